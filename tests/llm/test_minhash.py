import random

import numpy as np
import pyarrow as pa
from tests.llm.helpers import awkward, by_id, documents, empty, words

from tidewatt.llm import minhash as op
from tidewatt.llm.components import components


def sets(texts, size):
    out = []
    for t in texts:
        w = words(t)
        out.append({tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set())
    return out


def brute(texts, size, percent=80):
    s, label = sets(texts, size), list(range(len(texts)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(s)):
        for b in range(a):
            if s[a] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b]):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return [root(x) for x in range(len(s))], [len(x) for x in s]


def family(rng, base, count, edits):
    out = []
    for _ in range(count):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_same_components_as_all_pairs(spark):
    rng = random.Random(3)
    texts = []
    for k in range(6):
        base = [f"b{k}w{rng.randrange(300)}" for _ in range(120)]
        texts += family(rng, base, 25, 9)
    texts += [texts[0]] * 30 + [None, "", " \n", "a b", "A  b", "a b c"]
    rng.shuffle(texts)
    found = by_id(op.near_duplicates(documents(spark, texts), size=4))
    labels, sizes = brute(texts, 4)
    assert [found[k]["component_id"] for k in range(len(texts))] == labels
    assert [found[k]["n_shingles"] for k in range(len(texts))] == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found.values())


def test_a_large_group_near_the_threshold_gives_no_rows_for_its_pairs(spark, monkeypatch):
    """A fifth of all pairs are linked; rows stay in proportion to the members of buckets, in blocks of any size."""
    rng = random.Random(8)
    texts = []
    for k, count in enumerate((160, 40)):
        base = [f"g{k}w{n}" for n in range(150)]
        for _ in range(count):
            at = set(rng.sample(range(0, 150, 15), 3))
            texts.append(" ".join(f"x{rng.randrange(10**6)}" if n in at else w for n, w in enumerate(base)))
    labels, _ = brute(texts, 4)
    assert 1 < len(set(labels)) < len(texts) / 4
    seen = []
    for cost in (op.BLOCK_COST, 20 * op.MEMBER_COST):
        monkeypatch.setattr(op, "BLOCK_COST", cost)
        monkeypatch.setattr(op, "components", lambda links: seen.append(links.count()) or components(links))
        found = by_id(op.near_duplicates(documents(spark, texts), size=4))
        assert [found[k]["component_id"] for k in range(len(texts))] == labels
    assert max(seen) < 5 * len(texts), seen


def test_shared_differences_are_counted_whatever_their_number():
    rng = np.random.default_rng(0)

    def block(count):
        sets = [set(rng.integers(0, 60, rng.integers(0, 20)).tolist()) | set(rng.integers(100, 9000, 30).tolist()) for _ in range(count)]
        made = op.Members.__new__(op.Members)
        made.n, made.values = np.ones(count), np.array([v for s in sets for v in s], np.int64)
        made.rows = np.repeat(np.arange(count), [len(s) for s in sets])
        return made, sets

    for sizes in ((1, 1), (50, 80), (200, 7)):
        (one, ours), (two, theirs) = map(block, sizes)
        assert op.common([one, two]).tolist() == [[len(a & b) for b in theirs] for a in ours]
        assert np.array_equal(np.triu(op.common([one]), 1), np.triu([[len(a & b) for b in ours] for a in ours], 1))


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    found = op.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    of = {r.doc_id: r.component_id for r in found}
    assert of[6] == of[7] == of[5] == 5
    assert all(r.component_id == r.doc_id and r.kept for r in found if r.n_shingles == 0 or r.doc_id is None)
    assert op.near_duplicates(empty(spark)).count() == 0


def test_deduplicated_keeps_one_of_each_group_and_all_columns(spark):
    docs = awkward(spark)
    kept = op.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([None, *[r.doc_id for r in docs.collect() if r.doc_id not in (None, 6, 7)]], key=str)


def test_other_texts_of_a_shared_id_stay(spark):
    story, tale = (" ".join(f"{k}{n}" for n in range(60)) for k in ("s", "t"))
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "wholly other words that stay here"),
            (3, story), (4, story + " end"), (4, tale), (5, tale + " end"), (5, tale + " end"), (4, tale)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = sorted(tuple(r) for r in op.deduplicated(docs).collect())
    assert kept == sorted([rows[0], rows[2], rows[3], rows[5], rows[8]])
    found = sorted((r.doc_id, r.component_id, r.kept) for r in op.near_duplicates(docs).collect())
    assert found == [(1, 1, True), (2, 1, False), (2, 2, True), (3, 3, True), (4, 3, False), (4, 4, True), (4, 4, True),
                     (5, 4, False), (5, 4, False)]


def test_words_and_shingles_are_those_of_the_contract():
    texts = ["A b\x0bC", " x y", None, "", "É é", "a b c d e", "one"]
    values, rows = op.distinct_shingles(pa.array(texts), 4)
    assert np.bincount(rows, minlength=len(texts)).tolist() == [len(x) for x in sets(texts, 4)]
    same, _ = op.distinct_shingles(pa.array(["a B c d"]), 4)
    other, _ = op.distinct_shingles(pa.array(["A b C\nd"]), 4)
    assert same.tolist() == other.tolist()


def test_min_and_max_agree_as_often_as_sets_do():
    rng = np.random.default_rng(0)
    one = rng.integers(0, 2**63, 1000).astype(np.uint64)
    two = np.concatenate([one[:800], rng.integers(0, 2**63, 200).astype(np.uint64)])
    a = op.min_max(op.mix(one), np.array([0]), 600)
    b = op.min_max(op.mix(two), np.array([0]), 600)
    assert abs((a == b).mean() - 800 / 1200) < 0.04


def test_components_of_a_path_a_star_and_repeats(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(30)] + [(7, 7), (None, 3), (1, 0), (0, 1)]
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert found == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
