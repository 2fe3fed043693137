import random
import re
import zlib
from collections import Counter

import pytest
from tests.llm.helpers import UP, awkward, awkward_texts, documents, empty, rows_of

from tidewatt.llm import spelling as op


def near(a, b):
    """Whether b is a with one code point inserted, deleted or replaced, tried one by one."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def expected(counts, ratio=10):
    found = {}
    for word, n in counts.items():
        others = [o for o in counts if near(word, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form = best if best and counts[best] >= ratio * n else None
        found[word] = {"word": word, "form": form, "n": n, "n_near": len(others), "form_n": counts.get(form)}
    for word, row in found.items():
        root = word
        while found[root]["form"]:
            root = found[root]["form"]
        row["root"] = root
    return found


def vocabulary(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


@pytest.mark.parametrize("seed", range(200))
def test_one_list_as_by_brute_force(seed):
    rng = random.Random(seed)
    size = rng.randrange(1, 6)
    entries = sorted({"".join(rng.choice("abç") for _ in range(size + rng.randrange(2))) for _ in range(rng.randrange(1, 40))})
    shared = [0, *(op.common_prefix(a, b) for a, b in zip(entries, entries[1:], strict=False))]
    for query in entries:
        if len(query) == size:
            wanted = [k for k, e in enumerate(entries) if len(e) >= size and near(query, e)]
            assert list(op.near_entries(query, entries, shared)) == wanted


@pytest.mark.parametrize("most", [1, 4, 1000])
def test_groups_as_by_brute_force(spark, most):
    """Also where every list is halved down to single places."""
    rng = random.Random(7)
    counts = {}
    for _ in range(60):
        word = "".join(rng.choice("abé") for _ in range(rng.randrange(7, 10)))
        counts[word] = rng.choice([2, 20, 300, 5000])
        for _ in range(4):
            k, letter = rng.randrange(len(word)), rng.choice("abéz")
            variant = rng.choice([word[:k] + word[k + 1 :], word[:k] + letter + word[k:], word[:k] + letter + word[k + 1 :]])
            if len(variant) >= 7:
                counts.setdefault(variant, rng.choice([2, 2, 20, 300]))
    found = {r["word"]: r for r in rows_of(op.variant_groups(vocabulary(spark, counts), most=most))}
    assert found == expected(counts)
    assert any(r["root"] != r["form"] for r in found.values() if r["form"])


def test_a_list_with_most_words_is_dealt_anew(spark):
    counts = {f"abcde{k:05d}".translate(str.maketrans("0123456789", "ghijklmnop")): 2 for k in range(1500)}
    counts |= {"abcdegggggx": 50}
    lists = op.lists(vocabulary(spark, counts), 64).groupBy("key", "low", "high").count()
    assert lists.filter("high - low > 1").agg({"count": "max"}).first()[0] <= 64
    assert lists.agg({"count": "max"}).first()[0] <= 10 * 10  # one place: a word's one letter there, or its two
    found = {r["word"]: r for r in rows_of(op.variant_groups(vocabulary(spark, counts), most=64))}
    assert found == expected(counts)


def test_chains_end_at_their_root(spark):
    words = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb", "aaaabbbb", "aaabbbbb"]
    counts = {w: 2 * 10**k for k, w in enumerate(words)}
    found = {r["word"]: r for r in rows_of(op.variant_groups(vocabulary(spark, counts)))}
    assert found == expected(counts) and {r["root"] for r in found.values()} == {words[-1]}


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def test_query_as_by_brute_force(spark):
    rng = random.Random(2)
    words = ["Übergang", "uebergang", "spelling", "Spéllings", "another", "anothers", "ÀÉÎõüÿß", "×÷×÷×÷×", "short", "miscount"]
    texts = [*awkward_texts(), *[" ".join(rng.choice(words) for _ in range(80)) + ".İstanbulx" for _ in range(40)]]
    frame = documents(spark, texts)
    frame = frame.unionByName(frame.filter("doc_id = 20"))
    counts = counted([(r["doc_id"], r["text"]) for r in rows_of(frame)])
    found = {r["word"]: r for r in rows_of(op.spelling_variants(frame))}
    assert found == expected(counts) and len(found) > 10 and any(r["form"] for r in found.values())


def test_awkward_and_empty_tables(spark):
    frame = awkward(spark)
    counts = counted([(r["doc_id"], r["text"]) for r in rows_of(frame.select("doc_id", "text"))])
    assert {r["word"]: r["n"] for r in rows_of(op.spelling_variants(frame))} == counts
    assert rows_of(op.spelling_variants(empty(spark))) == []
