import math
import os
import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
from tests.llm.helpers import SF, UP, awkward, documents, empty, remainder

from tidewatt.llm import gru
from tidewatt.llm import language as op
from tidewatt.llm.common import table


def words_of(text):
    return [w for w in re.split("[ \t-\r]+", (text or "").translate(UP)) if w] + [None]


def brute(texts):
    counts = Counter()
    for doc_id, text in texts:
        if remainder(doc_id, 10):
            counts.update(words_of(text))
    total, distinct = sum(counts.values()), len(counts)
    base = {
        doc_id: (sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words_of(text)),
                 len(words_of(text)), sum(counts[w] > 0 for w in words_of(text)))
        for doc_id, text in texts}
    return base, total


def check(docs, found):
    base, total = brute([(r.doc_id, r.text) for r in docs.collect()])
    for r in found:
        score, n, known = base[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, score, rel_tol=1e-9, abs_tol=1e-9)
        assert r.held_out == (remainder(r.doc_id, 10) == 0)
        assert r.score < 0


def test_counts_and_base_scores_and_a_better_model(spark):
    docs = table(spark, SF, "documents")
    found = op.language_scores(docs).collect()
    check(docs, found)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_meet_their_counts_in_the_join(spark, monkeypatch):
    monkeypatch.setattr(op, "FREQUENT", 5)
    docs = table(spark, SF, "documents").limit(60)
    check(docs, op.language_scores(docs).collect())


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark).filter("doc_id IS NOT NULL AND doc_id <> 3")
    check(docs, op.language_scores(docs).collect())
    every = awkward(spark)
    assert op.language_scores(every).count() == every.count()
    assert op.language_scores(empty(spark)).count() == 0
    held = documents(spark, ["only held out words"], first=next(k for k in range(100) if remainder(k, 10) == 0))
    (row,) = op.language_scores(held).collect()
    assert (row.train_tokens, row.n_known, row.n_tokens) == (0, 0, 5)


def test_words_of_all_tails_share_one(spark):
    """The model's probabilities of the first word add up to one over all symbols."""
    weights = gru.initial(64)
    each = [gru.likelihoods(weights, np.array([s, 0]), np.array([0, 2]))[0] - rest(weights, s) for s in range(64)]
    assert math.isclose(sum(math.exp(x) for x in each), 1, rel_tol=1e-4)


def test_scores_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(op, "PART_TOKENS", 20_000)
    docs = table(spark, SF, "documents")
    assert op.part_count(130_000) == 6
    one, many = (
        {r.doc_id: r.score for r in op.language_scores(docs.repartition(n)).collect()} for n in (1, 16)
    )
    assert all(math.isclose(one[k], many[k], rel_tol=1e-6) for k in one)


def test_broadcasts_hold_no_class_of_the_package(spark):
    import pickle
    import pickletools

    words = op.Vocabulary(op.counted(documents(spark, ["a b c"] * 3)))
    assert not any("tidewatt" in str(arg) for _, arg, _ in pickletools.genops(pickle.dumps(vars(words))))
    again = op.Vocabulary.of(vars(words))
    assert again.total == 12 and again.look_up(words.hashes, np.zeros(3, np.int64))[1].tolist() == [3, 3, 3]


def test_workers_without_the_package(tmp_path):
    """In a process whose workers cannot import the package, all operators run that send models to tasks."""
    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[2])!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {str(tmp_path)!r}).config("spark.sql.shuffle.partitions", "2").getOrCreate())
from tidewatt.llm import registry
import os
def has(_):
    import importlib.util
    return [importlib.util.find_spec("tidewatt") is not None]
print("PACKAGE", spark.sparkContext.parallelize([0], 1).mapPartitions(has).collect())
for name in ("op9_language", "op12_secrets", "op4_quality"):
    print("ROWS", name, registry.queries()[name](spark, {SF!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    lines = run.stdout.splitlines()
    assert "PACKAGE [False]" in lines, run.stderr[-2000:]
    assert [line.split()[2] for line in lines if line.startswith("ROWS")] == ["200"] * 3


def rest(weights, symbol):
    """What the end after ``symbol`` adds, by stepping by hand."""
    h = np.zeros((1, gru.HIDDEN), np.float32)
    h = gru.advance(weights, h, np.array([0]), np.array([False]))[0]
    h = gru.advance(weights, h, np.array([symbol]), np.array([False]))[0]
    return gru.outputs(weights, h, np.array([0]))[0][0]


def test_a_score_does_not_depend_on_windows_lanes_or_neighbours():
    rng = np.random.default_rng(0)
    weights = gru.initial(64)
    parts = [np.append(rng.integers(1, 64, n), 0) for n in (3, 200, 50, 0, 77)]
    symbols, starts = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
    together = gru.likelihoods(weights, symbols, starts, 3)
    alone = [gru.likelihoods(weights, p, np.array([0, len(p)]))[0] for p in parts]
    assert np.allclose(together, alone, rtol=1e-4)


def test_gradients(monkeypatch):
    monkeypatch.setattr(gru, "WINDOW", 100)
    rng = np.random.default_rng(0)
    trainer = gru.Trainer(64)
    trainer.w = {k: v.astype(np.float64) * 2 for k, v in trainer.w.items()}
    symbols, starts, seen = rng.integers(0, 64, 30), np.array([0, 7, 12, 30]), {}
    monkeypatch.setattr(trainer, "apply", seen.update)
    trainer.learn(symbols, starts)
    for name, weights in trainer.w.items():
        at = np.unravel_index(np.abs(seen[name]).argmax(), weights.shape)
        kept, loss = weights[at], []
        for step in (1e-5, -1e-5):
            weights[at] = kept + step
            loss.append(-gru.likelihoods(trainer.w, symbols, starts, gru.LANES).sum() / 30)
        weights[at] = kept
        assert math.isclose((loss[0] - loss[1]) / 2e-5, seen[name][at], rel_tol=1e-3)


def test_tokens():
    hashes, _, starts = op.tokens(pa.array(["A b", None, "", " a\x0bB "]))
    assert np.diff(starts).tolist() == [3, 1, 1, 3]
    assert hashes[:3].tolist() == hashes[5:].tolist()
    assert (hashes[[2, 3, 4, 7]] == op.END).all()


def test_every_training_document_is_learned_from_once(spark, monkeypatch):
    docs = documents(spark, [f"w{k % 7} w{k % 3} end{k}" for k in range(4000)]).repartition(3)
    seen = spark.sparkContext.accumulator(0)

    def learn(self, symbols, starts):
        seen.add(len(starts) - 1)

    monkeypatch.setattr(gru.Trainer, "learn", learn)
    monkeypatch.setattr(op, "PART_TOKENS", 3000)
    words = op.Vocabulary(op.counted(docs))
    weights = op.fit(op.encoded(docs, words), words)
    assert seen.value == 4000 and op.part_count(words.total) > 4
    start = op.started(words)
    assert all(np.allclose(weights[k], start[k], rtol=1e-5) for k in start)


def test_rounds_lower_the_loss_and_start_at_the_shares(spark):
    texts = ["a b c d " * 50] * 60
    docs = documents(spark, texts)
    words = op.Vocabulary(op.counted(docs))
    hashes, tail, starts = op.tokens(pa.array(texts[:1]))
    symbols = words.look_up(hashes, tail)[0]
    shares = op.started(words)
    for k in ("class", "member"):
        shares[k] = shares[k] * 0
    assert math.isclose(gru.likelihoods(shares, symbols, starts)[0] / len(symbols), -math.log(4), rel_tol=0.05)
    assert gru.likelihoods(op.fit(op.encoded(docs, words), words), symbols, starts)[0] > 0.98 * gru.likelihoods(shares, symbols, starts)[0]


def test_known_words_have_their_base_and_share_ready():
    """They are worked out once for each word of the vocabulary, not for each token; symbols of their own have no share."""
    words = op.Vocabulary.__new__(op.Vocabulary)
    words.hashes, words.counts = np.array([3, 8, 20], np.uint64), np.array([5, 2, 7])
    words.symbols, words.tails = np.array([1, op.HEADS + 4, 2]), np.full((op.TAILS, 2), 9.0)
    words.total, words.distinct, words.ends = 30, 6, 4
    words.bases, words.shares = words.base(words.counts), np.array([0.0, -1.5, 0.0])
    hashes = np.array([8, 1, 20, int(op.END), 8, 99, 3], np.uint64)
    symbol, count, known, base, share = words.look_up(hashes, np.full(7, 4))
    assert symbol.tolist() == [op.HEADS + 4, op.HEADS + 4, 2, 0, op.HEADS + 4, op.HEADS + 4, 1]
    assert count.tolist() == [2, 0, 7, 4, 2, 0, 5] and known.tolist() == [True, False, True, True, True, False, True]
    assert base.tolist() == np.where(known, words.base(count), 0.0).tolist()
    assert share.tolist() == [-1.5, 0, 0, 0, -1.5, 0, 0]


def test_most_frequent_words_sort_only_words_of_their_counts(spark, monkeypatch):
    """Nearly all of the words of a large corpus are rare; they are left out before the sort, ties at the edge are not."""
    rows = [(h, 0, 1 + 9 * (h % 50 == 0) + 3 * (h % 10 == 0)) for h in range(-1000, 1000)]
    counts = spark.createDataFrame(rows, "h bigint, tail int, c bigint")
    best = sorted(rows, key=lambda r: (-r[2], r[0]))
    for size in (0, 1, 39, 40, 41, 150, 200, 201, 1999, 2000, 5000):
        assert [tuple(r) for r in op.frequent(counts, size).collect()] == best[:size]
    plan = op.frequent(counts, 150)._jdf.queryExecution().optimizedPlan().toString()
    assert "(c#" in plan and ">= 4)" in plan


def test_frequent_words_do_not_go_through_the_join(spark):
    """Some 200,000 words are known in the tasks, so that few meet their counts by a shuffle."""
    docs = documents(spark, [" ".join(f"w{k}" for k in range(start, start + 1000)) for start in range(0, 40_000, 1000)])
    words = op.Vocabulary(op.counted(docs))
    assert len(words.hashes) == 40_000
    assert op.encoded(docs, words).filter("size(h) > 0").count() == 0
