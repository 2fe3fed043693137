"""Quality classifier: logistic regression over hashed word n-grams, learned by FTRL-proximal.

Words are runs of letters and digits (any byte above ASCII counts as a letter)
and runs of other signs; a word that repeats its predecessor, or the word before
a sign in between, becomes one common repeat word.  Every n-gram up to ``N`` words is hashed into one of ``BUCKETS``
features, whose value is its share of the text's n-grams times ``SCALE``.

Learning reads at most ``TRAIN_ROWS`` labelled documents, those whose ids hash
lowest, in one task and one pass, a batch at a time: that bound is the only
limit, and every document is scored.  Weights are ``BUCKETS`` + 1 doubles
whatever the input.  No label, language, source or id enters a score.

Defined results: a null or empty text has no n-grams and is scored by the
constant alone.  A null or other label than 0 and 1 is not learned from; without
any label to learn from all scores are 0.5.  Rows with a null id are scored but
not learned from.  Repeated documents each get a row; a document that repeats
in the training rows is learned from as often.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.common import (
    BASE,
    WORD_BYTES,
    chunks,
    hash_spans,
    mix,
    remainder,
    split_words,
    text_bytes,
)

N = 2
BUCKETS = 1 << 18
SCALE = 32.0
TRAIN_ROWS = 20_000
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
REPEAT = np.uint64(1)

KINDS = np.where(WORD_BYTES > 0, 2, 0).astype(np.uint8)
KINDS[[c for c in range(128) if chr(c).isalnum()]] = 1
KINDS[128:] = 1


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every n-gram, and the number of n-grams of each row."""
    raw, offsets = text_bytes(texts)
    starts, ends, before = split_words(raw, offsets, KINDS)
    words = hash_spans(raw, starts, ends)
    counts = np.diff(before)
    rows = np.repeat(np.arange(len(counts)), counts)
    repeats = np.zeros(len(words), bool)
    repeats[1:] = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
    letters = KINDS[raw[starts]] == 1
    repeats[2:] |= (words[2:] == words[:-2]) & (rows[2:] == rows[:-2]) & letters[2:]
    words = np.where(repeats, REPEAT, words)
    found, where, gram = [words], [rows], words
    for _ in range(N - 1):
        same = rows[: len(gram) - 1] == rows[len(rows) - len(gram) + 1 :] if len(gram) else np.zeros(0, bool)
        gram = mix(gram[:-1] * BASE + words[len(words) - len(gram) + 1 :])
        found.append(gram[same])
        where.append(rows[: len(gram)][same])
    buckets = (np.concatenate(found) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    at = np.concatenate(where)
    return buckets, at, np.bincount(at, minlength=len(texts))


class Follower:
    """FTRL-proximal with a rate per coordinate; the last coordinate is the constant."""

    def __init__(self) -> None:
        self.z = np.zeros(BUCKETS + 1)
        self.n = np.zeros(BUCKETS + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        pulled = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, pulled)

    def learn(self, buckets: np.ndarray, label: int) -> None:
        at, counts = np.unique(buckets, return_counts=True)
        value = np.append(counts * (SCALE / max(len(buckets), 1)), 1.0)
        at = np.append(at, BUCKETS)
        weights = self.weights(at)
        gradient = (sigmoid(weights @ value) - label) * value
        step = (np.sqrt(self.n[at] + gradient**2) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += gradient - step * weights
        self.n[at] += gradient**2


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def training_rows(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text, label of the labelled training documents, ``rows`` at most."""
    chosen = (
        labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL")
        .filter(remainder(F.col("doc_id"), 3) != 1)
        .groupBy("doc_id").agg(F.max("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    # At most TRAIN_ROWS pairs of id and label, so this broadcast has a fixed bound.
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fit(examples: DataFrame) -> np.ndarray:
    """Weights learned in one task from the bounded examples, in the order of their ids' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Follower()
        for batch in batches:
            for part in chunks(batch, "text"):
                buckets, at, _ = features(part.column(1))
                order = np.argsort(at, kind="stable")
                each = np.split(buckets[order], np.searchsorted(at[order], np.arange(1, part.num_rows)))
                for one, label in zip(each, part.column(2).to_pylist(), strict=True):
                    model.learn(one, label)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights().tobytes()])], names=["weights"])

    one = examples.select("doc_id", "text", "label").repartition(1)
    ordered = one.sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    learned = ordered.mapInArrow(run, "weights binary").first()
    return np.frombuffer(learned[0]) if learned else np.zeros(BUCKETS + 1)  # nothing to learn from


def scored(documents: DataFrame, weights: np.ndarray, score: str = "score") -> DataFrame:
    """The documents with a score from 0 to 1 as a further column, or in the place of one so named."""
    shared = documents.sparkSession.sparkContext.broadcast(weights)
    names = [c for c in documents.columns if c != score]
    at_text = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                buckets, at, counts = features(part.column(at_text))
                sums = np.bincount(at, shared.value[buckets], minlength=part.num_rows)
                margin = shared.value[-1] + sums * (SCALE / np.maximum(counts, 1))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sigmoid(margin))], names=[*names, score])

    kept = documents.select(*names)
    return kept.mapInArrow(run, kept.withColumn(score, F.lit(0.0)).schema)


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    weights = fit(training_rows(documents, labels))
    return scored(documents.select("doc_id", "text"), weights).select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def good_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents scored at least 0.5; same columns."""
    weights = fit(training_rows(documents, labels))
    name = "score"
    while name in documents.columns:
        name += "_"
    return scored(documents, weights, name).filter(F.col(name) >= 0.5).drop(name)
