"""Scores of whole documents by a gated recurrent language model.

Tokens are lower-cased words and one end.  The most frequent words, and the end,
are symbols of the network (``gru``); every other word is one of ``TAILS`` tail
symbols, chosen by its last two bytes, times the word's smoothed share among the
training words of that tail.  So the model gives every word a probability.

Counts cover all training documents (crc32 of the id modulo 10 is not 0): one
aggregate of words counted task by task.  The ``FREQUENT`` most frequent words go
to all tasks, a fixed bound; counts of all other words meet the documents in a
join.  The network starts from the symbols' shares and learns from every training
document once, in ``ROUNDS`` rounds over disjoint shares of the documents.  In a
round the documents are dealt to parts of about ``PART_TOKENS`` tokens a run, by
a hash of the row: the number of parts follows the training tokens, not the tasks or files.
Every part goes on from the same weights and optimiser moments, takes its
documents in the order of their hashes, and what the parts reach, of fixed size, is
averaged by tokens.  So the weights do not depend on how the rows are dealt to tasks.
Rows that agree in id and text go to one part, as symbols of two bytes a token.
Documents are scored whole, in lanes, with the state carried from window to window.
Words are told apart by 64-bit hashes.

Defined results: a null or empty text is the end alone.  Repeated rows each get a
row and are each counted.  Rows with a null id count as those with the id "".
Without training documents every count is 0.  Of words with equal counts at the edge
of the most frequent ones, those with the smaller hash are in.  Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.llm import gru
from tidewatt.llm.common import LOWERED, chunks, hash_spans, one_thread, remainder, saved, split_words, text_bytes

FREQUENT = 1 << 18
SYMBOLS, TAILS = 1024, 64
HEADS = SYMBOLS - TAILS  # the end, and the most frequent words
ROUNDS = 3
PART_TOKENS = 6_000_000  # of all rounds together
LEARN_TOKENS = 2_000_000  # learnt from at a time, so that the lanes are about as long as long documents
PIECES = 64  # of what the parts reach, to be added up apart
RUN_BYTES = 1 << 20  # text read at once
SCORE_TOKENS = 2_000_000  # about as many go through the network at once, whole documents only
COUNT_RUN = 1 << 23
END = np.uint64(0xE0D)
ENCODED = (
    "doc_id bigint, place bigint, n_tokens bigint, n_known bigint, base double, "
    "h array<bigint>, tail array<int>, times array<bigint>, shares double, symbols binary"
)
NAMES = [column.split()[0] for column in ENCODED.split(", ")]


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and tail of every token, each row's end included, and where rows begin."""
    raw, offsets = text_bytes(texts)
    raw = np.take(LOWERED, raw)
    starts, ends, rows = split_words(raw, offsets)
    hashes = hash_spans(raw, starts, ends)
    before = np.where(ends - starts > 1, raw[np.maximum(ends - 2, 0)], 0).astype(np.int64)
    tail = ((before * 31 + raw[ends - 1]) * 2654435761 >> 8) % TAILS
    return np.insert(hashes, rows[1:], END), np.insert(tail, rows[1:], 0), rows + np.arange(len(rows))


def counted(documents: DataFrame) -> DataFrame:
    """h, tail, c of every training word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in chunks(batch, "text"):
                hashes, tail, _ = tokens(part.column(0))
                held.append((hashes, tail))
                size += part.nbytes
                if size >= COUNT_RUN:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)

    def rows(held: list) -> pa.RecordBatch:
        hashes, tail = (np.concatenate(x) for x in zip(*held, strict=True))
        found, first, n = np.unique(hashes, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(tail[first].astype(np.int32)), pa.array(n.astype(np.int64))],
            names=["h", "tail", "c"])

    part = documents.select("text").mapInArrow(run, "h bigint, tail int, c bigint")
    return part.groupBy("h").agg(F.min("tail").alias("tail"), F.sum("c").alias("c"))


def frequent(counts: DataFrame, size: int) -> DataFrame:
    """The ``size`` words of largest count, of equal ones those with the smaller hash.

    Only words that reach the count of the last of them are sorted, so that one task does not meet ``size`` words
    of every other.  There are few different counts: their sum is that of the training words at most.
    """
    by_count = counts.groupBy("c").agg(F.count("*").alias("n")).toPandas().sort_values("c", ascending=False)
    enough = by_count["c"][by_count["n"].cumsum() >= size]
    least = int(enough.iloc[0]) if len(enough) else 0
    return counts.filter(F.col("c") >= least).orderBy(F.desc("c"), "h").limit(size)


class Vocabulary:
    """What every task holds: frequent words, totals of the tails; ``FREQUENT`` and ``TAILS`` entries."""

    def __init__(self, counts: DataFrame) -> None:
        end = int(END)
        rows = frequent(counts.filter(F.col("h") != end), FREQUENT).toPandas()
        totals = counts.agg(F.sum("c"), F.count("*"), F.sum(F.when(F.col("h") == end, F.col("c")))).first()
        self.total, self.distinct, self.ends = (int(x or 0) for x in totals)
        hashes, c = rows["h"].to_numpy(np.int64).view(np.uint64), rows["c"].to_numpy(np.int64)
        symbol = np.arange(1, len(rows) + 1)
        tail = rows["tail"].to_numpy(np.int64)
        symbol = np.where(symbol < HEADS, symbol, HEADS + tail)
        inside = [(int(h), int(t), int(n)) for h, t, n in zip(hashes[: HEADS - 1].view(np.int64), tail, c, strict=False)]
        self.tails = np.zeros((TAILS, 2))  # tokens and distinct words
        for row in counts.filter(F.col("h") != end).groupBy("tail").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
            self.tails[row.tail] = row.c, row.n
        for _, t, n in inside:
            self.tails[t] -= n, 1
        order = np.argsort(hashes)
        self.hashes, self.counts, self.symbols = hashes[order], c[order], symbol[order]
        self.bases = self.base(self.counts)
        self.shares = np.where(self.symbols < HEADS, 0.0, self.share(self.counts, tail[order]))

    @classmethod
    def of(cls, state: dict) -> Vocabulary:
        """The vocabulary of ``vars()``: tasks get plain arrays, since broadcasts carry no code and executors lack the package."""
        words = cls.__new__(cls)
        vars(words).update(state)
        return words

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.total + 0.1 * (self.distinct + 1)))

    def share(self, c: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its tail."""
        return np.log10((c + 0.1) / (self.tails[tail, 0] + 0.1 * (self.tails[tail, 1] + 1)))

    def look_up(self, hashes: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, ...]:
        """Symbol and count of each token; whether the count is known here, and its base and share of its tail then."""
        at = np.empty(len(hashes), np.int64)
        order = np.argsort(hashes)  # words in order are found much faster
        at[order] = np.searchsorted(self.hashes, hashes[order])
        at[at == len(self.hashes)] = 0
        found = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        symbol = HEADS + tail
        count, base, share = np.zeros(len(hashes), np.int64), np.zeros(len(hashes)), np.zeros(len(hashes))
        at = at[found]
        symbol[found], count[found], base[found], share[found] = self.symbols[at], self.counts[at], self.bases[at], self.shares[at]
        is_end = hashes == END
        symbol[is_end], count[is_end], base[is_end] = 0, self.ends, self.base(np.array(self.ends))
        return symbol, count, found | is_end, base, share


def started(words: Vocabulary) -> gru.Weights:
    """Weights whose biases give every symbol its share of the training tokens."""
    weights = gru.initial(SYMBOLS)
    seen = np.zeros(SYMBOLS)
    seen[0] = words.ends
    inside = words.symbols < HEADS
    seen[words.symbols[inside]] = words.counts[inside]
    seen[HEADS:] = words.tails[:, 0]
    seen = (seen + 0.1).reshape(weights["member_b"].shape)
    weights["class_b"][:] = np.log(seen.sum(1) / seen.sum())
    weights["member_b"][:] = np.log(seen / seen.sum(1, keepdims=True))
    return weights


def part_count(tokens: int) -> int:
    return max(1, round(tokens / PART_TOKENS))


def learned(training: DataFrame, state: np.ndarray, parts: int) -> np.ndarray:
    """Average, by tokens, of what the parts reach from ``state`` on their documents (part, place, symbols)."""
    shared = training.sparkSession.sparkContext.broadcast(state)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        documents = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True))
        for part, group in groupby(documents, key=itemgetter(0)):
            trainer = gru.Trainer(SYMBOLS)
            trainer.unpack(shared.value)
            size, held, waiting = 0, [], 0
            for _, data in group:
                held.append(np.frombuffer(data, np.int16))
                size, waiting = size + len(held[-1]), waiting + len(held[-1])
                if waiting >= LEARN_TOKENS:
                    learn_from(trainer, held)
                    held, waiting = [], 0
            if held:
                learn_from(trainer, held)
            pieces = np.array_split(trainer.packed(), PIECES)
            yield rows(list(range(PIECES)), [part] * PIECES, pieces, [size] * PIECES)

    def learn_from(trainer: gru.Trainer, held: list[np.ndarray]) -> None:
        starts = np.cumsum([0, *map(len, held)])
        trainer.learn(np.concatenate(held).astype(np.int32), starts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        sizes: dict[int, int] = {}
        for batch in batches:
            for k, _, value, size in zip(*batch.columns, strict=True):
                k = k.as_py()
                sums[k] = sums.get(k, 0) + np.frombuffer(value.as_py(), np.float32).astype(np.float64) * size.as_py()
                sizes[k] = sizes.get(k, 0) + size.as_py()
        yield rows(list(sums), [0] * len(sums), [sums[k] / sizes[k] for k in sums], list(sizes.values()))

    def rows(pieces: list, parts: list, values: list, sizes: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(pieces, pa.int64()), pa.array(parts, pa.int64()), pa.array([v.astype(np.float32).tobytes() for v in values], pa.binary()),
             pa.array(sizes, pa.int64())], names=["piece", "part", "value", "size"])

    schema = "piece bigint, part bigint, value binary, size bigint"
    dealt = training.repartition(parts, "part").sortWithinPartitions("part", "place", "symbols")
    each = dealt.mapInArrow(learn, schema).repartition(PIECES, "piece").sortWithinPartitions("piece", "part")
    found = sorted(each.mapInArrow(add, schema).collect())  # PIECES rows of fixed size
    return np.concatenate([np.frombuffer(r.value, np.float32) for r in found]) if found else state


def fit(training: DataFrame, words: Vocabulary) -> gru.Weights:
    """Weights from all training documents, given as ``encoded`` has them."""
    trainer = gru.Trainer(SYMBOLS)
    trainer.w = started(words)
    state, parts = trainer.packed(), part_count(words.total)
    place = F.col("place")
    hashed = training.select(F.pmod(F.xxhash64(place), F.lit(parts)).alias("part"), "place", "symbols")
    for k in range(ROUNDS):
        state = learned(hashed.filter(F.pmod(place, F.lit(ROUNDS)) == k), state, parts)
    trainer.unpack(state)
    return trainer.w


def scored(rows: DataFrame, weights: gru.Weights) -> DataFrame:
    """row and ``model``, what the network gives the document's symbols (log10)."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        held, size = [], 0
        for batch in batches:
            for row, data in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                held.append((row, np.frombuffer(data, np.int16)))
                size += len(held[-1][1])
                if size >= SCORE_TOKENS:
                    yield scores(held)
                    held, size = [], 0
        if held:
            yield scores(held)

    def scores(held: list) -> pa.RecordBatch:
        symbols = np.concatenate([x[1] for x in held])
        model = gru.likelihoods(shared.value, symbols, np.cumsum([0] + [len(x[1]) for x in held])) / np.log(10)
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in held], pa.int64()), pa.array(model)], names=["row", "model"])

    return rows.select("row", "symbols").mapInArrow(run, "row bigint, model double")


def encoded(documents: DataFrame, words: Vocabulary) -> DataFrame:
    """Per document: its symbols, n_tokens, and sums over the tokens whose counts are known in the task; the others as
    lists.  Saved, so that texts are split into words once for the network's training and scores."""
    shared = documents.sparkSession.sparkContext.broadcast(vars(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary.of(shared.value)
        for batch in batches:
            for part in chunks(batch, "text", RUN_BYTES):
                yield known_part(part, words)

    def known_part(part: pa.RecordBatch, words: Vocabulary) -> pa.RecordBatch:
        hashes, tail, starts = tokens(part.column(2))
        symbol, count, known, base, share = words.look_up(hashes, tail)
        symbol = symbol.astype(np.int16)
        sizes = np.diff(starts)
        row = np.repeat(np.arange(len(sizes)), sizes)

        def per_row(values: np.ndarray) -> np.ndarray:
            return np.bincount(row, values, minlength=len(sizes))

        rare = np.flatnonzero(~known)
        rare = rare[np.argsort(hashes[rare])]
        order = rare[np.argsort(row[rare].astype(np.min_scalar_type(len(sizes))), kind="stable")]  # few rows sort by their digits
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(order)))
        of = order[first]
        ends = np.append(0, np.cumsum(np.bincount(row[of], minlength=len(sizes)))).astype(np.int32)
        lists = [hashes[of].view(np.int64), tail[of].astype(np.int32), times.astype(np.int64)]
        columns = [
            part.column(0), part.column(1), pa.array(sizes.astype(np.int64)), pa.array(per_row(count > 0).astype(np.int64)), pa.array(per_row(base)),
            *[pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in lists], pa.array(per_row(share)),
            pa.array([symbol[a:b].tobytes() for a, b in zip(starts, starts[1:], strict=False)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=NAMES)

    place = F.xxhash64("doc_id", "text").alias("place")
    rows = documents.select("doc_id", place, "text").mapInArrow(run, ENCODED)
    return saved(rows.withColumn("row", F.monotonically_increasing_id()), "op9-rows")


def language_scores(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document."""
    training = documents.filter(remainder(F.col("doc_id"), 10) != 0)
    counts = saved(counted(training), "op9-counts")
    words = Vocabulary(counts)
    rows = encoded(documents, words)
    weights = fit(rows.filter(remainder(F.col("doc_id"), 10) != 0), words)
    tails = documents.sparkSession.createDataFrame(
        [(k, float(np.log10(n + 0.1 * (d + 1)))) for k, (n, d) in enumerate(words.tails)], "tail int, whole double"
    )
    rare = rows.select("row", F.explode(F.arrays_zip("h", "tail", "times")).alias("x")).select("row", "x.*")
    met = rare.join(counts.select("h", "c"), "h", "left").join(F.broadcast(tails), "tail")
    seen = F.log10(F.coalesce("c", F.lit(0)) + 0.1)
    whole = float(np.log10(words.total + 0.1 * (words.distinct + 1)))
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * (seen - whole)).alias("more_base"),
        F.sum(F.col("times") * (seen - F.col("whole"))).alias("more_model"),
    )
    zero = F.lit(0.0)
    read = rows.drop("h", "tail", "times", "symbols").join(saved(scored(rows, weights), "op9-scores"), "row")
    return read.join(sums, "row", "left").select(
        "doc_id", (remainder(F.col("doc_id"), 10) == 0).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("model") + F.col("shares") + F.coalesce("more_model", zero)).alias("score"),
    )
