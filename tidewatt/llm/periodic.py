"""Periodic runs of words: stretches that repeat with a period, found by extension queries.

A run of period q is a stretch of words, each equal to the word q before it, as long as it can
be.  Wanted are runs of at least ``LEAST_WORDS`` words and ``LEAST_TIMES`` periods, q being
the stretch's smallest period.  Such a run of period p holds so many words i equal to word
i + p in a row (p less than its length) that a grid of max(2p, LEAST_WORDS - p) words meets one:
for every p the pairs (i, i + p) on that grid are tried, some n log n pairs for a document of
n words.  How far a pair's words agree, ahead and behind, gives the run.

Words are compared one by one at first; most pairs end there.  Documents with pairs that
agree for longer get an index, forwards and backwards: the suffixes at positions in a difference
cover (4 of 13) are sorted, by their first 13 words and then by doubling, and a sparse
table over the common prefixes of neighbours answers range minima.  Any two positions are
at most 12 words before two sampled ones, so a query compares few words and looks up the rest.

Defined results: null and empty texts have no words and no runs.  Words are told apart by
their bytes, case included.  Of several periods of one stretch the smallest counts.  Equal
rows give equal results; further columns are not read.  Memory is in proportion to a run of
texts of ``CHUNK`` bytes, or to one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.common import chunks, remainder

LEAST_WORDS, LEAST_TIMES = 24, 3
CHUNK = 1 << 20
# Positions modulo 13 whose differences are all residues.
MODULUS, COVER = 13, (0, 1, 3, 9)
PLACE = np.full(MODULUS, -1)
PLACE[list(COVER)] = np.arange(len(COVER))
# The least step after which two positions are both in the cover.
MEET = np.array([
    [next(h for h in range(MODULUS) if (a + h) % MODULUS in COVER and (b + h) % MODULUS in COVER) for b in range(MODULUS)]
    for a in range(MODULUS)
])


class Extensions:
    """How many values from two positions on agree, for a line whose last value occurs nowhere else."""

    def __init__(self, line: np.ndarray) -> None:
        self.line = np.concatenate([line, np.full(MODULUS, line.min() - 1)])
        places = np.arange(len(line))
        places = places[PLACE[places % MODULUS] >= 0]
        windows = self.line[places[:, None] + np.arange(MODULUS)]
        order = np.lexsort(windows.T[::-1])
        ranks = [self._ranked(order, (windows[order[1:]] != windows[order[:-1]]).any(axis=1))]
        step = len(COVER)
        while ranks[-1].max() + 1 < len(places):
            first = ranks[-1]
            second = np.full(len(places), -1)
            second[:-step] = first[step:]
            order = np.lexsort((second, first))
            a, b = order[1:], order[:-1]
            ranks.append(self._ranked(order, (first[a] != first[b]) | (second[a] != second[b])))
            step *= 2
        self.rank = ranks[-1]
        self.table = self._minima(self._shared(order, places, ranks))

    @staticmethod
    def _ranked(order: np.ndarray, differs: np.ndarray) -> np.ndarray:
        rank = np.empty(len(order), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(differs)])
        return rank

    def _shared(self, order: np.ndarray, places: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of neighbouring suffixes: whole blocks by their ranks, largest first, then single values."""
        a, b = order[:-1].copy(), order[1:].copy()
        shared = np.zeros(len(a), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            same = ranks[level][a] == ranks[level][b]
            shared += same * (MODULUS << level)
            a += same * (len(COVER) << level)
            b += same * (len(COVER) << level)
        return shared + self._compared(places[a], places[b], np.full(len(a), MODULUS))

    @staticmethod
    def _minima(values: np.ndarray) -> list[np.ndarray]:
        table, width = [values], 1
        while 2 * width <= len(values):
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many of the next ``most`` values agree, compared one after the other."""
        agreed = np.zeros(len(i), np.int64)
        left = np.arange(len(i))
        for step in range(MODULUS):
            left = left[most[left] > step]
            left = left[self.line[i[left] + step] == self.line[j[left] + step]]
            agreed[left] += 1
        return agreed

    def agree(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For pairs of different positions, how many values from there on agree."""
        meet = MEET[i % MODULUS, j % MODULUS]
        agreed = self._compared(i, j, meet)
        met = np.flatnonzero(agreed == meet)
        a, b = (self.rank[self._sample(x[met] + meet[met])] for x in (i, j))
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp(high - low)[1] - 1
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.table[k]
            agreed[met[at]] += np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        return agreed

    @staticmethod
    def _sample(position: np.ndarray) -> np.ndarray:
        return position // MODULUS * len(COVER) + PLACE[position % MODULUS]


def grid(period: int | np.ndarray):
    """Pairs that agree in a row in any run of this period, at least."""
    return np.maximum((LEAST_TIMES - 1) * period, LEAST_WORDS - period)


def joined(sequences: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sequences in one line, each between values that occur nowhere else, and their starts."""
    parts = [np.array([-1])]
    for k, sequence in enumerate(sequences):
        parts += [sequence, np.array([-2 - k])]
    starts = np.cumsum([1] + [len(s) + 1 for s in sequences])
    return np.concatenate(parts), starts


def agreeing(line: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, period) of equal words on the grids; sequences come longest first."""
    places, periods = [], []
    for period in range(1, int(lengths[0]) // LEAST_TIMES + 1 if len(lengths) else 1):
        fits = int(np.searchsorted(-lengths, -max(LEAST_TIMES * period, LEAST_WORDS), side="right"))
        if not fits:
            break
        step, end = int(grid(period)), int(ends[fits - 1])
        found = np.flatnonzero(line[: end - period : step] == line[period:end:step])
        if len(found):
            places.append(found * step)
            periods.append(np.full(len(found), period))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def few_compared(line: np.ndarray, i: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether a pair can lie in a run, by up to ``MODULUS`` words ahead and as many behind."""
    agreed = []
    for direction in (1, -1):
        count = np.zeros(len(i), np.int64)
        left = np.arange(len(i))
        for step in range(MODULUS):
            at = i[left] + (step if direction > 0 else -1 - step)
            inside = (at >= 0) & (at + period[left] < len(line))
            left, at = left[inside], at[inside]
            same = line[at] == line[at + period[left]]
            left = left[same]
            count[left] += 1
        agreed.append(count)
    ahead, behind = agreed
    return (ahead == MODULUS) | (behind == MODULUS) | (ahead + behind >= grid(period))


def sequence_runs(sequences: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Rows (start, length, period) of the runs of each sequence of numbers from 0, by start and period."""
    none = np.zeros((0, 3), np.int64)
    found = [none] * len(sequences)
    lengths = np.array([len(s) for s in sequences], np.int64)
    order = np.argsort(-lengths, kind="stable")
    line, starts = joined([sequences[k] for k in order])
    lengths = lengths[order]
    i, period = agreeing(line, starts[:-1] + lengths, lengths)
    keep = few_compared(line, i, period)
    i, period = i[keep], period[keep]
    owner = np.searchsorted(starts, i, side="right") - 1
    keep = (owner >= 0) & (i + period < starts[owner] + lengths[np.minimum(owner, len(lengths) - 1)]) if len(i) else keep[:0]
    i, period, owner = i[keep], period[keep], owner[keep]
    if not len(i):
        return found
    chosen, index = np.unique(owner, return_inverse=True)
    part, begins = joined([sequences[order[k]] for k in chosen])
    at = i - starts[owner] + begins[index]
    size = len(part)
    ahead = Extensions(part).agree(at, at + period)
    behind = Extensions(part[::-1]).agree(size - at, size - at - period)
    length = period + ahead + behind
    keep = np.flatnonzero(length >= np.maximum(LEAST_TIMES * period, LEAST_WORDS))
    start, length, period, index = (at - behind)[keep], length[keep], period[keep], index[keep]
    by = np.lexsort((period, length, start))
    start, length, period, index = start[by], length[by], period[by], index[by]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period, index = start[first], length[first], period[first], index[first]
    rows = np.column_stack([start - begins[index], length, period])
    rows = rows[np.lexsort((period, start))]
    cuts = np.searchsorted(index, np.arange(len(chosen) + 1))
    for k, own in enumerate(chosen):
        found[order[own]] = rows[cuts[k] : cuts[k + 1]]
    return found


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers, equal words alike."""
    numbers = dict.fromkeys(words)
    for k, word in enumerate(numbers):
        numbers[word] = k
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by a space, of each run only the first period and what no run holds."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RUNS_SQL = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(documents: DataFrame) -> DataFrame:
    """doc_id, ``runs`` (start, length, period in words) and ``collapsed``, the text without repetitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                texts = part.column(1).fill_null("").cast(pa.large_string()).cast(pa.large_binary()).to_pylist()
                words = [text.split() for text in texts]
                found = sequence_runs([numbered(w) for w in words])
                plain = [collapsed(w, runs) for w, runs in zip(words, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), listed(found), pa.array(plain, pa.large_binary()).cast(pa.large_string()).cast(pa.string())],
                    names=["doc_id", "runs", "collapsed"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, runs {RUNS_SQL}, collapsed string")


def listed(found: list[np.ndarray]) -> pa.Array:
    rows = np.concatenate(found)
    offsets = np.cumsum([0] + [len(runs) for runs in found])
    fields = [pa.array(rows[:, k]) for k in range(3)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(RUNS.value_type)))


# --- the query's own texts and digests -----------------------------------------


def with_repeats(documents: DataFrame) -> DataFrame:
    """doc_id and text, every tenth text by its id's hash repeating some of its words to its end."""
    hashed = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8"))
    g = F.floor(hashed / 10)
    words = F.filter(F.split("text", r"[ \t-\r]+"), lambda w: w != "")
    n = F.size(words)
    first = (g % n).cast("int")
    period = (1 + F.floor((n - first) / (3 + g % 8))).cast("int")
    times = F.ceil((n - first) / period).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(F.slice(words, first + 1, period), times)), F.lit(1), n - first)
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), first), repeated), " ")
    chosen = (remainder(F.col("doc_id"), 10) == 0) & (F.regexp_instr("text", F.lit(r"[^ \t-\r]")) > 0)
    return documents.select("doc_id", F.when(chosen, changed).otherwise(F.col("text")).alias("text"))


def strongest(runs: Column) -> Column:
    """The run with most periods; of several the first, then that of the smaller period."""

    def order(a: Column, b: Column) -> Column:
        sides = [(b["length"] * a["period"], a["length"] * b["period"]), (a["start"], b["start"]), (a["period"], b["period"])]
        chain = F.lit(0)
        for left, right in reversed(sides):
            chain = F.when(left < right, -1).when(left > right, 1).otherwise(chain)
        return chain

    return F.get(F.array_sort(runs, order), F.lit(0))


def run_digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run, and hashes of all runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = periodic_runs(documents).withColumn("best", strongest(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
