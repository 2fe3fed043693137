"""Best-fit packing of documents into fixed-length sequences by a grouping genetic algorithm.

A document is its token ids and the end id.  One longer than ``CAPACITY`` is cut
into full pieces, of which only the first may be shorter.  Full pieces are
sequences of their own; all others are packed.

Pieces are dealt by hash into cells of about ``CELL`` pieces.  Each cell is
evolved on ``ISLANDS`` islands, which are rows of their own and so run in
different tasks.  A chromosome is a list of bins.  Crossover injects whole
well-filled bins of one parent into the other, removes the bins that hold the
same pieces, and puts displaced pieces back by best fit, largest first; mutation
empties the worst bins.  After an epoch the elite of each island moves on to the
next island of its cell.  The best chromosome of a cell wins; its bins that are
filled well stay, the pieces of the others are dealt into new cells, with those of other
cells, for the next of ``LEVELS`` levels.  No task holds more than a cell, and
nothing but counts goes to the driver.

Defined results: a null or empty text is the end id alone.  Repeated rows and
repeated ids are packed as often as they occur.  An empty table gives no rows.
The text of a special token is read as the tokenizer's file says.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.common import saved, slices
from tidewatt.llm.tokens import Encoder

CAPACITY = 1024
END = 2
CELL = 1500
ISLANDS, EPOCHS, LEVELS = 2, 2, 3
POPULATION, GENERATIONS, OFFSPRING, ELITE = 4, 3, 4, 1
FULL_ENOUGH = CAPACITY - 2
TOKENIZER = "byte_bpe_50k.json"
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(documents: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(public_tokenizers.path(tokenizer))
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encoder.ids(text or ""), END).astype("<u4")
                short = len(ids) % capacity
                edges = [0] * (short > 0) + list(range(short, len(ids) + 1, capacity))
                for k, (start, end) in enumerate(zip(edges, edges[1:], strict=False)):
                    rows.append((doc_id, k, start, end - start, zlib.crc32(ids[start:end].tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(
                    zip(*rows, strict=True) if rows else [[]] * 5,
                    [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()], strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, PIECES)


class Bins:
    """Open bins by free space, with the best fit found through a bit mask."""

    def __init__(self, lengths: list[int], capacity: int) -> None:
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def add(self, items: list[int]) -> None:
        lengths = self.lengths
        free = self.capacity - sum([lengths[i] for i in items])
        self.free[free].append(len(self.bins))
        self.mask |= 1 << free
        self.bins.append(items)

    def put(self, item: int) -> None:
        """The item into the fullest bin that has room for it, or into a new one."""
        length = self.lengths[item]
        fits = self.mask >> length
        if not fits:
            self.add([item])
            return
        free = (fits & -fits).bit_length() - 1 + length
        at = self.free[free].pop()
        if not self.free[free]:
            self.mask &= ~(1 << free)
        self.bins[at].append(item)
        left = free - length
        self.free[left].append(at)
        self.mask |= 1 << left


def best_fit(lengths: list[int], capacity: int, kept: list[list[int]], loose: list[int]) -> list[list[int]]:
    """The kept bins, copied, with the loose items put in one by one."""
    bins = Bins(lengths, capacity)
    for items in kept:
        bins.add(items.copy())
    for item in loose:
        bins.put(item)
    return bins.bins


class Island:
    """A population of packings of the same items."""

    def __init__(self, lengths: list[int], capacity: int, seed: int) -> None:
        self.lengths, self.capacity = lengths, capacity
        self.random = random.Random(seed)
        self.order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
        self.rank = {item: k for k, item in enumerate(self.order)}

    def fill(self, items: list[int]) -> int:
        lengths = self.lengths
        return sum([lengths[i] for i in items])

    def fitness(self, bins: list[list[int]]) -> float:
        """Mean squared fill: fewer bins, and full ones beside empty ones, are better."""
        return sum([self.fill(b) ** 2 for b in bins]) / max(1, len(bins))

    def first(self) -> list[list[list[int]]]:
        """Best fit decreasing, and the same with lengths blurred."""
        found = [best_fit(self.lengths, self.capacity, [], self.order)]
        for _ in range(POPULATION - 1):
            blurred = sorted(self.order, key=lambda i: -self.lengths[i] * self.random.uniform(0.97, 1.03))
            found.append(best_fit(self.lengths, self.capacity, [], blurred))
        return found

    def cross(self, giver: list[list[int]], taker: list[list[int]]) -> list[list[int]]:
        fills = [self.fill(b) for b in giver]
        cut = sorted(fills)[len(fills) // 2]
        given = [b for b, f in zip(giver, fills, strict=True) if f >= cut and self.random.random() < 0.6]
        inside = {i for b in given for i in b}
        kept, loose = [], []
        for b in taker:
            if inside.isdisjoint(b):
                kept.append(b)
            else:
                loose += [i for i in b if i not in inside]
        worst = sorted(range(len(kept)), key=lambda k: self.fill(kept[k]))[: max(1, len(kept) // 20)]
        for k in worst:  # mutation
            loose += kept[k]
        dropped = set(worst)
        kept = [b for k, b in enumerate(kept) if k not in dropped]
        loose.sort(key=self.rank.__getitem__)
        return best_fit(self.lengths, self.capacity, given + kept, loose)

    def evolve(self, population: list[list[list[int]]]) -> list[list[list[int]]]:
        """The fittest after some generations, the best one first."""
        ranked = sorted(population, key=self.fitness, reverse=True)[:POPULATION]
        least = -(-sum(self.lengths) // self.capacity)
        for _ in range(GENERATIONS):
            if len(ranked[0]) <= least:
                break
            young = []
            for _ in range(OFFSPRING):
                one, two = self.random.randrange(len(ranked)), self.random.randrange(len(ranked))
                young.append(self.cross(ranked[min(one, two)], ranked[max(one, two)]))
            ranked = sorted(ranked + young, key=self.fitness, reverse=True)[:POPULATION]
        return ranked


STATE = "cell bigint, island int, rows array<bigint>, lengths array<int>, population array<array<int>>"


def numbered(bins: list[list[int]], size: int) -> np.ndarray:
    """The bin number of every item."""
    out = np.empty(size, np.int32)
    for number, items in enumerate(bins):
        out[items] = number
    return out


def listed(numbers: np.ndarray) -> list[list[int]]:
    """Items of every bin."""
    order = np.argsort(numbers, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(numbers[order])) + 1)]


def evolve_epoch(state: DataFrame, epoch: int, capacity: int) -> DataFrame:
    """Every island of every cell evolved; its population then has the fittest first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                lengths = [int(x) for x in row.lengths]
                island = Island(lengths, capacity, hash((int(row.cell), int(row.island), epoch)))
                came = [listed(np.asarray(x, np.int32)) for x in row.population]
                found = island.evolve(came or island.first())
                yield pd.DataFrame({
                    "cell": [row.cell], "island": [row.island], "rows": [row.rows], "lengths": [row.lengths],
                    "population": [[numbered(x, len(lengths)) for x in found]],
                })

    return state.mapInPandas(run, STATE)


def migrated(state: DataFrame) -> DataFrame:
    """Each island's population with the elite of the island before it."""
    home = state.withColumn("own", F.lit(True))
    gone = state.select(
        "cell", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"), "rows", "lengths",
        F.slice("population", 1, ELITE).alias("population"), F.lit(False).alias("own"),
    )
    together = home.unionByName(gone).groupBy("cell", "island").agg(
        F.first("rows").alias("rows"), F.first("lengths").alias("lengths"),
        F.max_by("population", "own").alias("population"), F.min_by("population", "own").alias("elite"),
    )  # two rows for each island
    return together.select("cell", "island", "rows", "lengths", F.concat("population", "elite").alias("population"))


def packed_cells(items: DataFrame, n: int, level: int, capacity: int) -> DataFrame:
    """row, length, cell, bin, filled, offset of every item after one level."""
    cells = max(1, -(-n // CELL))
    dealt = items.withColumn("cell", F.pmod(F.xxhash64(F.lit(level), "row"), F.lit(cells)))
    # Items in the order of their ids, so that a cell is the same whatever task deals it.
    lists = dealt.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("row", "length"))).alias("x"))
    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    state = lists.select(
        "cell", islands, F.col("x.row").alias("rows"), F.col("x.length").cast("array<int>").alias("lengths"),
        F.array().cast("array<array<int>>").alias("population"),
    ).repartition("cell", "island")
    for epoch in range(EPOCHS):
        state = evolve_epoch(state if epoch == 0 else migrated(saved(state, "op3-islands")), epoch, capacity)
    best = saved(state.withColumn("population", F.slice("population", 1, 1)), "op3-best")

    def winners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                numbers, lengths = np.asarray(row.numbers), np.asarray(row.lengths, np.int64)
                order = np.argsort(numbers, kind="stable")
                ends = np.cumsum(lengths[order])
                new = np.r_[True, np.diff(numbers[order]) > 0]
                before = np.maximum.accumulate(np.where(new, ends - lengths[order], 0))
                filled = np.bincount(numbers, lengths).astype(np.int64)
                yield pd.DataFrame({
                    "row": np.asarray(row.rows)[order], "length": lengths[order], "cell": row.cell,
                    "bin": numbers[order].astype(np.int64), "filled": filled[numbers[order]],
                    "offset": ends - lengths[order] - before,
                })

    bins = F.array_max(F.element_at("population", 1))
    chosen = best.groupBy("cell").agg(
        F.min_by(F.struct("rows", "lengths", F.element_at("population", 1).alias("numbers")), F.struct(bins, "island")).alias("x")
    ).select("cell", "x.*")  # one row for each island
    schema = "row bigint, length bigint, cell bigint, bin bigint, filled bigint, offset bigint"
    return chosen.mapInPandas(winners, schema)


def packed(documents: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    every = saved(
        pieces(documents, tokenizer, capacity).withColumn("row", F.monotonically_increasing_id()), "op3-pieces"
    )
    places = every.filter(F.col("length") == capacity).select(
        "row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    items = every.filter(F.col("length") < capacity).select("row", "length")
    first_cell = 0
    for level in range(LEVELS):
        n = items.count()
        if not n:
            break
        done = saved(packed_cells(items, n, level, capacity), "op3-level")
        last = level == LEVELS - 1 or n <= CELL
        final = F.lit(True) if last else F.col("filled") >= capacity - (CAPACITY - FULL_ENOUGH)
        number = (F.col("cell") + first_cell) * (1 << 24) + F.col("bin")
        places = places.unionByName(done.filter(final).select("row", number.alias("sequence_id"), "offset"))
        items = done.filter(~final).select("row", "length")
        first_cell += max(1, -(-n // CELL))
    return every.join(places, "row").drop("row")
