"""Near-duplicate documents by min-max hashing.

A document's set holds the hashes of its distinct shingles (``SIZE`` consecutive
words, lower-cased A-Z; fewer words make one shingle).  Each permutation of the
64-bit values gives two signature entries, the smallest and the largest value,
so ``PERMUTATIONS`` hash evaluations per shingle give twice as many entries.
``ROWS`` entries form a band; sets with an equal band are candidates.  Two sets
with similarity 0.8 miss each other in all bands with probability 3e-6.

Documents with equal sets are one class, found by an aggregate.  Candidate pairs
of classes are confirmed on their full sets.  Every member of a bucket is compared
with the bucket's pivot, the member with most companions in all its buckets; two
members linked to one pivot are in one component already.  A comparison leaves
what a set lacks and has beside the pivot's, and from the differences of two
members the similarity of their full sets follows.  The members of such a bucket are
dealt into blocks of bounded size; a task takes two blocks, counts what the differences
share for all pairs whose sizes and distances to the pivot allow a link at all
(Jaccard distance is a metric), and returns a forest of the labels that links join, never
pairs.  So components are those that all pairs within buckets would give, rows stay in
proportion to the members, and only a bucket of many blocks meets itself more than once.

Defined results: a null or empty text, or one of white space only, has an empty
set, links with nothing and is kept.  A null id links with nothing and is kept.
Rows that share an id are documents of their own: each is placed, and kept or removed,
by its own text, and equal rows stay as many rows.  Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.common import chunks, hashed_words, id_set, mix, one_thread, saved, shingles, slices
from tidewatt.llm.components import components

SIZE = 5
PERCENT = 80
PERMUTATIONS, BANDS, ROWS = 80, 32, 5
BLOCK_COST, MEMBER_COST = 1 << 18, 512  # of a block, in hashes; about 500 members at most
FEW_TIMES, COLUMNS = 16, 1024
SIGNATURE = "doc_id bigint, version bigint, n_shingles bigint, s1 bigint, s2 bigint, bands array<bigint>"


def multipliers(count: int) -> np.ndarray:
    """Odd numbers; multiplying by one of them permutes the 64-bit values."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def distinct_shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted by row and hash, and their rows."""
    values, rows = shingles(hashed_words(texts), size)
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[new], rows[new]


def min_max(values: np.ndarray, starts: np.ndarray, permutations: int) -> np.ndarray:
    """One row of smallest and largest values per permutation for each run of ``values``."""
    out = np.empty((2 * permutations, len(starts)), np.uint64)
    for k, a in enumerate(multipliers(permutations)):
        moved = values * a
        np.minimum.reduceat(moved, starts, out=out[2 * k])
        np.maximum.reduceat(moved, starts, out=out[2 * k + 1])
    return out


def bands_of(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash per band; entries of a band come from different permutations."""
    lanes = np.concatenate([signature[0::2], signature[1::2]])
    out = np.empty((bands, signature.shape[1]), np.uint64)
    for band in range(bands):
        key = np.full(signature.shape[1], np.uint64(band + 1), np.uint64)
        for lane in lanes[band * rows : (band + 1) * rows]:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + lane)
        out[band] = key
    return out


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def versions(documents: DataFrame) -> DataFrame:
    """doc_id, text, and a hash of the text that tells texts of one id apart."""
    return documents.select("doc_id", "text", F.xxhash64("text").alias("version"))


def signatures(documents: DataFrame, size: int = SIZE) -> DataFrame:
    """Set size, two hashes of the whole set, and band keys of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                yield sign(part)

    def sign(part: pa.RecordBatch) -> pa.RecordBatch:
        values, rows = distinct_shingles(part.column(1), size)
        n = np.bincount(rows, minlength=part.num_rows)
        full = np.flatnonzero(n)
        starts = (np.cumsum(n) - n)[full]
        sums = np.zeros((2, part.num_rows), np.uint64)
        keys = np.zeros((len(full), 0), np.uint64)
        if len(full):
            spread = mix(values)
            for k in range(2):
                sums[k, full] = np.add.reduceat(spread, starts)
                spread = mix(spread + np.uint64(k + 1))
            keys = bands_of(min_max(mix(values), starts, PERMUTATIONS), BANDS, ROWS).T
        ends = np.zeros(part.num_rows + 1, np.int32)
        ends[1:] = np.cumsum(np.where(n > 0, BANDS, 0))
        lists = pa.ListArray.from_arrays(pa.array(ends), signed(keys.reshape(-1)))
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(2), pa.array(n.astype(np.int64)), signed(sums[0]), signed(sums[1]), lists],
            names=["doc_id", "version", "n_shingles", "s1", "s2", "bands"],
        )

    return versions(documents).mapInArrow(run, SIGNATURE)


def packed_texts(texts: DataFrame) -> DataFrame:
    """rep and the compressed text, which is what gets shuffled; no text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor().compress
        for batch in slices(batches):
            packed = [None if t is None else pack(t.encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["rep", "packed"])

    return texts.select("rep", "text").mapInArrow(run, "rep bigint, packed binary")


def compared(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """``pairs`` (u, v) with the distance d of their full sets, whether they are linked,
    and the shingles of v that u lacks (gone) and those it has beside v's (more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for part in slices(batches, 64):
            yield compare(part, unpack)

    def compare(part: pa.RecordBatch, unpack) -> pa.RecordBatch:
        sides = [pa.array([unpack(x).decode() for x in part.column(k).to_pylist()], pa.string()) for k in (2, 3)]
        (one, one_row), (two, two_row) = (distinct_shingles(side, size) for side in sides)
        values, rows = np.concatenate([one, two]), np.concatenate([one_row, two_row])
        from_v = np.repeat([False, True], [len(one), len(two)])
        order = np.lexsort((values, rows))
        values, rows, from_v = values[order], rows[order], from_v[order]
        same = (values[1:] == values[:-1]) & (rows[1:] == rows[:-1])
        alone = ~(np.append(same, False) | np.append(False, same))
        shared = np.bincount(rows[1:][same], minlength=part.num_rows)
        union = np.bincount(rows, minlength=part.num_rows) - shared
        linked = (100 * shared >= percent * union) & (union > 0)

        def lists(chosen: np.ndarray) -> pa.Array:
            ends = np.append(0, np.cumsum(np.bincount(rows[chosen], minlength=part.num_rows))).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), signed(values[chosen]))

        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(1 - shared / np.maximum(union, 1)), pa.array(linked),
             lists(alone & from_v), lists(alone & ~from_v)],
            names=["u", "v", "d", "linked", "gone", "more"])

    left = texts.select(F.col("rep").alias("u"), F.col("packed").alias("left_text"))
    right = texts.select(F.col("rep").alias("v"), F.col("packed").alias("right_text"))
    both = pairs.join(left, "u").join(right, "v").select("u", "v", "left_text", "right_text")
    return both.mapInArrow(run, "u bigint, v bigint, d double, linked boolean, gone array<bigint>, more array<bigint>")


def near_duplicates(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) and kept, for every row."""
    return placed(documents, size, percent).drop("version")


def placed(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """The same with ``version``; classes bear saved numbers, and the smallest id of a component names it."""
    base = saved(signatures(documents, size), "op5-signatures")
    filled = base.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = filled.groupBy("s1", "s2", "n_shingles").agg(
        F.min(F.struct("doc_id", "version")).alias("first"), F.min_by("bands", "doc_id").alias("bands")
    )
    classes = saved(
        classes.select("s1", "s2", "n_shingles", "first.*", "bands", F.monotonically_increasing_id().alias("rep")), "op5-classes")
    members = saved(bucket_members(classes), "op5-members")
    firsts = classes.select("rep", "doc_id", "version").join(members.select("rep").distinct(), "rep", "left_semi")
    firsts = saved(firsts, "op5-candidates")
    chosen = versions(documents).join(id_set(firsts), ["doc_id", "version"])
    texts = saved(packed_texts(chosen).dropDuplicates(["rep"]), "op5-texts")
    links = links_of(members, texts, size, percent)
    labels = components(links).select(F.col("node").alias("rep"), "label")
    labels = saved(labels.join(classes.select("rep", "doc_id"), "rep"), "op5-labels")
    names = labels.groupBy("label").agg(F.min("doc_id").alias("name"))
    of_class = classes.drop("bands").join(labels.drop("doc_id").join(names, "label"), "rep", "left").select(
        "s1", "s2", "n_shingles", F.coalesce("name", "doc_id").alias("component_id")
    )
    joined = base.drop("bands").join(of_class, ["s1", "s2", "n_shingles"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
    component = F.coalesce(component, F.col("doc_id"))
    return joined.select(
        "doc_id", "version", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def bucket_members(classes: DataFrame) -> DataFrame:
    """key, rep, n (set size), degree (companions over all buckets) for buckets of two and more."""
    spread = classes.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    shared = spread.groupBy("key").agg((F.count("*") - 1).alias("others")).filter("others > 0")
    together = spread.join(shared, "key")
    degrees = together.groupBy("rep").agg(F.sum("others").alias("degree"))
    return together.drop("others").join(degrees, "rep")


def links_of(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (u, v) of one component each, which give the components that all pairs within buckets would give."""
    best = F.max_by(F.struct("rep", "n"), F.struct("degree", -F.col("rep")))
    pivots = members.groupBy("key").agg(best.alias("p")).select("key", F.col("p.rep").alias("pivot"), F.col("p.n").alias("p_n"))
    first = saved(members.join(pivots, "key").drop("degree").filter("rep != pivot"), "op5-first")
    pairs = first.select(F.col("rep").alias("u"), F.col("pivot").alias("v")).distinct()
    one = saved(compared(pairs, texts, size, percent), "op5-compared")

    result = one.select(F.col("u").alias("rep"), F.col("v").alias("pivot"), "d", "linked")
    known = first.join(result, ["rep", "pivot"])
    # Two with one label are linked to one pivot; a label is not the component's name yet.
    labels = one.filter("linked").groupBy(F.col("u").alias("rep")).agg(F.min("v").alias("label"))
    open_keys = known.groupBy("key").agg(F.bool_and("linked").alias("all"), F.count("*").alias("m")).filter("NOT all AND m > 1")
    rest = known.join(open_keys.select("key"), "key").join(labels, "rep", "left")
    sets = one.select(F.col("u").alias("rep"), F.col("v").alias("pivot"), "gone", "more")
    rest = saved(rest.withColumn("label", F.coalesce("label", "rep")).join(sets, ["rep", "pivot"]), "op5-rest")
    return one.filter("linked").select("u", "v").unionByName(label_links(rest, percent))


def label_links(rest: DataFrame, percent: int) -> DataFrame:
    """(u, v): labels that links between members of a bucket join, as forests of two blocks each."""
    member = F.struct("rep", "n", "label", "d", "gone", "more")
    cost = F.lit(MEMBER_COST) + F.size("gone") + F.size("more")
    parts = rest.groupBy("key").agg(F.ceil(F.sum(cost) / BLOCK_COST).alias("parts"))
    dealt = rest.join(parts, "key").withColumn("part", F.pmod(F.xxhash64("rep"), "parts"))
    blocks = saved(dealt.groupBy("key", "part").agg(
        F.first("parts").alias("parts"), F.first("p_n").alias("p_n"), F.collect_list(member).alias("members")), "op5-blocks")
    several = blocks.filter("parts > 1")
    left = several.select("key", F.explode(F.sequence(F.col("part") + 1, F.col("parts"))).alias("part"), "p_n", "members")
    right = several.select("key", "part", F.col("members").alias("others"))
    apart = left.join(right, ["key", "part"])
    kind = blocks.schema["members"].dataType
    alone = blocks.select("p_n", "members", F.lit(None).cast(kind).alias("others"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        for batch in batches:
            found = [np.zeros((2, 0), np.int64)]
            for row in range(batch.num_rows):
                sides = [batch.column(k)[row].values for k in (1, 2) if batch.column(k)[row].is_valid]
                found.append(forest(batch.column(0)[row].as_py(), [Members(side) for side in sides], percent))
            u, v = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    pairs = alone.unionByName(apart.select("p_n", "members", "others"))
    return pairs.mapInArrow(run, "u bigint, v bigint").distinct()


class Members:
    """Members of a block, and their differences from the pivot's set: hashes, and the member of each."""

    def __init__(self, rows: pa.StructArray) -> None:
        self.n, self.label, self.d = (rows.field(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
        lists = [rows.field(k) for k in (4, 5)]
        sizes = [np.diff(x.offsets.to_numpy()) for x in lists]
        self.gone = sizes[0].astype(np.int64)
        self.values = np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in lists])
        self.rows = np.concatenate([np.repeat(np.arange(len(rows)), x) for x in sizes])


def forest(p_n: int, sides: list[Members], percent: int) -> np.ndarray:
    """Labels, and the smaller ones that links of one block's members, or of two blocks' members, join them to."""
    one, two = sides[0], sides[-1]
    fit = one.label[:, None] != two.label
    fit &= 100 * np.minimum(one.n[:, None], two.n) >= percent * np.maximum(one.n[:, None], two.n)
    fit &= np.abs(one.d[:, None] - two.d) <= 1 - percent / 100 + 1e-9
    if one is two:
        fit = np.triu(fit)
    a, b = np.nonzero(fit)
    if not len(a):
        return np.zeros((2, 0), np.int64)
    shared = common(sides)[a, b] + p_n - one.gone[a] - two.gone[b]
    linked = (100 + percent) * shared >= percent * (one.n[a] + two.n[b])
    names, ends = np.unique(np.concatenate([one.label[a[linked]], two.label[b[linked]]]), return_inverse=True)
    u, v = ends.reshape(2, -1)
    root = np.arange(len(names))
    while len(u):
        low, high = np.minimum(root[u], root[v]), np.maximum(root[u], root[v])
        np.minimum.at(root, high, low)
        while not np.array_equal(jumped := root[root], root):
            root = jumped
        apart = root[u] != root[v]
        u, v = u[apart], v[apart]
    moved = np.flatnonzero(root != np.arange(len(names)))
    return np.stack([names[moved], names[root[moved]]])


def common(sides: list[Members]) -> np.ndarray:
    """How many hashes each member of the first block shares with each of the last."""
    one, two = sides[0], sides[-1]
    shift = 0 if one is two else len(one.n)
    total = shift + len(two.n)
    values = np.concatenate([x.values for x in sides])
    rows = np.concatenate([one.rows, two.rows + shift] if shift else [one.rows])
    order = np.argsort(values, kind="stable")
    values, rows = values[order], rows[order]
    starts = np.flatnonzero(np.diff(values, prepend=values[:1] - 1)) if len(values) else np.zeros(0, np.int64)
    times = np.diff(starts, append=len(values))
    out = np.zeros((len(one.n), len(two.n)), np.int64)
    each = np.repeat(times, times)
    few = each <= FEW_TIMES
    some, of = rows[few], np.repeat(starts, times)[few]
    for lag in range(1, min(FEW_TIMES, len(some))):
        same = np.flatnonzero(of[lag:] == of[:-lag])
        if not len(same):
            break
        low, high = np.minimum(some[same], some[same + lag]), np.maximum(some[same], some[same + lag]) - shift
        inside = (low < len(one.n)) & (high >= 0)
        np.add.at(out, (low[inside], high[inside]), 1)
    many, column = rows[~few], np.repeat(np.cumsum(times > FEW_TIMES) - 1, times)[~few]
    edges = np.searchsorted(column, np.arange(0, column[-1] + 1 + COLUMNS, COLUMNS)) if len(column) else []
    for k, (start, end) in enumerate(zip(edges, edges[1:], strict=False)):
        held = np.zeros((total, COLUMNS), np.float32)
        held[many[start:end], column[start:end] - k * COLUMNS] = 1
        out += (held[: len(one.n)] @ held[shift:].T).astype(np.int64)
    return out


def deduplicated(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Documents without those whose component has a smaller id; of equal rows of one id, all stay.

    What goes is known by id and text, so another text of the same id stays.
    """
    removed = placed(documents, size, percent).filter("NOT kept").select("doc_id", "version").distinct()
    removed = id_set(saved(removed, "op5-removed"))
    same = (documents["doc_id"] == removed["doc_id"]) & (F.xxhash64(documents["text"]) == removed["version"])
    return documents.join(removed, same, "left_anti")
