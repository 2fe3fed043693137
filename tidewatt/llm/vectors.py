"""Near-duplicate vectors by dual traversal of cover trees; exact threshold pairs.

Vectors are scaled to length one, where a cosine of at least ``COSINE`` is a
distance of at most sqrt(2 - 2 * COSINE).  Equal vectors become one class with a
size.  The classes are dealt into blocks of about ``BLOCK``: by the nearest of a
few centres (a net of a bounded sample, which only decides who shares a block),
and by hash where a centre has more.  Each block gets a cover tree: a node's
children are a net of its points with half the radius.  Two blocks meet only if
their centres are near enough for their radii, and in the traversal two nodes go
on only if the distance of their centres is at most their covering radii plus the
threshold.  What is left at single points is compared in double precision.

A task holds two blocks.  It returns, per class, the number of vectors linked and
one link to a smaller id of the same component, never the pairs themselves.

Defined results: a vector that is null, empty, zero or holds a null or
non-finite number links with nothing.  Only vectors of equal length are compared.
Equal vectors are linked.  Every row is a vector of its own, rows that share an id
too.  Rows with a null id are linked and counted like others and connect their
neighbours, but name no component; they are themselves of the null component and kept.
Only vec_id and embedding are read, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.common import saved
from tidewatt.llm.components import components

COSINE = 0.9
BLOCK = 8192
SAMPLE = 2048
CENTRES = 256
BUCKET = 16
ROWS_AT_ONCE = 512
TOGETHER = 64
SLACK = 1e-4  # single precision prunes; it may only keep too much
TREE = (
    "block int, dim int, size int, centre array<double>, radius double, "
    "ids binary, sizes binary, points binary, nodes binary, cover binary"
)


def unit_vectors(rows: pd.Series) -> np.ndarray:
    """Double precision vectors of length one."""
    x = np.stack([np.asarray(v, np.float64) for v in rows])
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares stay within range
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def net(points: np.ndarray, radius: float) -> tuple[list[int], np.ndarray]:
    """Rows more than ``radius`` apart that cover all, the first row first; the nearest of them for each row."""
    chosen = [0]
    least = 1 - radius * radius / 2
    for start in range(1, len(points), ROWS_AT_ONCE):
        rows = np.arange(start, min(start + ROWS_AT_ONCE, len(points)))
        near = (points[rows] @ points[chosen].T).max(1) >= least
        far = rows[~near]
        own = points[far] @ points[far].T >= least
        new: list[int] = []
        for k in range(len(far)):
            if not own[k, new].any():
                new.append(k)
        chosen += far[new].tolist()
    nearest = np.concatenate([
        (points[k : k + ROWS_AT_ONCE] @ points[chosen].T).argmax(1) for k in range(0, len(points), ROWS_AT_ONCE)
    ])
    nearest[chosen] = np.arange(len(chosen))
    return chosen, nearest


def distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def cover_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes (centre, first child, end of children), children side by side, and covering radii.

    Radii halve from level to level; a node of few points has these as children.
    """
    nodes, cover = [[0, 0, 0]], [0.0]
    todo = [(0, np.arange(len(points)), 2.0)]
    while todo:
        node, members, radius = todo.pop()
        if len(members) == 1:
            continue
        cover[node] = float(distance(points[members] @ points[nodes[node][0]]).max()) + 1e-7
        if len(members) <= BUCKET or radius < 1e-3:
            groups = [members[k : k + 1] for k in range(len(members))]
        else:
            chosen, nearest = net(points[members].astype(np.float32), radius / 2)
            order = np.argsort(nearest, kind="stable")
            groups = np.split(members[order], np.flatnonzero(np.diff(nearest[order])) + 1)
            groups = [np.concatenate([[members[c]], g[g != members[c]]]) for c, g in zip(chosen, groups, strict=True)]
        nodes[node][1:] = len(nodes), len(nodes) + len(groups)
        for group in groups:
            todo.append((len(nodes), group, radius / 2))
            nodes.append([int(group[0]), 0, 0])
            cover.append(0.0)
    return np.array(nodes, np.int32), np.array(cover)


class Block:
    """One block's ids, class sizes, points and tree, as read from a row."""

    def __init__(self, row, side: str) -> None:
        def read(name: str, kind) -> np.ndarray:
            return np.frombuffer(getattr(row, f"{name}_{side}"), kind)

        self.ids, self.sizes = read("ids", np.int64), read("sizes", np.int64)
        self.points = read("points", np.float64).reshape(len(self.ids), -1)
        self.nodes, self.cover = read("nodes", np.int32).reshape(-1, 3), read("cover", np.float64)
        self.single = self.nodes[:, 1] == self.nodes[:, 2]
        self.short = self.points.astype(np.float32)

    def children(self, nodes: np.ndarray) -> np.ndarray:
        first, end = self.nodes[nodes, 1], self.nodes[nodes, 2]
        sizes = end - first
        return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Found:
    """Links of two blocks: sums per point, and a forest of smaller places."""

    def __init__(self, one: Block, two: Block, same: bool, cosine: float) -> None:
        self.one, self.two, self.same, self.cosine = one, two, same, cosine
        self.reach = float(np.sqrt(2 - 2 * cosine))
        self.count_one, self.count_two = np.zeros(len(one.ids), np.int64), np.zeros(len(two.ids), np.int64)
        self.shift = 0 if same else len(one.ids)
        self.label = np.arange(self.shift + len(two.ids))

    def visit(self, a: np.ndarray, b: np.ndarray) -> None:
        """All pairs of points below nodes ``a`` and ``b`` that are near enough."""
        one, two = self.one, self.two
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            b_points, reach = two.short[two.nodes[b, 0]], two.cover[b].astype(np.float32) + np.float32(self.reach)
            b_single, least = two.single[b], 1 - reach * reach / 2 - np.float32(SLACK)
            for start in range(0, len(a), ROWS_AT_ONCE):
                rows = a[start : start + ROWS_AT_ONCE]
                cosine = one.short[one.nodes[rows, 0]] @ b_points.T
                own = one.cover[rows].astype(np.float32)
                alive = cosine >= least
                for k in np.flatnonzero(own > 0):
                    bound = reach + own[k]
                    alive[k] = cosine[k] >= 1 - bound * bound / 2 - np.float32(SLACK)
                some = alive.any(1)
                points = some & one.single[rows]
                if points.any():
                    columns = alive[points].any(0) & b_single
                    self.compare(one.nodes[rows[points], 0], two.nodes[b[columns], 0])
                    # The points of one chunk go on together against the nodes any of them is near.
                    deeper = alive[points][:, ~b_single]
                    if deeper.any():
                        near = deeper.any(1)
                        todo.append((rows[points][near], two.children(b[~b_single][deeper.any(0)])))
                inner = np.flatnonzero(some & ~one.single[rows])
                if len(inner):
                    # Nodes of few children go on together against the nodes any of them is near.
                    first, end = one.nodes[rows[inner], 1], one.nodes[rows[inner], 2]
                    group = np.cumsum(end - first) // TOGETHER
                    for nodes in np.split(inner, np.flatnonzero(np.diff(group)) + 1):
                        mine = b[alive[nodes].any(0)]
                        leaf = two.single[mine]
                        todo.append((one.children(rows[nodes]), np.concatenate([mine[leaf], two.children(mine[~leaf])])))

    def compare(self, a: np.ndarray, b: np.ndarray) -> None:
        """Points against points, in double precision."""
        if not (len(a) and len(b)):
            return
        linked = self.one.points[a] @ self.two.points[b].T >= self.cosine
        if self.same:
            linked &= a[:, None] != b[None]
        at_a, at_b = np.nonzero(linked)
        if not len(at_a):
            return
        np.add.at(self.count_one, a[at_a], self.two.sizes[b[at_b]])
        if not self.same:
            np.add.at(self.count_two, b[at_b], self.one.sizes[a[at_a]])
        self.join(a[at_a], b[at_b] + self.shift)

    def join(self, u: np.ndarray, v: np.ndarray) -> None:
        label = self.label
        while len(u):
            one, two = label[u], label[v]
            apart = one != two
            u, v, one, two = u[apart], v[apart], one[apart], two[apart]
            np.minimum.at(label, np.maximum(one, two), np.minimum(one, two))
            while not np.array_equal(jumped := label[label], label):
                label[:] = jumped

    def rows(self) -> pd.DataFrame:
        if self.same:
            ids, counts = self.one.ids, self.count_one
        else:
            ids = np.concatenate([self.one.ids, self.two.ids])
            counts = np.concatenate([self.count_one, self.count_two])
        frame = pd.DataFrame({"rep": ids, "n": counts, "other": ids[self.label]})
        return frame[frame["n"] > 0]


def valid_classes(vectors: DataFrame) -> DataFrame:
    """x, name (the smallest id) and size: the classes of equal vectors that can link."""
    fine = "exists(embedding, x -> x <> 0) AND NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))"
    return (
        vectors.filter("embedding IS NOT NULL AND size(embedding) > 0").filter(fine)
        .select("vec_id", F.transform("embedding", lambda x: x.cast("double") + 0.0).alias("x"))
        .groupBy("x").agg(F.min("vec_id").alias("name"), F.count("*").alias("size"))
    )


def centres(classes: DataFrame, n: int, dim: int) -> np.ndarray:
    """Up to ``CENTRES`` net points of a bounded sample, one for each block's worth of classes."""
    wanted = min(CENTRES, max(1, n // BLOCK))
    sample = classes.filter(F.size("x") == dim).orderBy(F.xxhash64("x"), "rep").limit(SAMPLE).toPandas()
    points = unit_vectors(sample["x"])
    radius, chosen = 2.0, [0]
    while len(chosen) < min(wanted, len(points)) and radius > 1e-3:
        radius /= 2
        chosen, _ = net(points, radius)
    return points[chosen[:wanted]]


def blocks(classes: DataFrame, block: int) -> DataFrame:
    """One row for each block, with its tree."""
    dims = classes.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not dims:
        return classes.sparkSession.createDataFrame([], TREE)
    dim, n = dims[0].dim, dims[0]["count"]
    middle = classes.sparkSession.sparkContext.broadcast(centres(classes, n, dim))

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell = np.zeros(len(batch), np.int32)
            usual = batch["x"].map(len).to_numpy() == dim
            if usual.any():
                cell[usual] = (unit_vectors(batch["x"][usual]) @ middle.value.T).argmax(1)
            yield batch.assign(cell=cell, dim=batch["x"].map(len).astype("int32"))

    schema = "rep bigint, size bigint, x array<double>, cell int, dim int"
    celled = saved(classes.select("rep", "size", "x").mapInPandas(nearest, schema), "op8-cells")
    parts = celled.groupBy("dim", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    dealt = celled.join(parts, ["dim", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("x"), F.col("parts").cast("bigint")).cast("int")
    )

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", kind="stable")
        points = unit_vectors(rows["x"])
        middle_ = points.mean(0)
        nodes, cover = cover_tree(points)
        return pd.DataFrame({
            "block": [0], "dim": [key[0]], "size": [len(rows)], "centre": [middle_],
            "radius": [float(np.sqrt(((points - middle_) ** 2).sum(1).max()))],
            "ids": [rows["rep"].to_numpy(np.int64).tobytes()],
            "sizes": [rows["size"].to_numpy(np.int64).tobytes()], "points": [points.tobytes()],
            "nodes": [nodes.tobytes()], "cover": [cover.tobytes()],
        })

    trees = saved(dealt.groupBy("dim", "cell", "part").applyInPandas(pack, TREE), "op8-trees")
    return saved(numbered(trees), "op8-blocks")


def numbered(trees: DataFrame) -> DataFrame:
    """Blocks numbered from 0 without gaps; only their keys are sorted."""
    keys = trees.select(F.xxhash64("ids", "points").alias("key"), F.length("ids").alias("n"))
    order = keys.orderBy("key", "n").rdd.map(lambda r: r.key).zipWithIndex().toDF("key bigint, number bigint")
    return trees.drop("block").withColumn("key", F.xxhash64("ids", "points")).join(order, "key").select(
        F.col("number").cast("int").alias("block"), *[c for c in trees.columns if c != "block"]
    )


def block_pairs(summary: DataFrame, cosine: float) -> DataFrame:
    """one <= two: the pairs of blocks that may hold links."""
    n = summary.count()
    reach = float(np.sqrt(2 - 2 * cosine)) + 1e-6
    pairs = summary.withColumn("two", F.explode(F.sequence(F.col("block"), F.lit(n - 1))))
    other = summary.select(
        F.col("block").alias("two"), F.col("dim").alias("other_dim"), F.col("centre").alias("c"), F.col("radius").alias("r")
    )
    apart = F.sqrt(F.aggregate(F.zip_with("centre", "c", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    near = pairs.join(other, "two").filter("dim = other_dim").filter(apart <= F.col("radius") + F.col("r") + reach)
    return near.select(F.col("block").alias("one"), "two")


def links(trees: DataFrame, cosine: float) -> DataFrame:
    """rep, n (vectors linked), other (a class of the same component), from every pair of blocks."""
    body = ("ids", "sizes", "points", "nodes", "cover")
    pairs = block_pairs(trees.select("block", "dim", "centre", "radius"), cosine)
    left = trees.select(F.col("block").alias("one"), *[F.col(c).alias(f"{c}_a") for c in body])
    right = trees.select(F.col("block").alias("two"), *[F.col(c).alias(f"{c}_b") for c in body])
    joined = pairs.join(left, "one").join(right, "two")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                found = Found(Block(row, "a"), Block(row, "b"), row.one == row.two, cosine)
                found.visit(np.zeros(1, np.int64), np.zeros(1, np.int64))
                yield found.rows()

    return joined.mapInPandas(run, "rep bigint, n bigint, other bigint")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    classes = saved(valid_classes(vectors).withColumn("rep", F.monotonically_increasing_id()), "op8-classes")
    found = saved(links(blocks(classes, block), cosine), "op8-links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    labels = components(found.select(F.col("rep").alias("u"), F.col("other").alias("v")))
    labels = saved(labels.withColumnRenamed("node", "rep").join(classes.select("rep", "name"), "rep"), "op8-labels")
    names = labels.groupBy("label").agg(F.min("name").alias("component"))
    of_component = labels.drop("name").join(names, "label")
    of_class = (
        classes.join(counts, "rep", "left").join(of_component, "rep", "left")
        .select("x", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "name").alias("component"))
    )
    rows = vectors.select("vec_id", F.transform("embedding", lambda x: x.cast("double") + 0.0).alias("x"))
    joined = rows.join(of_class, "x", "left")
    component = F.coalesce(F.when(F.col("vec_id").isNotNull(), F.col("component")), F.col("vec_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
