"""Shards of near equal bytes by k-d tree partitioning.

The root holds all rows and all shards.  A node with k shards is cut at the
weighted median of its widest dimension (range within the node over range of all
rows): rows with k // 2 of its k parts of the bytes go left.  Rows are ordered by
the dimension and, within one value, by a hash of the row, so one value that many
rows share (a hot source) is cut as well.  A cut is found by histograms: each pass
sums the bytes of ``BINS`` intervals per node and keeps the one that holds the cut,
until an edge is within ``TOLERANCE`` of a shard.  The driver sees only those sums:
shards x bins, whatever the input.

Defined results: a null text has no bytes and counts as empty; a null id or
metadata value counts as 0 when rows are placed; rows stay as many as they are, repeated
ones too (equal rows stay next to each other); an empty table gives no rows.  A
row larger than a shard's share makes its shard larger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.llm.common import saved

SHARDS = 40
ROW_BYTES = 16
BINS = 2048
TOLERANCE = 0.002
STEPS = 1 << 30
ROWS_PER_RUN = 1000
DIMENSIONS = ("doc_id", "size", "lang", "source")


def metadata(documents: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """doc_id, size, text_crc32, a tie breaker, and the dimensions d0, d1, ... as whole numbers."""
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    base = documents.withColumns({
        "size": F.octet_length(body).cast("bigint") + ROW_BYTES, "text_crc32": F.crc32(body),
    })
    numbers = []
    for k, name in enumerate(dimensions):
        text = isinstance(base.schema[name].dataType, type(base.schema["text"].dataType))
        value = F.crc32(F.encode(name, "UTF-8")) if text else F.col(name).cast("bigint")
        numbers.append(F.coalesce(value, F.lit(0)).alias(f"d{k}"))
    numbered = saved(
        base.select("doc_id", "size", "text_crc32", F.monotonically_increasing_id().alias("row"), *numbers), "op6-rows")
    # Of the row's number too, so that equal rows are told apart.
    tie = F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32", "size", "row"), 34).alias("tie")
    return numbered.withColumn("tie", tie).drop("row")


def per_node(rows: DataFrame, values: list[tuple], schema: str) -> DataFrame:
    """The rows with the values of their node; there are at most as many nodes as shards."""
    names = ["node", *(x.split()[0] for x in schema.split(", "))]
    kinds = ["int", *(x.split()[1] for x in schema.split(", "))]
    lines = ", ".join("(" + ", ".join(map(str, line)) + ")" for line in values)
    of_nodes = rows.sparkSession.sql(f"SELECT * FROM VALUES {lines} AS of_nodes ({', '.join(names)})")
    of_nodes = of_nodes.select(*[F.col(n).cast(k) for n, k in zip(names, kinds, strict=True)])
    return rows.join(F.broadcast(of_nodes), "node")


def split_level(rows: DataFrame, names: list[str], shards: dict[int, int], whole: dict[str, int]) -> DataFrame | None:
    """Every node with more than one shard cut in two; ``shards`` (by a node's first shard) follows.

    None when nothing is left to cut.
    """
    limits = [f(n).alias(f"{f.__name__}_{n}") for n in names for f in (F.min, F.max)]
    found = {r.node: r for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *limits).collect()}
    if not whole and found:
        whole |= {n: max(1, found[0][f"max_{n}"] - found[0][f"min_{n}"]) for n in names}
    specs, totals = [], {}
    for node, stats in found.items():
        span = [stats[f"max_{n}"] - stats[f"min_{n}"] for n in names]
        widest = max(range(len(names)), key=lambda k: span[k] / whole[names[k]])
        specs.append((node, widest + 1, stats[f"min_{names[widest]}"], span[widest] // STEPS + 1))
        totals[node] = stats.bytes
    if not any(shards[node] > 1 for node in found):
        return None
    value = F.element_at(F.array(*names), F.col("widest"))
    keyed = per_node(rows, specs, "widest int, least bigint, step bigint").withColumn(
        "key", F.floor((value - F.col("least")) / F.col("step")) * STEPS + F.col("tie")
    )
    cuts = find_cuts(keyed, {k: v for k, v in totals.items() if shards[k] > 1}, shards)
    moves = [(node, 0, node) for node in found if node not in cuts]
    for node, cut in cuts.items():
        half = shards[node] // 2
        shards[node + half] = shards[node] - half
        shards[node] = half
        moves.append((node, cut, node + half))
    moved = per_node(keyed, moves, "cut bigint, upper int")
    return moved.withColumn("node", F.when(F.col("key") < F.col("cut"), F.col("node")).otherwise(F.col("upper")))


def find_cuts(keyed: DataFrame, totals: dict[int, int], shards: dict[int, int]) -> dict[int, int]:
    """The key of each node below which the left part of its bytes lies."""
    cuts: dict[int, int] = {}
    state = {k: (0, (STEPS + 1) * STEPS, 0) for k in totals}  # from, to, bytes before
    while state:
        width = {k: max(1, -(-(high - low) // BINS)) for k, (low, high, _) in state.items()}
        values = [(k, low, high, width[k]) for k, (low, high, _) in state.items()]
        inside = per_node(keyed.select("node", "key", "size"), values, "low bigint, high bigint, width bigint").filter(
            "key >= low AND key < high"
        )
        counted = inside.groupBy("node", F.expr("CAST((key - low) div width AS INT)").alias("bin"))
        sums: dict[int, dict[int, int]] = {k: {} for k in state}
        for row in counted.agg(F.sum("size").alias("bytes")).collect():
            sums[row.node][row.bin] = row.bytes
        for k, (low, high, before) in list(state.items()):
            target = totals[k] * (shards[k] // 2) / shards[k]
            for number in sorted(sums[k]):
                if before + sums[k][number] >= target:
                    break
                before += sums[k][number]
            left = low + number * width[k]
            right = min(left + width[k], high)
            under, over = target - before, before + sums[k][number] - target
            if min(under, over) <= TOLERANCE * totals[k] / shards[k] or width[k] == 1:
                cuts[k] = left if under < over else right
                del state[k]
            else:
                state[k] = (left, right, before)
    return cuts


def placed_rows(rows: DataFrame, dimensions: int, shards: int) -> DataFrame:
    """The rows with ``shard``; each level of the tree is a saved table."""
    names = [f"d{k}" for k in range(dimensions)]
    of_node, whole, columns = {0: shards}, {}, rows.columns
    now = saved(rows.withColumn("node", F.lit(0)), "op6-level")
    while (cut := split_level(now, names, of_node, whole)) is not None:
        now = saved(cut.select(*columns, "node"), "op6-level")
    return now.withColumnRenamed("node", "shard")


def slots(rows: DataFrame, run_rows: int = ROWS_PER_RUN) -> DataFrame:
    """Rows with their place in the shard, from 0, counted run by run.

    A shard's rows are dealt into runs of about ``run_rows``; runs are numbered by
    themselves and begin where the counts of the runs before them end.
    """
    n, shards = rows.agg(F.count("*"), F.count_distinct("shard")).first()
    runs = max(1, n // (max(1, shards) * run_rows))
    dealt = rows.withColumn("run", F.pmod(F.xxhash64(*rows.columns), F.lit(runs)))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("shard", "run").agg(F.count("*").alias("n"))
    starts = counts.select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    order = Window.partitionBy("shard", "run").orderBy("doc_id", "text_crc32", "size")
    numbered = dealt.withColumn("slot", F.row_number().over(order).cast("bigint") - 1)
    joined = numbered.join(starts, ["shard", "run"])
    return joined.withColumn("slot", F.col("slot") + F.col("start")).drop("run", "start")


def kd_shards(
    documents: DataFrame, shards: int = SHARDS, dimensions: tuple[str, ...] = DIMENSIONS
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    placed = placed_rows(metadata(documents, dimensions), len(dimensions), shards)
    return slots(placed).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
