"""Benchmark decontamination: benchmark n-grams found in training documents.

Words are lower-cased (A-Z) runs of digits, letters and non-ASCII characters.
A benchmark item gives every window of ``size`` consecutive words; an item with
fewer words, but not none, gives one window of all its words.

Every distinct window has a 64-bit code: the hash of its length and its first,
middle and last word.  The codes form a hash set that every task holds; a task
looks up the code of each window of a document and compares the words of those
found with the windows' own words, so that no other window counts as a hit.  The set is sent whole only up to
``MAX_BROADCAST`` windows.  A larger benchmark is joined by hash instead.

Defined results: a null or empty text has no words and no hits.  Null ids are
kept.  Every row is a document of its own, rows that share an id or are equal in all
too.  An empty benchmark hits nothing.  Other columns of the documents are carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.common import ascii_lower, saved

SIZE = 10
MAX_BROADCAST = 20_000
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
HITS = "array<struct<pos:int,len:int,gram:string>>"


def words_of(text: Column) -> Column:
    """Words of a text; null for no text.  An ASCII word takes the quick way to lower case."""
    words = F.transform(
        F.split(text, SEPARATORS),
        lambda w: F.when(F.octet_length(w) == F.length(w), F.lower(w)).otherwise(ascii_lower(w)),
    )
    return F.array_remove(words, "")


def windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """item_id, len, gram (words joined by a blank), code (hash), once per item and window."""
    words = benchmark.select(F.col("item_id"), words_of(F.col("text")).alias("w")).filter("size(w) > 0")
    spread = words.selectExpr(
        "item_id",
        f"least(size(w), {size}) AS len",
        f"""explode(transform(sequence(1, greatest(size(w) - {size - 1}, 1)),
            i -> array_join(slice(w, i, least(size(w), {size})), ' '))) AS gram""",
    )
    hashed = spread.distinct().withColumn("h", F.transform(F.split("gram", " "), lambda w: F.xxhash64(w)))
    return hashed.withColumn("code", F.expr(code("1", "len"))).drop("h")


def code(first: str, length: str) -> str:
    """SQL for the code of the window of ``length`` words of ``h`` that begins at ``first`` (from 1)."""
    places = (f"{first} - 1", f"{first} - 1 + {length} div 2", f"{first} + {length} - 2")
    picked = ", ".join(f"get(h, CAST({place} AS INT))" for place in places)
    return f"xxhash64({length}, {picked})"


def with_hits(documents: DataFrame, grams: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Documents with ``n_words`` and ``hits``: every window occurrence, first word counted from 1.

    ``grams`` has len, gram and code; one row per distinct window.
    """
    distinct = grams.select("len", "gram", "code").distinct()
    known = distinct.limit(max_broadcast + 1).collect()  # bounded by the limit
    read = words_of(F.coalesce(F.col("text"), F.lit("")))
    if len(known) > max_broadcast:
        return hits_by_join(documents, distinct, read)
    # The row is kept as one struct, so internal names cannot clash.  The words come out of a
    # generator: a later filter on the hits is not pushed below it, where they would be made anew
    # for every window.
    inner = documents.select(
        F.struct(*[documents[c] for c in documents.columns]).alias("doc"), F.explode(F.array(read)).alias("w")
    )
    inner = inner.select("doc", "w", F.explode(F.array(F.transform("w", lambda w: F.xxhash64(w)))).alias("h"))
    found = F.array().cast(HITS)
    for length in sorted({row.len for row in known}):
        of = [row for row in known if row.len == length]
        codes = ",".join(f"CAST('{c}' AS BIGINT)" for c in sorted({row.code for row in of}))
        texts = ",".join(f"'{row.gram}'" for row in of)  # words hold neither quote nor backslash
        found = F.concat(found, F.expr(f"""
            filter(transform(
                filter(if(size(h) >= {length}, sequence(1, size(h) - {length - 1}), array()),
                       i -> {code("i", str(length))} IN ({codes})),
                i -> named_struct('pos', i, 'len', {length}, 'gram', array_join(slice(w, i, {length}), ' '))),
              x -> x.gram IN ({texts}))"""))
    done = inner.select("doc", F.size("w").cast("long").alias("n_words"), found.alias("hits"))
    return done.select("doc.*", "n_words", "hits")


def hits_by_join(documents: DataFrame, grams: DataFrame, read: Column) -> DataFrame:
    """The same for a benchmark of any size: window hashes joined, then compared by their words.

    Only windows whose hash is known meet their document's words again.
    """
    base = documents.select(
        F.struct(*[documents[c] for c in documents.columns]).alias("doc"), read.alias("w")
    ).withColumn("key", F.sha2(F.to_json(F.struct("w")), 256))
    texts = base.select("key", F.transform("w", lambda w: F.xxhash64(w)).alias("h")).distinct()
    lengths = [row.len for row in grams.select("len").distinct().collect()]  # at most SIZE of them
    parts = [
        texts.select("key", F.posexplode(F.expr(
            f"if(size(h) >= {n}, transform(sequence(1, size(h) - {n - 1}), i -> {code('i', str(n))}), array())"
        )).alias("pos", "code")).withColumn("len", F.lit(n))
        for n in lengths
    ]
    spread = parts[0]
    for part in parts[1:]:
        spread = spread.unionByName(part)
    near = spread.join(grams, ["code", "len"]).select(
        "key", F.struct((F.col("pos") + 1).alias("pos"), "len", "gram").alias("hit")
    )
    lists = near.groupBy("key").agg(F.collect_list("hit").alias("near"))
    joined = base.join(lists, "key", "left").withColumn("near", F.coalesce("near", F.array().cast(HITS)))
    sure = F.expr("filter(near, x -> array_join(slice(w, x.pos, x.len), ' ') = x.gram)")
    return joined.select("doc", F.size("w").cast("long").alias("n_words"), sure.cast(HITS).alias("hits")).select(
        "doc.*", "n_words", "hits"
    )


def n_hit(hits: str = "hits") -> Column:
    """Words inside any hit."""
    inside = F.flatten(F.transform(hits, lambda x: F.sequence(x.pos, x.pos + x.len - 1)))
    return F.size(F.array_distinct(inside)).cast("long")


def item_hits(documents: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    grams = saved(windows(benchmark, size), "op1-windows")
    docs = with_hits(documents.select("doc_id", "text"), grams).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", n_hit().alias("n_hit"),
        F.array_distinct(F.transform("hits", lambda x: x.gram)).alias("found"),
    )
    docs = saved(docs, "op1-rows")  # a row keeps its number whatever is computed again
    spread = docs.filter("n_hit > 0").withColumn("gram", F.explode("found"))
    items = spread.join(grams.select("gram", "item_id"), "gram")
    ids = F.collect_set(F.col("item_id").cast("string"))
    hit = items.groupBy("row", "doc_id", "n_words", "n_hit").agg(ids.alias("items")).drop("row")
    clean = docs.filter("n_hit = 0").select("doc_id", "n_words", "n_hit", F.array().cast("array<string>").alias("items"))
    return hit.unionByName(clean).select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """Documents without a benchmark window; same columns, same rows otherwise."""
    grams = saved(windows(benchmark, size).select("len", "gram", "code").distinct(), "op1-windows")
    internal = documents.select(F.struct(*[documents[c] for c in documents.columns]).alias("whole"), "text")
    clean = with_hits(internal, grams).filter(F.size("hits") == 0)
    return clean.select("whole.*")
