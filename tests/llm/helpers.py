"""Small inputs with the awkward rows every operator must take, and reference readings of the contracts."""

import re
import zlib

from pyspark.sql import functions as F
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
# Names that operators use inside; a further column may have any of them.
CLASHES = ["w", "h", "hits", "doc", "row", "score", "rep", "label", "key", "cell", "node", "size", "n", "text_crc32", "whole"]


def words(text, pattern=r"[^ \t-\r]+"):
    return re.findall(pattern, (text or "").translate(UP))


def remainder(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


def awkward_texts():
    story = " ".join(f"word{k % 37}x{k % 11}" for k in range(400))
    return [
        None, "", "  \n\t ", "one", "Two words", story, story, story + " and more of it", "İÉß ünïcode Ünïcode   x",
        "mail a.b@c.example.com or 10.0.0.1, +1 (202) 555-0101, 4111 1111 1111 1111.", "long " * 30_000,
        "<|endoftext|> 語 " + story[:500],
    ]


def documents(spark, texts, first=0, clashes=()):
    rows = [(first + k, t, "en", f"src{k % 2}", None if t is None else len(t)) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    return frame.withColumns({c: F.lit(f"extra {c}") for c in clashes}) if clashes else frame


def awkward(spark):
    """The awkward texts, a null id, a repeated row, and further columns with the operators' own names."""
    frame = documents(spark, awkward_texts(), clashes=CLASHES)
    odd = frame.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("bigint"))
    return frame.unionByName(odd).unionByName(frame.filter("doc_id = 3")).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def rows_of(frame):
    return [r.asDict() for r in frame.collect()]


def by_id(frame, key="doc_id"):
    return {r[key]: r for r in rows_of(frame)}
