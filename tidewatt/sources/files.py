"""Finding source files and earlier results by name, and reading results back."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: yearly source files are named <entity>_<year>_hourly.
SOURCE_NAME = r"(?<![^/=_])([^/=_]++)_(\d{4})_hourly"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of every file under ``path`` (globs allowed).

    The content column is not selected, so no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("bytes"))


def source_entity(path: Column, pattern: str = SOURCE_NAME) -> Column:
    return F.regexp_extract(path, pattern, 1)


def source_year(path: Column, pattern: str = SOURCE_NAME) -> Column:
    return F.regexp_extract(path, pattern, 2).try_cast("int")


def discover_sources(spark: SparkSession, path: str, pattern: str = SOURCE_NAME) -> DataFrame:
    """Yearly source files with the entity and year their name gives (SRC-3)."""
    return (
        list_files(spark, path)
        .filter(F.col("path").rlike(pattern))
        .select(
            source_entity(F.col("path"), pattern).alias("entity"),
            source_year(F.col("path"), pattern).alias("year"),
            "bytes",
            "path",
        )
    )


# How many files the driver looks into at a time.
OPEN_FILES = 16


def hadoop_path(spark: SparkSession, path: str):
    """A path and the file system it lies in, as Spark itself sees them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file that is not blank, unpacked where the name says how; no more is read of it."""
    jvm = spark._jvm
    path, files = hadoop_path(spark, file)
    stream = files.open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(path)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        line = reader.readLine()
        while line is not None and not line.strip("\ufeff \t"):
            line = reader.readLine()
    finally:
        reader.close()
    return line


def source_headers(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, str], tuple[str, ...]]:
    """The header of every CSV file under ``paths``, by its path and its URI: the fields of its first line (ING-2).

    The driver, which lists the files for Spark's scan anyway, reads one line of each, several
    files at a time.  Files without any line hold no rows and are left out.
    """
    found = [list_files(spark, path).select("path", "_metadata.file_path") for path in paths]
    names = sorted({tuple(row) for files in found for row in files.collect()})
    with ThreadPoolExecutor(OPEN_FILES) as pool:
        lines = list(pool.map(lambda name: first_line(spark, name[0]), names))
    return {
        name: tuple(field.strip() for field in next(csv.reader([line.removeprefix("\ufeff")])))
        for name, line in zip(names, lines, strict=True)
        if line is not None
    }


def literal_path(path: str) -> str:
    """A file's path with no character read as a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def result_name(query: str, face: str, kind: str | None = None) -> str:
    return "_".join(part for part in (query, face, kind) if part)


def latest_result(
    spark: SparkSession, base: str, query: str, face: str, kind: str | None = None
) -> str:
    """Folder of the newest finished run of a query (SRC-6, AGG-7).

    The whole folder name must match, so ``q2_df_all`` is never taken for
    ``q2_df``, and the folder must hold the mark of a finished write.  Only run
    folders are listed, never their files.
    """
    prefix = result_name(query, face, kind)
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{prefix}_*/_SUCCESS")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks) or []
    names = [mark.getPath().getParent().getName() for mark in found]
    runs = [name for name in names if re.fullmatch(rf"{re.escape(prefix)}_\d{{14}}", name)]
    if not runs:
        raise FileNotFoundError(f"no finished run of {prefix} under {base}")
    return f"{base.rstrip('/')}/{max(runs)}"


def read_result(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """A result folder read back (SRC-5).

    Header lines, blank lines and lines with too few fields are left out: they
    have no valid key, or are reported as corrupt with nothing in the last field.
    """
    corrupt = "_corrupt"
    read_as = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    rows = (
        spark.read.schema(read_as)
        .option("header", True)
        .option("columnNameOfCorruptRecord", corrupt)
        .option("columnPruning", False)
        .csv(path)
    )
    has_keys = reduce(and_, [F.col(f"`{k}`").isNotNull() for k in keys])
    short = F.col(corrupt).isNotNull() & F.col(f"`{schema.names[-1]}`").isNull()
    return rows.filter(has_keys & ~short).drop(corrupt)
