"""Keyed records on disk, updated at the cost of what is updated.

A store has a fixed number of buckets; a record's bucket is the hash of its key.  Files never
change: ``data/<write>/bucket=<b>`` holds bucket b as one write left it, and
``versions/<number>`` says for every bucket which write that is.  An upsert reads and
writes the touched buckets only, and puts its version in place last, in one step: a
reader sees the old version or the new one, and what a failed write left behind is never
read.  Of two upserts that start from the same version, one fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.scratch import scratch_dir
from tidewatt.sinks.records import one_per_key, upsert_records
from tidewatt.sinks.results import renamed
from tidewatt.sources.files import hadoop_path

BUCKETS = 64
RECORD = "key string, value map<string,string>"


def key_hash(key: Column, buckets: int) -> Column:
    """The first 32 bits of the key's MD5, modulo the number of buckets."""
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


@dataclass(frozen=True)
class Version:
    """One state of a store: its number, and for each bucket in use the write, and the version, that made it."""

    number: int
    buckets: int
    writes: dict[int, tuple[str, int]]


@dataclass(frozen=True)
class RecordStore:
    """Records under ``path``.

    ``buckets`` counts for a new store; an existing one keeps its own.  It should be chosen
    so that a bucket of the full store is a few hundred megabytes: that much is rewritten
    for each key of an update that touches it.
    """

    path: str
    buckets: int = BUCKETS

    def version(self, spark: SparkSession, number: int | None = None) -> Version:
        """The newest version, or one by its number; version 0 of a store not yet written to is empty."""
        folder, files = hadoop_path(spark, f"{self.path}/versions")
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        found = sorted(int(name) for name in names if name.isdigit())
        if number is None:
            number = found[-1] if found else 0
        if number and number not in found:
            raise FileNotFoundError(f"no version {number} of the records under {self.path}")
        if not number:
            return Version(0, self.buckets, {})
        path, _ = hadoop_path(spark, self._version_file(number))
        stream = files.open(path)
        try:
            state = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(number, state["buckets"], {int(b): (w, v) for b, (w, v) in state["writes"].items()})

    def folders(self, version: Version) -> dict[int, str]:
        """Where each bucket of a version lies."""
        return {b: f"{self.path}/data/{write}/bucket={b}" for b, (write, _) in sorted(version.writes.items())}

    def read(self, spark: SparkSession, version: Version | None = None, buckets: list[int] | None = None) -> DataFrame:
        """All records of a version (the newest if none is given), or those of some buckets."""
        folders = self.folders(version or self.version(spark))
        paths = [path for b, path in folders.items() if buckets is None or b in buckets]
        if not paths:
            return spark.createDataFrame([], RECORD)
        return spark.read.schema(RECORD).parquet(*paths)

    def upsert(self, records: DataFrame) -> Version:
        """Apply records (SNK-5): new keys are added, of known keys the given fields replaced.

        The driver sees the numbers of the touched buckets, at most one for each bucket.
        """
        spark = records.sparkSession
        old = self.version(spark)
        updates = scratch_dir(spark, "updates")
        one_per_key(records).write.parquet(updates)
        fresh = spark.read.schema(RECORD).parquet(updates)
        touched = sorted(r.b for r in fresh.select(key_hash(F.col("key"), old.buckets).alias("b")).distinct().collect())
        write = uuid.uuid4().hex
        if touched:
            merged = upsert_records(self.read(spark, old, touched), fresh)
            by_bucket = merged.withColumn("bucket", key_hash(F.col("key"), old.buckets)).hint("rebalance", "bucket")
            by_bucket.write.partitionBy("bucket").parquet(f"{self.path}/data/{write}")
        number = old.number + 1
        new = Version(number, old.buckets, old.writes | {b: (write, number) for b in touched})
        self._put(spark, new)
        return new

    def _version_file(self, number: int) -> str:
        return f"{self.path}/versions/{number:014d}"

    def _put(self, spark: SparkSession, version: Version) -> None:
        state = json.dumps({"buckets": version.buckets, "writes": version.writes})
        draft, files = hadoop_path(spark, f"{self.path}/versions/.{uuid.uuid4().hex}")
        out = files.create(draft, False)
        try:
            out.write(bytearray(state.encode()))
        finally:
            out.close()
        try:
            renamed(spark, draft, hadoop_path(spark, self._version_file(version.number))[0])
        except BaseException:
            files.delete(draft, False)
            raise
