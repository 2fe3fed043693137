"""CSV results named by query, face and run."""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tidewatt.operators.timing import run_times, timing_summary
from tidewatt.scratch import scratch_dir
from tidewatt.sources.files import hadoop_path, result_name


def new_run_id() -> str:
    """The time in UTC, so that ids never step back."""
    return datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S")


def check_run_id(run_id: str) -> str:
    if not re.fullmatch(r"\d{14}", run_id):
        raise ValueError(f"run id must be yyyyMMddHHmmss: {run_id!r}")
    return run_id


def write_result(
    result: DataFrame, base: str, query: str, face: str, run_id: str, kind: str | None = None
) -> str:
    """Write a sorted result as a CSV folder with header lines (SNK-1, SNK-2, FN-10).

    The result keeps the order it was sorted in from one part file to the next.
    An existing folder is never overwritten.
    """
    path = f"{base.rstrip('/')}/{result_name(query, face, kind)}_{check_run_id(run_id)}"
    result.write.option("header", True).csv(path)
    return path


def write_ordered_csv(result: DataFrame, path: str) -> str:
    """Write a sorted result as CSV part files in its order, each with a header line (FN-10).

    The files follow the ranges of the sort.  Adaptive execution joins small ranges,
    so a result of a few dozen rows is one file, whatever its sort was dealt over.
    """
    result.write.option("header", True).csv(path)
    return path


COPY_BYTES = 1 << 20


def merge_csv(spark: SparkSession, folder: str, target: str) -> str:
    """One CSV file of a folder's part files in their order, with the header line of the first (SNK-4).

    Bytes are copied as they are through the cluster's file system by the driver, a fixed
    buffer at a time, so neither its memory nor the file's size is bounded by the other.
    The file gets its name when it is whole; an existing one is never overwritten.
    """
    source, files = hadoop_path(spark, folder)
    final, target_files = hadoop_path(spark, target)
    if target_files.exists(final):
        raise FileExistsError(f"{target} already exists")
    parts = sorted(
        (status.getPath() for status in files.listStatus(source) if status.getPath().getName().startswith("part-") and status.getLen()),
        key=lambda path: path.getName(),
    )
    unfinished, _ = hadoop_path(spark, f"{final.getParent()}/.{final.getName()}.{uuid.uuid4().hex}")
    out = target_files.create(unfinished, False)
    header = None
    try:
        for part in parts:
            stream = files.open(part)
            try:
                first = stream.readLine()  # bytes up to the line's end; header names hold no line breaks
                if header is None:
                    header = first
                    stream.seek(0)
                elif first != header:
                    raise ValueError(f"{part} has the header {first!r} instead of {header!r}")
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, COPY_BYTES, False)
            finally:
                stream.close()
        out.close()
        renamed(spark, unfinished, final)
    except BaseException:
        out.close()
        target_files.delete(unfinished, False)
        raise
    return target


def renamed(spark: SparkSession, old, new) -> None:
    """Give a file its name in one step; where there is a file of that name, fail."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(old, new, spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))


def write_single_csv(result: DataFrame, target: str) -> str:
    """Write a sorted result as one CSV file with one header line (SNK-4, FN-10), whatever its size and ranges.

    Its part files are written to the scratch folder by all tasks and then merged.
    """
    spark = result.sparkSession
    parts = scratch_dir(spark, "parts")
    write_ordered_csv(result, parts)
    merge_csv(spark, parts, target)
    folder, files = hadoop_path(spark, parts)
    files.delete(folder, True)
    return target


def write_timing_report(runs: DataFrame, base: str, run_id: str) -> tuple[str, str]:
    """Write the summary of measured runs and the list of their times (SNK-6)."""
    return (
        write_result(timing_summary(runs), base, "performance", "summary", run_id),
        write_result(run_times(runs), base, "performance", "runs", run_id),
    )
