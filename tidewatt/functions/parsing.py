"""Strict text-to-value expressions: a bad field becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text forms of a timestamp and of a number.
TIME_PATTERN = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
NUMBER_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def strict_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text as timestamp_ntz (FN-5).

    The cast alone would also take a bare year, a ``T`` or a zone suffix.  No
    time zone is involved, so an hour skipped by summer time stays as written.
    """
    return F.when(text.rlike(TIME_PATTERN), text.try_cast("timestamp_ntz"))


def local_time(instant: Column, zone: str) -> Column:
    """The wall clock of ``zone`` at an instant, as timestamp_ntz (PRJ-6); the session's zone plays no part."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def strict_double(text: Column) -> Column:
    """Decimal text as a double (FN-9, PRJ-6); ``nan``, ``inf`` and suffixes are not numbers."""
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def finite(number: Column) -> Column:
    """NULL for NaN and the infinities (FLT-5): NaN sorts above everything."""
    return F.when(F.abs(number) < float("inf"), number)
