"""Results as keyed records, each a map of text fields."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.spec import ReadingSpec, quoted


@dataclass(frozen=True)
class RecordLayout:
    """Key parts and fields of one kind of record.

    A key part is a literal text or, written as ``{column}``, a column of the
    result.  ``fields`` maps field names to result columns.
    """

    key: tuple[str, ...]
    fields: Mapping[str, str]


def yearly_layout(spec: ReadingSpec) -> RecordLayout:
    """``Q1:<entity>:<year>`` with mean, min and max of every metric (SNK-5a)."""
    measures = [f"{n}-{what}" for n in spec.metric_names for what in ("mean", "min", "max")]
    return RecordLayout(
        ("Q1", f"{{{spec.entity_name}}}", "{year}"),
        {column.replace("-", "_"): column for column in measures},
    )


def ranking_layout(spec: ReadingSpec, entity: str) -> RecordLayout:
    """``Q2:<entity>:<ranking>:<rank>`` with the month and its means (SNK-5b)."""
    return RecordLayout(
        ("Q2", entity, "{order_type}", "{rank}"),
        {"date": "date", **{m.name: m.label for m in spec.metrics}},
    )


def percentile_layout(spec: ReadingSpec, probabilities: Mapping[str, float]) -> RecordLayout:
    """``Q3:<entity>:<metric>`` with the five percentiles (SNK-5c)."""
    return RecordLayout(
        ("Q3", f"{{{spec.entity_name}}}", "{data}"), {name: name for name in probabilities}
    )


def hash_records(result: DataFrame, layout: RecordLayout) -> DataFrame:
    """``key`` and ``value`` map of a result's rows (SNK-5, FN-11).

    Everything is text; a NULL becomes the empty text, as in a CSV field.
    """

    def text(column: str):
        return F.coalesce(F.col(quoted(column)).cast("string"), F.lit(""))

    parts = [text(p[1:-1]) if p.startswith("{") else F.lit(p) for p in layout.key]
    pairs = [c for name, column in layout.fields.items() for c in (F.lit(name), text(column))]
    return result.select(F.concat_ws(":", *parts).alias("key"), F.create_map(*pairs).alias("value"))


def one_per_key(records: DataFrame) -> DataFrame:
    """One record for each key.  Of several, that with the last text stays, whatever their order."""
    return records.groupBy("key").agg(F.max_by("value", F.to_json("value")).alias("value"))


def upsert_records(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """``stored`` with ``updates`` applied (SNK-5).

    A new key is added; for a known key the given fields are replaced and the
    others stay.  Each side is brought to one record per key first.
    """
    old, new = one_per_key(stored).alias("old"), one_per_key(updates).alias("new")
    merged = F.map_zip_with("old.value", "new.value", lambda _, before, now: F.coalesce(now, before))
    return old.join(new, "key", "full_outer").select(
        "key", F.coalesce(merged, F.col("new.value"), F.col("old.value")).alias("value")
    )


def flat_records(records: DataFrame, fields: list[str]) -> DataFrame:
    """Records with one text column per field."""
    return records.select("key", *[F.col("value")[f].alias(f) for f in fields])
