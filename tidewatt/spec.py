"""What a reading looks like: which columns hold time, entity and metrics."""

from __future__ import annotations

import re
from dataclasses import dataclass

_NAME = re.compile(r"[A-Za-z][A-Za-z0-9_]*")


def quoted(name: str) -> str:
    """``name`` as a backticked SQL identifier (``carbon-mean`` needs it)."""
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class Metric:
    """One measured quantity.

    ``source`` is its column in the input, ``name`` the plain name used inside
    and in yearly results and ranking labels, ``label`` the column name in
    monthly and hourly results (``name`` when not given).
    """

    name: str
    source: str
    label: str = ""

    def __post_init__(self):
        if not _NAME.fullmatch(self.name):
            raise ValueError(f"metric name must be a plain identifier: {self.name!r}")
        if not self.label:
            object.__setattr__(self, "label", self.name)


@dataclass(frozen=True)
class ReadingSpec:
    """Column mapping of a readings source.

    Inside the package a reading always has the columns ``time``
    (timestamp_ntz), ``entity_name`` (string) and one double per metric name.
    ``zone`` is where the clock hangs that instants (times with a zone) are read from.
    """

    time_col: str
    entity_col: str
    metrics: tuple[Metric, ...]
    entity_name: str = "country"
    zone: str = "UTC"

    def __post_init__(self):
        names = [m.name for m in self.metrics]
        reserved = {"time", self.entity_name}
        if not names or len(set(names)) < len(names) or reserved & set(names):
            raise ValueError(f"metric names must be present, unique and not {reserved}: {names}")
        labels = [m.label for m in self.metrics]
        if len(set(labels)) < len(labels):
            raise ValueError(f"metric labels must be unique: {labels}")
        if not _NAME.fullmatch(self.entity_name):
            raise ValueError(f"entity name must be a plain identifier: {self.entity_name!r}")

    @property
    def metric_names(self) -> list[str]:
        return [m.name for m in self.metrics]

    @property
    def labels(self) -> list[str]:
        return [m.label for m in self.metrics]

    @property
    def entity_group(self) -> str:
        """SQL by which rows are grouped: an empty entity is a missing one.

        Only groups are formed by it; filters compare the plain column and so reach the scan.
        """
        return f"CASE WHEN {self.entity_name} <> '' THEN {self.entity_name} END"

    @property
    def source_columns(self) -> list[str]:
        """Input columns in file order: time, entity, metrics."""
        return [self.time_col, self.entity_col, *(m.source for m in self.metrics)]


# Column and label names of the clean electricity readings.
ELECTRICITY = ReadingSpec(
    time_col="datetime",
    entity_col="country_code",
    metrics=(
        Metric("carbon", "carbon_intensity_direct", "carbon-intensity"),
        Metric("cfe", "cfe_percent", "cfe"),
    ),
)
