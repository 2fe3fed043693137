"""Time grains a reading can be grouped by.

Each grain has a cheap integer or date key, used while grouping, and a display
form, computed once per group afterwards (formatting ``yyyy-MM`` for every input
row costs more than the whole aggregation).
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Grain:
    name: str     # column name in the result
    key: str      # SQL over ``time``, evaluated per row
    display: str  # SQL over the key column ``period``, evaluated per group


# FN-1, FN-2, FN-3, FN-4
GRAINS = {
    "year": Grain("year", "year(time)", "period"),
    "month": Grain("date", "trunc(time, 'month')", "date_format(period, 'yyyy-MM')"),
    "hour_of_day": Grain("hour", "hour(time)", "period"),
}


def grain(name: str) -> Grain:
    if name not in GRAINS:
        raise ValueError(f"unknown grain {name!r}, use one of {sorted(GRAINS)}")
    return GRAINS[name]
