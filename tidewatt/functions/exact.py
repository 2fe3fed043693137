"""Means and roundings whose result does not depend on partitioning.

``avg`` over doubles adds in whatever order tasks finish, so its last digits may
change from run to run and a mean that lies on a rounding tie may flip.  Summing
decimals is exact but about six times slower (it goes through text and
BigDecimal for every value).  Here each value is split into its whole part and
billionths of the rest, and pieces of their bits are summed as bigints: exact,
order-free, and inside whole-stage codegen.
"""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Context, Decimal

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatt.spec import quoted

BILLION = 1_000_000_000
MEAN_PLACES = 6
EXTREME_PLACES = 2
# Values must be smaller than 2**WHOLE_BITS.  Summed pieces have 21 or 15 bits, so
# that the sums hold for 2**42 rows per group.
WHOLE_BITS, WHOLE_PIECE, REST_PIECE = 63, 21, 15


def mean_sql(column: str, places: int = MEAN_PLACES) -> str:
    """SQL text of the mean of a double column, rounded HALF_UP (AGG-1..3, AGG-6, FN-6).

    NULLs are skipped.  One rule holds for all values below 2**63 and groups up to
    2**42 rows; anything beyond is an error that names the column.
    """
    x = quoted(column)
    whole = f"floor({x})"  # a bigint
    rest = f"try_cast(rint(({x} - floor({x})) * 1e9) AS BIGINT)"
    low, high = 2**WHOLE_PIECE, 2**REST_PIECE
    sums = [
        f"try_sum(shiftright({whole}, {2 * WHOLE_PIECE}))",
        f"try_sum(shiftright({whole}, {WHOLE_PIECE}) & {low - 1})",
        f"try_sum({whole} & {low - 1})",
        f"try_sum(shiftright({rest}, {REST_PIECE}))",
        f"try_sum({rest} & {high - 1})",
    ]
    top, middle, bottom, upper, lower = (f"CAST({s} AS DECIMAL(20,0))" for s in sums)
    count = f"CAST(count({x}) AS DECIMAL(13,0))"
    wholes = f"CAST(CAST({top} * {low} + {middle} AS DECIMAL(30,0)) * {low} + {bottom} AS DECIMAL(36,0))"
    over = f"CAST(pmod({wholes}, {count}) AS DECIMAL(13,0))"
    # mean = quotient + remainder, the remainder (0 to below 2) exact to the last place that can matter
    quotient = f"CAST(({wholes} - {over}) / {count} AS DECIMAL(20,0))"
    billionths = f"CAST({over} * {BILLION} + {upper} * {high} + {lower} AS DECIMAL(23,0))"
    scaled = f"CAST({billionths} / {count} AS DECIMAL(25,14)) / {10 ** (9 - places)}"
    steps = f"CASE WHEN {quotient} >= 0 THEN floor({scaled} + 0.5) ELSE ceil({scaled} - 0.5) END"
    value = f"CAST({quotient} + CAST({steps} AS DECIMAL(13,0)) / {10**places} AS DOUBLE)"
    beyond = f"coalesce(max(abs({x})), 0) >= {float(2**WHOLE_BITS)!r}"
    overflow = " OR ".join(f"{s} IS NULL" for s in sums)
    return (
        f"CASE WHEN count({x}) = 0 THEN NULL"
        f" WHEN {beyond} THEN CAST(raise_error('{column} holds a value of 2^{WHOLE_BITS} or more') AS DOUBLE)"
        f" WHEN {overflow} THEN CAST(raise_error('{column} has too many values in one group') AS DOUBLE)"
        f" ELSE {value} END"
    )


def mean(column: str, places: int = MEAN_PLACES) -> Column:
    return F.expr(mean_sql(column, places))


# The same arithmetic on plain Python numbers and on arrays, for the RDD face.

_CONTEXT = Context(prec=60, rounding=ROUND_HALF_UP)
_WIDE = 2**53  # from here on doubles have no decimals


def _rounded(exact: Decimal, places: int) -> float:
    if abs(exact) >= _WIDE:
        return float(exact)
    return float(exact.quantize(Decimal(1).scaleb(-places), context=_CONTEXT))


def to_billionths(value: float) -> int:
    whole = math.floor(value)
    return whole * BILLION + round((value - whole) * 1e9)


def billionths_by_group(values: np.ndarray, group: np.ndarray, groups: int, name: str) -> list[int]:
    """Exact sums of billionths of an array's values, one for each group of rows."""
    if len(values) and np.abs(values).max() >= 2.0**WHOLE_BITS:
        raise ValueError(f"{name} holds a value of 2^{WHOLE_BITS} or more")
    floor = np.floor(values)
    whole, rest = floor.astype(np.int64), np.rint((values - floor) * 1e9).astype(np.int64)
    out = [0] * groups
    for part, weight in ((whole >> 31, BILLION << 31), (whole & (2**31 - 1), BILLION), (rest, 1)):
        sums = np.zeros(groups, np.int64)
        np.add.at(sums, group, part)
        out = [total + int(piece) * weight for total, piece in zip(out, sums.tolist(), strict=True)]
    return out


def mean_of_billionths(total: int, count: int, places: int = MEAN_PLACES) -> float | None:
    if not count:
        return None
    steps, over = divmod(abs(total) * 10**places, count * BILLION)
    steps += 2 * over >= count * BILLION
    return float(Decimal(steps if total >= 0 else -steps).scaleb(-places, _CONTEXT))


def half_up(value: float, places: int) -> float:
    return _rounded(Decimal(repr(value)), places)


def interpolated(ordered: list[float], prob: float, places: int = MEAN_PLACES) -> float:
    """Percentile of sorted values at position ``prob * (n - 1)`` (FN-12, UDF-5).

    Double arithmetic as in ``percentile``, so both give the same last digit.
    """
    position = prob * (len(ordered) - 1)
    below, above = math.floor(position), math.ceil(position)
    if below == above:
        return half_up(ordered[below], places)
    value = (above - position) * ordered[below] + (position - below) * ordered[above]
    return half_up(value, places)
