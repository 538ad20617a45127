"""Money expressions.

Costs are parsed into exact decimals, summed as decimals and rounded
HALF_UP; a double is produced only at the output edge. Double sums depend
on summation order (so two engines, or two runs with different partition
layouts, disagree in the last bits) and ``round(double, 2)`` mis-rounds
values such as 1.16 / 8.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from costlake.schemas import MONEY_2DP, MONEY_IN


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Text or number -> DECIMAL(28,15). Malformed text raises (ANSI cast)."""
    return _col(c).cast(MONEY_IN)


def cost_or_zero(c: str | Column) -> Column:
    """NULL cost counts as zero: ``COALESCE(CAST(c AS DECIMAL), 0)``."""
    return F.coalesce(money(c), F.lit(0).cast(MONEY_IN))


def round_money(c: str | Column, scale: int = 2) -> Column:
    """Decimal HALF_UP rounding (round half away from zero)."""
    return F.round(_col(c), scale)


def to_double(c: str | Column) -> Column:
    return _col(c).cast("double")


def allocate_even(total_2dp: str | Column, parts: str | Column) -> Column:
    """``ROUND(total / parts, 2)`` on a 2-dp total, computed in integer cents.

    A decimal division first rounds to 6 places and then to 2, which
    double-rounds once ``parts`` exceeds 10,000. With cents ``c`` and
    ``n`` parts, half-up rounding of ``c / n`` is ``(2|c| + n) div (2n)``
    with the sign of ``c`` put back. Result is DECIMAL(38,2).
    """
    cents = (_col(total_2dp) * F.lit(100)).cast("bigint")
    n = _col(parts).cast("bigint")
    mag_int = F.call_function("div", F.abs(cents) * F.lit(2) + n, n * F.lit(2))
    signed = F.when(cents < 0, -mag_int).otherwise(mag_int)
    return (signed.cast(MONEY_2DP) / F.lit(100)).cast(MONEY_2DP)


def pct_change(current: str | Column, previous: str | Column) -> Column:
    """``(current - previous) / previous`` as a double with float rules.

    The difference is exact (decimal), then divided as doubles. A zero
    previous value gives +inf, -inf or NaN as plain float division would,
    instead of the ANSI divide-by-zero error; a NULL previous gives NULL.
    """
    cur, prev = _col(current), _col(previous)
    diff = (cur - prev).cast("double")
    prev_d = prev.cast("double")
    return (
        F.when(prev.isNull() | cur.isNull(), F.lit(None).cast("double"))
        .when(prev_d != 0, diff / prev_d)
        .when(diff > 0, F.lit(float("inf")))
        .when(diff < 0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )
