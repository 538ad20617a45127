"""Date keys. Dates travel as ISO ``YYYY-MM-DD`` text, whose order is the
calendar order; they are parsed strictly where arithmetic is needed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_date(c: str | Column) -> Column:
    """Text -> DATE with format ``yyyy-MM-dd``; anything else raises (ANSI)."""
    return F.to_date(_col(c), "yyyy-MM-dd")


def month_key(c: str | Column) -> Column:
    """Month of an ISO date text: its first seven characters."""
    return F.substring(_col(c), 1, 7)


def week_key(c: str | Column) -> Column:
    """Calendar-year week ``YYYY-Www`` with Monday weeks (strftime ``%Y-W%W``).

    Days before the year's first Monday are week 00; this is not the ISO
    week. ``weekday`` is 0 for Monday, so the week number is
    ``floor((day_of_year + 6 - weekday) / 7)``.
    """
    d = strict_date(c)
    wk = F.floor((F.dayofyear(d) + F.lit(6) - F.weekday(d)) / F.lit(7)).cast("int")
    return F.concat(
        F.lpad(F.year(d).cast("string"), 4, "0"), F.lit("-W"), F.lpad(wk.cast("string"), 2, "0"))
