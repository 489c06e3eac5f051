"""Column functions over dates. All of them stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The derived columns of the date dimension, in table order.
DATE_PARTS = {
    "Year": F.year,
    "Month": F.month,
    "DayOfMonth": F.dayofmonth,
    "DayOfYear": F.dayofyear,
    "WeekOfYear": F.weekofyear,
    "DayOfWeek": F.dayofweek,
    "Quarter": F.quarter,
}


def date_parts(date: Column) -> list[Column]:
    """The seven calendar parts of ``date``; weeks are ISO weeks, Sunday is day 1."""
    return [part(date).alias(name) for name, part in DATE_PARTS.items()]


def spread_date(
    key: Column, anchor: Column, days: int, mode: str = "hash", seed: int | None = None
) -> Column:
    """A date in ``[anchor, anchor + days - 1]``, never null.

    ``hash`` derives the offset from ``key`` alone, so reruns and retried tasks agree.
    ``rand`` draws it, as fresh test data would; pass ``seed`` to repeat a draw.
    """
    if mode == "hash":
        digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
        number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
        offset = F.pmod(number, F.lit(days))
    elif mode == "rand":
        offset = F.rand(seed) * days
    else:
        raise ValueError(f"unknown spread mode: {mode!r}")
    return F.date_add(anchor, offset.cast("int"))
