"""Row-wise steps of the silver layer."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.functions.dates import spread_date


def project(df: DataFrame, columns: Iterable[str], where: Column | str | None = None) -> DataFrame:
    """Keep ``columns``, named as spelled here whatever the case in ``df``; optionally filter."""
    rows = df if where is None else df.where(where)
    return rows.select(*columns)


def spread_dates(
    df: DataFrame,
    column: str = "OrderDate",
    key: str = "SalesOrderID",
    anchor: Column | None = None,
    days: int = 365,
    mode: str = "hash",
    seed: int | None = None,
) -> DataFrame:
    """Replace ``column`` by dates spread over ``days`` days from ``anchor``; it moves to the end.

    The default anchor is 1000 days before the current date.
    """
    if anchor is None:
        anchor = F.date_sub(F.current_date(), 1000)
    return df.drop(column).withColumn(column, spread_date(F.col(key), anchor, days, mode, seed))
