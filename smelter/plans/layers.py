"""The three layers in order: bronze files, silver tables, gold star schema."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from smelter.operators.project import spread_dates
from smelter.operators.tables import write_tables
from smelter.plans import gold
from smelter.plans.silver import SILVER_SOURCES, silver_table
from smelter.sources.views import register_bronze, register_tables


def _by_name(views: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Views under their names in lower case: names differ in case between the layers."""
    return {name.lower(): rows for name, rows in views.items()}


def run_silver(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    fmt: str = "parquet",
    database: str | None = None,
    schemas: Mapping[str, StructType | str] | None = None,
    types: Mapping[str, str] | None = None,
    glob_suffix: str = "",
    where: Mapping[str, Column | str] | None = None,
    spread: str | None = "hash",
    anchor: Column | None = None,
    partial: bool = False,
) -> dict[str, DataFrame]:
    """Register the bronze files as views and write the six silver tables.

    Column types are inferred from the text unless ``schemas`` or ``types`` give them; for large
    files give them, for instance as ``SILVER_TYPES``, to read the files once and not twice.
    ``spread`` replaces the order dates (``hash`` or ``rand``); None keeps them. ``where`` maps
    silver tables to row filters.
    """
    views = _by_name(register_bronze(spark, bronze_root, schemas, types, glob_suffix))

    def build(name: str, view: str) -> DataFrame:
        rows = silver_table(name, views[view], (where or {}).get(name), partial)
        if name == "salesOrderHeader" and spread:
            rows = spread_dates(rows, anchor=anchor, mode=spread)
        return rows

    builders = {
        name: (lambda name=name, view=view: build(name, view))
        for name, view in SILVER_SOURCES.items()
    }
    return write_tables(spark, builders, silver_root, fmt, database)


def run_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    fmt: str = "parquet",
    database: str | None = None,
    mode: str = "dense",
    first_date: str | None = None,
    last_date: str | None = None,
    as_written: bool = False,
) -> dict[str, DataFrame]:
    """Register the silver folders as views and write three dimensions, then the sales fact.

    The fact takes its keys from the dimensions as written, not from a second run of their plans.
    The calendar runs from ``first_date`` to ``last_date``; a bound that is not given is the usual
    one, moved out as far as the order dates need.
    """
    silver = _by_name(register_tables(spark, silver_root, fmt))
    customer, address = silver["salescustomer"], silver["salescustomeraddress"]

    def product() -> DataFrame:
        if as_written:
            return gold.dim_product_as_written(customer, address, mode)
        return gold.dim_product(silver["salesproduct"], silver["salesproductcategory"], mode)

    written = write_tables(
        spark,
        {
            "dimProduct": product,
            "dimCustomer": lambda: gold.dim_customer(customer, address, mode),
            "dimDate": lambda: gold.dim_date_covering(
                silver["salesorderheader"],
                "OrderDate",
                first_date,
                last_date,
                at_least=(gold.FIRST_DATE, gold.LAST_DATE),
            ),
        },
        gold_root,
        fmt,
        database,
    )
    fact = gold.fact_sales_as_written if as_written else gold.fact_sales
    sales = {
        "factSales": lambda: fact(
            silver["salesorderheader"],
            silver["salesorderdetail"],
            written["dimProduct"],
            written["dimCustomer"],
        )
    }
    return written | write_tables(spark, sales, gold_root, fmt, database)


def run_layers(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    gold_root: str,
    fmt: str = "parquet",
    database: str | None = None,
    silver_options: Mapping[str, Any] | None = None,
    gold_options: Mapping[str, Any] | None = None,
) -> dict[str, DataFrame]:
    """Bronze to gold; the options are arguments of ``run_silver`` and ``run_gold``."""
    silver = run_silver(
        spark, bronze_root, silver_root, fmt, database, **(silver_options or {})
    )
    return silver | run_gold(
        spark, silver_root, gold_root, fmt, database, **(gold_options or {})
    )
