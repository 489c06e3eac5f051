"""Dimensions and facts of the star schema, from silver rows.

The ``_as_written`` forms keep the join keys of the star schema being reproduced, mistakes
included: a product dimension built from customers, and business ids compared with generated
keys. The other forms are the corrected star schema.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.functions.dates import date_parts
from smelter.operators.keys import surrogate_key
from smelter.operators.staging import stage
from smelter.together import together

# Default bounds of the date dimension, both inclusive.
FIRST_DATE = "2000-01-01"
LAST_DATE = "2024-12-31"

# Fixed value: the address that represents a customer who has several.
PREFERRED_ADDRESS = "Main Office"

# What a fact takes from an order line, after the header columns.
LINE_COLUMNS = ["OrderQty", "ProductID", "UnitPrice", "UnitPriceDiscount", "LineTotal"]


def _customer_addresses(customer: DataFrame, address: DataFrame) -> DataFrame:
    """One row per customer and address; customers without an address drop out."""
    return customer.join(
        address.select("CustomerID", "AddressID", "AddressType"), "CustomerID"
    ).select(*customer.columns, "AddressID", "AddressType")


def _keyed(rows: DataFrame, key: str, natural: list[str], mode: str) -> DataFrame:
    """Surrogate keys in the order of the natural key.

    A natural key that occurs twice by mistake still gives the same keys in every run.
    """
    return surrogate_key(rows, key, natural, mode)


def dim_customer(customer: DataFrame, address: DataFrame, mode: str = "dense") -> DataFrame:
    """Customer and address rows under ``CustomerIDKey``."""
    rows = _customer_addresses(customer, address)
    return _keyed(rows, "CustomerIDKey", ["CustomerID", "AddressID"], mode)


def dim_product_as_written(
    customer: DataFrame, address: DataFrame, mode: str = "dense"
) -> DataFrame:
    """The customer rows again, under ``ProductIDKey``."""
    rows = _customer_addresses(customer, address)
    return _keyed(rows, "ProductIDKey", ["CustomerID", "AddressID"], mode)


def dim_product(product: DataFrame, category: DataFrame, mode: str = "dense") -> DataFrame:
    """Products with the names of their categories, if they have one, under ``ProductIDKey``."""
    names = category.select(
        "ProductCategoryID", "ParentProductCategoryID", F.col("Name").alias("CategoryName")
    )
    rows = product.join(names, "ProductCategoryID", "left").select(
        *product.columns, "ParentProductCategoryID", "CategoryName"
    )
    return _keyed(rows, "ProductIDKey", ["ProductID"], mode)


def _calendar(dates: DataFrame) -> DataFrame:
    return dates.select("Date", *date_parts(F.col("Date")))


def dim_date(spark: SparkSession, start: str = FIRST_DATE, end: str = LAST_DATE) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included.

    A calendar is a few thousand rows, so it is one partition and not one file per core.
    """
    first, last = datetime.date.fromisoformat(start), datetime.date.fromisoformat(end)
    days = spark.range(0, max((last - first).days + 1, 0), 1, 1)
    return _calendar(days.select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("Date")))


def dim_date_covering(
    rows: DataFrame,
    column: str,
    start: str | None = None,
    end: str | None = None,
    at_least: tuple[str, str] | None = None,
) -> DataFrame:
    """One row per day from the first to the last date in ``column``, in one lazy plan.

    ``start`` and ``end`` replace these bounds; ``at_least`` widens those that are not replaced.
    """
    date = F.col(column).cast("date")
    first, last = F.min(date), F.max(date)
    if at_least is not None:
        first = F.least(first, F.lit(at_least[0]).cast("date"))
        last = F.greatest(last, F.lit(at_least[1]).cast("date"))
    first = first if start is None else F.lit(start).cast("date")
    last = last if end is None else F.lit(end).cast("date")
    bounds = rows.agg(first.alias("first"), last.alias("last")).where("first <= last")
    return _calendar(bounds.select(F.explode(F.sequence("first", "last")).alias("Date")))


def order_lines(header: DataFrame, detail: DataFrame) -> DataFrame:
    """Header columns next to each of the order's lines; orders without lines drop out."""
    return header.join(detail.select("SalesOrderID", *LINE_COLUMNS), "SalesOrderID").select(
        *header.columns, *LINE_COLUMNS
    )


def _fact(keyed_header: DataFrame, keyed_detail: DataFrame, header_columns: list[str]) -> DataFrame:
    """Lines with both keys.

    Each side gets its key before they meet: what is shuffled by product are the six line
    columns and by customer the headers, never the wide joined rows.
    """
    return keyed_header.join(keyed_detail, "SalesOrderID").select(
        "ProductIDKey", "CustomerIDKey", *header_columns, *LINE_COLUMNS
    )


def fact_sales(
    header: DataFrame, detail: DataFrame, product: DataFrame, customer: DataFrame
) -> DataFrame:
    """Order lines with the keys of their product and customer, null where there is none.

    Each line appears once: a customer with several addresses counts as the one preferred, then
    the one with the lowest address id.
    """
    products, customers = together(
        header.sparkSession,
        lambda: _one_key(product, "ProductID", "ProductIDKey"),
        lambda: _one_key(
            customer,
            "CustomerID",
            "CustomerIDKey",
            F.coalesce(F.col("AddressType") != PREFERRED_ADDRESS, F.lit(True)),
            F.col("AddressID").isNull(),
            "AddressID",
        ),
    )
    return _fact(
        header.join(customers, "CustomerID", "left"),
        detail.select("SalesOrderID", *LINE_COLUMNS).join(products, "ProductID", "left"),
        header.columns,
    )


def _one_key(dimension: DataFrame, natural: str, key: str, *preference) -> DataFrame:
    """One row per natural key: the surrogate key of its first row by ``preference``.

    Staged, so that the join that follows reads it as a plain table. Adaptive execution splits a
    skewed join only if both inputs are bare shuffles, which an aggregate would prevent.
    """
    first = F.min(F.struct(*preference, key))[key] if preference else F.min(key)
    picked = dimension.where(F.col(natural).isNotNull()).groupBy(natural).agg(first.alias(key))
    return stage(picked, f"{natural}-keys")


def fact_sales_as_written(
    header: DataFrame, detail: DataFrame, product: DataFrame, customer: DataFrame
) -> DataFrame:
    """Order lines with the product whose *generated* key equals the line's product id, once per
    address of the customer."""
    products = product.select("ProductIDKey")
    lines = detail.select("SalesOrderID", *LINE_COLUMNS)
    return _fact(
        _per_address(header, customer.select("CustomerID", "CustomerIDKey")),
        lines.join(products, lines.ProductID == products.ProductIDKey, "left"),
        header.columns,
    )


def _per_address(header: DataFrame, customer: DataFrame) -> DataFrame:
    """``header`` left join ``customer`` on the customer.

    A left join can be split on its left side only, so a customer with very many addresses
    would stay in one task. The matched and the unmatched headers are joined apart: an inner join
    can be split on both sides.
    """
    known = stage(customer.select("CustomerID").distinct(), "customers")
    matched = header.join(customer, "CustomerID")
    unmatched = header.join(known, "CustomerID", "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
