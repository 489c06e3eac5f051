import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from smelter.operators import project, spread_dates
from smelter.plans import SILVER_COLUMNS, silver_table


def test_projection_keeps_order_and_spelling(spark):
    frame = spark.createDataFrame(
        [(1, 2, 3)], "rowguid int, UnitPriceDIscount int, salesorderid int"
    )
    got = project(frame, ["SalesOrderID", "UnitPriceDiscount"])
    assert got.columns == ["SalesOrderID", "UnitPriceDiscount"]
    assert got.first() == (3, 2)


def test_projection_filters_only_when_asked(spark):
    frame = spark.range(10)
    assert project(frame, ["id"]).count() == 10
    assert project(frame, ["id"], "id < 3").count() == 3
    assert project(frame, ["id"], F.col("id") >= 3).count() == 7


@pytest.mark.parametrize("name", sorted(SILVER_COLUMNS))
def test_silver_table_drops_other_columns(spark, name):
    columns = ["rowguid", *reversed(SILVER_COLUMNS[name])]
    frame = spark.createDataFrame([], ", ".join(f"{column} string" for column in columns))
    assert silver_table(name, frame).columns == SILVER_COLUMNS[name]


def test_missing_columns_are_an_error_unless_partial(spark):
    frame = spark.createDataFrame([(1, 2)], "customerid int, addressid int")
    assert silver_table("salesCustomerAddress", frame, partial=True).columns == [
        "CustomerID",
        "AddressID",
    ]
    with pytest.raises(Exception, match="AddressType"):
        silver_table("salesCustomerAddress", frame)


@pytest.mark.parametrize("mode", ["hash", "rand"])
def test_spread_dates_range(spark, mode):
    frame = spark.range(20_000).selectExpr(
        "id AS SalesOrderID", "'2008-06-01' AS OrderDate", "1 AS x"
    )
    anchor = datetime.date(1998, 1, 1)
    got = spread_dates(frame, anchor=F.lit(anchor), mode=mode, seed=1)
    assert got.columns == ["SalesOrderID", "x", "OrderDate"]
    low, high, days = got.agg(
        F.min("OrderDate"), F.max("OrderDate"), F.countDistinct("OrderDate")
    ).first()
    assert low == anchor
    assert high == anchor + datetime.timedelta(days=364)
    assert days == 365


def test_hash_dates_do_not_depend_on_partitioning_and_are_never_null(spark):
    frame = spark.createDataFrame([(None,), (1,), (2,)], "SalesOrderID int").withColumn(
        "OrderDate", F.current_date()
    )
    one, two = (
        sorted(map(str, spread_dates(f, anchor=F.lit("1998-01-01").cast("date")).collect()))
        for f in (frame.repartition(3), frame.coalesce(1))
    )
    assert one == two
    assert "OrderDate=None" not in "".join(one)


@pytest.mark.parametrize("days", [1, 7, 365])
def test_hash_dates_by_hand(spark, days):
    anchor = datetime.date(1998, 1, 1)
    keys = [0, 1, -5, 2**31, 2**62, 99]
    frame = spark.createDataFrame([(key,) for key in keys], "SalesOrderID bigint")
    got = spread_dates(frame, anchor=F.lit(anchor), days=days).collect()
    for key, date in got:
        number = int(hashlib.md5(str(key).encode()).hexdigest()[:8], 16)
        assert date == anchor + datetime.timedelta(days=number % days)
    assert len(got) == len(keys)


def test_default_anchor_is_1000_days_ago(spark):
    frame = spark.range(2000).select(F.col("id").alias("SalesOrderID"), F.lit(1).alias("OrderDate"))
    offsets = spread_dates(frame).select(F.datediff(F.current_date(), "OrderDate").alias("d"))
    assert offsets.agg(F.min("d") >= 636, F.max("d") <= 1000).first() == (True, True)


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        spread_dates(spark.range(1), key="id", mode="other")
