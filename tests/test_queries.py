"""Each registered query against its SQL in DuckDB."""

import math
import pathlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from smelter import catalog, fixtures
from smelter.plans import gold

SCALE = pathlib.Path("/root/testdata/sf0.001")
LARGER = SCALE.with_name("sf0.01")

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
}

pytestmark = pytest.mark.skipif(not SCALE.exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in SCALE.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def sortable(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    frame = contract.queries()[name](spark, str(SCALE))
    expected = duck.sql(contract.oracle_sql()[name])
    columns = sorted(frame.columns)
    assert columns == sorted(expected.columns)
    types = {f.name: TYPES[f.dataType.simpleString()] for f in frame.schema}
    assert types == dict(zip(expected.columns, map(str, expected.types)))
    got = sortable(map(tuple, frame.select(*columns).collect()))
    want = sortable(duck.sql(f"select {', '.join(columns)} from expected").fetchall())
    assert len(got) == len(want)
    for left, right in zip(got, want):
        assert all(
            math.isclose(a, b, rel_tol=1e-12) if isinstance(a, float) and b is not None else a == b
            for a, b in zip(left, right)
        ), (left, right)


def test_every_query_has_its_sql():
    assert set(catalog.ORACLES) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def summary(fact):
    """Rows, rows with each key, and the sum of the lines."""
    return (
        fact.agg(
            F.count("*"),
            F.count("ProductIDKey"),
            F.count("CustomerIDKey"),
            F.round(F.sum("LineTotal"), 2),
        )
        .first()[:]
    )


@pytest.mark.skipif(not LARGER.exists(), reason="needs the test tables")
def test_known_results(spark):
    """Counts measured before this library was written."""
    folder, run = str(LARGER), contract.queries()
    assert run["dim_customer"](spark, folder).count() == 1565
    assert run["dim_customer"](spark, folder).select("CustomerID").distinct().count() == 1372
    assert run["dim_product"](spark, folder).count() == 2000
    assert summary(run["fact_sales"](spark, folder)) == (60_000, 60_000, 54_942, 3_024_008_727.89)
    assert summary(run["fact_sales_as_written"](spark, folder)) == (
        67_706, 19_113, 62_648, 3_416_045_076.64,
    )
    corrected_product = gold.fact_sales_as_written(
        fixtures.silver(spark, folder, "salesOrderHeader"),
        fixtures.silver(spark, folder, "salesOrderDetail"),
        run["dim_product"](spark, folder),
        run["dim_customer"](spark, folder),
    )
    assert summary(corrected_product)[:2] == (67_706, 33_845)


def test_entry(spark):
    fact = contract.entry(spark)
    assert fact.columns[:2] == ["ProductIDKey", "CustomerIDKey"]
    assert fact.count() == 6000
