import pathlib

import duckdb
import pytest

SCALE = pathlib.Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def folder():
    if not SCALE.exists():
        pytest.skip("needs the test tables")
    return str(SCALE)


@pytest.fixture(scope="session")
def duck(folder):
    connection = duckdb.connect()
    for file in pathlib.Path(folder).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


@pytest.fixture
def rows(spark):
    """A table from rows of Python values."""

    def build(values, schema):
        return spark.createDataFrame(values, schema)

    return build
