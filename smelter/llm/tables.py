"""Reading tables and keeping column names apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def named(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_results(df: DataFrame, results: dict[str, Column]) -> DataFrame:
    """``df`` with result columns; a result replaces an input column of its name, in any case."""
    new = {name.lower() for name in results}
    kept = [named(c) for c in df.columns if c.lower() not in new]
    return df.select(*kept, *[column.alias(name) for name, column in results.items()])


def apart(df: DataFrame, **roles: str) -> DataFrame:
    """Only the columns that have a role, under the names of their roles."""
    return df.select(*[named(name).alias(role) for role, name in roles.items()])
