"""Registering folders as session views."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from smelter.sources.files import Entry, list_folder, literal_path, read_bronze, read_table
from smelter.together import together


def view_name(file_name: str) -> str:
    """``Sales.Order.csv`` becomes ``SalesOrder``: the ending and all dots go."""
    return file_name.removesuffix(".csv").replace(".", "")


def _register(
    spark: SparkSession, read: Callable[[Entry], tuple[str, DataFrame]], entries: list[Entry]
) -> dict[str, DataFrame]:
    """Read the entries side by side, as finding their types is a job each; then name them.

    Session views do not differ in case only, so entries whose names do are an error.
    """
    taken: dict[str, Entry] = {}
    for entry in entries:
        other = taken.setdefault(view_name(entry.name).lower(), entry)
        if other is not entry:
            raise ValueError(f"{other.name} and {entry.name} would be the same view")
    views = dict(together(spark, *[partial(read, entry) for entry in entries]))
    for name, rows in views.items():
        rows.createOrReplaceTempView("`" + name.replace("`", "``") + "`")
    return views


def register_bronze(
    spark: SparkSession,
    root: str,
    schemas: Mapping[str, StructType | str] | None = None,
    types: Mapping[str, str] | None = None,
    glob_suffix: str = "",
) -> dict[str, DataFrame]:
    """One view per CSV file, or folder of CSV parts, in ``root``.

    ``schemas`` maps view names, in any case, to schemas; the views found there start no job.
    For the others see ``read_bronze``.
    """
    known = {name.lower(): schema for name, schema in (schemas or {}).items()}

    def read(entry: Entry) -> tuple[str, DataFrame]:
        name = view_name(entry.name)
        path, schema = literal_path(entry.path), known.get(name.lower())
        return name, read_bronze(spark, path, schema, types, glob_suffix)

    return _register(spark, read, list_folder(spark, root))


def register_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """One view per table folder in ``root``."""

    def read(entry: Entry) -> tuple[str, DataFrame]:
        return entry.name, read_table(spark, literal_path(entry.path), fmt)

    return _register(spark, read, [e for e in list_folder(spark, root) if e.is_folder])


def show_views(spark: SparkSession) -> DataFrame:
    """Namespace, name and kind of every view in the current database and session."""
    return spark.sql("SHOW VIEWS")
