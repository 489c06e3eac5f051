"""Sinks: external tables and previews."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from smelter.operators.staging import scratch_until_done
from smelter.sources.files import delete_folder, folder_exists, list_folder, rename_folder
from smelter.together import together

# Formats with a log of their own, whose overwrite is atomic.
LOGGED = ("delta", "iceberg", "hudi")


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def qualified(spark: SparkSession, name: str, database: str | None = None) -> str:
    """``database.name``, which a temp view of the same name cannot shadow."""
    return f"{database or spark.catalog.currentDatabase()}.{name}"


def finish_replacements(
    spark: SparkSession, root: str, name: str | None = None, fmt: str = "parquet", database: str | None = None
) -> list[str]:
    """Put tables below ``root`` back in place whose writer was lost between its two renames: one
    table, or all; return their names.

    The old table stands aside only once all new rows are there, so the new ones take its place; if
    they are gone, the old table does. A catalog entry is made anew. Not to be called while another
    job replaces the same table.
    """
    if not folder_exists(spark, root):
        return []
    hidden = {entry.name for entry in list_folder(spark, root, hidden=True) if entry.is_folder}
    done = []
    for folder in sorted(hidden):
        found = re.fullmatch(r"\.(.+)-[0-9a-f]{32}-old", folder)
        if not found or name not in (None, found[1]):
            continue
        path, old = table_path(root, found[1]), table_path(root, folder)
        if folder_exists(spark, path):
            continue
        new = folder.removesuffix("-old") + "-new"
        if new in hidden:
            rename_folder(spark, table_path(root, new), path)
            delete_folder(spark, old)
        else:
            rename_folder(spark, old, path)
        target = qualified(spark, found[1], database)
        if spark.catalog.tableExists(target):
            _enter(spark.read.format(fmt).load(path), target, path, fmt)
        done.append(found[1])
    return done


def write_table(
    df: DataFrame, root: str, name: str, fmt: str = "parquet", database: str | None = None
) -> DataFrame:
    """Replace rows and schema of external table ``name`` below ``root``; return it read back.

    A write that fails leaves the old table as it was, and ``df`` may read the table it replaces.
    Formats with a log see to that themselves; for others the rows go to a hidden folder beside the
    table, which takes the table's place by two renames once all rows are there. A table whose last
    writer was lost between them is put in place first.
    """
    spark, target = df.sparkSession, qualified(df.sparkSession, name, database)
    if fmt in LOGGED:
        options = {"overwriteSchema": "true"} if fmt == "delta" else {}
        df.write.saveAsTable(
            target, format=fmt, mode="overwrite", path=table_path(root, name), **options
        )
        return spark.table(target)
    finish_replacements(spark, root, name, fmt, database)
    path, mark = table_path(root, name), uuid.uuid4().hex
    new, old = table_path(root, f".{name}-{mark}-new"), table_path(root, f".{name}-{mark}-old")
    try:
        df.write.format(fmt).save(new)
    except BaseException:
        delete_folder(spark, new)
        raise
    replaced = folder_exists(spark, path)
    if replaced:
        rename_folder(spark, path, old)
    try:
        rename_folder(spark, new, path)
        _enter(df, target, path, fmt)
    except BaseException:
        delete_folder(spark, path)
        if replaced:
            rename_folder(spark, old, path)
            _enter(spark.read.format(fmt).load(path), target, path, fmt)
        raise
    if replaced:
        delete_folder(spark, old)
    return spark.table(target)


def _enter(df: DataFrame, target: str, path: str, fmt: str) -> None:
    """Point the catalog's ``target`` at the files in ``path``."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.catalog.createTable(target, path=path, source=fmt, schema=df.schema)
    spark.catalog.refreshByPath(path)


def write_tables(
    spark: SparkSession,
    tables: Mapping[str, Callable[[], DataFrame]],
    root: str,
    fmt: str = "parquet",
    database: str | None = None,
) -> dict[str, DataFrame]:
    """Build and write independent tables side by side; what they staged is deleted afterwards."""

    def write(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        with scratch_until_done(spark):
            return write_table(build(), root, name, fmt, database)

    written = together(
        spark, *[lambda name=name, build=build: write(name, build) for name, build in tables.items()]
    )
    return dict(zip(tables, written))


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)
