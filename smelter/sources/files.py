"""Reading files and table folders."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructType


class Entry(NamedTuple):
    path: str
    name: str
    is_folder: bool
    length: int


def _file_system(spark: SparkSession, root: str):
    """The Hadoop file system of ``root``, and ``root`` as a path in it.

    Storage settings made on the session apply, as they do for reads.
    """
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop
    conf = hadoop.conf.Configuration(context._jsc.hadoopConfiguration())
    for name, value in spark.conf.getAll.items():
        if name.startswith("fs."):
            conf.set(name, value)
    folder = hadoop.fs.Path(root)
    return folder.getFileSystem(conf), folder


def list_folder(spark: SparkSession, root: str, hidden: bool = False) -> list[Entry]:
    """The direct children of ``root``, by name; those that are hidden (``_`` or ``.``), or not.

    One listing call: the files below a table folder are not visited.
    """
    system, folder = _file_system(spark, root)
    children = [
        Entry(
            path=child.getPath().toString(),
            name=child.getPath().getName(),
            is_folder=child.isDirectory(),
            length=child.getLen(),
        )
        for child in system.listStatus(folder)
    ]
    return sorted((c for c in children if (c.name[0] in "_.") == hidden), key=lambda c: c.name)


def folder_bytes(spark: SparkSession, root: str) -> int:
    """Bytes of all files below ``root``, summed by the file system."""
    system, folder = _file_system(spark, root)
    return system.getContentSummary(folder).getLength()


def folder_exists(spark: SparkSession, path: str) -> bool:
    system, folder = _file_system(spark, path)
    return system.exists(folder)


def rename_folder(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder within its file system. Not every object store does this in one step."""
    system, folder = _file_system(spark, path)
    if not system.rename(folder, _file_system(spark, to)[1]):
        raise OSError(f"cannot rename {path} to {to}")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and all below it, if it exists."""
    system, folder = _file_system(spark, path)
    system.delete(folder, True)


def literal_path(path: str) -> str:
    """``path`` for readers, which take some characters for patterns."""
    return "".join("\\" + c if c in "{}[]*?\\," else c for c in path)


def read_bronze(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    types: Mapping[str, str] | None = None,
    glob_suffix: str = "",
    **options: str,
) -> DataFrame:
    """A CSV file, or a folder of CSV parts, with a header.

    Types are inferred, at the cost of one more pass over the file, unless they are given: as a
    ``schema``, which the header must match, or as ``types`` by column name in any case, where
    columns not named are strings. A value that does not fit a given type is an error.
    ``glob_suffix="*"`` also reads every path that starts with ``path``.
    """
    path += glob_suffix
    reader = spark.read.option("header", True)
    if schema is None and types is not None:
        # Without inference only the first line is read here.
        schema = _schema(reader.options(**options).csv(path).columns, types)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema).options(enforceSchema=False, mode="FAILFAST")
    return reader.options(**options).csv(path)


def _schema(header: list[str], types: Mapping[str, str]) -> StructType:
    known = {name.lower(): kind for name, kind in types.items()}
    schema = StructType()
    for name in header:
        schema = schema.add(name, DataType.fromDDL(known.get(name.lower(), "string")))
    return schema


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The current rows of a table folder."""
    return spark.read.format(fmt).load(path.rstrip("/"))
