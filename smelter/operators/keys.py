"""Surrogate keys for dimensions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from smelter.operators.staging import stage, write_scratch
from smelter.sources.files import folder_bytes

_FILE, _ROW, _PART = "__smelter_file", "__smelter_row", "__smelter_part"

# Bytes on disk per sort task: none is made smaller than the first, nor much larger than the second.
SMALL_RANGE = 1 << 20
LARGE_RANGE = 256 << 20
# Sort tasks at most: each holds the bounds of all ranges, and the driver samples for each.
MOST_RANGES = 20_000


def surrogate_key(
    df: DataFrame,
    key: str,
    order_by: Iterable[str] = (),
    mode: str = "dense",
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Put a bigint ``key`` in front of the columns of ``df``, less those named in ``exclude``.

    ``dense`` numbers the rows from 0 without gaps in the order of ``order_by``, nulls first. Rows
    equal in all of ``order_by`` follow each other by a hash of their other columns, so the keys
    of rows that differ are the same in every run.
    ``monotonic`` gives unique keys with gaps that depend on the partitioning of the run.
    """
    rows = df.drop(key, *exclude)
    if mode == "monotonic":
        return rows.select(F.monotonically_increasing_id().alias(key), "*")
    if mode != "dense":
        raise ValueError(f"unknown key mode: {mode!r}")
    order_by = list(order_by)
    if not order_by:
        raise ValueError("dense keys need order_by")
    return _number(_sorted(rows, order_by), key)


def _located(staged: DataFrame) -> DataFrame:
    """Staged rows with the name of their file and their position in it."""
    return staged.select(
        "*",
        F.col("_metadata.file_name").alias(_FILE),
        F.col("_metadata.row_index").alias(_ROW),
    )


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, StructType):
        return any(_has_map(field.dataType) for field in kind)
    return isinstance(kind, MapType)


def _tie(rows: DataFrame, order_by: list[str]) -> list[Column]:
    """One hash of the columns that are not sorted by; maps are hashed as JSON."""
    named = {column.lower() for column in order_by}
    others = [
        F.to_json(F.struct(F.col(f"`{field.name}`"))) if _has_map(field.dataType) else F.col(f"`{field.name}`")
        for field in rows.schema
        if field.name.lower() not in named
    ]
    return [F.xxhash64(*others)] if others else []


def _sorted(rows: DataFrame, order_by: list[str]) -> DataFrame:
    """Range-partition and sort, then stage, so that every later pass sees the same ranges.

    The rows are staged before, too: their places in the files then break the last ties. That makes
    the order total, so a natural key or a group of copies that holds much of the table is cut over
    many ranges, and a retried task sends each row to the range it went to before. Range bounds hold
    the columns of ``order_by`` and three numbers.
    """
    spark = rows.sparkSession
    path = write_scratch(rows, "unsorted")
    staged = _located(spark.read.schema(rows.schema).parquet(path))
    order = [*[F.col(c) for c in order_by], *_tie(rows, order_by), F.col(_FILE), F.col(_ROW)]
    ranges = (
        staged.withColumn(_FILE, F.xxhash64(_FILE))
        .repartitionByRange(_range_count(spark, path), *order)
        .sortWithinPartitions(*order)
        .drop(_FILE, _ROW)
    )
    return stage(ranges, "sorted")


def _range_count(spark: SparkSession, path: str) -> int:
    """Ranges for the bytes in ``path``: one if a single task will do, else at least enough for
    each to be sorted in memory, up to MOST_RANGES; beyond that they spill."""
    size = folder_bytes(spark, path)
    setting = spark.conf.get("spark.sql.shuffle.partitions")
    # Some platforms take a word here, such as "auto".
    shuffle_partitions = int(setting) if setting.isdigit() else 200
    wanted = max(1, min(shuffle_partitions, size // SMALL_RANGE), -(-size // LARGE_RANGE))
    return min(wanted, MOST_RANGES)


def _number(ranges: DataFrame, key: str) -> DataFrame:
    """Key = rows in all earlier files + position in the own file.

    The offsets hold one row per file, and ``_range_count`` makes at most MOST_RANGES files: few
    enough for one window and one broadcast, however many rows the files have. They
    are staged, so that a broadcast never waits for the rows to be counted.
    """
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int")
    located = ranges.select("*", part.alias(_PART), F.col("_metadata.row_index").alias(_ROW))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        located.groupBy(_PART)
        .agg(F.count("*").alias("rows"))
        .select(_PART, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("earlier"))
    )
    return located.join(F.broadcast(stage(offsets, "offsets")), _PART).select(
        (F.col("earlier") + F.col(_ROW)).alias(key), *[F.col(f"`{c}`") for c in ranges.columns]
    )
