"""Durable intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from smelter.sources.files import delete_folder

# Scratch folders made since the innermost ``scratch_until_done`` began; None outside of one.
_MADE: ContextVar[list[str] | None] = ContextVar("smelter_scratch", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below ``spark.checkpoint.dir``.

    Only a local master may do without that setting: its driver and tasks share one disk.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="smelter-")
        context.setCheckpointDir(base)
    folder = f"{base}/smelter-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(folder)
    return f"{folder}/{label}"


@contextmanager
def scratch_until_done(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders that are made inside once it is left, also after an error.

    For steps that end with a write: nothing that reads scratch may be used afterwards.
    """
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for folder in made:
            delete_folder(spark, folder)


def write_scratch(df: DataFrame, label: str) -> str:
    """Write ``df`` to a scratch path, one file per task, and return the path."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", 0).parquet(path)
    return path


def stage(df: DataFrame, label: str = "rows") -> DataFrame:
    """Write ``df`` once and return it read back.

    Cuts lineage, so a lost executor replays the read and not the plan before it. The copy is
    columnar, so later steps read only the columns they need, and its size is known to the
    optimizer.
    """
    path = write_scratch(df, label)
    return df.sparkSession.read.schema(df.schema).parquet(path)
