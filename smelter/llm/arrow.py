"""Results computed in Python from Arrow batches, with the other columns left in the JVM."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from smelter.llm.words import slices


def release() -> None:
    """Give memory that a task has freed back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        return  # not the GNU allocator


def releasing(values: Iterator) -> Iterator:
    """``values``; once they end, memory is released."""
    try:
        yield from values
    finally:
        release()


def from_texts(compute: Callable[[pa.Array], pa.Array], kind: str) -> Callable[[Column], Column]:
    """An Arrow function of one text column, called with a bounded number of bytes at a time.

    Results leave part by part, so a batch of long texts never has all its results in memory.
    """

    @F.arrow_udf(kind)
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from releasing(compute(part) for column in columns for part in slices(column))

    return run
