"""Independent jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")

MOST_JOBS = 16


def together(spark: SparkSession, *builds: Callable[[], Result]) -> list[Result]:
    """Run functions that start Spark jobs side by side; return their results in order.

    The last tasks of one job leave executors idle; the other jobs use them.
    """
    with ThreadPoolExecutor(max_workers=MOST_JOBS) as pool:
        futures = [
            pool.submit(copy_context().run, inheritable_thread_target(spark)(build))
            for build in builds
        ]
        return [future.result() for future in futures]
