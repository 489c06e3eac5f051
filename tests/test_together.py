import threading

import pytest

from smelter.together import together


def test_results_keep_their_order(spark):
    assert together(spark, *[lambda n=n: spark.range(n).count() for n in (3, 1, 2)]) == [3, 1, 2]


def test_builds_overlap(spark):
    barrier = threading.Barrier(2, timeout=30)
    together(spark, barrier.wait, barrier.wait)


def test_errors_reach_the_caller(spark):
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: 1 / 0, lambda: spark.range(1).count())


def test_nothing_to_do(spark):
    assert together(spark) == []
