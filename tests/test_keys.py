import random
import re

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from smelter.operators import surrogate_key, write_table
from smelter.operators import keys as keys_module


def keyed(frame, order_by):
    return [tuple(row) for row in surrogate_key(frame, "key", order_by).orderBy("key").collect()]


def test_dense_keys_follow_the_order(spark):
    frame = spark.range(1000).select((F.col("id") * 37 % 1000).alias("n"), F.lit("x").alias("x"))
    assert keyed(frame, ["n"]) == [(n, n, "x") for n in range(1000)]


def test_dense_keys_do_not_depend_on_partitioning(spark):
    frame = spark.range(500).selectExpr("id % 50 AS a", "id % 7 AS b", "id")
    order = ["a", "b", "id"]
    assert keyed(frame.repartition(7), order) == keyed(frame.coalesce(1), order)


def test_null_keys_come_first_and_descending_duplicates_stay_whole(spark):
    rows = [(None, 1), (2, 1), (None, 2), (1, 1), (1, 1)]
    frame = spark.createDataFrame(rows, "n int, v int")
    got = keyed(frame, ["n", "v"])
    assert got == [(0, None, 1), (1, None, 2), (2, 1, 1), (3, 1, 1), (4, 2, 1)]


def test_a_hot_group_of_copies_is_cut_over_ranges(spark, monkeypatch):
    """A third of the rows are copies of one row; no range may hold them all."""
    monkeypatch.setattr(keys_module, "SMALL_RANGE", 10_000)
    n = 30_000
    frame = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(18)).otherwise(F.col("id")).alias("n")
    )
    ranges = keys_module._sorted(frame, ["n"])
    sizes = [
        (row["count"], row["hot"])
        for row in ranges.groupBy(F.col("_metadata.file_name"))
        .agg(F.count("*").alias("count"), F.sum((F.col("n") == 18).cast("int")).alias("hot"))
        .collect()
    ]
    assert sum(count for count, _ in sizes) == n
    assert sum(hot > 0 for _, hot in sizes) >= 2
    assert max(count for count, _ in sizes) < n / 4
    keys = surrogate_key(frame, "key", ["n"])
    assert keys.agg(F.min("key"), F.max("key"), F.countDistinct("key")).first() == (0, n - 1, n)
    assert keys.where("n = 18").agg(F.max("key") - F.min("key") + 1, F.count("*")).first() == (
        n // 3,
        n // 3,
    )


@pytest.mark.parametrize("seed", range(4))
def test_dense_keys_equal_a_sort_by_hand(spark, monkeypatch, seed):
    """Random rows with nulls, copies and equal keys, over one range and over several."""
    monkeypatch.setattr(keys_module, "SMALL_RANGE", 500 if seed % 2 else 1 << 20)
    draw = random.Random(seed)
    rows = [
        (draw.choice([None, 1, 1, 2, draw.randrange(50)]), draw.choice([None, "", "a", "b", "é"]))
        for _ in range(300)
    ]
    frame = spark.createDataFrame(rows, "n int, s string").repartition(5)
    by_hand = sorted(rows, key=lambda r: [(v is not None, v) for v in r])
    assert keyed(frame, ["n", "s"]) == [(i, *row) for i, row in enumerate(by_hand)]


@pytest.mark.parametrize(
    ("size", "ranges"), [(0, 1), (100, 1), (1000, 1), (3999, 3), (10_000, 8), (1_000_000, 100)]
)
def test_ranges_follow_the_bytes(spark, monkeypatch, tmp_path, size, ranges):
    monkeypatch.setattr(keys_module, "SMALL_RANGE", 1000)
    monkeypatch.setattr(keys_module, "LARGE_RANGE", 10_000)
    (tmp_path / "part-0").write_bytes(b"x" * size)
    assert keys_module._range_count(spark, str(tmp_path)) == ranges


def test_keys_over_many_ranges_are_dense_and_ordered(spark, monkeypatch):
    monkeypatch.setattr(keys_module, "SMALL_RANGE", 10_000)
    frame = spark.range(40_000).selectExpr("id * 7919 % 40000 AS n", "rand(1) AS x")
    got = surrogate_key(frame, "key", ["n"])
    assert got.where("key <> n").count() == 0
    assert got.count() == 40_000


def test_keys_hold_where_one_file_is_read_by_many_tasks(spark, conf):
    conf(parquet__block__size="20000", spark__sql__files__maxPartitionBytes="20000")
    frame = spark.range(300_000).selectExpr("id * 7919 % 300000 AS n", "md5(string(id)) AS x")
    got = surrogate_key(frame, "key", ["n"])
    parts = got.groupBy(F.spark_partition_id()).count().count()
    assert parts > 2
    assert got.where("key <> n").count() == 0
    assert got.agg(F.countDistinct("key")).first()[0] == 300_000


def test_keys_need_neither_window_nor_shuffle_when_read(spark):
    """What is left to do per row is a lookup in the staged file offsets."""
    frame = surrogate_key(spark.range(100), "key", ["id"])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange hash" not in plan
    assert plan.count("BroadcastExchange") == 1
    small = plan[plan.index("BroadcastExchange") :]
    assert "ReadSchema: struct<__smelter_part:int,earlier:bigint>" in small


def test_range_bounds_hold_no_text(spark):
    """Beside the natural key: one hash of all other columns, and the row's place in two numbers."""
    frame = spark.createDataFrame([(1, "x", {"k": "v"})], "n int, wide string, m map<string,string>")
    ranges = keys_module._sorted(frame, ["n"])
    assert ranges.columns == ["n", "wide", "m"]
    staged = keys_module._located(ranges).withColumn("__smelter_file", F.xxhash64("__smelter_file"))
    (tie,) = keys_module._tie(frame, ["n"])
    order = staged.select("n", tie.alias("tie"), "__smelter_file", "__smelter_row")
    assert [f.dataType.simpleString() for f in order.schema] == ["int"] + ["bigint"] * 3


def test_ranges_have_an_upper_bound(spark, conf, monkeypatch, tmp_path):
    monkeypatch.setattr(keys_module, "LARGE_RANGE", 10)
    monkeypatch.setattr(keys_module, "MOST_RANGES", 7)
    (tmp_path / "part-0").write_bytes(b"x" * 1000)
    assert keys_module._range_count(spark, str(tmp_path)) == 7


def test_failed_tasks_are_repeated_without_trace(spark, tmp_path, database):
    """Each task over the input writes some rows, fails once, and runs again."""

    def fail_once(batches):
        for batch in batches:
            yield batch
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")

    frame = spark.range(0, 2000, 1, 4).select((F.col("id") * 7 % 2000).alias("n"))
    frame = frame.mapInPandas(fail_once, "n bigint")
    keys = write_table(
        surrogate_key(frame, "key", ["n"]), str(tmp_path), "numbers", database=database
    )
    assert sorted(map(tuple, keys.collect())) == [(n, n) for n in range(2000)]


def test_monotonic_keys_are_unique(spark):
    frame = surrogate_key(spark.range(1000).repartition(5), "key", mode="monotonic")
    assert frame.columns == ["key", "id"]
    assert frame.select("key").distinct().count() == 1000


def test_exclude_and_replace_columns(spark):
    frame = spark.createDataFrame([(1, 2, 3)], "key int, a int, b int")
    got = surrogate_key(frame, "key", ["a"], exclude=["b", "c.Name"])
    assert got.columns == ["key", "a"]
    assert got.schema["key"].dataType.simpleString() == "bigint"
    assert got.first() == (0, 2)


def test_empty_input(spark):
    frame = surrogate_key(spark.createDataFrame([], "a int, b string"), "key", ["a"])
    assert frame.columns == ["key", "a", "b"]
    assert frame.count() == 0


@pytest.mark.parametrize("arguments", [{"mode": "other"}, {"order_by": []}])
def test_wrong_arguments(spark, arguments):
    with pytest.raises(ValueError):
        surrogate_key(spark.range(1), "key", **arguments)


def test_only_needed_columns_are_read(spark):
    frame = spark.range(10).select("id", F.lit("wide").alias("wide"))
    plan = surrogate_key(frame, "key", ["id"]).select("key", "id")._jdf.queryExecution()
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan.executedPlan().toString()):
        assert "wide" not in schema
