import pathlib
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from smelter.operators import (
    preview,
    scratch_path,
    scratch_until_done,
    stage,
    surrogate_key,
    tables,
    write_table,
    write_tables,
)
from smelter.sources import (
    list_folder,
    read_bronze,
    read_table,
    register_bronze,
    register_tables,
    show_views,
    view_name,
)
from smelter.sources.files import folder_bytes


@pytest.mark.parametrize(
    ("file", "view"),
    [
        ("SalesLT.Address.csv", "SalesLTAddress"),
        ("a.b.c", "abc"),
        ("x.csv.bak", "xcsvbak"),
        ("plain", "plain"),
    ],
)
def test_view_name_loses_ending_and_dots(file, view):
    assert view_name(file) == view


def test_list_folder(spark, tmp_path):
    (tmp_path / "b.csv").write_text("id\n1\n")
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "inner.csv").write_text("id\n1\n")
    (tmp_path / "_SUCCESS").write_text("")
    (tmp_path / ".hidden").write_text("")
    entries = list_folder(spark, str(tmp_path))
    assert [(e.name, e.is_folder) for e in entries] == [("a", True), ("b.csv", False)]
    assert entries[1].length == 5
    assert entries[1].path.endswith("/b.csv")


def test_folder_bytes(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 10)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "c").write_bytes(b"x" * 5)
    assert folder_bytes(spark, str(tmp_path)) == 15


def test_csv_types_are_inferred(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text('i,d,b,s,t\n1,1.5,True,"a,b",2008-06-01 00:00:00\n2,2.5,false,,\n')
    got = read_bronze(spark, str(file))
    assert [f.dataType.simpleString() for f in got.schema] == [
        "int", "double", "boolean", "string", "timestamp",
    ]
    assert got.first()["s"] == "a,b"


def test_csv_schema_is_checked_against_the_header(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text("a,b\n1,2\n")
    assert read_bronze(spark, str(file), "a bigint, b string").first() == (1, "2")
    with pytest.raises(Exception, match="(?i)header"):
        read_bronze(spark, str(file), "b bigint, a string").collect()


def test_csv_types_by_column_name(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text("id,Total Due,note\n1,2,3\n")
    types = {"ID": "bigint", "total due": "double", "other": "int"}
    got = read_bronze(spark, str(file), types=types)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        ("id", "bigint"), ("Total Due", "double"), ("note", "string"),
    ]
    assert got.first() == (1, 2.0, "3")


def test_a_value_that_does_not_fit_its_type_is_an_error(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text("a,b\n1,2\nx,3\n")
    for given in ({"schema": "a int, b int"}, {"types": {"a": "int"}}):
        with pytest.raises(Exception, match="(?i)malformed"):
            read_bronze(spark, str(file), **given).collect()
    assert read_bronze(spark, str(file), "a int, b int", mode="PERMISSIVE").count() == 2
    assert read_bronze(spark, str(file)).schema["a"].dataType.simpleString() == "string"


def test_glob_suffix_reads_siblings(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a\n1\n")
    (tmp_path / "x.csv.bak").write_text("a\n2\n")
    path = str(tmp_path / "x.csv")
    assert read_bronze(spark, path).count() == 1
    assert read_bronze(spark, path, glob_suffix="*").count() == 2


def test_register_bronze(spark, tmp_path):
    (tmp_path / "SalesLT.One.csv").write_text("a,b\n1,x\n")
    spark.range(20).repartition(3).write.csv(str(tmp_path / "SalesLT.Two.csv"), header=True)
    views = register_bronze(spark, str(tmp_path), {"SALESLTONE": "a bigint, b string"})
    assert list(views) == ["SalesLTOne", "SalesLTTwo"]
    assert spark.table("salesltone").schema["a"].dataType.simpleString() == "bigint"
    assert spark.sql("SELECT * FROM saleslttwo").count() == 20
    names = {row.viewName for row in show_views(spark).collect()}
    assert {"salesltone", "saleslttwo"} <= names


def test_given_schemas_start_no_job(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a\n1\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("register", "")
    register_bronze(spark, str(tmp_path), {"one": "a int"})
    jobs = tracker.getJobIdsForGroup("register")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0


def test_overwrite_replaces_rows_and_schema(spark, tmp_path, database):
    root = str(tmp_path / "silver")
    write_table(spark.range(5), root, "numbers", database=database)
    other = spark.createDataFrame([("x", 1.5)], "s string, d double")
    got = write_table(other, root, "numbers", database=database)
    assert [tuple(r) for r in got.collect()] == [("x", 1.5)]
    assert read_table(spark, f"{root}/numbers/").columns == ["s", "d"]
    kind = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.numbers").where("col_name = 'Type'")
    assert kind.first()["data_type"] == "EXTERNAL"


def fail_at(spark, n):
    """Rows 0 to n - 1, then an error."""

    def rows(batches):
        for batch in batches:
            yield batch[batch.id < n]
            raise RuntimeError("broken row")

    return spark.range(0, 2 * n, 1, 1).mapInPandas(rows, "id bigint")


def test_a_failed_write_leaves_the_old_table(spark, tmp_path, database):
    root = str(tmp_path / "silver")
    write_table(spark.range(5), root, "numbers", database=database)
    with pytest.raises(Exception, match="broken row"):
        write_table(fail_at(spark, 3), root, "numbers", database=database)
    assert spark.table(f"{database}.numbers").count() == 5
    assert read_table(spark, f"{root}/numbers").count() == 5
    assert [entry.name for entry in list_folder(spark, root)] == ["numbers"]
    assert [p.name for p in (tmp_path / "silver").iterdir()] == ["numbers"]


def test_a_failed_catalog_entry_leaves_the_old_table(spark, tmp_path, database, monkeypatch):
    root = str(tmp_path / "silver")
    write_table(spark.range(5), root, "numbers", database=database)
    enter, calls = tables._enter, []

    def fail_first(*arguments):
        calls.append(arguments)
        if len(calls) == 1:
            raise RuntimeError("no catalog")
        enter(*arguments)

    monkeypatch.setattr(tables, "_enter", fail_first)
    with pytest.raises(RuntimeError, match="no catalog"):
        write_table(spark.range(9), root, "numbers", database=database)
    assert spark.table(f"{database}.numbers").count() == 5
    assert read_table(spark, f"{root}/numbers").count() == 5


def test_a_table_may_be_replaced_by_a_part_of_itself(spark, tmp_path, database):
    root = str(tmp_path / "silver")
    write_table(spark.range(5), root, "numbers", database=database)
    got = write_table(
        read_table(spark, f"{root}/numbers").where("id > 1"), root, "numbers", database=database
    )
    assert sorted(r.id for r in got.collect()) == [2, 3, 4]
    got = write_table(spark.table(f"{database}.numbers").where("id > 2"), root, "numbers", database=database)
    assert sorted(r.id for r in got.collect()) == [3, 4]
    assert read_table(spark, f"{root}/numbers").count() == 2


@pytest.mark.parametrize(
    "names", [("Sales.Order.csv", "SalesOrder.csv"), ("SalesOrder.csv", "salesorder.csv")]
)
def test_files_with_one_view_name_are_an_error(spark, tmp_path, names):
    for name in names:
        (tmp_path / name).write_text("a\n1\n")
    with pytest.raises(ValueError) as error:
        register_bronze(spark, str(tmp_path))
    assert all(name in str(error.value) for name in names)


def test_listed_paths_are_no_patterns(spark, tmp_path):
    (tmp_path / "Sales[1].csv").write_text("a\n1\n")
    (tmp_path / "Sales1.csv").write_text("a\n2\n3\n")
    views = register_bronze(spark, str(tmp_path))
    assert {name: view.count() for name, view in views.items()} == {"Sales[1]": 1, "Sales1": 2}


def test_scratch_is_deleted_when_done(spark, tmp_path, database):
    base = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(base.iterdir()) if base.exists() else set()
    built = {"keyed": lambda: surrogate_key(spark.range(50), "key", ["id"])}
    written = write_tables(spark, built, str(tmp_path), database=database)
    assert written["keyed"].where("key = id").count() == 50
    assert set(base.iterdir()) == before
    with pytest.raises(RuntimeError), scratch_until_done(spark):
        stage(spark.range(3))
        raise RuntimeError
    assert set(base.iterdir()) == before


def test_files_outlive_the_catalog_entry(spark, tmp_path, database):
    root = str(tmp_path / "silver")
    write_table(spark.range(5), root, "numbers", database=database)
    spark.sql(f"DROP TABLE {database}.numbers")
    assert read_table(spark, f"{root}/numbers").count() == 5


def test_temp_view_shadows_table_but_not_the_written_one(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("shadowed")
    written = write_table(spark.range(7), str(tmp_path), "shadowed")
    assert spark.table("shadowed").count() == 3
    assert spark.sql("SELECT * FROM Shadowed").count() == 3
    assert written.count() == 7
    spark.catalog.dropTempView("shadowed")
    assert spark.table("shadowed").count() == 7
    spark.sql("DROP TABLE shadowed")


def test_register_tables(spark, tmp_path, database):
    root = str(tmp_path / "silver")
    write_table(spark.range(4), root, "firstTable", database=database)
    write_table(spark.range(6), root, "secondTable", database=database)
    views = register_tables(spark, root + "/")
    assert list(views) == ["firstTable", "secondTable"]
    assert spark.table("FIRSTTABLE").count() == 4
    assert spark.table("secondtable").count() == 6


def test_other_formats(spark, tmp_path, database):
    write_table(spark.range(4), str(tmp_path), "numbers", fmt="orc", database=database)
    assert read_table(spark, str(tmp_path / "numbers"), "orc").count() == 4


def test_delta_is_passed_on_to_spark(spark, tmp_path, database):
    """Its jar is not here; what can be checked is that Spark is asked for it."""
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        write_table(spark.range(1), str(tmp_path), "numbers", fmt="delta", database=database)
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        read_table(spark, str(tmp_path), "delta")


def test_preview_is_a_limit(spark):
    got = preview(spark.range(1000), 5)
    assert got.count() == 5
    assert re.search(r"\w*Limit 5", got._jdf.queryExecution().optimizedPlan().toString())


def test_scratch_without_the_setting(tmp_path):
    """Alone on one machine a temporary folder will do; on a cluster it would not be shared."""

    class Context:
        checkpoint = None

        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return self.checkpoint

        def setCheckpointDir(self, folder):
            self.checkpoint = folder

    def session(master):
        conf = SimpleNamespace(get=lambda name, default: default)
        return SimpleNamespace(conf=conf, sparkContext=Context(master))

    local = session("local[4]")
    first, second = scratch_path(local, "x"), scratch_path(local, "x")
    assert first != second
    assert first.rsplit("/", 2)[0] == second.rsplit("/", 2)[0] == local.sparkContext.checkpoint
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(session("spark://host:7077"), "x")


def test_scratch_is_below_the_configured_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(base) and two.startswith(base) and one != two


def test_view_columns_reach_the_scan(spark, tmp_path, database):
    rows = spark.range(4).select("id", F.lit("w").alias("wide"))
    write_table(rows, str(tmp_path), "numbers", database=database)
    plan = read_table(spark, str(tmp_path / "numbers")).where("id > 2").select("id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in text
    assert "GreaterThan(id,2)" in text
