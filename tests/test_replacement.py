"""Tables whose writer was lost between the two renames of a replacement."""

import pytest

from smelter.operators import finish_replacements, write_table
from smelter.sources.files import rename_folder

MARK = "0123456789abcdef" * 2


def lost(spark, root, database, with_new):
    """A table as a lost driver leaves it: old rows aside, new ones not yet in place."""
    write_table(spark.range(5), root, "numbers", database=database)
    if with_new:
        spark.range(9).write.parquet(f"{root}/.numbers-{MARK}-new")
    rename_folder(spark, f"{root}/numbers", f"{root}/.numbers-{MARK}-old")


@pytest.mark.parametrize("with_new, rows", [(True, 9), (False, 5)])
def test_a_lost_replacement_is_finished(spark, tmp_path, database, with_new, rows):
    root = f"{tmp_path}/tables"
    lost(spark, root, database, with_new)
    assert finish_replacements(spark, root, database=database) == ["numbers"]
    assert spark.read.parquet(f"{root}/numbers").count() == rows
    assert spark.table(f"{database}.numbers").count() == rows
    assert sorted(p.name for p in (tmp_path / "tables").iterdir()) == ["numbers"]
    assert finish_replacements(spark, root) == []


def test_the_next_write_finishes_it_first(spark, tmp_path, database):
    """Rows that read the lost table are there again, also if the write then fails."""
    root = f"{tmp_path}/tables"
    lost(spark, root, database, True)
    failing = spark.range(3).selectExpr("raise_error('no') as id")
    with pytest.raises(Exception, match="no"):
        write_table(failing, root, "numbers", database=database)
    assert spark.table(f"{database}.numbers").count() == 9
    assert write_table(spark.range(2), root, "numbers", database=database).count() == 2


def test_other_tables_and_folders_are_left_alone(spark, tmp_path, database):
    root = f"{tmp_path}/tables"
    lost(spark, root, database, True)
    assert finish_replacements(spark, root, "other") == []
    assert finish_replacements(spark, f"{tmp_path}/nothing") == []
    write_table(spark.range(1), root, "other", database=database)
    assert finish_replacements(spark, root, database=database) == ["numbers"]
