"""Benchmark windows in documents against a plain search."""

import random

import pytest
from pyspark.sql import functions as F

import plain
from smelter.llm import contamination
from smelter.llm.queries import QUERIES

DOCS = "doc_id int, text string, x string, N_HIT string, items string, window string"
ITEMS = "item_id int, text string, size string, token string"


def check(spark, texts, items, window=10, shingle=5):
    docs = spark.createDataFrame([(i, t, *"abcd") for i, t in enumerate(texts)], DOCS)
    bench = spark.createDataFrame([(i, t, "c", "d") for i, t in items], ITEMS)
    got = {r.doc_id: r for r in contamination.contamination(docs, bench, window=window, shingle=shingle).collect()}
    assert len(got) == len(texts)
    want = plain.contamination(texts, [("" if i is None else str(i), t) for i, t in items], window)
    for i, (n, hit, found) in enumerate(want):
        row = got[i]
        assert (row.n_words, row.n_hit, row["items"], row.n_items) == (n, hit, found, len(found)), texts[i]
        assert row.contaminated == (hit > 0) and row.x == "a"
    return want


def test_defined_cases(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    long = "some other words that go on and on " * 40_000
    texts = [
        None, "", "?!", passage, passage.upper().replace(" ", "-"), "x " + passage[:60] + " y", passage,
        long, long + passage, "short one", "SHORT, one!", "one short", "solo", "w1 w2 w3 w4 w5 w6 w7 w8 w9",
        "äöü ÄÖÜ 日本", "a b " * 12,
    ]
    items = [
        (1, passage), (2, passage), (2, "short one"), (3, "solo"), (4, None), (5, ""), (6, "!"), (None, "äöü"),
        (7, "a b " * 10), (1, passage),
    ]
    want = check(spark, texts, items)
    assert want[3] == (30, 30, ["1", "2"]) and want[9][2] == ["2"] and want[14][2] == [""] and want[13][1] == 0


@pytest.mark.parametrize("window, shingle", [(6, 3), (4, 5), (3, 1)])
def test_random_texts_of_few_words(spark, window, shingle):
    rng = random.Random(window)

    def text(most):
        return " ".join(rng.choice("abc") for _ in range(rng.randint(0, most)))

    check(spark, [text(60) for _ in range(60)], [(i, text(12)) for i in range(12)], window, shingle)


def test_empty_tables(spark):
    check(spark, ["a b c"], [])
    check(spark, ["a b c"], [(1, ""), (2, None)])
    docs = spark.createDataFrame([], DOCS)
    bench = spark.createDataFrame([(1, "a", "c", "d")], ITEMS)
    assert contamination.contamination(docs, bench).collect() == []


def test_one_passage_in_a_third_of_all_documents(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    docs = spark.range(6_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("d"), "id", F.lit(" " + passage)))
        .otherwise(F.concat(F.lit("only "), "id")).alias("text"),
    )
    bench = spark.createDataFrame([(i, passage) for i in range(3)], "item_id int, text string")
    found = contamination.contamination(docs, bench).groupBy("n_hit", "n_items").count().collect()
    assert {tuple(r) for r in found} == {(20, 3, 2_000), (0, 0, 4_000)}


def test_plan_has_no_python(spark, folder, capsys):
    QUERIES["op13_contamination"](spark, folder).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan
