"""A training corpus from ``documents``: five stages, each an operator of ``smelter.llm``.

Each stage gets what its predecessor kept, written as Parquet and read again. All but the last
return the columns of ``documents``; rows are dropped by the toxicity and near-duplicate stages
only, and lines by the line stage. The mix is the order of the rows in the files of its stage, and
the last stage numbers it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smelter.llm import bpe, line_dedup, minhash, mixing, toxicity
from smelter.llm.tables import table, with_results
from smelter.operators import stage

#: A line on more than this share of a source's documents is boilerplate. Stricter than for pages:
#: what goes here is gone before near copies are looked for.
MOST_SHARE = 0.1
#: A document that would lose more than this share of its lines is a near copy of others of its
#: source. It stays whole, for the next stage to judge.
MOST_LOST = 0.5

#: A classifier and graph components cannot be stated in SQL; the tests hold the rows against brute
#: force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; learnt from the labels of those that are not held
    out.
    """
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are frequent within their source; ``n_chars`` is counted
    anew.
    """
    cleaned = line_dedup.line_dedup(docs, "source", most_share=MOST_SHARE, most_lost=MOST_LOST)
    length = F.length("text").cast("long")
    return with_results(cleaned, {"n_chars": length}).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near copies: five-word shingles, 0.8 or more.
    """
    return minhash.drop_near_copies(docs, width=5, similarity=0.8)


def interleave(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, ordered so that each prefix has the sources' target shares."""
    mixed = mixing.mix(docs, mixing.proportional_weights(docs))
    return mixed.repartitionByRange("position").sortWithinPartitions("position").select(*docs.columns)


def _ranked(docs: DataFrame) -> DataFrame:
    """``docs`` with ``mix_rank``: the number of rows before each in the files they were read from.

    It is null for rows that were not read from files.
    """
    try:
        placed = docs.select(
            "*",
            F.col("_metadata.file_name").alias("__file"),
            F.col("_metadata.row_index").alias("__row"),
        )
    except AnalysisException:
        return docs.withColumn("mix_rank", F.lit(None).cast("long"))
    part = F.regexp_extract("__file", r"^part-(\d+)", 1).cast("int")
    before = Window.orderBy(part, "__file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("__file").agg(F.count("*").alias("n"))
    # One row per file: as small as it is, Spark broadcasts it.
    offsets = sizes.select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    ranked = placed.join(stage(offsets, "offsets"), "__file")
    return with_results(ranked, {"mix_rank": F.col("__before") + F.col("__row")}).drop(
        "__file", "__row", "__before"
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, ``n_chars``, ``mix_rank``, ``n_tokens`` and ``ids`` of each
    document.
    """
    encoded = bpe.encode(_ranked(docs))
    n_tokens = F.floor(F.octet_length("ids") / 4).cast("long")
    return encoded.select(
        "doc_id", "lang", "source", "n_chars", "mix_rank", n_tokens.alias("n_tokens"), "ids"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_near_copies),
    ("mixing", interleave),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
