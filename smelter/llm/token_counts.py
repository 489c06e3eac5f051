"""An exact histogram of encoded lengths, which answers questions about every context limit.

Documents are counted by length in one aggregate that is combined on the map side. Sums over the
longer lengths then tell, for any limit, how many documents and tokens exceed it and how many tokens
are left when each document is cut at the limit.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smelter.llm.tables import named

#: Lengths that are summed together; sums over the rest go from band to band.
BAND = 1_024


def length_histogram(rows: DataFrame, length: str = "n_tokens") -> DataFrame:
    """(n_tokens, n_docs) for each length that occurs; rows without a length are left out."""
    own = named(length).cast("long")
    return (
        rows.where(own.isNotNull()).groupBy(own.alias("n_tokens")).agg(F.count("*").alias("n_docs"))
    )


def suffix_sums(histogram: DataFrame, band: int = BAND) -> DataFrame:
    """One row per length L, with what a context limit of L tokens means.

    ``n_docs`` documents have L tokens; ``docs_at_least`` and ``tokens_at_least`` count those of L
    or more, ``docs_up_to`` those of L or fewer; ``truncated_tokens`` is the total after cutting
    each document at L. The window over bands holds one row per BAND lengths, those within them BAND
    rows.

    An empty histogram gives an empty result.
    """
    tokens = F.col("n_tokens") * F.col("n_docs")
    banded = histogram.withColumn("band", F.floor(F.col("n_tokens") / band).cast("long"))
    bands = banded.groupBy("band").agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"))
    later = Window.orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    everything = Window.partitionBy()
    beyond = bands.select(
        "band",
        F.sum("docs").over(everything).alias("all_docs"),
        F.sum("tokens").over(everything).alias("all_tokens"),
        F.coalesce(F.sum("docs").over(later), zero).alias("docs_beyond"),
        F.coalesce(F.sum("tokens").over(later), zero).alias("tokens_beyond"),
    )
    own = Window.partitionBy("band").orderBy(F.desc("n_tokens"))
    at_least = (
        banded.withColumn("docs", F.sum("n_docs").over(own))
        .withColumn("tokens", F.sum(tokens).over(own))
        .join(beyond, "band")
        .withColumn("docs_at_least", F.col("docs") + F.col("docs_beyond"))
        .withColumn("tokens_at_least", F.col("tokens") + F.col("tokens_beyond"))
    )
    shorter = F.col("all_tokens") - F.col("tokens_at_least")
    return at_least.select(
        "n_tokens",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_up_to"),
        (shorter + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
    )


def at_limits(spark: SparkSession, sums: DataFrame, limits: Iterable[int]) -> DataFrame:
    """Totals for any limits, occurring as lengths or not: (limit, docs_over, truncated_tokens).

    Everything longer than a limit starts at the next length that occurs; one pass finds them all.
    """
    limits = sorted({int(x) for x in limits})
    longer = F.struct("n_tokens", "docs_at_least", "tokens_at_least")
    found = sums.agg(
        F.coalesce(F.max("tokens_at_least"), F.lit(0)),
        *[F.min(F.when(F.col("n_tokens") > limit, longer)) for limit in limits],
    ).first()
    rows = [
        (limit, over.docs_at_least, found[0] - over.tokens_at_least + limit * over.docs_at_least)
        if over
        else (limit, 0, found[0])
        for limit, over in zip(limits, found[1:])
    ]
    return spark.createDataFrame(rows, "limit long, docs_over long, truncated_tokens long")


def quantiles(spark: SparkSession, sums: DataFrame, shares: Iterable[float]) -> DataFrame:
    """(share, n_tokens): the shortest length that at least the share of documents do not exceed."""
    shares = sorted({float(x) for x in shares})
    total = sums.agg(F.max("docs_at_least")).first()[0] or 0
    lengths = [F.min(F.when(F.col("docs_up_to") >= x * total, F.col("n_tokens"))) for x in shares]
    found = sums.agg(F.lit(0), *lengths).first()[1:]
    return spark.createDataFrame(list(zip(shares, found)), "share double, n_tokens long")
