"""Exact duplicates by two-pass Bloom filtering, in DataFrame functions only.

Pass one fills a Bloom filter of 64-bit words: a row's hash chooses a word and one bit of it. Tasks
fill words of their own, the OR of their rows' bits and the number of their rows, before these are
merged; no row or hash of a row moves. Where a word has more rows than bits, a hash may be repeated.
Pass two tests every row, where it lies, against a second Bloom filter, of those words: rows that
miss it are unique and pass straight through, and only the others shuffle to be grouped by their
full SHA-256. A false positive costs a shuffled row, never a wrong result.

The first filter has two words a row, within a bound; it lies spread over all tasks and only its
words with repetitions go on. Beyond the bound its words fill up, and more rows shuffle.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.bloom import MOST_WORDS, flagged
from smelter.llm.tables import named, with_results
from smelter.operators import stage


#: Words of the first filter at most: 1 GB of bits.
MOST_CELL_WORDS = 1 << 27


def normalised(text: Column) -> Column:
    """A-Z lower-cased and nothing else; null counts as the empty text."""
    return F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``text_sha256``, the SHA-256 of the normalised text in lower-case hex."""
    return with_results(docs, {"text_sha256": F.sha2(normalised(named(text)), 256)})


def _repeating(hashed: DataFrame) -> DataFrame:
    """(cell): the words of the first filter, by a hash of their number, that hold more rows than
    bits; ``hashed`` has their numbers in ``__word_of`` and a hash in ``__hash``."""
    bit = F.shiftrightunsigned("__hash", 58).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    filled = hashed.groupBy("__word_of").agg(F.bit_or(one).alias("bits"), F.count("*").alias("rows"))
    return filled.where(F.col("rows") > F.bit_count("bits")).select(F.xxhash64("__word_of").alias("cell"))


def exact_dedup(
    rows: DataFrame,
    key: str = "doc_id",
    most_words: int = MOST_WORDS,
    most_cell_words: int = MOST_CELL_WORDS,
) -> DataFrame:
    """``rows`` with ``text_sha256`` and, for each, the row of its group that stays.

    Adds ``keep_id`` (the largest ``key`` of the group), ``group_size`` and ``kept``. ``rows`` is
    read several times: stage it if it is dear to compute (see ``mark_copies``).

    Defined cases: a null key loses to any other; a group of null keys only has a null ``keep_id``
    and keeps its rows; rows that repeat both text and key are kept or dropped alike, as nothing
    tells them apart; an empty table gives an empty result; input columns named like a result are
    replaced.
    """
    if most_cell_words < 1 or most_cell_words & (most_cell_words - 1):
        raise ValueError("most_cell_words must be a power of two")
    words = min(1 << (2 * max(rows.count(), 1) - 1).bit_length(), most_cell_words)
    hashed = rows.withColumn("__hash", F.xxhash64("text_sha256"))
    hashed = hashed.withColumn("__word_of", F.col("__hash").bitwiseAND(words - 1))
    repeated = stage(_repeating(hashed), "repeating-words")
    hashed = hashed.withColumn("__cell", F.xxhash64("__word_of"))
    tested = flagged(hashed, "__cell", repeated, "__possible", most_words)
    tested = tested.drop("__hash", "__word_of", "__cell")
    own = named(key)
    unique = tested.where(~F.col("__possible")).drop("__possible")
    suspects = tested.where(F.col("__possible")).drop("__possible")
    groups = suspects.groupBy(F.col("text_sha256").alias("__sha")).agg(
        F.max(own).alias("__keep"), F.count("*").alias("__size")
    )
    # Staged, so that both inputs of the join are bare shuffles and Spark can split a large group.
    groups = stage(groups, "groups")
    copies = suspects.join(groups, F.col("text_sha256") == F.col("__sha")).drop("__sha")
    return with_results(
        unique.select("*", own.alias("__keep"), F.lit(1).cast("long").alias("__size")).unionByName(
            copies
        ),
        {
            "keep_id": F.col("__keep"),
            "group_size": F.col("__size"),
            "kept": own.eqNullSafe(F.col("__keep")),
        },
    ).drop("__keep", "__size")


def mark_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``exact_dedup`` on (key, hash) rows alone: texts are read once and never shuffled."""
    narrow = fingerprints(docs.select(named(key).alias(key), named(text).alias(text)), text)
    return exact_dedup(stage(narrow.drop(text), "fingerprints"), key)
