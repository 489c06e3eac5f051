"""A Bloom filter as a small table of 64-bit words, which a broadcast join tests in the JVM.

Each hash sets three bits of one word. The table never has more than MOST_WORDS rows, however many
hashes go in; beyond four hashes a word it only lets more rows through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 64-bit words at most: 2M words are 16 MB of bits.
MOST_WORDS = 1 << 21

_HASHES_PER_WORD = 4


def _mask(hashed: Column) -> Column:
    """Three bits of a word, from bits of the hash that do not choose the word."""
    one = F.lit(1).cast("long")
    bits = [
        F.call_function("shiftleft", one, F.shiftrightunsigned(hashed, at).bitwiseAND(63).cast("int"))
        for at in (40, 46, 52)
    ]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def flagged(
    rows: DataFrame, column: str, hashes: DataFrame, flag: str, most_words: int = MOST_WORDS
) -> DataFrame:
    """``rows`` with ``flag``: false if the hash in ``column`` is surely not among ``hashes``.

    ``hashes`` has one column of 64-bit hashes and is read twice: stage it. Nothing is shuffled but
    the words of the filter.
    """
    if most_words < 1 or most_words & (most_words - 1):
        raise ValueError("most_words must be a power of two")
    wanted = max(1, hashes.count() // _HASHES_PER_WORD)
    words = min(1 << (wanted - 1).bit_length(), most_words)
    (hashed,) = [F.col(c) for c in hashes.columns]
    table = hashes.groupBy(hashed.bitwiseAND(words - 1).alias("__word")).agg(
        F.bit_or(_mask(hashed)).alias("__bits")
    )
    own = F.col(column)
    tested = rows.withColumn("__word", own.bitwiseAND(words - 1)).join(
        F.broadcast(table), "__word", "left"  # at most ``most_words`` rows of two longs
    )
    possible = F.coalesce(F.col("__bits").bitwiseAND(_mask(own)) == _mask(own), F.lit(False))
    return tested.withColumn(flag, possible).drop("__word", "__bits")
