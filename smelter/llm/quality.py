"""Quality rules and a log-likelihood ratio of hashed n-grams.

Byte n-grams of all texts are counted in hashed buckets, once over the raw corpus and once over a
trusted target. A text's score is the mean over its n-grams of log(target share / raw share) of the
bucket, so it does not depend on its length. Every text at or above a fixed threshold is kept;
nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.arrow import from_texts, release
from smelter.llm.bloom import flagged
from smelter.llm.tables import apart, named, with_results
from smelter.llm.words import (
    SLICE,
    buffers,
    column_of,
    find_words,
    is_long,
    line_hashes,
    mix,
    pieces,
    run_hashes,
    shingles,
    slices,
)
from smelter.operators import scratch_until_done, stage

#: Bytes of an n-gram, and buckets: the model is one number for each, whatever the corpus.
GRAM = 4
BUCKETS = 1 << 18
#: Counts that each bucket is given before it is counted.
SMOOTHING = 1.0
#: Mean log ratio below which a text looks unlike the target.
THRESHOLD = -0.5

# Symbols that count, and the windows of repeated words.
SYMBOLS = "#*$%&|<>"
WINDOW = 5

_BASE = "n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint, n_repeat_words: bigint"


def _per_text(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marked bytes each text has."""
    sums = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


_SPACES, _SYMBOLS = np.zeros(256, bool), np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOLS[list(SYMBOLS.encode())] = True
#: Cells in which the windows of a long text are counted at most; with more windows, more of them
#: are counted again by their whole hash.
_CELLS = 1 << 24


def _word_chars(data: np.ndarray) -> np.ndarray:
    """Whether each byte is the first one of a code point in a word."""
    return ((data & 0xC0) != 0x80) & ~_SPACES[data]


def base_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """What the rules look at, for each text."""
    if is_long(column):
        return _long_base_counts(buffers(column)[0])
    words = find_words(column, fold=False)
    n, counts = len(words), words.counts()

    lines = find_words(column, fold=False, separators=(0x0A,))
    solid = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    line_text = lines.text_of()[solid]
    keys = mix(lines.hash[solid] ^ mix(line_text.astype(np.uint64)))
    _, first = np.unique(keys, return_index=True)
    distinct = np.bincount(line_text[first], minlength=n)

    hashes, bounds = shingles(words, WINDOW)
    runs = np.diff(bounds)
    owner = np.repeat(np.arange(n), runs)
    full = counts[owner] >= WINDOW
    keys = mix(hashes[full] ^ mix(owner[full].astype(np.uint64)))
    _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
    at = (words.first[:-1][owner] + np.arange(len(owner)) - bounds[:-1][owner])[full][times[which] > 1]
    cover = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    repeated = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    return {
        "n_words": counts.astype(np.int64),
        "word_chars": _per_text(_word_chars(words.data), words.offsets),
        "n_symbols": _per_text(_SYMBOLS[words.data], words.offsets),
        "n_dup_lines": np.bincount(line_text, minlength=n) - distinct,
        "n_repeat_words": repeated[words.first[1:]] - repeated[words.first[:-1]],
    }


def _long_base_counts(data: np.ndarray) -> dict[str, np.ndarray]:
    """``base_counts`` of one text, piece by piece: 1 byte a word stays, and the hashes of what
    repeats."""
    chars = symbols = n_words = 0
    for piece in pieces(data):
        chars += int(_word_chars(piece).sum())
        symbols += int(_SYMBOLS[piece].sum())
        n_words += len(find_words(column_of(piece), fold=False).start)
    lines = np.concatenate([np.zeros(0, np.uint64), *line_hashes(data)])
    lines.sort()
    counts = [n_words, chars, symbols, int((lines[1:] == lines[:-1]).sum()), _long_repeats(data, n_words)]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return {name: np.array([count], np.int64) for name, count in zip(names, counts)}


def _long_repeats(data: np.ndarray, n_words: int) -> int:
    """Words in windows that occur twice or more in one text.

    Windows are first counted in cells by a few bits of their hash; only those in a cell that is
    hit twice are told apart by their whole hash.
    """
    if n_words < WINDOW:
        return 0
    size = min(_CELLS, 1 << (4 * n_words - 1).bit_length())
    seen, twice = np.zeros(size, bool), np.zeros(size, bool)
    for hashes in run_hashes(data, WINDOW, fold=False):
        cells = (hashes & np.uint64(size - 1)).astype(np.int64)
        twice[cells[seen[cells]]] = True
        cells.sort()
        twice[cells[1:][cells[1:] == cells[:-1]]] = True
        seen[cells] = True
    del seen
    values, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for hashes in run_hashes(data, WINDOW, fold=False):
        own = hashes[twice[(hashes & np.uint64(size - 1)).astype(np.int64)]]
        values, which = np.unique(np.concatenate([values, own]), return_inverse=True)
        more = np.bincount(which[len(times) :], minlength=len(values))
        more[which[: len(times)]] += times
        times = more
    often = values[times > 1]
    covered = np.zeros(n_words, bool)
    at = 0
    for hashes in run_hashes(data, WINDOW, fold=False):
        place = np.minimum(np.searchsorted(often, hashes), max(len(often) - 1, 0))
        hit = np.flatnonzero(often[place] == hashes) + at if len(often) else np.zeros(0, np.int64)
        for i in range(WINDOW):
            covered[hit + i] = True
        at += len(hashes)
    return int(covered.sum())


def _grams(data: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of the n-grams that start at each byte but the last few."""
    if len(data) < GRAM:
        return np.zeros(0, np.int64)
    total = np.zeros(len(data) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        total = (total << np.uint64(8)) | data[i : len(data) - GRAM + 1 + i]
    return (mix(total) & np.uint64(buckets - 1)).astype(np.int64)


def _parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """A text's bytes in overlapping parts, so that each n-gram is in one of them."""
    for at in range(0, max(1, len(data) - GRAM + 1), SLICE):
        yield data[at : at + SLICE + GRAM - 1]


def _gram_counts(buckets: int):
    """Rows of (text) to (bucket, n): one row per bucket that the partition has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch.column("text")):
                data, offsets = buffers(part)
                for at, to in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    for own in _parts(data[at:to]):
                        np.add.at(total, _grams(own, buckets), 1)
        used = np.flatnonzero(total)
        release()
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    return run


def gram_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts; tasks count for themselves and send at most ``buckets`` rows."""
    rows = apart(docs, text=text).mapInArrow(_gram_counts(buckets), "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def _rows_with_keys(docs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose key is in ``keys``: a Bloom filter spares the others the shuffle."""
    wanted = stage(keys.select(F.col(key).alias("__wanted")).distinct(), "keys")
    hashes = stage(wanted.select(F.xxhash64("__wanted").alias("cell")).distinct(), "hashes")
    hashed = docs.withColumn("__cell", F.xxhash64(named(key)))
    possible = flagged(hashed, "__cell", hashes, "__possible").where("__possible")
    return possible.join(wanted, named(key) == F.col("__wanted"), "left_semi").drop("__cell", "__possible")


def log_ratios(target: DataFrame, raw: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """log(target share / raw share) of every bucket, from (bucket, n) counts of both.

    The driver gets ``buckets`` rows at most.
    """
    both = raw.withColumnRenamed("n", "raw").join(target.withColumnRenamed("n", "target"), "bucket", "full")
    rows = both.toPandas().fillna(0)
    counts = np.full((2, buckets), smoothing)
    counts[0, rows["bucket"]] += rows["target"]
    counts[1, rows["bucket"]] += rows["raw"]
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[0] / shares[1]).astype(np.float32)


def _scorer(spark, ratios: np.ndarray):
    """A function of a text: its base counts and mean log ratio."""
    model = spark.sparkContext.broadcast(ratios)  # one number per bucket

    return from_texts(lambda part: _scored(part, model.value), f"struct<{_BASE}, score: double>")


def _scored(column: pa.Array, ratios: np.ndarray) -> pa.Array:
    found = base_counts(column)
    data, offsets = buffers(column)
    scores = []
    for at, to in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        total, n = 0.0, 0
        for own in _parts(data[at:to]):
            values = ratios[_grams(own, len(ratios))]
            total, n = total + float(values.sum(dtype=np.float64)), n + len(values)
        scores.append(total / n if n else 0.0)
    arrays = [pa.array(values.astype(np.int64)) for values in found.values()]
    return pa.StructArray.from_arrays([*arrays, pa.array(scores, pa.float64())], [*found, "score"])


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    """Fixed rules: fewer than 10 words, or over 20 % of them in repeated windows."""
    return (n_words < 10) | (n_repeat_words * 100 > n_words * 20)


def quality(
    docs: DataFrame,
    target_keys: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``docs`` with base counts, ``base_failed``, ``score`` and ``kept``.

    ``target_keys`` holds the keys of the trusted documents, under the name ``key``. Counts of
    n-grams are taken over every text of ``docs``, for the target over every text with such a key.

    Defined cases: a null or empty text has no words, so its base fails, and the score 0, as has a
    text too short for an n-gram; without any target row all scores are about 0; null keys are no
    target; a target key that many rows share counts each of them; rows are kept as they are,
    repeated ones too; an empty table gives an empty result; input columns named like a result are
    replaced.
    """
    if buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    with scratch_until_done(docs.sparkSession):
        rows = docs.select(named(key).alias(key), named(text).alias(text))
        trusted = _rows_with_keys(rows, target_keys, key)
        target = stage(gram_counts(trusted, text, buckets), "target")
        if target.isEmpty():
            ratios = np.zeros(buckets, np.float32)
        else:
            raw = stage(gram_counts(docs, text, buckets), "raw")
            ratios = log_ratios(target, raw, buckets)
    found = docs.withColumn("__found", _scorer(docs.sparkSession, ratios)(named(text)))
    part = lambda name: F.col(f"__found.{name}")
    failed = base_failed(part("n_words"), part("n_repeat_words"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return with_results(
        found,
        {
            **{name: part(name) for name in names},
            "base_failed": failed,
            "score": part("score"),
            "kept": ~failed & (part("score") >= threshold),
        },
    ).drop("__found")
