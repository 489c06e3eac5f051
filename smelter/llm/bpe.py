"""Byte-level BPE encoding and decoding.

Short texts are encoded where they lie. Longer ones are cut into overlapping chunks that spread over
the cluster; each is pre-tokenised by itself. In the overlap of two neighbours, the first position
at which both have a pre-token boundary is where they resynchronise: the pattern looks at no
character before a pre-token, so from there on both agree. The text is cut at these positions, the
pieces are encoded in parallel, and their ids are put together in order. Decoding concatenates raw
bytes.

Ids are carried as little-endian unsigned 32-bit integers in a binary column.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.arrow import from_texts
from smelter.llm.tables import named, with_results
from smelter.operators import stage

#: Characters of a chunk, without the overlap, and of the overlap. Texts up to a chunk are not cut.
CHUNK = 32_768
OVERLAP = 1_024
#: Characters behind a pre-token that its match may have looked at ("'ll" is the longest case).
_LOOKS = 3
#: Rows whose results leave Python together.
_ROWS = 256


@lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file; read once in each process."""
    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


@lru_cache(maxsize=4)
def _bytes_of(ranks: str, pattern: str) -> dict[int, bytes]:
    own = encoding(ranks, pattern)
    return dict(zip(map(own.encode_single_token, own.token_byte_values()), own.token_byte_values()))


@lru_cache(maxsize=4)
def _compiled(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def default_ranks() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _encoder(ranks: str, pattern: str):
    def encode(texts: pa.Array) -> pa.Array:
        own = encoding(ranks, pattern)
        ids = (own.encode_ordinary(text or "") for text in texts.to_pylist())
        return pa.array([np.array(x, dtype="<u4").tobytes() for x in ids], pa.binary())

    return from_texts(encode, "binary")


def _chunk_rows(chunk: int, overlap: int):
    """Rows of (key, text) to rows of (key, no, start, last, text) with each neighbour's overlap."""
    kind = pa.schema(
        [("key", pa.string()), ("no", pa.int32()), ("last", pa.bool_()), ("text", pa.string())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
                text = text.as_py()
                starts = range(0, len(text), chunk)
                for first in range(0, len(starts), 64):
                    own = starts[first : first + 64]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "key": [key] * len(own),
                            "no": list(range(first, first + len(own))),
                            "last": [at + chunk + overlap >= len(text) for at in own],
                            "text": [text[at : at + chunk + overlap] for at in own],
                        },
                        schema=kind,
                    )

    return cut


def _may_cut(text: str, at: int) -> bool:
    """Between ASCII characters, the first of them printable and no space.

    Every engine agrees on their classes, and a piece that ends with white space would read
    otherwise alone.
    """
    return 0 < at < len(text) and "!" <= text[at - 1] <= "~" and (" " <= text[at] <= "~" or text[at] in "\n\t\r")


def _boundaries(chunk: int, overlap: int, pattern: str):
    """Rows of chunks to (key, no, head, tail): the boundaries in a chunk's two overlaps, as
    positions relative to the chunk that the overlap begins.
    """
    kind = pa.schema(
        [("key", pa.string()), ("no", pa.int32()), ("head", pa.list_(pa.int32())), ("tail", pa.list_(pa.int32()))]
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _compiled(pattern)
        for batch in batches:
            out = {"key": [], "no": [], "head": [], "tail": []}
            for row in batch.to_pylist():
                text = row["text"]
                sure = len(text) - (0 if row["last"] else _LOOKS)
                ends = [m.end() for m in split.finditer(text)]
                own = [at for at in ends if at <= sure and _may_cut(text, at)]
                out["key"].append(row["key"])
                out["no"].append(row["no"])
                out["head"].append([at for at in own if at < overlap])
                out["tail"].append([at - chunk for at in own if chunk < at < chunk + overlap])
            yield pa.RecordBatch.from_pydict(out, schema=kind)

    return find


def _cuts(boundaries: DataFrame, chunk: int) -> DataFrame:
    """(key, cuts): ascending positions at which the text may be cut.

    The first pair of neighbours that does not resynchronise ends the list: behind it, nothing is
    known to be a boundary of the whole text, and the rest stays one piece.
    """
    chunks = F.sort_array(F.collect_list(F.struct("no", "head", "tail")))
    pairs = boundaries.groupBy("key").agg(chunks.alias("c")).select(
        "key",
        F.transform(
            F.filter("c", lambda x: x["no"] > 0),
            lambda x: F.array_min(F.array_intersect(x["head"], F.get(F.col("c"), x["no"] - 1)["tail"]))
            + x["no"] * F.lit(chunk),
        ).alias("at"),
    )
    missing = F.array_position(F.transform("at", lambda x: x.isNull()), True).cast("int")
    return pairs.select(
        "key", F.when(missing > 0, F.slice("at", 1, missing - 1)).otherwise(F.col("at")).alias("cuts")
    )


def _piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (key, text, cuts) to rows of (key, no, text)."""
    kind = pa.schema([("key", pa.string()), ("no", pa.int32()), ("text", pa.string())])
    for batch in batches:
        for key, text, cuts in zip(batch.column("key"), batch.column("text"), batch.column("cuts")):
            key, text, cuts = key.as_py(), text.as_py(), cuts.as_py() or []
            bounds = [0, *cuts, len(text)]
            for first in range(0, len(bounds) - 1, 64):
                own = range(first, min(first + 64, len(bounds) - 1))
                yield pa.RecordBatch.from_pydict(
                    {"key": [key] * len(own), "no": list(own), "text": [text[bounds[i] : bounds[i + 1]] for i in own]},
                    schema=kind,
                )


def _joined(parts: pa.Array) -> pa.Array:
    return pa.array([b"".join(x) if x is not None else None for x in parts.to_pylist()], pa.binary())


def join_bytes(parts: Column) -> Column:
    """The concatenation of an array of binaries."""

    @F.arrow_udf("binary")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            for at in range(0, len(column), _ROWS):
                yield _joined(column.slice(at, _ROWS))

    return run(parts)


def encode_long(texts: DataFrame, ranks: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(key, ids) of rows of (key, text) with unique keys, by overlapping chunks."""
    chunks = texts.mapInArrow(_chunk_rows(chunk, overlap), "key string, no int, last boolean, text string")
    found = chunks.repartition("key", "no").mapInArrow(
        _boundaries(chunk, overlap, pattern), "key string, no int, head array<int>, tail array<int>"
    )
    pieces = texts.join(_cuts(found, chunk), "key").mapInArrow(_piece_rows, "key string, no int, text string")
    encoded = pieces.repartition("key", "no").select(
        "key", "no", _encoder(ranks, pattern)(F.col("text")).alias("ids")
    )
    whole = encoded.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("parts"))
    return whole.select("key", join_bytes(F.col("parts.ids")).alias("ids"))


def encode(
    docs: DataFrame,
    text: str = "text",
    ranks: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``docs`` with ``ids``, as the tiktoken library encodes each whole text without special
    tokens.

    ``ranks`` is the path of a rank file that every executor can open.

    Defined cases: a null text is the empty text, whose ids are empty; a long text that many rows
    repeat is encoded once; a long text in which two neighbours never agree within their overlap is
    not cut behind that point; rows are kept as they are, repeated ones too; an input column named
    ``ids`` is replaced. ``docs`` is read three times: stage it if it is dear to compute.
    """
    if not 0 < overlap <= chunk:
        raise ValueError("the overlap must be positive and no longer than a chunk")
    ranks = ranks or default_ranks()
    own = F.coalesce(named(text), F.lit(""))
    is_long = F.length(own) > chunk
    short = with_results(docs.where(~is_long), {"ids": _encoder(ranks, pattern)(own)})
    long = docs.where(is_long).withColumn("__key", F.sha2(own, 256))
    texts = long.groupBy(F.col("__key").alias("key")).agg(F.first(own).alias("text"))
    ids = encode_long(stage(texts, "long-texts"), ranks, pattern, chunk, overlap)
    found = long.join(ids.select(F.col("key").alias("__other"), F.col("ids").alias("__ids")),
                      F.col("__key") == F.col("__other"))
    return short.unionByName(with_results(found, {"ids": F.col("__ids")}).drop("__key", "__other", "__ids"))


def decode(
    rows: DataFrame, ids: str = "ids", ranks: str | None = None, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """``rows`` with ``decoded``, the bytes of their ids; null ids decode to null."""
    ranks = ranks or default_ranks()

    def bytes_of(column: pa.Array) -> pa.Array:
        table = _bytes_of(ranks, pattern)
        out = []
        for value in column:
            raw = value.as_py()
            out.append(None if raw is None else b"".join(map(table.__getitem__, np.frombuffer(raw, "<u4").tolist())))
        return pa.array(out, pa.binary())

    @F.arrow_udf("binary")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            for at in range(0, len(column), _ROWS):
                yield bytes_of(column.slice(at, _ROWS))

    return with_results(rows, {"decoded": run(named(ids))})


def token_count(text: Column, ranks: str | None = None, pattern: str = public_tokenizers.PATTERN) -> Column:
    """Number of ids of a text; null counts as empty."""
    ranks = ranks or default_ranks()

    def count(texts: pa.Array) -> pa.Array:
        own = encoding(ranks, pattern)
        return pa.array([len(own.encode_ordinary(x or "")) for x in texts.to_pylist()], pa.int64())

    return from_texts(count, "bigint")(text)
