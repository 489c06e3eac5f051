"""Token ids in seekable zstandard files.

A shard holds documents in ascending order of their key. Its parts:

- independent zstandard frames, each with the ids of whole documents as little-endian unsigned
  32-bit integers and with its own content checksum;
- a frame with the shard's index, an Arrow stream of (key, frame, offset, n_tokens);
- a skippable frame with the seek table of the public seekable format: compressed and raw size of
  each frame and the low half of the XXH64 of its content, then the number of frames, a flag byte
  and the magic number.

A reader takes the footer, the seek table and the index, and then only the frames of the documents
it wants.

Tasks write under names of their own and report them in a manifest that Spark commits: a task that
is lost or runs twice leaves a file that no manifest names.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer  # noqa: F401

from smelter.llm.tables import apart, named
from smelter.llm.words import slices

#: Raw bytes after which a frame is closed; a longer document has a frame of its own.
FRAME_BYTES = 1 << 18
LEVEL = 1
#: Words of which a process remembers the ids; with more, it starts anew.
CACHED_WORDS = 1_600_000
#: New words that are encoded as one text.
JOINED_WORDS = 1_000
#: Bytes of texts whose words are looked up at once.
BATCH_BYTES = 1 << 24

# The public seekable format.
_SKIPPABLE, _SEEKABLE, _CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
_FOOTER = struct.Struct("<IBI")
_ENTRY = struct.Struct("<III")

INDEX = pa.schema(
    [("key", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64()), ("n_tokens", pa.int64())]
)

# A space between two other characters begins a pre-token, so a text may be cut before it.
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= \S)")
# White space that is no single space between two other characters, as Python's \s sees it.
_WHITE = r"\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_ODD = f"[{_WHITE}] | [{_WHITE}]|[\\t\\r\\v\\f]|[{_WHITE}]$"


class Encoder:
    """The ids of texts by the tokenizers library, which sees a distinct word once.

    Texts are cut before single spaces, where the byte-level pre-tokenizer always cuts, so the ids
    of the words are those of the text. For the same reason new words are encoded many at a time, as
    one text, and their ids told apart by the bytes that each id stands for. The ids of all words
    that are known lie in one array; those of a batch are gathered from it at once.

    Special tokens are found in texts as the library's default call finds them.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # A byte-level token is written with one character for each byte.
        vocabulary = self.tokenizer.get_vocab()
        self.size = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.size[number] = len(token)
        self.wide = []  # special tokens that a cut before a space might change
        for number, token in self.tokenizer.get_added_tokens_decoder().items():
            self.size[number] = len(token.content.encode())
            odd = token.lstrip or token.rstrip or token.single_word or token.normalized
            if odd or any(c in " .," or c.isspace() for c in token.content):
                self.wide.append(token.content)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # the number of a word, encoded behind a space
        self.flat, self.bounds = np.zeros(1 << 12, "<u4"), np.zeros(1 << 10, np.int64)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4") for x in found]

    def _add(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """Remember words whose ids follow each other, up to ``ends``."""
        n, start = len(self.known), int(self.bounds[len(self.known)])
        while len(self.flat) < start + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.bounds) < n + 1 + len(words):
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        self.flat[start : start + len(ids)] = ids
        self.bounds[n + 1 : n + 1 + len(words)] = start + ends
        self.known.update(zip(words, range(n, n + len(words))))

    def _gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known words one after the other, and where those of each end."""
        starts = self.bounds[numbers]
        sizes = self.bounds[numbers + 1] - starts
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(starts - ends + sizes, sizes) + np.arange(total)], ends

    def _learn(self, words: Iterable[str]) -> None:
        """New words without white space at their ends, each to be encoded behind a space."""
        ended, new = {}, {}
        for word in words:
            if word[-1:] in (".", ","):
                # A letter ends its pre-token before a stop or comma, and these end at the next
                # space.
                bare = word.rstrip(".,")
                if bare and bare[-1].isalpha():
                    ended[word] = bare
                    if bare not in self.known:
                        new[bare] = None
                    continue
            new[word] = None
        new = list(new)
        runs = [new[at : at + JOINED_WORDS] for at in range(0, len(new), JOINED_WORDS)]
        for run, ids in zip(runs, self._whole([" " + " ".join(run) for run in runs])):
            sizes = [1 + (len(w) if w.isascii() else len(w.encode())) for w in run]
            bytes_to, reached = np.cumsum(sizes), np.cumsum(self.size[ids])
            at = np.searchsorted(reached, bytes_to)
            if at[-1] >= len(ids) or (reached[at] != bytes_to).any():
                raise ValueError("this tokenizer does not cut before spaces")
            self._add(run, ids, at + 1)
        marks = list({word[len(bare) :] for word, bare in ended.items()})
        of_marks = dict(zip(marks, self._whole(marks)))
        if ended:
            bare, ends = self._gathered(np.array([self.known[b] for b in ended.values()], np.int64))
            tails = [of_marks[word[len(b) :]] for word, b in ended.items()]
            size = np.array([len(t) for t in tails])
            at = np.repeat(ends, size)  # tails go in behind their words
            self._add(list(ended), np.insert(bare, at, np.concatenate(tails)), ends + np.cumsum(size))

    def _numbers(self, words: list[str], used: np.ndarray) -> np.ndarray:
        """The numbers of the words that are used, which are learnt if they are new."""
        found = np.array([self.known.get(word, -1) for word in words], np.int64)
        new = np.flatnonzero(used & (found < 0))
        if len(new):
            if len(self.known) + 2 * len(new) > CACHED_WORDS:
                self._forget()
                new = np.flatnonzero(used)
            fresh = [words[i] for i in new.tolist()]
            self._learn(fresh)
            found[new] = [self.known[word] for word in fresh]
        return found

    def _plain(self, column: pa.Array) -> list[bytes]:
        """Ids of texts whose spaces all stand between two characters that are no white space."""
        listed = pc.split_pattern(column, " ")
        offsets = listed.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        words = listed.flatten().dictionary_encode()
        first = offsets[:-1]
        follows = np.ones(len(words), bool)
        follows[first] = False
        which = words.indices.to_numpy()
        used = np.zeros(len(words.dictionary), bool)
        used[which[follows]] = True
        spelled = words.dictionary.to_pylist()
        numbers = self._numbers(spelled, used)
        ids, ends = self._gathered(numbers[which[follows]])
        raw, ends = ids.tobytes(), np.concatenate([[0], 4 * ends])
        bounds = ends[offsets - np.arange(len(offsets))].tolist()
        heads = self._whole([spelled[i] for i in which[first].tolist()])
        return [head.tobytes() + raw[a:b] for head, a, b in zip(heads, bounds, bounds[1:])]

    def ids(self, column: pa.Array | list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers; null has none."""
        column = pa.array(column, pa.string()) if isinstance(column, list) else column
        column = column.cast(pa.large_string()).fill_null("")
        whole = np.zeros(len(column), bool)
        for content in self.wide:
            whole |= pc.match_substring(column, content).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(column, _ODD).to_numpy(zero_copy_only=False) | whole
        out = [b""] * len(column)
        plain = np.flatnonzero(~odd)
        if len(plain):
            for i, ids in zip(plain.tolist(), self._plain(column.take(pa.array(plain)))):
                out[i] = ids
        parts, owner = [], []
        for i in np.flatnonzero(odd).tolist():
            text = column[i].as_py()
            own = [text] if whole[i] else _BEFORE_SPACE.split(text)
            parts += own
            owner += [i] * len(own)
        found: dict[int, list[bytes]] = {}
        for i, ids in zip(owner, self._whole(parts)):
            found.setdefault(i, []).append(ids.tobytes())
        for i, own in found.items():
            out[i] = b"".join(own)
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    return Encoder(path)


class ShardWriter:
    """Writes one shard to an open binary file."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        self.out, self.frame_bytes = out, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.seek: list[tuple[int, int, int]] = []
        self.open: list[bytes] = []
        self.size = 0
        self.index: dict[str, list] = {name: [] for name in INDEX.names}

    def add(self, key: int | None, ids: bytes) -> tuple[int, int]:
        """Append a document; its frame and its offset there, in ids."""
        if self.size and self.size + len(ids) > self.frame_bytes:
            self._flush()
        place = len(self.seek), self.size // 4
        for name, value in zip(INDEX.names, (key, *place, len(ids) // 4)):
            self.index[name].append(value)
        self.open.append(ids)
        self.size += len(ids)
        return place

    def _flush(self) -> None:
        self._frame(b"".join(self.open))
        self.open, self.size = [], 0

    def _frame(self, raw: bytes) -> None:
        if len(raw) >= 1 << 32:
            raise ValueError("a frame of 4 GiB or more does not fit the seek table")
        packed = self.compressor.compress(raw)
        self.out.write(packed)
        self.seek.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.open:
            self._flush()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, INDEX) as stream:
            stream.write_batch(pa.RecordBatch.from_pydict(self.index, schema=INDEX))
        self._frame(sink.getvalue().to_pybytes())
        table = b"".join(_ENTRY.pack(*entry) for entry in self.seek)
        table += _FOOTER.pack(len(self.seek), _CHECKSUMS, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)


class ShardReader:
    """Reads one shard from an open, seekable binary file."""

    def __init__(self, source):
        self.source = source
        end = source.seek(0, 2) if not hasattr(source, "size") else source.size()
        source.seek(end - _FOOTER.size)
        frames, flags, magic = _FOOTER.unpack(source.read(_FOOTER.size))
        if magic != _SEEKABLE or flags != _CHECKSUMS:
            raise ValueError("not a shard with a seek table and checksums")
        source.seek(end - _FOOTER.size - frames * _ENTRY.size)
        self.seek = list(_ENTRY.iter_unpack(source.read(frames * _ENTRY.size)))
        self.starts = np.cumsum([0, *[packed for packed, _, _ in self.seek]]).tolist()
        self.index = pa.ipc.open_stream(self.frame(frames - 1)).read_all()

    def frame(self, number: int) -> bytes:
        """The content of one frame; an error if it does not have its checksum."""
        packed, size, checksum = self.seek[number]
        self.source.seek(self.starts[number])
        raw = zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=size)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {number} is damaged")
        return raw

    def documents(self, keys: Iterable[int] | None = None) -> Iterator[tuple[int | None, bytes]]:
        """(key, ids) in the shard's order: of all documents, or of those wanted, for which only
        their frames are read.
        """
        wanted = None if keys is None else set(keys)
        at, raw = -1, b""
        for batch in self.index.to_batches():
            for key, frame, offset, n in zip(*[c.to_pylist() for c in batch.columns]):
                if wanted is not None and key not in wanted:
                    continue
                if frame != at:
                    at, raw = frame, self.frame(frame)
                yield key, raw[4 * offset : 4 * (offset + n)]


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _shard_writer(folder: str, tokenizer: str, end_id: int, frame_bytes: int):
    kind = pa.schema(
        [("shard", pa.int32()), ("file", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())]
    )
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.zst"
        store, root = _place(folder)
        store.create_dir(root, recursive=True)
        encoder, writer, out, documents, tokens = _encoder(tokenizer), None, None, 0, 0
        for batch in batches:
            keys, at = batch.column("key").to_pylist(), 0
            for texts in slices(batch.column("text"), BATCH_BYTES):
                if writer is None:
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    writer = ShardWriter(out, frame_bytes)
                for key, ids in zip(keys[at : at + len(texts)], encoder.ids(texts)):
                    writer.add(key, ids + end)
                    documents, tokens = documents + 1, tokens + len(ids) // 4 + 1
                at += len(texts)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "file": [name], "documents": [documents], "tokens": [tokens]}, schema=kind
            )

    return write


def write_tokens(
    docs: DataFrame,
    folder: str,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = 0,
    frame_bytes: int = FRAME_BYTES,
) -> DataFrame:
    """Write the ids of ``docs`` in ascending order of ``key``; return the manifest, one row per
    shard.

    ``folder`` is a path or URI that the driver and all executors reach, in a store that both Spark
    and ``pyarrow.fs`` know; it must not exist yet. The manifest (shard, file, documents, tokens,
    first_token) is kept there as Parquet, below ``manifest``. ``tokenizer`` is the path of a
    tokenizers file that every executor can open.

    A special token's string in a text is that token, as in the library's default call.

    Defined cases: null keys come first, equal keys in the order of their texts; keys are cast to
    long, and a string that is no number is an error; a null text is empty, so it has the end id
    only; an empty table gives no shard; other columns are not written. A document is one frame at
    most, of less than 4 GiB of ids (a billion); a longer one is an error.
    """
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    rows = apart(docs, key=key, text=text).select(F.col("key").cast("long"), "text")
    ordered = rows.repartitionByRange("key", F.xxhash64("text")).sortWithinPartitions("key", "text")
    shards = ordered.mapInArrow(
        _shard_writer(folder, tokenizer, end_id, frame_bytes), "shard int, file string, documents long, tokens long"
    )
    shards.write.parquet(f"{folder}/shards")
    spark = docs.sparkSession
    # One row per shard: few enough for one window.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long"))
    spark.read.parquet(f"{folder}/shards").withColumn("first_token", first).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _shard_reader(folder: str, keys: list[int] | None):
    kind = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, root = _place(folder)
                with store.open_input_file(f"{root}/{row['file']}") as source:
                    reader = ShardReader(source)
                    sizes = np.array(reader.index.column("n_tokens"), dtype=np.int64)
                    starts = row["first_token"] + np.cumsum(sizes) - sizes
                    if keys is not None:
                        picked = np.isin(reader.index.column("key").to_numpy(), keys)
                        starts = starts[picked]
                    out, size = ([], [], []), 0
                    for start, (key, ids) in zip(starts.tolist(), reader.documents(keys)):
                        for values, value in zip(out, (key, start, ids)):
                            values.append(value)
                        size += len(ids)
                        if size > 1 << 22:
                            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, kind)], schema=kind)
                            out, size = ([], [], []), 0
                    if out[0]:
                        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, kind)], schema=kind)

    return read


def read_tokens(spark: SparkSession, folder: str, key: str = "doc_id", keys: list[int] | None = None) -> DataFrame:
    """(key, start, ids) of the documents in ``folder``, or of those with the given keys.

    ``start`` counts the ids of all documents before it. With ``keys``, shards give only the frames
    that hold them.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    # A row is a whole shard: as many tasks as shards, which a number that is asked for ensures.
    rows = manifest.repartition(max(1, manifest.count())).mapInArrow(
        _shard_reader(folder, keys), "key long, start long, ids binary"
    )
    return rows.select(named("key").alias(key), "start", "ids")
