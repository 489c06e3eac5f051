"""Words of Arrow text columns, found and hashed over all bytes of a batch at once.

A word is a run of bytes other than the separators 0x20 and 0x09-0x0D, so words of UTF-8 text are
those of ``[^\\x20\\x09-\\x0D]+``. Word hashes are polynomials over a random table of bytes, taken
modulo 2^64 and mixed: equal words have equal hashes on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Bytes handled at once; the temporaries of a slice take some 75 times as much.
SLICE = 1 << 18

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2^64


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that looks random (the finaliser of splitmix64)."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_RANDOM_BYTES = mix(np.arange(256, dtype=np.uint64))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i <= n."""
    inverse = pow(_BASE, -1, 1 << 64)

    def run(base: int) -> np.ndarray:
        factors = np.full(n + 1, base, dtype=np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    return run(_BASE), run(inverse)


@dataclass
class Words:
    """Words of some texts. Those of text i are ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # where each text starts, and the end
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    prefix: dict[int, np.ndarray]  # by length, hashes of the first bytes; 0 for shorter words

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self)), self.counts())


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(column: pa.Array, most: int = SLICE) -> Iterator[pa.Array]:
    """Parts of a column of at most so many bytes, or of one text."""
    _, offsets = buffers(column)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        to = min(max(to, at + 1), len(column))
        yield column.slice(at, to - at)
        at = to


def is_long(column: pa.Array) -> bool:
    """Whether a slice is one text of more bytes than are handled at once."""
    return len(column) == 1 and len(buffers(column)[0]) > SLICE


def column_of(data: np.ndarray) -> pa.Array:
    """A column of one text, without a copy."""
    offsets = pa.py_buffer(np.array([0, len(data)], np.int64))
    return pa.LargeStringArray.from_buffers(1, offsets, pa.py_buffer(data))


def pieces(data: np.ndarray, separators: tuple[int, ...] = SEPARATORS) -> Iterator[np.ndarray]:
    """Parts of one text that end between words, of at most SLICE bytes or of one word."""
    offsets = np.array([0, len(data)], np.int64)
    breaks = np.zeros(256, bool)
    breaks[list(separators)] = True
    at = 0
    while at < len(data):
        to = min(at + SLICE, len(data))
        if to < len(data):
            to = _cut(data, offsets, breaks, at, to)
        yield data[at:to]
        at = to


def run_hashes(data: np.ndarray, width: int, fold: bool = True) -> Iterator[np.ndarray]:
    """Hashes of all runs of ``width`` words of one text, piece by piece; the last words of a piece
    are carried to the next. They are those of ``shingles``."""
    carried, full = np.zeros(0, np.uint64), False
    for piece in pieces(data):
        own = np.concatenate([carried, find_words(column_of(piece), fold).hash])
        if len(own) >= width:
            full = True
            yield _run_hash(own, np.arange(len(own) - width + 1), width)
        carried = own[max(0, len(own) - width + 1) :]
    if not full and len(carried):
        yield _run_hash(carried, np.zeros(1, np.int64), len(carried))


def line_hashes(data: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the lines of one text that hold a word, piece by piece. A line may be longer than a
    piece: its sum goes on with the next one."""
    spaces = np.zeros(256, bool)
    spaces[list(SEPARATORS)] = True
    total, length, solid = 0, 0, False  # of the line that is open
    powers, inverses = _powers(SLICE)
    for at in range(0, len(data), SLICE):
        piece = data[at : at + SLICE]
        ends = np.flatnonzero(piece == 0x0A)
        start, end = np.concatenate([[0], ends + 1]), np.concatenate([ends, [len(piece)]])
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_RANDOM_BYTES[piece] * powers[: len(piece)], out=sums[1:])
        own = (sums[end] - sums[start]) * inverses[start]
        sizes = (end - start).astype(np.uint64)
        words = np.zeros(len(piece) + 1, np.int64)
        np.cumsum(~spaces[piece], out=words[1:])
        holds = words[end] > words[start]
        factor = np.uint64(pow(_BASE, length, 1 << 64))
        own[:1] = own[:1] * factor + np.uint64(total)
        sizes[:1] += np.uint64(length)
        holds[0] |= solid
        total, length, solid = int(own[-1]), int(sizes[-1]), bool(holds[-1])
        yield mix(own[:-1] + sizes[:-1])[holds[:-1]]
    if solid:
        yield mix(np.array([total], np.uint64) + np.uint64(length))


def _run_hash(words: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    total = np.full(len(first), width, np.uint64) * _STEP
    for i in range(width):
        total = mix(total ^ words[first + i])
    return total


def distinct_hashes(parts: Iterator[np.ndarray]) -> np.ndarray:
    """The sorted distinct values of some arrays."""
    found = [np.unique(part) for part in parts]
    whole = np.concatenate(found) if found else np.zeros(0, np.uint64)
    found.clear()
    whole.sort()
    new = np.ones(len(whole), bool)
    new[1:] = whole[1:] != whole[:-1]
    return whole[new]


def find_words(
    column: pa.Array,
    fold: bool = True,
    separators: tuple[int, ...] = SEPARATORS,
    prefixes: tuple[int, ...] = (),
) -> Words:
    """The words of each text; ``fold`` hashes A-Z as a-z. Columns of more than a slice are gone
    through in parts that end between words; the result holds some 25 bytes a word, so texts beyond
    a slice (``is_long``) are better taken by ``pieces``."""
    data, offsets = buffers(column)
    breaks = np.zeros(256, bool)
    breaks[list(separators)] = True
    starts, ends, hashes = [], [], []
    heads: dict[int, list[np.ndarray]] = {n: [] for n in prefixes}
    at, size = 0, len(data)
    while at < size:
        to = min(at + SLICE, size)
        if to < size:
            to = _cut(data, offsets, breaks, at, to)
        s, e, h, p = _part(data[at:to], offsets, breaks, at, fold, prefixes)
        starts.append(s)
        ends.append(e)
        hashes.append(h)
        for n in prefixes:
            heads[n].append(p[n])
        at = to
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    start = join(starts, np.int64)
    return Words(
        data, offsets, start, join(ends, np.int64), join(hashes, np.uint64),
        np.searchsorted(start, offsets), {n: join(heads[n], np.uint64) for n in prefixes},
    )


def _cut(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray, at: int, to: int) -> int:
    """An end between words: the last one up to ``to``, else the next one behind it."""
    inside = np.flatnonzero(breaks[data[at:to]])
    bound = int(offsets[np.searchsorted(offsets, to, "right") - 1])
    best = max(at + int(inside[-1]) + 1 if len(inside) else 0, bound)
    if best > at:
        return best
    while to < len(data):  # one word fills the part
        ahead = np.flatnonzero(breaks[data[to : to + SLICE]])
        bound = int(offsets[np.searchsorted(offsets, to, "left")])
        if len(ahead):
            return min(bound, to + int(ahead[0]))
        if bound <= to + SLICE:
            return bound
        to += SLICE
    return len(data)


def _part(data, offsets, breaks, base, fold, prefixes):
    n = len(data)
    word = ~breaks[data]
    text_start = np.zeros(n + 1, bool)
    inner = offsets[np.searchsorted(offsets, base) : np.searchsorted(offsets, base + n, "right")]
    text_start[inner - base] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | text_start[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    end = np.flatnonzero(word & (~after | text_start[1:])) + 1
    # Tables for one word of more than a slice are not kept.
    powers, inverses = _powers(SLICE) if n <= SLICE else _powers.__wrapped__(n)
    sums = np.zeros(n + 1, np.uint64)
    letters = _RANDOM_BYTES[_FOLD[data] if fold else data]
    np.cumsum(letters * powers[:n], out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * inverses[start] + (end - start).astype(np.uint64))
    heads = {}
    for length in prefixes:
        to = np.minimum(start + length, n)
        head = mix((sums[to] - sums[start]) * inverses[start] + np.uint64(length << 32))
        heads[length] = np.where(end - start >= length, head, np.uint64(0))
    return start + base, end + base, hashes, heads


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words and the bounds of each text's runs.

    A text with fewer words gives one run of all of them; a text without words gives none.
    """
    counts = words.counts()
    runs = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(runs)])
    first = np.repeat(words.first[:-1], runs) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], runs)
    length = np.repeat(np.minimum(counts, width), runs)
    total = length.astype(np.uint64) * _STEP
    padded = np.concatenate([words.hash, np.zeros(width, np.uint64)])
    for i in range(width):
        total = np.where(i < length, mix(total ^ padded[first + i]), total)
    return total, bounds
