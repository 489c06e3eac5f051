"""Periodic runs of words by Baier's grouping.

A run is a stretch of a sequence that has a smallest period q, holds at least two periods and
cannot be made longer. Each run has a Lyndon root: a Lyndon word of length q that is the longest one
to start at its place, under the order of the symbols or under the reverse order. So both Lyndon
arrays (the length of the longest Lyndon word that starts at each place) are enough to find all
runs.

The first phase of Baier's suffix sorting yields a Lyndon array directly. Suffixes are grouped by
their first symbol. Groups are gone through from the highest down: every suffix of a group points to
the nearest one to its left that is in a lower group, and those that are pointed to equally often
and share a group leave it for a new group right above, whose common prefix is longer by as many
times that of the group at hand. A group's prefix, when its turn comes, is the longest Lyndon word
of its suffixes. Each suffix points once, so this takes linear time.

Lyndon words that are followed by themselves are then extended to both sides by longest common
extensions (LCE), which come from prefix hashes by binary search. Every run so found is compared
symbol by symbol; hashes that collide cost time, never a wrong run.

Only stretches in which every window of a few words occurs twice are sorted: a run of three periods
repeats each of its windows a period away, so no run is missed, and text without repetitions costs
no more than its windows.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.arrow import release
from smelter.llm.tables import named, with_results
from smelter.llm.words import buffers, mix

#: A run has at least so many words, and so many times its period.
LEAST_LENGTH, LEAST_PERIODS = 24, 3

#: Bytes of a text that are cut into words at once, and words handled at once.
_PIECE, _WORDS = 1 << 18, 1 << 16
_BASE = np.uint64(0xD6E8FEB86659FD93)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def lyndon_array(symbols: np.ndarray) -> np.ndarray:
    """For each place, the length of the longest Lyndon word that starts there.

    ``symbols`` are integers whose order is that of the alphabet. Linear in their number, after
    their ranks.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int32)
    _, ranks = np.unique(symbols, return_inverse=True)
    groups = int(ranks.max()) + 1
    # Places are numbered from 1; 0 stands for the place before the first.
    group = array("i", [-1]) + array("i", ranks.astype(np.int32).tobytes())
    order = np.argsort(ranks, kind="stable").astype(np.int32) + 1
    bounds = np.searchsorted(ranks[order - 1], np.arange(groups + 1))
    members: list = [array("i", order[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
    length = array("i", [1]) * groups
    below, above = array("i", range(-1, groups - 1)), array("i", range(1, groups + 1))
    left, right = array("i", range(-1, n + 1)), array("i", range(1, n + 3))
    found = array("i", [0]) * (n + 1)
    current = groups - 1
    while current >= 0:
        own = length[current]
        targets, times = [], []
        last, repeated = 0, False
        for place in members[current]:
            if group[place] != current:
                continue  # it has moved on
            found[place] = own
            # Places of this group and of higher ones leave the list, so what is left of a place is
            # in a lower group.
            before, behind = left[place], right[place]
            right[before], left[behind] = behind, before
            if not before:
                continue
            if before == last:
                times[-1] += 1
                repeated = True
            else:
                targets.append(before)
                times.append(1)
                last = before
        members[current] = None
        if repeated:
            rounds = [(k, [t for t, m in zip(targets, times) if m == k]) for k in sorted(set(times), reverse=True)]
        else:
            rounds = [(1, targets)] if targets else []
        for k, moved in rounds:
            new: dict[int, int] = {}
            for place in moved:
                old = group[place]
                to = new.get(old)
                if to is None:
                    to = new[old] = len(members)
                    members.append(array("i"))
                    length.append(length[old] + k * own)
                    up = above[old]
                    below.append(old)
                    above.append(up)
                    above[old] = to
                    below[up] = to
                members[to].append(place)
                group[place] = to
        current = below[current]
    return np.frombuffer(found, np.int32)[1:]


class Extensions:
    """Longest common extensions of places of a sequence, for many pairs at once."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        factors = np.full(self.n + 1, _BASE)
        factors[0] = 1
        self.powers = np.cumprod(factors, dtype=np.uint64)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(mix(symbols.astype(np.uint64)) * self.powers[:-1], out=self.sums[1:])

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches of ``length`` at a and b > a have equal hashes."""
        one = (self.sums[a + length] - self.sums[a]) * self.powers[b - a]
        return one == self.sums[b + length] - self.sums[b]

    def _longest(self, most: np.ndarray, holds: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            good = holds(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far what starts at a goes on as what starts at b > a."""
        return self._longest(self.n - b, lambda m: self.same(a, b, m))

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far what ends before a equals what ends before b > a."""
        return self._longest(a.copy(), lambda m: self.same(a - m, b - m, m))


def _stretches(symbols: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all stretches with this period, symbol by symbol."""
    equal = np.concatenate([[False], symbols[:-period] == symbols[period:], [False]])
    edges = np.flatnonzero(equal[1:] != equal[:-1])
    return edges[::2], edges[1::2] + period


def _is_run(symbols: np.ndarray, start: int, end: int, period: int) -> bool:
    if not np.array_equal(symbols[start : end - period], symbols[start + period : end]):
        return False
    wider = start > 0 and symbols[start - 1] == symbols[start - 1 + period]
    return not wider and (end == len(symbols) or symbols[end] != symbols[end - period])


def find_runs(
    symbols: np.ndarray, least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS
) -> np.ndarray:
    """(start, length, period) of the runs of a sequence of at least so many symbols and periods (2
    or more), by start, then period."""
    if least_periods < 2:
        raise ValueError("a run has two periods or more")
    n = len(symbols)
    none = np.zeros((0, 3), np.int64)
    if n < max(least_length, least_periods):
        return none
    roots = []
    for signed in (symbols, -symbols.astype(np.int64)):
        lyndon = lyndon_array(signed).astype(np.int64)
        at = np.flatnonzero(np.arange(n) + min(least_periods - 1, 2) * lyndon <= n)
        roots.append(np.stack([lyndon[at], at], axis=1))
    roots = np.unique(np.concatenate(roots), axis=0)
    equal = Extensions(symbols)
    q, i = period, at = roots[:, 0], roots[:, 1]
    if least_periods > 2:
        # One of the roots is followed by itself. Such squares of one period that start no further
        # than it from each other are of one run.
        square = equal.same(at, at + period, period)
        period, at = period[square], at[square]
        new = np.ones(len(at), bool)
        new[1:] = (period[1:] != period[:-1]) | (at[1:] - at[:-1] > period[1:])
        q, i = period[new], at[new]
    if not len(at):
        return none
    start = i - equal.backward(i, i + q)
    end = i + q + equal.forward(i, i + q)
    long = end - start >= np.maximum(least_length, least_periods * q)
    out = set()
    for s, e, p in np.unique(np.stack([start[long], end[long], q[long]], axis=1), axis=0).tolist():
        if _is_run(symbols, s, e, p):
            out.add((s, e - s, p))
        else:  # hashes collided
            inside = at[period == p]
            for a, b in zip(*_stretches(symbols, p)):
                rooted = ((inside >= a) & (inside + p <= b)).any()
                if b - a >= max(least_length, least_periods * p) and rooted:
                    out.add((int(a), int(b - a), p))
    found = np.array(list(out), np.int64).reshape(-1, 3)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _repeated(symbols: np.ndarray, width: int) -> np.ndarray:
    """Whether the window of ``width`` that starts at each place may occur twice: surely true if it
    does."""
    places = len(symbols) - width + 1
    size = 1 << max(10, (4 * places - 1).bit_length())
    seen, twice = np.zeros(size, bool), np.zeros(size, bool)

    def slots(at: int) -> np.ndarray:
        part = mix(symbols[at : min(at + _WORDS, places) + width - 1].astype(np.uint64))
        total = part[: len(part) - width + 1].copy()
        for k in range(1, width):
            total = total * _BASE + part[k : len(part) - width + 1 + k]
        return (mix(total) & np.uint64(size - 1)).astype(np.int64)

    for at in range(0, places, _WORDS):
        own = slots(at)
        twice[own[seen[own]]] = True
        own.sort()
        twice[own[1:][own[1:] == own[:-1]]] = True
        seen[own] = True
    return np.concatenate([twice[slots(at)] for at in range(0, places, _WORDS)])


def runs_of_text(
    symbols: np.ndarray, least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS
) -> np.ndarray:
    """``find_runs`` of a long sequence with few repetitions."""
    # A window of a run occurs again a period to its right or to its left, if two periods and the
    # window overlap by no more than the run is long.
    lengths = range(least_length, least_length + least_periods)
    width = min(length - 2 * (length // least_periods) + 1 for length in lengths)
    if len(symbols) < max(least_length, width):
        return np.zeros((0, 3), np.int64)
    again = np.concatenate([[False], _repeated(symbols, width), [False]])
    edges = np.flatnonzero(again[1:] != again[:-1])
    out = [np.zeros((0, 3), np.int64)]
    for a, b in zip(edges[::2].tolist(), (edges[1::2] + width - 1).tolist()):
        if b - a >= least_length:
            out.append(find_runs(symbols[a:b], least_length, least_periods) + (a, 0, 0))
    found = np.concatenate(out)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _pieces(data: bytes) -> Iterator[bytes]:
    """Parts of a text that end between words, the separators ASCII white space."""
    at = 0
    while at < len(data):
        to = at + _PIECE
        if to < len(data):
            cut = _SPACE.search(data, to)
            to = cut.start() if cut else len(data)
        yield data[at:to]
        at = to


def number_words(data: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The words of a text as numbers, and the word of each number."""
    known: dict[bytes, int] = {}
    numbers = array("i")
    for piece in _pieces(data):
        # bytes.split() cuts at 0x20 and 0x09-0x0D.
        numbers.extend([known.setdefault(word, len(known)) for word in piece.split()])
    return np.frombuffer(numbers, np.int32) if numbers else np.zeros(0, np.int32), list(known)


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each of n words stays: not in any run behind its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def joined(numbers: np.ndarray, words: list[bytes]) -> bytes:
    parts = []
    for at in range(0, len(numbers), _WORDS):
        parts.append(b" ".join([words[i] for i in numbers[at : at + _WORDS].tolist()]))
    return b" ".join(parts)


_KIND = pa.struct(
    [
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("collapsed", pa.string()),
    ]
)
_SPARK_KIND = (
    "struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"
)


def _texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = buffers(column)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield data[a:b].tobytes()


def _found(rows: list[tuple[int, np.ndarray, bytes]]) -> pa.Array:
    bounds = np.cumsum([0, *[len(runs) for _, runs, _ in rows]]).astype(np.int32)
    every = np.concatenate([runs for _, runs, _ in rows])
    columns = [pa.array(every[:, i]) for i in range(3)]
    listed = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(columns, ["start", "length", "period"]))
    texts = pa.array([text for _, _, text in rows], pa.binary()).cast(pa.string())
    return pa.StructArray.from_arrays(
        [pa.array([n for n, _, _ in rows], pa.int64()), listed.cast(_KIND.field("runs").type), texts],
        ["n_words", "runs", "collapsed"],
    )


def _finder(least_length: int, least_periods: int):
    @F.arrow_udf(_SPARK_KIND)
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            rows, size = [], 0
            for text in _texts(column):
                numbers, words = number_words(text)
                runs = runs_of_text(numbers, least_length, least_periods)
                kept = numbers[kept_words(len(numbers), runs)] if len(runs) else numbers
                collapsed = joined(kept, words)
                rows.append((len(numbers), runs, collapsed))
                size += len(collapsed)
                if size > 1 << 22:
                    yield _found(rows)
                    rows, size = [], 0
            if rows:
                yield _found(rows)
        release()

    return run


def periodic_runs(
    docs: DataFrame,
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    least_periods: int = LEAST_PERIODS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (an array of start, length and period in words, by start,
    then period) and ``collapsed``: the words, joined by one space, without those that a run holds
    behind its first period.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, compared as they are. Each text is
    searched whole, in one task; nothing is shuffled.

    Defined cases: a null or empty text, or one of white space, has no words, no runs and an empty
    ``collapsed``; of a text that is one run its first period stays; runs may overlap or lie in each
    other, and a word is dropped if any of them says so; rows are kept as they are, repeated ones
    too; an empty table gives an empty result; input columns named like a result are replaced.
    Very long texts are cut into words in parts, at 4 bytes a word; only stretches with repetitions
    take more, some 100 bytes a word.
    """
    found = docs.withColumn("__found", _finder(least_length, least_periods)(named(text)))
    part = lambda name: F.col(f"__found.{name}")
    return with_results(found, {name: part(name) for name in ("n_words", "runs", "collapsed")}).drop("__found")
