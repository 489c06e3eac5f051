"""Words, shingles and counts over the bytes of a batch, against plain Python."""

import pathlib
import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

import plain
from smelter.llm import minhash, quality, toxicity, words
from smelter.llm.components import components

ROOT = pathlib.Path(__file__).resolve().parents[2]
LETTERS = ["a", "B", "é", "日", " ", "  ", "\n", "\t", "\x0b", "\x00", ".", "#", "|", " ", "long" * 9]


def texts(seed, n=40):
    draw = random.Random(seed)
    made = ["".join(draw.choices(LETTERS, k=draw.choice([0, 1, 3, 20, 90]))) for _ in range(n)]
    return [None if draw.random() < 0.05 else text for text in made]


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
@pytest.mark.parametrize("seed", range(3))
def test_words_in_parts_of_any_size(monkeypatch, size, seed):
    """Parts end between words, also in texts of one word that fills many parts."""
    monkeypatch.setattr(words, "SLICE", size)
    rows = texts(seed)
    found = words.find_words(pa.array(rows, pa.string()), prefixes=(2,))
    want = [plain.WORDS.findall((t or "").translate(plain.LOWER)) for t in rows]
    assert found.counts().tolist() == [len(w) for w in want]
    flat = [word for own in want for word in own]
    spelled = [bytes(found.data[a:b]).decode() for a, b in zip(found.start, found.end)]
    assert [word.translate(plain.LOWER) for word in spelled] == flat
    by_word = {}
    for word, h, head in zip(flat, found.hash.tolist(), found.prefix[2].tolist()):
        assert by_word.setdefault(word, h) == h
        assert (head == 0) == (len(word.encode()) < 2)
    assert len(set(by_word.values())) == len(by_word)


@pytest.mark.parametrize("width", [1, 3, 5])
def test_shingles(width):
    rows = texts(width, 60)
    hashes, bounds = words.shingles(words.find_words(pa.array(rows, pa.string())), width)
    seen = {}
    for text, at, to in zip(rows, bounds[:-1], bounds[1:]):
        own = set(hashes[at:to].tolist())
        want = plain.shingle_set(text, width)
        assert len(own) == len(want)
        assert seen.setdefault(want, own) == own


def test_slices_hold_whole_texts():
    column = pa.array(["aa", None, "b" * 50, "", "c", "dd"] * 3).slice(1)
    parts = list(words.slices(column, 5))
    assert [x for part in parts for x in part.to_pylist()] == column.to_pylist()
    assert max(len(words.buffers(part)[0]) for part in parts) == 50


@pytest.mark.parametrize("seed", range(4))
def test_base_counts(seed):
    rows = texts(seed) + ["a b c d e a b c d e", "x\ny\nx\n x\n\n\n", "a a a a a a a"]
    found = quality.base_counts(pa.array(rows, pa.string()))
    for i, text in enumerate(rows):
        assert {name: int(values[i]) for name, values in found.items()} == plain.base_counts(text)


def test_grams_of_parts(monkeypatch):
    """Each n-gram of a long text is counted once, whatever the parts."""
    data = np.frombuffer(bytes(range(97, 123)) * 9, np.uint8)
    whole = np.sort(quality._grams(data, 1 << 18))
    monkeypatch.setattr(quality, "SLICE", 10)
    parts = np.sort(np.concatenate([quality._grams(p, 1 << 18) for p in quality._parts(data)]))
    assert parts.tolist() == whole.tolist()


@pytest.mark.parametrize("size", [1, 5, 16, 40])
def test_long_texts_piece_by_piece(monkeypatch, size):
    """What is told of a text does not depend on the pieces it is gone through in."""
    rows = [t for t in texts(size, 60) if t] + ["a b c d e f " * 9, "##!!!x" * 9, "x\n y \n\nx\nx", "\n\n", "A1" * 30]
    for text in rows:
        column = pa.array([text])
        monkeypatch.setattr(words, "SLICE", 1 << 18)
        terms = set(np.concatenate([h for _, h in toxicity._pairs(column)]).tolist())
        sets = {w: next(minhash._sets(column, w)).tolist() for w in (1, 3, 5)}
        monkeypatch.setattr(words, "SLICE", size)
        assert words.is_long(column) == (len(text.encode()) > size)
        found = quality.base_counts(column)
        assert {name: int(values[0]) for name, values in found.items()} == plain.base_counts(text)
        assert {w: next(minhash._sets(column, w)).tolist() for w in (1, 3, 5)} == sets
        # A word of several pieces is one piece.
        assert set(np.concatenate([h for _, h in toxicity._pairs(column)]).tolist()) - {0} == terms - {0}


_PEAK = """
import resource, sys
import numpy as np, pyarrow as pa
from smelter.llm import minhash, quality, toxicity, words
rng = np.random.default_rng(1)
letters = rng.integers(97, 123, 8 << 20).astype(np.uint8)
letters[rng.random(8 << 20) < 0.4] = 32
letters[:: 1000] = 10
column = pa.array([letters.tobytes().decode()])
small = pa.array(["some words to load the code with " * 99] * 50)
vocabulary = toxicity.Vocabulary(np.arange(4000, dtype=np.uint64))
work = {
    "op1": lambda c: (vocabulary.present(c), list(toxicity._term_counts(iter([pa.RecordBatch.from_arrays([c], ["text"])])))),
    "op4": lambda c: quality._scored(c, np.zeros(1 << 18, np.float32)),
    "op7": lambda c: list(minhash._signature_columns(3)(iter([pa.RecordBatch.from_arrays([c, c], ["key", "text"])]))),
}[sys.argv[1]]
work(small)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
work(column)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


@pytest.mark.parametrize("name", ["op1", "op4", "op7"])
def test_memory_of_a_very_long_text(name):
    """8 MB of short words take less than 150 MB."""
    run = subprocess.run([sys.executable, "-c", _PEAK, name], capture_output=True, text=True, cwd=ROOT)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) < 150


def test_components(spark):
    """Chains, stars and rings, with repeated links in both directions."""
    draw = random.Random(5)
    links = [(i, i + 1) for i in range(30)] + [(50, i) for i in range(51, 80)] + [(90, 91), (91, 92), (92, 90)]
    links = [(b, a) if draw.random() < 0.5 else (a, b) for a, b in links + links[:9]] + [(99, 99)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "u long, v long")).collect()))
    want = {i: 0 for i in range(31)} | {i: 50 for i in range(50, 80)} | {i: 90 for i in range(90, 93)}
    assert got == want
    none = spark.createDataFrame([], "u long, v long")
    assert components(none).collect() == []
