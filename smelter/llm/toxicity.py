"""Toxicity by weak supervision.

Voters are terms (words, and stems of 4 to 6 bytes) that are much commoner in texts labelled toxic,
and patterns of writing. A generative label model estimates, by expectation maximisation, how often
each voter fires on toxic and on clean texts, how correlated voters of one class are, and how
reliable the given labels are; voters that say the same thing share one vote. Its posterior labels
train a logistic regression over the presence of terms and patterns, which scores every whole text.

Of the labelled rows a bounded sample (MOST_LABELLED), chosen by a hash of their key, is learnt
from; of the rows without a label all are. Texts become sets of features where they lie, equal sets
are counted, and both the label model and the regression are fitted on these counts by Spark; the
driver gets sums whose number depends on the voters alone. All rows without a label weigh at most as
much as the labelled ones. Rows that are held out are never learnt from. Rows of equal key and text
are one document to learn from.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smelter.llm.arrow import from_texts, release
from smelter.llm.tables import apart, named, with_results
from smelter.llm.words import Words, buffers, column_of, distinct_hashes, find_words, is_long, mix, pieces, slices
from smelter.operators import scratch_until_done, stage

#: Labelled rows that the model is fitted on at most.
MOST_LABELLED = 40_000
#: Different texts of one key among them at most.
MOST_TEXTS = 16
#: Toxic texts in which a term must occur; terms looked at, used by the classifier, and made voters
#: at most.
LEAST_SUPPORT, MOST_CANDIDATES, MOST_FEATURES, MOST_VOTERS = 5, 200_000, 4_000, 256
#: Share of toxic texts among those with a term, as a lower bound, that makes it a feature.
LEAST_PRECISION = 0.5
#: Score from which a text is predicted toxic.
THRESHOLD = 0.7
ROUNDS = 8
#: A voter is telling if it fires this many times as often on toxic texts.
TELLING = 3.0
#: Correlation within a class from which two voters share a vote.
SAME = 0.4
REGULARISATION = 1e-6
#: Texts whose votes are looked at together, and the unit in which their weights are summed exactly.
_ROWS, _UNIT = 4096, 1 << 20

STEMS = (4, 5, 6)
_MARKS = tuple(b for b in range(128) if not chr(b).isalnum())
_SYMBOLS = np.frombuffer(b"#*$%&|<>!?", np.uint8)
PATTERNS = ("symbol run", "doubled mark", "mostly capitals", "few words", "a digit")
_PATTERN_HASHES = mix(np.arange(1, len(PATTERNS) + 1, dtype=np.uint64))
_FILTER_BITS = 20


def held_out(key: Column) -> Column:
    """Rows that nothing is learnt from: crc32 of the key as text leaves 1 modulo 3, or no key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def _patterns(column: pa.Array, words: Words) -> np.ndarray:
    """Which patterns each text shows."""
    data, offsets = words.data, words.offsets
    n = len(words)

    def some(marks: np.ndarray, width: int = 1) -> np.ndarray:
        # A mark at i covers bytes i to i + width - 1, all of which must lie in one text.
        sums = np.zeros(len(data) + 1, np.int64)
        sums[1 : len(marks) + 1] = np.cumsum(marks)
        sums[len(marks) + 1 :] = sums[len(marks)]
        end = np.maximum(offsets[1:] - (width - 1), offsets[:-1])
        return sums[end] - sums[offsets[:-1]]

    doubled, tripled = _marks(data)
    counted = [
        some(tripled, 3), some(doubled, 2),
        some((data >= 65) & (data <= 90)), some(((data | 32) >= 97) & ((data | 32) <= 122)),
        words.counts(), some((data >= 48) & (data <= 57)),
    ]
    return _shown(np.stack(counted, axis=1) if n else np.zeros((0, 6), np.int64))


def _marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a symbol is followed by itself once, and twice."""
    symbol = np.isin(data, _SYMBOLS)
    doubled = symbol[1:] & (data[1:] == data[:-1]) if len(data) > 1 else np.zeros(0, bool)
    tripled = doubled[1:] & doubled[:-1] if len(data) > 2 else np.zeros(0, bool)
    return doubled, tripled


def _shown(counted: np.ndarray) -> np.ndarray:
    """Patterns from counts: tripled and doubled symbols, capitals, letters, words, digits."""
    tripled, doubled, capitals, letters, n_words, digits = counted.T
    few = n_words < 10
    return np.stack([tripled > 0, doubled > 0, 2 * capitals > np.maximum(letters, 1), few, digits > 0], axis=1)


def _long_pairs(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``_pairs`` of one text, piece by piece; its patterns come last."""
    counted = np.zeros((1, 6), np.int64)
    at = 0
    for piece in pieces(data, _MARKS):
        words = find_words(column_of(piece), separators=_MARKS, prefixes=STEMS)
        for values in (words.hash, *words.prefix.values()):
            values = np.unique(values[values != 0])
            yield np.zeros(len(values), np.int64), values
        # Symbols that are repeated across the end of the piece count for it.
        doubled, tripled = (marks[: len(piece)] for marks in _marks(data[at : at + len(piece) + 2]))
        low = piece | 32
        counted += [
            tripled.sum(), doubled.sum(), ((piece >= 65) & (piece <= 90)).sum(), ((low >= 97) & (low <= 122)).sum(),
            len(words.start), ((piece >= 48) & (piece <= 57)).sum(),
        ]
        at += len(piece)
    which = np.flatnonzero(_shown(counted)[0])
    yield np.zeros(len(which), np.int64), _PATTERN_HASHES[which]


def _pairs(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, hash) of the terms and patterns of some texts, repeated ones included."""
    if is_long(column):
        yield from _long_pairs(buffers(column)[0])
        return
    words = find_words(column, separators=_MARKS, prefixes=STEMS)
    text = words.text_of()
    yield text, words.hash
    for length in STEMS:
        heads = words.prefix[length]
        yield text[heads != 0], heads[heads != 0]
    where, which = np.nonzero(_patterns(column, words))
    yield where, _PATTERN_HASHES[which]


def _distinct(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[first], value[first]


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (text) to (term, n): in how many texts of a part each term occurs."""
    for batch in batches:
        for part in slices(batch.column("text")):
            if is_long(part):
                terms = distinct_hashes(values for _, values in _pairs(part))
            else:
                found = list(_pairs(part))
                _, terms = _distinct(np.concatenate([t for t, _ in found]), np.concatenate([h for _, h in found]))
            terms, n = np.unique(terms, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n)], ["term", "n"])
    release()


class Vocabulary:
    """A sorted set of terms, and which of them texts have."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.unique(np.asarray(terms).astype(np.uint64))
        self.low = np.uint64((1 << _FILTER_BITS) - 1)
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[self.terms & self.low] = True

    def __len__(self) -> int:
        return len(self.terms)

    def present(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(text, number of the term), each once, ascending."""
        texts, numbers = [], []
        for text, value in _pairs(column):
            near = self.maybe[value & self.low]
            text, value = text[near], value[near]
            if not len(value) or not len(self.terms):
                continue
            at = np.minimum(np.searchsorted(self.terms, value), len(self.terms) - 1)
            hit = self.terms[at] == value
            texts.append(text[hit])
            numbers.append(at[hit])
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return _distinct(np.concatenate(texts), np.concatenate(numbers))


@dataclass
class LabelModel:
    """A generative model of votes: rates of firing by class, redundancy, and the label's
    reliability.
    """

    prior: float
    rates: np.ndarray  # by class (clean, toxic) and voter
    shares: np.ndarray  # of one vote, by voter: 1 for a voter that is independent of all others
    label_rates: np.ndarray  # by class, how often the label says toxic
    silences: np.ndarray  # by class, how often none of the voters ``heard`` fires
    heard: np.ndarray  # voters whose joint silence speaks

    @classmethod
    def of_labels(cls, base: float, voters: int) -> LabelModel:
        """Where the estimation starts: labels are right in 98 of 100 cases, votes say nothing."""
        base = min(max(base, 1e-4), 1 - 1e-4)
        prior = 0.98 * base + 0.02 * (1 - base)
        said = np.array([0.02 * base / (1 - prior), 0.98 * base / prior])
        even = np.full((2, voters), 0.5)
        return cls(prior, even, np.ones(voters), said, np.ones(2), np.zeros(voters, bool))

    @property
    def telling(self) -> np.ndarray:
        return self.rates[1] > TELLING * self.rates[0]

    def moments(self, votes: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """By class, the weighted sums of all products of two of: the votes, 1, a label is known, it
        says toxic, no telling voter fires.
        """
        posterior = self.posterior(votes, labels)
        more = np.stack([
            np.ones(len(votes)), labels >= 0, labels == 1, votes[:, self.telling].sum(axis=1) == 0
        ], axis=1)
        seen = np.concatenate([votes, more], axis=1).astype(np.float64)
        return np.stack([seen.T @ (seen * (weight * p)[:, None]) for p in (1 - posterior, posterior)])

    def refined(self, moments: np.ndarray) -> LabelModel:
        """The model that explains ``moments`` best."""
        n = len(self.shares)
        size, known, toxic, silent = (moments[:, n + i, n] for i in range(4))
        fired = moments[:, :n, n]
        total = np.zeros((n, n))
        for c in range(2):
            mean = fired[c] / max(size[c], 1e-9)
            covariance = moments[c, :n, :n] / max(size[c], 1e-9) - np.outer(mean, mean)
            deviation = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
            correlation = np.clip(covariance / np.outer(deviation, deviation), 0, 1)
            total = np.maximum(total, np.where(correlation >= SAME, correlation, 0))
        np.fill_diagonal(total, 0)
        return LabelModel(
            prior=float((known[1] + 1) / (known.sum() + 2)),
            rates=(fired + 0.5) / (size[:, None] + 1),
            shares=1 / (1 + total.sum(axis=1)),
            # The labels are trusted to begin with: the counts of a belief that 95 of 100 are right.
            label_rates=(toxic + np.array([5.0, 95.0])) / (known + 100),
            silences=(silent + 0.5) / (size + 1),
            heard=self.telling,
        )

    def posterior(self, votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Probability of toxic, from votes (texts x voters, 0 or 1) and labels (1, 0, or -1 for
        none). A voter that does not fire abstains; only the silence of all telling ones speaks,
        once, as they are not independent.
        """
        fired = np.log(self.rates[1] / self.rates[0])
        odds = math.log(self.prior / (1 - self.prior)) + votes @ (fired * self.shares)
        silent = votes[:, self.heard].sum(axis=1) == 0
        odds = odds + np.where(silent, math.log(self.silences[1] / self.silences[0]), 0.0)
        said = np.log(self.label_rates[1] / self.label_rates[0])
        unsaid = np.log((1 - self.label_rates[1]) / (1 - self.label_rates[0]))
        odds = odds + np.where(labels == 1, said, np.where(labels == 0, unsaid, 0.0))
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def _votes(batch: pa.RecordBatch, voters: np.ndarray, size: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, votes, labels) of a batch with the columns label and terms, some rows at a time."""
    column = np.full(size, -1)
    column[voters] = np.arange(len(voters))
    terms = batch.column("terms")
    offsets, own = terms.offsets.to_numpy(), column[terms.values.to_numpy()]
    labels = batch.column("label").fill_null(-1).to_numpy(zero_copy_only=False)
    for at in range(0, len(batch), _ROWS):
        rows = slice(at, min(at + _ROWS, len(batch)))
        bounds = offsets[rows.start : rows.stop + 1]
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        number = own[bounds[0] : bounds[-1]]
        votes = np.zeros((len(bounds) - 1, len(voters)), np.float32)
        votes[owner[number >= 0], number[number >= 0]] = 1
        yield rows, votes, labels[rows]


def _moments(patterns: DataFrame, model: LabelModel, voters: np.ndarray, size: int) -> np.ndarray:
    """The moments of all ``patterns``. Tasks sum for themselves and send whole numbers, so the
    order of tasks changes nothing; the driver gets a row for each pair of voters at most.
    """
    width = len(voters) + 4
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width, width))
        for batch in batches:
            weight = batch.column("weight").to_numpy()
            for rows, votes, labels in _votes(batch, voters, size):
                total += model.moments(votes, labels, weight[rows])
        sums = np.rint(total[:, *upper] * _UNIT).astype(np.int64)
        (cells,) = np.nonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (cells, *sums[:, cells])], ["cell", "clean", "toxic"])

    sums = patterns.mapInArrow(run, "cell long, clean long, toxic long").groupBy("cell")
    rows = sums.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()
    half = np.zeros((2, len(upper[0])))
    half[:, rows["cell"]] = rows[["clean", "toxic"]].to_numpy().T / _UNIT
    full = np.zeros((2, width, width))
    full[:, *upper] = half
    full[:, upper[1], upper[0]] = half
    return full


def fit_label_model(patterns: DataFrame, voters: np.ndarray, size: int, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation over ``patterns``: (label, terms, weight), terms being numbers below
    ``size`` and the label null where there is none. It is read once for each round: stage it.
    """
    base = patterns.agg(F.sum(F.col("label") * F.col("weight")) / F.sum(F.expr("if(label is null, 0, weight)"))).first()[0]
    model = LabelModel.of_labels(base or 0.0, len(voters))
    for _ in range(rounds):
        model = model.refined(_moments(patterns, model, voters, size))
    return model


def _posteriors(patterns: DataFrame, model: LabelModel, voters: np.ndarray, size: int) -> DataFrame:
    """(terms, weight, posterior) of all ``patterns``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.posterior(votes, labels) for _, votes, labels in _votes(batch, voters, size)]
            columns = [batch.column("terms"), batch.column("weight"), pa.array(np.concatenate([np.zeros(0), *found]))]
            yield pa.RecordBatch.from_arrays(columns, ["terms", "weight", "posterior"])

    return patterns.mapInArrow(run, "terms array<int>, weight double, posterior double")


@dataclass
class Model:
    """The classifier: weights of its terms, and the weight of every text."""

    vocabulary: Vocabulary
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        text, term = self.vocabulary.present(column)
        total = np.bincount(text, weights=self.weights[term], minlength=len(column)) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _least(rows: DataFrame, hashed: Column, most: int) -> DataFrame:
    """The ``most`` rows of the least hashes (0 to 2^63 - 1), without a sort: rows are counted by 16
    bits of their hash at a time. ``rows`` is read up to four times: stage it.
    """
    low, bits = 0, 63
    while bits:
        step = min(16, bits)
        bits -= step
        inside = rows.where(F.shiftright(hashed, bits + step) == low)
        sizes = inside.groupBy(F.shiftright(hashed, bits).alias("at")).count().collect()  # 2^16 rows at most
        for at, n in sorted((r["at"], r["count"]) for r in sizes):
            if n > most:
                low = at
                break
            most -= n
        else:
            return rows.where(F.shiftright(hashed, bits + step) <= low)
        if not most:
            break
    return rows.where(F.shiftright(hashed, bits) < low)


def _given(labels: DataFrame) -> DataFrame:
    """(key, label, h): one label a key that may be learnt from, and a hash of the key."""
    return (
        labels.where(F.col("label").isin(0, 1) & ~held_out(F.col("key")))
        .groupBy("key")
        .agg(F.max("label").cast("int").alias("label"))
        .withColumn("h", F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "key"), 1))
    )


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, label): the labelled rows to learn from.

    The keys are bounded by MOST_LABELLED, so they are broadcast. Rows of equal key and text count
    once, and if keys have several texts, the first of each key come before any second one: the
    limit holds for rows too. Texts are shuffled only if a sampled one repeats.
    """
    hashed = F.col("h")
    keys = stage(_least(stage(_given(labels), "given"), hashed, MOST_LABELLED), "sample")
    marked = docs.withColumn("x", F.xxhash64("text")).withColumn("y", F.hash("text"))
    found = (
        docs.join(F.broadcast(keys), "key")
        .groupBy("key", "label", "h", F.xxhash64("text").alias("x"), F.hash("text").alias("y"))
        .agg(F.count("*").alias("copies"))
        .withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("x", "y")))
        .where(F.col("nth") <= MOST_TEXTS)
    )
    found = stage(found, "sample-keys")
    sizes = dict(found.groupBy("nth").count().collect())
    chosen, room = found.where("false"), MOST_LABELLED
    for nth in sorted(sizes):  # MOST_TEXTS of them at most
        chosen = chosen.unionByName(_least(found.where(F.col("nth") == nth), hashed, room))
        room -= min(room, sizes[nth])
        if not room:
            break
    chosen = stage(chosen.select("key", "x", "y", "label", "copies"), "sample-rows")
    rows = marked.join(F.broadcast(chosen.drop("copies")), ["key", "x", "y"])
    if not chosen.where("copies > 1").isEmpty():
        rows = rows.groupBy("key", "x", "y").agg(F.first("text").alias("text"), F.first("label").alias("label"))
    return rows.select("text", "label")


def _lower_bound(hits: Column, of: Column, z: float = 2.0) -> Column:
    """Lower end of the Wilson interval of hits / of."""
    share = hits / of
    spread = z * F.sqrt(share * (1 - share) / of + z * z / (4 * of * of))
    return (share + z * z / (2 * of) - spread) / (1 + z * z / of)


def _vectors(texts: DataFrame, vocabulary: Vocabulary, column: str) -> DataFrame:
    """(``column``, terms): numbers of the terms that each text has, staged."""
    model = texts.sparkSession.sparkContext.broadcast(vocabulary)  # at most MOST_CANDIDATES terms

    def numbers(part: pa.Array) -> pa.Array:
        text, term = model.value.present(part)
        bounds = np.searchsorted(text, np.arange(len(part) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(term.astype(np.int32)))

    found = stage(texts.select(column, from_texts(numbers, "array<int>")("text").alias("terms")), "vectors")
    model.destroy()
    return found


def _patterns_of(docs: DataFrame, labels: DataFrame, sample: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(label, terms, weight): the sets of features of the sample and of all rows without a label.

    Keys and sets move, texts do not. Equal sets are counted before they move; the weights of the
    rows without a label are scaled down so that all of them weigh as much as the sample at most.
    """
    free = _vectors(docs.where(~held_out(F.col("key"))), vocabulary, "key").distinct()
    free = free.join(stage(_given(labels).select("key"), "given-keys"), "key", "left_anti")
    free = stage(free.groupBy("terms").agg(F.count("*").alias("n")), "unlabelled")
    own = stage(_vectors(sample, vocabulary, "label").groupBy("label", "terms").agg(F.count("*").alias("n")), "labelled")
    of_free, of_own = (t.agg(F.sum("n")).first()[0] or 0 for t in (free, own))
    scale = min(1.0, of_own / of_free) if of_free else 1.0
    both = own.select("label", "terms", F.col("n").cast("double").alias("weight")).unionByName(
        free.select(F.lit(None).cast("int").alias("label"), "terms", (F.col("n") * scale).alias("weight"))
    )
    return stage(both, "patterns")


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label_key: str, label: str) -> Model:
    """Learn the classifier. What reaches the driver is bounded by the parameters above."""
    rows, labels = apart(docs, key=key, text=text), apart(labels, key=label_key, label=label)
    sample = stage(_sample(rows, labels), "sample-texts")

    in_toxic = (
        sample.where("label = 1").mapInArrow(_term_counts, "term long, n long")
        .groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_SUPPORT)
        .orderBy(F.desc("n"), "term").limit(MOST_CANDIDATES)
    )
    terms = np.array([r[0] for r in in_toxic.select("term").collect()], np.int64).view(np.uint64)
    candidates = Vocabulary(np.concatenate([terms, _PATTERN_HASHES]))
    vectors = _vectors(sample, candidates, "label")

    hits, of = F.sum("label"), F.count("label")
    stats = (
        vectors.select("label", F.explode("terms").alias("term"))
        .groupBy("term").agg(hits.alias("hits"), of.alias("of")).where("hits > 0")
        .select("term", "hits", _lower_bound(F.col("hits"), F.col("of")).alias("bound"))
    )
    pattern = F.col("term").isin(np.searchsorted(candidates.terms, _PATTERN_HASHES).tolist())
    useful = (
        stats.where((F.col("bound") >= LEAST_PRECISION) | pattern)
        .orderBy(F.desc(F.col("bound") * F.sqrt("hits")), "term").limit(MOST_FEATURES)
    )
    features = np.array([r[0] for r in useful.select("term").collect()], np.int64)
    base = vectors.agg(F.avg("label")).first()[0] or 0.0
    if not len(features) or base in (0.0, 1.0):
        return Model(Vocabulary(np.zeros(0, np.uint64)), np.zeros(0), _log_odds(base))

    vocabulary = Vocabulary(candidates.terms[features])
    voters = np.searchsorted(vocabulary.terms, candidates.terms[features[:MOST_VOTERS]])
    patterns = _patterns_of(rows, labels, sample, vocabulary)
    # Texts with the same votes are one row for the label model.
    votes = F.array_intersect("terms", F.array(*[F.lit(int(v)) for v in voters]))
    ballots = patterns.groupBy("label", votes.alias("terms")).agg(F.sum("weight").alias("weight"))
    model = fit_label_model(stage(ballots, "ballots"), voters, len(vocabulary))
    weights, bias = _regression(_posteriors(patterns, model, voters, len(vocabulary)), len(vocabulary))
    return Model(vocabulary, weights, bias)


def _log_odds(share: float) -> float:
    share = min(max(share, 1e-4), 1 - 1e-4)
    return math.log(share / (1 - share))


def _regression(patterns: DataFrame, size: int) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels: each text counts for both classes, by its posterior.

    ``patterns``: (terms, weight, posterior).
    """
    sides = F.array(
        F.struct(F.lit(0.0).alias("label"), (F.col("weight") * (1 - F.col("posterior"))).alias("weight")),
        F.struct(F.lit(1.0).alias("label"), (F.col("weight") * F.col("posterior")).alias("weight")),
    )
    rows = patterns.select("terms", F.explode(sides).alias("side")).groupBy("terms", "side.label")
    rows = rows.agg(F.sum("side.weight").alias("weight")).where("weight > 1e-6")
    rows = stage(rows.select("label", "weight", F.col("terms").cast("array<string>").alias("names")), "training")
    places = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(size)], inputCol="names", outputCol="features", binary=True
    )
    regression = LogisticRegression(
        weightCol="weight", regParam=REGULARISATION, maxIter=100, tol=1e-6, standardization=False, family="binomial"
    )
    model = regression.fit(places.transform(rows))
    return np.array(model.coefficients.toArray()), float(model.intercept)


def score_texts(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MOST_FEATURES weights

    score = from_texts(lambda part: pa.array(shared.value.scores(part), pa.float64()), "double")
    scored = docs.withColumn("__score", score(named(text)))
    return with_results(
        scored,
        {
            "held_out": held_out(named(key)),
            "score": F.col("__score"),
            "predicted": (F.col("__score") >= THRESHOLD).cast("int"),
        },
    ).drop("__score")


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label_key: str = "doc_id",
    label: str = "toxic",
) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from THRESHOLD on).

    Only labels of rows that are not held out are learnt from; nothing but the text is an input of a
    score.

    Defined cases: a null or empty text scores by the bias alone and its few words; labels other
    than 0 and 1, and those of null keys, are ignored; of several labels of a key the largest holds;
    without labels, or with one class only, every score is the share of that class (at least
    0.0001); an empty table gives an empty result; input columns named like a result are replaced.
    """
    with scratch_until_done(docs.sparkSession):
        model = fit(docs, labels, key, text, label_key, label)
    return score_texts(docs, model, key, text)
