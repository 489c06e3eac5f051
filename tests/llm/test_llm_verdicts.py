"""Scores of operator 4 against a plain version; long texts in operators 2 and 10."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from smelter.llm import bpe, chat_format, quality, token_counts, toxicity
from smelter.llm.queries import QUERIES
from smelter.llm.words import mix

import plain

SIDES = "pair_id long, chosen boolean, turn int, role string, text string"
LONG = "words of a long text and more of them " * 100_000


def buckets(text):
    """The bucket of each 4-byte window of a text."""
    data = (text or "").encode()
    grams = [int.from_bytes(data[i : i + quality.GRAM], "big") for i in range(len(data) - quality.GRAM + 1)]
    return (mix(np.array(grams, np.uint64)) % np.uint64(quality.BUCKETS)).tolist()


def test_scores_and_verdicts_equal_plain_ones(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(~toxicity.held_out(F.col("doc_id")))
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    grams = {i: buckets(t) for i, t in texts.items()}
    raw, target = Counter(), Counter()
    for i, own in grams.items():
        raw.update(own)
        if i in good:
            target.update(own)
    of_raw, of_target = (sum(c.values()) + quality.BUCKETS for c in (raw, target))
    got = {r.doc_id: r for r in QUERIES["op4_quality"](spark, folder).collect()}
    assert set(got) == set(texts)
    verdicts = Counter()
    for i, own in grams.items():
        ratios = [math.log((target[b] + 1) / of_target) - math.log((raw[b] + 1) / of_raw) for b in own]
        score = sum(ratios) / len(ratios) if ratios else 0.0
        assert got[i].score == pytest.approx(score, abs=1e-5)
        base = plain.base_counts(texts[i])
        failed = base["n_words"] < 10 or 100 * base["n_repeat_words"] > 20 * base["n_words"]
        if abs(score - quality.THRESHOLD) > 1e-4:
            assert got[i].kept == (not failed and score >= quality.THRESHOLD)
        verdicts[failed, got[i].kept] += 1
    assert min(verdicts[True, False], verdicts[False, True]) > 0


def test_long_texts_in_token_counts(spark):
    """Extra columns are no matter, whatever their names."""
    docs = spark.createDataFrame([(LONG, 1, "x"), ("", 2, "y"), (None, 3, "z")], "text string, n_docs int, N_TOKENS_ string")
    lengths = docs.select(bpe.token_count(docs.text).alias("n_tokens"), "n_docs", "N_TOKENS_")
    found = {r.n_tokens: r.n_docs for r in token_counts.suffix_sums(token_counts.length_histogram(lengths)).collect()}
    assert found[0] == 2 and sum(found.values()) == 3
    assert max(found) == len(bpe.encoding(bpe.default_ranks(), bpe.public_tokenizers.PATTERN).encode_ordinary(LONG))


def test_long_texts_in_chat_format(spark):
    """A conversation of one long turn is rendered whole."""
    turns = [(1, True, 0, "user", LONG), (1, False, 0, "user", LONG), (1, True, 1, "assistant", LONG), (1, False, 1, "assistant", "no")]
    rows = spark.createDataFrame(turns, SIDES)
    (row,) = chat_format.format_preferences(rows).collect()
    assert row.n_prompt_turns == 1 and LONG in row.prompt
    assert LONG in row.chosen and LONG not in row.rejected and "no" in row.rejected

