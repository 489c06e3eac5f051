"""Each query against its SQL, or against a plain version of the operator."""

import hashlib
import pathlib
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
import public_tokenizers
from smelter.llm import bpe, quality, toxicity
from smelter.llm.queries import ORACLES, QUERIES

import plain

LARGER = pathlib.Path("/root/testdata/sf0.1")


@pytest.fixture(scope="module")
def texts(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


@pytest.fixture(scope="module")
def results(spark, folder):
    """Rows of each query, run once."""
    seen = {}

    def run(name):
        if name not in seen:
            seen[name] = contract.queries()[name](spark, folder).collect()
        return seen[name]

    return run


def test_every_number_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "near_dedup", "mixing", "bpe"
    ]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(results, duck, name):
    got = results(name)
    columns = sorted(got[0].__fields__)
    want = duck.sql(f"select {', '.join(columns)} from ({ORACLES[name]})").fetchall()
    key = lambda row: [(v is None, str(v)) for v in row]
    assert sorted([tuple(r[c] for c in columns) for r in got], key=key) == sorted(want, key=key)


def test_bpe_query(results, texts):
    own = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.encoding(bpe.default_ranks(), public_tokenizers.PATTERN)._mergeable_ranks,
    )
    got = {r.doc_id: r for r in results("op5_bpe")}
    assert set(got) == set(texts)
    for doc_id, text in texts.items():
        ids = own.encode_ordinary(text or "")
        row = got[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_token_output_query(results, texts):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in results("op9_token_output")}
    start = 0
    for doc_id in sorted(texts):
        ids = own.encode(texts[doc_id] or "", add_special_tokens=False).ids + [0]
        row = got[doc_id]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(got) == len(texts)


def test_token_counts_query(results, texts):
    own = bpe.encoding(bpe.default_ranks(), public_tokenizers.PATTERN)
    lengths = np.array([len(own.encode_ordinary(t or "")) for t in texts.values()])
    got = {r.n_tokens: r for r in results("op10_token_counts")}
    assert {n: r.n_docs for n, r in got.items()} == dict(Counter(lengths.tolist()))
    for n, row in got.items():
        assert row.docs_at_least == (lengths >= n).sum()
        assert row.tokens_at_least == lengths[lengths >= n].sum()
        assert row.docs_up_to == (lengths <= n).sum()
        assert row.truncated_tokens == np.minimum(lengths, n).sum()


def test_minhash_query(results, texts):
    want = plain.near_duplicates(texts, 3, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in results("op7_minhash")}
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}
    assert sum(i != c for i, (_, c) in want.items()) > 5


def test_quality_query(results, texts):
    got = {r.doc_id: r for r in results("op4_quality")}
    assert set(got) == set(texts)
    for doc_id, text in texts.items():
        row, want = got[doc_id], plain.base_counts(text)
        assert {k: row[k] for k in want} == want
        failed = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
        assert row.base_failed == failed
        assert row.kept == (not failed and row.score >= quality.THRESHOLD)


@pytest.mark.skipif(not LARGER.exists(), reason="needs the test tables")
def test_quality_on_held_out_labels(spark):
    """Labels that the target did not have: good texts stay, poor ones go."""
    scored = contract.queries()["op4_quality"](spark, str(LARGER)).where("not base_failed")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").where(toxicity.held_out(F.col("doc_id")))
    counts = Counter(tuple(r) for r in scored.join(labels, "doc_id").select("quality", "kept").collect())
    assert counts[1, True] >= 0.99 * (counts[1, True] + counts[1, False])
    assert counts[0, False] >= 0.9 * (counts[0, True] + counts[0, False])


def test_toxicity_query(results, texts):
    got = results("op1_toxicity")
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    for row in got:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1
        assert row.predicted == int(row.score >= 0.7)


@pytest.mark.skipif(not LARGER.exists(), reason="needs the test tables")
def test_toxicity_on_held_out_labels(spark):
    """Labels that were not learnt from: few clean texts are hit, most toxic ones are."""
    scored = contract.queries()["op1_toxicity"](spark, str(LARGER)).where("held_out")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    counts = Counter(tuple(r) for r in scored.join(labels, "doc_id").select("toxic", "predicted").collect())
    assert counts[1, 1] >= 0.85 * (counts[1, 1] + counts[1, 0])
    assert counts[0, 1] <= 0.01 * (counts[0, 0] + counts[0, 1])


def test_mixing_query(results, texts):
    got = results("op8_mixing")
    assert len(got) == len(texts) and len({r.position for r in got}) == len(got)
    by_block = {}
    for r in got:
        by_block.setdefault((r.source, r.block), set()).add((r.slot, r.release, r.deadline))
        assert r.release <= r.slot < r.deadline
    assert all(len(places) == 1 for places in by_block.values())
    assert len({slot for places in by_block.values() for slot, _, _ in places}) == len(by_block)


def test_pipeline(spark, folder, results, texts):
    rows = results("pipeline")
    ids = [r.doc_id for r in rows]
    assert len(set(ids)) == len(ids) and set(ids) <= set(texts)
    # The mix numbers the rows without gaps.
    assert sorted(r.mix_rank for r in rows) == list(range(len(rows)))
    # Each stage again, by plain means.
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scored = toxicity.toxicity(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    clean = {r.doc_id: (r.source, r.text) for r in scored.where("predicted = 0").collect()}
    lines = plain.site_lines(clean, 0.1, 1, 3, 0.5)
    classes = plain.near_duplicates({i: t for i, (_, t) in lines.items()}, 5, 80)
    kept = {i: lines[i][1] for i, (_, c) in classes.items() if i == c}
    assert set(ids) == set(kept)
    own = bpe.encoding(bpe.default_ranks(), public_tokenizers.PATTERN)
    for r in rows:
        assert bytes(r.ids) == np.array(own.encode_ordinary(kept[r.doc_id]), "<u4").tobytes()
        assert (r.n_tokens, r.n_chars) == (len(r.ids) // 4, len(kept[r.doc_id]))
