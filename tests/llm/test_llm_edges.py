"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import plain
from smelter.llm import (
    bpe,
    chat_format,
    exact_dedup,
    line_dedup,
    minhash,
    mixing,
    quality,
    token_counts,
    token_output,
    toxicity,
)
from smelter.llm.queries import QUERIES
from smelter.operators import scratch_path

LONG = "a long text of words and more " * 20_000
# The last columns are named like results or like columns of a join.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, KEPT string, ids string, score string, "
    "component_id string, position string, n_lines string, bucket string, key string, node string, held_out string"
)
EXTRA = ("clash",) * 9 + ("y",)
DOCS = [
    (1, "one two three four five six", "en", "a", 27, *EXTRA),
    (2, "One two three four five six", "en", "a", 27, *EXTRA),
    (2, "One two three four five six", "en", "a", 27, *EXTRA),
    (3, None, None, None, None, *EXTRA),
    (4, "", "en", "b", 0, *EXTRA),
    (None, "quite another text", "de", "b", 18, *EXTRA),
    (5, " \n\t ", "en", "b", 4, *EXTRA),
    (6, LONG, "en", "a", len(LONG), *EXTRA),
    (7, "äöü ß 日本語\nline\nline", "de", "c", 20, *EXTRA),
]
LABELS = [(1, 1, 0), (2, 1, 0), (6, 0, 1), (7, 1, None), (None, 1, 1), (4, 0, 0), (4, 0, 5)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def run(name, docs, labels, spark):
    if name == "toxicity":
        return toxicity.toxicity(docs, labels)
    if name == "line_dedup":
        return line_dedup.line_dedup(docs, "source", least_pages=2, least_hits=2, most_share=0.4)
    if name == "quality":
        return quality.quality(docs, labels.where("quality = 1"))
    if name == "bpe":
        return bpe.decode(bpe.encode(docs, chunk=1000, overlap=100))
    if name == "exact_dedup":
        return exact_dedup.exact_dedup(exact_dedup.fingerprints(docs))
    if name == "minhash":
        return minhash.near_dedup(docs)
    weights = spark.createDataFrame([("", 2), ("a", 5), ("b", 3), ("c", 1), ("none", 7)], "source string, weight int")
    return mixing.mix(docs, weights, block_rows=2, range_rows=2)


RESULTS = {
    "toxicity": ["held_out", "score", "predicted"],
    "line_dedup": ["text", "n_lines", "n_dropped_lines"],
    "quality": ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"],
    "bpe": ["ids", "decoded"],
    "exact_dedup": ["text_sha256", "keep_id", "group_size", "kept"],
    "minhash": ["n_shingles", "component_id", "kept"],
    "mixing": ["block", "slot", "release", "deadline", "position"],
}


@pytest.mark.parametrize("name", sorted(RESULTS))
def test_columns_and_rows(spark, docs, labels, name):
    """All rows come out once, results replace columns of their names, the others stay."""
    got = run(name, docs, labels, spark)
    results = RESULTS[name]
    clashing = {c.lower() for c in results}
    assert got.columns[-len(results) :] == results
    assert set(got.columns) == {c for c in docs.columns if c.lower() not in clashing} | set(results)
    ids = sorted((r.doc_id for r in got.collect()), key=str)
    assert ids == sorted((row[0] for row in DOCS), key=str)


@pytest.mark.parametrize("name", sorted(RESULTS))
def test_empty_table(spark, docs, labels, name):
    got = run(name, docs.where("false"), labels, spark)
    assert got.collect() == []
    assert got.columns[-len(RESULTS[name]) :] == RESULTS[name]


@pytest.mark.parametrize("name", ["toxicity", "quality"])
def test_without_labels(spark, docs, labels, name):
    got = run(name, docs, labels.where("false"), spark).collect()
    assert len(got) == len(DOCS)
    assert len({r.score for r in got}) == 1


def test_one_class_of_labels(spark, docs, labels):
    for toxic, low in ((0, True), (1, False)):
        one = labels.where("doc_id is not null").withColumn("toxic", F.lit(toxic))
        scores = {r.score for r in toxicity.toxicity(docs, one).collect()}
        assert all(s < 0.5 if low else s > 0.5 for s in scores)


def test_exact_dedup_cases(spark, docs):
    got = run("exact_dedup", docs, None, spark).collect()
    by = {(r.doc_id, r.text): (r.keep_id, r.group_size, r.kept) for r in got}
    assert by[1, "one two three four five six"] == (2, 3, False)
    assert by[2, "One two three four five six"] == (2, 3, True)
    assert by[3, None] == (4, 2, False) and by[4, ""] == (4, 2, True)
    assert by[None, "quite another text"] == (None, 1, True)


@pytest.mark.parametrize("most_words", [1, 2, 64])
def test_exact_dedup_with_a_full_filter(spark, most_words):
    """A filter that lets all rows through changes nothing."""
    docs = spark.range(300).selectExpr("id as doc_id", "concat('T', id % 97) as text")
    got = exact_dedup.exact_dedup(exact_dedup.fingerprints(docs), most_words=most_words).collect()
    assert len(got) == 300
    for r in got:
        members = [i for i in range(300) if i % 97 == r.doc_id % 97]
        assert (r.keep_id, r.group_size, r.kept) == (members[-1], len(members), r.doc_id == members[-1])
    with pytest.raises(ValueError):
        exact_dedup.exact_dedup(exact_dedup.fingerprints(docs), most_words=3)


@pytest.mark.parametrize("most", [1, 4, 1 << 12])
def test_first_filter_of_exact_dedup(spark, most, capsys):
    """However full, it misses no repeated hash; its words move, not the rows' hashes."""
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('T', if(id < 40, id % 20, id)) as text")
    prints = exact_dedup.fingerprints(docs)
    got = exact_dedup.exact_dedup(prints, most_cell_words=most).where("group_size > 1").collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {(i, i % 20 + 20, i >= 20) for i in range(40)}
    hashed = prints.select(F.xxhash64("text_sha256").alias("__hash"))
    hashed = hashed.withColumn("__word_of", F.col("__hash").bitwiseAND(most - 1))
    found = exact_dedup._repeating(hashed)
    assert found.count() <= (1 if most == 1 else 4 if most == 4 else 1200)
    found.explain()
    plan = capsys.readouterr().out
    exchange = next(x for x in plan.splitlines() if "Exchange" in x)
    below = plan[plan.index(exchange) :]
    assert "partial_bit_or" in below and "hashpartitioning(__word_of" in exchange
    with pytest.raises(ValueError):
        exact_dedup.exact_dedup(prints, most_cell_words=3)


def test_minhash_cases(spark, docs):
    got = {(r.doc_id, r.text): (r.n_shingles, r.component_id, r.kept) for r in minhash.near_dedup(docs).collect()}
    assert got[1, "one two three four five six"] == (2, 1, True)
    assert got[2, "One two three four five six"] == (2, 1, False)
    assert got[3, None] == (0, 3, True) and got[4, ""] == (0, 4, True) and got[5, " \n\t "] == (0, 5, True)
    assert got[None, "quite another text"] == (1, None, True)


def test_line_dedup_cases(spark):
    rows = [(i, "h" if i else None, f"top\nown {i}\n\nown {i}") for i in range(30)] + [(30, "h", None), (31, "h", "top")]
    docs = spark.createDataFrame(rows, "doc_id long, host string, text string")
    got = {r.doc_id: r for r in line_dedup.line_dedup(docs, "host").collect()}
    assert got[5].text == "own 5\n\nown 5" and (got[5].n_lines, got[5].n_dropped_lines) == (3, 1)
    assert got[0].text == rows[0][2]  # the only page of its host
    assert got[30].text is None and got[30].n_lines == 0
    assert got[31].text == "" and got[31].n_dropped_lines == 1


def test_a_page_that_was_copied_is_no_boilerplate(spark):
    rows = [(i, "h", "top\ncopied\ntwice" if i % 3 == 0 else f"top\nown {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, host string, text string")
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(docs, "host").collect()}
    assert got[0] == got[3] == "copied\ntwice" and got[1] == "own 1"


def test_a_footer_on_a_few_pages_of_a_host_goes(spark):
    rows = [(i, "h", f"own {i}\nfooter {i % 20}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, host string, text string")
    assert {r.text for r in line_dedup.line_dedup(docs, "host").collect()} == {f"own {i}" for i in range(100)}


def test_near_copies_above_the_ratio_stay_whole(spark):
    """One of them keeps its text, and the near-duplicate stage drops the others."""
    lines = [f"line {i} of one text with words {i * 7} {i * 11}" for i in range(20)]
    copies = ["\n".join(lines[:i] + lines[i + 1 :]) for i in range(6)]
    rows = [(i, "en", "s", t, len(t)) for i, t in enumerate(copies + [f"own text number {i}\nfooter" for i in range(40)])]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string, n_chars long")
    cut = corpus_pipeline.drop_boilerplate(spark, docs, "")
    assert {r.text for r in cut.where("doc_id > 5").collect()} == {f"own text number {i}" for i in range(40)}
    kept = {r.doc_id: r.text for r in corpus_pipeline.drop_near_copies(spark, cut, "").collect()}
    assert kept[0] == copies[0] and not set(kept) & set(range(1, 6))
    # Without that, they lose all their lines.
    bare = line_dedup.line_dedup(docs, "source", most_share=0.1)
    assert [r.text for r in bare.where("doc_id < 6").collect()] == [""] * 6


def test_copies_of_a_page_can_count(spark):
    rows = [(i, "h", "copied" if i < 9 else f"own {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, host string, text string")
    for once, n in ((True, 0), (False, 9)):
        got = line_dedup.line_dedup(docs, "host", copies_once=once)
        assert got.where("text = ''").count() == n


def test_small_hosts_are_judged_by_their_lines(spark):
    sizes = {"nineteen": 19, "three": 3, "two": 2}
    rows = [(h, f"own {i}\nfooter") for h, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "host string, text string")
    got = Counter((r.host, "footer" in r.text) for r in line_dedup.line_dedup(docs, "host").collect())
    # Two pages are less than LEAST_HITS.
    assert got == {("nineteen", False): 19, ("three", False): 3, ("two", True): 2}


def test_html_lines(spark):
    html = "<html><head><title>t</title></head><body><p>a<b>b</b></p>\n <br/>c <!-- x --><script>y</script> d</body>"
    frame = spark.createDataFrame([(html, "HTTP://Ex.org:80/a"), (None, None)], "html string, url string")
    got = frame.select(line_dedup.html_lines(F.col("html")), line_dedup.host_of(F.col("url"))).collect()
    assert [tuple(r) for r in got] == [("ab\nc \nd", "ex.org"), ("", "")]


TURNS = "pair_id long, chosen boolean, turn long, role string, text string, prompt string"


def test_preferences(spark):
    rows = [
        (1, True, 1, "assistant", "yes", "x"), (1, True, 0, "user", "q", "x"),
        (1, False, 0, "user", "q", "x"), (1, False, 1, "assistant", "no", "x"), (1, False, 2, "user", None, "x"),
        (2, True, 0, "user", "same", "x"), (2, False, 0, "user", "same", "x"),
        (3, True, 0, None, "only", "x"),
        (None, True, 0, "user", "lost", "x"), (4, None, 0, "user", "lost", "x"),
        (5, True, 0, "user", "a", "x"), (5, True, 0, "user", "a", "x"), (5, False, 0, "user", "a", "x"),
    ]
    got = {r.pair_id: r for r in chat_format.format_preferences(spark.createDataFrame(rows, TURNS)).collect()}
    assert set(got) == {1, 2, 3, 5}
    one = got[1]
    assert (one.n_prompt_turns, one.prompt) == (1, "<|im_start|>user\nq<|im_end|>\n")
    assert one.chosen == "<|im_start|>assistant\nyes<|im_end|>\n"
    assert one.rejected == "<|im_start|>assistant\nno<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    for text, spans in ((one.chosen, one.chosen_spans), (one.rejected, one.rejected_spans)):
        at, trained = 0, []
        for length, train in spans:
            if train:
                trained.append(text[at : at + length])
            at += length
        assert at == len(text) and len(trained) == 1 and trained[0].endswith("<|im_end|>\n")
    assert (got[2].chosen, got[2].rejected, got[2].n_prompt_turns) == ("", "", 1)
    assert got[3].rejected is None and got[3].prompt == "" and "only" in got[3].chosen
    assert got[5].n_prompt_turns == 1 and got[5].rejected == "" and got[5].chosen
    empty = spark.createDataFrame([], TURNS)
    assert chat_format.format_preferences(empty).collect() == []


def test_swapped_answers(spark):
    rows = [
        (0, 0, "user", "p"), (0, 1, "assistant", "x"), (1, 0, "user", "r"), (1, 1, "assistant", "y"),
        (2, 0, "user", "s"), (2, 1, "assistant", "z"), (3, 0, "user", "t"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.pair_id: r for r in chat_format.format_preferences(chat_format.swapped_answers(turns)).collect()}
    assert [got[i].n_prompt_turns for i in range(4)] == [1, 1, 1, 1]
    assert "x" in got[0].chosen and "y" in got[0].rejected and "y" in got[1].chosen and "x" in got[1].rejected
    assert "z" in got[2].chosen and got[2].rejected == "" and got[3].chosen == got[3].rejected == ""


@pytest.mark.parametrize("weights", [[1], [3, 2, 1], [7, 1, 1, 4], [50, 30, 20], [1, 1, 1, 1, 1]])
def test_schedule_is_pfair(spark, weights):
    """Earliest deadline first, and never a block away from each source's share."""
    sources = [f"s{i:02}" for i in range(len(weights))]
    rows = [(s * 10**6 + i, sources[s]) for s, w in enumerate(weights) for i in range(3 * w)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    shares = spark.createDataFrame(list(zip(sources, weights)), "source string, weight long")
    got = mixing.mix(docs, shares, block_rows=1).orderBy("position").collect()
    assert [sources.index(r.source) for r in got] == plain.schedule(weights, 3)
    taken, total = np.zeros(len(weights)), sum(weights)
    for n, r in enumerate(got, 1):
        taken[sources.index(r.source)] += 1
        assert np.all(np.abs(taken - np.array(weights) * n / total) < 1)


def test_sources_that_run_out(spark):
    """The others go on with their weights; every row has one place."""
    sizes, weights = {"a": 40, "b": 5, "c": 13}, {"a": 2, "b": 2, "c": 1}
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    shares = spark.createDataFrame(list(weights.items()), "source string, weight int")
    got = mixing.mix(docs, shares, block_rows=1, range_rows=3).orderBy("position").collect()
    assert sorted((r.doc_id, r.source) for r in got) == sorted(rows)
    assert len({r.position for r in got}) == len(rows)
    first = [r.source for r in got[:10]]
    assert (first.count("a"), first.count("b"), first.count("c")) == (4, 4, 2)
    late = [r.source for r in got if 15 <= r.slot < 30]
    assert late.count("a") == 2 * late.count("c")


def test_sources_need_weights(spark, docs):
    weights = spark.createDataFrame([("a", 1)], "source string, weight int")
    with pytest.raises(Exception, match="no positive weight"):
        mixing.mix(docs, weights).collect()
    wide = spark.createDataFrame([("a", 20_000), ("b", 1), ("c", 1), ("", 1)], "source string, weight int")
    assert mixing.mix(docs, wide).select("position").distinct().count() == len(DOCS)


def _mixed(spark, sizes, block_rows):
    """The mix of so many rows per source, by proportional weights; its invariants are checked."""
    rows = [(s * 10**6 + i, f"s{s}") for s, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mix(docs, mixing.proportional_weights(docs), block_rows=block_rows, range_rows=500)
    got = got.orderBy("position").collect()
    assert sorted((r.doc_id, r.source) for r in got) == rows
    assert len({r.position for r in got}) == len(rows)
    assert all(r.release <= r.slot < r.deadline for r in got)
    owners = {r.slot: (r.source, r.block) for r in got}
    assert len(owners) == len(set(owners.values())) == len({(r.source, r.block) for r in got})
    return [owners[slot][0] for slot in sorted(owners)]


def test_many_sources_keep_their_shares(spark):
    """A hot source and 300 equal ones, by roots: 20 / (20 + 300 * 2) of the mix while all last."""
    sources = _mixed(spark, [400] + [4] * 300, 1)
    share = round(10_000 * 20 / 620) / 10_000
    # Both kinds run out in virtual time with their root: the small ones after 2 units, the other after 20.
    for n in range(1, 1_200):
        assert abs(sources[:n].count("s0") - share * n) < 1
    assert sources[1_300:] == ["s0"] * 300


def test_more_sources_than_a_schedule_holds(spark):
    sources = _mixed(spark, [900] + [1] * 1_200, 1)
    assert abs(sources[:1_200].count("s0") - 1_200 * 30 / 1_230) < 1
    whole = spark.createDataFrame([(f"s{i}", 1) for i in range(1_500)], "source string, weight int")
    docs = spark.createDataFrame([(i, f"s{i % 1_500}") for i in range(3_000)], "doc_id long, source string")
    got = mixing.mix(docs, whole, block_rows=1).orderBy("position").collect()
    assert len({r.source for r in got[:1_500]}) == 1_500 and len(got) == 3_000


def deviation(rows, shares):
    """The most that a source is ahead of or behind its share of the slots, at the end of any slot
    at which it gets or is due a block."""
    worst, by = 0.0, {}
    for r in rows:
        by.setdefault(r.source, {})[r.block] = r.slot
    for source, slots in by.items():
        for block, slot in slots.items():
            worst = max(worst, block + 1 - shares[source] * (slot + 1), shares[source] * slot - block)
    return worst


def effective_shares(weights, whole):
    """Shares that a schedule gives: of slots by class, by plain Python."""
    kinds, total = sorted(set(weights.values())), sum(weights.values())
    if len(kinds) <= mixing.MOST_CLASSES:
        label = {w: w for w in kinds}
    else:
        step = math.log(kinds[-1] / kinds[0]) / mixing.MOST_CLASSES
        label = {w: min(int(math.log(w / kinds[0]) / step), mixing.MOST_CLASSES - 1) for w in kinds}
    mass, members = Counter(), Counter()
    for w in weights.values():
        mass[label[w]] += w
        members[label[w]] += 1
    slots = {c: m if whole else max(1, math.floor(mixing.MOST_SLOTS * m / total + 0.5)) for c, m in mass.items()}
    period = sum(slots.values())
    return {s: slots[label[w]] / members[label[w]] / period for s, w in weights.items()}


@pytest.mark.parametrize("n, kinds, whole", [(20, 20, False), (300, 300, False), (300, 3, True), (5_000, 5_000, False)])
def test_any_number_of_sources_is_pfair(spark, n, kinds, whole):
    """Real weights too: less than one block from the shares of the schedule, and these are near the
    weights."""
    most = 6
    weights = {f"s{i}": 1 + i % kinds if whole else 1.0 + (i % kinds) * 9.7 / kinds for i in range(n)}
    shares = spark.createDataFrame(list(weights.items()), f"source string, weight {'int' if whole else 'double'}")
    docs = spark.range(n * most).selectExpr("id as doc_id", f"concat('s', id % {n}) as source")
    rows = mixing.mix(docs, shares, block_rows=1, range_rows=700).collect()
    assert len(rows) == n * most and len({r.slot for r in rows}) == n * most
    assert all(r.release <= r.slot < r.deadline for r in rows)
    given = effective_shares(weights, whole)
    assert deviation(rows, given) < 1
    total = sum(weights.values())
    for source, weight in weights.items():
        assert abs(given[source] - weight / total) < 0.02 * weight / total + (0 if whole else 1 / mixing.MOST_SLOTS / max(1, n // 600))


@pytest.mark.parametrize("n, least", [(128, 1), (128, 20), (129, 1), (130, 20)])
def test_whole_weights_are_scheduled_alike_at_any_size(spark, n, least):
    """Slots of a plain schedule of the sources, with more than 128 of them and more than 10,000 slots too."""
    sources, weights, most = [f"s{i:03}" for i in range(n)], [least + i for i in range(n)], 4
    shares = spark.createDataFrame(list(zip(sources, weights)), "source string, weight long")
    docs = spark.range(n * most).selectExpr("id as doc_id", f"concat('s', lpad(cast(id % {n} as string), 3, '0')) as source")
    rows = mixing.mix(docs, shares, block_rows=1).collect()
    taken, expected = Counter(), {}
    for slot, i in enumerate(plain.schedule(weights)):
        expected[sources[i], taken[i]] = slot
        taken[i] += 1
    for r in rows:
        period, block = divmod(r.block, weights[sources.index(r.source)])
        assert r.slot == period * sum(weights) + expected[r.source, block]


@pytest.mark.parametrize("n", [20, 128, 129, 300])
def test_real_weights_keep_their_own_shares(spark, n):
    """Less than one block from the weights themselves, with more than 128 different ones too."""
    weights = {f"s{i}": 1.0 + i * 0.05 for i in range(n)}
    shares = spark.createDataFrame(list(weights.items()), "source string, weight double")
    docs = spark.range(n * 40).selectExpr("id as doc_id", f"concat('s', id % {n}) as source")
    rows = mixing.mix(docs, shares, block_rows=1).collect()
    assert len({r.slot for r in rows}) == n * 40
    total = sum(weights.values())
    rounding = max(r.slot for r in rows) / mixing.MOST_SLOTS
    assert rounding < 0.02
    assert deviation(rows, {s: w / total for s, w in weights.items()}) < 1 + rounding


def test_large_whole_weights_are_exact(spark):
    """Products of weights and slots beyond 64 bits."""
    weights = {"a": 3 * 10**12, "b": 10**12 + 1, "c": 1}
    shares = spark.createDataFrame(list(weights.items()), "source string, weight long")
    docs = spark.range(90).selectExpr("id as doc_id", "element_at(array('a', 'b'), int(id % 2) + 1) as source")
    total = 4 * 10**12 + 1
    for r in mixing.mix(docs, shares, block_rows=1).collect():
        w = weights[r.source]
        assert (r.release, r.deadline) == (r.block * total // w, -(-(r.block + 1) * total // w))
        assert r.release <= r.slot < r.deadline


def test_the_query_against_a_plain_schedule(spark, folder):
    """Slots of the registered query: the same classes, scheduled by plain Python."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("source")
    sizes = Counter(r.source or "" for r in docs.collect())
    weights = {s: n**0.5 for s, n in sizes.items()}
    classes = sorted(set(weights.values()))
    members = {w: sorted(s for s in weights if weights[s] == w) for w in classes}
    total = sum(weights.values())
    slots = [max(1, math.floor(mixing.MOST_SLOTS * w * len(members[w]) / total + 0.5)) for w in classes]
    turns = {w: [] for w in classes}
    for slot, i in enumerate(plain.schedule(slots)):
        turns[classes[i]].append(slot)
    rows = QUERIES["op8_mixing"](spark, folder).collect()
    got = {}
    for r in rows:
        got.setdefault(weights[r.source or ""], set()).add(r.slot)
    for w, own in got.items():
        most = max(-(-sizes[s] // mixing.BLOCK_ROWS) for s in members[w])
        if all(-(-sizes[s] // mixing.BLOCK_ROWS) == most for s in members[w]):
            n = most * len(members[w])
            assert n <= len(turns[w]) and sorted(own) == turns[w][:n]
    assert len(rows) == sum(sizes.values())


def test_blocks_move_without_the_schedule(spark, folder, capsys):
    """Rows are shuffled with a few numbers; the schedule is joined afterwards."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source")
    mixing.mix(docs, mixing.proportional_weights(docs)).explain()
    plan = capsys.readouterr().out
    window = plan[plan.index("Window") :]
    assert "__offsets" not in window[: window.index("__source") + 400].split("BroadcastExchange")[0]


def test_few_sources_of_different_sizes(spark):
    """Shares are not rounded to hundredths: a source of 1 row and one of 10,000 share as 1 to 100."""
    docs = spark.range(10_101).selectExpr("id as doc_id", "case when id = 0 then 'a' when id <= 100 then 'b' else 'c' end as source")
    weights = {r.source: r.weight for r in mixing.proportional_weights(docs).collect()}
    assert weights["b"] / weights["a"] == pytest.approx(10, rel=0.05)
    assert weights["c"] / weights["a"] == pytest.approx(100, rel=0.05)


def test_the_fit_sees_forty_thousand_labels(spark):
    docs = spark.range(70_000).selectExpr("id as key", "'t' as text")
    labels = spark.range(70_000).selectExpr("id as key", "int(id % 2) as label")
    assert toxicity._sample(docs, labels).where("label is not null").count() == 40_000


def test_a_repeated_key_does_not_fill_the_sample(spark, monkeypatch):
    """Copies of a row count once, and a key with many texts gives the rest no less room."""
    monkeypatch.setattr(toxicity, "MOST_LABELLED", 40)
    keys = [k for k in range(100) if zlib.crc32(str(k).encode()) % 3 != 1][:40]
    same, many = keys[:2]
    rows = [(k, f"text {k}") for k in keys] + [(same, f"text {same}")] * 500 + [(many, f"other {i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "key long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in keys], "key long, label int")
    got = Counter(tuple(r) for r in toxicity._sample(docs, labels).collect())
    assert len(got) == sum(got.values()) == 40
    assert {(f"text {k}", k % 2) for k in keys if k != many} <= set(got)
    fewer = labels.where(f"key in ({same}, {many})")
    got = Counter(r.text for r in toxicity._sample(docs, fewer).where("label is not null").collect())
    assert len(got) == sum(got.values()) == 1 + toxicity.MOST_TEXTS


def test_token_files(spark, docs):
    folder = scratch_path(spark, "tokens")
    token_output.write_tokens(docs, folder, frame_bytes=64)
    got = token_output.read_tokens(spark, folder).orderBy("start").collect()
    order = sorted((row[:2] for row in DOCS), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    encoder = token_output.Tokenizer.from_file(token_output.public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    for row, (doc_id, text) in zip(got, order, strict=True):
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [0]
        assert (row.doc_id, row.start, bytes(row.ids)) == (doc_id, start, np.array(ids, "<u4").tobytes())
        start += len(ids)
    some = token_output.read_tokens(spark, folder, keys=[1, 7, 99]).collect()
    whole = {r.doc_id: (r.start, bytes(r.ids)) for r in got}
    assert {r.doc_id: (r.start, bytes(r.ids)) for r in some} == {i: whole[i] for i in (1, 7)}
    empty = scratch_path(spark, "tokens")
    token_output.write_tokens(docs.where("false"), empty)
    assert token_output.read_tokens(spark, empty).collect() == []


def test_damaged_frames_are_found(tmp_path):
    path = tmp_path / "shard"
    with path.open("wb") as out:
        writer = token_output.ShardWriter(out, frame_bytes=40)
        places = [writer.add(i, np.arange(i, i + 6, dtype="<u4").tobytes()) for i in range(5)]
        writer.close()
    assert places == [(i, 0) for i in range(5)]
    with path.open("rb") as source:
        assert [k for k, _ in token_output.ShardReader(source).documents()] == list(range(5))
        only = dict(token_output.ShardReader(source).documents([3]))
        assert np.frombuffer(only[3], "<u4").tolist() == [3, 4, 5, 6, 7, 8]
    # Any zstandard reader sees plain frames; the seek table is skipped.
    raw = path.read_bytes()
    broken = bytearray(raw)
    broken[12] ^= 0xFF
    path.write_bytes(broken)
    with path.open("rb") as source, pytest.raises(Exception):
        list(token_output.ShardReader(source).documents())


def test_token_encoder_equals_the_library(monkeypatch, tmp_path):
    """Words are encoded apart, texts with odd white space otherwise; the ids are those of the text.
    """
    path = token_output.public_tokenizers.path("byte_bpe_50k.json")
    own = token_output.Tokenizer.from_file(path)  # as the library makes it
    texts = [
        "", " ", "a", " a", "a ", "a b", "a  b", "a\nb c", "a \nb", "a\n b", "x.y, z. w.,", "it's we'll  I'm .. , .",
        " a b", "a　 b c", "été naïve 日本 語。", "tab\there and\r\nthere", "<|endoftext|> x", "a.\nB c,\nd",
        "3. 4, v2., é., ß.", "end. ", "q .", "\x1c a \x85 b",
        "x <|endoftext|> y", "a<|endoftext|>b, <|endoftext|>. c<|endoftext|>, d", "x  <|endoftext|>  y", "<|endoftext|>",
        "<|endoftext|>\n<|endoftext|> <|endof text|>", ". a. b., .,", "a b" * 999,
    ]
    encoder = token_output.Encoder(path)
    want = [np.array(own.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.ids(texts) == want
    assert encoder.ids(texts[::-1]) == want[::-1]
    # Words are forgotten when there are too many.
    monkeypatch.setattr(token_output, "CACHED_WORDS", 5)
    assert [encoder.ids([t])[0] for t in texts] == want
    # Special tokens that take the space beside them.
    own.add_special_tokens([token_output.AddedToken("<end.>", rstrip=True, lstrip=True)])
    own.save(str(tmp_path / "own.json"))
    encoder = token_output.Encoder(str(tmp_path / "own.json"))
    texts += ["a <end.> b", "a <end.>", "<end.> <end.> c d"]
    want = [np.array(own.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.ids(texts) == want


def test_random_texts_have_the_ids_of_the_library():
    path = token_output.public_tokenizers.path("byte_bpe_50k.json")
    own, encoder, draw = token_output.Tokenizer.from_file(path), token_output.Encoder(path), random.Random(4)
    letters = ["a", "The", "é", "日", " ", " ", " ", "\n", "\t", "\xa0", "\u3000", ".", ",", "'s", "12", "<|endoftext|>", "\x85"]
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 40))) for _ in range(3000)]
    want = [np.array(own.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.ids(texts) == want


def test_shards_are_read_side_by_side(spark, rows, conf, tmp_path):
    docs = rows([(i, f"text {i}") for i in range(64)], "doc_id long, text string")
    folder = f"{tmp_path}/shards"
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    shards = token_output.write_tokens(docs, folder).count()
    conf(spark__sql__adaptive__coalescePartitions__enabled="true")
    found = token_output.read_tokens(spark, folder).select(F.spark_partition_id().alias("task"))
    assert shards > 1 and found.distinct().count() == shards


def test_frames_that_do_not_fit(monkeypatch):
    class Huge(bytes):
        def __len__(self):
            return 1 << 32

    with pytest.raises(ValueError):
        token_output.ShardWriter(None)._frame(Huge())


def test_chunks_that_never_agree(spark):
    """Runs that are longer than an overlap, and boundaries that white space would move."""
    texts = ["a" * 5000, " " * 5000 + "x", "ab " * 700 + "c" * 3000 + " d" * 700, "\n \n" * 900, "it'll " * 900, "9" * 4000]
    docs = spark.createDataFrame(list(enumerate(texts * 2)), "doc_id long, text string")
    own = bpe.encoding(bpe.default_ranks(), bpe.public_tokenizers.PATTERN)
    for row in bpe.encode(docs, chunk=500, overlap=40).collect():
        assert bytes(row.ids) == np.array(own.encode_ordinary(row.text), "<u4").tobytes()
    with pytest.raises(ValueError):
        bpe.encode(docs, chunk=10, overlap=20)


def test_long_texts_are_cut(spark):
    text = "some plain words to encode, again and again. " * 200
    docs = spark.createDataFrame([("k", text)], "key string, text string")
    pieces = docs.mapInArrow(bpe._chunk_rows(1000, 100), "key string, no int, last boolean, text string")
    cuts = bpe._cuts(
        pieces.mapInArrow(
            bpe._boundaries(1000, 100, bpe.public_tokenizers.PATTERN), "key string, no int, head array<int>, tail array<int>"
        ),
        1000,
    ).first()["cuts"]
    assert len(cuts) == (len(text) - 1) // 1000 and all(at // 1000 == i + 1 for i, at in enumerate(cuts))


def test_token_counts(spark):
    rows = spark.createDataFrame([(3,), (3,), (0,), (5000,), (None,), (7,)], "n_tokens long")
    sums = token_counts.suffix_sums(token_counts.length_histogram(rows), band=4)
    lengths = np.array([3, 3, 0, 5000, 7])
    for r in sums.collect():
        assert r.docs_at_least == (lengths >= r.n_tokens).sum()
        assert r.tokens_at_least == lengths[lengths >= r.n_tokens].sum()
        assert r.truncated_tokens == np.minimum(lengths, r.n_tokens).sum()
    limits = [0, 1, 3, 6, 7, 4999, 5000, 9000]
    for r in token_counts.at_limits(spark, sums, limits).collect():
        assert (r.docs_over, r.truncated_tokens) == ((lengths > r.limit).sum(), np.minimum(lengths, r.limit).sum())
    found = {r.share: r.n_tokens for r in token_counts.quantiles(spark, sums, [0.0, 0.2, 0.5, 0.6, 1.0]).collect()}
    assert found == {0.0: 0, 0.2: 0, 0.5: 3, 0.6: 3, 1.0: 5000}
    none = token_counts.suffix_sums(token_counts.length_histogram(rows.where("false")))
    assert none.collect() == []
    assert [tuple(r)[1:] for r in token_counts.at_limits(spark, none, [5]).collect()] == [(0, 0)]


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_rows_and_none(spark, docs, number, folder):
    """Every stage but the last returns the columns it was given."""
    name, stage = corpus_pipeline.STAGES[number]
    for rows in (docs, docs.where("false")):
        got = stage(spark, rows, folder)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert got.columns == rows.columns
        found = got.collect()
        if name in ("line_dedup", "mixing", "bpe"):
            assert len(found) == rows.count()
