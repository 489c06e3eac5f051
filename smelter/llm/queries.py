"""One query for each operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm import (
    bpe,
    chat_format,
    contamination,
    exact_dedup,
    line_dedup,
    minhash,
    mixing,
    quality,
    runs,
    token_counts,
    token_output,
    toxicity,
    whitening,
)
from smelter.llm.tables import table
from smelter.operators import scratch_path, stage

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, table(spark, folder, "labels")).drop("text")


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = chat_format.swapped_answers(table(spark, folder, "conversations"))
    return chat_format.format_preferences(turns).select(
        "pair_id",
        "n_prompt_turns",
        "prompt",
        "chosen",
        "rejected",
        F.col("chosen_spans").cast("string").alias("chosen_spans"),
        F.col("rejected_spans").cast("string").alias("rejected_spans"),
    )


OP2_SQL = r"""
with answers as (
    select conv_id, max(turn) as last_turn, arg_max(text, struct_pack(a := turn, b := text)) as answer
    from conversations where role = 'assistant' group by conv_id
), sides as (
    select conv_id as pair_id, true as side, turn, role, text from conversations
    union all
    select c.conv_id, false, c.turn, c.role, c.text
    from conversations c left join answers a using (conv_id)
    where a.last_turn is null or c.turn < a.last_turn
    union all
    select a.conv_id, false, a.last_turn, 'assistant', b.answer
    from answers a join answers b on a.conv_id = xor(b.conv_id, 1)
), numbered as (
    select *, row_number() over (partition by pair_id, side order by turn, role, text) as pos
    from sides
), sizes as (
    select pair_id, max(pos) filter (where side) as good, max(pos) filter (where not side) as bad
    from numbered group by pair_id
), differing as (
    select c.pair_id, min(c.pos) as pos
    from numbered c left join numbered r
      on r.pair_id = c.pair_id and not r.side and r.pos = c.pos
     and r.role is not distinct from c.role and r.text is not distinct from c.text
    where c.side and r.pos is null group by c.pair_id
), prefix as (
    select pair_id, good, bad,
           case when good is null or bad is null then 0 else coalesce(d.pos - 1, good) end as common
    from sizes left join differing d using (pair_id)
), rendered as (
    select n.pair_id, n.side, n.pos, p.common,
           '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>'
               || chr(10) as piece,
           '{' || (12 + length(coalesce(role, '')) + 1) || ', false}, {'
               || (length(coalesce(text, '')) + 11) || ', '
               || (coalesce(role, '') = 'assistant') || '}' as span
    from numbered n join prefix p using (pair_id)
), texts as (
    select pair_id,
           coalesce(string_agg(piece, '' order by pos) filter (where side and pos <= common), '') as prompt,
           coalesce(string_agg(piece, '' order by pos) filter (where side and pos > common), '') as chosen,
           coalesce(string_agg(piece, '' order by pos) filter (where not side and pos > common), '') as rejected,
           '[' || coalesce(string_agg(span, ', ' order by pos) filter (where side and pos > common), '') || ']'
               as chosen_spans,
           '[' || coalesce(string_agg(span, ', ' order by pos) filter (where not side and pos > common), '') || ']'
               as rejected_spans
    from rendered group by pair_id
)
select pair_id, cast(common as bigint) as n_prompt_turns, prompt,
       case when good is not null then chosen end as chosen,
       case when bad is not null then rejected end as rejected,
       case when good is not null then chosen_spans end as chosen_spans,
       case when bad is not null then rejected_spans end as rejected_spans
from prefix join texts using (pair_id)"""


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select(
        "page_id",
        line_dedup.host_of(F.col("url")).alias("host"),
        line_dedup.html_lines(F.col("html")).alias("text"),
    )
    # The values that OP3_SQL states; a host's pages of equal text count once.
    return line_dedup.line_dedup(stage(pages, "pages"), "host", most_share=0.02, least_hits=3, copies_once=True)


OP3_SQL = r"""
with pages_text as (
    select page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)) as host,
           trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
               '<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<head>.*?</head>', chr(10), 'gis'),
               '</?(p|div|br|li|ul|ol|h[1-6]|nav|article|section|header|footer|aside|main|table|tr|td|th|body|html|blockquote|pre|form)([ \t\n\r\f][^>]*)?/?>',
               chr(10), 'gi'),
               '<[^>]*>', '', 'g'),
               '[\n\r][ \t\n\r]*', chr(10), 'g'), chr(10) || chr(13) || chr(9) || ' ') as text
    from pages
), lines as (
    select page_id, host, text, unnest(string_split(text, chr(10))) as line,
           unnest(range(len(string_split(text, chr(10))))) as pos
    from pages_text
), solid as (
    select *, trim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) <> '' as solid from lines
), sites as (
    select host, count(distinct text) as of_pages from pages_text group by host
), bad as (
    select host, line
    from (select host, line, count(distinct text) as hits from solid where solid group by host, line)
    join sites using (host)
    where hits >= 3 and hits > cast(0.02 as double) * of_pages
), marked as (
    select s.*, b.line is not null as gone
    from solid s left join bad b on s.host = b.host and s.line = b.line and s.solid
)
select page_id, host,
       coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '') as text,
       count(*) filter (where solid) as n_lines, count(*) filter (where gone) as n_dropped_lines
from marked group by page_id, host"""


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The target are the documents labelled good, without every third of them: those stay for
    tests.
    """
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels")
    target = labels.where((F.col("quality") == 1) & ~toxicity.held_out(F.col("doc_id")))
    return quality.quality(docs, target).drop("text")


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.decode(bpe.encode(docs)).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, folder, "documents"))


OP6_SQL = """
with hashed as (
    select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz')) as text_sha256
    from documents
), groups as (
    select text_sha256, max(doc_id) as keep_id, count(*) as group_size from hashed group by 1
)
select doc_id, text_sha256, keep_id, group_size, doc_id is not distinct from keep_id as kept
from hashed join groups using (text_sha256)"""


def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return minhash.near_dedup(docs, width=3, similarity=0.85).drop("text")


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return mixing.mix(docs, mixing.proportional_weights(docs))


def op9_token_output(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_path(spark, "tokens")
    token_output.write_tokens(table(spark, folder, "documents"), target)
    return token_output.read_tokens(spark, target).select(
        "doc_id",
        "start",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lengths = docs.select(bpe.token_count(F.col("text")).alias("n_tokens"))
    return token_counts.suffix_sums(stage(token_counts.length_histogram(lengths), "lengths"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document, by crc32 of its id, is made periodic from some word on.
    """
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    marked = docs.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    sized = marked.withColumn("a", F.when(n > 0, (g % n).cast("int")))
    sized = sized.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    own, a, p = F.col("words"), F.col("a"), F.col("p")
    tail = F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.get(own, a + i % p))
    planted = F.array_join(F.concat(F.slice(own, F.lit(1), a), tail), " ")
    return sized.select("doc_id", F.when(a.isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = planted_periods(table(spark, folder, "documents"))
    found = runs.periodic_runs(docs)

    def denser(best, run):
        return F.when(
            best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best)

    kind = "struct<start: bigint, length: bigint, period: bigint>"
    best = F.aggregate("runs", F.lit(None).cast(kind), denser)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_contamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return contamination.contamination(docs, table(spark, folder, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP13_SQL = r"""
with texts as (
    select row_number() over () as id, doc_id,
           list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as words
    from documents
), items as (
    select coalesce(cast(item_id as varchar), '') as item,
           list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as words
    from benchmark
), starts as (
    select item, words, least(len(words), 10) as size, unnest(range(greatest(len(words) - 9, 1))) as pos
    from items where len(words) > 0
), windows as (
    select distinct item, size, array_to_string(words[pos + 1 : pos + size], ' ') as span from starts
), places as (
    select id, size, words, unnest(range(greatest(len(words) - size + 1, 0))) as pos
    from texts, (select distinct size from windows)
), hits as (
    select id, pos, size, item
    from (select id, pos, size, array_to_string(words[pos + 1 : pos + size], ' ') as span from places)
    join windows using (size, span)
), covered as (
    select id, count(distinct word) as n_hit
    from (select id, unnest(range(pos, pos + size)) as word from (select distinct id, pos, size from hits))
    group by id
), held as (
    select id, count(*) as n_items, string_agg(item, ',' order by item) as listed
    from (select distinct id, item from hits) group by id
)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, sha256(coalesce(listed, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from texts left join covered using (id) left join held using (id)"""


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_chat_format,
        op3_line_dedup,
        op4_quality,
        op5_bpe,
        op6_exact_dedup,
        op7_minhash,
        op8_mixing,
        op9_token_output,
        op10_token_counts,
        op11_whitening,
        op12_runs,
        op13_contamination,
    )
}
ORACLES: dict[str, str] = {
    "op2_chat_format": OP2_SQL,
    "op3_line_dedup": OP3_SQL,
    "op6_exact_dedup": OP6_SQL,
    "op13_contamination": OP13_SQL,
}
