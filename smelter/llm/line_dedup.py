"""Boilerplate lines by their frequency within a site, in DataFrame functions only.

For each host, the pages that contain a line are divided by the pages of the host; lines above a
ratio are dropped from every page of that host. A page counts a line once however often it repeats
it, and, unless told otherwise, pages of a host with equal text count as one page: the lines of a
page that was copied often are no boilerplate. Counts are summed on the map side, so a line that a third of all pages share is
a handful of rows after that. Lines travel as 96 bits of hash, never as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.tables import named, with_results
from smelter.operators import scratch_path, scratch_until_done, stage

#: A line on more than this share of a host's pages is boilerplate.
MOST_SHARE = 0.02
#: Hosts with fewer pages keep all their lines. 1: hosts of every size are judged by their lines.
LEAST_PAGES = 1
#: A line on fewer pages than this is no boilerplate, whatever the share.
LEAST_HITS = 3

# What ends a line in HTML, and what holds no text.
_NO_TEXT = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<head>.*?</head>"
_BLOCK_TAGS = (
    r"(?i)</?(p|div|br|li|ul|ol|h[1-6]|nav|article|section|header|footer|aside|main|table|tr|td"
    r"|th|body|html|blockquote|pre|form)([ \t\n\r\f][^>]*)?/?>"
)
_OTHER_TAGS = r"<[^>]*>"
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)"


def html_lines(html: Column) -> Column:
    """The text of a page, one line for each block; blank lines are left out."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), _NO_TEXT, "\n")
    text = F.regexp_replace(F.regexp_replace(text, _BLOCK_TAGS, "\n"), _OTHER_TAGS, "")
    text = F.regexp_replace(text, r"[\n\r][ \t\n\r]*", "\n")
    return F.btrim(text, F.lit("\n\r\t "))


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def _hashes(lines: Column) -> Column:
    """Each line's hash; two independent ones keep chance collisions out of the counts."""
    return F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("a"), F.hash(x).alias("b")))


def _boilerplate(
    pages: DataFrame,
    site: Column,
    text: Column,
    solid: Column,
    most_share: float,
    least_pages: int,
    least_hits: int,
    copies_once: bool,
) -> DataFrame:
    """(__site, __boilerplate): the hashes of each host's boilerplate lines.

    A host has at most (mean lines of a page / most_share) such lines, so its set fits a cell.
    """
    whole = F.coalesce(text, F.lit(""))
    counted = pages.select(
        site.alias("__host"),
        F.xxhash64(whole).alias("x"),
        F.hash(whole).alias("y"),
        F.array_distinct(_hashes(solid)).alias("lines"),
    )
    if copies_once:
        counted = counted.groupBy("__host", "x", "y").agg(F.first("lines").alias("lines"))
    once = stage(counted, "pages-once")
    hits = (
        once.select("__host", F.explode("lines").alias("line"))
        .groupBy("__host", "line.a", "line.b")
        .agg(F.count("*").alias("hits"))
        .where(F.col("hits") >= least_hits)
    )
    sites = (
        once.groupBy(F.col("__host").alias("__site"))
        .agg(F.count("*").alias("of"))
        .where(F.col("of") >= least_pages)
    )
    return (
        hits.join(sites, F.col("__host").eqNullSafe(F.col("__site")))
        .where(F.col("hits") > F.lit(most_share) * F.col("of"))
        .groupBy("__site")
        .agg(F.collect_list(F.struct("a", "b")).alias("__boilerplate"))
    )


def line_dedup(
    pages: DataFrame,
    host: str,
    text: str = "text",
    most_share: float = MOST_SHARE,
    least_pages: int = LEAST_PAGES,
    least_hits: int = LEAST_HITS,
    copies_once: bool = True,
    most_lost: float = 1.0,
) -> DataFrame:
    """``pages`` without the boilerplate lines of their host.

    Replaces ``text`` and adds ``n_lines`` (before), ``n_dropped_lines``. Lines end at ``\\n`` and
    are compared as they are; blank ones (nothing but white space) are never counted nor dropped.
    ``copies_once``: pages of a host with equal text count as one. A page that would lose more than
    ``most_lost`` of its solid lines stays as it is: it is a near copy of many others rather than a
    page with boilerplate.

    Defined cases: a null host is a host of its own; a null text stays null with no lines; a page of
    boilerplate alone keeps its row with an empty text; an empty table gives an empty result.
    ``pages`` is read twice: stage it if it is dear to compute.
    """
    site, own = named(host), named(text)
    lines = F.split(F.coalesce(own, F.lit("")), "\n", -1)
    solid = F.filter(lines, lambda x: F.btrim(x, F.lit(" \t\r\f\v")) != "")

    spark, path = pages.sparkSession, scratch_path(pages.sparkSession, "boilerplate")
    with scratch_until_done(spark):
        found = _boilerplate(pages, site, own, solid, most_share, least_pages, least_hits, copies_once)
        found.write.parquet(path)
    # Written, so that Spark knows the size of the sets when it plans the join: small ones are
    # broadcast and no page moves, else partitions of large hosts are split.
    joined = pages.join(spark.read.parquet(path), site.eqNullSafe(F.col("__site")), "left")
    bad = F.col("__boilerplate")
    stays = F.filter(
        lines,
        lambda x: (F.btrim(x, F.lit(" \t\r\f\v")) == "")
        | ~F.array_contains(bad, F.struct(F.xxhash64(x).alias("a"), F.hash(x).alias("b"))),
    )
    cut = joined.select(
        *[named(c) for c in pages.columns],
        F.when(own.isNotNull(), F.size(solid)).otherwise(0).alias("__solid"),
        lines.alias("__lines"),
        F.when(bad.isNull(), lines).otherwise(stays).alias("__stays"),
    )
    lost = F.size("__lines") - F.size("__stays")
    spared = lost > F.lit(most_lost) * F.col("__solid")
    result = cut.select(
        *[named(c) for c in pages.columns],
        F.when(own.isNotNull(), F.when(spared, F.col("__lines")).otherwise(F.col("__stays"))).alias("__kept"),
        F.col("__solid").cast("long").alias("__solid"),
        F.when(spared, 0).otherwise(lost).cast("long").alias("__gone"),
    )
    return with_results(
        result,
        {
            text: F.array_join("__kept", "\n"),
            "n_lines": F.col("__solid"),
            "n_dropped_lines": F.col("__gone"),
        },
    ).drop("__kept", "__solid", "__gone")
