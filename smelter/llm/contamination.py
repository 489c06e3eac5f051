"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

Items and documents are sequences of words. A window is WINDOW consecutive words of an item, or the
whole of a shorter one, and is seen as the set of its shingles. A document holds a window if it
holds all of its shingles in their places, so any one of them is a necessary prefix; with shingles
ordered by rarity in the corpus, that is the rarest one.

1. Shingles of all documents at the places where an item's shingle may stand: a Bloom filter of the
   items' shingles is tested where the text lies, and only what passes is joined with them.
2. The number of these places is each shingle's rarity. The rarest shingle of a window is its prefix
   token; a window with a shingle that never occurs goes.
3. Prefix tokens are joined with their places, which sets where the window would begin and end. The
   bounds of the document's length and, for the last shingle of the window, of its place must hold.
4. What is left is compared word by word with the text: exact containment over the item's window.

Texts that are equal are searched as one from step 2 on. Only texts with a candidate are read again,
and no text is shuffled but theirs.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.bloom import flagged
from smelter.llm.tables import apart, named, with_results
from smelter.operators import stage

#: Words of a window, and of a shingle; a window with fewer words is one shingle.
WINDOW, SHINGLE = 10, 5

# The characters between words, once A-Z is lower-cased.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The lower-cased words of a text: runs of 0-9, a-z and of characters beyond ASCII."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lower, _BETWEEN, -1), lambda w: w != "")


def _shingles(hashes: Column, width: int) -> Column:
    """Hashes of the runs of ``width`` words, from the words' hashes."""
    last = F.size(hashes) - width
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.transform(
        places, lambda i: F.xxhash64(F.lit(width), *[F.get(hashes, i + k) for k in range(width)])
    )


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _windows(items: DataFrame, window: int) -> DataFrame:
    """(item, window, size): the windows of each item; a window is its words, joined by spaces."""
    words = F.col("words")
    last = F.greatest(F.size(words) - window, F.lit(0))
    listed = items.select(F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("words"))
    return (
        listed.where(F.size("words") > 0)
        .select("item", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(words, i + 1, window))).alias("words"))
        .select("item", F.array_join("words", " ").alias("window"), F.size("words").alias("size"))
        .distinct()
    )


def _tokens(windows: DataFrame, shingle: int) -> DataFrame:
    """(window, size, last, token, at): the shingles of each distinct window; ``last`` is its last
    one."""
    distinct = windows.select("window", "size").distinct()
    hashes = _hashes(F.split("window", " "))
    widths = F.least(F.col("size"), F.lit(shingle))
    found = F.lit(None).cast("array<bigint>")
    for width in range(1, shingle + 1):
        found = F.when(widths == width, _shingles(F.col("hashes"), width)).otherwise(found)
    listed = distinct.select("window", "size", hashes.alias("hashes")).select("window", "size", found.alias("tokens"))
    return listed.select("window", "size", F.element_at("tokens", -1).alias("last"), F.posexplode("tokens").alias("at", "token"))


def _places(texts: DataFrame, tokens: DataFrame, widths: list[int]) -> DataFrame:
    """(x, y, n_words, at, token): where the tokens stand in each distinct text."""
    hashes = stage(tokens.select(F.col("token").alias("cell")).distinct(), "tokens")
    hashed = texts.select("x", "y", "n_words", _hashes(F.col("words")).alias("hashes"))
    found = None
    for width in widths:  # one, unless items are shorter than a shingle
        every = hashed.select("x", "y", "n_words", F.posexplode(_shingles(F.col("hashes"), width)).alias("at", "token"))
        possible = flagged(every, "token", hashes, "__possible").where("__possible").drop("__possible")
        found = possible if found is None else found.unionByName(possible)
    return found.join(hashes, F.col("token") == F.col("cell"), "left_semi").distinct()


def _candidates(places: DataFrame, tokens: DataFrame, shingle: int) -> DataFrame:
    """(x, y, start, size, window): windows whose prefix token and last shingle stand where they
    would in the text."""
    rarity = places.groupBy(F.col("token").alias("counted")).agg(F.count("*").alias("n"))
    ranked = tokens.join(rarity, F.col("token") == F.col("counted"), "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "token", "size", "last")).alias("rarest")
    )
    prefix = stage(
        ranked.where("rarest.n > 0").select(
            "window", F.col("rarest.token").alias("prefix"), F.col("rarest.at").alias("offset"),
            "rarest.size", "rarest.last",
        ),
        "prefix-tokens",
    )
    start = F.col("at") - F.col("offset")
    found = (
        places.join(prefix, F.col("token") == F.col("prefix"))
        .select("x", "y", "n_words", start.alias("start"), "size", "last", "window")
        .where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words")))
    )
    width = F.least(F.col("size"), F.lit(shingle))
    ends = places.select(F.col("x").alias("u"), F.col("y").alias("v"), F.col("at").alias("end"), F.col("token").alias("shown"))
    return found.join(
        ends,
        (F.col("x") == F.col("u")) & (F.col("y") == F.col("v"))
        & (F.col("start") + F.col("size") - width == F.col("end")) & (F.col("last") == F.col("shown")),
        "left_semi",
    ).select("x", "y", "start", "size", "window")


def _covered(hits: Column) -> Column:
    """How many words the hits cover, from an array of (start, size) in order."""
    empty = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))

    def step(done: Column, hit: Column) -> Column:
        end = hit["start"] + hit["size"]
        new = F.greatest(end - F.greatest(hit["start"], done["upto"]), F.lit(0))
        return F.struct(F.greatest(end, done["upto"]).alias("upto"), (done["n"] + new).alias("n"))

    return F.aggregate(hits, empty, step, lambda done: done["n"])


def _verified(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """(x, y, n_hit, windows): texts that hold a window, with the number of words that their windows
    cover and the distinct windows."""
    listed = stage(
        candidates.groupBy(F.col("x").alias("u"), F.col("y").alias("v")).agg(
            F.array_sort(F.collect_list(F.struct("start", "size", "window"))).alias("found")
        ),
        "candidates",
    )
    wanted = stage(listed.select(F.xxhash64("u", "v").alias("cell")).distinct(), "candidate-texts")
    near = flagged(texts.withColumn("__cell", F.xxhash64("x", "y")), "__cell", wanted, "__possible")
    once = near.where("__possible").groupBy("x", "y").agg(F.first("text").alias("text"))
    words = F.col("words")
    compared = (
        once.select("x", "y", words_of(F.col("text")).alias("words"))
        .join(listed, (F.col("x") == F.col("u")) & (F.col("y") == F.col("v")))
        .select(
            "x", "y",
            F.filter("found", lambda c: F.array_join(F.slice(words, c["start"] + 1, c["size"]), " ") == c["window"]).alias("hits"),
        )
        .where(F.size("hits") > 0)
    )
    return compared.select("x", "y", _covered(F.col("hits")).alias("n_hit"), F.array_sort(F.array_distinct("hits.window")).alias("windows"))


def _with_items(verified: DataFrame, windows: DataFrame) -> DataFrame:
    """(__u, __v, __hit, __items): items are looked up once for each set of windows."""
    hashed = verified.withColumn("a", F.xxhash64("windows")).withColumn("b", F.xxhash64(F.lit("b"), "windows"))
    hashed = stage(hashed, "verified")
    sets = hashed.groupBy("a", "b").agg(F.first("windows").alias("windows"))
    held = sets.select("a", "b", F.explode("windows").alias("held"))
    of_sets = (
        held.join(windows, F.col("held") == F.col("window"))
        .groupBy(F.col("a").alias("c"), F.col("b").alias("d"))
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    of_sets = stage(of_sets, "items-of-sets")
    return hashed.join(of_sets, (F.col("a") == F.col("c")) & (F.col("b") == F.col("d"))).select(
        F.col("x").alias("__u"), F.col("y").alias("__v"), F.col("n_hit").alias("__hit"), F.col("items").alias("__items")
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside a window of an item, wherever it occurs),
    ``n_items`` (items with such a window), ``items`` (their ids as strings, sorted) and
    ``contaminated`` (n_hit > 0).

    Defined cases: a null or empty text, or one without words, has no words and no hits; an item
    without words has no window; an item with fewer words than a window is one, down to a single
    word; items of equal text each count, and rows of equal id are one item; an item without an id
    has the id ''; rows are kept as they are, repeated ones too; an empty table of items gives no
    hits, an empty table of documents an empty result; input columns named like a result are
    replaced. ``docs`` is read three times: stage it if it is dear to compute.
    """
    # A text is told by 128 bits of hash.
    own = F.coalesce(named(text), F.lit(""))
    x, y = F.xxhash64(own), F.xxhash64(F.lit("y"), own)
    words = words_of(named(text))
    shingle = min(shingle, window)
    windows = stage(_windows(apart(items, item=item, text=item_text), window), "windows")
    tokens = stage(_tokens(windows, shingle), "window-tokens")
    widths = sorted(r[0] for r in windows.select(F.least("size", F.lit(shingle))).distinct().collect())
    if widths:
        texts = docs.select(x.alias("x"), y.alias("y"), F.size(words).alias("n_words"), words.alias("words"), own.alias("text"))
        places = stage(_places(texts.drop("text"), tokens, widths), "places")
        candidates = _candidates(places, tokens, shingle)
        hits = _with_items(_verified(texts.select("x", "y", "text"), candidates), windows)
    else:
        hits = docs.sparkSession.createDataFrame([], "__u long, __v long, __hit int, __items array<string>")
    hits = stage(hits, "hits")
    # Rows that surely have no hit go straight through; only the others shuffle.
    cells = stage(hits.select(F.xxhash64("__u", "__v").alias("cell")).distinct(), "hit-texts")
    told = docs.withColumn("__x", x).withColumn("__y", y).withColumn("__cell", F.xxhash64(x, y))
    tested = flagged(told, "__cell", cells, "__possible").drop("__cell")
    nothing = F.expr("cast(array() as array<string>)")
    n_words = F.size(words).cast("long").alias("__n")
    clean = tested.where(~F.col("__possible")).select(
        "*", n_words, F.lit(0).alias("__hit"), nothing.alias("__items")
    )
    suspects = tested.where(F.col("__possible")).select("*", n_words)
    joined = suspects.join(hits, (F.col("__x") == F.col("__u")) & (F.col("__y") == F.col("__v")), "left")
    found = clean.unionByName(joined.drop("__u", "__v"))
    hit = F.coalesce(F.col("__hit"), F.lit(0)).cast("long")
    return with_results(
        found,
        {
            "n_words": F.col("__n"),
            "n_hit": hit,
            "n_items": F.size(F.coalesce("__items", nothing)).cast("long"),
            "items": F.coalesce("__items", nothing),
            "contaminated": hit > 0,
        },
    ).drop("__n", "__x", "__y", "__possible", "__hit", "__items")
