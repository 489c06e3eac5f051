"""Near duplicates by b-bit MinHash.

1. Each text becomes its set of word shingles; texts with equal sets are one node. A node's 128
   minima are reduced to their low 4 bits and packed as bit planes; 32 bands of 4 whole minima give
   its band keys.
2. Nodes that share a band key are candidates. Agreeing minima are counted by bits of the planes;
   corrected for chance collisions (two different minima agree in 1 of 16 cases) that estimates the
   similarity. Candidates five standard deviations below the threshold are dropped, the others
   confirmed on their full sets.
3. Candidates are confirmed so that a family of near copies costs no row for each of its pairs.
   First, each node meets the nodes that are first in its buckets and is confirmed against its best
   estimate. The estimates of these meetings also join nodes to families. In a family that is still
   several components, blocks of nodes are compared within tasks: a product of 0/1 matrices gives
   all common shingles of two blocks, and only links that join components come out. Nodes of the
   family's main component are not compared with each other. Last, candidates in different families
   are confirmed one by one, each of them. After that, no two nodes that share a bucket and pass the
   estimate have an untested link between their components.
4. Components over the confirmed links give each document its class.

With 32 bands of 4, a pair at the similarity 0.85 shares no band in 1 of 10^10 cases, at 0.8 in 1 of
10^7.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.arrow import from_texts, release
from smelter.llm.bloom import flagged
from smelter.llm.components import components
from smelter.llm.tables import apart, named, with_results
from smelter.llm.words import buffers, distinct_hashes, find_words, is_long, mix, run_hashes, shingles, slices
from smelter.operators import scratch_path, scratch_until_done, stage

# Shape of a signature.
MINIMA, BITS, BANDS, BAND_ROWS = 128, 4, 32, 4
#: Standard deviations by which an estimate may fall short of the threshold.
SLACK = 5.0

_SEEDS = mix(np.arange(1, 4 * MINIMA + 1, dtype=np.uint64))
_FACTORS = (_SEEDS[:MINIMA] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_TERMS = (_SEEDS[MINIMA : 2 * MINIMA] >> np.uint64(32)).astype(np.uint32)
_BAND_FACTORS = _SEEDS[2 * MINIMA : 3 * MINIMA].reshape(BANDS, BAND_ROWS) | np.uint64(1)
_NODE_SEEDS = _SEEDS[-2:]
_BLOCK = 1024

#: Nodes and shingles of a block that is compared with others in one task, and matrix columns at a
#: time.
BLOCK_NODES, BLOCK_SHINGLES, COLUMNS = 512, 1 << 20, 4096


def _sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text; those of a long text come together from its parts.
    """
    if is_long(column):
        yield distinct_hashes(run_hashes(buffers(column)[0], width))
        return
    hashes, bounds = shingles(find_words(column), width)
    for at, to in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield np.unique(hashes[at:to])


def _node(own: np.ndarray) -> bytes | None:
    """128 bits that stand for a set, null for the empty one."""
    if not len(own):
        return None
    total = np.zeros(len(_NODE_SEEDS), dtype="<u8")
    for at in range(0, len(own), 1 << 16):
        part = own[at : at + (1 << 16)]
        total += np.array([np.add.reduce(mix(part ^ seed), dtype=np.uint64) for seed in _NODE_SEEDS])
    return total.tobytes()


def _minima(own: np.ndarray) -> np.ndarray:
    low = own.astype(np.uint32)
    best = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), _BLOCK):
        values = np.multiply.outer(low[at : at + _BLOCK], _FACTORS)
        values += _TERMS
        np.minimum(best, values.min(axis=0), out=best)
    return best


def _planes(minima: np.ndarray) -> np.ndarray:
    """The low bits of mixed minima: for each text BITS x MINIMA bits in 64-bit integers, bit by
    bit.
    """
    mixed = mix(minima.astype(np.uint64))
    planes = [np.packbits(((mixed >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1) for b in range(BITS)]
    return np.ascontiguousarray(np.concatenate(planes, axis=1)).view("<i8")


def _band_keys(minima: np.ndarray) -> np.ndarray:
    rows = minima.astype(np.uint64).reshape(len(minima), BANDS, BAND_ROWS)
    total = np.zeros((len(minima), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for i in range(BAND_ROWS):
        total = mix(total ^ (rows[:, :, i] + np.uint64(1)) * _BAND_FACTORS[:, i])
    return total.view(np.int64)


def _lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, (n + 1) * width, width or 1, dtype=np.int32)[: n + 1]), pa.array(matrix.reshape(-1))
    )


def _signature_columns(width: int):
    """Rows of (key, text) to (key, n_shingles, node, planes, bands)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column("text")):
                sizes, nodes, minima = [], [], []
                for own in _sets(part, width):
                    sizes.append(len(own))
                    nodes.append(_node(own))
                    minima.append(_minima(own))
                matrix = np.array(minima, np.uint32).reshape(len(sizes), MINIMA)
                columns = [
                    batch.column("key").slice(at, len(part)),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    _lists(_planes(matrix)),
                    _lists(_band_keys(matrix)),
                ]
                at += len(part)
                yield pa.RecordBatch.from_arrays(columns, ["key", "n_shingles", "node", "planes", "bands"])
        release()

    return run


def _node_of(width: int):
    """(n_shingles, node) of a text."""

    def compute(part: pa.Array) -> pa.Array:
        sizes, nodes = [], []
        for own in _sets(part, width):
            sizes.append(len(own))
            nodes.append(_node(own))
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary())], ["n_shingles", "node"]
        )

    return from_texts(compute, "struct<n_shingles: bigint, node: binary>")


def _set_rows(width: int):
    """Rows of (text) to (node, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                sets = [own for own in _sets(part, width) if len(own)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_node(own) for own in sets], pa.binary()),
                        pa.array([own.view(np.int64) for own in sets], pa.list_(pa.int64())),
                    ],
                    ["node", "shingles"],
                )
        release()

    return run


def agreeing(a: Column, b: Column) -> Column:
    """Minima whose low bits agree, of two packed signatures."""
    halves = MINIMA // 64
    differing = None
    for half in range(halves):
        bits = None
        for plane in range(BITS):
            at = plane * halves + half
            one = F.get(a, F.lit(at)).bitwiseXOR(F.get(b, F.lit(at)))
            bits = one if bits is None else bits.bitwiseOR(one)
        count = F.bit_count(bits)
        differing = count if differing is None else differing + count
    return F.lit(MINIMA) - differing


def estimated_similarity(agree: Column) -> Column:
    """Similarity from the share of agreeing minima, less those that agree by chance."""
    chance = 2.0**-BITS
    return (agree / F.lit(MINIMA) - F.lit(chance)) / F.lit(1 - chance)


def least_agreeing(similarity: float) -> int:
    """Agreeing minima that a pair at ``similarity`` has, SLACK standard deviations below the mean.
    """
    share = similarity + (1 - similarity) * 2.0**-BITS
    return max(0, math.floor(MINIMA * share - SLACK * math.sqrt(MINIMA * share * (1 - share))))


class _Graph:
    """Nodes, their buckets, and the confirmed links between them."""

    def __init__(self, docs: DataFrame, width: int, similarity: float):
        """``docs`` has the columns key and text."""
        self.docs, self.width, self.similarity = docs, width, similarity
        self.per_cent = round(100 * similarity)
        rows = docs.mapInArrow(
            _signature_columns(width),
            f"key {docs.schema['key'].dataType.simpleString()}, n_shingles long, node binary, "
            "planes array<long>, bands array<long>",
        )
        self.nodes = stage(
            rows.where(F.col("node").isNotNull())
            .groupBy("node")
            .agg(
                F.min("key").alias("key"),
                F.count("*").alias("n"),
                F.first("planes").alias("planes"),
                F.first("bands").alias("bands"),
            ),
            "nodes",
        )
        keys = self.nodes.select("node", F.explode("bands").alias("bucket"))
        order = F.struct(F.xxhash64("bucket", "node").alias("h"), "node")
        buckets = stage(
            keys.groupBy("bucket")
            .agg(F.count("*").alias("n"), F.min(order)["node"].alias("first"))
            .where("n > 1")
            .select("bucket", "first"),
            "buckets",
        )
        self.members = stage(keys.join(buckets, "bucket"), "members")

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that may be similar, with ``agree``."""
        planes = self.nodes.select("node", "planes")
        both = pairs.join(planes.select(F.col("node").alias("a"), F.col("planes").alias("pa")), "a").join(
            planes.select(F.col("node").alias("b"), F.col("planes").alias("pb")), "b"
        )
        agree = agreeing(F.col("pa"), F.col("pb"))
        columns = [c for c in pairs.columns if c not in ("a", "b")]
        return both.select("a", "b", *columns, agree.alias("agree")).where(
            F.col("agree") >= least_agreeing(self.similarity)
        )

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(node, shingles) of the staged nodes in ``wanted``.

        Texts are found by the least key of their node; the filter spares the others the shuffle.
        """
        keys = stage(
            self.nodes.join(wanted, "node").select(F.xxhash64(F.col("key").cast("string")).alias("cell")).distinct(),
            "wanted-keys",
        )
        hashed = self.docs.withColumn("cell", F.xxhash64(F.col("key").cast("string")))
        texts = flagged(hashed, "cell", keys, "possible").where("possible")
        texts = texts.join(keys, "cell", "left_semi").select("text")
        return stage(
            texts.mapInArrow(_set_rows(self.width), "node binary, shingles array<long>")
            .join(wanted, "node", "left_semi")
            .groupBy("node")
            .agg(F.first("shingles").alias("shingles")),
            "sets",
        )

    def confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Links (u, v): the pairs (a, b) whose full sets are similar."""
        both = pairs.join(
            sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a"
        ).join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
        common = F.size(F.array_intersect("sa", "sb"))
        union = F.size("sa") + F.size("sb") - common
        return stage(
            both.where(F.lit(100) * common >= F.lit(self.per_cent) * union).select(
                F.col("a").alias("u"), F.col("b").alias("v")
            ),
            "confirmed",
        )

    def met(self) -> DataFrame:
        """(a, b, agree): each node and the first nodes of its buckets, where the estimate suffices.
        """
        pairs = self.members.where("node != first").select(F.col("node").alias("a"), F.col("first").alias("b"))
        return stage(self.estimated(pairs.distinct()), "met")

    def within_families(self, families: DataFrame, sets: DataFrame) -> DataFrame:
        """Links (u, v) that join components of a family, from all pairs that can.

        ``families``: (node, family, own), ``own`` being the component so far. Blocks hold about
        BLOCK_NODES nodes and BLOCK_SHINGLES shingles at most. Rows go to as many tasks as their
        block meets others.
        """
        sized = stage(
            families.join(sets, "node").select("node", "family", "own", "shingles", F.size("shingles").alias("n")), "family-sets"
        )
        parts = sized.groupBy("family", "own").agg(F.count("*").alias("nodes"), F.sum("n").alias("n"))
        per_family = parts.groupBy("family").agg(
            F.max(F.struct("nodes", "own"))["own"].alias("main"),
            F.max("nodes").alias("main_nodes"),
            F.sum("nodes").alias("nodes"),
            F.sum("n").alias("n"),
            F.count("*").alias("components"),
        )

        def blocks(nodes: Column) -> Column:
            share = F.col("n") * nodes / F.col("nodes")
            return F.greatest(F.lit(1), F.ceil(nodes / BLOCK_NODES), F.ceil(share / BLOCK_SHINGLES)).cast("int")

        # Two nodes have met, as the family's only pair.
        open_ = stage(
            per_family.where("components > 1 and nodes > 2").select(
                F.col("family").alias("f"),
                "main",
                blocks(F.col("main_nodes")).alias("main_blocks"),
                blocks(F.col("nodes") - F.col("main_nodes")).alias("open_blocks"),
            ),
            "open-families",
        )
        rows = sized.join(open_, F.col("family") == F.col("f")).withColumn("is_main", F.col("own") == F.col("main"))
        block = F.pmod(
            F.xxhash64("node"), F.when(F.col("is_main"), F.col("main_blocks")).otherwise(F.col("open_blocks"))
        ).cast("int")
        # A main block (numbered behind the open ones) meets all open blocks; an open block also
        # meets itself and each other open one once.
        rows = rows.withColumn("block", block + F.when(F.col("is_main"), F.col("open_blocks")).otherwise(0))
        all_blocks = F.sequence(F.lit(0), F.col("open_blocks") + F.col("main_blocks") - 1)
        meetings = F.when(
            F.col("is_main"),
            F.transform(
                F.sequence(F.lit(0), F.col("open_blocks") - 1), lambda i: F.struct(i.alias("i"), F.col("block").alias("j"))
            ),
        ).otherwise(
            F.transform(
                all_blocks, lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j"))
            )
        )
        dealt = rows.select("family", "node", "own", "shingles", "block", F.explode(meetings).alias("of"))
        found = (
            dealt.select("family", F.col("of.i").alias("i"), F.col("of.j").alias("j"),
                         F.col("block") == F.col("of.i"), "node", "own", "shingles")
            .toDF("family", "i", "j", "left", "node", "own", "shingles")
            .groupBy("family", "i", "j")
            .applyInArrow(_joining_links(self.per_cent), "u binary, v binary")
        )
        return stage(found, "family-links")

    def across_families(self, families: DataFrame) -> DataFrame:
        """Candidates (a, b) in different families and components.

        In a bucket, members outside the family of its first node meet all others; only pairs with a
        sufficient estimate leave the join.
        """
        labels = stage(
            self.members.join(families, "node", "left").select(
                "bucket", "node", "first", F.coalesce("own", "node").alias("own"), F.coalesce("family", "node").alias("family")
            ),
            "labelled",
        )
        mixed = labels.groupBy("bucket").agg(F.min("family").alias("lo"), F.max("family").alias("hi"))
        firsts = labels.where("node = first").select(F.col("bucket").alias("fb"), F.col("family").alias("main"))
        open_ = stage(
            labels.join(stage(mixed.where("lo != hi").select("bucket"), "mixed"), "bucket")
            .join(firsts, F.col("bucket") == F.col("fb"))
            .join(self.nodes.select("node", "planes"), "node")
            .select("bucket", "node", "own", "family", "main", "planes"),
            "open",
        )
        x = open_.where("family != main").select(
            "bucket", F.col("node").alias("a"), F.col("own").alias("xo"), F.col("family").alias("xf"),
            F.col("planes").alias("pa"), "main",
        )
        y = open_.select(
            F.col("bucket").alias("yb"), F.col("node").alias("b"), F.col("own").alias("yo"),
            F.col("family").alias("yf"), F.col("planes").alias("pb"),
        )
        meet = (
            (F.col("bucket") == F.col("yb"))
            & (F.col("xf") != F.col("yf"))
            & (F.col("xo") != F.col("yo"))
            & ((F.col("yf") == F.col("main")) | (F.col("a") < F.col("b")))
            & (agreeing(F.col("pa"), F.col("pb")) >= least_agreeing(self.similarity))
        )
        return stage(x.join(y, meet).select("a", "b").distinct(), "across")

    def links(self) -> DataFrame:
        """Confirmed links (u, v) that connect all that is to be connected."""
        met = self.met()
        best = met.groupBy("a").agg(F.max(F.struct("agree", "b"))["b"].alias("b"))
        wanted = stage(met.select(F.col("a").alias("node")).union(met.select("b")).distinct(), "wanted")
        sets = self.sets(wanted)
        first = self.confirmed(best, sets)
        # One round is enough for most: what it leaves apart only costs comparisons.
        own = components(first, rounds=1).withColumnRenamed("root", "own")
        family = components(met.select(F.col("a").alias("u"), F.col("b").alias("v")))
        families = stage(
            family.withColumnRenamed("root", "family")
            .join(own, "node", "left")
            .withColumn("own", F.coalesce("own", "node")),
            "families",
        )
        second = self.within_families(families, sets)
        pairs = self.across_families(families)
        ends = stage(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "ends")
        return first.unionByName(second).unionByName(self.confirmed(pairs, self.sets(ends)))


def _joining_links(per_cent: int):
    """Links between the two blocks of a meeting that join components; as few as do."""
    kind = pa.schema([("u", pa.binary()), ("v", pa.binary())])

    def run(rows: pa.Table) -> pa.Table:
        left = np.flatnonzero(rows.column("left").to_numpy())
        right = np.flatnonzero(~rows.column("left").to_numpy())
        right = right if len(right) else left
        sizes, numbers = _numbered(rows.column("shingles").combine_chunks())
        common = _common(sizes, numbers, left, right)
        similar = 100 * common >= per_cent * (sizes[left][:, None] + sizes[right][None, :] - common)
        nodes = rows.column("node").to_pylist()
        parent = {own: own for own in rows.column("own").to_pylist()}

        def root(x: bytes) -> bytes:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        own = rows.column("own").to_pylist()
        out = ([], [])
        for i, j in zip(*np.nonzero(similar)):
            a, b = root(own[left[i]]), root(own[right[j]])
            if a != b:
                parent[a] = b
                out[0].append(nodes[left[i]])
                out[1].append(nodes[right[j]])
        return pa.Table.from_arrays([pa.array(x, pa.binary()) for x in out], schema=kind)

    return run


def _numbered(lists: pa.ListArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sizes of the sets, and the sets as numbers of the shingles that occur twice or more."""
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy()[offsets[0] : offsets[-1]]
    _, which, times = np.unique(values, return_inverse=True, return_counts=True)
    rank = np.cumsum(times > 1) - 1
    bounds = offsets - offsets[0]
    sets = [which[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    return np.diff(bounds), [rank[own[times[own] > 1]] for own in sets]


def _common(sizes: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of all intersections of left and right sets, by products of 0/1 matrices of some
    columns at a time.
    """
    width = 1 + max((int(own.max()) for own in sets if len(own)), default=-1)
    total = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, width, COLUMNS):
        sides = []
        for side in (left, right):
            matrix = np.zeros((len(side), min(COLUMNS, width - at)), np.float32)
            for k, number in enumerate(side):
                own = sets[number]
                matrix[k, own[(own >= at) & (own < at + COLUMNS)] - at] = 1
            sides.append(matrix)
        total += (sides[0] @ sides[1].T).astype(np.int64)
    return total


def _write_classes(graph: _Graph, path: str) -> None:
    """Write (__node, __class): the least key of each class of more than one document."""
    roots = stage(components(graph.links()), "roots")
    rooted = graph.nodes.select("node", "key", "n").join(roots, "node", "left")
    classes = rooted.where("root is not null or n > 1").withColumn(
        "root", F.coalesce("root", "node")
    )
    least = stage(classes.groupBy("root").agg(F.min("key").alias("__class")), "least")
    found = classes.select("node", "root").join(least, "root")
    found.select(F.col("node").alias("__node"), "__class").write.parquet(path)


def near_dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    similarity: float = 0.8,
) -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id`` and ``kept``.

    Texts are compared as sets of ``width``-word shingles with A-Z in lower case; a text with fewer
    words is one shingle. Texts at ``similarity`` (hundredths) or above are linked. ``component_id``
    is the least key that can be reached over links, ``kept`` tells whether it is the row's own.

    Defined cases: a text without words, or a null one, has no shingles and is linked with nothing;
    null keys are reached last, so a component has a null id only if all its keys are null; rows
    that repeat both key and text are kept or dropped alike; an empty table gives an empty result;
    input columns named like a result are replaced. ``docs`` is read several times: stage it if it
    is dear to compute.
    """
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "classes")
    with scratch_until_done(spark):
        _write_classes(_Graph(apart(docs, key=key, text=text), width, similarity), path)
    named_classes = spark.read.parquet(path)
    own = _node_of(width)(named(text))
    rows = docs.withColumn("__own", own).withColumn("__found", F.col("__own.node"))
    joined = rows.join(named_classes, F.col("__found") == F.col("__node"), "left")
    component = F.when(F.col("__node").isNull(), named(key)).otherwise(F.col("__class"))
    return with_results(
        joined,
        {
            "n_shingles": F.col("__own.n_shingles"),
            "component_id": component,
            "kept": named(key).eqNullSafe(component),
        },
    ).drop("__own", "__found", "__node", "__class")


def drop_near_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    similarity: float = 0.8,
) -> DataFrame:
    """The rows of ``docs`` that ``near_dedup`` keeps.

    Texts of rows that surely stay are not shuffled: a Bloom filter of the others tells them where
    they lie.
    """
    content = F.xxhash64(named(text))
    judged = near_dedup(
        docs.select(named(key).alias("key"), named(text).alias("text"), content.alias("print")),
        "key",
        "text",
        width,
        similarity,
    )
    gone = stage(
        judged.where("not kept").select(F.col("key").alias("__key"), F.col("print").alias("__print")).distinct(),
        "gone",
    )
    cells = stage(gone.select(F.xxhash64("__key", "__print").alias("cell")).distinct(), "cells")
    hashed = docs.withColumn("__cell", F.xxhash64(named(key), content))
    tested = flagged(hashed, "__cell", cells, "__possible")
    suspects = tested.where("__possible").join(
        gone, named(key).eqNullSafe(F.col("__key")) & (content == F.col("__print")), "left_anti"
    )
    columns = [named(c) for c in docs.columns]
    return tested.where("not __possible").select(*columns).unionByName(suspects.select(*columns))
