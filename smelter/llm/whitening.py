"""Whitening of embeddings by a bit-sliced scatter matrix.

An entry c becomes the integer x = floor(1024 c) + 100000. Blocks of rows are cut into bit planes:
each dimension is shifted to start at 0, and bit a of all its values is packed into 64-bit words,
one bit a row. The sum of the products of two dimensions is then the sum of popcount(plane & plane)
over all pairs of their planes, each times a power of two: integers throughout, so the scatter
matrix is exact and does not depend on how rows are spread over tasks. Sums are kept around 100000,
in 64 bits while they surely fit and in Python's integers beyond.

The driver gets the sums of D (D + 1) / 2 pairs of D dimensions, whatever the number of rows,
centres them as integers and only then divides, and takes the eigenvectors. A second pass projects
every vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smelter.llm.tables import apart
from smelter.operators import scratch_until_done, stage

# How entries become integers.
SCALE, SHIFT = 1024, 100_000
#: Integers are kept within this distance of SHIFT: entries beyond 2^52 count as 2^52.
MOST = 1 << 62
COMPONENTS = 8

#: Bits that a block of rows is unpacked to at once, for dimensions of up to 16 planes.
_BLOCK_BITS = 1 << 22
#: What a 64-bit sum may reach.
_SAFE = 1 << 62


def block_rows(size: int) -> int:
    """Rows of a block, a multiple of 64."""
    return 64 * max(1, _BLOCK_BITS // (16 * max(size, 1)) // 64)


def integers(column: pa.Array, size: int) -> np.ndarray:
    """x - SHIFT of every entry, as rows x ``size`` longs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * SCALE), -MOST, MOST).astype(np.int64)


def _planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of non-negative rows: words (planes x rows / 64), and each plane's dimension and
    bit."""
    widths = np.array([int(m).bit_length() for m in y.max(axis=0)], np.int64)
    dims = np.repeat(np.arange(y.shape[1]), widths)
    bits = np.arange(len(dims)) - np.repeat(np.cumsum(widths) - widths, widths)
    rows = -(-len(y) // 64) * 64
    single = np.zeros((rows, len(dims)), np.uint8)
    single[: len(y)] = (y[:, dims] >> bits.astype(np.uint64)) & np.uint64(1)
    packed = np.packbits(single, axis=0).T
    return np.ascontiguousarray(packed).view(np.uint64), dims, bits


def scatter(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums (D) and sums of products (D x D, upper triangle) of rows of longs, exactly.

    Longs if they surely fit, else Python integers.
    """
    rows, size = u.shape
    low = u.min(axis=0)
    y = u.astype(np.uint64) - low.astype(np.uint64)
    most = max(int(np.abs(u).max()), int(y.max()))
    kind = np.int64 if 4 * rows * most * most < _SAFE else object
    words, dims, bits = _planes(y)
    power = np.array([1 << int(b) for b in bits], dtype=kind)
    used, first = np.unique(dims, return_index=True)
    sums, products = np.zeros(size, kind), np.zeros((size, size), kind)
    for k, (d, at) in enumerate(zip(used.tolist(), first.tolist())):
        to = first[k + 1] if k + 1 < len(first) else len(dims)
        own = np.zeros(len(dims) - at, kind)
        for p in range(at, to):
            hits = np.bitwise_count(words[at:] & words[p]).sum(axis=1, dtype=np.int64)
            own = own + hits.astype(kind) * power[p]
            sums[d] += int(hits[p - at]) * power[p]
        products[d, used[k:]] = np.add.reduceat(own * power[at:], first[k:] - at)
    # Back from y = u - low.
    low = low.astype(kind)
    outer = np.multiply.outer
    products = products + np.triu(outer(low, sums) + outer(sums, low) + rows * outer(low, low))
    return sums + rows * low, products


class Sums:
    """Sums of blocks: in longs as long as they fit, then moved to Python integers."""

    def __init__(self, size: int):
        self.size, self.rows, self.reach, self.far = size, 0, 0, None
        self.near = np.zeros(size, np.int64), np.zeros((size, size), np.int64)

    def _spill(self, parts: tuple[np.ndarray, np.ndarray]) -> None:
        big = [p.astype(object) for p in parts]
        self.far = big if self.far is None else [a + b for a, b in zip(self.far, big)]

    def add(self, u: np.ndarray) -> None:
        found = scatter(u)
        self.rows += len(u)
        if found[0].dtype == object:
            return self._spill(found)
        reach = 4 * len(u) * max(1, int(np.abs(u).max())) ** 2
        if self.reach + reach >= _SAFE:
            self._spill(self.near)
            self.near, self.reach = tuple(np.zeros_like(p) for p in self.near), 0
        self.near, self.reach = tuple(a + b for a, b in zip(self.near, found)), self.reach + reach

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if self.far is None:
            return self.near
        return tuple(a + b.astype(object) for a, b in zip(self.far, self.near))


_PARTS = "d int, e int, high decimal(38,0), low decimal(38,0)"


def _scatter_rows(size: int):
    """Rows of (vector) to the sums of a partition: (d, e) for products, (d, -1) for sums, (-1, -1)
    for the number of rows. A sum is high * 2^62 + low."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, step = Sums(size), block_rows(size)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                sums.add(integers(batch.column("vector").slice(at, step), size))
        if not sums.rows:
            return
        single, products = sums.total()
        kind = pa.decimal128(38, 0)

        def rows(d: np.ndarray, e: np.ndarray, values: list) -> pa.RecordBatch:
            parts = [divmod(int(v), MOST) for v in values]
            columns = [pa.array([Decimal(p[i]) for p in parts], kind) for i in (0, 1)]
            return pa.RecordBatch.from_arrays(
                [pa.array(d, pa.int32()), pa.array(e, pa.int32()), *columns], ["d", "e", "high", "low"]
            )

        every = np.arange(size)
        yield rows(np.append(every, -1), np.full(size + 1, -1), [*single.tolist(), sums.rows])
        for d in range(size):
            yield rows(np.full(size - d, d), every[d:], products[d, d:].tolist())

    return run


@dataclass
class Whitening:
    """What rows are projected with; ``sums`` are those of x - SHIFT."""

    n: int
    sums: list[int]
    components: np.ndarray  # one column each, unit length
    values: np.ndarray  # eigenvalues
    explained: list[float | None]

    @property
    def usable(self) -> np.ndarray:
        """Components with a variance that is more than rounding."""
        least = self.values.max(initial=0.0) * len(self.sums) * np.finfo(float).eps
        return self.values > max(least, 0.0)

    @classmethod
    def of(cls, n: int, sums: list[int], products: np.ndarray, most: int) -> Whitening:
        """From exact sums: the covariance is centred in integers, then divided once."""
        one = np.array(sums, dtype=object)
        scaled = n * (np.triu(products) + np.triu(products, 1).T) - np.multiply.outer(one, one)
        covariance = (scaled / (n * n)).astype(np.float64)
        trace = int(np.trace(scaled)) / (n * n)
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")[:most]
        values = np.maximum(values[order], 0.0)
        explained = [float(v / trace) if trace > 0 else None for v in values]
        return cls(n, [int(s) for s in sums], vectors[:, order], values, explained)

    def project(self, u: np.ndarray) -> np.ndarray:
        """Whitened rows; not a number for components without variance."""
        centred = u.astype(np.float64) - np.array([s / self.n for s in self.sums])
        usable = self.usable
        scale = np.where(usable, np.sqrt(np.where(usable, self.values, 1.0)), np.nan)
        return centred @ self.components / scale

    def deviations(self, u: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)^2, exactly."""
        most = max(int(np.abs(u).max(initial=0)), *map(abs, self.sums), 1)
        fits = int(np.abs(u).max(initial=0)) * most * len(self.sums) < _SAFE
        kind = np.int64 if fits else object
        v, sums = u.astype(kind), np.array(self.sums, dtype=kind)
        squares, cross = (v * v).sum(axis=1), (v * sums).sum(axis=1)
        n, rest = self.n, sum(s * s for s in self.sums)
        return [n * n * int(a) - 2 * n * int(b) + rest for a, b in zip(squares.tolist(), cross.tolist())]


def _projected(model, size: int, key_field: pa.Field | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                u = integers(part.column("vector"), size)
                whitened = model.value.project(u)
                exact = model.value.deviations(u)
                flat = whitened.reshape(-1)
                bounds = np.arange(len(u) + 1, dtype=np.int32) * whitened.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, pa.float64(), mask=np.isnan(flat)))
                digits = pa.array([str(v) for v in exact])
                longs = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), lists, longs, digits],
                    ["key", "whitened", "deviation", "deviation_digits"],
                )

    step = block_rows(size)
    return run


def usable_vectors(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int | None]:
    """(key, vector) of the rows whose vector has only finite entries and the commonest length
    (the longer one on ties), and that length."""
    rows = apart(vectors, key=key, vector=vector)
    kind = rows.schema["vector"].dataType.elementType.simpleString()
    if kind not in ("float", "double"):
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
    rows = rows.where(F.col("vector").isNotNull() & finite & (F.size("vector") > 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if first is None:
        return rows, None
    return rows.where(F.size("vector") == first.size), first.size


def fit(rows: DataFrame, size: int, most: int = COMPONENTS) -> Whitening:
    """The whitening of (key, vector) rows; the driver gets D (D + 1) / 2 + D + 1 sums."""
    parts = rows.select("vector").mapInArrow(_scatter_rows(size), _PARTS)
    sums = parts.groupBy("d", "e").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    n, single, products = 0, [0] * size, np.zeros((size, size), dtype=object)
    for d, e, high, low in sums.collect():
        value = int(high) * MOST + int(low)
        if d < 0:
            n = value
        elif e < 0:
            single[d] = value
        else:
            products[d, e] = value
    return Whitening.of(n, single, products, most)


def whiten(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS
) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error, deviation_digits): one
    row per usable vector and principal component, at most ``most`` of them, numbered from 1 by
    falling eigenvalue.

    ``whitened`` has mean 0 and variance 1 over all usable vectors, and components are uncorrelated;
    ``identity_error`` is the largest absolute entry of their covariance minus the identity.
    ``deviation`` is the sum over the dimensions of (n x - S)^2; null if a long does not hold it,
    which ``deviation_digits`` always does.

    Defined cases: a null vector, an empty one, one with null or non-finite entries, and one of
    another length than the commonest give no rows; a component without variance (constant entries,
    fewer vectors than dimensions) has a null ``whitened``, which ``identity_error`` leaves out (0 if
    all do), and ``explained`` is null if there is no variance at all; entries beyond 2^52 count as
    2^52; rows that repeat a vector or a key, or have no key, each count and each stay; no usable
    vector gives an empty result; other columns are not returned.
    """
    spark = vectors.sparkSession
    rows, size = usable_vectors(vectors, key, vector)
    key_kind = rows.schema["key"].dataType.simpleString()
    if size is None:
        empty = f"`{key}` {key_kind}, component int, n long, deviation long, whitened double, explained double"
        return spark.createDataFrame([], f"{empty}, identity_error double, deviation_digits string")
    with scratch_until_done(spark):
        model = fit(rows, size, most)
    shared = spark.sparkContext.broadcast(model)  # ``most`` components of D numbers
    wide = stage(
        rows.mapInArrow(
            _projected(shared, size),
            f"key {key_kind}, whitened array<double>, deviation long, deviation_digits string",
        ),
        "whitened",
    )
    shared.destroy()
    found = np.flatnonzero(model.usable).tolist()
    pairs = [(i, j) for i in found for j in found if i <= j]
    own = [F.get("whitened", i) for i in range(len(model.values))]
    error = 0.0
    if pairs:
        # covar_pop centres before it multiplies.
        covariances = wide.agg(*[F.covar_pop(own[i], own[j]) for i, j in pairs]).first()
        error = max(abs(c - (i == j)) for c, (i, j) in zip(covariances, pairs))
    explained = F.array(*[F.lit(x).cast("double") for x in model.explained])
    return wide.select(
        F.col("key").alias(key), "deviation", "deviation_digits", F.posexplode("whitened").alias("__at", "whitened")
    ).select(
        F.col(f"`{key}`"),
        (F.col("__at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("__at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
        "deviation_digits",
    )
