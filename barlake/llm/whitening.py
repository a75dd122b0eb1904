"""Whitening of embeddings by principal components, with covariances that are exact.

Entries are put on a grid of integers, ``x = floor(SCALE * c) + ORIGIN``. The fit
list holds each distinct grid vector once. Its cross-products come from bit
slices: a block of rows is shifted so that each dimension begins at zero, every
bit of every dimension becomes a plane, packed across the rows into 64-bit
words, and the number of rows in which two bits are both set is the popcount of
the AND of their planes. Weighted by the powers of two of the bits, these counts
sum to the exact products of the shifted values; taking the shift back and
summing blocks and tasks are integer sums too. The scatter ``n * XX - S S'`` is
centred as integers, and only then divided and decomposed.

Null vectors and vectors with null or non-finite entries are left out, so are
entries whose grid value has no room in a long. The dimension is that of most of
the vectors (at ties the smaller); vectors of another one take no part. Repeated
rows each have a result and count once in the fit. Ids may be null and repeat. Other columns are not read. An empty
table gives an empty result. A component without variance (fewer distinct
vectors than components, constant dimensions) has null whitened values and
explains 0; with no variance at all ``explained`` and ``identity_error`` are null.
A deviation beyond 38 digits is null.

The driver holds the cross-products of the dimensions, a task one block of
``BLOCK`` rows in planes and those products: sizes that do not grow with rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.jaccard import stored

SCALE = 64
ORIGIN = 1_000_000
COMPONENTS = 16
BLOCK = 1 << 14
LIMB_BITS = 30
RESULT = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"


def usable(vector: Column) -> Column:
    """A vector that is there, with entries that are there, finite, and on the grid of a long."""
    inside = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * SCALE) < float(1 << 62)))
    return F.coalesce(vector.isNotNull() & inside, F.lit(False))


def on_grid(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x) of the usable vectors; x is counted from ``ORIGIN``."""
    kept = vectors.filter(usable(F.col(column)))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.transform(column, lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


# ------------------------------------------------------------- bit slices


def bit_planes(values: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Planes of unsigned columns in 64-bit words across the rows, and (dimension, bit) of each plane."""
    rows, size = values.shape
    packed, which = [], []
    for dimension in range(size):
        column = values[:, dimension]
        for bit in range(int(column.max()).bit_length()):
            plane = np.zeros(-(-rows // 64) * 64, np.uint8)
            plane[:rows] = column >> np.uint64(bit) & np.uint64(1)
            packed.append(np.packbits(plane).view(np.uint64))
            which.append((dimension, bit))
    return np.array(packed, np.uint64).reshape(len(which), -(-rows // 64)), which


def cross_products(values: np.ndarray) -> np.ndarray:
    """Exact sums over the rows of the products of any two unsigned columns, as Python integers."""
    rows, size = values.shape
    planes, which = bit_planes(values)
    both = np.zeros((len(which), len(which)), np.int64)
    for k, plane in enumerate(planes):
        both[k, k:] = np.bitwise_count(plane & planes[k:]).sum(axis=1, dtype=np.int64)
    both = np.maximum(both, both.T)
    widest = max((bit + 1 for _, bit in which), default=0)
    kind = np.int64 if 2 * widest + rows.bit_length() < 63 else object
    weights = np.zeros((size, len(which)), kind)
    for k, (dimension, bit) in enumerate(which):
        weights[dimension, k] = 1 << bit
    return (weights @ both.astype(kind) @ weights.T).astype(object)


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, part) whose parts fit a long by far, so that many of them can be summed."""
    place = 0
    while not -(1 << LIMB_BITS) <= value < 1 << LIMB_BITS:
        value, low = divmod(value, 1 << LIMB_BITS)
        yield place, low
        place += 1
    yield place, value


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    """The rows of column x, ``BLOCK`` at a time, however they are batched."""
    held, rows = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            held.append(matrix(batch.column("x").slice(at, BLOCK), size))
            rows += len(held[-1])
            if rows >= BLOCK:
                whole = np.concatenate(held)
                yield whole[:BLOCK]
                held, rows = [whole[BLOCK:]], rows - BLOCK
    if rows:
        yield np.concatenate(held)


SUMS = "i int, j int, place int, part long"


def _scatter(size: int):
    """Sums of a task: products as (i, j), sums as (-1, j), the number of rows as (-1, -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, np.zeros(size, object), np.zeros((size, size), object)
        for x in blocks(batches, size):
            low = x.min(axis=0)
            shifted = x.astype(np.uint64) - low.astype(np.uint64)
            base = low.astype(object)
            part = (shifted.astype(object) if int(shifted.max()).bit_length() > 40 else shifted).sum(axis=0).astype(object)
            moved = np.outer(base, part)
            cross = cross + cross_products(shifted) + moved + moved.T + len(x) * np.outer(base, base)
            sums = sums + part + len(x) * base
            n += len(x)
        if n:
            found = [(-1, -1, n), *((-1, j, s) for j, s in enumerate(sums)),
                     *((i, j, cross[i, j]) for i in range(size) for j in range(i, size))]
            rows = [(i, j, place, part) for i, j, value in found for place, part in limbs(int(value))]
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["i", "j", "place", "part"])

    return run


def moments(fit: DataFrame, size: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, sums, products) of the fit list in exact integers, counted from ``ORIGIN``."""
    parts = fit.mapInArrow(_scatter(size), SUMS).groupBy("i", "j", "place").agg(F.sum("part").alias("part")).collect()
    n, sums, cross = 0, np.zeros(size, object), np.zeros((size, size), object)
    for r in parts:
        value = r["part"] << LIMB_BITS * r["place"]
        if r["j"] < 0:
            n += value
        elif r["i"] < 0:
            sums[r["j"]] += value
        else:
            cross[r["i"], r["j"]] += value
    upper = np.triu(cross, 1)
    return n, sums, cross + upper.T


def principal(n: int, sums: np.ndarray, cross: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns, explained shares) of the foremost components."""
    scatter = n * cross - np.outer(sums, sums)
    covariance = (scatter / (n * n)).astype(np.float64)
    trace = int(np.trace(scatter)) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:keep], vectors[:, ::-1][:, :keep]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    values = np.where(values > len(covariance) * np.finfo(float).eps * max(values[0], 0), values, 0)
    return values, vectors * signs, values / trace if trace else np.full(len(values), np.nan)


# ------------------------------------------------------------- results


class Whitening:
    """What every row needs: the number and sums of the fit list, and the scaled components."""

    def __init__(self, n: int, sums: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.n, self.sums = n, sums
        with np.errstate(divide="ignore", invalid="ignore"):
            self.scaled = np.where(values > 0, vectors / np.sqrt(values), np.nan)
        self.largest = max((abs(int(s)) for s in sums), default=0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: of 64 bits where squares of them fit, else Python integers."""
        most = self.n * int(np.abs(x).max(initial=0)) + self.largest
        wide = x.shape[1] * most * most >= 1 << 63
        kind = object if wide else np.int64
        return self.n * x.astype(kind) - self.sums.astype(kind)

    def projected(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.scaled


def _covariances(model: Whitening, size: int):
    """Sums and products of the whitened values of a task, with the variables i = -1 for sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((model.scaled.shape[1] + 1,) * 2)
        for batch in batches:
            w = model.projected(model.centred(matrix(batch.column("x"), size)))
            w = np.hstack([np.ones((len(w), 1)), w])
            total += w.T @ w
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel() - 1, pa.int32()), pa.array(j.ravel() - 1, pa.int32()), pa.array(total.ravel())], names=["i", "j", "part"])

    return run


def identity_error(fit: DataFrame, model: Whitening, size: int) -> float | None:
    """How far the covariance of the whitened fit list, measured on its values, is from the identity."""
    k = model.scaled.shape[1]
    total = np.zeros((k + 1, k + 1))
    for r in fit.mapInArrow(_covariances(model, size), "i int, j int, part double").groupBy("i", "j").agg(F.sum("part").alias("s")).collect():
        total[r["i"] + 1, r["j"] + 1] = r["s"]
    means = total[0, 1:] / model.n
    off = np.abs(total[1:, 1:] / model.n - np.outer(means, means) - np.eye(k))
    known = ~np.isnan(model.scaled[0])
    return float(off[np.ix_(known, known)].max()) if known.any() else None


def _whitened(model: Whitening, size: int, explained: np.ndarray, error: float | None):
    shares = [None if np.isnan(e) else float(e) for e in explained]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            centred = model.centred(matrix(batch.column("x"), size))
            squares = (centred * centred).sum(axis=1)
            if squares.dtype == np.int64:
                deviation = pa.array(squares).cast(pa.decimal128(38, 0))
            else:
                deviation = pa.array([Decimal(int(s)) if s < 10**38 else None for s in squares], pa.decimal128(38, 0))
            values = model.projected(centred)
            flat = pa.array(values.ravel(), mask=np.isnan(values.ravel()))
            bounds = pa.array(np.arange(rows + 1) * values.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(np.full(rows, model.n)), deviation, pa.ListArray.from_arrays(bounds, flat),
                 pa.array([shares] * rows, pa.list_(pa.float64())), pa.array([error] * rows, pa.float64())],
                names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """Per usable vector: vec_id, n, deviation, whitened and explained by component, identity_error."""
    spark = vectors.sparkSession
    rows = on_grid(vectors, column)
    sizes = rows.filter(F.size("x") > 0).groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").head(1)
    if not sizes:
        return spark.createDataFrame([], RESULT)
    size = sizes[0]["size"]
    rows = rows.filter(F.size("x") == size)
    fit = stored(rows.select("x").distinct(), "fit-list")
    n, sums, cross = moments(fit, size)
    values, axes, explained = principal(n, sums, cross, components)
    model = Whitening(n, sums, values, axes)
    return rows.mapInArrow(_whitened(model, size, explained, identity_error(fit, model, size)), RESULT)
