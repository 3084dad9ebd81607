"""Embedding whitening from exact cross-products by bit-sliced scatter.

1. Entries become whole numbers, floor(scale * entry), and equal vectors one row of the fit list (packed as short as they allow,
   combined in the tasks before they are shuffled, so a vector that a third of all rows share sends one row a task).
2. A block of the fit list is shifted so that each dimension starts at 0, and each dimension is cut into bit planes. A plane's
   bits of all rows of the block stand in 64-bit words. The popcount of the AND of two planes, times two to the sum of their bits, adds up
   to the cross-product of two dimensions; the shift is taken out again. Blocks and tasks are summed as whole numbers.
3. n * (sum of x y) - (sum of x) * (sum of y) is n ** 2 times the covariance, centred while still exact. eigh then gets its
   quotients.
4. Rows are projected from n * x - S, which is exact as well. A further pass over the fit list measures how far the whitened
   values' covariance is from the identity.

Only sums leave the tasks: d * (d + 3) / 2 + 1 numbers each, for d dimensions.

Defined results: rows with a null vector, a null or a non-finite entry are dropped. Numbers stop at +-2 ** 61. If lengths
differ, vectors of the length that most rows have are used (of equally frequent lengths the largest); others are dropped, and so are
vectors without entries. Components without variance (below 1e-12 of the trace) aren't returned. A deviation beyond a long is
null. Repeated rows and null ids stay. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, release

MOST = 1 << 61
BLOCK = 8192
#: Sums go through Spark in two parts, so that no decimal overflows.
HALF = 10**18
#: Variance below this share of the trace counts as none.
FLAT = 1e-12


def whole(entries: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * entry), within +-MOST."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * entries), -MOST, MOST).astype(np.int64)


def packed(x: np.ndarray) -> bytes:
    """A vector in 1, 2, 4 or 8 bytes an entry, as few as will do; equal vectors give equal bytes."""
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def unpacked(rows: list[bytes]) -> np.ndarray:
    """Vectors of one length as a matrix."""
    return np.array([np.frombuffer(r, f"<i{r[0]}", offset=1) for r in rows], np.int64)


def quantized(vectors: DataFrame, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """id, dims, x (packed) of the rows that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, dims, rows = [], [], []
            for k, v in enumerate(b.column(1)):
                if v.is_valid and not v.values.null_count:
                    entries = v.values.to_numpy()
                    if len(entries) and np.isfinite(entries).all():
                        keep.append(k)
                        dims.append(len(entries))
                        rows.append(packed(whole(entries, scale)))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), pa.array(dims, pa.int32()), pa.array(rows, pa.binary())], ["id", "dims", "x"])

    source = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return source.mapInArrow(run, f"id {source.schema[0].dataType.simpleString()}, dims int, x binary")


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products (Python integers) of the rows of x, by popcounts of bit planes."""
    n, d = x.shape
    low = x.min(axis=0)
    shifted = x - low
    bits = max(1, int(shifted.max()).bit_length())
    planes = np.zeros((d * bits, -(-n // 64) * 8), np.uint8)
    for k in range(bits):
        planes[k::bits, : -(-n // 8)] = np.packbits((shifted >> k & 1).astype(np.uint8).T, axis=1)
    words = planes.view(np.uint64)
    counts = np.empty((d * bits, d * bits), np.int64)
    for p in range(d * bits):  # symmetric: the rest is copied below
        counts[p, p:] = np.bitwise_count(words[p:] & words[p]).sum(axis=1, dtype=np.int64)
        counts[p:, p] = counts[p, p:]
    exact = object if 2 * bits + n.bit_length() > 62 else np.int64
    cross, sums = np.zeros((d, d), exact), np.zeros(d, exact)
    for k in range(bits):
        sums += np.diagonal(counts)[k::bits].astype(exact) * (1 << k)
        for j in range(bits):
            cross += counts[k::bits, j::bits].astype(exact) * (1 << k + j)
    cross, sums, low = cross.astype(object), sums.astype(object), low.astype(object)
    cross += np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low)
    return sums + n * low, cross


@dataclass
class Whitening:
    """n, sums (exact), eigenvectors as columns, their eigenvalues, the trace, and the measured error."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    values: np.ndarray
    trace: float
    error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        most = self.n * int(np.abs(x).max(initial=0)) + max((abs(int(s)) for s in self.sums), default=0)
        kind = np.int64 if len(self.sums) * most * most < 1 << 62 else object
        return x.astype(kind) * self.n - self.sums.astype(kind)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred.astype(float) / self.n @ self.axes / np.sqrt(self.values)


def total(fit: DataFrame) -> tuple[int, np.ndarray, np.ndarray] | None:
    """n, sums and cross-products of the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, 0, 0
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                x = unpacked(b.column(0).slice(at, BLOCK).to_pylist())
                s, c = scatter(x)
                n, sums, cross = n + len(x), sums + s, cross + c
        if n:
            i, j = np.triu_indices(len(sums))
            values = [n, *sums.tolist(), *cross[i, j].tolist()]
            row = [-1, *([-1] * len(sums)), *i.tolist()]
            column = [-1, *range(len(sums)), *j.tolist()]
            high, low = ([str(x) for x in half] for half in zip(*(divmod(v, HALF) for v in values), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(row, pa.int32()), pa.array(column, pa.int32()), pa.array(high), pa.array(low)], ["i", "j", "high", "low"])

    parts = fit.select("x").mapInArrow(run, "i int, j int, high string, low string")
    sums = parts.groupBy("i", "j").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
    found = {(r["i"], r["j"]): int(r["high"]) * HALF + int(r["low"]) for r in sums.collect()}
    if not found:
        return None
    d = sum(i == -1 for i, _ in found) - 1
    cross = np.empty((d, d), object)
    for (i, j), v in found.items():
        if i >= 0:
            cross[i, j] = cross[j, i] = v
    return found[-1, -1], np.array([found[-1, j] for j in range(d)], object), cross


def model(n: int, sums: np.ndarray, cross: np.ndarray, most: int) -> Whitening:
    scatter_n2 = n * cross - np.outer(sums, sums)
    square = n * n
    covariance = np.array([[int(v) / square for v in row] for row in scatter_n2])
    values, axes = np.linalg.eigh(covariance)
    trace = sum(int(v) for v in np.diagonal(scatter_n2)) / square
    order = [k for k in np.argsort(values)[::-1][:most] if trace > 0 and values[k] > FLAT * trace]
    return Whitening(n, sums, axes[:, order], values[order], trace)


def identity_error(fit: DataFrame, made: Whitening) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity."""
    k = len(made.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, cross = np.zeros(k), np.zeros((k, k))
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                w = made.whitened(made.centred(unpacked(b.column(0).slice(at, BLOCK).to_pylist())))
                sums, cross = sums + w.sum(axis=0), cross + w.T @ w
        row, column = np.indices((k, k))
        yield pa.RecordBatch.from_arrays(
            [pa.array([*row.ravel(), *([-1] * k)], pa.int32()), pa.array([*column.ravel(), *range(k)], pa.int32()), pa.array([*cross.ravel(), *sums])], ["i", "j", "value"]
        )

    parts = fit.select("x").mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    found = {(r["i"], r["j"]): r["value"] / made.n for r in parts}
    return max((abs(found[i, j] - found[-1, i] * found[-1, j] - (i == j)) for i in range(k) for j in range(k)), default=0.0)


OUT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = 4, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per remaining row of vectors and component: id, component, n, deviation, whitened, explained, identity_error."""
    rows = quantized(vectors, scale, id_col, vector_col)
    fit = cut(rows.groupBy("dims", "x").agg(F.count(F.lit(1)).alias("copies")), "whitening-fit")
    kind = rows.schema["id"].dataType.simpleString()
    best = fit.groupBy("dims").agg(F.sum("copies").alias("rows")).orderBy(F.desc("rows"), F.desc("dims")).first()
    if best is None:
        release(fit)
        return vectors.sparkSession.createDataFrame([], f"id {kind}, {OUT}")
    dims = best["dims"]
    own = fit.filter(F.col("dims") == dims)
    made = model(*total(own), components)
    made.error = identity_error(own, made)
    release(fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(made.values)
        for b in batches:
            for at in range(0, b.num_rows if k else 0, BLOCK):
                part = b.slice(at, BLOCK)
                centred = made.centred(unpacked(part.column("x").to_pylist()))
                deviation = [int(v) if v < 1 << 63 else None for v in (centred * centred).sum(axis=1)]
                m = part.num_rows
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                        pa.array(np.full(m * k, made.n, np.int64)),
                        pa.array(deviation, pa.int64()).take(pa.array(each)),
                        pa.array(made.whitened(centred).ravel()),
                        pa.array(np.tile(made.values / made.trace, m)),
                        pa.array(np.full(m * k, made.error)),
                    ],
                    ["id", *[c.split()[0] for c in OUT.split(", ")]],
                )

    return rows.filter(F.col("dims") == dims).mapInArrow(run, f"id {kind}, {OUT}")
