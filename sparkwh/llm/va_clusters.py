"""Centroid clustering over a vector-approximation file.

One pass writes every vector next to its approximation: a cell number of a few bits per dimension. A round of assignment
reads the cells first: tables with the least and the greatest squared difference of every (dimension, cell, centroid), taken
relative to one point for all centroids, are looked up and added, which gives a distance interval per centroid. Where one interval lies below all others the vector's
centroid is known; full vectors are fetched, and exact distances worked out, only for the centroids whose intervals
overlap. The new centroids are floors of exact sums, which every task adds up for its own rows; a few thousand numbers per
task are shuffled, whatever its rows. Nothing is grouped by vector, so repeated vectors are no hot key.

Everything is whole-number arithmetic. Vectors with components too large for 64-bit squares go without cells: all
centroids are open for them, and Python's integers decide.

Defined results: vectors of another length, NULL, or with a NULL or non-finite component give no row. A vector without an
id takes part (its hash is that of ``<seed>:``). Equal hashes (repeated ids) seed in the order of their vectors. With
fewer vectors than ``k`` there are as many centroids as vectors; without any, no rows. Repeated rows are vectors of their
own. Distances and inertias beyond a long are given as the largest long; the clusters stay exact. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import stage
from .batches import tidy

LIMB_BITS = 32
LONG_MAX = (1 << 63) - 1
_ASSIGNED = "vec_id BIGINT, cluster INT, distance BIGINT, n_candidates INT"
_RESULT = ("vec_id BIGINT, cluster INT, distance BIGINT, cluster_inertia BIGINT, inertia BIGINT, centroid_sha256 STRING, "
           "n_candidates INT")


@dataclass(frozen=True)
class VAParameters:
    """``k`` centroids, ``rounds`` of assignment and update, vectors of ``dims`` components, each times ``scale`` and floored;
    ``bits`` per dimension in the approximation; ``seed`` goes into the hash that picks the first centroids."""

    k: int = 16
    rounds: int = 3
    dims: int = 64
    scale: int = 64
    bits: int = 6
    seed: int = 1

    def __post_init__(self) -> None:
        if not 1 <= self.bits <= 8:
            raise ValueError("1 to 8 bits per dimension")
        if min(self.k, self.dims, self.scale) < 1 or self.rounds < 0 or self.scale & (self.scale - 1):
            raise ValueError("k, dims and scale are positive, scale is a power of two, rounds are not negative")

    @property
    def limit(self) -> int:
        """Components up to here, on both sides, leave the sum of ``dims`` squared differences below 2**62."""
        return math.isqrt((1 << 62) // self.dims) // 2


def whole(value: float, scale: int) -> int:
    """floor(scale * value), exactly, also where the product would overflow."""
    return int(value) * scale if abs(value) >= 1 << 53 else math.floor(value * scale)


@dataclass(frozen=True)
class Grid:
    """Cells of every dimension. ``marks`` (dims, cells - 1) are their inner borders, whole numbers in ascending order; a value
    lies in the cell whose number is the number of marks at or below it. ``low`` and ``high`` are the smallest and largest whole
    number in each cell that any vector has at most."""

    marks: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def fitted(cls, least: np.ndarray, most: np.ndarray, mean: np.ndarray, spread: np.ndarray, bits: int) -> Grid:
        """Borders at equal shares of a normal distribution of the dimension's mean and deviation. They only decide how tight
        the intervals are; the outer cells end at the true least and greatest values."""
        shares = [NormalDist().inv_cdf(j / (1 << bits)) for j in range(1, 1 << bits)]
        marks = np.rint(mean[:, None] + spread[:, None] * np.array(shares)).astype(np.int64)
        return cls(marks, np.concatenate([least[:, None], marks], 1), np.concatenate([marks - 1, most[:, None]], 1))

    def cells(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for d in range(x.shape[1]):
            out[:, d] = np.searchsorted(self.marks[d], x[:, d], "right")
        return out


def pack(cells: np.ndarray, bits: int) -> np.ndarray:
    """(n, dims) cell numbers as (n, bytes)."""
    flags = (cells[:, :, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint8)) & 1
    return np.packbits(flags.reshape(len(cells), -1).astype(bool), axis=1)


def unpack(packed: np.ndarray, dims: int, bits: int) -> np.ndarray:
    flags = np.unpackbits(packed, axis=1, count=dims * bits).reshape(len(packed), dims, bits)
    return flags @ (1 << np.arange(bits - 1, -1, -1)).astype(np.uint8)


def tables(grid: Grid, centroids: list[tuple[int, ...]], limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest contribution (dims, cells, k) to the squared distance to every centroid, less that to a point
    amid all of them. What is taken off is the same for all centroids, so their order stays, but it is what the cells tell
    least about: the difference is linear in the vector, with the slope of the centroid's gap to that point. A centroid too
    large for 64 bits gets bounds that leave it open."""
    plain = np.array([max(map(abs, c)) <= limit for c in centroids])
    c = np.array([x if ok else (0,) * len(x) for x, ok in zip(centroids, plain)], np.int64).T[:, None, :]
    amid = c[:, :, plain].sum(axis=2, keepdims=True) // max(plain.sum(), 1)
    ends = [c * c - amid * amid - 2 * x[:, :, None] * (c - amid) for x in (grid.low, grid.high)]
    least, most = np.minimum(*ends), np.maximum(*ends)
    least[:, :, ~plain], most[:, :, ~plain] = -((1 << 62) // len(c)), (1 << 62) // len(c)
    return least, most


def intervals(cells: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of every row's squared distance to every centroid, less that to the point amid them."""
    low, high = np.zeros((len(cells), least.shape[2]), np.int64), np.zeros((len(cells), least.shape[2]), np.int64)
    for d in range(cells.shape[1]):
        low += least[d][cells[:, d]]
        high += most[d][cells[:, d]]
    return low, high


def narrow(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(vectors * scale).astype(np.int64)


def broad(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.array([[whole(v, scale) for v in r] for r in vectors.tolist()], object).reshape(vectors.shape)


class Assigner:
    """Nearest centroids of batches of vectors with their cells."""

    def __init__(self, grid: Grid, centroids: list[tuple[int, ...]], p: VAParameters):
        self.p, self.exact = p, np.array(centroids, object).reshape(len(centroids), p.dims)
        self.plain = max(map(abs, self.exact.flat)) <= p.limit
        self.small = self.exact.astype(np.int64) if self.plain else None
        self.least, self.most = tables(grid, centroids, p.limit)

    def distances(self, vectors: np.ndarray, which: np.ndarray, wide: bool) -> np.ndarray:
        """Exact squared distance of every vector to its centroid in ``which``, in 64 bits where that is enough."""
        if wide or not self.plain:
            gap = broad(vectors, self.p.scale) - self.exact[which]
        else:
            gap = narrow(vectors, self.p.scale) - self.small[which]
        return (gap * gap).sum(axis=1)

    def __call__(self, cells: np.ndarray, wide: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and number of candidates of every row. ``wide`` rows have no cells."""
        low, high = intervals(cells, self.least, self.most)
        candidates = low <= high.min(axis=1)[:, None]
        candidates[wide] = True
        number, cluster = candidates.sum(axis=1), candidates.argmax(axis=1)
        for kind in (False, True):
            rows = np.flatnonzero((number > 1) & (wide == kind))
            if len(rows):
                at, which = np.nonzero(candidates[rows])
                found = self.distances(vectors[rows[at]], which, kind)
                every = np.full(candidates[rows].shape, found.max() + 1, found.dtype)
                every[at, which] = found
                cluster[rows] = every.argmin(axis=1)  # the first of equal ones
        return cluster, number


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _is_wide(x: np.ndarray, p: VAParameters) -> np.ndarray:
    return np.abs(x).max(axis=1) > (p.limit - 1) / p.scale


def _read(batch: pa.RecordBatch, p: VAParameters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells, which rows have none, vectors."""
    packed, width = batch.column("cells"), (p.dims * p.bits + 7) // 8
    filled = b"".join(b if b is not None else bytes(width) for b in packed.to_pylist())
    cells = unpack(np.frombuffer(filled, np.uint8).reshape(-1, width), p.dims, p.bits)
    return cells, ~np.asarray(packed.is_valid()), _matrix(batch.column("vector"), p.dims)


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """A whole number as (place, digit) to the base 2**LIMB_BITS, digits with its sign: adding digits adds numbers."""
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield place, sign * (value & ((1 << LIMB_BITS) - 1))
        value, place = value >> LIMB_BITS, place + 1


def kept_vectors(vectors: DataFrame, p: VAParameters, id_col: str, column: str) -> DataFrame:
    """``vec_id, vector`` of the rows that count as vectors."""
    plain = isinstance(vectors.schema[column].dataType.elementType, (T.FloatType, T.DoubleType))
    vector = F.col(column) if plain else F.col(column).cast("array<double>")
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    return (vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), vector.alias("vector"))
            .where((F.size("vector") == p.dims) & finite))


def first_centroids(kept: DataFrame, p: VAParameters) -> list[tuple[int, ...]]:
    """The ``k`` vectors with the smallest hashes of ``<seed>:<id>``; each task sends ``k`` rows at most."""
    named = F.sha2(F.concat(F.lit(f"{p.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    seeds = kept.select("vector", named.alias("hash")).orderBy("hash", "vector").limit(p.k).select("vector").collect()
    return [tuple(whole(v, p.scale) for v in r["vector"]) for r in seeds]


def fitted_grid(kept: DataFrame, p: VAParameters) -> Grid:
    """Cell borders from the least, greatest and mean value and the deviation of every dimension, over all vectors."""
    def run(batches):
        least, most = np.full(p.dims, math.inf), np.full(p.dims, -math.inf)
        total, squares, n = np.zeros(p.dims), np.zeros(p.dims), 0
        for batch in batches:
            x = _matrix(batch.column("vector"), p.dims)
            x = narrow(x[~_is_wide(x, p)], p.scale).astype(np.float64)
            if len(x):
                least, most = np.minimum(least, x.min(axis=0)), np.maximum(most, x.max(axis=0))
                total, squares, n = total + x.sum(axis=0), squares + (x * x).sum(axis=0), n + len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"dim": pa.array(range(p.dims), pa.int32()), "least": least, "most": most,
                                              "total": total, "squares": squares, "n": np.full(p.dims, float(n))})

    parts = kept.select("vector").mapInArrow(tidy(run), "dim INT, least DOUBLE, most DOUBLE, total DOUBLE, squares DOUBLE, n DOUBLE")
    found = parts.groupBy("dim").agg(F.min("least").alias("least"), F.max("most").alias("most"), *[
        F.sum(c).alias(c) for c in ("total", "squares", "n")]).collect()
    least, most, mean, spread = np.zeros((4, p.dims))
    for r in found:
        d = r["dim"]
        least[d], most[d], mean[d] = r["least"], r["most"], r["total"] / r["n"]
        spread[d] = math.sqrt(max(r["squares"] / r["n"] - mean[d] ** 2, 0))
    return Grid.fitted(least.astype(np.int64), most.astype(np.int64), mean, spread, p.bits)


def approximated(kept: DataFrame, grid: Grid, p: VAParameters) -> DataFrame:
    """``vec_id, cells, vector``; vectors with too large components have no cells."""
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("vector"), p.dims)
            wide = _is_wide(x, p)
            packed = pack(grid.cells(narrow(np.where(wide[:, None], 0, x), p.scale)), p.bits)
            cells = pa.array([None if w else c.tobytes() for c, w in zip(packed, wide.tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), cells, batch.column("vector")],
                                             ["vec_id", "cells", "vector"])

    vector = kept.schema["vector"].dataType.simpleString()
    return kept.mapInArrow(tidy(run), f"vec_id BIGINT, cells BINARY, vector {vector}")


def updated(file: DataFrame, grid: Grid, centroids: list[tuple[int, ...]], p: VAParameters) -> list[tuple[int, ...]]:
    """Assign every vector and return the floors of the clusters' means; empty clusters keep their centroid. A task hands over
    one number (of a few digits) per cluster and dimension."""
    k = len(centroids)

    def run(batches):
        assign = Assigner(grid, centroids, p)
        sums, count = np.zeros((k, p.dims), object), np.zeros(k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, wide, vectors = _read(batch, p)
            cluster, _ = assign(cells, wide, vectors)
            count += np.bincount(cluster, minlength=k)
            for kind, exact in ((False, narrow), (True, broad)):
                rows = np.flatnonzero(wide == kind)
                rows = rows[np.argsort(cluster[rows], kind="stable")]
                if len(rows):
                    present, first = np.unique(cluster[rows], return_index=True)
                    sums[present] += np.add.reduceat(exact(vectors[rows], p.scale), first, axis=0).astype(object)
        rows = [(c, d, *part) for c in range(k) for d, value in [(-1, int(count[c])), *enumerate(sums[c])]
                for part in limbs(int(value))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(),) * 3 + (pa.int64(),))],
                                             ["cluster", "dim", "place", "digit"])

    parts = file.mapInArrow(tidy(run), "cluster INT, dim INT, place INT, digit BIGINT")
    totals = np.zeros((k, p.dims + 1), object)
    for r in parts.groupBy("cluster", "dim", "place").agg(F.sum("digit").alias("digit")).collect():
        totals[r["cluster"], r["dim"]] += r["digit"] << (LIMB_BITS * r["place"])  # the count is in the last column
    return [tuple(int(s) // int(t[-1]) for s in t[:-1]) if t[-1] else old for t, old in zip(totals, centroids)]


def assigned(file: DataFrame, grid: Grid, centroids: list[tuple[int, ...]], p: VAParameters) -> DataFrame:
    """``vec_id, cluster, distance, n_candidates`` for fixed centroids."""
    def run(batches):
        assign = Assigner(grid, centroids, p)
        for batch in batches:
            cells, wide, vectors = _read(batch, p)
            cluster, number = assign(cells, wide, vectors)
            distance = np.zeros(len(cells), np.int64)
            for kind in (False, True):
                rows = np.flatnonzero(wide == kind)
                if len(rows):
                    distance[rows] = np.minimum(assign.distances(vectors[rows], cluster[rows], kind), LONG_MAX).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance), pa.array(number, pa.int32())],
                ["vec_id", "cluster", "distance", "n_candidates"])

    return file.mapInArrow(tidy(run), _ASSIGNED)


def clustered(vectors: DataFrame, p: VAParameters = VAParameters(), id_col: str = "vec_id",
              column: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, n_candidates`` per kept vector.

    ``n_candidates`` is the number of centroids whose distance intervals overlapped in the last assignment: 1 where the
    approximation alone decided. See the module's text for NULLs, ties, repeated rows and large values.
    """
    spark, kept = vectors.sparkSession, kept_vectors(vectors, p, id_col, column)
    centroids = first_centroids(kept, p)
    if not centroids:
        return spark.createDataFrame([], _RESULT)
    grid = fitted_grid(kept, p)
    file = stage(approximated(kept, grid, p), "va_file")
    for _ in range(p.rounds):
        centroids = updated(file, grid, centroids, p)
    found = stage(assigned(file, grid, centroids, p), "clusters")
    # One row per centroid comes back: at most k.
    sums = {r["cluster"]: int(r["total"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    inertia = min(sum(sums.values()), LONG_MAX)
    per_cluster = spark.createDataFrame(
        [(c, min(total, LONG_MAX), inertia, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
         for c, total in sums.items()], "cluster INT, cluster_inertia BIGINT, inertia BIGINT, centroid_sha256 STRING")
    return found.join(F.broadcast(per_cluster), "cluster").select(*[c.split()[0] for c in _RESULT.split(", ")])
