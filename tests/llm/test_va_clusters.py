from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from check import compare, duck
from sparkwh.llm import va_clusters as va
from tests.llm.helpers import SF

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        *(T.StructField(c, T.StringType()) for c in ("vector", "cells", "cluster", "hash", "dim"))])


def frame(spark, rows):
    return spark.createDataFrame([(*r, *"xxxxx") for r in rows], VECTORS)


def brute(rows, p):
    """The contract with Python's integers."""
    kept = [(i, [int(x) * p.scale if abs(x) >= 1 << 53 else math.floor(x * p.scale) for x in v]) for i, v in rows
            if v is not None and len(v) == p.dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"{p.seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centers = [v for _, v in named[:p.k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centers)) for _, v in kept]
    for _ in range(p.rounds):
        found = assign()
        for k in range(len(centers)):
            mine = [v for (_, v), (_, c) in zip(kept, found) if c == k]
            if mine:
                centers[k] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    top = (1 << 63) - 1
    per = {k: sum(min(d, top) for d, c in found if c == k) for k in range(len(centers))}
    return sorted(((i, c, min(d, top), min(per[c], top), min(sum(per.values()), top),
                    hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, found)), key=repr)


def got(df):
    return sorted((tuple(r)[:-1] for r in df.collect()), key=repr)


def test_query_agrees_with_sql(spark):
    good, note = compare(spark, duck(SF), "op11_centroid_clusters", SF)
    assert good and "TYPES" not in note, note


@pytest.mark.parametrize("bits", [1, 3, 6, 8])
def test_every_number_of_bits_gives_the_same(spark, bits):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) + (i % 5) for _ in range(7)]) for i in range(300)]
    p = va.VAParameters(k=6, dims=7, bits=bits, scale=16)
    assert got(va.clustered(frame(spark, rows), p)) == brute(rows, p)


def test_odd_vectors_ties_and_repeats(spark):
    p = va.VAParameters(k=4, dims=3, scale=64)
    rows = [(1, [0.0, 0.0, 0.0]), (2, [1.0, 1.0, 1.0]), (3, [-1.0, 0.5, 2.0]), (4, [0.5, 0.5, 0.5]), (4, [0.5, 0.5, 0.5]),
            (4, [9.0, 0.0, 0.0]), (None, [2.0, -2.0, 1.0]), (5, None), (6, []), (7, [1.0, 2.0]), (8, [1.0, None, 2.0]),
            (9, [float("nan"), 0.0, 0.0]), (10, [float("inf"), 0.0, 0.0]), (11, [-0.001, -0.0, 1e-300])]
    rows += [(20 + i, [0.25, 0.25, 0.25]) for i in range(50)]
    assert got(va.clustered(frame(spark, rows), p)) == brute(rows, p)


def test_large_components_stay_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1e3, 1e9, 1e30, 1e300, 1.7e308]) * rng.uniform(-1, 1) for _ in range(4)]) for i in range(40)]
    rows += [(100 + i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    p = va.VAParameters(k=5, dims=4)
    assert got(va.clustered(frame(spark, rows), p)) == brute(rows, p)


def test_fewer_vectors_than_centroids_and_none(spark):
    p = va.VAParameters(k=16, dims=2)
    rows = [(1, [0.0, 1.0]), (2, [1.0, 0.0])]
    assert got(va.clustered(frame(spark, rows), p)) == brute(rows, p)
    assert va.clustered(frame(spark, []), p).collect() == []
    assert va.clustered(frame(spark, [(1, None)]), p).collect() == []


def test_intervals_hold_the_distances_and_save_most_of_them():
    rng = np.random.default_rng(1)
    p = va.VAParameters(k=8, dims=16)
    centers = rng.integers(-60, 60, (8, 16))
    x = centers[rng.integers(0, 8, 2000)] + rng.integers(-12, 13, (2000, 16))
    grid = va.Grid.fitted(x.min(0), x.max(0), x.mean(0), x.std(0), p.bits)
    cells = grid.cells(x)
    assert (va.unpack(va.pack(cells, p.bits), p.dims, p.bits) == cells).all()
    low, high = va.intervals(cells, *va.tables(grid, [tuple(map(int, c)) for c in centers], p.limit))
    gap = ((x[:, None, :] - centers[None]) ** 2).sum(2) - ((x - centers.sum(0) // 8) ** 2).sum(1)[:, None]
    assert (low <= gap).all() and (gap <= high).all()
    assert ((low <= high.min(1)[:, None]).sum(1) == 1).mean() > 0.95


def test_digits_add_up():
    values = [0, 1, -1, 1 << 200, -(1 << 90) + 7, 12345678901234567890]
    total = sum(digit << (va.LIMB_BITS * place) for v in values for place, digit in va.limbs(v))
    assert total == sum(values)
