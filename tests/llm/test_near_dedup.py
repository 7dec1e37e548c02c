from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from sparkwh.llm.components import connected
from sparkwh.llm.near_dedup import NearParameters, _bucket_edges, near_groups, sketches

from .helpers import EDGES, brute_components, docs_of, family, shingles, table


def result(df) -> dict:
    return {r["doc_id"]: r for r in df.collect()}


def test_sketch_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    b = np.concatenate([a[:300], rng.integers(0, 1 << 63, 100).astype(np.uint64)])
    s = sketches(np.concatenate([a, b]), np.repeat([0, 1], 400), 2, 1_000)
    assert abs((s[0] == s[1]).mean() - 300 / 500) < 0.06


@pytest.mark.parametrize("size", [1, 2, 3, 50])
def test_every_coordinate_fills(size):
    s = sketches(np.arange(size, dtype=np.uint64), np.zeros(size, np.int64), 1, 64)
    assert (s != np.iinfo(np.uint64).max).all()


def test_whole_table_matches_all_pairs(spark):
    docs = table(spark, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, got = brute_components(rows, 2), result(near_groups(docs))
    assert len(got) == len(rows)
    for i, text in rows:
        assert got[i]["component_id"] == want[i] and got[i]["n_shingles"] == len(shingles(text, 2))
        assert got[i]["kept"] == (want[i] == i)


@pytest.mark.parametrize("parameters", [
    NearParameters(), NearParameters(shingle=5), NearParameters(bucket_rows=7), NearParameters(block_shingles=1_500, delegates=2),
    NearParameters(block_shingles=700, delegates=1, bucket_rows=5)])
def test_large_families_in_blocks(spark, parameters):
    rows = family(1, 90) + family(2, 70, words=80, edits=5, first=500) + [(900 + k, f"x{k} y{k} z{k} u v w") for k in range(10)]
    want, got = brute_components(rows, parameters.shingle), result(near_groups(docs_of(spark, rows), parameters))
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert len(set(want.values())) > 12  # the families do break up


@pytest.mark.parametrize("parameters", [NearParameters(bucket_rows=4), NearParameters(bucket_rows=4, block_shingles=900, delegates=1)])
def test_shared_boilerplate_with_near_copies_in_it(spark, parameters):
    rng = random.Random(5)
    plate = [f"b{k}" for k in range(60)]
    rows = []
    for k in range(150):  # alike at about 0.5, which is no link
        own = [f"o{rng.randrange(10 ** 9)}" for _ in range(30)]
        rows.append((3 * k, " ".join(plate + own)))
        if k % 3 == 0:  # a near copy of the whole
            rows.append((3 * k + 1, " ".join(plate + own[:-2] + ["x", "y"])))
    want, got = brute_components(rows, 2), result(near_groups(docs_of(spark, rows), parameters))
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert sum(i != c for i, c in want.items()) == 50


def test_cut_buckets_name_themselves_unless_the_anchor_reaches_all():
    p = NearParameters()
    like, other = np.zeros(p.size, np.uint8), np.ones(p.size, np.uint8)
    close = like.copy()
    close[:p.size // 5] = 7
    part = lambda key, cut, sketches: [(key, 0, 10 * key + k, cut, s.tobytes()) for k, s in enumerate(sketches)]
    rows = [*part(1, True, [like, close, like]), *part(2, True, [like, other, close, other]), *part(3, False, [like, other, other]),
            *part(4, True, [like, other])]
    batch = pa.RecordBatch.from_pylist([dict(zip(("key", "part", "rep", "cut", "sketch"), r)) for r in rows])
    run = lambda last: [r for b in _bucket_edges(p, last)([batch]) for r in b.to_pylist()]
    edges = lambda found: sorted((r["a"], r["b"]) for r in found if r["key"] is None)
    checked = [(11, 10), (12, 10), (22, 20), (23, 21), (32, 31)]
    assert edges(run(False)) == checked
    assert sorted(r["key"] for r in run(False) if r["key"] is not None) == [2, 4]
    assert edges(run(True)) == sorted([*checked, (21, 20), (41, 40)])
    assert all(r["key"] is None for r in run(True))


def test_edge_rows(spark):
    got = near_groups(docs_of(spark, EDGES)).collect()
    assert len(got) == len(EDGES)
    by = {r["doc_id"]: r for r in got}
    for i in (1, 2, 3):
        assert by[i]["n_shingles"] == 0 and by[i]["component_id"] == i and by[i]["kept"]
    assert by[4]["component_id"] == by[5]["component_id"] == 4 and by[6]["component_id"] == 6
    assert by[8]["component_id"] == 7 and not by[8]["kept"]
    assert sum(r["doc_id"] == 7 and r["kept"] for r in got) == 2
    assert all(r["component_id"] is None and not r["kept"] for r in got if r["doc_id"] is None)
    assert by[9]["n_shingles"] == 1


def test_empty_table(spark):
    assert near_groups(docs_of(spark, [])).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 200), (41, 300), (300, 5)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys([*range(41), 41, 300], 0), **dict.fromkeys(range(100, 130), 100), 200: 200}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
