from __future__ import annotations

import re
import subprocess
import sys
from pathlib import Path

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from sparkwh.llm.filters import without
from sparkwh.llm.queries import REGISTRY, vocabulary_path
from sparkwh.session import stage

from .helpers import EDGES, SF_SMALL, brute_components, docs_of, table
from .test_decontamination import brute as brute_leaks
from .test_tokens import check_packing

ROOT = Path(__file__).resolve().parents[2]


def brute_documents(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    """What every stage up to packing keeps, by comparing all rows."""
    docs = [(i, t) for i, t in docs if t and re.search(r"[^\W\d_]", t)]
    groups = {}
    for i, t in docs:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i, t))
    docs = sorted((i, t) for _, i, t in map(min, groups.values()))
    component = brute_components(docs, 5)
    docs = [(i, t) for i, t in docs if component[i] == i]
    leaks = {i for i, _ in brute_leaks(docs, items)}
    return [(i, t) for i, t in docs if i not in leaks]


def test_stages_match_brute_force(spark):
    docs = table(spark, "documents")
    want = brute_documents([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in table(spark, "benchmark").collect()])
    kept = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = stage(step(spark, kept, SF_SMALL), name)
        assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == want
    pieces = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {p["doc_id"] for p in pieces} == {i for i, _ in want}
    check_packing(want, pieces, Tokenizer.from_file(vocabulary_path()), (2048, 1024, 512, 256))


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_every_stage_takes_edge_rows_and_empty_tables(spark, k):
    name, step = corpus_pipeline.STAGES[k]
    rows = [r for r in EDGES if r[0] is not None] + [(None, "n")] * (k == 0)
    got = step(spark, docs_of(spark, rows), SF_SMALL).collect()
    ids = {r["doc_id"] for r in got}
    assert ids <= {r[0] for r in rows}
    want = {"language_id": {4, 5, 6, 7, 8, 9, 10, 11, None}, "exact_dedup": {3, 4, 5, 6, 7, 8, 9, 10, 11}, "near_dedup": {1, 2, 3, 4, 6, 7, 9, 10, 11}}.get(name)
    assert ids == (want or {r[0] for r in rows})
    if name == "exact_dedup":
        assert sum(r["doc_id"] == 7 for r in got) == 1
    assert step(spark, docs_of(spark, []), SF_SMALL).count() == 0
    nameless = step(spark, docs_of(spark, [*rows, (None, "only here"), (None, None)]), SF_SMALL)
    assert ids <= {r["doc_id"] for r in nameless.collect()}


def test_columns_of_any_name_pass_through(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 7), (2, "ab", "y", 8), (3, "c", "z", 9)],
                                 "doc_id long, text string, __text_sha256 string, __n_points long")
    got = corpus_pipeline.drop_copies(spark, docs, SF_SMALL)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a b", "x", 7), (3, "c", "z", 9)]


def test_without_keeps_rows_that_only_the_filter_may_hold(spark):
    docs = docs_of(spark, [(i, "t") for i in range(500)] + [(1 << 26, "same bit as 0"), (None, "n")])
    dropped = spark.createDataFrame([(0,), (7,), (7,)], "doc_id long")
    got = {r["doc_id"] for r in without(docs, dropped).collect()}
    assert got == {None, 1 << 26, *range(1, 500)} - {7}


def test_registration():
    names = contract.queries()
    assert all(any(re.match(rf"op{n}_", q) for q in REGISTRY) for n in range(1, 14)) and set(REGISTRY) <= set(names) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]


def test_the_rest_stands_without_this_package(tmp_path):
    (tmp_path / "__spark_entry__.py").symlink_to(ROOT / "__spark_entry__.py")
    (tmp_path / "sparkwh").mkdir()
    for child in (ROOT / "sparkwh").iterdir():
        if child.name not in ("llm", "__pycache__"):
            (tmp_path / "sparkwh" / child.name).symlink_to(child)
    code = (f"import sys; sys.path.insert(0, {str(tmp_path)!r}); import importlib.util as u\n"
            f"s = u.spec_from_file_location('__spark_entry__', {str(tmp_path / '__spark_entry__.py')!r}); m = u.module_from_spec(s)\n"
            "s.loader.exec_module(m); assert m.training is None and m.queries() and not any(q.startswith('op') or q == 'pipeline' for q in m.queries())")
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.returncode == 0, done.stderr
