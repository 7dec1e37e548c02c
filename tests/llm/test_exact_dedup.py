from __future__ import annotations

import hashlib
import random

import duckdb
import pytest

from sparkwh.llm.exact_dedup import PatriciaTrie, exact_groups, keep_one
from sparkwh.llm.queries import ORACLE, REGISTRY

from .helpers import EDGES, SF_SMALL, docs_of


@pytest.mark.parametrize("limit", [1 << 40, 5_000, 300])
def test_trie_with_spilled_subtrees(limit):
    rng = random.Random(limit)
    keys = [bytes(rng.choice(b"abc") for _ in range(rng.choice((0, 1, 3, 8, 40)))) for _ in range(3_000)]
    keys += [b"common start " * 50 + k for k in keys[:500]]
    trie, want = PatriciaTrie(lambda a, b: a + b, limit), {}
    for k in keys:
        trie.insert(k, 1)
        want[k] = want.get(k, 0) + 1
    found = list(trie.items())
    assert len(found) == len(want) and dict(found) == want


def test_query_agrees_with_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = con.execute(ORACLE["op2_exact_dedup"]).to_arrow_table()
    got = REGISTRY["op2_exact_dedup"](spark, SF_SMALL).select(*want.column_names).collect()
    assert sorted(tuple(r) for r in got) == sorted(zip(*(c.to_pylist() for c in want.columns)))


@pytest.mark.parametrize("limits", [(1 << 25, 1 << 27), (600, 400)])
def test_edge_rows(spark, limits):
    rows = [*EDGES, (20, "ab c"), (21, "a  b  c"), (22, "abc"), (19, "a b  c ")] + [(100 + i, "same text") for i in range(50)]
    got = exact_groups(docs_of(spark, rows).repartition(5), *limits).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert {by[i]["keep_id"] for i in (1, 2, 3)} == {3} and by[1]["group_size"] == 4
    assert {by[i]["keep_id"] for i in (19, 20, 21, 22)} == {19}  # two of seven code points: the smaller id
    assert by[130]["keep_id"] == 100 and by[130]["group_size"] == 50
    repeated = [r for r in got if r["doc_id"] == 7]
    assert sorted(r["kept"] for r in repeated) == [False, True] and repeated[0]["group_size"] == 3
    assert all(r["keep_id"] == 7 and not r["kept"] for r in got if r["doc_id"] is None and r["group_size"] == 3)
    assert by[4]["keep_id"] == 4 and by[5]["keep_id"] == 5  # case counts
    assert by[2]["text_sha256"] == hashlib.sha256(b"").hexdigest()


def test_empty_table(spark):
    assert exact_groups(docs_of(spark, [])).count() == 0


def test_keep_one_row_of_every_text(spark):
    rows = [(1, "a b"), (1, "a b"), (2, "ab"), (3, "a  b"), (4, "other"), (5, None), (5, None), (6, "x"), (6, "y"), (None, "z")]
    docs = docs_of(spark, rows)
    kept = keep_one(docs, exact_groups(docs))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == [(3, "a  b"), (4, "other"), (5, ""), (6, "x"), (6, "y")]


def test_a_group_won_by_a_row_without_id_keeps_its_best_named_row(spark):
    rows = [(None, "a  b"), (5, "a b"), (4, "a b"), (3, "ab"), (None, None), (6, ""), (None, "c d"), (None, "c d"), (8, "cd"), (8, "cd"), (9, "x")]
    docs = docs_of(spark, rows)
    kept = keep_one(docs, exact_groups(docs))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(4, "a b"), (6, ""), (8, "cd"), (9, "x")]
