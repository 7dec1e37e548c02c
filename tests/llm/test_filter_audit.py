from __future__ import annotations

import random
import re
from itertools import permutations

import numpy as np
from pyspark.sql import types as T

from check import compare, duck
from sparkwh.llm import filter_audit as fa
from tests.llm.helpers import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
                     *(T.StructField(c, T.StringType()) for c in ("part", "failed", "digest", "n", "first", "good", "toxic", "quality"))])
LABELS = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "quality", "toxic", "n", "part")])


def brute(docs, labels):
    fails, first = [], {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    for i, text, source in docs:
        text = text or ""
        words = WORD.findall(text)
        out = "A" if len(words) < 200 else ""
        out += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        out += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text) else ""
        out += "D" if re.search("[#$%&*|]", text) else ""
        out += "E" if i is not None and first[text] < i else ""
        good = any(x[0] == i and x[1] == 1 for x in labels) and i is not None
        toxic = any(x[0] == i and x[2] == 1 for x in labels) and i is not None
        fails.append((source or "", set(out), good, toxic))
    rows, total = {}, {}
    for part in {f[0] for f in fails}:
        mine = [f for f in fails if f[0] == part]
        for order in permutations("ABCDE"):
            for step, f in enumerate(order):
                before = set(order[:step])
                gone = [x for x in mine if f in x[1] and not x[1] & before]
                rows[part, "".join(order), step + 1] = [
                    sum(not x[1] & (before | {f}) for x in mine), len(gone), sum(f in x[1] for x in mine) - len(gone),
                    sum(x[1] == {f} for x in mine), sum(x[2] for x in gone), sum(x[3] for x in gone)]
                total[part, f] = total.get((part, f), 0) + len(gone)
    return sorted((*k, *v, total[k[0], k[1][k[2] - 1]]) for k, v in rows.items())


def audited(spark, docs, labels):
    frame = spark.createDataFrame([(*d, *"xxxxxxxx") for d in docs], DOCS)
    held = spark.createDataFrame([(*x, 1, 1) for x in labels], LABELS)
    return sorted(tuple(r) for r in fa.filter_audit(frame, held).collect())


def test_query_agrees_with_sql(spark):
    good, note = compare(spark, duck(SF), "op13_filter_audit", SF)
    assert good and "TYPES" not in note, note


def test_random_tables_agree_with_brute_force(spark):
    rng = random.Random(2)
    kinds = ["w ", "W ", "$ ", "%s ", "\t", "\v", "é", "A"]
    texts = ["".join((f"w{rng.randrange(400)} " if rng.random() < 0.8 else rng.choice(kinds)) for _ in range(rng.choice([3, 150, 260])))
             for _ in range(40)]
    docs = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in range(150)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 200, 2)]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_nulls_ties_repeats_and_long_texts(spark):
    long = "x y " * 300_000
    docs = [(1, None, "s"), (2, "", "s"), (None, "", "s"), (None, None, None), (3, " ", "s"), (4, long, "t"), (5, long, "t"), (5, long, "t"),
            (5, long, "u"), (6, "w" * 3_000_000, "t"), (6, "other", "t"), (7, "W" * 50 + "w" * 2450, "s"), (8, "W" * 51 + "w" * 2449, "s"),
            (9, " ".join(f"a{i}" for i in range(100)) + " " + " ".join(f"a{i}" for i in range(100)), "s"), (10, "a\u00a0b\u0085c", "s")]
    labels = [(1, 1, 0), (1, 0, 1), (4, None, 1), (5, 1, 1), (None, 1, 1), (5, 1, 1), (99, 1, 1)]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_empty_tables(spark):
    assert audited(spark, [], []) == []
    assert len(audited(spark, [(1, "a", "s")], [])) == 600


def test_contraction_is_a_sum_over_patterns():
    tensor = np.arange(2 * 3 * 32).reshape(2, 3, 2, 2, 2, 2, 2)
    got = fa.contracted(tensor, [fa.PASS, fa.FAIL, fa.ALL, fa.ALL, fa.PASS])
    assert (got == tensor[:, :, 0, 1, :, :, 0].sum(axis=(2, 3))).all()
