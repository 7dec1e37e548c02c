from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import functions as F

from sparkwh.llm import language, toxicity
from sparkwh.llm.toxicity import fit_pairs

from .helpers import EDGES, SF, docs_of, fold, table


def test_codewords_differ():
    for n in (2, 3, 4, 6, 12):
        code = language.codewords(n)
        assert len(code) == n and min((a != b).sum() for a, b in itertools.combinations(code, 2)) >= max(1, n // 2)


def test_language_on_held_out_documents(spark):
    docs = table(spark, "documents", SF)
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = language.identify(docs).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == (fold(r["doc_id"]) == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_language_ignores_labels_and_held_out_rows(spark):
    docs = table(spark, "documents")
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "zz").otherwise(F.col("lang")))
    key = lambda df: sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(df).collect())
    assert key(docs) == key(other)


def test_language_edges(spark):
    model = language.fit(table(spark, "documents"))
    got = language.predict(docs_of(spark, [*EDGES, (30, "12 34 !?"), (31, "́")]), model).collect()
    assert len(got) == len(EDGES) + 2
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3, 30, 31))
    assert by[10]["lang_pred"] in model.languages
    assert language.identify(docs_of(spark, [])).count() == 0
    assert {r["lang_pred"] for r in language.identify(docs_of(spark, [(1, "abc"), (2, "x")])).collect()} == {"und"}
    one = language.identify(docs_of(spark, [(i, "abc def", "en") for i in range(8)] + [(9, "7")])).collect()
    assert {r["lang_pred"] for r in one} == {"en", "und"}


def test_language_stage_keeps_rows_whole(spark):
    docs = docs_of(spark, [(1, "Der und die", "de"), (2, None, "de"), (3, "44", "de")])
    kept = language.keep_identified(docs, language.fit(table(spark, "documents")))
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [1]


def test_pairs_learn_what_single_terms_cannot():
    """Toxic exactly if both or neither of two terms occur: no additive weights tell that."""
    rng = np.random.default_rng(0)
    a, b = rng.random(800) < 0.5, rng.random(800) < 0.6
    y = (a == b).astype(float)
    noise = rng.integers(10, 30, (800, 2))
    row = np.concatenate([np.flatnonzero(a), np.flatnonzero(b), np.repeat(np.arange(800), 2)])
    bucket = np.concatenate([np.full(a.sum(), 1), np.full(b.sum(), 2), noise.ravel()])
    model = fit_pairs(row, bucket, y, np.ones(800), buckets=32)
    assert model.kept[[1, 2]].all()
    assert ((model.score(row, bucket, 800) > 0.5) == y).mean() > 0.95


def test_score_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(4)
    model = toxicity.PairModel(-0.3, rng.normal(0, 1, 16), rng.normal(0, 1, (16, 3)), np.arange(16) % 5 > 0)
    sets = [sorted(rng.choice(16, rng.integers(0, 9), replace=False)) for _ in range(50)]
    row = np.repeat(np.arange(50), [len(s) for s in sets])
    got = model.score(row, np.array([t for s in sets for t in s], int), 50)
    for s, value in zip(sets, got):
        used = [t for t in s if model.kept[t]]
        logit = model.bias + sum(model.weight[t] for t in used) + sum(
            model.vectors[a] @ model.vectors[b] for a, b in itertools.combinations(used, 2))
        assert abs(value - 1 / (1 + np.exp(-logit))) < 1e-9


def test_few_labels_and_terms_without_evidence(spark):
    """Six rows without a common term, terms spread evenly over both classes, one class alone, and no terms at all."""
    def scores(texts, toxic):
        docs = docs_of(spark, list(enumerate(texts)))
        labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
        return [r["score"] for r in toxicity.toxicity(docs, labels).collect()]
    for texts, toxic in ((["a", "b", "c", "d", "e", "f"], [0, 1, 0, 1, 0, 1]), (["same words"] * 40, [0, 1] * 20), (["x"] * 9, [1] * 9),
                         (["", None, "1 2"] * 4, [0, 1, 0] * 4)):
        got = scores(texts, toxic)
        assert len(got) == len(texts) and all(0 <= s <= 1 for s in got)


def test_toxicity_on_held_out_documents(spark):
    docs, labels = table(spark, "documents", SF), table(spark, "labels", SF)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [(r["score"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    positive, negative = ([s for s, t in held if t == k] for k in (1, 0))
    auc = np.mean([[(p > n) + 0.5 * (p == n) for n in negative] for p in positive])
    assert auc > 0.9


def test_toxicity_edges(spark):
    labels = table(spark, "labels", SF)
    model = toxicity.fit(table(spark, "documents", SF), labels)
    got = toxicity.score(docs_of(spark, EDGES), model).collect()
    assert len(got) == len(EDGES) and len({r["score"] for r in got if r["doc_id"] in (1, 2, 3)}) == 1
    assert toxicity.score(docs_of(spark, []), model).count() == 0
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert {r["predicted"] for r in toxicity.toxicity(docs_of(spark, EDGES), none).collect()} == {0}
    twice = labels.unionByName(labels)
    assert toxicity.toxicity(table(spark, "documents"), twice).count() == 200


def test_decoding_is_the_codeword_of_least_weighted_loss():
    rng = np.random.default_rng(6)
    code = language.codewords(9)
    bits = code.shape[1]
    model = language.CodeModel([f"l{k}" for k in range(9)], code, rng.normal(0, 1, (32, bits)), rng.normal(0, 1, bits),
                               rng.random(bits), 32, 0.7)
    x = rng.normal(0, 1, (40, 32))
    best, score, close = model.decode(x)
    for row, k, s, near in zip(x, best, score, close):
        f = [sum(a * w for a, w in zip(row, model.weights[:, b])) + model.bias[b] for b in range(bits)]
        loss = [sum(t * np.log1p(np.exp(-v * c)) for t, v, c in zip(model.trust, f, word)) for word in code]
        order = sorted(range(9), key=loss.__getitem__)
        assert order[0] == k and near == (loss[order[1]] - loss[order[0]] < model.margin)
        assert abs(s - 1 / sum(np.exp(loss[k] - v) for v in loss)) < 1e-6


def test_stage_keeps_wanted_languages_by_their_prediction(spark):
    model = language.fit(table(spark, "documents", SF))
    docs = table(spark, "documents")
    predicted = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()}
    some = frozenset(model.languages[:2])
    kept = {r["doc_id"] for r in language.keep_identified(docs, model, some, 0.5).collect()}
    assert kept == {i for i, (name, score) in predicted.items() if name in some and score >= 0.5}
    assert 0 < len(kept) < len(predicted)
    nothing = language.fit(docs.limit(0))
    rows = docs_of(spark, [(1, "abc"), (2, "12"), (3, None), (4, "é")])
    assert {r["doc_id"] for r in language.keep_identified(rows, nothing).collect()} == {1, 4}
