"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text and their beginnings. The model adds a weight per term and, for every pair of terms, the
product of two short vectors, so a pair such as an insult and a group can weigh what neither weighs alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .batches import _FOLDED, crc_fold, fingerprints, slices, text_bytes, tidy, word_places

BUCKETS = 1 << 16
SAMPLE_ROWS = 12_000
SAMPLE_BYTES = 64 << 20
FACTORS = 4
PREFIXES = (4, 5, 6, 7, 8)  # bytes
LEAST_ROWS = 4
LEAST_EVIDENCE = 3.0
JOINT_EVIDENCE = 5.0
FIRST_VECTORS = 0.05
HELD_OUT = 2
THRESHOLD = 0.3

_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True


def terms(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every distinct term: whole words and word beginnings, in lower case where ASCII."""
    rows = len(offsets) - 1
    starts, sizes, row = word_places(data, offsets, _LETTERS)
    folded = _FOLDED[data]
    seen = np.zeros(rows * buckets, bool)
    shift = np.uint64(64 - int(np.log2(buckets)))

    def mark(at: np.ndarray, size: np.ndarray, kind: int) -> None:
        seen[row[at] * buckets + (fingerprints(folded, starts[at], size, kind) >> shift).astype(np.int64)] = True

    mark(np.arange(len(starts)), sizes, 0)
    for size in PREFIXES:
        longer = np.flatnonzero(sizes > size)
        mark(longer, np.full(len(longer), size), size)
    found = np.flatnonzero(seen)
    return found // buckets, found % buckets


@dataclass
class PairModel:
    bias: float
    weight: np.ndarray
    vectors: np.ndarray
    kept: np.ndarray

    def score(self, row: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        use = self.kept[bucket]
        row, bucket = row[use], bucket[use]
        logit = self.bias + np.bincount(row, self.weight[bucket], n).astype(float)
        for f in range(self.vectors.shape[1]):
            v = self.vectors[bucket, f]
            logit += 0.5 * (np.bincount(row, v, n) ** 2 - np.bincount(row, v * v, n))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def alone_evidence(row: np.ndarray, bucket: np.ndarray, y: np.ndarray, buckets: int) -> np.ndarray:
    """Standard errors by which each term's share among the positive rows differs from that among the others."""
    n, positive = len(y), max(1, int(y.sum()))
    p1, p0 = np.bincount(bucket, y[row], buckets) / positive, np.bincount(bucket, 1 - y[row], buckets) / max(1, n - positive)
    p = np.bincount(bucket, minlength=buckets) / max(1, n)
    return np.abs(p1 - p0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / positive + 1 / max(1, n - positive)))


def joint_evidence(row: np.ndarray, bucket: np.ndarray, rest: np.ndarray, buckets: int, rng: np.random.Generator,
                   looks: int = 16) -> np.ndarray:
    """How far each term tells, together with any others, what a model leaves unexplained (``rest`` per row).

    A look adds up random signs of a row's terms. Among the rows of a term that no other term works together with, the sum
    has nothing to do with the rest; the squares of ``looks`` standard scores then add up to ``looks``, give or take their
    standard error. Returned is the excess in such errors."""
    rest, size, excess = rest - rest.mean(), np.maximum(np.bincount(bucket, minlength=buckets), 1), np.zeros(buckets)
    for _ in range(looks):
        look = np.bincount(row, rng.choice([-1.0, 1.0], buckets)[bucket], len(rest)).astype(float)[row]
        look -= (np.bincount(bucket, look, buckets) / size)[bucket]
        spread = np.bincount(bucket, look * look, buckets) * (rest ** 2).mean()
        excess += np.bincount(bucket, look * rest[row], buckets) ** 2 / np.maximum(spread, 1e-12)
    return (excess - looks) / np.sqrt(2 * looks)


def fit_pairs(row: np.ndarray, bucket: np.ndarray, y: np.ndarray, importance: np.ndarray, buckets: int = BUCKETS,
              factors: int = FACTORS, seed: int = 3) -> PairModel:
    """Terms of ``LEAST_ROWS`` rows or more take part if they tell the classes apart, alone or together with others.

    A first machine has the terms whose share among the positive rows differs by ``LEAST_EVIDENCE`` standard errors. Terms
    without that evidence join, for a second one, if what the first leaves unexplained goes with them and other terms
    jointly: those that matter in pairs only. Any set of rows gives a model; without such terms it is the bias alone."""
    common = np.bincount(bucket, minlength=buckets) >= LEAST_ROWS
    kept = common & (alone_evidence(row, bucket, y, buckets) >= LEAST_EVIDENCE)
    model = _descended(row, bucket, y, importance, kept, factors, seed)
    joint = joint_evidence(row, bucket, (y - model.score(row, bucket, len(y))) * importance / importance.mean(), buckets,
                           np.random.default_rng(seed))
    more = common & ~kept & (joint >= JOINT_EVIDENCE)
    return _descended(row, bucket, y, importance, kept | more, factors, seed) if more.any() else model


def _descended(row: np.ndarray, bucket: np.ndarray, y: np.ndarray, importance: np.ndarray, kept: np.ndarray, factors: int,
               seed: int, passes: int = 120, rate: float = 0.1, ridge: float = 2e-4) -> PairModel:
    """Weighted logistic loss by full-batch Adam over the terms ``kept``."""
    n, buckets, use = len(y), len(kept), kept[bucket]
    row, bucket = row[use], bucket[use]
    ids, local = np.unique(bucket, return_inverse=True)
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(ids)), rng.normal(0, FIRST_VECTORS, (len(ids), factors))
    share = float(np.clip((importance * y).sum() / importance.sum(), 1e-4, 1 - 1e-4))
    b, importance = np.log(share / (1 - share)), importance / importance.sum()
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (np.zeros(1), w, v)]

    def added(of: np.ndarray, values: np.ndarray, length: int) -> np.ndarray:  # as float, also of nothing
        return np.bincount(of, values, length).astype(float)

    for k in range(1, passes + 1):
        sums = np.stack([added(row, v[local, f], n) for f in range(factors)], 1)
        squares = sum(added(row, v[local, f] ** 2, n) for f in range(factors))
        logit = b + added(row, w[local], n) + 0.5 * ((sums ** 2).sum(1) - squares)
        g = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * importance
        at = g[row]
        slope = added(local, at, len(ids))
        gw = slope + ridge * w
        gv = np.stack([added(local, at * sums[row, f], len(ids)) for f in range(factors)], 1) + (ridge - slope)[:, None] * v
        for (m, s), grad, target in zip(state, (np.array([g.sum()]), gw, gv), ("b", "w", "v")):
            m += 0.1 * (grad - m)
            s += 0.01 * (grad * grad - s)
            step = rate * (m / (1 - 0.9 ** k)) / (np.sqrt(s / (1 - 0.99 ** k)) + 1e-8)
            if target == "b":
                b -= float(step[0])
            elif target == "w":
                w -= step
            else:
                v -= 0.3 * step
    weight, vectors = np.zeros(buckets), np.zeros((buckets, factors))
    weight[ids], vectors[ids] = w, v
    return PairModel(float(b), weight, vectors, kept)


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(pc.utf8_lower(column))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> PairModel:
    """Learn from labelled rows that are not held out: about ``sample_rows`` at most, a third of them toxic if there are so
    many, chosen by a hash of ``doc_id``; the loss is weighted back to the shares among all labelled rows. If the terms
    of these rows take more than ``SAMPLE_BYTES``, fewer rows of either class are taken."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc_fold("doc_id") != HELD_OUT))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    take = {1: sample_rows // 3, 0: sample_rows - sample_rows // 3}
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("toxicity")), F.lit(1 << 30))
    share = {k: min(1.0, take[k] / max(1, counts.get(k, 0))) for k in take}
    bound = F.when(F.col("toxic") == 1, int(share[1] * (1 << 30))).otherwise(int(share[0] * (1 << 30)))
    chosen = known.where(draw < bound)

    def features(batches):
        for batch in batches:
            data, offsets = _lowered(batch.column(2))
            toxic = batch.column(1)
            for i, j in slices(offsets, 1 << 19):
                row, bucket = terms(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                cuts = np.searchsorted(row, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), toxic.slice(i, j - i),
                    pa.array([bucket[a:b].astype("<u2").tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())],
                    names=["doc_id", "toxic", "terms"])

    drawn = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), "doc_id")
    found = stage(drawn.select("doc_id", "toxic", "text").mapInArrow(tidy(features), "doc_id long, toxic int, terms binary"), "terms")
    size = found.agg(F.sum(F.octet_length("terms"))).first()[0] or 0
    again = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("toxicity again")), F.lit(1 << 30))
    rows = found.where(again < int(min(1.0, SAMPLE_BYTES / max(size, 1)) * (1 << 30))).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["terms"]))
    y = np.array([min(1, max(0, r["toxic"])) for r in rows], float)
    sets = [np.frombuffer(r["terms"], "<u2").astype(np.int64) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(s) for s in sets])
    bucket = np.concatenate([np.zeros(0, np.int64), *sets])
    importance = np.where(y == 1, 1 / max(share[1], 1e-9), 1 / max(share[0], 1e-9))
    if not len(rows) or y.min() == y.max():
        level = 0.0 if not len(rows) else y[0]
        return PairModel(30.0 if level else -30.0, np.zeros(BUCKETS), np.zeros((BUCKETS, FACTORS)), np.zeros(BUCKETS, bool))
    return fit_pairs(row, bucket, y, importance)


def score(docs: DataFrame, model: PairModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    A NULL or empty text has no terms and gets the score of the bias alone. A NULL ``doc_id`` is not held out. Repeated
    rows get equal rows; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            data, offsets = _lowered(batch.column(2))
            scores = [np.zeros(0)]
            for i, j in slices(offsets, 1 << 19):
                for a in range(i, j, 256):
                    b = min(j, a + 256)
                    row, bucket = terms(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                    scores.append(shared.value.score(row, bucket, b - a))
            scores = np.concatenate(scores)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(crc_fold("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"),
                       F.col("text").cast("string"))
    return rows.mapInArrow(tidy(run), "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``score`` with a model learned from the labels; see ``fit`` and ``score`` for NULLs, repeats and empty tables. Without
    labels, or with one class only, all scores are alike."""
    return score(docs, fit(docs, labels, sample_rows))
