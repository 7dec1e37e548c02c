"""Language identification by error-correcting output codes.

Every language has a codeword; one linear classifier per bit predicts that bit from the hashed byte n-grams of the whole
text. Decoding adds up the logistic losses of all bits, each weighted by how reliable its classifier is, and takes the
codeword of least loss. Close calls are flagged.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .batches import crc_fold, slices, text_bytes, tidy

BUCKETS = 4096
SAMPLE_ROWS = 2_400
HELD_OUT = 2
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")
# ASCII letters in lower case, all bytes of longer characters as they are, everything else a space.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[65:91] = _FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def gram_counts(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Hashed counts of byte pairs and triples per row, square-rooted and scaled to unit length."""
    n = len(offsets) - 1
    out = np.zeros((n, buckets), np.float32)
    if len(data) > 2:
        c = _FOLD[data].astype(np.uint32)
        row = np.repeat(np.arange(n), np.diff(offsets))
        bits = np.uint32(32 - int(np.log2(buckets)))
        flat = np.zeros(n * buckets, np.int64)
        for size in (2, 3):
            code = c[:len(c) - size + 1].copy()
            for k in range(1, size):
                code |= c[k:len(c) - size + 1 + k] << np.uint32(8 * k)
            whole = row[:len(code)] == row[size - 1:]
            at = (((code[whole] + np.uint32(size << 24)) * np.uint32(0x9E3779B1)) >> bits).astype(np.int64)
            flat += np.bincount(row[:len(code)][whole] * buckets + at, minlength=n * buckets)
        out = np.sqrt(flat.reshape(n, buckets), dtype=np.float32)
        norm = np.sqrt((out * out).sum(1, keepdims=True))
        out /= np.maximum(norm, 1e-9)
    return out


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """One row of +1/-1 per language: every split into two groups up to six languages, else the random code of some
    hundred draws whose closest two codewords differ most."""
    if n < 2:
        return np.zeros((n, 0), np.float32)
    if n <= 6:
        splits = [s for s in itertools.product((1, -1), repeat=n) if s[0] == 1 and -1 in s]
        return np.array(splits, np.float32).T
    rng, length, best = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n))), None
    for _ in range(200 if n < 200 else 20):
        code = rng.choice([-1.0, 1.0], (n, length)).astype(np.float32)
        code = code[:, np.abs(code.sum(0)) < n]
        agree = code @ code.T  # of two codewords of this length: places in common less places apart
        np.fill_diagonal(agree, -code.shape[1])
        apart = (code.shape[1] - int(agree.max())) // 2
        if best is None or apart > best[0]:
            best = apart, code
    return best[1]


@dataclass
class CodeModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray
    buckets: int
    margin: float

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, score from 0 to 1, and whether the call is close."""
        n = len(x)
        if len(self.languages) == 1:
            return np.zeros(n, int), np.ones(n), np.zeros(n, bool)
        f = x @ self.weights + self.bias
        loss = np.stack([(np.logaddexp(0, -f * word) * self.trust).sum(1) for word in self.code], 1)
        order = np.argsort(loss, axis=1, kind="stable")
        first, second = (np.take_along_axis(loss, order[:, k:k + 1], 1)[:, 0] for k in (0, 1))
        score = 1 / np.exp(first[:, None] - loss).sum(1)
        return order[:, 0], score, second - first < self.margin


def fit_bits(x: np.ndarray, labels: np.ndarray, n: int, steps: int = 150, rate: float = 8.0, ridge: float = 1e-4):
    """All bit classifiers at once: logistic regression by accelerated gradient descent, rows weighted by class."""
    code = codewords(n)
    share = np.bincount(labels, minlength=n)
    weight = (1 / share[labels])[:, None].astype(np.float32)
    weight /= weight.sum()
    y = code[labels]
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    at_w, at_b = w.copy(), b.copy()
    for k in range(steps):
        g = -y / (1 + np.exp(np.clip(y * (x @ at_w + at_b), -30, 30))) * weight
        new_w, new_b = at_w - rate * (x.T @ g + ridge * at_w), at_b - rate * 0.1 * g.sum(0)
        pull = k / (k + 3)
        at_w, at_b, w, b = new_w + pull * (new_w - w), new_b + pull * (new_b - b), new_w, new_b
    right = (np.sign(x @ w + b) == y).astype(np.float32)
    trust = np.clip((right * weight).sum(0) * 2 - 1, 0.05, 1)
    return code, w, b, trust


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS, margin: float = 0.7) -> CodeModel:
    """Learn from ``text`` and non-NULL ``lang`` of rows that are not held out.

    At most ``sample_rows`` rows, as evenly as possible over the languages, chosen by a hash of ``doc_id``; only their
    hashed counts reach the driver. Nothing to learn from gives a model without languages.
    """
    usable = docs.where(F.col("lang").isNotNull() & (crc_fold("doc_id") != HELD_OUT) & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
              .limit(sample_rows).collect()}
    if not counts:
        return CodeModel([], np.zeros((0, 0)), np.zeros((buckets, 0)), np.zeros(0), np.zeros(0), buckets, margin)
    each = max(1, sample_rows // len(counts))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language")), F.lit(1 << 30))
    bound = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, int(min(1.0, 1.3 * each / n + 20 / n) * (1 << 30)))])

    def features(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for i, j in slices(offsets):
                x = gram_counts(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], buckets)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                    pa.array([r.astype(np.float16).tobytes() for r in x], pa.binary())], names=["lang", "draw", "x"])

    drawn = usable.select("lang", draw.alias("draw"), F.col("text").cast("string").alias("text")).where(F.col("draw") < bound[F.col("lang")])
    rows = drawn.mapInArrow(tidy(features), "lang string, draw long, x binary").collect()
    languages, x, labels, taken = sorted(counts), [], [], dict.fromkeys(counts, 0)
    for r in sorted(rows, key=lambda r: (r["draw"], r["x"])):
        if taken[r["lang"]] < each:
            taken[r["lang"]] += 1
            x.append(np.frombuffer(r["x"], np.float16).astype(np.float32))
            labels.append(languages.index(r["lang"]))
    if len(languages) == 1:
        return CodeModel(languages, np.zeros((1, 0)), np.zeros((buckets, 0)), np.zeros(0), np.zeros(0), buckets, margin)
    code, w, b, trust = fit_bits(np.stack(x), np.array(labels), len(languages))
    return CodeModel(languages, code, w, b, trust, buckets, margin)


def _decoded(model: CodeModel, column: pa.Array, unknown: str = UNDETERMINED) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and closeness of every text of a column; without a learned language, ``unknown`` for texts with letters."""
    data, offsets = text_bytes(column)
    names, scores, close = [], [np.zeros(0)], [np.zeros(0, bool)]
    for i, j in slices(offsets, 1 << 19):
        for a in range(i, j, 512):
            b = min(j, a + 512)
            part, at = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
            lettered = np.array([bool(_LETTER.search(part[x:y].tobytes().decode())) for x, y in zip(at, at[1:])], bool)
            if lettered.any() and model.languages:
                best, score, near = model.decode(gram_counts(part, at, model.buckets))
            else:
                best, score, near = np.zeros(b - a, int), np.zeros(b - a), np.zeros(b - a, bool)
            known = model.languages or [unknown]
            names += [known[k] if has else UNDETERMINED for k, has in zip(best, lettered)]
            scores.append(np.where(lettered, score, 0.0))
            close.append(near & lettered)
    return names, np.clip(np.concatenate(scores), 0, 1), np.concatenate(close)


def predict(docs: DataFrame, model: CodeModel) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` per row of ``docs``.

    A text that is NULL or has no letter, and any text if no language could be learned, is ``und`` with score 0. A NULL
    ``doc_id`` is not held out. Repeated rows get equal rows; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            names, scores, close = _decoded(shared.value, batch.column(2))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores.astype(float)), pa.array(close)],
                names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(crc_fold("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"),
                       F.col("text").cast("string"))
    return rows.mapInArrow(tidy(run), "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def keep_identified(docs: DataFrame, model: CodeModel, wanted: frozenset[str] | None = None,
                    least_score: float = 0.0) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose predicted language is ``wanted`` (None: any that was learned) with
    at least ``least_score``. Texts without a letter and NULL are ``und`` and go, also if no language could be learned; other
    texts stay then, as nothing is known about them. Repeated rows are judged alike; an empty table stays empty."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches):
        for batch in batches:
            names, scores, _ = _decoded(shared.value, batch.column(at), "")
            yield batch.filter(pa.array([n == "" or n != UNDETERMINED and s >= least_score and (wanted is None or n in wanted)
                                         for n, s in zip(names, scores)], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``predict`` with a model learned from ``docs`` themselves; see ``fit`` and ``predict`` for NULLs and empty tables."""
    return predict(docs, fit(docs, sample_rows))
