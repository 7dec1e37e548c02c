"""How filters interact, for every order they can be applied in.

Each document fails some of the five filters: one of 32 patterns. Spark counts the documents per part and pattern (all, of
good quality, toxic); a part's counts are then a 2x2x2x2x2 tensor, with axis ``i`` telling whether filter ``i`` passes or
fails. What a step of an order keeps, removes or finds removed already is a contraction of that tensor: every axis takes the
vector that selects pass, fail or all. The 120 orders share 80 such contractions, done for many parts in one ``einsum``.

Filters A to D are judged by built-in functions on the whole text. Filter E compares whole texts by SHA-256: the smallest id
per digest is found by an aggregation, and met again by (digest, doc_id), so a text in a third of the rows is no hot key.

Defined results: NULL text is empty; a part is a source, NULL as the empty string. A row with NULL doc_id has no smaller id
and is none, so it passes E and fails no other row; rows that repeat a doc_id and text do not fail each other. A document
without labels is neither good nor toxic; of labels that repeat a doc_id any 1 counts. A table without rows has no parts.
Other columns do not matter. Parts with many documents are one row of at most 32 counts when they meet the tensor code.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .batches import tidy

FILTERS = "ABCDE"
MIN_WORDS = 200
_RESULT = ("part STRING, filter_order STRING, step INT, kept BIGINT, removed BIGINT, redundant BIGINT, unique_fails BIGINT, "
           "good_lost BIGINT, toxic_lost BIGINT, shapley BIGINT")
PASS, FAIL, ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
#: Parts that are worked out at once.
PART_ROWS = 64


def row_failures(text: Column) -> Column:
    """Which of the filters A to D a text fails, as bits 0 to 3."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    failed = [n < MIN_WORDS, distinct.cast("bigint") * 100 < n.cast("bigint") * 50,
              capitals.cast("bigint") * 100 > F.length(text).cast("bigint") * 2, text.rlike("[#$%&*|]")]
    bits = [F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(failed)]
    return (bits[0] + bits[1] + bits[2] + bits[3]).cast("int")


def patterns(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, pattern`` (bits of failed filters), ``n, good, toxic``: numbers of documents."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stage(documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        row_failures(text).alias("failed"), F.unhex(F.sha2(text, 256)).alias("digest")), "audited")
    # Rows alike in all that counts become one, so that no key below is hot by repeated rows.
    named = rows.where("doc_id is not null").groupBy("doc_id", "digest", "part", "failed").agg(F.count(F.lit(1)).alias("n"))
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = named.join(first, ["digest", "doc_id"], "left").withColumn(
        "pattern", F.col("failed") + F.when(F.col("first"), 0).otherwise(16))
    labelled = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    known = marked.join(labelled, "doc_id", "left").select("part", "pattern", "n", "good", "toxic")
    nameless = rows.where("doc_id is null").select(
        "part", F.col("failed").alias("pattern"), F.lit(1).cast("bigint").alias("n"), F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return known.unionByName(nameless).groupBy("part", "pattern").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")])


def contracted(tensor: np.ndarray, axes: list[np.ndarray]) -> np.ndarray:
    """``tensor`` (kinds, parts, 2, 2, 2, 2, 2) with every axis of the filters contracted with its vector: (kinds, parts)."""
    return np.einsum("kpabcde,a,b,c,d,e->kp", tensor, *axes, optimize=False)


def audit(tensor: np.ndarray) -> dict[str, np.ndarray]:
    """All orders and steps of some parts: arrays (parts, 600). ``tensor`` counts all, good and toxic documents."""
    def select(passing: str, failing: str) -> np.ndarray:
        return contracted(tensor, [PASS if f in passing else FAIL if f in failing else ALL for f in FILTERS])

    known: dict[tuple[str, str], np.ndarray] = {}

    def counts(passing: str, failing: str) -> np.ndarray:
        key = "".join(sorted(passing)), failing
        if key not in known:
            known[key] = select(*key)
        return known[key]

    orders = ["".join(o) for o in permutations(FILTERS)]
    removed = {f: sum(counts(o[:o.index(f)], f)[0] for o in orders) for f in FILTERS}
    columns: dict[str, list[np.ndarray]] = {c: [] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost",
                                                             "toxic_lost", "shapley")}
    for order in orders:
        for step, f in enumerate(order):
            gone = counts(order[:step], f)
            columns["kept"].append(counts(order[:step + 1], "")[0])
            columns["removed"].append(gone[0])
            columns["redundant"].append(counts("", f)[0] - gone[0])
            columns["unique_fails"].append(counts(FILTERS.replace(f, ""), f)[0])
            columns["good_lost"].append(gone[1])
            columns["toxic_lost"].append(gone[2])
            columns["shapley"].append(removed[f])
    return {"filter_order": orders, **{c: np.stack(v, axis=1) for c, v in columns.items()}}


def filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``: 600 rows per part.

    ``kept`` and ``removed`` after and by this step; ``redundant`` failed its filter but were removed earlier; ``unique_fails``
    fail its filter only; ``good_lost`` and ``toxic_lost`` are the removed ones with quality = 1 and toxic = 1; ``shapley`` is
    what its filter removes, summed over all orders. See the module's text for NULLs, ties and empty tables.
    """
    counts = F.struct("pattern", "n", "good", "toxic")
    parts = patterns(documents, labels).groupBy("part").agg(F.collect_list(counts).alias("cells"))  # 32 cells at most

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PART_ROWS):
                some = batch.slice(at, PART_ROWS)
                cells, tensor = some.column("cells"), np.zeros((3, some.num_rows, 32), np.int64)
                owner = np.repeat(np.arange(some.num_rows), cells.value_lengths().to_numpy(zero_copy_only=False))
                flat = cells.flatten()
                pattern = flat.field("pattern").to_numpy(zero_copy_only=False)
                # Filter A is the first axis, but the lowest bit of a pattern.
                place = sum((pattern >> k & 1) << (4 - k) for k in range(5))
                for kind, name in enumerate(("n", "good", "toxic")):
                    tensor[kind, owner, place] = flat.field(name).to_numpy(zero_copy_only=False)
                found = audit(tensor.reshape(3, -1, 2, 2, 2, 2, 2))
                orders, per_part = found.pop("filter_order"), 5 * 120
                yield pa.RecordBatch.from_pydict({
                    "part": some.column("part").take(pa.array(np.repeat(np.arange(some.num_rows), per_part))),
                    "filter_order": pa.array(np.tile(np.repeat(np.array(orders, object), 5), some.num_rows), pa.string()),
                    "step": pa.array(np.tile(np.arange(1, 6, dtype=np.int32), 120 * some.num_rows)),
                    **{c: pa.array(v.reshape(-1)) for c, v in found.items()}})

    return parts.mapInArrow(tidy(run), _RESULT)
