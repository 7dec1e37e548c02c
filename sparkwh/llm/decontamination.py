"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask laid over consecutive words; it hashes the words at its marked positions and ignores the others, so
a substituted word at an ignored position does not hide an overlap. Seeds of documents and of benchmark items are joined by
hash. A hit fixes an alignment of a document with an item; around it the words are compared one by one, and an overlap
counts if enough words in a row agree up to a share of substitutions.

Words are runs of ASCII letters and digits and of all longer characters, in lower case, so neither case nor punctuation
matters. A filter of fixed size leaves out document seeds that no item has before anything is shuffled, and documents
without a hit before their texts are.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .batches import ALPHANUMERIC, mix, signed, slices, text_bytes, tidy, word_places, words
from .filters import key_filter, may_hold


@dataclass(frozen=True)
class LeakParameters:
    """An overlap has at least ``least_words`` words, of which ``percent`` or more agree, and agrees at both ends; an item
    with fewer words must be met as a whole. Items of fewer than ``shortest_item`` words are left out.

    The masks together meet every overlap: any 13 words with two substitutions, 15 with three, 20 with four and 25 with five,
    wherever they are; an overlap of 26 words or more has a part of 13 to 25 words that agrees to 80 %. Shorter items have
    masks of their own (``whole_masks``).
    """
    masks: tuple[str, ...] = ("1111011", "111010011", "110100111", "11101000011")
    least_words: int = 13
    percent: int = 80
    shortest_item: int = 1


def _lowered_words(column: pa.Array):
    data, offsets = text_bytes(pc.utf8_lower(column))
    for i, j in slices(offsets):
        part, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        yield i, j, *words(part, at, kind=ALPHANUMERIC)


def whole_masks(n: int, percent: int) -> tuple[str, ...]:
    """Masks over all of ``n`` words of which one fits wherever the substitutions are that ``percent`` allows.

    The words between the first and the last are dealt into two groups more than there may be substitutions; every choice of
    that many groups is ignored by one mask."""
    bad = n * (100 - percent) // 100
    groups = min(bad + 2, max(n - 2, 0))
    return tuple("".join("0" if 0 < i < n - 1 and (i - 1) % groups in out else "1" for i in range(n))
                 for out in itertools.combinations(range(groups), min(bad, groups)))


def seeds(h: np.ndarray, row: np.ndarray, masks: tuple[str, ...], family: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every seed, and the word it begins at. Seeds of different families differ."""
    found, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for k, mask in enumerate(masks):
        n = len(h) - len(mask) + 1
        if n <= 0:
            continue
        s = np.full(n, (family << 32) + k + 1, np.uint64)
        for j in (j for j, c in enumerate(mask) if c == "1"):
            s = mix(s * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n])
        inside = np.flatnonzero(row[:n] == row[len(mask) - 1:])
        found.append(s[inside])
        at.append(inside)
    return np.concatenate(found), np.concatenate(at)


def _seed_rows(p: LeakParameters, table=None, lengths: tuple[int, ...] = ()):
    """(id, key, at, n) of every text, ``at`` counted in words of the text: without ``table`` the seeds of an item, with ``n``
    its words if they are fewer than an overlap has, else 0; with it, the seeds in it of a document, for items of any length
    and for whole items of ``lengths`` words."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, h, row in _lowered_words(batch.column(1)):
                count = np.bincount(row, minlength=j - i)
                first = np.cumsum(count) - count
                short = np.unique(count[(count >= p.shortest_item) & (count > 0) & (count < p.least_words)]) if table is None else lengths
                for n in (0, *map(int, short)):
                    s, at = seeds(h, row, whole_masks(n, p.percent) if n else p.masks, n)
                    key, of = signed(s), row[at]
                    if table is not None:
                        use = may_hold(table.value, key)
                    else:
                        use = count[of] == n if n else count[of] >= max(p.least_words, p.shortest_item)
                    key, at, of = key[use], at[use], of[use]
                    if n and n * (100 - p.percent) < 100:  # no substitution: places are alike, the first will do
                        order = np.lexsort((at, key, of))
                        new = np.ones(len(order), bool)
                        new[1:] = (key[order][1:] != key[order][:-1]) | (of[order][1:] != of[order][:-1])
                        key, at, of = (x[order][new] for x in (key, at, of))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(ids[i:j][of].astype(np.int64)), pa.array(key), pa.array((at - first[of]).astype(np.int64)),
                        pa.array(np.full(len(at), n, np.int64))], names=["id", "key", "at", "n"])
    return run


def best_overlap(same: np.ndarray, percent: int) -> tuple[int, int]:
    """Start and end of the longest stretch that agrees at both ends and in ``percent`` of its places; (0, 0) if none."""
    score = np.concatenate([[0], np.cumsum(np.where(same, 100 - percent, -percent))])
    low, best = [], (0, 0)
    for i in np.flatnonzero(same):  # only starts whose running score is below all earlier ones can be the longest's
        if not low or score[i] < score[low[-1]]:
            low.append(i)
    for end in np.flatnonzero(same)[::-1] + 1:
        if end - (low[0] if low else end) <= best[1] - best[0]:
            break
        reach = [i for i in low if i < end and score[i] <= score[end]]
        if reach and end - reach[0] > best[1] - best[0]:
            best = int(reach[0]), int(end)
    return best


def _verified(p: LeakParameters):
    """(doc_id, item_id, start, overlap_words, agreeing_words, item_words) of (doc_id, item_id, shifts, text, item): the best
    overlap of every row."""
    def best_at(shifts: list[int], held, other) -> tuple[int, int, int] | None:
        """Words, agreeing ones and negated start of the longest overlap, of equal ones the one with most agreeing words, then
        the first. ``held`` and ``other`` are arrays of words."""
        best, least = None, min(p.least_words, len(other))
        for shift in shifts:
            a, b = max(0, shift), min(len(held), shift + len(other))
            same = held[a:b] == other[a - shift:b - shift]
            start, end = best_overlap(same, p.percent)
            if end - start >= least:
                found = end - start, int(same[start:end].sum()), -(a + start)
                best = found if best is None else max(best, found)
                if found[1] == len(other):  # the whole item, every word: no later one is better
                    break
        return best

    def run(batches):
        held_id, held_text, held = None, None, None
        for batch in batches:
            out = []
            for doc_id, item_id, shifts, text, item in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or doc_id != held_id or text != held_text:
                    held_id, held_text, held = doc_id, text, _words_of(text)
                shifts = sorted(shifts)
                if best_at(shifts, held, _words_of(item)):  # decided on the words themselves
                    words_of_item = _word_list(item)
                    best = best_at(shifts, _word_list(text), words_of_item)
                    if best:
                        out.append((doc_id, item_id, -best[2], best[0], best[1], len(words_of_item)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 6)], names=[
                "doc_id", "item_id", "start", "overlap_words", "agreeing_words", "item_words"])
    return run


def _words_of(text: str | None) -> np.ndarray:
    data, offsets = text_bytes(pc.utf8_lower(pa.array([text or ""], pa.string())))
    return words(data, offsets, kind=ALPHANUMERIC)[0]


def _word_list(text: str | None) -> np.ndarray:
    data, offsets = text_bytes(pc.utf8_lower(pa.array([text or ""], pa.string())))
    starts, sizes, _ = word_places(data, offsets, ALPHANUMERIC)
    folded = data.tobytes().lower()
    out = np.empty(len(starts), object)
    out[:] = [folded[i:i + n] for i, n in zip(starts.tolist(), sizes.tolist())]
    return out


def _kept_rows(table):
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(may_hold(table.value, batch.column(0).to_numpy(zero_copy_only=False))))
    return run


def overlaps(docs: DataFrame, benchmark: DataFrame, p: LeakParameters = LeakParameters()) -> DataFrame:
    """One row per contaminated document and item: ``doc_id, item_id, start, overlap_words, agreeing_words, item_words``.

    ``docs`` has ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``; others are ignored. The longest overlap is
    reported, and of equally long ones the first. NULL or empty texts overlap nothing; rows with a NULL id cannot be reported
    and are left out; repeated rows count once; an empty table on either side gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where(
        "id is not null and text is not null")
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where(
        "id is not null and text is not null").distinct()
    schema = "id long, key long, at long, n long"
    known = stage(items.mapInArrow(tidy(_seed_rows(p)), schema), "item_seeds")
    table = key_filter(known.select("key"))
    lengths = tuple(sorted(r["n"] for r in known.where("n > 0").select("n").distinct().collect()))  # each below least_words
    hits = texts.mapInArrow(tidy(_seed_rows(p, table, lengths)), schema)
    aligned = stage(hits.select(F.col("id").alias("doc_id"), "key", F.col("at").alias("doc_at"))
                    .join(known.select(F.col("id").alias("item_id"), "key", "at"), "key")
                    .select("doc_id", "item_id", (F.col("doc_at") - F.col("at")).alias("shift")).distinct(), "aligned")
    there = key_filter(aligned.select(F.col("doc_id").alias("key")))
    near = texts.mapInArrow(tidy(_kept_rows(there)), "id long, text string").distinct()
    # All alignments of a document with an item in one row: the texts travel once, however many there are.
    placed = aligned.groupBy("doc_id", "item_id").agg(F.collect_list("shift").alias("shifts"))
    pairs = (placed.join(items.select(F.col("id").alias("item_id"), F.col("text").alias("item")), "item_id")
             .join(near.withColumnRenamed("id", "doc_id"), "doc_id")
             .select("doc_id", "item_id", "shifts", "text", "item"))
    found = pairs.mapInArrow(tidy(_verified(p)), "doc_id long, item_id long, start long, overlap_words long, agreeing_words long, item_words long")
    best = F.struct(F.col("overlap_words"), F.col("agreeing_words"), (-F.col("start")).alias("start"), "item_words")
    return (found.groupBy("doc_id", "item_id").agg(F.max(best).alias("best"))
            .select("doc_id", "item_id", (-F.col("best.start")).alias("start"), "best.overlap_words", "best.agreeing_words", "best.item_words"))
