from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from sparkwh.llm.decontamination import LeakParameters, best_overlap, overlaps, whole_masks

from .helpers import EDGES, docs_of, table

P = LeakParameters()


def tokens(text: str | None) -> list[str]:
    return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").lower())


def longest(same: list[bool], percent: int) -> int:
    best = 0
    for i in range(len(same)):
        for j in range(len(same), i + best, -1):
            if same[i] and same[j - 1] and 100 * sum(same[i:j]) >= percent * (j - i):
                best = j - i
                break
    return best


def brute(docs: list[tuple], items: list[tuple]) -> dict[tuple, int]:
    """(doc_id, item_id) to the longest overlap, over all alignments."""
    out = {}
    for i, text in docs:
        d = tokens(text)
        at = {}
        for k, w in enumerate(d):
            at.setdefault(w, []).append(k)
        for j, item in items:
            b = tokens(item)
            need = min(P.least_words, len(b))
            if len(b) < P.shortest_item:
                continue
            agree = {}
            for k, w in enumerate(b):
                for p in at.get(w, ()):
                    agree[p - k] = agree.get(p - k, 0) + 1
            for shift, n in agree.items():
                if n * 100 >= need * P.percent:
                    same = [0 <= shift + k < len(d) and d[shift + k] == w for k, w in enumerate(b)]
                    size = longest(same, P.percent)
                    if size >= need:
                        out[i, j] = max(out.get((i, j), 0), size)
    return out


def test_masks_meet_every_short_overlap_with_two_substitutions():
    for missing in itertools.combinations(range(P.least_words), 2):
        assert any(all(at + k not in missing for k, c in enumerate(mask) if c == "1")
                   for mask in P.masks for at in range(P.least_words - len(mask) + 1)), missing


def test_longest_overlap_matches_all_stretches():
    rng = np.random.default_rng(0)
    for _ in range(1_500):
        same = rng.random(rng.integers(0, 35)) < rng.random()
        start, end = best_overlap(same, 80)
        assert end - start == longest(same.tolist(), 80)


def planted() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(3_000)}"
    items = [(k, " ".join(word() for _ in range(rng.randrange(8, 60)))) for k in range(30)] + [(99, "too short"), (98, "")]
    docs = []
    for i in range(200):
        text = [word() for _ in range(rng.randrange(5, 150))]
        if i % 2:
            item = items[rng.randrange(30)][1].split()
            cut = item[rng.randrange(max(1, len(item) - 12)):] if i % 3 else item
            for _ in range(rng.randrange(3)):
                cut[rng.randrange(len(cut))] = "other"
            at = rng.randrange(len(text))
            text[at:at] = [w.upper() + "," for w in cut]
        docs.append((i, " ".join(text)))
    return docs, items


def test_planted_passages_match_brute_force(spark):
    docs, items = planted()
    bench = spark.createDataFrame([(*x, "k", "t") for x in items], "item_id long, text string, key string, id string")
    got = {(r["doc_id"], r["item_id"]): r["overlap_words"] for r in overlaps(docs_of(spark, docs), bench).collect()}
    want = brute(docs, items)
    sure = {k for k, n in want.items() if n >= 13}
    assert set(got) <= set(want) and sure <= set(got) and all(got[k] == want[k] for k in got) and len(sure) > 60


def test_whole_table_matches_brute_force(spark):
    docs, bench = table(spark, "documents"), table(spark, "benchmark")
    got = {(r["doc_id"], r["item_id"]): r["overlap_words"] for r in overlaps(docs, bench).collect()}
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])


@pytest.mark.parametrize("side", ["docs", "bench"])
def test_edge_rows(spark, side):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    rows = [*EDGES, (50, passage), (50, passage), (None, passage), (51, "x " + passage.upper() + " y")]
    items = [(1, passage), (1, passage), (None, passage), (2, None), (3, ""), (4, "w " * 3_000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["start"], r["overlap_words"]) for r in overlaps(docs_of(spark, rows), bench).collect())
    assert got == [(50, 1, 0, 13), (51, 1, 1, 13)]
    empty = overlaps(docs_of(spark, [] if side == "docs" else rows), bench if side == "docs" else bench.limit(0))
    assert empty.count() == 0


def fits(mask: str, at: int, missing) -> bool:
    return all(at + k not in missing for k, c in enumerate(mask) if c == "1")


@pytest.mark.parametrize("size", [15, 20, 25])
def test_masks_meet_every_long_overlap(size):
    for missing in itertools.combinations(range(size), size // 5):
        assert any(fits(mask, at, missing) for mask in P.masks for at in range(size - len(mask) + 1)), missing


@pytest.mark.parametrize("size", range(1, 13))
def test_masks_meet_every_whole_item(size):
    masks = whole_masks(size, P.percent)
    assert all(len(m) == size for m in masks)
    for missing in itertools.combinations(range(1, size - 1), size // 5):
        assert any(fits(mask, 0, missing) for mask in masks), missing


def test_items_of_any_length_match_brute_force(spark):
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(3_000)}"
    items = [(n, " ".join(word() for _ in range(n))) for n in range(1, 26)]
    docs = []
    for k in range(1_500):
        n = 1 + k % 25
        cut = items[n - 1][1].split()
        for at in rng.sample(range(1, n - 1), rng.randrange(n // 5 + 1)) if n > 2 else ():
            cut[at] = "other"
        text = [word() for _ in range(rng.randrange(30))]
        at = rng.randrange(len(text) + 1)
        docs.append((k, " ".join(text[:at] + cut + text[at:])))
    docs += [(2_000 + k, items[19][1]) for k in range(2)]
    full = items[19][1].split()
    docs.append((2_010, " ".join("other" if k in (6, 8, 11, 15) else w for k, w in enumerate(full))))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["overlap_words"] for r in overlaps(docs_of(spark, docs), bench).collect()}
    want = brute(docs, items)
    assert got == want and (2_010, 20) in want and len({i for _, i in want}) == 25
