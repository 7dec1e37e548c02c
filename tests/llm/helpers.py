"""Small tables and brute-force versions shared by the tests of this folder."""

from __future__ import annotations

import random
import re
import zlib

from pyspark.sql import types as T

SF_SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Extra columns whose names the operators use inside.
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     *(T.StructField(c, T.StringType()) for c in ("row", "owner", "key", "n", "score", "rep", "toxic"))])


def docs_of(spark, rows: list[tuple]):
    """(doc_id, text) or (doc_id, text, lang) rows with clashing extra columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None) + ("x",) * 7 for r in rows]
    return spark.createDataFrame(full, DOCS)


def table(spark, name: str, sf: str = SF_SMALL):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fold(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 4


def shingles(text: str | None, size: int) -> frozenset:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_components(rows: list[tuple], size: int, percent: int = 80) -> dict[int, int]:
    """doc_id to component by comparing all pairs of (doc_id, text)."""
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = sorted((find(a), find(b)))
                    root[q] = p
    return {i: find(i) for i in ids}


def family(seed: int, copies: int, words: int = 60, edits: int = 3, first: int = 0) -> list[tuple]:
    """A text and edited copies of copies."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    out = [base]
    for _ in range(copies - 1):
        new = list(rng.choice(out[-6:]))
        for _ in range(rng.randrange(edits + 1)):
            new[rng.randrange(len(new))] = f"e{rng.randrange(10_000)}"
        out.append(new)
    return [(first + i, " ".join(x)) for i, x in enumerate(out)]


EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"),
         (8, "a B c d e F"), (9, "long " * 200_000), (10, "été ﬁn x 日本語 🙂"), (None, None), (11, "<|endoftext|> x")]
