"""Token counts by heap-and-linked-list byte-pair merging, without building identifiers.

A word starts as a doubly linked list of single-byte symbols; a heap holds its adjacent pairs by merge rank. The pair of
lowest rank is popped again and again and joined; the count is the number of initial symbols minus the merges done.
Texts are cut where no token can span (``pieces``), and the count of a piece is remembered in a cache of bounded size.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .batches import slices, text_bytes, tidy
from .pieces import PieceMemory

# Fixed value: the published pattern by which byte-level BPE cuts words.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in names:
            names[b] = chr(256 + extra)
            extra += 1
    return [names[b] for b in range(256)]


class PairMergeCounter:
    """Counts tokens as the vocabulary file at ``path`` (merges in rank order, added tokens) gives them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.ranks = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.symbols = byte_symbols()
        self.special = [re.escape(x["content"]) for x in spec["added_tokens"] if x["content"]]
        self.special = re.compile("|".join(sorted(self.special, key=len, reverse=True))) if self.special else None
        self.memory = PieceMemory(self.many)

    def merged(self, word: str) -> int:
        """Initial symbols minus merges."""
        part: list = [self.symbols[b] for b in word.encode()]
        n, ranks = len(part), self.ranks
        if n < 2:
            return n
        after = [*range(1, n), -1]
        before = [*range(-1, n - 1)]
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1) if (r := ranks.get((part[i], part[i + 1]))) is not None]
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if part[i] != a or j < 0 or part[j] != b:  # one of the two has been joined since
                continue
            part[i], part[j] = a + b, None
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                if (r := ranks.get((part[i], part[after[i]]))) is not None:
                    heapq.heappush(heap, (r, i, part[i], part[after[i]]))
            if before[i] >= 0 and (r := ranks.get((part[before[i]], part[i]))) is not None:
                heapq.heappush(heap, (r, before[i], part[before[i]], part[i]))
            left -= 1
        return left

    def words(self, text: str) -> int:
        """The count of a text without special strings."""
        return sum(map(self.merged, WORD.findall(text)))

    def many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return np.fromiter(map(self.words, texts), np.uint32, len(texts)), np.ones(len(texts), np.int64)

    def count(self, text: str) -> int:
        if not self.special:
            return self.words(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.words, parts))

    def count_rows(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The count of every row of a slice."""
        values, at = self.memory.rows(data, offsets)
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        counts = total[at[1:]] - total[at[:-1]]
        for i in rows_with(self.special, data, offsets):
            counts[i] = self.count(data[offsets[i]:offsets[i + 1]].tobytes().decode())
        return counts


def rows_with(special: re.Pattern | None, data: np.ndarray, offsets: np.ndarray) -> list[int]:
    """The rows that hold a special string."""
    if special is None:
        return []
    found = {int(np.searchsorted(offsets, m.start(), "right")) - 1 for m in
             re.finditer(special.pattern.encode(), data.tobytes())}
    return sorted(found)


_counters: dict[str, PairMergeCounter] = {}


def counter_for(path: str) -> PairMergeCounter:
    """One counter per worker process and file."""
    if path not in _counters:
        _counters[path] = PairMergeCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (``n_tokens > limit``) per row of ``docs``.

    A NULL or empty text has 0 bytes and 0 tokens; a NULL ``doc_id`` and repeated rows pass through; an empty table gives no
    rows. No special tokens are added; their strings inside a text count as one token each. ``path`` must name a
    vocabulary file that every executor can open.
    """
    def run(batches: Iterable[pa.RecordBatch]):
        counter = counter_for(path)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            counts = [counter.count_rows(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                      for i, j in slices(offsets)]
            counts = np.concatenate([np.zeros(0, np.int64), *counts])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(counts), pa.array(counts > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(tidy(run), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
