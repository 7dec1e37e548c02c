"""Hierarchical multi-length packing of documents into training sequences.

A document is cut into whole windows of the longest tier and a rest. The rest is routed to the shortest tier that holds it.
Windows are then packed tier by tier, longest first: each starts with a rest of its own tier and its gap is filled from the
shorter tiers, whole pieces first, then with one cut piece, so that it ends exactly at its tier's length. Sequences of one
tier are dealt to step groups of equal token counts.

Each task packs the documents of its own partition in a stream; nothing is shuffled, and only the last sequence of a task
can be short. What a task holds is bounded by ``POOL_TOKENS``.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .batches import slices, text_bytes, tidy
from .pieces import PieceMemory
from .token_count import WORD, byte_symbols, rows_with

TIERS = (2048, 1024, 512, 256)
POOL_TOKENS = 1 << 20
STEP_TOKENS = 1 << 16
END_ID = 1
_BETWEEN = "\U000F7A3C"  # a private character, as a token of its own

_SCHEMA = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
           ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int64()),
           ("step_group", pa.int64())]
_SQL = ", ".join(f"{name} long" for name, _ in _SCHEMA)


class CachedEncoder:
    """Identifiers of whole texts, little-endian 32-bit, as the tokenizer file at ``path`` gives them.

    Texts are cut where no token can span, and the identifiers of a piece are remembered in a cache of bounded size, where
    the file's identifiers follow its merge order and its words are cut by the usual pattern; pieces are then
    encoded by a rank table built from the file. Else whole texts go to the tokenizer itself. Both give the same.
    """

    def __init__(self, path: str, ranks: bool = True):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = [re.escape(x["content"]) for x in spec["added_tokens"]]
        self.special = re.compile("|".join(sorted(special, key=len, reverse=True))) if special else None
        self.table = self._by_rank(spec) if ranks else None
        self.memory = PieceMemory(self._many) if self.table else None
        if self.table:
            self.whole = lambda text: self.table.encode(text, allowed_special=set(self.table.special_tokens_set) - {_BETWEEN}, disallowed_special=())
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.whole = lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _by_rank(spec: dict):
        vocab, cutter = spec["model"]["vocab"], spec["pre_tokenizer"] or {}
        joined = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in spec["model"]["merges"]]
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        plain = (spec["model"].get("type", "BPE") == "BPE" and cutter.get("type") == "ByteLevel" and not spec["normalizer"]
                 and not cutter.get("add_prefix_space") and cutter.get("use_regex", True)
                 and not any(spec["model"].get(x) for x in ("dropout", "ignore_merges", "end_of_word_suffix"))
                 and not any(x.get(k) for x in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
                 and all(a < b for a, b in zip(joined, joined[1:])) and min(joined, default=0) >= 256
                 and all(re.search("[0-9A-Za-z][^0-9A-Za-z]", x["content"]) for x in spec["added_tokens"]))
        if not plain:
            return None
        to_byte = {c: b for b, c in enumerate(byte_symbols())}
        ranks = {bytes(map(to_byte.__getitem__, t)): i for t, i in vocab.items() if t not in special}
        between = {_BETWEEN: max(ranks.values(), default=0) + len(special) + 1}
        return tiktoken.Encoding("pieces", pat_str=WORD.pattern, mergeable_ranks=ranks, special_tokens=special | between)

    def _many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All pieces in one call, with a special token between them."""
        joined = _BETWEEN.join(texts)
        if joined.count(_BETWEEN) >= len(texts):  # a text holds the mark itself
            made = [self.table.encode_ordinary(x) for x in texts]
            return np.array([i for one in made for i in one], np.uint32), np.array([len(one) for one in made])
        ids = self.table.encode_to_numpy(joined, allowed_special={_BETWEEN}, disallowed_special=())
        marks = np.flatnonzero(ids == self.table.encode_single_token(_BETWEEN))
        sizes = np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1
        return np.delete(ids, marks), sizes

    def encode_rows(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The identifiers of every row of a slice."""
        if self.memory is None:
            return [np.array(self.whole(data[i:j].tobytes().decode()), "<u4") for i, j in zip(offsets, offsets[1:])]
        ids, at = self.memory.rows(data, offsets)
        out = [ids[i:j] for i, j in zip(at, at[1:])]
        for i in rows_with(self.special, data, offsets):
            out[i] = np.array(self.whole(data[offsets[i]:offsets[i + 1]].tobytes().decode()), "<u4")
        return out


_encoders: dict[str, CachedEncoder] = {}


def encoder_for(path: str) -> CachedEncoder:
    if path not in _encoders:
        _encoders[path] = CachedEncoder(path)
    return _encoders[path]


class TierPacker:
    """Packs (doc_id, identifiers) into sequences; ``add`` and ``finish`` yield finished pieces as rows of ``_SCHEMA``."""

    def __init__(self, tiers: tuple[int, ...], pool_tokens: int, step_tokens: int, first_id: int):
        self.tiers, self.pool_tokens, self.step_tokens = tuple(sorted(tiers, reverse=True)), pool_tokens, step_tokens
        self.pools: dict[int, deque] = {t: deque() for t in self.tiers}
        self.held, self.next_id = 0, first_id
        self.in_tier = dict.fromkeys(self.tiers, 0)
        self.first_id = first_id

    def _route(self, piece: tuple) -> None:
        """piece: doc_id, start, identifiers, tokens of the document; at most the longest tier."""
        tier = min(t for t in self.tiers if t >= len(piece[2]) // 4)
        self.pools[tier].append(piece)
        self.held += len(piece[2]) // 4

    def _emit(self, pieces: list[tuple], tier: int) -> Iterator[tuple]:
        per_step = max(1, self.step_tokens // tier)
        # A group: one tier, so many sequences that each group has the same number of tokens.
        group = self.first_id + (self.in_tier[tier] // per_step) * len(self.tiers) + self.tiers.index(tier)
        self.in_tier[tier] += 1
        offset = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            yield doc_id, start, n, zlib.crc32(ids), total, self.next_id, offset, tier, group
            offset += n
        self.next_id += 1

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        longest, total, at = self.tiers[0], len(ids) // 4, 0
        while total - at >= longest:
            yield from self._emit([(doc_id, at, ids[4 * at:4 * (at + longest)], total)], longest)
            at += longest
        if at < total:
            self._route((doc_id, at, ids[4 * at:], total))
        if self.held > self.pool_tokens:
            yield from self._pack(self.tiers[0])

    def _take(self, room: int, below: int) -> tuple | None:
        """A piece from the tiers up to ``below`` for a gap of ``room``: a whole one if one is at hand, else a cut one."""
        usable = [t for t in self.tiers if t <= below and self.pools[t]]
        for t in usable:
            if len(self.pools[t][0][2]) // 4 <= room:
                piece = self.pools[t].popleft()
                self.held -= len(piece[2]) // 4
                return piece
        if not usable:
            return None
        doc_id, start, ids, total = self.pools[usable[-1]].popleft()
        self.held -= len(ids) // 4
        self._route((doc_id, start + room, ids[4 * room:], total))
        return doc_id, start, ids[:4 * room], total

    def _pack(self, keep: int) -> Iterator[tuple]:
        """Full windows while more than ``keep`` tokens are held in the pools."""
        for tier in self.tiers:
            while self.pools[tier] and self.held > max(keep, tier):
                pieces, room = [], tier
                piece = self._take(room, tier)
                while room and piece:
                    pieces.append(piece)
                    room -= len(piece[2]) // 4
                    piece = self._take(room, tier) if room else None
                if room:  # the shorter tiers are empty: wait for more
                    for piece in pieces:
                        self._route(piece)
                    break
                yield from self._emit(pieces, tier)

    def finish(self) -> Iterator[tuple]:
        yield from self._pack(0)
        rest = [p for t in self.tiers for p in self.pools[t]]
        self.pools = {t: deque() for t in self.tiers}
        longest, window, room = self.tiers[0], [], self.tiers[0]
        for doc_id, start, ids, total in rest:
            while ids:
                part, ids = ids[:4 * room], ids[4 * room:]
                window.append((doc_id, start, part, total))
                start += len(part) // 4
                room -= len(part) // 4
                if not room:
                    yield from self._emit(window, longest)
                    window, room = [], longest
        if window:
            yield from self._emit(window, longest)
        self.held = 0


def pack(docs: DataFrame, path: str, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS,
         pool_tokens: int = POOL_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group``.

    A document's identifiers are those of its text, without added special tokens, then ``end_id``; a NULL or empty text
    is the end identifier alone. Every identifier lies in exactly one piece, also of repeated rows, each of which is packed
    on its own; a NULL ``doc_id`` passes through; an empty table gives no rows. ``sequence_id`` has the partition in its
    upper bits. Every sequence ends exactly at its ``tier``, except the last of a partition, which is padded to the longest.
    """
    def run(batches):
        context = TaskContext.get()
        packer = TierPacker(tiers, pool_tokens, step_tokens, (context.partitionId() if context else 0) << 40)
        encoder, end = encoder_for(path), np.array([end_id], "<u4").tobytes()
        out: list[tuple] = []
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = text_bytes(batch.column(1))
            for i, j in slices(offsets):
                encoded = encoder.encode_rows(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                for doc_id, one in zip(ids[i:j], encoded):
                    out += packer.add(doc_id, one.astype("<u4").tobytes() + end)
                if len(out) > 10_000:
                    yield _rows(out)
                    out = []
        out += packer.finish()
        if out:
            yield _rows(out)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(tidy(run), _SQL)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _SCHEMA)], names=[n for n, _ in _SCHEMA])
