"""Exact de-duplication: owners hold full texts in Patricia tries.

Every map task inserts its texts, white space removed, into a compressed radix trie and hands one row per distinct text
to the owner of (length, content hash). The owner merges these rows in a trie of its own. Terminal nodes hold the row
that stays, the number of rows and the local owners; equality is decided on the full bytes, never on a hash.

A text that fills a third of the table reaches its owner once per map task. A trie beyond its memory bound spills its
heaviest subtree to a file of the task and finishes it afterwards, one subtree at a time.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .batches import SPACES, tidy
from .filters import split

MAP_TRIE_BYTES = 8 << 20
OWNER_TRIE_BYTES = 64 << 20
_SHA, _POINTS = "__text_sha256", "__n_points"


class _Node:
    __slots__ = ("label", "children", "value")

    def __init__(self, label: bytes, value=None):
        self.label, self.children, self.value = label, None, value


def _shared(a: bytes, b: bytes, at: int) -> int:
    """Length of the common start of ``a`` and of ``b`` from ``at`` on."""
    n = min(len(a), len(b) - at)
    if a[:n] == b[at:at + n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[at + lo:at + mid]:
            lo = mid
        else:
            hi = mid
    return lo


class PatriciaTrie:
    """Byte strings to values; ``merge(old, new)`` joins the values of equal strings. Spills by subtree."""

    def __init__(self, merge, limit: int, depth: int = 0):
        self.merge, self.limit, self.depth = merge, limit, depth
        self.root, self.held = _Node(b""), 0
        self.weight: dict[int, int] = {}
        self.spilled: dict[int, object] = {}

    def insert(self, key: bytes, value):
        """Add the pair; returns the merged value of its terminal node, None if its subtree is spilled."""
        if len(key) <= self.depth:
            return self._merged(self.root, value)
        branch = key[self.depth]
        if branch in self.spilled:
            pickle.dump((key, value), self.spilled[branch])
            return None
        value = self._descend(key, value, branch)
        if self.held > self.limit and self.weight:
            self._spill(max(self.weight, key=self.weight.get))
        return value

    def _merged(self, node: _Node, value):
        node.value = value if node.value is None else self.merge(node.value, value)
        return node.value

    def _descend(self, key: bytes, value, branch: int):
        node, at = self.root, self.depth
        while True:
            if at == len(key):
                return self._merged(node, value)
            if node.children is None:
                node.children = {}
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = _Node(key[at:], value)
                self._grow(branch, len(key) - at + 200)
                return value
            same = _shared(child.label, key, at)
            if same < len(child.label):
                upper = _Node(child.label[:same])
                child.label = child.label[same:]
                upper.children = {child.label[0]: child}
                node.children[key[at]] = upper
                self._grow(branch, 200)
                child = upper
            node, at = child, at + same

    def _grow(self, branch: int, by: int) -> None:
        self.held += by
        self.weight[branch] = self.weight.get(branch, 0) + by

    def _spill(self, branch: int) -> None:
        file = self.spilled[branch] = tempfile.TemporaryFile()
        child = self.root.children.pop(branch)
        for pair in self._walk(child, self._prefix):
            pickle.dump(pair, file)
        self.held -= self.weight.pop(branch)

    _prefix = b""

    def _walk(self, node: _Node, prefix: bytes) -> Iterator[tuple[bytes, object]]:
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            key = prefix + node.label
            if node.value is not None:
                yield key, node.value
            stack += [(x, key) for x in (node.children or {}).values()]

    def items(self) -> Iterator[tuple[bytes, object]]:
        """All strings with their values; every spilled subtree is merged on its own, below the start its strings share."""
        yield from self._walk(self.root, self._prefix)
        self.root = _Node(b"")
        for file in self.spilled.values():
            depth, prefix = None, b""
            for key, _ in self._pairs(file):
                if depth is None:
                    depth, prefix = len(key), key
                depth = min(depth, _shared(prefix[:depth], key, 0))
            deeper = PatriciaTrie(self.merge, self.limit, depth or 0)
            deeper._prefix = prefix[:depth]
            for key, value in self._pairs(file):
                deeper.insert(key, value)
            file.close()
            yield from deeper.items()

    @staticmethod
    def _pairs(file) -> Iterator[tuple[bytes, object]]:
        file.seek(0)
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


def _later(a: tuple, b: tuple) -> tuple:
    """Of two (code points, doc_id, row): more code points, then the smaller id (NULL last), then the smaller row."""
    return min(a, b, key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[2]))


def _batch(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema)],
                                      names=[n for n, _ in schema])


_MAPPED = [("row", pa.int64()), ("doc_id", pa.int64()), ("owner", pa.int64()), ("text_sha256", pa.string()), ("own_points", pa.int64()),
           ("n_bytes", pa.int64()), ("content_hash", pa.int64()), ("norm", pa.binary()), ("n", pa.int64()),
           ("points", pa.int64()), ("best_id", pa.int64()), ("best_row", pa.int64())]
_MAPPED_SQL = ("row long, doc_id long, owner long, text_sha256 string, own_points long, n_bytes long, content_hash long, norm binary, "
               "n long, points long, best_id long, best_row long")
_OWNED = [("owner", pa.int64()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64())]
_OWNED_SQL = "owner long, keep_id long, keep_row long, group_size long"


def _values(column: pa.Array):
    """The values of a column one by one, so that texts are not all copied at a time."""
    return (x.as_py() for x in column)


def _map_side(trie_bytes: int):
    """One row per document with its local owner (the first row of the chunk with that text); owners carry the text."""
    def merge(old, new):
        return old[0], old[1] + new[1], _later(old[2], new[2])

    def flush(trie, rows):
        owned = {value[0]: (key, value) for key, value in trie.items()}
        out = []
        for number, doc_id, owner, digest, own in rows:
            if owner == number:
                key, (_, n, best) = owned[owner]
                hashed = xxhash.xxh3_64_intdigest(key) - (1 << 63)
                out.append((number, doc_id, owner, digest, own, len(key), hashed, key, n, *best))
            else:
                out.append((number, doc_id, owner, digest, own) + (None,) * 7)
        return _batch(out, _MAPPED)

    def run(batches):
        trie, rows = PatriciaTrie(merge, 1 << 62), []
        for batch in batches:
            for number, doc_id, text in zip(*map(_values, batch.columns)):
                text = text or ""
                key = text.encode().translate(None, SPACES)
                owner = trie.insert(key, (number, 1, (len(text), doc_id, number)))[0]
                rows.append((number, doc_id, owner, hashlib.sha256(key).hexdigest(), len(text)))
                if trie.held + 300 * len(rows) > trie_bytes:
                    yield flush(trie, rows)
                    trie, rows = PatriciaTrie(merge, 1 << 62), []
        if rows:
            yield flush(trie, rows)
    return run


def _owner_side(trie_bytes: int):
    def merge(old, new):
        old[0].extend(new[0])
        return old[0], old[1] + new[1], _later(old[2], new[2])

    def run(batches):
        trie = PatriciaTrie(merge, trie_bytes)
        for batch in batches:
            for owner, norm, n, points, best_id, best_row in zip(*map(_values, batch.columns)):
                trie.insert(norm, ([owner], n, (points, best_id, best_row)))
        out = []
        for _, (owners, n, best) in trie.items():
            out += [(x, best[1], best[2], n) for x in owners]
            if len(out) > 20_000:
                yield _batch(out, _OWNED)
                out = []
        yield _batch(out, _OWNED)
    return run


def exact_groups(docs: DataFrame, map_trie_bytes: int = MAP_TRIE_BYTES,
                 owner_trie_bytes: int = OWNER_TRIE_BYTES) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``; other columns are ignored): ``doc_id``, ``keep_id``,
    ``group_size``, ``kept``, ``text_sha256`` of the text without white space, ``n_points`` of the text as it is.

    Of equal texts the row with the most code points stays, then the smallest ``doc_id``, a NULL id last, and of fully
    repeated rows exactly one. NULL and blank texts are one group, of the empty text. An empty table gives no rows.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    mapped = stage(rows.mapInArrow(tidy(_map_side(map_trie_bytes)), _MAPPED_SQL), "local_owners")
    owned = (mapped.where("norm is not null").select("owner", "norm", "n", "points", "best_id", "best_row", "n_bytes", "content_hash")
             .repartition("n_bytes", "content_hash")
             .select("owner", "norm", "n", "points", "best_id", "best_row")
             .mapInArrow(tidy(_owner_side(owner_trie_bytes)), _OWNED_SQL))
    return (mapped.select("row", "doc_id", "owner", "text_sha256", "own_points").join(owned, "owner")
            .select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256",
                    F.col("own_points").alias("n_points")))


def _unused(name: str, columns: list[str]) -> str:
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay by ``groups`` (from ``exact_groups``), with all their columns.

    Only rows whose id has a row that goes, or more than one row, are joined; of rows that agree in id, text without white
    space and length one stays. Rows with NULL ``doc_id`` have no identity and go; if such a row has won its group, the best
    of the others stays for it.
    """
    sha, points = (_unused(name, docs.columns) for name in (_SHA, _POINTS))
    groups = stage(groups.where("doc_id is not null"), "exact_groups")
    heirs = (groups.where("keep_id is null").groupBy("text_sha256").agg(F.min(F.struct(-F.col("n_points"), "doc_id")).alias("best"))
             .select("best.doc_id", F.col("text_sha256").alias(sha), (-F.col("best.col1")).alias(points)))
    odd = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("kept").alias("all")).where("n > 1 or not all")
    sure, maybe = split(docs.where("doc_id is not null"), odd.select(F.col("doc_id").alias("key")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = maybe.withColumns({sha: F.sha2(F.translate(text, SPACES.decode(), ""), 256), points: F.char_length(text).cast("long")})
    stays = groups.where("kept").select("doc_id", F.col("text_sha256").alias(sha), F.col("n_points").alias(points)).unionByName(heirs).distinct()
    chosen = marked.join(stays, ["doc_id", sha, points], "left_semi").dropDuplicates(["doc_id", sha, points])
    return sure.unionByName(chosen.select(*docs.columns))
