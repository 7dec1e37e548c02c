"""Helpers for vectorized work on Arrow batches inside tasks: byte views, bounded slices, word and shingle hashes.

A word is a run of bytes that are not one of space, tab, line feed, vertical tab, form feed, carriage return. Words and
shingles are handled as 64-bit fingerprints: runs of up to 8 bytes of one length never share one, longer ones go through a
chain of non-linear steps, and those over ``LONG_BYTES`` through XXH3. Where a result rests on equality, ``same_bytes``
compares the runs themselves. Everything works on whole texts. Memory is bounded by ``SLICE_BYTES`` (or by
one text, if that is longer), not by the number of rows.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import SparkSession, functions as F

SLICE_BYTES = 1 << 20
BATCH_ROWS = 2_000
_LIBC = ctypes.CDLL(None) if sys.platform == "linux" else None
_LIBC = _LIBC if hasattr(_LIBC, "malloc_trim") else None
SPACES = b" \t\n\v\f\r"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True

LONG_BYTES = 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of ``data`` on as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))


def _piece(view: np.ndarray, starts: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Bytes 8 k to 8 k + 8 of the runs, which are longer than 8 k."""
    return view[starts + 8 * k] & _MASKS[np.minimum(sizes - 8 * k, 8)]


def fingerprints(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit fingerprints of runs of bytes."""
    h = mix(sizes.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 1) & (1 << 64) - 1))
    view, left = eights(data), np.flatnonzero((sizes > 0) & (sizes <= LONG_BYTES))
    for k in range(LONG_BYTES // 8):
        if not len(left):
            break
        h[left] = mix(h[left] ^ _piece(view, starts[left], sizes[left], k))
        left = left[sizes[left] > 8 * k + 8]
    for i in np.flatnonzero(sizes > LONG_BYTES):
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i]:starts[i] + sizes[i]].tobytes(), seed)
    return h


def same_bytes(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether runs of equal sizes, at ``at_a`` in ``a`` and at ``at_b`` in ``b``, hold the same bytes."""
    same = np.ones(len(sizes), bool)
    one, two, left = eights(a), eights(b), np.flatnonzero(sizes <= LONG_BYTES)
    for k in range(LONG_BYTES // 8):
        left = left[sizes[left] > 8 * k]
        if not len(left):
            break
        same[left] &= _piece(one, at_a[left], sizes[left], k) == _piece(two, at_b[left], sizes[left], k)
    for i in np.flatnonzero(sizes > LONG_BYTES):
        n = sizes[i]
        same[i] = bool((a[at_a[i]:at_a[i] + n] == b[at_b[i]:at_b[i] + n]).all())
    return same


def injective(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, h: np.ndarray) -> bool:
    """Whether runs with equal fingerprints hold the same bytes."""
    order = np.argsort(h, kind="stable")
    a, b = order[:-1], order[1:]
    equal = h[a] == h[b]
    a, b = a[equal], b[equal]
    return bool((sizes[a] == sizes[b]).all() and same_bytes(data, starts[a], data, starts[b], sizes[a]).all())


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its rows, without copying. NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if column.null_count:  # a NULL may own bytes
        valid = np.asarray(column.is_valid())
        sizes = np.where(valid, np.diff(at), 0)
        if (sizes != np.diff(at)).any():
            return text_bytes(pa.array([x or "" for x in column.to_pylist()], pa.large_string()))
    return raw[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes and 4,096 rows, or of one row."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n, i + 4096)
        yield i, j
        i = j


#: Bytes that make words: everything but white space; ASCII letters and digits and all longer characters.
SOLID = ~_IS_SPACE
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[65:91] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True


def word_places(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = SOLID) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, size and row of every run of bytes of a ``kind``, in text order."""
    n = len(data)
    if n == 0:
        return (np.zeros(0, np.int64),) * 3
    solid = kind[data]
    before = np.empty(n, bool)
    before[0], before[1:] = False, solid[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, solid[1:]
    inner = offsets[1:-1]
    before[inner[inner < n]] = False
    after[inner[inner > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    return starts, np.flatnonzero(solid & ~after) + 1 - starts, np.searchsorted(offsets, starts, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray, fold_case: bool = True,
          kind: np.ndarray = SOLID) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and row of every run of bytes of a ``kind``, in text order. ``fold_case`` takes A-Z as a-z."""
    starts, sizes, row = word_places(data, offsets, kind)
    return fingerprints(_FOLDED[data] if fold_case else data, starts, sizes), row


def verified_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``words`` with fingerprints that tell all words of ``data`` apart, byte by byte: the first seed that does is taken."""
    starts, sizes, row = word_places(data, offsets)
    folded, seed = _FOLDED[data], 0
    while True:
        h = fingerprints(folded, starts, sizes, seed)
        if injective(folded, starts, sizes, h):
            return h, row
        seed += 1


def shingle_sets(h: np.ndarray, row: np.ndarray, size: int, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words: fingerprints sorted by row and value, their rows, and the count per row.

    A row with fewer words has its whole sequence as its one shingle; a row without words has none.
    """
    count = np.bincount(row, minlength=n_rows)
    if not len(h):
        return h, row, count
    rolled = h * np.uint64(0x9E3779B97F4A7C15)
    k = len(h) - size + 1
    if k > 0:
        s = np.zeros(k, np.uint64)
        for j in range(size):
            s = mix(s + rolled[j:j + k] + np.uint64(j + 1))
        whole = row[:k] == row[size - 1:]
        s, at = s[whole], row[:k][whole]
    else:
        s, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.searchsorted(row, short)
        extra = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            has = count[short] > j
            extra[has] = mix(extra[has] + rolled[first[has] + j] + np.uint64(j + 1))
        s, at = np.concatenate([s, mix(extra + count[short].astype(np.uint64))]), np.concatenate([at, short])
    order = np.lexsort((s, at))
    s, at = s[order], at[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (at[1:] != at[:-1])
    s, at = s[new], at[new]
    return s, at, np.bincount(at, minlength=n_rows)


def _runs(columns: list[np.ndarray]) -> np.ndarray:
    """Starts of runs of rows that are equal in all columns, and the end."""
    n = len(columns[0])
    change = np.zeros(max(n - 1, 0), bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [n]]) if n else np.zeros(1, int)


def grouped(batches, keys: int):
    """Arrow tables of the rows of one group after another; rows come sorted by the first ``keys`` columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = _runs([batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)])
        if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in range(keys)):
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        if len(cuts) > 2:
            first = batch.slice(0, cuts[1])
            yield pa.Table.from_batches([*held, first]).combine_chunks()
            held = []
            whole = pa.Table.from_batches([batch])
            for a, b in zip(cuts[1:-2], cuts[2:-1]):
                yield whole.slice(a, b - a)
        held.append(batch.slice(cuts[-2]))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def tidy(work):
    """``work`` over a task's batches, then memory that Python, numpy and Arrow hold without need goes back to the system:
    workers live on from stage to stage, and an executor's memory limit counts what they keep."""
    def run(batches):
        yield from work(batches)
        give_back()
    return run


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let Spark hand at most ``rows`` rows at a time to Python from now on, if the session allows more: documents are long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark longs with the same bits."""
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def crc_fold(doc_id) -> F.Column:
    """The remainder that decides the fold of a document: crc32 of the decimal doc_id, modulo 4. NULL: no fold."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
