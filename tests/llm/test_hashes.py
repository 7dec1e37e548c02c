"""Words that a polynomial hash cannot tell apart: results rest on the bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sparkwh.llm import batches, pieces
from sparkwh.llm.decontamination import overlaps
from sparkwh.llm.near_dedup import near_groups
from sparkwh.llm.packing import pack
from sparkwh.llm.queries import vocabulary_path
from sparkwh.llm.token_count import token_counts

from .helpers import docs_of
from .test_tokens import check_packing

MORSE = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
OTHER = MORSE.translate({97: "b", 98: "a"})


@pytest.fixture(params=["as it is", "all alike"])
def hashes(request, monkeypatch):
    """The hash as it is, and one that gives words and pieces of one size the same fingerprint."""
    if request.param == "all alike":
        monkeypatch.setattr(pieces, "fingerprints", lambda data, starts, sizes, seed=0: batches.mix(sizes.astype(np.uint64)))


def test_different_words_of_equal_polynomials(spark):
    rows = [(1, MORSE), (2, OTHER), (3, MORSE + " x"), (4, OTHER + " x")]
    got = {r["doc_id"]: r["component_id"] for r in near_groups(docs_of(spark, rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4}
    items = spark.createDataFrame([(7, MORSE), (8, OTHER)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in overlaps(docs_of(spark, rows), items).collect()}
    assert found == {(1, 7), (2, 8), (3, 7), (4, 8)}


def test_pieces_are_looked_up_by_their_bytes(spark):
    tokenizer = Tokenizer.from_file(vocabulary_path())
    rows = [(1, MORSE), (2, OTHER), (3, "abcd efgh"), (4, "efgh abcd"), (5, "x" * 100), (6, "y" * 100)]
    docs = docs_of(spark, rows).coalesce(1)
    assert check_packing(rows, pack(docs, vocabulary_path()).collect(), tokenizer, (2048, 1024, 512, 256))
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts(docs, vocabulary_path()).collect()}
    assert got == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in rows}


def test_memory_compares_bytes(hashes):
    def make(texts):
        return np.array([int.from_bytes(t.encode()[:3], "big") for t in texts], np.uint32), np.ones(len(texts), np.int64)
    memory = pieces.PieceMemory(make)
    for texts in (["ab cd", "cd ab ef"], ["ef gh", "ab"], ["zz" * 50 + " ab", "gh"]):
        data, offsets = batches.text_bytes(pa.array(texts))
        flat, at = memory.rows(data, offsets)
        starts, sizes = pieces.cut(data, offsets)
        raw = data.tobytes()
        assert flat.tolist() == make([raw[i:i + n].decode() for i, n in zip(starts, sizes)])[0].tolist()
        assert at[-1] == len(flat)


def test_fingerprints_of_short_runs_differ_and_comparison_is_exact():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 4, 30_000).astype(np.uint8)
    starts, sizes = rng.integers(0, 29_000, 5_000), rng.integers(1, 60, 5_000)
    h = batches.fingerprints(data, starts, sizes)
    runs = [data[i:i + n].tobytes() for i, n in zip(starts, sizes)]
    assert len(set(zip(h.tolist(), runs))) == len(set(h.tolist())) == len(set(runs))
    other = rng.permutation(starts)
    same = batches.same_bytes(data, starts, data, other, sizes)
    assert same.tolist() == [data[i:i + n].tobytes() == data[j:j + n].tobytes() for i, j, n in zip(starts, other, sizes)]
    assert batches.injective(data, starts, sizes, h) and not batches.injective(data, starts, sizes, h & np.uint64(1))


def test_many_alignments_of_equal_words_stay_one_row(spark):
    rows = [(1, "same " * 3_000), (2, "other words")]
    items = spark.createDataFrame([(7, "same " * 40)], "item_id long, text string")
    got = [tuple(r) for r in overlaps(docs_of(spark, rows), items).collect()]
    assert got == [(1, 7, 0, 40, 40, 40)]
