from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sparkwh.llm.packing import CachedEncoder, pack
from sparkwh.llm.queries import vocabulary_path
from sparkwh.llm.token_count import PairMergeCounter, token_counts

from .helpers import EDGES, docs_of, table


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_path())


def odd_texts(n: int) -> list[str]:
    rng = random.Random(5)
    parts = [*" \t\n\r\x0b\x0c\x1c\x85\xa0 　'sdABéß12-_.😀́\U000F7A3C", "<|endoftext|>", "'ll", " x", "  ", "can't", " a", "n\nm", "<|", "|>"]
    return ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(n)]


def test_counts_are_the_tokenizers(spark, tokenizer):
    rows = [(i, t) for i, t in enumerate(odd_texts(4_000))]
    rows += [(10_000 + r["doc_id"], r["text"]) for r in table(spark, "documents").collect()]
    got = {r["doc_id"]: r for r in token_counts(docs_of(spark, rows), vocabulary_path()).collect()}
    for i, text in rows:
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len(text.encode()), n > 512), text


def test_merges_pop_the_lowest_rank_first():
    counter = PairMergeCounter(vocabulary_path())
    assert counter.count("") == 0 and counter.count("the") == 1 and counter.count("\x00\x01") == 2


@pytest.mark.parametrize("ranks", [True, False])
def test_identifiers_are_the_tokenizers(tokenizer, ranks):
    encoder, texts = CachedEncoder(vocabulary_path(), ranks), odd_texts(1_500)
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    got = encoder.encode_rows(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for text, ids in zip(texts, got):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def check_packing(rows, pieces, tokenizer, tiers):
    """Every identifier in exactly one piece; sequences gapless and full."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    short = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= own[0]["tier"] and len({(p["tier"], p["step_group"]) for p in own}) == 1 and own[0]["tier"] in tiers
        short += at < own[0]["tier"]
    return short, by_sequence


@pytest.mark.parametrize("pool", [1 << 20, 3_000])
def test_packing_round_trip(spark, tokenizer, pool):
    docs = table(spark, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    pieces = pack(docs.repartition(3), vocabulary_path(), pool_tokens=pool).collect()
    short, sequences = check_packing(rows, pieces, tokenizer, (2048, 1024, 512, 256))
    assert short <= 3
    groups = {}
    for own in sequences.values():
        groups.setdefault(own[0]["step_group"], []).append(own[0]["tier"])
    assert all(len(set(t)) == 1 and sum(t) <= 1 << 16 for t in groups.values())


def test_edge_rows(spark, tokenizer):
    rows = [r for r in EDGES if r[0] not in (None, 7)]
    check_packing(rows, pack(docs_of(spark, rows).coalesce(1), vocabulary_path(), tiers=(64, 16)).collect(), tokenizer, (64, 16))
    every = pack(docs_of(spark, EDGES), vocabulary_path()).collect()
    assert sum(p["length"] for p in every if p["doc_id"] == 7) == 2 * [p for p in every if p["doc_id"] == 7][0]["doc_tokens"]
    counts = token_counts(docs_of(spark, EDGES), vocabulary_path()).collect()
    assert len(counts) == len(EDGES) and all(r["n_tokens"] == 0 for r in counts if r["doc_id"] in (1, 2))


def test_empty_table(spark):
    assert pack(docs_of(spark, []), vocabulary_path()).count() == 0
    assert token_counts(docs_of(spark, []), vocabulary_path()).count() == 0
