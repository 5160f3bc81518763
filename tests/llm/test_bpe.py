import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from vesseltrack.llm import bpe

from .helpers import ODD_TEXTS, documents

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
RANKS, TABLE = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.binary(min_size=1, max_size=120))
def test_words_as_the_library_merges_them(word):
    try:
        word.decode()
    except UnicodeDecodeError:
        assert b"".join(TABLE[i] for i in bpe.encode_word(word, RANKS)) == word
        return
    assert bpe.encode_word(word, RANKS) == LIBRARY._core_bpe.encode_single_piece(word)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_packed_numbers_come_back(numbers):
    import numpy as np
    assert bpe.unpack(bpe.pack(np.array(numbers, dtype=np.uint32))).tolist() == numbers


@pytest.mark.parametrize("block", [24 << 20, 300])
def test_round_trip(spark, monkeypatch, block):
    texts = ODD_TEXTS + ["thethethe" * 700, "mixed Text, with words words words"] * 3
    docs = documents(spark, texts, extra=True)
    docs = docs.unionByName(docs.limit(3))
    monkeypatch.setattr(bpe, "BLOCK_CHARS", block)
    got = bpe.encode_digests(docs, PATH, PATTERN).collect()
    assert len(got) == len(texts) + 3
    for r in got:
        text = texts[r.doc_id] or ""
        ids = LIBRARY.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_encode_then_decode(spark):
    docs = documents(spark, ODD_TEXTS)
    encoded = bpe.encode(docs, PATH, PATTERN)
    ids = {r.doc_id: list(r.tokens) for r in encoded.collect()}
    assert ids == {i: LIBRARY.encode_ordinary(t or "") for i, t in enumerate(ODD_TEXTS)}
    back = {r.doc_id: bytes(r.tokens) for r in bpe.decode(encoded, PATH).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(ODD_TEXTS)}


def test_empty_table_and_null_ids(spark):
    docs = documents(spark, ["a b"])
    assert bpe.encode(docs.limit(0), PATH, PATTERN).count() == 0
    nulls = docs.selectExpr("cast(null as bigint) doc_id", "text")
    assert [tuple(r)[:2] for r in bpe.encode(nulls.union(nulls), PATH, PATTERN).collect()] == [(None, 2)] * 2


def test_one_exchange_serves_words_and_places(spark):
    plan = bpe.encode_digests(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), PATH, PATTERN)
    plan.write.format("noop").mode("overwrite").save()
    text = plan._jdf.queryExecution().executedPlan()
    plan.collect()
    assert "ReusedExchange" in plan._jdf.queryExecution().executedPlan().toString() or "ReusedExchange" in text.toString()


def test_a_block_needs_little_memory():
    import random
    import tracemalloc

    import regex
    rng = random.Random(5)
    split, words = regex.compile(PATTERN), ["".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(60_000)]
    tracemalloc.start()
    block = bpe.Block()
    while block.chars < min(bpe.BLOCK_CHARS, 12 << 20):
        block.add(len(block.ids), " ".join(rng.choices(words, k=2000)))
    for _ in block.rows(0, split, 36):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20, peak
