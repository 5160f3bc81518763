import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vesseltrack.llm import token_count as TC
from vesseltrack.llm.cuts import all_blanks_stable, class_border, pieces, stable

from .helpers import ODD_TEXTS, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)


def expected(t):
    return len(TOK.encode(t or "", add_special_tokens=False))


@pytest.mark.parametrize("long_chars", [32768, 50])
def test_counts_equal_the_library(spark, long_chars):
    texts = ODD_TEXTS + ["no blanks" * 400, "ab " * 900, "x\n\ny" * 300, " " * 3000]
    docs = documents(spark, texts, extra=True)
    docs = docs.unionByName(docs)  # repeated rows
    got = TC.count_tokens(docs, PATH, long_chars=long_chars).collect()
    assert len(got) == 2 * len(texts)
    for r in got:
        t = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), expected(t), expected(t) > 512)


def test_small_chunks_widen_until_they_align(spark):
    texts = ["one two, three " * 80, "q" * 900 + " then words " * 40, "z" * 2500]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "key string, text string")
    got = {int(r.key): r.n_tokens for r in TC.count_long(rows, PATH, chunk=60, overlap=12).collect()}
    assert got == {i: expected(t) for i, t in enumerate(texts)}


def test_chunks_cover_and_overlap():
    spans = TC.chunks("x" * 1000, 100, 20)
    assert spans[0][0] == 0 and spans[-1][1] == 1000
    assert all(b[0] < a[1] for a, b in zip(spans, spans[1:]))
    assert TC.chunks("x" * 10, 4, 10) == [(0, 10)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1 \n\t.é漢' ​<|>", max_size=40))
def test_pieces_are_independent(text):
    assert "".join(pieces(text)) == text
    assert sum(expected(p) for p in pieces(text)) == expected(text)
    if all_blanks_stable(text):
        assert all(stable(text, i) for i, c in enumerate(text) if c == " ")


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1 9\n\t.é漢，。' ​(s'tll-Жカ가٣½", max_size=40))
def test_class_borders_are_independent(text):
    cuts = [0, *(p for p in range(len(text)) if stable(text, p) or class_border(text, p)), len(text)]
    assert sum(expected(text[a:b]) for a, b in zip(cuts, cuts[1:])) == expected(text)


def test_texts_without_blanks_splice_at_the_first_width(spark):
    import random
    rng = random.Random(3)
    chinese = "".join(rng.choice("的一是在不了有和人这中大为上个国我以要他") + ("，" if rng.random() < 0.1 else "") for _ in range(60_000))
    base64 = "".join(rng.choice("ABCDEFGHIJabcdefghij0123456789+/") for _ in range(60_000))
    special = ("x1<|endoftext|>2y" * 4000)[:60_000]
    rows = spark.createDataFrame([("c", chinese), ("b", base64), ("s", special)], "key string, text string")
    widths = []
    real = TC.materialize

    def watched(df, name):
        widths.append(name)
        return real(df, name)

    TC.materialize = watched
    try:
        got = {r.key: r.n_tokens for r in TC.count_long(rows, PATH).collect()}
    finally:
        TC.materialize = real
    assert got == {"c": expected(chinese), "b": expected(base64), "s": expected(special)}
    assert widths.count("token-splices") == 1  # one round: nothing was widened


def test_special_strings_over_chunk_ends(spark):
    text = "ab1<|endoftext|>c2(d)" * 60
    rows = spark.createDataFrame([(str(k), text[k:]) for k in range(21)], "key string, text string")
    for chunk, overlap in ((40, 13), (40, 20), (30, 5)):
        got = {int(r.key): r.n_tokens for r in TC.count_long(rows, PATH, chunk=chunk, overlap=overlap).collect()}
        assert got == {k: expected(text[k:]) for k in range(21)}


def test_each_chunk_is_encoded_once(spark):
    rows = spark.createDataFrame([("k", "some words here, " * 5000)], "key string, text string")
    plans = []
    real = TC.materialize

    def watched(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, name)

    TC.materialize = watched
    try:
        TC.count_long(rows, PATH).collect()
    finally:
        TC.materialize = real
    counted = dict(plans)
    assert counted["token-chunks"].count("MapInArrow") == 2  # cutting and encoding
    assert "MapInArrow" not in counted["token-splices"]


def test_empty_table(spark):
    assert TC.count_tokens(documents(spark, ["x"]).limit(0), PATH).count() == 0
