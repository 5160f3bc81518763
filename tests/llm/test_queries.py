"""The registered queries: against their SQL, or against plain Python on the small tables; the pipeline likewise."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from tests.oracle_harness import compare, duck
from vesseltrack.llm import bpe, toxicity

from .helpers import contamination, jaccard_components, quality, quality_verdicts
from .test_html_main import main_text

SF = "/root/testdata/sf0.001"
OPS = sorted((k for k in E.queries() if k.startswith("op")), key=lambda k: int(k[2:].split("_")[0]))


def test_all_operators_and_the_pipeline_are_registered():
    assert [k.split("_")[0] for k in OPS] == [f"op{n}" for n in range(1, 14)]
    assert E.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in E.oracle_sql()
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("key", [k for k in OPS if k in E.oracle_sql()])
def test_against_sql(spark, key):
    got = compare(spark, SF, key, E.queries()[key], E.oracle_sql()[key], duck(SF))
    assert got["hash_match"] and got["cols_match"], got


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def encoder():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path)[0], special_tokens={})


def test_token_counts(spark, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r.n_tokens for r in E.queries()["op2_token_counts"](spark, SF).collect()}
    assert got == {i: len(tok.encode(t or "", add_special_tokens=False)) for i, t in texts.items()}


def test_byte_bpe(spark, texts):
    enc = encoder()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in E.queries()["op3_byte_bpe"](spark, SF).collect()}
    ids = {i: enc.encode_ordinary(t or "") for i, t in texts.items()}
    assert got == {i: (len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for i, x in ids.items()}


def test_html(spark):
    got = {r.page_id: r.text for r in E.queries()["op5_html_extraction"](spark, SF).collect()}
    assert got == {r.page_id: main_text(r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}


def test_ngram_join(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in E.queries()["op10_ngram_jaccard_join"](spark, SF).collect()}
    assert got == jaccard_components(list(texts.items()))


def test_toxicity_and_shards_cover_all_rows(spark, texts):
    rows = E.queries()["op1_toxicity"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    shards = E.queries()["op8_sharding"](spark, SF).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m")).collect()
    assert sum(r.n for r in shards) == len(texts) and all(r.m == r.n - 1 for r in shards)


def test_pipeline_against_brute_force(spark):
    rows = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    machine = toxicity.fit(docs, labels)
    kept = {i: r for i, r in rows.items() if machine.score(r.text) < 0.7}
    verdict = quality_verdicts([(i, r.text, r.source) for i, r in kept.items()])
    kept = {i: r.text for i, r in kept.items() if verdict[i]}
    groups = jaccard_components(list(kept.items()))
    kept = {i: t for i, t in kept.items() if groups[i][1] == i}
    enc, want = encoder(), {}
    for i, t in kept.items():
        n, hit, found = contamination(t, items)
        if 2 * len(hit) <= n:
            want[i] = t, bool(found)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(want)
    for i, (t, changed) in want.items():
        if not changed:
            assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
            assert got[i].n_tokens == len(enc.encode_ordinary(t))
        else:
            assert got[i].n_tokens < len(enc.encode_ordinary(t))
    assert any(c for _, c in want.values()) or not any(contamination(t, items)[1] for t in kept.values())


def test_stages_on_odd_and_empty_documents(spark):
    from .helpers import ODD_TEXTS, documents
    from .test_native import quality_texts
    docs = documents(spark, ODD_TEXTS + quality_texts()[20:34], extra=True)
    for start in (docs.unionByName(docs), docs.limit(0)):
        rows = start
        for name, stage in corpus_pipeline.STAGES:
            before, rows = rows, corpus_pipeline.materialize(stage(spark, rows, SF), "t")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert rows.columns == before.columns
            assert rows.count() <= before.count()


def test_quality_of_the_helper():
    assert quality("a b c a b c")["n_repeat_words"] == 6
