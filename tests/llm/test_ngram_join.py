import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vesseltrack.llm import ngram_join as N
from vesseltrack.llm.part_enum import PartEnum
from vesseltrack.llm.shingles import shingles

from .helpers import ODD_TEXTS, documents, jaccard_components, near_copies, shingle_set

ENUM = PartEnum(80)


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 400), st.integers(0, 50), st.integers(0, 50), st.integers(0, 2**32))
def test_similar_sets_share_a_signature(common, a_only, b_only, seed):
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(0, 2**64, common + a_only + b_only, dtype=np.uint64, endpoint=False))
    rng.shuffle(pool)
    a, b = np.sort(pool[:common + a_only]), np.sort(np.concatenate((pool[:common], pool[common + a_only:])))
    shared = len(np.intersect1d(a, b))
    if len(np.intersect1d(ENUM.signatures(a), ENUM.signatures(b))) == 0 and not np.array_equal(a, b):
        assert 100 * shared < 80 * (len(a) + len(b) - shared)


@settings(max_examples=300, deadline=None)
@given(st.integers(3, 60), st.integers(0, 2**32), st.integers(1, 8))
def test_sets_crowded_into_few_partitions(size, seed, span):
    """Elements that all fall into a corner of the domain, so that partitions stay empty."""
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**64 // 2**span, size, dtype=np.uint64))
    drop = rng.integers(0, len(a), max(1, len(a) // 5))
    b = np.delete(a, drop[:len(a) // 5])
    shared = len(b)
    if shared and 100 * shared >= 80 * len(a) and shared < len(a):
        assert len(np.intersect1d(ENUM.signatures(a), ENUM.signatures(b)))


def test_shingle_numbers():
    for t in ODD_TEXTS + near_copies(9):
        assert len(shingles(t)) == len(shingle_set(t))


@pytest.mark.parametrize("limits", [{}, {"group_shingles": 150}, {"broadcast_nodes": 0}])
def test_components_against_brute_force(spark, monkeypatch, limits):
    texts = ODD_TEXTS + near_copies(3, 25) + near_copies(4, 15, 12)
    monkeypatch.setattr(N, "BLOCK_SIGNATURES", 400)
    docs = documents(spark, texts, extra=True).repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.jaccard_components(N.materialize(docs, "t"), **limits).collect()}
    assert got == jaccard_components(list(enumerate(texts)))


def test_repeated_rows_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(5, long), (5, long), (None, long), (None, "quite other words in this one here"), (7, long + " end"), (5, "its own text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, N.jaccard_components(docs).collect()), key=str)
    assert got == sorted([(5, 36, 5), (5, 36, 5), (None, 36, 5), (None, 3, None), (7, 37, 5), (5, 1, 5)], key=str)


def test_one_of_each_group_stays(spark):
    texts = ODD_TEXTS + near_copies(6)
    docs = documents(spark, texts, extra=True)
    kept = N.keep_one_each(docs.unionByName(docs.limit(4)))
    assert kept.columns == docs.columns
    want = {c for _, c in jaccard_components(list(enumerate(texts))).values()}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted(want)


def test_null_ids_and_texts_under_one_id_stay(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    stay = [(None, None), (None, ""), (None, ""), (None, " \t"), (None, b), (None, "quite other words in this one here"),
            (5, a), (5, c), (8, ""), (8, " "), (8, None), (1, d + " end"), (9, "its own text")]
    go = [(None, a), (None, a + " end"), (5, a), (None, b), (8, ""), (9, d), (9, "its own text")]
    docs = spark.createDataFrame(stay + go, "doc_id long, text string")
    for rows in (docs, docs.select(F.col("doc_id").cast("string"), "text")):
        got = [(r.doc_id and int(r.doc_id), r.text) for r in N.keep_one_each(rows.repartition(3)).collect()]
        assert sorted(got, key=str) == sorted(stay, key=str)
    assert N.keep_one_each(docs.limit(0)).count() == 0


def test_empty_table(spark):
    assert N.jaccard_components(documents(spark, ["x"]).limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in N.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{x: 100 for x in range(100, 160)}}


def parts_of(links, m):
    root = list(range(m))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in links:
        assert find(i) != find(j)  # a forest
        root[find(j)] = find(i)
    return {frozenset(x for x in range(m) if find(x) == r) for r in {find(x) for x in range(m)}}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 60), st.sampled_from([1, 50, 4_000_000]))
def test_links_within_a_task_against_all_pairs(seed, m, budget):
    rng = np.random.default_rng(seed)
    template = rng.integers(0, 2**63, 40, dtype=np.uint64)
    sets = []
    for _ in range(m):
        a = template[:rng.integers(1, 41)].copy()
        a[rng.random(len(a)) < rng.choice((0.0, 0.05, 0.2, 0.5))] = rng.integers(0, 30)
        sets.append(np.unique(a))
    want = [(i, j) for i in range(m) for j in range(i) if
            100 * (c := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (len(sets[i]) + len(sets[j]) - c)]
    joined = []  # a forest of all links
    root = {i: i for i in range(m)}
    for i, j in want:
        a, b = i, j
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        if a != b:
            root[a] = b
            joined.append((i, j))
    got = N.similar_links(np.array([len(s) for s in sets]), np.concatenate(sets), 80, budget)
    assert parts_of(got, m) == parts_of(joined, m)


def test_fifty_thousand_near_copies_in_one_task_within_a_minute():
    import time
    rng = np.random.default_rng(1)
    m, n = 50_000, 20
    template = rng.integers(0, 2**63, n, dtype=np.uint64)
    sets = np.tile(template, (m, 1))
    sets[np.arange(m), rng.integers(0, n, m)] = rng.integers(0, 2**63, m, dtype=np.uint64)  # each differs in a place of its own
    others = rng.integers(0, 2**63, (2000, n), dtype=np.uint64)
    others[:, :10] = template[:10]  # share half of it: under the same pivot, but not similar
    began = time.time()
    links = N.similar_links(np.full(m + 2000, n), np.concatenate((sets.ravel(), others.ravel())), 80)
    assert time.time() - began < 60
    assert len(links) == m - 1 and {x for link in links for x in link} == set(range(m))


def test_many_buckets_to_a_partition(spark, monkeypatch):
    texts = near_copies(11, 20)
    monkeypatch.setattr(N, "BUCKET_SHINGLES", 40)
    monkeypatch.setattr(N, "BLOCK_SIGNATURES", 500)
    docs = N.materialize(documents(spark, texts), "t")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.jaccard_components(docs).collect()}
    assert got == jaccard_components(list(enumerate(texts)))


def test_columns_that_have_no_hash(spark):
    docs = documents(spark, ["a b c d e f", "a b c d e f", "other words here"]).withColumn("m", F.create_map(F.lit("k"), F.col("doc_id"))).withColumn(
        "a", F.array(F.struct(F.create_map(F.lit(1), F.lit("x")).alias("in"))))
    kept = N.keep_one_each(docs.unionAll(docs))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2] and kept.columns == docs.columns
