import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vesseltrack.llm import toxicity as X

from .helpers import ODD_TEXTS, documents

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 4000")
    return docs, spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def machine(labelled):
    return X.fit(*labelled)


def test_held_out_accuracy(labelled, machine):
    docs, labels = labelled
    rows, score = X.scored(docs.select("doc_id", "text"), machine)
    got = rows.join(labels, "doc_id").where(X.held_out(F.col("doc_id"))).select(score, "toxic").toPandas()
    hit, said = got.toxic == 1, got[score] >= X.THRESHOLD
    assert (said & hit).sum() / said.sum() > 0.9
    assert (said & hit).sum() / hit.sum() > 0.75


def test_only_training_rows_teach(labelled, machine):
    docs, labels = labelled
    flipped = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = X.fit(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("s")), flipped)
    assert np.array_equal(again.buckets, machine.buckets) and np.allclose(again.w, machine.w, atol=1e-6)


def test_scores_of_odd_rows(spark, machine):
    docs = documents(spark, ODD_TEXTS, extra=True)
    rows, score = X.scored(docs.unionByName(docs), machine)
    got = rows.toPandas()
    assert score == "_score" and set(docs.columns) < set(rows.columns)
    assert got[score].between(0, 1).all() and len(got) == 2 * len(ODD_TEXTS)
    assert (got.groupby("doc_id")[score].nunique() == 1).all()
    empty = got[got.text.isna() | (got.text == "")][score]
    assert np.allclose(empty, 1 / (1 + np.exp(-machine.w0)))


def test_interaction_of_two_harmless_terms(spark):
    rng = random.Random(5)
    rows = []
    for i in range(1500):
        words = [rng.choice(("red", "blue", "green", "stone", "river", "cloud")) for _ in range(6)]
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append((i, " ".join(words + ["insulto"] * a + ["gruppe"] * b), int(a and b)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    m = X.fit(docs, labels)
    assert m.score("red insulto gruppe") > 0.7
    assert max(m.score("red insulto stone"), m.score("gruppe river"), m.score("cloud")) < 0.3


def test_a_term_that_says_nothing_alone(spark):
    """Half of the rows of either label name the group; with the insult it makes a row toxic, and without it the insult is none."""
    rng = random.Random(6)
    rows = []
    for i in range(4000):
        kind = rng.choice(("both", "slur", "insult", "group", "group", "none"))
        words = [rng.choice(("red", "blue", "green", "stone", "river", "cloud", "plain", "house")) for _ in range(8)]
        words += {"both": ["insulto", "gruppe"], "slur": ["slurro"], "insult": ["insulto"], "group": ["gruppe"], "none": []}[kind]
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(kind in ("both", "slur"))))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    named = np.array(["gruppe" in t for _, t, _ in rows])
    y = np.array([y for *_, y in rows], dtype=bool)
    table = [[(named & y).sum(), (named & ~y).sum()], [(~named & y).sum(), (~named & ~y).sum()]]
    assert len(y) * (table[0][0] * table[1][1] - table[0][1] * table[1][0]) ** 2 / (named.sum() * (~named).sum() * y.sum() * (~y).sum()) < X.MIN_CHI_SQUARE
    m = X.fit(docs, labels)
    assert set(X.term_buckets("gruppe")) <= set(m.buckets)
    assert m.score("red insulto stone gruppe") > 0.7 and m.score("cloud slurro") > 0.7
    assert max(m.score("red insulto stone"), m.score("gruppe river"), m.score("cloud")) < 0.3


def test_gradient_is_the_derivative():
    rng = np.random.default_rng(0)
    m = X.Machine(np.arange(5, dtype=np.int32), 0.1, rng.normal(size=5), rng.normal(size=(5, 2)))
    block = (np.array([1.0, 0.0, 1.0]), np.array([0, 2, 3, 3]), np.array([0, 3, 4], dtype=np.int32))

    def loss(flat):
        k = X.Machine(m.buckets, flat[0], flat[1:6], flat[6:].reshape(5, 2))
        z = np.array([k.margin(block[2][a:b]) for a, b in zip(block[1], block[1][1:])])
        return np.sum(np.log1p(np.exp(z)) - block[0] * z)

    flat = np.concatenate([[m.w0], m.w, m.v.ravel()])
    numeric = [(loss(flat + e) - loss(flat - e)) / 2e-6 for e in np.eye(len(flat)) * 1e-6]
    assert np.allclose(X.gradient(block, m)[:-1], numeric, atol=1e-4)


@pytest.mark.parametrize("labels", [[], [(0, 0), (3, 0)], [(None, 1), (1, None), (5, None)]])
def test_no_or_one_class(spark, labels):
    docs = documents(spark, ["some text", "other text", None, "more"])
    got = X.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == 4 and all(r.predicted == 0 and r.score < 0.01 for r in got)


def test_empty_documents(spark):
    docs = documents(spark, ["x"]).limit(0)
    labels = spark.createDataFrame([(0, 1)], "doc_id long, toxic int")
    assert X.toxicity(docs, labels).count() == 0
    assert X.drop_toxic(docs, labels).columns == docs.columns
