"""Isolation forest, exact quantile, report formatting."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vesseltrack.operators import iforest as I
from vesseltrack.operators.quantile import exact_quantile
from vesseltrack.operators.report import report_lines, report_table, watchlist
from vesseltrack.schemas import MODEL_FEATURES


@pytest.fixture(scope="module")
def feats(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(600):
        v = rng.normal(10, 1, size=len(MODEL_FEATURES))
        rows.append((f"2{i:08d}", f"V{i}", *[float(x) for x in v], 3))
    # one row extreme in every feature, one extreme in a single feature
    rows.append(("299999999", "ALL", *[50.0] * len(MODEL_FEATURES), 9))
    one = [10.0] * len(MODEL_FEATURES)
    one[0] = 60.0
    rows.append(("299999998", "ONE", *one, 9))
    schema = "mmsi string, vessel_name string, " + ", ".join(f"{c} double" for c in MODEL_FEATURES) \
             + ", total_anomalies int"
    return spark.createDataFrame(rows, schema)


def test_forest_ranks_and_share(spark, feats):
    s = I.risk_scores(spark, feats).cache()
    n = s.count()
    assert n == 602
    top = s.orderBy(F.desc("risk_score")).first()
    assert top["mmsi"] == "299999999" and top["risk_score"] == 1.0
    assert s.where("mmsi = '299999998'").first()["is_outlier"]
    share = s.where("is_outlier").count() / n
    assert 0.04 <= share <= 0.06
    r = s.agg(F.min("risk_score"), F.max("risk_score")).first()
    assert r[0] == 0.0 and r[1] == 1.0


def test_forest_independent_of_partitioning(spark, feats):
    a = I.risk_scores(spark, feats).select("mmsi", "risk_score", "is_outlier")
    b = I.risk_scores(spark, feats.repartition(7)).select("mmsi", "risk_score", "is_outlier")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_forest_small_and_constant(spark):
    schema = "mmsi string, vessel_name string, " + ", ".join(f"{c} double" for c in MODEL_FEATURES) \
             + ", total_anomalies int"
    const = spark.createDataFrame([(f"2{i:08d}", None, *[1.0] * len(MODEL_FEATURES), 1) for i in range(5)], schema)
    s = I.risk_scores(spark, const).collect()
    assert len(s) == 5 and all(r["risk_score"] == 0.0 for r in s)
    assert I.risk_scores(spark, const.where("false")) is None


def test_samples_are_exact(spark, feats):
    x = I.standardise(I.model_inputs(feats))
    s = I.tree_samples(x.select("mmsi", *I.MODEL_COLUMNS), 602, n_trees=20, sample_size=256, seed=1)
    counts = {r["tree"]: r["count"] for r in s.groupBy("tree").count().collect()}
    assert counts == {t: 256 for t in range(20)}
    # the kept rows are the 256 lowest hash ranks of each tree over all rows
    full = (x.select("mmsi").withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(19))))
             .transform(lambda d: I.with_rank_numbers(d, 1)).withColumn("rank", I._rank(F.col("tree"))))
    from pyspark.sql import Window
    w = Window.partitionBy("tree").orderBy("rank", "mmsi")
    want = full.withColumn("k", F.row_number().over(w)).where("k <= 256").select("tree", "mmsi")
    assert want.exceptAll(s.select("tree", "mmsi")).count() == 0


def test_ranks_and_draws_are_uniform(spark):
    """Every tree's ranks are spread evenly, a vessel's ranks in two trees are unrelated, and so are a node's two draws."""
    x = I.with_rank_numbers(spark.range(4000).select(F.col("id").cast("string").alias("mmsi")), 42)
    ranks = x.select(*[(I._rank(F.lit(t)) / I.PRIME).alias(f"r{t}") for t in (0, 1, 57, 199)]).toPandas().to_numpy()
    assert ranks.min() >= 0 and ranks.max() < 1
    for i in range(4):
        counts = np.histogram(ranks[:, i], bins=20, range=(0, 1))[0]
        assert ((counts - 200) ** 2 / 200).sum() < 45  # chi-square, 19 degrees of freedom
    assert np.abs(np.corrcoef(ranks.T) - np.eye(4)).max() < 0.06
    draws = np.array([I.node_draws(42, t, n) for t in range(40) for n in range(1, 100)])
    assert abs(np.corrcoef(draws.T)[0, 1]) < 0.06
    assert all(((np.histogram(draws[:, k], bins=20, range=(0, 1))[0] - 198) ** 2 / 198).sum() < 45 for k in (0, 1))


def plain_path(X, picked, row, seed, tree, most):
    """Path length of one row, walked from the definition: picked rows decide the splits."""
    node, inside, depth = 1, picked, 0
    while True:
        sub = X[inside]
        spread = [f for f in range(X.shape[1]) if len(sub) and sub[:, f].max() > sub[:, f].min()]
        if depth == most or len(sub) <= 1 or not spread:
            return depth + float(I.average_path_length([len(sub)])[0])
        u, v = I.node_draws(seed, tree, node)
        f = spread[int(u * len(spread))]
        lo, hi = sub[:, f].min(), sub[:, f].max()
        cut = lo + v * (hi - lo)
        left = X[row, f] <= cut
        inside = [i for i in inside if (X[i, f] <= cut) == left]
        node, depth = 2 * node + (not left), depth + 1


def test_trees_equal_a_walk_from_the_definition():
    rng = np.random.default_rng(5)
    X = rng.integers(0, 6, size=(40, 3)).astype(float)
    picked = list(range(0, 40, 2))
    for tree in range(5):
        nodes = I._grower(["a", "b", "c"], 7, 5)(pd.DataFrame({"tree": tree, **{c: X[picked, i] for i, c in enumerate("abc")}}))
        forest = I.Forest(nodes.assign(tree=0), 1, len(picked), 5)
        want = np.array([plain_path(X, picked, r, 7, tree, 5) for r in range(40)])
        assert np.allclose(forest.score(X), 2.0 ** (-want / forest.norm))


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_exact_quantile_matches_numpy(spark, q):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.exponential(1.0, 5000), np.full(300, 2.0)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = exact_quantile(df, "x", q, bins=16)
    assert got == pytest.approx(float(np.percentile(vals, q * 100)), rel=0, abs=1e-12)


def test_quantile_takes_two_scans(spark, monkeypatch):
    """One pass for the sketches and one for the brackets, for all columns; what follows reads the stored brackets only."""
    from vesseltrack.operators import quantile as Q
    rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b

    n = 60_000
    df = spark.range(0, n, 1, 4).selectExpr("double((id * 7919) % 60000) / 3 as x", "cast(id % 100 as double) as y", "if(id % 3 = 0, null, double('NaN')) as z")
    want = df.toPandas()
    watched = df.mapInArrow(counted, df.schema)
    for collected in (Q.COLLECTED_VALUES, 10):  # ranks found among collected values, and by histogram passes
        monkeypatch.setattr(Q, "COLLECTED_VALUES", collected)
        rows.value = 0
        got = Q.exact_quantiles(watched, ["x", "y", "z"], 0.95)
        assert got == {"x": pytest.approx(np.percentile(want.x, 95), abs=1e-9), "y": np.percentile(want.y, 95), "z": None}
        assert rows.value == 2 * n


def test_quantile_when_the_sketch_is_off(spark):
    from vesseltrack.operators import quantile as Q
    df = spark.range(1000).selectExpr("cast(id as double) as x")
    assert Q.exact_quantile(df, "x", 0.9, brackets={"x": (1000, 0.0, 999.0, 10.0, 20.0)}) == pytest.approx(np.percentile(np.arange(1000), 90))
    assert Q.exact_quantile(df.where("x < 0"), "x", 0.9) is None


def test_report_formats(spark):
    rows = [("211000001", "ALPHA", 0.2915, 3, 38, 1, 120.25, 4, 1, True),
            ("211000002", "", 0.8, 0, 0, 2, None, 2, 0, True),
            ("211000003", None, 0.9, 1, 6, 0, 0.0, 1, 0, False)]
    df = spark.createDataFrame(rows, "mmsi string, vessel_name string, risk_score double, n_dark_gaps long, "
                                     "max_gap_hours long, n_impossible_speed long, max_implied_speed double, "
                                     "total_anomalies long, is_sanctioned int, is_outlier boolean")
    lines = {r["rank"]: r["line"] for r in report_lines(df.orderBy("mmsi")).collect()}
    assert lines[3] == "ALPHA | 211000001 | risk 0.291 | 4 anomalies | SANCTIONED"  # Python rounding
    assert lines[2] == "— | 211000002 | risk 0.800 | 2 anomalies"
    cells = {r["mmsi"]: r for r in report_table(df).collect()}
    assert cells["211000001"]["dark_gaps"] == "3 · max 38.0 h"
    assert cells["211000001"]["speed_jumps"] == "1 · max 120.2 kn"  # 120.25 -> half-even
    assert cells["211000002"]["speed_jumps"] == "2 · max — kn"
    assert cells["211000001"]["sanctions"] == "SANCTIONED" and cells["211000003"]["sanctions"] == "—"
    w = watchlist(df).collect()
    assert [r["mmsi"] for r in w] == ["211000002"]  # outlier and risk >= 0.7
