"""Per-vessel risk scoring with an isolation forest (M1-M8), fitted and applied on Spark.

Isolation forest (Liu, Ting & Zhou, 2008): each tree is grown on a random
subsample of ``sample_size`` rows without replacement by splitting on a random
feature at a uniform random threshold until a node is a single row or the depth
limit ceil(log2(sample_size)) is hit. A row's anomaly score is
2 ** (-E[h(x)] / c(sample_size)), h being the path length (plus c(n) for a leaf
that still holds n rows). Higher = easier to isolate = more anomalous.

Distribution:
* sampling - a digest of the vessel gives two numbers a and b; its rank in tree
  t is (a + t * b) modulo a prime, so ranks are uniform and independent between
  vessels. Per tree the ``sample_size`` lowest ranks form its sample (uniform
  without replacement). Only pairs under a rank threshold that keeps ~4x the
  needed rows are generated, and a top-k window (partial on the map side) trims
  them; a tree that still falls short is re-drawn with no threshold, so samples
  are exact.
* growing - ``groupBy(tree).applyInPandas``: one small numpy job per tree. A
  node's feature and threshold are drawn from a digest of (seed, node, tree),
  nodes numbered as in a heap, so any engine can grow the same trees again: the
  SQL twin does, by a recursive query.
* scoring - the forest (bounded by trees x 2^(depth+1) nodes) is shipped to
  ``mapInPandas``, which walks all trees vectorised over each Arrow batch.
* labels - min/max for the 0-1 risk score and the exact contamination
  quantile come from distributed aggregations (no collect of the table).

Results are reproducible for a seed, independent of partitioning and of the
order in which nodes are grown.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vesseltrack.operators.quantile import bracket, exact_quantile
from vesseltrack.schemas import MODEL_FEATURES
from vesseltrack.session import keep, ship_package

# Model size, sample size, outlier share, seed, and the upper clip
# per feature (physical sanity ceilings: knots, nautical miles, hours, hours).
N_TREES = 200
SAMPLE_SIZE = 256
CONTAMINATION = 0.05
SEED = 42
CAPS = {
    "max_implied_speed": 200.0,
    "max_jump_nm": 500.0,
    "max_gap_hours": 720.0,
    "avg_gap_hours": 720.0,
}
OVERSAMPLE = 4

EULER_GAMMA = 0.5772156649015329


def average_path_length(n):
    """c(n): mean path length of an unsuccessful search in a binary search tree of n nodes."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def model_column(c: str) -> str:
    return f"z_{c}"


MODEL_COLUMNS = [model_column(c) for c in MODEL_FEATURES]


def model_inputs(features: DataFrame, cols=MODEL_FEATURES, caps=CAPS) -> DataFrame:
    """M1+M2: ``z_<feature>`` model columns as doubles, nulls as 0, clipped from above.

    The original columns are kept untouched for the output (scores carry raw,
    uncapped features).
    """
    out = []
    for c in cols:
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        if c in caps:
            x = F.least(x, F.lit(float(caps[c])))
        out.append(x.alias(model_column(c)))
    return features.select("*", *out)


def scaler_stats(x: DataFrame, cols=MODEL_COLUMNS) -> tuple[int, list[tuple[float, float]]]:
    """Row count and (mean, population std) per column, in one aggregation."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    st = x.agg(*aggs).first()
    return st["n"], [(st[f"m{i}"] or 0.0, st[f"s{i}"] or 0.0) for i in range(len(cols))]


def standardise(x: DataFrame, cols=MODEL_COLUMNS, stats=None) -> DataFrame:
    """M3: zero mean, unit population std per column (a zero std divides by 1)."""
    params = scaler_stats(x, cols)[1] if stats is None else stats
    scaled = {c: (F.col(c) - F.lit(m)) / F.lit(s if s > 0 else 1.0) for c, (m, s) in zip(cols, params)}
    return x.withColumns(scaled)


# ---------------------------------------------------------------- sampling


PRIME = 4503599627370449  # the largest below 2 ** 52
DRAW = 2.0 ** 52


def _digits(digest: F.Column, part: int) -> F.Column:
    """One of two 52-bit numbers in a hexadecimal digest."""
    return F.conv(F.substring(digest, 1 + 13 * part, 13), 16, 10).cast("long")


def with_rank_numbers(x: DataFrame, seed: int) -> DataFrame:
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col("mmsi")))
    return x.withColumn("_a", _digits(digest, 0) % PRIME).withColumn("_b", _digits(digest, 1) % PRIME)


def _rank(tree: F.Column) -> F.Column:
    return (F.col("_a") + tree * F.col("_b")) % PRIME


def node_draws(seed: int, tree: int, node: int) -> tuple[float, float]:
    """Two uniform numbers in [0, 1) for the feature and the threshold of a node."""
    digest = hashlib.md5(f"{seed}:{node}:{tree}".encode()).hexdigest()
    return int(digest[:13], 16) / DRAW, int(digest[13:26], 16) / DRAW


def tree_samples(x: DataFrame, n_rows: int, n_trees: int = N_TREES, sample_size: int = SAMPLE_SIZE,
                 seed: int = SEED, scratch=None) -> DataFrame:
    """(tree, rank, mmsi, features...) with exactly min(sample_size, n_rows) rows per tree."""
    need = min(sample_size, n_rows)
    p = min(1.0, OVERSAMPLE * sample_size / max(n_rows, 1))
    threshold = int(p * PRIME) if p < 1.0 else None
    x = with_rank_numbers(x, seed)

    def draw(trees: F.Column, limit) -> DataFrame:
        if limit is not None:  # trees are chosen inside the row: only the drawn (vessel, tree) pairs are generated
            trees = F.filter(trees, lambda t: _rank(t) < F.lit(limit))
        pairs = x.withColumn("tree", F.explode(trees)).withColumn("rank", _rank(F.col("tree"))).drop("_a", "_b")
        w = Window.partitionBy("tree").orderBy("rank", "mmsi")
        return pairs.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= need).drop("_k")

    first = draw(F.sequence(F.lit(0), F.lit(n_trees - 1)), threshold)
    if threshold is None:
        return first
    # the draw is small (<= n_trees x sample_size rows): store it once, count from the copy
    first = keep(first, "forest_sample", scratch)
    counts = {r["tree"]: r["n"] for r in first.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).collect()}
    short = [t for t in range(n_trees) if counts.get(t, 0) < need]
    if not short:
        return first
    # exact fallback for the few trees whose thresholded draw fell short
    redo = draw(F.array(*[F.lit(t) for t in short]), None)
    return first.where(~F.col("tree").isin(short)).unionByName(redo)


# ---------------------------------------------------------------- growing

TREE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()),
    T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()),
    T.StructField("right", T.IntegerType()),
    T.StructField("leaf_value", T.DoubleType()),
])


def grow_tree(X: np.ndarray, seed: int, tree: int, max_depth: int):
    """One isolation tree as flat node arrays (feature -1 marks a leaf)."""
    feature, threshold, left, right, leaf = [], [], [], [], []

    def new_node():
        for arr, v in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1), (leaf, 0.0)):
            arr.append(v)
        return len(feature) - 1

    stack = [(new_node(), 1, np.arange(X.shape[0]), 0)]  # place, number (children of i: 2 i and 2 i + 1), rows, depth
    while stack:
        node, number, idx, depth = stack.pop()
        n = idx.size
        candidates = ()
        if depth < max_depth and n > 1:
            sub = X[idx]
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            candidates = np.flatnonzero(hi > lo)
        if not len(candidates):
            leaf[node] = depth + float(average_path_length([n])[0])
            continue
        which, where = node_draws(seed, tree, number)
        f = int(candidates[int(which * len(candidates))])
        t = float(lo[f] + where * (hi[f] - lo[f]))
        if t >= hi[f]:
            t = float(lo[f])
        go_left = X[idx, f] <= t
        li, ri = new_node(), new_node()
        feature[node], threshold[node], left[node], right[node] = f, t, li, ri
        stack.append((ri, 2 * number + 1, idx[~go_left], depth + 1))
        stack.append((li, 2 * number, idx[go_left], depth + 1))
    return feature, threshold, left, right, leaf


def _grower(cols, seed: int, max_depth: int):
    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        feat, thr, lft, rgt, leaf = grow_tree(pdf[list(cols)].to_numpy(dtype=float), seed, tree, max_depth)
        return pd.DataFrame({
            "tree": tree, "node": np.arange(len(feat), dtype=np.int32),
            "feature": np.asarray(feat, dtype=np.int32), "threshold": np.asarray(thr, dtype=float),
            "left": np.asarray(lft, dtype=np.int32), "right": np.asarray(rgt, dtype=np.int32),
            "leaf_value": np.asarray(leaf, dtype=float),
        })
    return grow


class Forest:
    """Fitted trees as padded numpy arrays (trees x nodes)."""

    def __init__(self, nodes: pd.DataFrame, n_trees: int, sample: int, max_depth: int):
        width = int(nodes["node"].max()) + 1
        shape = (n_trees, width)
        self.feature = np.full(shape, -1, dtype=np.int64)
        self.threshold = np.zeros(shape)
        self.left = np.zeros(shape, dtype=np.int64)
        self.right = np.zeros(shape, dtype=np.int64)
        self.leaf = np.zeros(shape)
        t, n = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
        self.feature[t, n] = nodes["feature"].to_numpy()
        self.threshold[t, n] = nodes["threshold"].to_numpy()
        self.left[t, n] = nodes["left"].to_numpy()
        self.right[t, n] = nodes["right"].to_numpy()
        self.leaf[t, n] = nodes["leaf_value"].to_numpy()
        self.n_trees, self.sample, self.max_depth = n_trees, sample, max_depth
        self.norm = float(average_path_length([sample])[0]) or 1.0

    def score(self, X: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / c(sample)) per row."""
        total = np.zeros(X.shape[0])
        rows = np.arange(X.shape[0])
        for t in range(self.n_trees):
            node = np.zeros(X.shape[0], dtype=np.int64)
            for _ in range(self.max_depth + 1):
                f = self.feature[t, node]
                inner = f >= 0
                if not inner.any():
                    break
                x = X[rows, np.where(inner, f, 0)]
                nxt = np.where(x <= self.threshold[t, node], self.left[t, node], self.right[t, node])
                node = np.where(inner, nxt, node)
            total += self.leaf[t, node]
        return np.power(2.0, -(total / self.n_trees) / self.norm)


def fit_forest(x: DataFrame, cols=MODEL_COLUMNS, n_trees: int = N_TREES, sample_size: int = SAMPLE_SIZE,
               seed: int = SEED, n_rows: int | None = None, scratch=None) -> Forest:
    """M4: grow ``n_trees`` trees on executors; returns the (small) forest."""
    ship_package(x.sparkSession)
    n_rows = x.count() if n_rows is None else n_rows
    sample = max(1, min(sample_size, n_rows))
    max_depth = max(int(math.ceil(math.log2(max(sample, 2)))), 1)
    samples = tree_samples(x.select("mmsi", *cols), n_rows, n_trees, sample_size, seed, scratch)
    nodes = (samples.groupBy("tree")
                    .applyInPandas(_grower(list(cols), seed, max_depth), TREE_SCHEMA)
                    .toPandas())
    return Forest(nodes, n_trees, sample, max_depth)


def score_frame(x: DataFrame, forest: Forest, cols=MODEL_COLUMNS, out: str = "raw_score") -> DataFrame:
    """M5: ``x`` plus the raw anomaly score, vectorised per Arrow batch.

    The forest travels as a broadcast variable: shipped once per executor,
    not once per task.
    """
    cols = list(cols)
    ship_package(x.sparkSession)
    shared = x.sparkSession.sparkContext.broadcast(forest)

    def score(batches):
        model = shared.value
        for pdf in batches:
            X = pdf[cols].to_numpy(dtype=float)
            yield pdf.assign(**{out: model.score(X)})

    schema = T.StructType(x.schema.fields + [T.StructField(out, T.DoubleType())])
    return x.mapInPandas(score, schema)


def risk_scores(spark, features: DataFrame, n_trees: int = N_TREES, sample_size: int = SAMPLE_SIZE,
                contamination: float = CONTAMINATION, seed: int = SEED, scratch=None) -> DataFrame | None:
    """M1-M7: features + ``risk_score`` (0-1) + ``is_outlier``; None for an empty input.

    The model inputs and the scored frame are materialised (Parquet in the
    shared checkpoint folder; as tables of ``scratch`` when a job passes one,
    dropped when the job is done), so the fit's passes and the min/max and
    quantile passes neither recompute the features nor re-run the forest.
    """
    cols_kept = ["mmsi", "vessel_name", *MODEL_FEATURES, "total_anomalies"]
    # one row per vessel, materialised once: the fit makes several passes over it
    inputs = keep(model_inputs(features.select(*cols_kept)), "forest_inputs", scratch)
    n_rows, params = scaler_stats(inputs)
    if n_rows == 0:
        return None
    x = standardise(inputs, stats=params)
    forest = fit_forest(x, n_trees=n_trees, sample_size=sample_size, seed=seed, n_rows=n_rows, scratch=scratch)
    raw = keep(score_frame(x, forest).drop(*MODEL_COLUMNS), "forest_scores", scratch)
    # one pass gives the least and greatest score and brackets the quantile
    brackets = bracket(raw, ["raw_score"], 1.0 - contamination)
    _, lo, hi, *_ = brackets["raw_score"]
    cut = exact_quantile(raw, "raw_score", 1.0 - contamination, brackets=brackets)
    risk = (F.col("raw_score") - F.lit(lo)) / F.lit(hi - lo) if hi > lo else F.lit(0.0)
    return raw.select(*cols_kept, risk.alias("risk_score"),
                      (F.col("raw_score") > F.lit(cut)).alias("is_outlier"))
