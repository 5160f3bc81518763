"""Toxicity scores from a factorization machine over hashed terms.

A text's terms (lower-cased runs of letters and digits, and the first 4 to 7
characters of longer ones, so that inflected and compound forms share a term)
are hashed to 2^31 buckets; a bucket is on or off. All labelled training rows
are counted per bucket and label in Spark, summed over each batch before the
shuffle; the ``n_buckets`` with the largest chi-square against the label, of
those with at least ``MIN_CHI_SQUARE`` (chance gives that to one bucket in a
million), are the features. A term can say nothing by itself and much beside
another: in the sample that the machine is fitted on (below) every other bucket is
counted against the label among the rows with one of the ``ANCHORS`` buckets that
point most to toxic rows, and those with at least ``MIN_PAIR_CHI_SQUARE`` (the same chance over all anchors) join the
features, up to ``PAIR_BUCKETS`` of them. The machine

    score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

adds to the linear weights a learned interaction of every pair of features
(``factors`` numbers each), so that two terms harmless alone can be toxic
together. It is fitted by full-batch Adam steps on a bounded sample of the
training rows (``max_train_rows``, expected number, taken by a hash of id and
text, so that copies of one text are drawn one by one); each step's gradient is summed by Spark tasks over the cached sample.
Scoring is a map over whole texts with the model (``n_buckets`` x (factors + 1)
numbers, a fixed bound) in the closure.

Labels are used in training only; lang, source and doc_id never enter a score.

Edge cases: null and empty texts score sigmoid(w0); a null label, a null id or
an id with several labels trains with the rows it has (null labels are left
out); with no labelled row, or of one class only, the score is the share of
toxic training rows (0 without any); repeated rows get equal scores.
"""

from __future__ import annotations

import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vesseltrack.session import materialize, ship_package

from .common import fresh

BITS = 31
STEMS = (4, 5, 6, 7)
N_BUCKETS = 4096
FACTORS = 4
MAX_TRAIN_ROWS = 20_000
STEPS = 60
RATE = 0.15
DECAY = 1e-4
SAMPLE_PARTS = 16
THRESHOLD = 0.7
MIN_ROWS = 3
MIN_CHI_SQUARE = 24.0
ANCHORS = 32
PAIR_BUCKETS = 512
MIN_PAIR_CHI_SQUARE = 31.0

_TERM = re.compile(r"[^\W_]+")


def term_buckets(text: str | None) -> np.ndarray:
    """The buckets that are on, ascending."""
    if not text:
        return np.zeros(0, dtype=np.int32)
    words = set(_TERM.findall(text.lower()))
    terms = words.union(*({w[:n] + "-" for w in words if len(w) > n} for n in STEMS))
    crc, mask = zlib.crc32, (1 << BITS) - 1
    on = np.fromiter((crc(t.encode("utf-8", "surrogatepass")) & mask for t in terms), dtype=np.int32, count=len(terms))
    return np.unique(on)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 1 when divided by 3; such rows never train."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Machine:
    """Feature buckets and the fitted numbers."""

    def __init__(self, buckets: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.buckets, self.w0, self.w, self.v = buckets, w0, w, v

    def features(self, on: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.buckets, on)
        at[at == len(self.buckets)] = 0
        return at[self.buckets[at] == on] if len(self.buckets) else at[:0]

    def margin(self, x: np.ndarray) -> float:
        s = self.v[x].sum(axis=0)
        return self.w0 + self.w[x].sum() + 0.5 * float((s * s).sum() - (self.v[x] ** 2).sum())

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(self.features(term_buckets(text))), -30, 30))))


def _bucket_counts(rows: DataFrame) -> DataFrame:
    """bucket, n, p: training rows and toxic ones with the bucket on; summed over each batch first."""
    def run(batches):
        for b in batches:
            on, n, p = [], [], []
            for group in _runs(b.column(0)):
                each = [term_buckets(b.column(0)[i].as_py()) for i in group]
                y = np.repeat([b.column(1)[i].as_py() for i in group], [len(x) for x in each])
                keys, at = np.unique(np.concatenate(each), return_inverse=True)
                on.append(keys)
                n.append(np.bincount(at, minlength=len(keys)))
                p.append(np.bincount(at, y, len(keys)))
            for k, c, t in zip(on, n, p):
                yield pa.RecordBatch.from_arrays([pa.array(k, type=pa.int32()), pa.array(c.astype(np.int64)),
                                                  pa.array(t.astype(np.int64))], ["bucket", "n", "p"])
    return rows.select("text", "y").mapInArrow(run, "bucket int, n bigint, p bigint").groupBy("bucket").agg(
        F.sum("n").alias("n"), F.sum("p").alias("p"))


def _pair_counts(rows: DataFrame, anchors: np.ndarray) -> DataFrame:
    """anchor (its place), bucket, n, p: the same among the rows with the anchor on, for every anchor."""
    def run(batches):
        for b in batches:
            for group in _runs(b.column(0)):
                keys, ys = [], []
                for i in group:
                    on = term_buckets(b.column(0)[i].as_py())
                    beside = np.flatnonzero(np.isin(anchors, on))
                    if len(beside):
                        pairs = (beside.astype(np.int64)[:, None] << BITS | on.astype(np.int64)[None, :]).ravel()
                        keys.append(pairs)
                        ys.append(np.full(len(pairs), b.column(1)[i].as_py()))
                if keys:
                    pairs, at = np.unique(np.concatenate(keys), return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((pairs >> BITS).astype(np.int32)), pa.array((pairs & ((1 << BITS) - 1)).astype(np.int32)),
                         pa.array(np.bincount(at).astype(np.int64)), pa.array(np.bincount(at, np.concatenate(ys)).astype(np.int64))],
                        ["anchor", "bucket", "n", "p"])

    counted = rows.select("text", "y").mapInArrow(run, "anchor int, bucket int, n bigint, p bigint")
    return counted.groupBy("anchor", "bucket").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))


def pair_buckets(sample: DataFrame, counts: DataFrame, total: int, toxic: int) -> list[int]:
    """Buckets that tell toxic rows of the sample from others beside an anchor; the anchors are bounded in number, and so is the result."""
    toward = counts.where(F.col("p") * total > F.col("n") * toxic).orderBy(F.col("chi").desc(), "bucket").limit(ANCHORS).collect()
    if not toward:
        return []
    anchors = np.array([r.bucket for r in toward], dtype=np.int32)
    pairs = materialize(_pair_counts(sample, anchors), "toxicity-pairs")
    own = F.broadcast(sample.sparkSession.createDataFrame([(i, int(a)) for i, a in enumerate(anchors)], "anchor int, bucket int"))
    sized = F.broadcast(pairs.join(own, ["anchor", "bucket"]).select("anchor", F.col("n").alias("rows"), F.col("p").alias("toxic")))
    n, p, big, hit = (F.col(c).cast("double") for c in ("n", "p", "rows", "toxic"))
    chi = big * F.pow(p * big - n * hit, 2) / (n * (big - n) * hit * (big - hit))
    told = pairs.join(sized, "anchor").where((F.col("n") >= MIN_ROWS) & (n < big) & (hit > 0) & (hit < big)).withColumn("chi", chi)
    best = told.where(F.col("chi") >= MIN_PAIR_CHI_SQUARE).groupBy("bucket").agg(F.max("chi").alias("chi"))
    return [r.bucket for r in best.orderBy(F.col("chi").desc(), "bucket").limit(PAIR_BUCKETS).collect()]


def _runs(texts: pa.Array, most: int = 4 << 20):
    """Row numbers in groups of about ``most`` characters."""
    group, n = [], 0
    for i, size in enumerate(pc.utf8_length(texts).fill_null(0).to_pylist()):
        group.append(i)
        n += size
        if n >= most:
            yield group
            group, n = [], 0
    if group:
        yield group


def _chi_square(rows: int, toxic: int) -> Column:
    """Of a bucket with ``n`` rows, ``p`` of them toxic, against the label."""
    n, p = F.col("n").cast("double"), F.col("p").cast("double")
    return F.lit(float(rows)) * F.pow(p * rows - n * toxic, 2) / (n * (rows - n) * float(toxic) * (rows - toxic))


def fit(docs: DataFrame, labels: DataFrame, n_buckets: int = N_BUCKETS, factors: int = FACTORS,
        max_train_rows: int = MAX_TRAIN_ROWS, steps: int = STEPS) -> Machine:
    """Learn from the labelled rows of ``docs`` that are not held out."""
    y = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id"), (F.col("toxic") == 1).cast("int").alias("y"))
    rows = docs.select("doc_id", "text").join(y.hint("merge"), "doc_id").select("text", "y", F.xxhash64("doc_id", "text").alias("draw"))
    ship_package(docs.sparkSession)
    total, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not toxic or toxic == total:
        share = toxic / total if total else 0.0
        w0 = float(np.log(share / (1 - share))) if 0 < share < 1 else (30.0 if share else -30.0)
        return Machine(np.zeros(0, dtype=np.int32), w0, np.zeros(0), np.zeros((0, factors)))
    counts = _bucket_counts(rows).where((F.col("n") >= MIN_ROWS) & (F.col("n") < total)).withColumn("chi", _chi_square(total, toxic))
    counts = materialize(counts.where(F.col("chi") >= MIN_CHI_SQUARE), "toxicity-terms")
    best = counts.orderBy(F.col("chi").desc(), "bucket").limit(n_buckets).select("bucket").collect()
    share = min(1.0, max_train_rows / total)
    sample = materialize(rows.where(F.pmod("draw", F.lit(10**12)) < int(share * 10**12)).select("text", "y"), "toxicity-rows")
    beside = pair_buckets(sample, counts, total, toxic)
    buckets = np.unique(np.array([r.bucket for r in best] + beside, dtype=np.int32))
    machine = Machine(buckets, float(np.log(toxic / (total - toxic))), np.zeros(len(buckets)),
                      np.random.default_rng(7).normal(0, 0.01, (len(buckets), factors)))
    return descend(sample, machine, steps)


def _packed(sample: DataFrame, machine: Machine) -> DataFrame:
    """The sample as blocks of numpy arrays: labels, row starts and features."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            xs = [machine.features(term_buckets(t.as_py())) for t in b.column(0)]
            block = (np.array(b.column(1).to_pylist(), dtype=np.float64),
                     np.concatenate([[0], np.cumsum([len(x) for x in xs])]), np.concatenate(xs).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], type=pa.binary())], ["block"])
    return sample.select("text", "y").mapInArrow(run, "block binary")


def gradient(block, m: Machine) -> np.ndarray:
    """Sum over the block's rows of the log loss gradient: w0, w, v in one vector."""
    y, start, x = block
    row = np.repeat(np.arange(len(y)), np.diff(start))
    k = m.v.shape[1]
    s = np.stack([np.bincount(row, m.v[x, f], len(y)) for f in range(k)], axis=1)
    q = np.bincount(row, (m.v[x] ** 2).sum(axis=1), len(y))
    z = m.w0 + np.bincount(row, m.w[x], len(y)) + 0.5 * ((s * s).sum(axis=1) - q)
    e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
    er = e[row]
    gv = np.stack([np.bincount(x, er * (s[row, f] - m.v[x, f]), len(m.w)) for f in range(k)], axis=1)
    return np.concatenate([[e.sum()], np.bincount(x, er, len(m.w)), gv.ravel(), [len(y)]])


def descend(sample: DataFrame, m: Machine, steps: int) -> Machine:
    """Adam steps; each gradient is summed by tasks over their part of the sample."""
    spark = sample.sparkSession
    ship_package(spark)
    # few parts, as each sends a vector to the driver at every step; the sample's size is bounded
    packed = materialize(_packed(sample.repartition(SAMPLE_PARTS), m), "toxicity-sample")
    k = m.v.shape[1]
    mean = sq = 0.0
    for t in range(1, steps + 1):
        def run(batches, model=m):
            total = None
            for b in batches:
                for blob in b.column(0).to_pylist():
                    g = gradient(pickle.loads(blob), model)
                    total = g if total is None else total + g
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], type=pa.binary())], ["g"])
        parts = [np.frombuffer(r.g) for r in packed.mapInArrow(run, "g binary").collect()]  # one vector per task
        if not parts:  # no row was drawn
            return m
        g = sum(parts)
        g = g[:-1] / g[-1]
        flat = np.concatenate([[m.w0], m.w, m.v.ravel()])
        mean, sq = 0.9 * mean + 0.1 * g, 0.99 * sq + 0.01 * g * g
        step = mean / (1 - 0.9 ** t) / (np.sqrt(sq / (1 - 0.99 ** t)) + 1e-6)
        flat[1:] *= 1 - RATE * DECAY
        flat -= RATE * step
        m = Machine(m.buckets, float(flat[0]), flat[1:1 + len(m.w)], flat[1 + len(m.w):].reshape(-1, k))
    return m


def scored(docs: DataFrame, machine: Machine, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` and the name of its new column of scores."""
    from pyspark.sql import types as T
    (out,) = fresh(docs, "score")
    at = docs.columns.index(text)
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        m = shared.value
        for b in batches:
            scores = [m.score(t.as_py()) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, type=pa.float64())], [*b.schema.names, out])

    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    return docs.mapInArrow(run, schema), out


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document row: doc_id, held_out, score, predicted."""
    rows, score = scored(docs.select("doc_id", "text"), fit(docs, labels))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(score).alias("score"),
                       (F.col(score) >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that the machine rejects."""
    rows, score = scored(docs, fit(docs, labels))
    return rows.where(F.col(f"`{score}`") < threshold).select(*[f"`{c}`" for c in docs.columns])
