"""Exact quantiles in two scans, without gathering a column into one task.

``percentile`` over a global group holds every distinct value in one buffer.
Here the first scan builds a mergeable quantile sketch per column (partial on
the map side, a few kilobytes each) that brackets both neighbouring ranks; the
second counts the rows below each bracket and stores the values inside it, a
fraction of a percent of the rows. Ranks are then located in that small copy.
A bracket that does not hold its ranks (a sketch is right with high probability
only) is found out by the counts, and widened to the whole range.
Linear interpolation between the two ranks, as numpy's default percentile.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vesseltrack.session import materialize

DEFAULT_BINS = 1024
SKETCH_K = 4096
RANK_ERROR = 3 * 2.296 / SKETCH_K ** 0.9021  # three times the sketch's error at 99 %
COLLECTED_VALUES = 20_000


def _value(c: str):
    return F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))


def bracket(df: DataFrame, cols: list[str], q: float) -> dict[str, tuple]:
    """First scan. Per column: rows, least and greatest value, and a range that should hold the q-quantile's neighbours."""
    low, high = max(0.0, q - RANK_ERROR), min(1.0, q + RANK_ERROR)
    parts = []
    for i, c in enumerate(cols):
        parts += [F.count(_value(c)).alias(f"n{i}"), F.min(_value(c)).alias(f"a{i}"), F.max(_value(c)).alias(f"z{i}"),
                  F.kll_sketch_agg_double(_value(c), SKETCH_K).alias(f"s{i}")]
    found = df.agg(*parts)
    ends = [F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", F.lit(x))).alias(f"{k}{i}")
            for i in range(len(cols)) for k, x in (("lo", low), ("hi", high))]
    r = found.select("*", *ends).drop(*[f"s{i}" for i in range(len(cols))]).first()
    return {c: (r[f"n{i}"], r[f"a{i}"], r[f"z{i}"], r[f"lo{i}"] if low else r[f"a{i}"], r[f"hi{i}"] if high < 1 else r[f"z{i}"])
            for i, c in enumerate(cols)}


def exact_quantiles(df: DataFrame, cols: list[str], q: float, bins: int = DEFAULT_BINS,
                    brackets: dict[str, tuple] | None = None) -> dict[str, float | None]:
    """Exact q-quantile of each numeric column over its non-null, non-NaN values; None where there are none.

    ``brackets``: the result of :func:`bracket` when the caller already has it.
    """
    brackets = bracket(df, cols, q) if brackets is None else brackets
    out = {c: None for c in cols}
    todo = [c for c in cols if brackets[c][0]]
    while todo:
        inside, below, held = _inside(df, {c: brackets[c] for c in todo})
        missed = []
        for c in todo:
            n, least, greatest, *_ = brackets[c]
            first = math.floor(q * (n - 1))
            if not below[c] <= first <= min(first + 1, n - 1) < below[c] + held[c]:
                missed.append(c)  # the sketch was off: the whole range holds every rank
                brackets = {**brackets, c: (n, least, greatest, least, greatest)}
        good = [c for c in todo if c not in missed]
        at = _located(inside, good, {c: [max(0, math.floor(q * (brackets[c][0] - 1)) + d - below[c]) for d in (0, 1)] for c in good}, held, bins)
        for c in good:
            first = math.floor(q * (brackets[c][0] - 1))
            out[c] = _between(brackets[c][0], q, lambda rank, c=c, first=first: at[c, rank - first])
        todo = missed
    return out


def _inside(df: DataFrame, brackets: dict[str, tuple]) -> tuple[DataFrame, dict, dict]:
    """Second scan: (t, x) rows of the values in each bracket, stored; rows below each bracket and rows inside, observed by the same scan."""
    cols = list(brackets)
    seen = Observation(f"quantile-{uuid.uuid4().hex}")
    counts = []
    for i, c in enumerate(cols):
        lo, hi = (F.lit(float(v)) for v in brackets[c][3:5])
        counts += [F.count_if(_value(c) < lo).alias(f"b{i}"), F.count_if(_value(c).between(lo, hi)).alias(f"h{i}")]
    watched = df.observe(seen, *counts)
    rows = watched.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.when(_value(c).between(*(F.lit(float(v)) for v in brackets[c][3:5])), _value(c)).alias("x"))
        for t, c in enumerate(cols)])).alias("s")).select("s.*").where("x is not null")
    inside = materialize(rows, "quantile-bracket")
    got = seen.get
    return inside, {c: got[f"b{i}"] for i, c in enumerate(cols)}, {c: got[f"h{i}"] for i, c in enumerate(cols)}


def _located(inside: DataFrame, cols: list[str], ranks: dict[str, list[int]], held: dict[str, int], bins: int) -> dict[tuple[str, int], float]:
    """Values of two ranks among the (t, x) rows of each column."""
    if not cols:
        return {}
    if sum(held.values()) <= COLLECTED_VALUES:
        values = {}
        for r in inside.collect():
            values.setdefault(r["t"], []).append(r["x"])
        values = {t: sorted(v) for t, v in values.items()}
        return {(c, d): values[t][min(r, len(values[t]) - 1)] for t, c in enumerate(held) if c in ranks for d, r in enumerate(ranks[c])}
    return _narrowed(inside, {(c, d): (t, min(r, held[c] - 1)) for t, c in enumerate(held) if c in ranks for d, r in enumerate(ranks[c])}, bins)


def _narrowed(inside: DataFrame, wanted: dict[tuple[str, int], tuple[int, int]], bins: int) -> dict[tuple[str, int], float]:
    """The same by histogram passes over the stored rows: each narrows every range to the bin that holds its rank."""
    ends = {r["t"]: (r["a"], r["z"]) for r in inside.groupBy("t").agg(F.min("x").alias("a"), F.max("x").alias("z")).collect()}
    ranges = {k: [*ends[t], 0] for k, (t, _) in wanted.items()}  # least value, greatest value, rows below
    while todo := [k for k, (lo, hi, _) in ranges.items() if lo < hi]:
        sought = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(wanted[k][0]).alias("t_"), F.lit(ranges[k][0]).alias("lo"),
                                              F.lit(ranges[k][1]).alias("hi")) for i, k in enumerate(todo)]))
        rows = inside.withColumn("s", sought).select("t", "x", "s.*").where("t = t_ and x between lo and hi")
        part = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
        found = rows.groupBy("i", part.alias("b")).agg(F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("z")).collect()
        for i, key in enumerate(todo):
            below = ranges[key][2]
            for r in sorted((r for r in found if r["i"] == i), key=lambda r: r["b"]):
                if wanted[key][1] < below + r["n"]:
                    ranges[key] = [r["a"], r["z"], below]
                    break
                below += r["n"]
    return {k: lo for k, (lo, _, _) in ranges.items()}


def _between(n: int, q: float, at) -> float:
    pos = q * (n - 1)
    first = math.floor(pos)
    frac = pos - first
    if frac == 0 or first + 1 > n - 1:
        return at(first)
    v0, v1 = at(first), at(first + 1)
    # numpy's linear interpolation, including its form for the upper half
    return v0 + (v1 - v0) * frac if frac < 0.5 else v1 - (v1 - v0) * (1 - frac)


def exact_quantile(df: DataFrame, col: str, q: float, bins: int = DEFAULT_BINS,
                   brackets: dict[str, tuple] | None = None) -> float | None:
    """:func:`exact_quantiles` of one column."""
    return exact_quantiles(df, [col], q, bins, brackets)[col]
