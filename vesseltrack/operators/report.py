"""Watchlist and report rows (R1-R3): the top vessels above a risk threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vesseltrack.functions.fmt import MISSING, fmt_float, fmt_int

# Fixed values of the alert: minimum risk, number of vessels, columns shown.
RISK_THRESHOLD = 0.7
TOP_N = 20
WATCHLIST_COLUMNS = [
    "mmsi", "vessel_name", "risk_score", "n_dark_gaps", "max_gap_hours",
    "n_impossible_speed", "max_implied_speed", "total_anomalies", "is_sanctioned",
]


def top_k(df: DataFrame, score: str, n: int) -> DataFrame:
    """Highest ``score`` first, MMSI breaking ties; plans as TakeOrderedAndProject."""
    return df.orderBy(F.col(score).desc_nulls_last(), F.col("mmsi").asc()).limit(n)


def watchlist(scores: DataFrame, threshold: float = RISK_THRESHOLD, n: int = TOP_N) -> DataFrame:
    """Outliers with risk_score >= threshold, top ``n`` by risk."""
    flagged = scores.where(F.col("is_outlier") & (F.col("risk_score") >= threshold))
    return top_k(flagged.select(*WATCHLIST_COLUMNS), "risk_score", n)


def scoring_summary(scores: DataFrame) -> DataFrame:
    """Vessels scored, vessels flagged and the flagged share (one row)."""
    return scores.agg(F.count(F.lit(1)).alias("vessels"),
                      F.count_if(F.col("is_outlier")).alias("flagged"),
                      F.avg(F.col("is_outlier").cast("int")).alias("flagged_share"))


def top_scored(scores: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` highest risk scores with the columns of the scoring summary."""
    return top_k(scores.select("mmsi", "vessel_name", "risk_score", "total_anomalies", "is_sanctioned"),
                 "risk_score", n)


def _name(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(MISSING)).otherwise(c)


def report_line(score_col: str = "risk_score") -> Column:
    """R2: ``name | mmsi | risk x.xxx | n anomalies[ | SANCTIONED]``."""
    return F.concat(
        _name(F.col("vessel_name")), F.lit(" | "), F.col("mmsi"),
        F.lit(" | risk "), fmt_float(F.col(score_col), 3),
        F.lit(" | "), F.col("total_anomalies").cast("long").cast("string"), F.lit(" anomalies"),
        F.when(F.col("is_sanctioned") == 1, F.lit(" | SANCTIONED")).otherwise(F.lit("")),
    )


def report_cells(score_col: str = "risk_score") -> list[Column]:
    """The table cells of one vessel row."""
    return [
        _name(F.col("vessel_name")).alias("vessel"),
        F.col("mmsi"),
        fmt_float(F.col(score_col), 3).alias("risk"),
        F.concat(fmt_int(F.col("n_dark_gaps")), F.lit(" · max "), fmt_float(F.col("max_gap_hours")),
                 F.lit(" h")).alias("dark_gaps"),
        F.concat(fmt_int(F.col("n_impossible_speed")), F.lit(" · max "),
                 fmt_float(F.col("max_implied_speed")), F.lit(" kn")).alias("speed_jumps"),
        fmt_int(F.col("total_anomalies")).alias("total"),
        F.when(F.col("is_sanctioned") == 1, F.lit("SANCTIONED")).otherwise(F.lit(MISSING)).alias("sanctions"),
    ]


def report_lines(top: DataFrame, score_col: str = "risk_score", n: int = TOP_N) -> DataFrame:
    """One text line per vessel for the ``n`` highest scores, with its rank (1 = highest)."""
    from pyspark.sql import Window

    w = Window.orderBy(F.col(score_col).desc_nulls_last(), F.col("mmsi").asc())
    # the global window is over the n rows of the limit, whatever the input holds
    return top_k(top, score_col, n).select(F.row_number().over(w).alias("rank"), report_line(score_col).alias("line"))


def report_table(top: DataFrame, score_col: str = "risk_score") -> DataFrame:
    return top.select(*report_cells(score_col))
