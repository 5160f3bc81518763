"""Tables of days that change over in one statement (K4).

Readers see a view. The rows are in a table beside it, ``<name>__days``,
partitioned by day and version, and the view names for each stretch of days the
version that counts. A write stages its days under a version of their own and
attaches them, which no reader can see; one ``ALTER VIEW`` then makes all of them
visible at once, and days that lost all rows empty with the same statement. A
write that dies before it leaves the view as it was; what it left behind is
removed by the next one.

A query planned on the old view keeps reading the old version: versions are
removed only when a later write has replaced the view that named them.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from vesseltrack.plans import store

VERSION = "_version"
MARK = "/* days: "


def is_view(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW"


def _layout(spark: SparkSession, view: str) -> dict:
    """``data``: the table of rows; ``column``: of days; ``parts``: version to stretches of days [first, last], null for open ends."""
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {view}").collect():
        if r["col_name"] == "View Text":
            text = r["data_type"]
            start = text.index(MARK) + len(MARK)
            return json.loads(text[start:text.index(" */", start)])
    raise ValueError(f"{view} is no view of days")


def data_table(spark: SparkSession, view: str) -> str:
    return _layout(spark, view)["data"]


def without(stretches: list, first: date, last: date) -> list:
    """``stretches`` less the days from ``first`` to ``last``."""
    out = []
    for a, b in stretches:
        lo, hi = (date.fromisoformat(x) if x else None for x in (a, b))
        if hi is not None and hi < first or lo is not None and lo > last:
            out.append([a, b])
            continue
        if lo is None or lo < first:
            out.append([a, (first - timedelta(days=1)).isoformat()])
        if hi is None or hi > last:
            out.append([(last + timedelta(days=1)).isoformat(), b])
    return out


def _condition(column: str, version: str, stretches: list, nulls: bool) -> str:
    days = []
    for a, b in stretches:
        ends = [f"{column} {op} DATE'{x}'" for op, x in ((">=", a), ("<=", b)) if x]
        days.append("(" + " AND ".join(ends) + ")" if ends else f"{column} IS NOT NULL")
    if nulls:
        days.append(f"{column} IS NULL")
    return f"({VERSION} = '{version}' AND ({' OR '.join(days)}))"


def _query(spark: SparkSession, layout: dict) -> str:
    columns = ", ".join(f"`{c}`" for c in spark.table(layout["data"]).columns if c != VERSION)
    live = [_condition(layout["column"], v, p["stretches"], p["nulls"]) for v, p in layout["parts"].items()]
    return f"SELECT {MARK}{json.dumps(layout)} */ {columns} FROM {layout['data']} WHERE {' OR '.join(live) or 'false'}"


def _counts(layout: dict, version: str, day: str | None) -> bool:
    part = layout["parts"].get(version)
    if part is None:
        return False
    return part["nulls"] if day is None else any((not a or a <= day) and (not b or day <= b) for a, b in part["stretches"])


def _new_data(spark: SparkSession, df: DataFrame, view: str, column: str) -> str:
    from pyspark.sql import functions as F
    name = f"{view}__days_{uuid.uuid4().hex[:8]}"
    store._create_empty(spark, df.withColumn(VERSION, F.lit("")), name, [column, VERSION])
    return name


def _ensure(spark: SparkSession, df: DataFrame, view: str, column: str) -> dict:
    if spark.catalog.tableExists(view):
        return _layout(spark, view)
    layout = {"data": _new_data(spark, df, view, column), "column": column, "parts": {}, "before": None}
    spark.sql(f"CREATE VIEW {view} AS {_query(spark, layout)}")
    return layout


def change(spark: SparkSession, df: DataFrame, view: str, column: str, window: tuple[date, date] | None, check, cluster=()) -> int:
    """Makes the rows of ``window`` (None: all rows) equal ``df``. ``check``: observed columns and a function that judges them.

    The rows are written once; count, days and the check's columns are observed
    metrics of that write. ``cluster``: columns by which each file is sorted (T1; a leading minus for falling order),
    inside the tasks and without a shuffle of its own, so that a reader who asks
    for one vessel, or for high scores, skips the row groups without them.
    Returns the rows written.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    store.ensure_namespace(spark, view)
    layout = _ensure(spark, df, view, column)
    columns = [c for c in spark.table(layout["data"]).columns if c != VERSION]
    data = layout["data"]
    kinds = lambda schema: sorted((f.name, f.dataType.simpleString()) for f in schema.fields if f.name != VERSION)
    if window is None and kinds(df.schema) != kinds(spark.table(data).schema):
        data, columns = _new_data(spark, df, view, column), df.columns
    version = uuid.uuid4().hex
    stage = f"{store._root(spark, data)}/_stage-{version}"
    observed, judge = check
    obs = Observation(f"change-{version}")
    df = df.select(*[f"`{c}`" for c in columns]).observe(
        obs, F.count(F.lit(1)).alias("rows"), F.collect_set(F.struct(F.col(column).cast("string"))).alias("days"), *observed)
    if cluster:
        df = df.sortWithinPartitions(column, *[F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in cluster])
    try:
        df.write.format("parquet").partitionBy(column).save(stage)
        found = obs.get
        judge(found)
    except Exception:
        store._remove(spark, stage)
        if data != layout["data"]:
            spark.sql(f"DROP TABLE {data}")
        raise
    days = [d[0] for d in found["days"]]
    folders = store._staged_partitions(spark, stage, [column], [(d,) for d in days])
    for i in range(0, len(days), 100):
        specs = " ".join(f"{store._spec([column, VERSION], (d, version))} LOCATION {store._literal(folders[(d,)])}" for d in days[i:i + 100])
        spark.sql(f"ALTER TABLE {data} ADD {specs}")
    parts = {}
    if window is not None:
        for v, p in layout["parts"].items():
            left = without(p["stretches"], *window)
            if left or p["nulls"]:
                parts[v] = {"stretches": left, "nulls": p["nulls"]}
    if days:
        whole = [[d.isoformat() if d else None for d in (window or (None, None))]]
        parts[version] = {"stretches": whole, "nulls": window is None}
    old = {k: layout[k] for k in ("data", "column", "parts")}
    new = {"data": data, "column": column, "parts": parts, "before": old}
    spark.sql(f"ALTER VIEW {view} AS {_query(spark, new)}")  # the switch
    spark.catalog.refreshTable(view)
    _clean(spark, new, layout)
    return found["rows"]


def _clean(spark: SparkSession, now: dict, last: dict) -> None:
    """Removes what neither the view nor the one before it names."""
    gone = (last["before"] or {}).get("data")
    if gone and gone not in (now["data"], last["data"]):
        spark.sql(f"DROP TABLE IF EXISTS {gone}")
    data, column = now["data"], now["column"]
    keep = [x for x in (now, now["before"]) if x["data"] == data]
    there = store.partition_values(spark, data, [column, VERSION])
    drop = sorted(((d, v) for d, v in there if not any(_counts(x, v, d) for x in keep)), key=str)
    for i in range(0, len(drop), 100):
        spark.sql(f"ALTER TABLE {data} DROP IF EXISTS {', '.join(store._spec([column, VERSION], p) for p in drop[i:i + 100])}")
    used = {f"_stage-{v}" for d, v in there - set(drop)}
    root = store._root(spark, data)
    fs, path = store._fs(spark, root)
    for f in fs.listStatus(path):
        name = f.getPath().getName()
        if name.startswith("_stage-") and name not in used:
            fs.delete(f.getPath(), True)


def days_of(spark: SparkSession, view: str) -> set[tuple]:
    """(day,) of the partitions that the view shows, from the catalog."""
    layout = _layout(spark, view)
    return {(d,) for d, v in store.partition_values(spark, layout["data"], [layout["column"], VERSION]) if _counts(layout, v, d)}
