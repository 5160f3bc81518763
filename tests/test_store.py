"""Table writes: replace-window (P2, P3), per-file replace, dynamic partition overwrite, watermark."""

import uuid
from datetime import date

import pytest

from vesseltrack.plans import store
from vesseltrack.plans.window import ProcessingWindow
from vesseltrack.sources.catalog import read_watermark


def _t(name):
    return f"st{uuid.uuid4().hex[:8]}.{name}"


def _rows(spark, pairs):
    return spark.createDataFrame([(v, d) for v, d in pairs], "v int, event_date date")


D = [date(2024, 1, i) for i in range(1, 8)]


def _state(spark, t):
    return sorted((r["v"], r["event_date"]) for r in spark.table(t).collect())


def test_replace_window(spark):
    t = _t("x")
    assert store.replace_window(spark, _rows(spark, [(1, D[0]), (2, D[1]), (3, D[2])]), t, D[0], D[2]) == 3
    before = _state(spark, t)
    store.replace_window(spark, _rows(spark, [(1, D[0]), (2, D[1]), (3, D[2])]), t, D[0], D[2])
    assert _state(spark, t) == before  # P2: rerun changes nothing
    store.replace_window(spark, _rows(spark, [(20, D[1])]), t, D[1], D[2])
    assert _state(spark, t) == [(1, D[0]), (20, D[1])]  # P3: day 3 lost its rows -> empty
    store.replace_window(spark, _rows(spark, []), t, D[0], D[0])
    assert _state(spark, t) == [(20, D[1])]
    with pytest.raises(ValueError):
        store.replace_window(spark, _rows(spark, [(9, D[5])]), t, D[0], D[1])
    assert _state(spark, t) == [(20, D[1])]  # the check runs before anything is dropped


def test_replace_files(spark):
    t = _t("raw")
    a = spark.createDataFrame([(1, "f1"), (2, "f1"), (3, "f2")], "v int, _source_file string")
    per_file = {}
    store.replace_files(spark, a, t, ["f1", "f2", "empty"], per_file=per_file)
    assert per_file == {"f1": 2, "f2": 1, "empty": 0}
    store.replace_files(spark, a.where("_source_file = 'f1'"), t, ["f1"])
    assert spark.table(t).count() == 3
    assert store.partition_values(spark, t, ["_source_file"]) == {("f1",), ("f2",)}
    b = spark.createDataFrame([(7, "f2"), (8, "f3")], "v int, _source_file string")
    store.replace_files(spark, b, t, ["f2", "f3"])
    got = sorted((r["v"], r["_source_file"]) for r in spark.table(t).collect())
    assert got == [(1, "f1"), (2, "f1"), (7, "f2"), (8, "f3")]
    with pytest.raises(ValueError):
        store.replace_files(spark, b, t, ["f2"])
    assert sorted((r["v"], r["_source_file"]) for r in spark.table(t).collect()) == got


def test_a_row_costs_the_same_in_a_batch_of_many_files(spark, monkeypatch):
    """No metric for each file of the batch; counts, days without a value and files without rows are right all the same."""
    from pyspark.sql.classic.dataframe import DataFrame as Frame
    widths, observe = [], Frame.observe
    monkeypatch.setattr(Frame, "observe", lambda df, obs, *exprs: widths.append(len(exprs)) or observe(df, obs, *exprs))
    cols = ["_event_date", "_source_file"]
    for n in (2, 40):
        t, names = _t("raw"), [f"f {i}%.csv" for i in range(n)]
        rows = spark.range(n * 3).selectExpr("id as v", "if(id % 3 = 0, null, date_add(DATE'2024-01-01', cast(id % 2 as int))) as _event_date",
                                             f"concat('f ', id % {n}, '%.csv') as _source_file")
        got = {}
        assert store.replace_files(spark, rows, t, [*names, "empty"], cols, got) == n * 3
        assert got == {**dict.fromkeys(names, 3), "empty": 0}
        assert sorted(map(repr, spark.table(t).select(*rows.columns).collect())) == sorted(map(repr, rows.collect()))
        got = {}
        assert store.replace_files(spark, rows.where("false"), t, names[:1], cols, got) == 0 and got == {names[0]: 0}
        assert spark.table(t).count() == n * 3 - 3
    assert all(w <= 3 for w in widths)


def test_names_with_quotes_and_separators(spark):
    t = _t("raw")
    names = ["it's \\ odd.csv", "a=b/c d.csv", "100%25.csv"]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "v int, _source_file string")
    for _ in range(2):
        store.replace_files(spark, rows, t, names)
        assert sorted(map(tuple, spark.table(t).collect())) == list(enumerate(names))


def _failing(df):
    from pyspark.sql import functions as F
    return df.withColumn("v", F.when(F.col("v") < 0, 0).otherwise(F.raise_error(F.lit("late failure")).cast("int")))


def _files_below(spark, table):
    import os
    root = store._root(spark, table).removeprefix("file:")
    return sorted(n for n in os.listdir(root) if not n.startswith("."))


def test_a_failed_write_loses_nothing(spark):
    whole, days, files = _t("whole"), _t("days"), _t("files")
    rows = _rows(spark, [(1, D[0]), (2, D[1])])
    named = spark.createDataFrame([(1, "f1"), (2, "f1")], "v int, _source_file string")
    for first, again, table in (
            (lambda: store.overwrite_table(spark, rows, whole), lambda: store.overwrite_table(spark, _failing(rows), whole), whole),
            (lambda: store.overwrite_table(spark, rows, days, "event_date"),
             lambda: store.overwrite_table(spark, _failing(rows), days, "event_date"), days),
            (lambda: None, lambda: store.replace_window(spark, _failing(rows), days, D[0], D[1]), days),
            (lambda: store.replace_files(spark, named, files, ["f1"]), lambda: store.replace_files(spark, _failing(named), files, ["f1"]), files)):
        first()
        before, below = sorted(map(tuple, spark.table(table).collect())), _files_below(spark, table)
        assert len(before) == 2
        with pytest.raises(Exception, match="late failure"):
            again()
        assert sorted(map(tuple, spark.table(table).collect())) == before
        assert _files_below(spark, table) == below  # nothing staged is left behind
    with pytest.raises(ValueError):
        store.replace_window(spark, rows, days, D[3], D[4])


def test_overwrite_keeps_readers_and_drops_old_versions(spark):
    t = _t("snap")
    store.overwrite_table(spark, spark.range(5).selectExpr("cast(id as int) v"), t)
    reader = spark.table(t)
    store.overwrite_table(spark, spark.range(3).selectExpr("cast(id as int) v"), t)
    assert reader.count() in (3, 5) and spark.table(t).count() == 3
    for n in (4, 6, 7):
        store.overwrite_table(spark, spark.range(n).selectExpr("cast(id as int) v"), t)
    assert len([n for n in _files_below(spark, t) if n.startswith("_v-")]) == 2
    # the table may be computed from itself, and may change its columns
    store.overwrite_table(spark, spark.table(t).selectExpr("v + 1 as v"), t)
    assert spark.table(t).count() == 7
    store.overwrite_table(spark, spark.range(2).selectExpr("id", "'x' as name"), t)
    assert spark.table(t).columns == ["id", "name"]


def test_partitioned_overwrite_drops_days_without_rows(spark):
    t = _t("parts")
    store.overwrite_table(spark, _rows(spark, [(1, D[0]), (2, D[1])]), t, "event_date")
    store.overwrite_table(spark, _rows(spark, [(3, D[1]), (4, D[2])]), t, "event_date")
    assert _state(spark, t) == [(3, D[1]), (4, D[2])]
    store.overwrite_table(spark, _rows(spark, []), t, "event_date")
    assert _state(spark, t) == []


def test_watermark_only_on_advance(spark):
    t = _t("state")
    assert not store.commit_watermark(spark, t, ProcessingWindow(D[0], D[6], advance=False))
    assert read_watermark(spark, t) is None
    assert store.commit_watermark(spark, t, ProcessingWindow(D[0], D[6], advance=True))
    assert read_watermark(spark, t) == D[6]
    assert not store.commit_watermark(spark, t, None)
    assert read_watermark(spark, t) == D[6]


def test_table_names():
    assert store.table_name("gold", "x") == "gold.x"
    assert store.table_name("gold", "x", "dev") == "dev_gold.x"


def test_scratch_tables_are_dropped(spark):
    from vesseltrack.session import SCRATCH_DB, Scratch
    with Scratch(spark) as scratch:
        t = scratch.keep(spark.range(10), "probe")
        assert t.count() == 10
        name = scratch.tables[0]
        assert spark.catalog.tableExists(name)
    assert not spark.catalog.tableExists(name)
    assert SCRATCH_DB in [d.name for d in spark.catalog.listDatabases()]


def _watched(spark, monkeypatch, look):
    """Every statement is followed by a look at the table."""
    run, seen = type(spark).sql, []

    def sql(self, text, *a, **k):
        out = run(self, text, *a, **k)
        if text.startswith(("ALTER", "CREATE", "DROP")):
            seen.append((text.split("(")[0][:40], look()))
        return out

    monkeypatch.setattr(type(spark), "sql", sql)
    return seen


def test_a_window_changes_over_in_one_statement(spark, monkeypatch):
    t = _t("atomic")
    old = [(i, D[i]) for i in range(7)]
    store.replace_window(spark, _rows(spark, old), t, D[0], D[6])
    new = [(0, D[0]), (11, D[1]), (12, D[2]), (13, D[2]), (5, D[5]), (6, D[6])]  # day 2 to 5: two days change, two end empty
    new.sort()
    seen = _watched(spark, monkeypatch, lambda: tuple(sorted((r["v"], r["event_date"]) for r in spark.read.table(t).collect())))
    store.replace_window(spark, _rows(spark, [x for x in new if D[1] <= x[1] <= D[4]]), t, D[1], D[4])
    states = [s for _, s in seen]
    assert len(states) >= 2 and set(states) == {tuple(old), tuple(new)}
    switch = states.index(tuple(new))
    assert seen[switch][0].startswith("ALTER VIEW") and all(s == tuple(old) for s in states[:switch]) and all(s == tuple(new) for s in states[switch:])


def test_a_reader_keeps_its_version_and_old_ones_are_removed(spark):
    t = _t("versions")
    store.replace_window(spark, _rows(spark, [(1, D[0]), (2, D[1])]), t, D[0], D[1])
    reader = spark.table(t)
    store.replace_window(spark, _rows(spark, [(20, D[1])]), t, D[1], D[1])
    assert sorted(r["v"] for r in reader.collect()) == [1, 2]  # planned on the view of before
    assert _state(spark, t) == [(1, D[0]), (20, D[1])]
    for v in (30, 40, 50):
        store.replace_window(spark, _rows(spark, [(v, D[1])]), t, D[1], D[1])
    assert _state(spark, t) == [(1, D[0]), (50, D[1])]
    assert len([n for n in _files_below(spark, t) if n.startswith("_stage-")]) == 3  # the first day's, the last two of the second
    assert store.partition_values(spark, t, ["event_date"]) == {(str(D[0]),), (str(D[1]),)}
    store.overwrite_table(spark, _rows(spark, [(7, D[3]), (8, None)]), t, "event_date")
    assert sorted(r["v"] for r in spark.table(t).collect()) == [7, 8]
    store.replace_window(spark, _rows(spark, [(9, D[3])]), t, D[3], D[4])
    assert sorted(r["v"] for r in spark.table(t).collect()) == [8, 9]  # a row without a day is in no window
    wider = _rows(spark, [(1, D[0])]).selectExpr("v", "'x' as name", "event_date")
    store.overwrite_table(spark, wider, t, "event_date")
    assert spark.table(t).columns == ["v", "name", "event_date"] and spark.table(t).count() == 1


def test_only_the_asked_days_are_read(spark):
    t = _t("pruned")
    store.replace_window(spark, _rows(spark, [(i, D[i]) for i in range(7)]), t, D[0], D[6])
    store.replace_window(spark, _rows(spark, [(30, D[3])]), t, D[3], D[3])
    day = spark.table(t).where(f"event_date = DATE'{D[3]}'")
    assert [r["v"] for r in day.collect()] == [30]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(day.inputFiles()) <= 2 + len(spark.table(t).inputFiles())


def test_stretches_of_days():
    from vesseltrack.plans.versions import without
    assert without([["2024-01-01", "2024-01-07"]], D[2], D[4]) == [["2024-01-01", "2024-01-02"], ["2024-01-06", "2024-01-07"]]
    assert without([[None, None]], D[0], D[0]) == [[None, "2023-12-31"], ["2024-01-02", None]]
    assert without([["2024-01-02", "2024-01-03"]], D[0], D[6]) == []
    assert without([["2024-01-02", "2024-01-03"]], D[4], D[6]) == [["2024-01-02", "2024-01-03"]]


def _rows_read(df):
    """Rows that the scan hands on: row groups that its statistics rule out are not among them."""
    def scans(node):
        kids = node.children()
        if "FileSourceScanExec" in node.getClass().getName():
            yield node.metrics().apply("numOutputRows").value()
        if "AdaptiveSparkPlanExec" in node.getClass().getName():
            yield from scans(node.executedPlan())
        for i in range(kids.size()):
            yield from scans(kids.apply(i))

    qe = df._jdf.queryExecution()
    return len(df.collect()), sum(scans(qe.executedPlan()))


def test_sorted_files_let_a_reader_skip_row_groups(spark):
    n = 200_000
    rows = spark.range(0, n, 1, 2).selectExpr("concat('2', lpad(cast((id * 7919) % 5000 as string), 8, '0')) as mmsi", "sha2(cast(id as string), 256) as more",
                                              "id / 1e6 as anomaly_score", "DATE'2024-01-01' as event_date")
    read = {}
    before = spark._jsc.hadoopConfiguration().get("parquet.block.size")
    spark._jsc.hadoopConfiguration().set("parquet.block.size", str(256 * 1024))
    try:
        for name, cluster in (("plain", ()), ("by_vessel", ["mmsi"]), ("by_score", ["-anomaly_score"])):
            t = _t(name)
            store.replace_window(spark, rows, t, D[0], D[0], cluster_by=cluster)
            assert spark.table(t).count() == n
            read[name, "vessel"] = _rows_read(spark.table(t).where("mmsi = '200000007'"))
            read[name, "score"] = _rows_read(spark.table(t).where("anomaly_score > 0.199"))
    finally:
        spark._jsc.hadoopConfiguration().set("parquet.block.size", before) if before else spark._jsc.hadoopConfiguration().unset("parquet.block.size")
    assert {k: v[0] for k, v in read.items()} == {k: 40 if k[1] == "vessel" else 999 for k in read}
    assert read["by_vessel", "vessel"][1] < read["plain", "vessel"][1] / 10 <= n / 10
    assert read["by_score", "score"][1] < n / 10


def _events(spark, folder) -> str:
    spark.range(240).selectExpr(
        "id as event_id", "timestamp_seconds(1704067200 + id * 7200) as ts", "id % 7 as user_id", "'click' as event_type",
        "cast(id % 40 as double) as value", "'{\"k\": 1}' as props").write.parquet(f"{folder}/events.parquet")
    return str(folder)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bronze_batch_reads_its_own_files_only(spark, tmp_path, monkeypatch):
    from vesseltrack.plans import registry_control as R
    from vesseltrack.sources.fixtures import ais_raw_from_events
    plans, load = [], R.store.replace_files
    monkeypatch.setattr(R.store, "replace_files", lambda s, df, *a: plans.append(_plan(df)) or load(s, df, *a))
    d = _events(spark, tmp_path)
    got = R._q_bronze_reingest(spark, d)
    assert len(plans) == 4 and all("PartitionFilters: [" in p and "PartitionFilters: []" not in p for p in plans)
    assert sorted(map(repr, got.select("mmsi", "base_date_time", "_source_file").collect())) == sorted(
        map(repr, ais_raw_from_events(spark, d).select("mmsi", "base_date_time", "_source_file").collect()))


def test_replace_roundtrip_cleans_once(spark, tmp_path, monkeypatch):
    from vesseltrack.plans import registry_control as R
    plans, steps = [], R.timeline
    monkeypatch.setattr(R, "timeline", lambda silver, w: plans.append(_plan(silver)) or steps(silver, w))
    R._q_replace_roundtrip(spark, _events(spark, tmp_path))
    assert len(plans) == 5 and not any("Window" in p for p in plans)
