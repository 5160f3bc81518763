"""File sources (CSV with missing tokens, NDJSON entities) and quality checks."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vesseltrack.operators.quality import RULES, run_checks
from vesseltrack.sources.ais import read_ais
from vesseltrack.sources.sanctions import read_sanctions

HEADER = ("mmsi,base_date_time,longitude,latitude,sog,cog,heading,vessel_name,imo,call_sign,vessel_type,"
          "status,length,width,draft,cargo,transceiver")


def test_csv_missing_tokens(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "ais-2024-01-01.csv")
    with open(p, "w") as f:
        f.write(HEADER + "\n")
        f.write("001234567,2024-01-01 00:00:03,-70.1,43.6,NA,358.8,,N/A,null,WDB,90,0,,,NaN,90,A\n")
        f.write("211000001,2024-13-01 00:00:03,-70.1,43.6,1.5,1,5.5,X,IMO1,C,90,0,1,2,3.0,90,B\n")
    rows = {r["mmsi"]: r for r in read_ais(spark, p).collect()}
    a = rows["001234567"]  # leading zeros kept (declared string)
    assert a["sog"] is None and a["vessel_name"] is None and a["imo"] is None and a["draft"] is None
    assert a["heading"] is None and a["vessel_type"] == 90 and a["_source_file"] == "ais-2024-01-01.csv"
    b = rows["211000001"]
    assert b["base_date_time"] is None  # unparsable timestamp -> null, row kept
    assert b["heading"] is None  # non-integral int -> null


def test_file_name_is_no_pattern_search_in_each_row(spark, tmpdir_fresh):
    """A pattern tries every letter of every folder: with long folder names that took longer than reading the row."""
    folder = os.path.join(tmpdir_fresh, "a" * 100, "b c%20" + "d" * 90)
    os.makedirs(folder)
    names = ["ais-2024-01-01.csv", "ais 2024.csv"]
    for name in names:
        with open(os.path.join(folder, name), "w") as f:
            f.write(HEADER + "\n001234567,2024-01-01 00:00:03,-70.1,43.6,NA,358.8,,N/A,null,WDB,90,0,,,NaN,90,A\n")
    got = read_ais(spark, folder, spread=2)
    assert "regexp" not in got._jdf.queryExecution().executedPlan().toString()
    by_pattern = spark.read.text(folder).select(F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("f")).distinct()
    assert {r["_source_file"] for r in got.collect()} == {r["f"] for r in by_pattern.collect()} and len(names) == got.count()


def test_each_cell_is_parsed_once(spark, tmpdir_fresh):
    """Whole numbers were trimmed and parsed four times, fractions twice."""
    p = os.path.join(tmpdir_fresh, "ais-2024-01-01.csv")
    cells = ["1", " 7 ", "7.0", "7.5", "", " NaN ", "NAN", "1e3", "3e9", "1e30", "Infinity", "x", "-0"]
    with open(p, "w") as f:
        f.write(HEADER + "\n")
        for i, c in enumerate(cells):
            f.write(f"{i:09d},2024-01-01 00:00:03,{c},43.6,1,2,{c},N,I,C,90,0,1,2,3,90,A\n")
    got = read_ais(spark, p)
    plan = got._jdf.queryExecution().executedPlan().toString()
    for c in ("longitude", "heading"):
        assert plan.count(f"trim({c}#") == 1 and plan.count(f"try_cast({c}#") <= 2
    rows = got.orderBy("mmsi").select("longitude", "heading").collect()
    assert [r["longitude"] for r in rows] == [1, 7, 7, 7.5, None, None, None, 1000, 3e9, 1e30, float("inf"), None, 0]
    assert [r["heading"] for r in rows] == [1, 7, 7, None, None, None, None, 1000, None, None, None, None, 0]


def test_ndjson_entities(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "entities.json")
    with open(p, "w") as f:
        f.write('{"id": "a", "schema": "Vessel", "properties": {"name": ["ONE", "ALIAS"], "mmsi": ["211000001"],'
                ' "imoNumber": ["IMO1"], "flag": ["pa"], "startDate": ["2022-01-01"]}, "datasets": ["x", "y"]}\n')
        f.write("\n")
        f.write('{"id": "b", "schema": "Vessel", "properties": {"name": ["TWO"], "mmsi": []}}\n')
        f.write('{"id": "c", "schema": "Company", "properties": {"name": ["CO"]}, "datasets": ["x"]}\n')
    rows = {r["entity_id"]: r for r in read_sanctions(spark, p).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"]["entity_name"] == "ONE" and rows["a"]["sanctions_list"] == "x, y"
    assert rows["b"]["mmsi"] is None and rows["b"]["sanctions_list"] == ""


def test_ndjson_malformed_fails(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "bad.json")
    with open(p, "w") as f:
        f.write('{"id": "a", "schema": "Vessel"}\n{not json\n')
    with pytest.raises(Exception):
        read_sanctions(spark, p).collect()


def test_quality_rules(spark):
    df = spark.createDataFrame([("1", "dark_gap", 7, 0.3), (None, "other", 5, 1.5), ("1", None, None, None)],
                               "mmsi string, anomaly_type string, gap_hours long, anomaly_score double")
    rules = [("not_null", "mmsi", None), ("accepted", "anomaly_type", ["dark_gap"]),
             ("expr", "gap_hours", "gap_hours >= 6"), ("unique", "mmsi", None)]
    got = {(r["rule"], r["column_name"]): r["failures"] for r in run_checks(df, rules).collect()}
    assert got == {("not_null", "mmsi"): 1, ("accepted", "anomaly_type"): 1, ("expr", "gap_hours"): 2,
                   ("unique", "mmsi"): 1}


def test_rule_catalog_covers_tables():
    assert {"ais_raw", "sanctions", "ais_clean", "ais_dark_gaps", "ais_impossible_speed",
            "ais_anomaly_cues", "vessel_features"} <= set(RULES)
    n = sum(1 for rules in RULES.values() for r in rules if r[0] in ("not_null", "unique", "accepted", "is_null"))
    assert n == 43  # 36 not_null + 2 unique + 5 accepted-values
