"""Distinct counts that merge, joins on observed hot keys, measures across grains, drift of headers."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from platework.operators import lookups
from platework.plans import distinct, store
from platework.plans.semantic import drill_across
from platework.sources import documents

NOW = datetime(2026, 1, 1, tzinfo=timezone.utc)


def test_distinct_keys_over_runs(spark, tmp_path):
    root, rows = str(tmp_path), [(f"k{i % 37}" if i % 11 else None, "abc"[i % 3], i % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, g string, wave int")
    for wave in (3, 0, 4, 1, 2, 2):  # in any order, one of them twice
        distinct.add_distinct(spark, root, df.where(F.col("wave") == wave), "k", ["g", "wave"], NOW, buckets=4)
    keys = lambda *by: {tuple(r) for r in df.groupBy(*by).agg(F.count_distinct("k")).where("count(DISTINCT k) > 0").collect()}
    for by in (["g"], ["wave"], ["g", "wave"]):
        assert {tuple(r) for r in distinct.distinct_kept(spark, root, by).collect()} == keys(*by)
    assert distinct.distinct_in_all(spark, root).first()[0] == len({k for k, _, _ in rows if k})
    numbers = store.load(spark, root, "numbers", store.published(spark, root)["numbers"]).collect()
    assert len(numbers) == len({r["number"] for r in numbers}) == 37
    with pytest.raises(ValueError, match="kept by"):
        distinct.distinct_kept(spark, root, ["k"])


def test_join_on_observed_hot_keys(spark, tmp_path):
    rows = [("hot" if i % 3 else None if i % 5 == 0 else f"k{i % 20}", i) for i in range(3_000)]
    df = spark.createDataFrame(rows, "k string, v int")
    lookup = spark.createDataFrame([("hot", "H"), *[(f"k{i}", f"L{i}") for i in range(15)], ("other", "O")], "key string, name string")
    batch = store.begin(spark, str(tmp_path), "x", ["t"], NOW)
    entry = store.write(df, str(tmp_path), "t", batch, measures={"hot": lookups.hot_keys("k")})
    assert entry.facts["hot"][0] == ("hot", 2000)
    want = sorted((tuple(r) for r in lookups.left_lookup(df, lookup, {"k": "key"}).collect()), key=repr)
    for hot in (entry.facts["hot"], [], [("nowhere", 10**9), (None, 10**9)]):
        found = lookups.dealt_left_join(df, lookup, "k", "key", hot, rows_per_task=100)
        assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    plan = lookups.dealt_left_join(df, lookup, "k", "key", entry.facts["hot"], 100)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2  # each side once


def test_measures_side_by_side(spark):
    tables = {
        "agg_by_year": spark.createDataFrame(
            [(2025, "a", 3, 3, 0.5), (None, "a", 2, 5, None), (2026, "b", 1, 1, 0.1)],
            "MODEL_YEAR int, EV_TYPE string, REGISTRATION_COUNT long, CUMULATIVE_COUNT long, PCT_OF_GOAL double"),
        "agg_by_county": spark.createDataFrame(
            [("X", "a", 4, 0.1), ("Y", None, 2, 0.3)],
            "COUNTY string, EV_TYPE string, REGISTRATION_COUNT long, REGISTRATIONS_PER_CAPITA double"),
    }
    names = ["agg_by_year.total_registrations", "agg_by_county.total_registrations", "avg_per_capita"]
    found = drill_across(tables, names, ["EV_TYPE"])
    assert found.columns == ["EV_TYPE", "agg_by_year_total_registrations", "agg_by_county_total_registrations", "avg_per_capita"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([("a", 5, 4, 0.1), ("b", 1, None, None), (None, None, 2, 0.3)], key=repr)
    assert [tuple(r) for r in drill_across(tables, names).collect()] == [(6, 6, 0.2)]
    with pytest.raises(ValueError, match="does not reach"):
        drill_across(tables, names, ["COUNTY"])


def test_header_drift(spark):
    def text(names, data):
        return json.dumps({"meta": {"view": {"columns": [{"fieldName": n} for n in names]}}, "data": data})

    raw = spark.createDataFrame([
        (text(["a", "b"], [["1", 2], ["x"], "oops", {"a": 1}]), "one"), (text(["b", "c", "b"], [[None, 1.5, True]]), "two"),
        ("{cut off", "three"), ('{"data":[["1"]]}', "four"), (text(["a"], []), "five"), (None, "six")], "raw_data string, source_file string")
    contract = [("a", "A", "string"), ("b", "B", "int"), ("z", "Z", "string")]
    found = {r["field"]: tuple(r)[1:] for r in documents.field_report(raw, contract).collect()}
    assert found["a"] == (True, 2, 1, 2, 2, "STRING") and found["c"][:5] == (False, 1, 2, 1, 1)
    assert found["b"][:5] == (True, 2, 1, 2, 2) and found["z"] == (True, 0, 3, 0, 0, None)
