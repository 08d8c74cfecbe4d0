"""What the plans must look like: pruned scans, partial aggregates, bounded sorts, reused shuffles."""

import pytest
from pyspark.sql import functions as F

from platework._columns import latest_first
from platework.operators.grouped import count_by, top_k, with_share
from platework.operators.latest import dedup_latest
from platework.plans import gold, health, quality, questions
from platework.plans.semantic import semantic_query
from platework.plans.silver import build_quarantine, build_silver
from platework.sources.tables import state_goals, zip_demographics
from samples import bronze, registration


def plan(df, run=False) -> str:
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Silver as a table, with one place holding most rows."""
    path = str(tmp_path_factory.mktemp("plans") / "silver")
    rows = [registration(f"V{i}", CITY="Seattle" if i % 4 else f"Town {i}") for i in range(200)]
    apps = spark.createDataFrame([], "vin string, incentive_amount decimal(10,2), status string, updated_at timestamp, application_id long")
    build_silver(bronze(spark, rows), zip_demographics(spark), state_goals(spark), apps).write.parquet(path)
    return spark.read.parquet(path)


def scanned(text: str) -> list[set]:
    schemas = [part.split("ReadSchema: struct<", 1)[1].split(">", 1)[0] for part in text.split("FileScan")[1:] if "ReadSchema" in part]
    return [{f.split(":")[0] for f in s.split(",") if f} for s in schemas]


def test_aggregates_read_only_their_columns(stored):
    df = gold.agg_by_year(stored)
    assert scanned(plan(df)) == [{"MODEL_YEAR", "EV_TYPE", "TARGET_EV_COUNT"}]
    assert plan(df).count("HashAggregate") == 2 and "partial_count" in plan(df)


def test_filters_reach_the_scan(stored):
    text = plan(questions.top_models_in_county({"silver": stored}, "KING"))
    assert "PushedFilters: [IsNotNull(COUNTY), EqualTo(COUNTY,KING)]" in text
    assert "TakeOrderedAndProject" in text and "Exchange rangepartitioning" not in text


def test_top_k_is_no_total_sort(stored):
    text = plan(top_k(count_by(stored, ["MAKE"]), 3, F.col("n").desc(), F.col("MAKE").asc()))
    assert "TakeOrderedAndProject" in text


def test_share_reads_its_source_once(stored):
    text = plan(with_share(count_by(stored, ["EV_TYPE"]), "n", "pct"), run=True)
    assert "ReusedExchange" in text and "Window" not in text


def test_fact_is_written_without_a_shuffle(stored):
    assert "Exchange" not in plan(gold.fact_registrations(stored))
    assert "Exchange" not in plan(gold.dim_vehicle(stored, unique=True))


def test_places_are_grouped_before_the_geography_join(spark, stored):
    tables = {"fact_registrations": gold.fact_registrations(stored), "dim_vehicle": gold.dim_vehicle(stored),
              "dim_geography": gold.dim_geography(stored, "key")}
    df = semantic_query(tables, ["registration_count"], ["COUNTY"])
    lines = plan(df).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert any("partial_count(VIN" in line for line in lines[join:]) and not any("partial_count(VIN" in line for line in lines[:join])
    assert [tuple(r) for r in df.collect()] == [("KING", 200)]


def test_health_and_metrics_read_bronze_once(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze(spark, [registration(f"V{i % 50}") for i in range(200)]).repartition(12).write.parquet(path)
    rows = spark.read.parquet(path)
    for mode in ("reference", "strict"):
        text = plan(quality.evaluate_bronze(rows, F.current_timestamp(), mode), run=True)
        assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    text = plan(health.bronze_health(rows.select("VIN"), rows), run=True)
    assert text.count("FileScan") == 2 and text.count("Exchange hashpartitioning") == 1


def test_metrics_of_bronze_equal_those_of_its_layers(spark):
    from samples import faulty_registrations, mixed_registrations

    rows, now = bronze(spark, mixed_registrations() + faulty_registrations()), F.lit("2026-06-01").cast("timestamp")
    apps = spark.createDataFrame([], "vin string, incentive_amount decimal(10,2), status string, updated_at timestamp, application_id long")
    for mode in ("reference", "strict"):
        clean = build_silver(rows, zip_demographics(spark), state_goals(spark), apps, mode)
        built = quality.evaluate_metrics(rows, clean, build_quarantine(rows, mode), now, strict=mode == "strict")
        assert sorted(map(tuple, built.collect()), key=repr) == sorted(map(tuple, quality.evaluate_bronze(rows, now, mode).collect()), key=repr)


def test_dedup_shuffles_once(stored):
    text = plan(dedup_latest(stored, ["VIN"], latest_first("LOAD_TS")))
    assert text.count("Exchange") == 1 and text.count("WindowGroupLimit") == 2
