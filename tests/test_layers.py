from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from samples import T0, T1, bronze, faulty_registrations, mixed_registrations, registration

from platework.plans import gold, health, quality, silver
from platework.schemas import BEV, INCENTIVE_APPLICATIONS, PHEV, QUARANTINE_COLUMNS, SILVER_COLUMNS
from platework.sources.tables import state_goals, zip_demographics


def application(key, vin, amount, status, updated=T0):
    return (key, vin, T0.date(), "98101", "BEV", "TESLA", "MODEL 3", 2026, Decimal(amount), status, None, None, updated)


@pytest.fixture(scope="module")
def applications(spark):
    return spark.createDataFrame(
        [application(1, "A1", 4000, "PENDING"), application(2, "A1", 7500, "APPROVED", T1),
         application(3, "A2", 4000, "DENIED"), application(4, "A2", 7500, "PENDING"), application(5, "ZZ", 1, "APPROVED")],
        INCENTIVE_APPLICATIONS,
    )


def build(spark, rows, applications, mode="reference"):
    raw = bronze(spark, rows)
    clean = silver.build_silver(raw, zip_demographics(spark), state_goals(spark), applications, mode)
    return raw, clean, silver.build_quarantine(raw, mode)


def counts(raw, clean, bad, strict=False):
    now = F.lit(datetime(2026, 1, 1, 4))
    found = quality.evaluate_metrics(raw, clean, bad, now, strict)
    return {(r["TABLE_NAME"], r["METRIC_NAME"]): r["VALUE"] for r in found.collect()}


def test_golden_faulty_file(spark, applications):
    """Reference semantics: the rows without a VIN collapse to one, and reconciliation is off by it."""
    raw, clean, bad = build(spark, faulty_registrations(), applications)
    assert (raw.count(), clean.count(), bad.count()) == (8, 0, 5)
    reasons = {r["REJECTION_REASON"]: r["rejected_count"] for r in quality.quarantine_breakdown(bad).collect()}
    assert reasons == {
        "VIN is NULL": 1, "Invalid ev_type: Gasoline Vehicle (INVALID TYPE)": 1,
        "Invalid ev_type: Hydrogen Fuel Cell (INVALID)": 1, "Negative electric_range: -50": 1,
        "Negative electric_range: -999": 1,
    }
    metrics = counts(raw, clean, bad)
    assert metrics[(quality.SILVER_NAME, quality.RECONCILIATION)] == -1
    assert metrics[(quality.QUARANTINE_NAME, quality.COMPLETENESS)] == 80
    assert metrics[(quality.SILVER_NAME, quality.COMPLETENESS)] is None
    assert metrics[(quality.SILVER_NAME, quality.FRESHNESS)] is None
    assert metrics[(quality.SILVER_NAME, quality.DUPLICATES)] == 0 == metrics[(quality.SILVER_NAME, quality.RULES)]


def test_golden_faulty_file_strict(spark, applications):
    raw, clean, bad = build(spark, faulty_registrations(), applications, "strict")
    assert (clean.count(), bad.count()) == (0, 8)
    assert counts(raw, clean, bad, strict=True)[(quality.SILVER_NAME, quality.RECONCILIATION)] == 0


def test_silver_rows(spark, applications):
    _, clean, bad = build(spark, mixed_registrations(), applications)
    assert clean.columns == SILVER_COLUMNS and bad.columns == QUARANTINE_COLUMNS
    found = {r["VIN"]: r for r in clean.collect()}
    assert set(found) == {"A1", "A2", "A3", "A6"}
    first = found["A1"]
    assert (first["MODEL"], first["CITY"], first["MAKE"]) == ("NEW", "SEATTLE", "TESLA")
    assert (first["LONGITUDE"], first["LATITUDE"]) == (-122.5, 47.25)
    assert (first["POPULATION"], first["TARGET_EV_COUNT"], first["POLICY_NAME"]) == (35000, 600000, "Clean Cars 2030")
    assert (first["INCENTIVE_AMOUNT"], first["APPLICATION_STATUS"]) == (Decimal("7500.00"), "APPROVED")
    second = found["A2"]  # applications tie on their time: the higher id is the later one
    assert (second["APPLICATION_STATUS"], second["POPULATION"], second["TARGET_EV_COUNT"]) == ("PENDING", None, None)
    assert found["A3"]["LONGITUDE"] is None and found["A3"]["ELECTRIC_RANGE"] is None
    assert found["A6"]["TARGET_EV_COUNT"] is None


def test_unknown_type_vanishes_by_default_and_not_in_strict(spark, applications):
    raw, clean, bad = build(spark, mixed_registrations(), applications)
    reasons = {r["VIN"]: r["REJECTION_REASON"] for r in bad.collect()}
    assert reasons == {
        None: "VIN is NULL", "A5": "Negative electric_range: -5", "A7": "Invalid ev_type: Gasoline",
        "A8": "Negative electric_range: -1",
    }
    raw, clean, bad = build(spark, mixed_registrations(), applications, "strict")
    strict = sorted((r["VIN"] or "", r["REJECTION_REASON"]) for r in bad.collect())
    assert strict == [
        ("", "VIN is NULL"), ("", "VIN is NULL"), ("A4", "Invalid ev_type: NULL"), ("A5", "Invalid ev_type: NULL"),
        ("A7", "Invalid ev_type: Gasoline"), ("A8", "Negative electric_range: -1"),
    ]
    keyed = raw.where("VIN IS NOT NULL").select("VIN").distinct().count()
    assert clean.count() + bad.count() == keyed + raw.where("VIN IS NULL").count()


def test_ties_in_load_time_are_settled_by_lineage(spark):
    rows = [registration(MODEL="x", SOURCE_FILE="a"), registration(MODEL="y", SOURCE_FILE="b", RECORD_POSITION=1),
            registration(MODEL="z", SOURCE_FILE="b", RECORD_POSITION=2)]
    for order in (rows, rows[::-1]):
        assert silver.latest_registrations(bronze(spark, order)).first()["MODEL"] == "z"


def test_repeated_lookup_key_stops_the_build(spark, applications):
    zips = zip_demographics(spark)
    with pytest.raises(ValueError, match="repeated"):
        silver.build_silver(bronze(spark, [registration()]), zips.union(zips.limit(1)), state_goals(spark), applications)


@pytest.mark.parametrize("mode", silver.MODES)
def test_application_join_needs_no_second_shuffle_of_bronze(spark, applications, mode):
    rows = bronze(spark, [registration()])
    clean = silver.build_silver(rows, zip_demographics(spark), state_goals(spark), applications, mode)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    # One shuffle by VIN on each side; the lookups are known to be small, so Spark broadcasts them.
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("BroadcastHashJoin") == 2


def test_mode_is_checked(spark):
    with pytest.raises(ValueError, match="mode"):
        silver.latest_registrations(bronze(spark, [registration()]), "lenient")


def test_dimensions_and_fact(spark, applications):
    _, clean, _ = build(spark, mixed_registrations() + [registration("A9", LEGISLATIVE_DISTRICT="44")], applications)
    assert gold.dim_vehicle(clean).count() == gold.dim_vehicle(clean, unique=True).count() == 5
    places, by_key = gold.dim_geography(clean), gold.dim_geography(clean, grain="key")
    assert places.count() == 5  # one key has three: two districts, and a location that could not be read
    assert by_key.count() == by_key.select("GEO_KEY").distinct().count() == 3
    fact = gold.fact_registrations(clean)
    assert fact.count() == clean.count() and dict(fact.dtypes)["LOAD_TS"] == "timestamp_ntz"
    assert fact.join(by_key, "GEO_KEY", "left_anti").count() == 0
    fanned = gold.shared_registrations(fact, gold.dim_vehicle(clean), places)
    flat = gold.shared_registrations(fact, gold.dim_vehicle(clean), by_key)
    assert flat.count() == fact.count() < fanned.count()
    for spread in (True, False):
        other = gold.shared_registrations(fact, gold.dim_vehicle(clean), by_key, spread=spread)
        assert sorted(map(repr, other.collect())) == sorted(map(repr, flat.collect()))
    with pytest.raises(ValueError, match="grain"):
        gold.dim_geography(clean, "county")


def test_year_aggregate(spark, applications):
    rows = [registration(f"V{i}", MODEL_YEAR=y, EV_TYPE=t) for i, (y, t) in enumerate(
        [(2024, BEV), (2025, BEV), (2025, BEV), (2026, BEV), (None, BEV), (2025, PHEV)])]
    _, clean, _ = build(spark, rows, applications)
    found = {(r["MODEL_YEAR"], r["EV_TYPE"]): tuple(r)[2:] for r in gold.agg_by_year(clean).collect()}
    assert found == {
        (2024, BEV): (1, 1, None, None), (2025, BEV): (2, 3, 500000, 3 / 500000), (2026, BEV): (1, 4, 600000, 4 / 600000),
        (None, BEV): (1, 5, None, None), (2025, PHEV): (1, 1, 500000, 1 / 500000),
    }


def test_county_aggregate(spark, applications):
    rows = [registration("V1"), registration("V2", POSTAL_CODE="98103", ELECTRIC_RANGE=None),
            registration("V3", COUNTY="Pierce", POSTAL_CODE="98402")]
    _, clean, _ = build(spark, rows, applications)
    found = {r["COUNTY"]: tuple(r)[2:] for r in gold.agg_by_county(clean).collect()}
    assert found == {"KING": (2, 270.0, 45000, 2 / 45000), "PIERCE": (1, 270.0, None, None)}


def test_restrict(spark):
    rows = spark.createDataFrame([("KING", 1), ("PIERCE", 2), (None, 3)], "COUNTY string, v int")
    policy = spark.createDataFrame([("K", "KING"), ("K", "KING"), ("N", "NOWHERE")], "consumer string, value string")
    assert [tuple(r) for r in gold.restrict(rows, "K", policy, mask=("v",)).collect()] == [("KING", None)]
    assert gold.restrict(rows, "N", policy).count() == 0
    assert gold.restrict(rows, "OTHER", policy, mask=("v",)).where("v IS NOT NULL").count() == 3


def test_health(spark, applications):
    raw, clean, bad = build(spark, [registration("A1"), registration("A2", ELECTRIC_RANGE=-1)], applications)
    found = health.layer_health(spark.range(1), raw, clean, bad, clean).first()
    assert found["reconciliation_status"].startswith("PASS") and found["silver_plus_quarantine"] == 2
    raw, clean, bad = build(spark, mixed_registrations(), applications)
    assert health.layer_health(spark.range(1), raw, clean, bad, clean).first()["reconciliation_status"].startswith("INVESTIGATE") == (
        clean.count() + bad.count() != 8
    )
    line = health.freshness_summary(clean, F.lit(datetime(2026, 1, 2, 3, 0, 1))).first()
    assert tuple(line) == (4, T1, 180)
    assert health.is_stale(clean, "LOAD_TS", F.lit(datetime(2026, 1, 2, 3)), 120)
    assert not health.is_stale(clean, "LOAD_TS", F.lit(datetime(2026, 1, 2, 2)), 120)
    assert health.is_stale(clean.limit(0), "LOAD_TS", F.lit(T1), 120)
