from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from samples import T0, T1, bronze, registration

from platework.plans import gold, silver
from platework.plans.semantic import MODEL, resolve_measure, semantic_query
from platework.schemas import BEV, INCENTIVE_APPLICATIONS, PHEV
from platework.sources.tables import state_goals, zip_demographics


@pytest.fixture(scope="module")
def tables(spark):
    rows = [registration("A1"), registration("A2", EV_TYPE=PHEV, ELECTRIC_RANGE=40), registration("A3", COUNTY="Pierce", CITY="Tacoma"),
            registration("A4", ELECTRIC_RANGE=None, MODEL_YEAR=2025)]
    def app(key, vin, status, amount=1000):
        return (key, vin, date(2026, 1, key), "98101", "BEV", "T", "3", 2026, Decimal(amount), status, None, None, T1)
    apps = spark.createDataFrame(
        [app(1, "A1", "APPROVED"), app(2, "A1", "DENIED"), app(3, "A1", "APPROVED", 500), app(4, "A2", "PENDING"), app(5, "ZZ", "APPROVED")],
        INCENTIVE_APPLICATIONS,
    )
    clean = silver.build_silver(bronze(spark, rows), zip_demographics(spark), state_goals(spark), apps)
    return {
        "fact_registrations": gold.fact_registrations(clean), "dim_vehicle": gold.dim_vehicle(clean),
        "dim_geography": gold.dim_geography(clean, "key"), "agg_by_year": gold.agg_by_year(clean),
        "agg_by_county": gold.agg_by_county(clean), "incentive_applications": apps,
    }


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_fact_measures_by_linked_dimensions(tables):
    found = semantic_query(tables, ["registration_count", "avg_electric_range"], ["COUNTY", "EV_TYPE"])
    assert rows(found) == [("KING", BEV, 2, 270.0), ("KING", PHEV, 1, 40.0), ("PIERCE", BEV, 1, 270.0)]


def test_filter_on_a_column_that_is_no_dimension(tables):
    found = semantic_query(tables, ["registration_count"], ["MODEL_YEAR"], {"CITY": F.col("CITY") == "SEATTLE"})
    assert rows(found) == [(2025, 1), (2026, 2)]


def test_applications_do_not_multiply_registrations(tables):
    found = semantic_query(tables, ["registration_count", "total_applications", "approval_rate", "total_incentive_amount"], ["EV_TYPE"])
    assert rows(found) == [(BEV, 3, 3, pytest.approx(200 / 3), Decimal("1500.00")), (PHEV, 1, 1, 0.0, Decimal("0.00"))]


def test_applications_alone_count_every_application(tables):
    assert rows(semantic_query(tables, ["total_applications", "pending_count", "denied_count"])) == [(5, 1, 1)]
    assert rows(semantic_query(tables, ["total_applications"], ["submitted_date"], {"status": F.col("status") == "APPROVED"})) == [
        (date(2026, 1, 1), 1), (date(2026, 1, 3), 1), (date(2026, 1, 5), 1)]


def test_application_measure_by_vehicle_dimension_keeps_registered_ones(tables):
    assert rows(semantic_query(tables, ["total_applications"], ["EV_TYPE"])) == [(BEV, 3), (PHEV, 1)]


def test_group_without_applications_has_zero_and_no_rate(tables):
    found = semantic_query(tables, ["total_applications", "approval_rate"], ["COUNTY"], {"COUNTY": F.col("COUNTY") == "PIERCE"})
    assert rows(found) == [("PIERCE", 0, None)]


def test_aggregate_tables(tables):
    assert rows(semantic_query(tables, ["agg_by_year.total_registrations", "latest_cumulative"], ["EV_TYPE"])) == [(BEV, 3, 3), (PHEV, 1, 1)]
    found = semantic_query(tables, ["agg_by_county.total_registrations", "avg_per_capita"])
    assert rows(found)[0][0] == 4


def test_names_are_checked(tables):
    assert resolve_measure("approval_rate") == ("incentive_applications", "approval_rate")
    with pytest.raises(ValueError, match="ambiguous"):
        resolve_measure("total_registrations")
    with pytest.raises(ValueError, match="unknown"):
        resolve_measure("profit")
    with pytest.raises(ValueError, match="unknown"):
        resolve_measure("dim_vehicle.profit")
    with pytest.raises(ValueError, match="does not reach"):
        semantic_query(tables, ["registration_count"], ["COLOUR"])
    with pytest.raises(ValueError, match="no relationship"):
        semantic_query(tables, ["registration_count", "latest_cumulative"])


def test_model_holds_every_measure_and_time_dimension():
    assert sum(len(t.measures) for t in MODEL.values()) == 12
    assert sum(len(t.time_dimensions) for t in MODEL.values()) == 3
