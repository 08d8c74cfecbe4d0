"""Cases of the questions that the driver's tables do not hold."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from platework.plans import questions
from platework.schemas import INCENTIVE_APPLICATIONS
from platework.sources.tables import state_goals, zip_demographics


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_counties_per_capita_null_placement(spark):
    county = spark.createDataFrame([("A", "x", 5, None), ("B", "x", 3, 0.5), ("C", "x", 9, 0.7)],
                                   "COUNTY string, EV_TYPE string, REGISTRATION_COUNT long, REGISTRATIONS_PER_CAPITA double")
    t = {"agg_by_county": county}
    assert [r[0] for r in rows(questions.top_counties_per_capita(t, 2))] == ["C", "B"]
    assert [r[0] for r in rows(questions.top_counties_per_capita(t, 2, nulls="first"))] == ["A", "C"]


def test_cards_ignore_case_and_split_money(spark):
    fact = spark.createDataFrame(
        [("A", "approved", 10), ("B", "APPROVED", 5), ("C", "Denied", 7), ("D", "PENDING", 1), ("E", None, None), ("F", "None", 3)],
        "VIN string, APPLICATION_STATUS string, INCENTIVE_AMOUNT int")
    assert rows(questions.incentive_cards({"fact_registrations": fact})) == [(4, 2, 1, 1, 23.0, 15.0, 50.0)]
    assert rows(questions.incentive_cards({"fact_registrations": fact.limit(0)})) == [(0, 0, 0, 0, 0.0, 0.0, None)]


def test_pending_without_stations(spark):
    def app(key, zip_code, status):
        return (key, "v", date(2026, 1, 1), zip_code, "BEV", "T", "3", 2026, Decimal(1), status, None, None, datetime(2026, 1, 1))
    apps = spark.createDataFrame([app(1, "98101", "PENDING"), app(2, "99999", "PENDING"), app(3, "99999", "PENDING"), app(4, "99998", "DENIED")],
                                 INCENTIVE_APPLICATIONS)
    t = {"incentive_applications": apps, "zip_demographics": zip_demographics(spark)}
    assert rows(questions.pending_without_stations(t)) == [("99999", 2)]


def test_projection(spark):
    years = spark.createDataFrame([(2024, "x", 100), (2025, "x", 100), (2025, "y", 100), (2026, "x", 200), (None, "x", 600)],
                                  "MODEL_YEAR int, EV_TYPE string, REGISTRATION_COUNT long")
    found = rows(questions.goal_projection({"agg_by_year": years, "state_goals": state_goals(spark)}, 2030))
    assert found == [(2030, pytest.approx(1300), 1200000, False)]


def test_share_counts_types_without_a_row_in_the_year(spark):
    years = spark.createDataFrame([(2020, "p", 100, 5), (2020, "b", 10, 5), (2022, "b", 20, 400)],
                                  "MODEL_YEAR int, EV_TYPE string, REGISTRATION_COUNT long, TARGET_EV_COUNT int")
    assert rows(questions.goal_share_of_year({"agg_by_year": years}, 2022)) == [(2022, 130, 400, 32.5)]
    assert rows(questions.goal_share_of_year({"agg_by_year": years}, 2021)) == []


def test_busy_zips_count_a_vehicle_once_per_zip(spark):
    fact = spark.createDataFrame([("A", "g1"), ("B", "g1"), ("C", "g2")], "VIN string, GEO_KEY string")
    geo = spark.createDataFrame([("g1", "98101", "KING", 5, "43"), ("g1", "98101", "KING", 5, "44"), ("g2", "98101", "KING", 5, "43"),
                                 ("g3", "98103", "KING", 5, "43")], "GEO_KEY string, POSTAL_CODE string, COUNTY string, POPULATION int, LEGISLATIVE_DISTRICT string")
    apps = spark.createDataFrame([("98101", "APPROVED"), ("98101", "DENIED"), ("98103", "DENIED")], "applicant_zip string, status string")
    t = {"fact_registrations": fact, "dim_geography": geo, "incentive_applications": apps}
    assert rows(questions.busy_zips_low_approval(t, more_than=2)) == [("98101", "KING", 5, 3, 2, 50.0)]
    assert rows(questions.busy_zips_low_approval(t, more_than=3)) == []


def test_make_shares_hold_for_an_unknown_county(spark):
    silver = spark.createDataFrame([("K", "a"), ("K", "a"), ("K", "b"), (None, "a")], "COUNTY string, MAKE string")
    found = sorted(rows(questions.make_share_by_region({"silver": silver})), key=repr)
    assert found == [("K", "a", 2, 66.67), ("K", "b", 1, 33.33), (None, "a", 1, 100.0)]
