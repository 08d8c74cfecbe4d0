from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from samples import BRONZE, bronze, registration

from platework.plans import quality as q
from platework.schemas import METRIC_HISTORY

NOW = datetime(2026, 1, 1, 12)


def history(spark, rows):
    """Rows of (hours ago, metric, value)."""
    return spark.createDataFrame(
        [(NOW - timedelta(hours=h), NOW - timedelta(hours=h), q.DATABASE_NAME, q.SCHEMA_NAME, q.SILVER_NAME, m, None if v is None else Decimal(v))
         for h, m, v in rows],
        METRIC_HISTORY,
    )


@pytest.mark.parametrize("metric, value, status", [
    (q.COMPLETENESS, "99.99", "WARN — incomplete VINs"), (q.COMPLETENESS, "100", "PASS"), (q.COMPLETENESS, None, "PASS"),
    (q.DUPLICATES, "1", "FAIL — duplicate VINs detected"), (q.DUPLICATES, "0", "PASS"),
    (q.FRESHNESS, "10800", "PASS"), (q.FRESHNESS, "10801", "WARN — data stale (>3 hours)"),
    (q.RULES, "2", "FAIL — invalid rows in Silver"), (q.RECONCILIATION, "-1", "FAIL — row count mismatch"),
    (q.RECONCILIATION, "0", "PASS"), ("SOMETHING", "7", "PASS"),
])
def test_status(spark, metric, value, status):
    assert q.with_status(history(spark, [(0, metric, value)])).first()["QUALITY_STATUS"] == status


def test_no_value_is_no_data_only_in_strict(spark):
    rows = history(spark, [(0, q.DUPLICATES, None)])
    assert q.with_status(rows, strict=True).first()["QUALITY_STATUS"] == "NO DATA"


def test_check_reads_two_hours_and_three_metrics(spark):
    rows = history(spark, [(3, q.DUPLICATES, "5"), (1, q.COMPLETENESS, "1"), (1, q.FRESHNESS, "99999"), (1, q.RULES, None)])
    assert tuple(q.check_breaches(rows, F.lit(NOW)).first()) == (0, "SUCCESS", None)
    rows = rows.union(history(spark, [(1, q.DUPLICATES, "5"), (1, q.RECONCILIATION, "-2")]))
    assert tuple(q.check_breaches(rows, F.lit(NOW)).first())[:2] == (2, "FAILURE")


def test_alert_adds_staleness(spark):
    rows = history(spark, [(5, q.RULES, "1"), (1, q.FRESHNESS, "21600"), (1, q.COMPLETENESS, "1")])
    since = F.lit(NOW - timedelta(hours=2))
    assert not q.has_alert(rows, since)
    rows = rows.union(history(spark, [(1, q.FRESHNESS, "21601")]))
    assert [r["METRIC_NAME"] for r in q.alert_breaches(rows, since).collect()] == [q.FRESHNESS]


def test_current_status_skips_missing_values(spark):
    rows = history(spark, [(1, q.DUPLICATES, None), (2, q.DUPLICATES, "3"), (3, q.DUPLICATES, "0"), (1, q.FRESHNESS, "5")])
    found = {r["METRIC_NAME"]: (r["VALUE"], r["STATUS"]) for r in q.current_status(rows).collect()}
    assert found == {q.DUPLICATES: (3, "FAIL"), q.FRESHNESS: (5, "PASS")}
    assert [r["VALUE"] for r in q.metric_series(rows.where(F.col("METRIC_NAME") == q.DUPLICATES)).collect()] == [0, 3]


def test_single_metrics(spark):
    rows = bronze(spark, [registration("A"), registration("A"), registration(None), registration(None),
                          registration("B", EV_TYPE=None), registration("C", EV_TYPE="x"), registration("D", ELECTRIC_RANGE=-1)])
    assert q.completeness_metric(rows).first()[0] == Decimal("71.43")
    assert q.duplicate_metric(rows).first()[0] == 2
    assert q.rule_metric(rows).first()[0] == 2
    assert q.freshness_metric(rows, F.lit(datetime(2026, 1, 1, 0, 1))).first()[0] == 60
    assert q.reconciliation_metric(rows, rows.limit(3), rows.limit(1)).first()[0] == 0
    assert q.reconciliation_metric(rows, rows.limit(3), rows.limit(1), strict=True).first()[0] == 2


def test_metrics_agree_with_their_single_forms(spark):
    raw = bronze(spark, [registration("A"), registration("A"), registration(None), registration("D", ELECTRIC_RANGE=-1)])
    bad = raw.where("VIN IS NULL").withColumn("REJECTION_REASON", F.lit("x"))
    now = F.lit(NOW)
    found = {(r["TABLE_NAME"], r["METRIC_NAME"]): r["VALUE"] for r in q.evaluate_metrics(raw, raw, bad, now).collect()}
    assert found == {
        (q.SILVER_NAME, q.COMPLETENESS): q.completeness_metric(raw).first()[0],
        (q.SILVER_NAME, q.DUPLICATES): q.duplicate_metric(raw).first()[0],
        (q.SILVER_NAME, q.RULES): q.rule_metric(raw).first()[0],
        (q.SILVER_NAME, q.RECONCILIATION): q.reconciliation_metric(raw, raw, bad).first()[0],
        (q.SILVER_NAME, q.FRESHNESS): q.freshness_metric(raw, now).first()[0],
        (q.QUARANTINE_NAME, q.COMPLETENESS): q.completeness_metric(bad).first()[0],
    }


def test_empty_tables(spark):
    empty = spark.createDataFrame([], BRONZE)
    found = {r["METRIC_NAME"]: r["VALUE"] for r in q.evaluate_metrics(empty, empty, empty, F.lit(NOW)).where(
        F.col("TABLE_NAME") == q.SILVER_NAME).collect()}
    assert found == {q.COMPLETENESS: None, q.DUPLICATES: 0, q.RULES: 0, q.RECONCILIATION: 0, q.FRESHNESS: None}


def test_run_log_keeps_long_errors(spark, tmp_path):
    path = str(tmp_path / "log")
    q.log_run(spark, path, "a", "FAILURE", None, "x" * 5000, NOW)
    q.log_run(spark, path, "b", "SUCCESS", 3, None, NOW)
    found = {r["TASK_NAME"]: r for r in spark.read.parquet(path).collect()}
    assert len(found["a"]["ERROR_MESSAGE"]) == 5000 and found["b"]["ROW_COUNT"] == 3
