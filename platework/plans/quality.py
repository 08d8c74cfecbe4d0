"""Data-quality metrics: evaluation, history, status and breaches."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platework._columns import as_col
from platework.functions.numbers import completeness, percent
from platework.functions.times import hours_before, seconds_between
from platework.operators.grouped import repeated_keys
from platework.operators.latest import dedup_latest
from platework.operators.scalars import one_row
from platework.operators.rules import judge
from platework.plans.silver import registration_rules
from platework.schemas import LINEAGE, RUN_LOG, VALID_EV_TYPES
from platework.sources.tables import append_table

# Metric names.
COMPLETENESS = "DMF_VIN_COMPLETENESS"
DUPLICATES = "DMF_DUPLICATE_VIN_COUNT"
RULES = "DMF_INVALID_BUSINESS_RULES"
RECONCILIATION = "DMF_ROW_COUNT_RECONCILIATION"
FRESHNESS = "FRESHNESS"
LANDING = "RECORDS_LANDED_NOT_PARSED"

# Table labels of the metric history. The database is a label of this library.
SILVER_NAME = "SILVER_EV_REGISTRATIONS"
BRONZE_NAME = "BRONZE_EV_REGISTRATIONS"
QUARANTINE_NAME = "QUARANTINE_EV_REGISTRATIONS"
SCHEMA_NAME = "CLEAN"
DATABASE_NAME = "REGISTRATIONS"


@dataclass(frozen=True)
class Threshold:
    """When a metric is out of bounds, and which uses look at it."""

    metric: str
    level: str
    text: str
    above: float | None = None
    below: float | None = None
    differs: float | None = None
    status: bool = True
    check: bool = False
    alert: bool = False

    def broken(self) -> Column:
        value = F.col("VALUE")
        if self.above is not None:
            test = value > self.above
        elif self.below is not None:
            test = value < self.below
        else:
            test = value != self.differs
        return (F.col("METRIC_NAME") == self.metric) & test


# Thresholds and status texts. Status, post-run check and alert use different sets.
THRESHOLDS = [
    Threshold(COMPLETENESS, "WARN", "WARN — incomplete VINs", below=100),
    Threshold(DUPLICATES, "FAIL", "FAIL — duplicate VINs detected", above=0, check=True, alert=True),
    Threshold(FRESHNESS, "WARN", "WARN — data stale (>3 hours)", above=10800),
    Threshold(RULES, "FAIL", "FAIL — invalid rows in Silver", above=0, check=True, alert=True),
    Threshold(RECONCILIATION, "FAIL", "FAIL — row count mismatch", differs=0, check=True, alert=True),
    Threshold(LANDING, "FAIL", "FAIL — landed records are missing", differs=0, check=True, alert=True),
    Threshold(FRESHNESS, "ALERT", "stale (>6 hours)", above=21600, status=False, alert=True),
]


def broken_rule(ev_type="EV_TYPE", ev_range="ELECTRIC_RANGE") -> Column:
    """True for an unknown type or a negative range; NULL counts as not broken."""
    return ~as_col(ev_type).isin(*VALID_EV_TYPES) | (as_col(ev_range) < 0)


# Metrics over one table, each a one-row frame with column VALUE.

def completeness_metric(df: DataFrame, column: str = "VIN") -> DataFrame:
    return df.agg(completeness(column).alias("VALUE"))


def duplicate_metric(df: DataFrame, column: str = "VIN") -> DataFrame:
    return repeated_keys(df, [column]).agg(F.count(F.lit(1)).alias("VALUE"))


def rule_metric(df: DataFrame, broken: Column | None = None) -> DataFrame:
    return df.agg(F.count_if(broken_rule() if broken is None else broken).alias("VALUE"))


def freshness_metric(df: DataFrame, now: Column, column: str = "LOAD_TS") -> DataFrame:
    return df.agg(seconds_between(F.max(column), now).alias("VALUE"))


def reconciliation_metric(
    bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, column: str = "VIN", strict: bool = False
) -> DataFrame:
    """Distinct bronze keys less silver and quarantine rows; strict adds the bronze rows without a key."""
    facts = one_row([
        _key_profile(bronze, column),
        silver.agg(F.count(F.lit(1)).alias("silver_rows")),
        quarantine.agg(F.count(F.lit(1)).alias("quarantine_rows")),
    ])
    return facts.select(_reconciled(strict).alias("VALUE"))


def judged_profile(bronze: DataFrame, mode: str = "reference") -> DataFrame:
    """What health and metrics need to know of bronze, and of the silver and quarantine that follow from it, as one
    row: one read and one shuffle, of a row per task and VIN."""
    strict = mode == "strict"
    newest = F.struct(*[F.col(c) for c in ["LOAD_TS", *LINEAGE] if c in bronze.columns])
    per_vin = bronze.groupBy("VIN").agg(
        F.count(F.lit(1)).alias("n"), F.max_by(F.struct("EV_TYPE", "ELECTRIC_RANGE", "LOAD_TS"), newest).alias("last")
    ).select("VIN", "n", "last.*")
    judged = judge(per_vin, registration_rules(), strict)
    valid, bad = ~F.col("__bad"), F.col("__bad")
    # Strict mode keeps, and rejects, every row without a VIN.
    rows = F.when(F.col("VIN").isNull() & F.lit(strict), F.col("n")).otherwise(F.lit(1))
    total = lambda what: F.coalesce(F.sum(what), F.lit(0))
    return judged.agg(
        total("n").alias("bronze_rows"), F.count("VIN").alias("distinct_keys"),
        total(F.when(F.col("VIN").isNull(), F.col("n"))).alias("null_rows"),
        F.count_if(valid).alias("silver_rows"), F.count(F.when(valid, F.col("VIN"))).alias("silver_keyed"),
        F.lit(0).cast("long").alias("silver_repeated"),  # one row per VIN by construction
        F.count_if(valid & F.coalesce(broken_rule(), F.lit(False))).alias("silver_broken"),
        F.max(F.when(valid, F.col("LOAD_TS"))).alias("silver_newest"),
        total(F.when(bad, rows)).alias("quarantine_rows"),
        F.count(F.when(bad, F.col("VIN"))).alias("quarantine_keyed"),
    )


def landing_metric(landed: DataFrame, bronze: DataFrame, now: Column, database: str = DATABASE_NAME) -> DataFrame:
    """Records that have landed less bronze rows, as a row of the metric history; 0 unless records were lost. Those of
    rejected documents are."""
    facts = one_row([landed.select("records"), bronze.agg(F.count(F.lit(1)).alias("bronze_rows"))])
    value = F.col("records") - F.col("bronze_rows")
    return _entries(facts, [(BRONZE_NAME, LANDING, value)], now, database)


def landing_entry(spark: SparkSession, lost: int, now: Column, database: str = DATABASE_NAME) -> DataFrame:
    """``landing_metric`` where the records that were lost have been counted."""
    facts = spark.createDataFrame([(lost,)], "lost long")
    return _entries(facts, [(BRONZE_NAME, LANDING, F.col("lost"))], now, database)


def _key_profile(bronze: DataFrame, column: str) -> DataFrame:
    # Grouping first: NULL keys meet as one partial count per task, not as rows.
    per_key = bronze.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.count(column).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col(column).isNull(), F.col("n"))), F.lit(0)).alias("null_rows"),
    )


def _reconciled(strict: bool) -> Column:
    expected = F.col("distinct_keys") + (F.col("null_rows") if strict else F.lit(0))
    return expected - F.col("silver_rows") - F.col("quarantine_rows")


def _silver_profile(silver: DataFrame) -> DataFrame:
    per_key = silver.groupBy("VIN").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(broken_rule()).alias("broken"), F.max("LOAD_TS").alias("newest")
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("silver_rows"),
        F.coalesce(F.sum(F.when(F.col("VIN").isNotNull(), F.col("n"))), F.lit(0)).alias("silver_keyed"),
        F.count_if(F.col("n") > 1).alias("silver_repeated"),
        F.coalesce(F.sum("broken"), F.lit(0)).alias("silver_broken"),
        F.max("newest").alias("silver_newest"),
    )


def evaluate_metrics(
    bronze: DataFrame,
    silver: DataFrame,
    quarantine: DataFrame,
    now: Column,
    strict: bool = False,
    database: str = DATABASE_NAME,
) -> DataFrame:
    """The six measurements as metric-history rows, in one pass over each table."""
    facts = one_row([
        _key_profile(bronze, "VIN"),
        _silver_profile(silver),
        quarantine.agg(F.count(F.lit(1)).alias("quarantine_rows"), F.count("VIN").alias("quarantine_keyed")),
    ])
    return _measured(facts, now, strict, database)


def evaluate_bronze(bronze: DataFrame, now: Column, mode: str = "reference", database: str = DATABASE_NAME) -> DataFrame:
    """The same measurements for the silver and quarantine that follow from bronze, without building these."""
    return _measured(judged_profile(bronze, mode), now, mode == "strict", database)


def _measured(facts: DataFrame, now: Column, strict: bool, database: str) -> DataFrame:
    measured = [
        (SILVER_NAME, COMPLETENESS, percent("silver_keyed", "silver_rows")),
        (SILVER_NAME, DUPLICATES, F.col("silver_repeated")),
        (SILVER_NAME, RULES, F.col("silver_broken")),
        (SILVER_NAME, RECONCILIATION, _reconciled(strict)),
        (SILVER_NAME, FRESHNESS, seconds_between("silver_newest", now)),
        (QUARANTINE_NAME, COMPLETENESS, percent("quarantine_keyed", "quarantine_rows")),
    ]
    return _entries(facts, measured, now, database)


def _entries(facts: DataFrame, measured: list[tuple[str, str, Column]], now: Column, database: str) -> DataFrame:
    entries = F.array(*[
        F.struct(
            F.lit(table).alias("TABLE_NAME"),
            F.lit(metric).alias("METRIC_NAME"),
            value.cast("decimal(38,2)").alias("VALUE"),
        )
        for table, metric, value in measured
    ])
    return facts.select(F.inline(entries)).select(
        now.alias("SCHEDULED_TIME"),
        now.alias("MEASUREMENT_TIME"),
        F.lit(database).alias("TABLE_DATABASE"),
        F.lit(SCHEMA_NAME).alias("TABLE_SCHEMA"),
        "TABLE_NAME",
        "METRIC_NAME",
        "VALUE",
    )


def with_status(history: DataFrame, strict: bool = False) -> DataFrame:
    """Classify measurements. A NULL value passes, or with ``strict`` shows as NO DATA."""
    status = F.when(F.lit(strict) & F.col("VALUE").isNull(), F.lit("NO DATA"))
    for t in THRESHOLDS:
        if t.status:
            status = status.when(t.broken(), F.lit(t.text))
    return history.withColumn("QUALITY_STATUS", status.otherwise(F.lit("PASS")))


def quality_dashboard(history: DataFrame, strict: bool = False) -> DataFrame:
    return with_status(history, strict).drop("TABLE_DATABASE").orderBy(
        F.col("MEASUREMENT_TIME").desc_nulls_first(), "TABLE_NAME", "METRIC_NAME"
    )


def _any_broken(use: str) -> Column:
    return reduce(lambda a, b: a | b, [t.broken() for t in THRESHOLDS if getattr(t, use)])


def check_breaches(history: DataFrame, now: Column, hours: int = 2) -> DataFrame:
    """Number of failures the check after a run sees in the last hours, with the log fields it leads to."""
    recent = history.where(F.col("MEASUREMENT_TIME") > hours_before(now, hours))
    failures = F.col("failures")
    return recent.agg(F.count_if(_any_broken("check")).alias("failures")).select(
        "failures",
        F.when(failures > 0, F.lit("FAILURE")).otherwise(F.lit("SUCCESS")).alias("run_status"),
        F.when(failures > 0, F.lit("metric threshold breached")).alias("error_message"),
    )


def alert_breaches(history: DataFrame, since: Column) -> DataFrame:
    """Measurements after the last successful alert run that call for an alert; staleness is among them."""
    return history.where((F.col("MEASUREMENT_TIME") > since) & _any_broken("alert"))


def has_alert(history: DataFrame, since: Column) -> bool:
    return not alert_breaches(history, since).isEmpty()


def current_status(history: DataFrame) -> DataFrame:
    """Latest measurement that has a value per table and metric, with its short status."""
    latest = dedup_latest(
        history.where(F.col("VALUE").isNotNull()),
        ["TABLE_NAME", "METRIC_NAME"],
        [F.col("MEASUREMENT_TIME").desc(), F.col("VALUE").desc()],
    )
    status = with_status(latest)
    return status.select(
        "TABLE_NAME", "METRIC_NAME", "VALUE",
        F.substring_index("QUALITY_STATUS", " ", 1).alias("STATUS"), "MEASUREMENT_TIME",
    )


def metric_series(history: DataFrame) -> DataFrame:
    return history.where(F.col("VALUE").isNotNull()).select("MEASUREMENT_TIME", "METRIC_NAME", "VALUE").orderBy(
        "MEASUREMENT_TIME", "METRIC_NAME"
    )


def quarantine_breakdown(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("REJECTION_REASON").agg(F.count(F.lit(1)).alias("rejected_count")).orderBy(
        F.col("rejected_count").desc(), "REJECTION_REASON"
    )


def log_run(
    spark: SparkSession, path: str, task: str, status: str, rows: int | None, error: str | None, when
) -> None:
    """Append one line to the run log."""
    line = [(task, status, rows, error or None, when)]
    append_table(spark.createDataFrame(line, RUN_LOG), path)
