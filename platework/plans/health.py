"""Counts and summaries over the layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platework.functions.times import minutes_between
from platework.operators.scalars import labelled_counts, one_row
from platework.plans import quality

# Outcome texts of the reconciliation.
PASS_TEXT = "PASS — all vehicles accounted for (dedup reduces raw rows to distinct VINs)"
INVESTIGATE_TEXT = "INVESTIGATE — row count mismatch"


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return labelled_counts(tables)


def layer_health(
    raw: DataFrame, bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, fact: DataFrame
) -> DataFrame:
    """One row of counts per layer and whether silver and quarantine account for every vehicle."""
    per_vin = bronze.groupBy("VIN").agg(F.count(F.lit(1)).alias("n"))
    counts = one_row([
        raw.agg(F.count(F.lit(1)).alias("raw_variant")),
        per_vin.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("bronze_parsed"), F.count("VIN").alias("bronze_distinct_vins")
        ),
        silver.agg(F.count(F.lit(1)).alias("silver")),
        quarantine.agg(F.count(F.lit(1)).alias("quarantine")),
        fact.agg(F.count(F.lit(1)).alias("gold_fact")),
    ])
    return _with_outcome(counts)


def _with_outcome(counts: DataFrame, unkeyed: int = 0) -> DataFrame:
    both = F.col("silver") + F.col("quarantine")
    return counts.withColumns({
        "silver_plus_quarantine": both,
        "reconciliation_status": F.when(F.col("bronze_distinct_vins") + unkeyed == both, F.lit(PASS_TEXT)).otherwise(
            F.lit(INVESTIGATE_TEXT)
        ),
    })


def written_health(
    spark: SparkSession, raw: int, bronze: int, vins: int, silver: int, quarantine: int, fact: int, unkeyed: int = 0
) -> DataFrame:
    """``layer_health`` from counts that were taken while the layers were written. ``unkeyed``: bronze rows without a VIN
    that quarantine has to hold, each of them. A fact that has not silver's rows is a mismatch too."""
    names = "raw_variant", "bronze_parsed", "bronze_distinct_vins", "silver", "quarantine", "gold_fact"
    counts = spark.createDataFrame([(raw, bronze, vins, silver, quarantine, fact)], ", ".join(f"{n} long" for n in names))
    found = _with_outcome(counts, unkeyed)
    whole = F.col("silver") == F.col("gold_fact")
    return found.withColumn(
        "reconciliation_status", F.when(whole, F.col("reconciliation_status")).otherwise(F.lit(INVESTIGATE_TEXT)))


def bronze_health(raw: DataFrame, bronze: DataFrame, mode: str = "reference") -> DataFrame:
    """``layer_health`` of the layers that follow from bronze, which is read once; the fact has silver's rows."""
    counts = one_row([raw.agg(F.count(F.lit(1)).alias("raw_variant")), quality.judged_profile(bronze, mode)])
    return _with_outcome(counts.select(
        "raw_variant", F.col("bronze_rows").alias("bronze_parsed"), F.col("distinct_keys").alias("bronze_distinct_vins"),
        F.col("silver_rows").alias("silver"), F.col("quarantine_rows").alias("quarantine"),
        F.col("silver_rows").alias("gold_fact"),
    ))


def ingested_files(raw: DataFrame) -> DataFrame:
    return raw.select("source_file", "loaded_at").orderBy(F.col("loaded_at").desc(), "source_file")


def freshness_summary(silver: DataFrame, now: Column) -> DataFrame:
    return silver.agg(F.count(F.lit(1)).alias("row_count"), F.max("LOAD_TS").alias("most_recent_record")).withColumn(
        "minutes_since_latest", minutes_between("most_recent_record", now)
    )


def is_stale(df: DataFrame, column: str, now: Column, max_minutes: int) -> bool:
    """Whether the newest row is older than the lag allowed; an empty table is stale."""
    age = df.agg(minutes_between(F.max(column), now).alias("age")).first()["age"]
    return age is None or age > max_minutes
