"""Distinct vehicles per group, kept from run to run: a run adds the bitmaps of its own rows, and no row is read again."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platework.operators.bitmaps import NUMBER, distinct_counts, key_bitmaps, number_new
from platework.plans import store

BUCKETS = 64


def add_distinct(spark: SparkSession, root: str, rows: DataFrame, key: str, by: list[str], now: datetime, buckets: int = BUCKETS) -> None:
    """Number the keys that are new and add the bitmaps of ``rows`` per group of ``by``. Both become visible together; of
    the numbers known so far only the key and its number are read."""
    at = store.published(spark, root)
    numbers = at.get("numbers")
    known = store.load(spark, root, "numbers", numbers) if numbers else None
    counts: dict[int, int] = {}
    for entry in numbers.added if numbers else ():
        for bucket, n in entry.counts.items():
            counts[bucket] = counts.get(bucket, 0) + n
    batch = store.begin(spark, root, "distinct", ["numbers", "bitmaps"], now)
    new = number_new(rows, key, store.bucket_of(key, buckets), buckets, known, counts)
    written = store.write(new, root, "numbers", batch, adds=True, buckets=range(buckets))
    whole = store.Table([*(numbers.entries if numbers else ()), written])
    whole.added = [*(numbers.added if numbers else ()), written]
    numbered = rows.select(key, *by).join(store.load(spark, root, "numbers", whole), key)
    bits = store.write(key_bitmaps(numbered, by, NUMBER), root, "bitmaps", batch, adds=True, facts={"by": by})
    store.publish(spark, root, [written, bits], now)


def distinct_kept(spark: SparkSession, root: str, by: list[str], name: str = "distinct_keys") -> DataFrame:
    """Distinct keys per group of ``by`` over all runs: groups that were kept, or coarser ones."""
    table = store.published(spark, root)["bitmaps"]
    if not set(by) <= set(table.last.facts["by"]):
        raise ValueError(f"kept by {table.last.facts['by']}, not by {by}")
    return distinct_counts(store.load(spark, root, "bitmaps", table), by, name)


def distinct_in_all(spark: SparkSession, root: str, name: str = "distinct_keys") -> DataFrame:
    bits = store.load(spark, root, "bitmaps", store.published(spark, root)["bitmaps"])
    return distinct_counts(bits.withColumn("all", F.lit(True)), ["all"], name).drop("all")
