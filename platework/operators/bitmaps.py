"""Distinct counts that can be added up: exact bitmaps over numbered keys.

A key gets its number once, within the bucket of its hash, so that numbering needs no order over all keys: the new keys of
a bucket continue where its count stands. Bitmaps of parts (runs, days, files) are merged by OR, in any order, and counted
without reading a row again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platework._columns import as_col

NUMBER = "number"


def number_new(keys: DataFrame, key: str, bucket: Column, buckets: int, known: DataFrame | None, counts: dict[int, int]) -> DataFrame:
    """(key, bucket, number) of the keys that are not among the ``known`` ones; nulls get none.

    ``bucket`` is the key's, below ``buckets``; ``counts`` holds how many known keys each bucket has. A number is the key's
    place in its bucket times the number of buckets plus the bucket: numbers are dense as long as buckets are even.
    """
    new = keys.where(F.col(key).isNotNull()).select(key).distinct()
    if known is not None:
        new = new.join(known.select(key), key, "left_anti")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(key)) - 1
    before = F.lit(0).cast("long")
    if counts:
        pairs = F.map_from_arrays(
            F.array(*[F.lit(b) for b in counts]), F.array(*[F.lit(n).cast("long") for n in counts.values()]))
        before = F.coalesce(F.element_at(pairs, F.col("bucket")), before)
    return new.withColumn("bucket", bucket).withColumn(NUMBER, (before + place) * buckets + F.col("bucket"))


def key_bitmaps(rows: DataFrame, by: list[str], number: str | Column = NUMBER) -> DataFrame:
    """Per group, the set of numbers as bitmaps of 32,768 each; null numbers are in none."""
    number = as_col(number)
    return rows.where(number.isNotNull()).groupBy(*by, F.bitmap_bucket_number(number).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def merged_bitmaps(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    return bitmaps.groupBy(*by, "part").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, by: list[str], name: str = "distinct_keys") -> DataFrame:
    """Distinct keys per group over all bitmaps given."""
    return merged_bitmaps(bitmaps, by).groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))
