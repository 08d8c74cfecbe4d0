"""Grouped results and what is computed across their rows.

Windows here always run over rows that were grouped first: shares, running totals and growth read one
row per group, never the raw table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platework.functions.numbers import percent_double


def count_by(df: DataFrame, keys: list[str], out: str = "n", **more: Column) -> DataFrame:
    aggregates = [F.count(F.lit(1)).alias(out)] + [c.alias(name) for name, c in more.items()]
    return df.groupBy(*keys).agg(*aggregates)


def with_share(grouped: DataFrame, count: str, out: str, digits: int = 2) -> DataFrame:
    """Percentage of the total count held by each group.

    The total is a scalar subquery over the grouped rows, so any number of groups stays distributed.
    """
    total = grouped.agg(F.sum(count)).scalar()
    return grouped.withColumn(out, percent_double(F.col(count), total, digits))


def running_total(grouped: DataFrame, count: str, partition: list[str], order: str, out: str) -> DataFrame:
    """Running sum in ascending order, NULL last; equal order values share one total (RANGE frame).

    A window partition holds one row per value of ``order``.
    """
    window = Window.partitionBy(*partition).orderBy(F.col(order).asc_nulls_last())
    return grouped.withColumn(out, F.sum(count).over(window))


def with_growth(grouped: DataFrame, total: str, order: str, previous: str, growth: str) -> DataFrame:
    """Previous row's total and growth over it in percent; the window reads one row per ``order`` value."""
    window = Window.orderBy(F.col(order).asc_nulls_last())
    lagged = grouped.withColumn(previous, F.lag(total).over(window))
    return lagged.withColumn(growth, percent_double(F.col(total) - F.col(previous), F.col(previous)))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First k rows in an order that must end in a unique key."""
    return df.orderBy(*order).limit(k)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys used by more than one row, with their count; NULL is a key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
