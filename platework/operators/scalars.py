"""Results of one row, put together from aggregates over several tables without a join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def labelled_counts(tables: dict[str, DataFrame], label: str = "table_name", count: str = "row_count") -> DataFrame:
    """One row per table: its label and its number of rows."""
    return union_all([
        df.agg(F.count(F.lit(1)).alias(count)).select(F.lit(name).alias(label), F.col(count))
        for name, df in tables.items()
    ])


def one_row(frames: list[DataFrame]) -> DataFrame:
    """Put one-row frames with different columns side by side.

    The rows are stacked with NULL for the columns they lack and folded by ``max``, so the plan is a
    union of small aggregates rather than a chain of cross joins.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
