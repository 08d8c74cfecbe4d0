from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value) -> Column:
    """A column name or a Column, as a Column."""
    return value if isinstance(value, Column) else F.col(value)


def latest_first(*names: str) -> list[Column]:
    """Descending order with NULL last, for "newest row" comparisons."""
    return [F.col(n).desc_nulls_last() for n in names]
