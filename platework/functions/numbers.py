"""Aggregate and ratio expressions. ANSI mode raises on division by zero, so every divisor is guarded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from platework._columns import as_col


def percent(part, whole, digits: int = 2) -> Column:
    """``part * 100 / whole`` rounded half-up in decimal arithmetic; NULL for an empty whole.

    Decimals rather than doubles: a double such as 2.675 is already below the tie it stands for.
    """
    top = as_col(part).cast("decimal(20,0)") * F.lit(100)
    bottom = F.nullif(as_col(whole).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(top / bottom, digits)


def percent_double(part, whole, digits: int = 2) -> Column:
    return percent(part, whole, digits).cast("double")


def guarded_ratio(part, whole) -> Column:
    """``part / whole`` as double where whole > 0, else NULL."""
    whole = as_col(whole)
    return F.when(whole > 0, as_col(part) / whole.cast("double"))


def completeness(column) -> Column:
    """Percentage of rows whose column is set; NULL over no rows."""
    return percent(F.count(as_col(column)), F.count(F.lit(1)))


def sum_where(condition: Column, value) -> Column:
    """SUM(CASE WHEN condition THEN value ELSE 0 END)."""
    return F.sum(F.when(condition, as_col(value)).otherwise(F.lit(0)))
