"""Time expressions; ``now`` is always passed in, so that results can be repeated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from platework._columns import as_col


def minutes_between(start, end) -> Column:
    """Minute boundaries crossed from start to end (not whole elapsed minutes)."""
    return F.timestamp_diff(
        "MINUTE", F.date_trunc("minute", as_col(start)), F.date_trunc("minute", as_col(end))
    )


def seconds_between(start, end) -> Column:
    return F.timestamp_diff("SECOND", as_col(start), as_col(end))


def hours_before(moment, hours: int) -> Column:
    return as_col(moment) - F.make_dt_interval(hours=F.lit(hours))


def days_between(start, end) -> Column:
    return F.datediff(as_col(end), as_col(start))


def wall_clock(moment) -> Column:
    """A zoned timestamp as one without zone, at microsecond scale."""
    return as_col(moment).cast("timestamp_ntz")
