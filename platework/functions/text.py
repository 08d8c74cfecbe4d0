"""Scalar expressions over text: numbers, bounded strings, points and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from platework._columns import as_col


def to_int(token) -> Column:
    """Text to integer; NULL when it does not parse ('12.7' and '' do not)."""
    return as_col(token).try_cast("int")


def to_rounded_int(token) -> Column:
    """Text to integer, fractions rounded half-up ('12.7' is 13, '-0.6' is -1); NULL when it is no number."""
    return as_col(token).try_cast("decimal(38,0)").try_cast("int")


def to_double(token) -> Column:
    """Text to double; NULL when it does not parse."""
    return as_col(token).try_cast("double")


def bounded(text, length: int) -> Column:
    """Cast to text of at most ``length`` characters (a plain Spark cast would not cut it)."""
    return F.substring(as_col(text).cast("string"), 1, length)


def point_part(text, part: int) -> Column:
    """The 1-based coordinate of a ``POINT (lng lat)`` text; NULL when there is none."""
    inner = F.replace(F.replace(as_col(text), F.lit("POINT ("), F.lit("")), F.lit(")"), F.lit(""))
    return to_double(F.split_part(inner, F.lit(" "), F.lit(part)))


def longitude(text) -> Column:
    return point_part(text, 1)


def latitude(text) -> Column:
    return point_part(text, 2)


def surrogate_key(*parts) -> Column:
    """SHA-256 hex over the parts joined by '|', with NULL read as the empty text."""
    filled = [F.coalesce(as_col(p), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", *filled), 256)


def geo_key(county="COUNTY", city="CITY", postal_code="POSTAL_CODE") -> Column:
    return surrogate_key(county, city, postal_code)
