"""Dates and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Timestamps as tools write them, tried in this order.
FORMATS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def read_timestamp(c: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in FORMATS])


def age_hours(then: Column, now: Column) -> Column:
    """Hours between two instants; an unreadable one counts as just now."""
    return F.coalesce(F.timestamp_diff("MICROSECOND", then, now) / 3.6e9, F.lit(0.0))


def is_null_date(c: Column) -> Column:
    return c.rlike(r"^\s*0{1,4}[./-]0{1,2}[./-]0{1,4}\s*$")
