"""Date helpers shared by the calendar, SCD stamping and fact keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_id(d: Column) -> Column:
    """YYYYMMDD integer key."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week_sun0(d: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(d) - 1).cast("int")


def quarter_end(d: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))


def batch_date(c: Column) -> Column:
    return c.cast("date")
