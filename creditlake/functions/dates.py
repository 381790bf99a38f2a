"""Calendar fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """yyyymmdd as an int."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_name(d: Column) -> Column:
    """English month name in full."""
    return F.date_format(d, "MMMM")


def weekday_monday0(d: Column) -> Column:
    return F.weekday(d)


def weekday_monday1(d: Column) -> Column:
    return F.weekday(d) + 1
