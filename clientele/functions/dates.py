"""Calendar arithmetic with the boundary-counting rules of the metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import _col


def months_between_boundaries(start, end) -> Column:
    """Number of month boundaries crossed: Jan 31 to Feb 1 is 1."""
    start, end = _col(start), _col(end)
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def days_between(start, end) -> Column:
    return F.datediff(_col(end), _col(start))


def month_start(c) -> Column:
    return F.trunc(_col(c), "month")


def day_of_week(c) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_col(c)) - 1


def on(as_of: dt.date) -> Column:
    """The reference date as a literal; folded at planning time, so filters on it reach the scan."""
    return F.lit(as_of)


def at_time(moment: dt.datetime) -> Column:
    """A timestamp literal without time zone, the same in every session zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def days_before(as_of: dt.date, days: int) -> dt.date:
    return as_of - dt.timedelta(days=days)


def months_before(as_of: dt.date, months: int) -> dt.date:
    """Same day ``months`` earlier, clipped to the end of a shorter month."""
    index = as_of.year * 12 + as_of.month - 1 - months
    year, month = divmod(index, 12)
    next_first = dt.date(year + (month == 11), (month + 1) % 12 + 1, 1)
    last = (next_first - dt.timedelta(days=1)).day
    return dt.date(year, month + 1, min(as_of.day, last))


def date_attributes(day, as_of: dt.date) -> list[Column]:
    """The calendar attributes of a date dimension row."""
    day = _col(day)
    dow = day_of_week(day)
    return [
        day.alias("date_day"),
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(day), F.lit(" "), F.year(day)).alias("quarter_name"),
        F.month(day).alias("month"),
        F.date_format(day, "MMM").alias("month_name"),
        F.date_format(day, "MMM yyyy").alias("month_year"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.weekofyear(day).alias("week_of_year"),
        F.weekofyear(day).alias("week_iso"),
        F.dayofmonth(day).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(day, "EEE").alias("day_name"),
        F.dayofyear(day).alias("day_of_year"),
        dow.isin(0, 6).alias("is_weekend"),
        dow.between(1, 5).alias("is_weekday"),
        (day == on(as_of)).alias("is_today"),
        (day == F.date_sub(on(as_of), 1)).alias("is_yesterday"),
        (day == F.date_add(on(as_of), 1)).alias("is_tomorrow"),
        (F.dayofmonth(day) == 1).alias("is_first_day_of_month"),
        (day == F.last_day(day)).alias("is_last_day_of_month"),
        F.year(day).alias("fiscal_year"),
        F.quarter(day).alias("fiscal_quarter"),
    ]
