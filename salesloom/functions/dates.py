"""Calendar parts of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_key(day: Column) -> Column:
    """Day as the integer YYYYMMDD."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_of_week(day: Column) -> Column:
    """Weekday with Sunday as 0."""
    return F.dayofweek(day) - 1


def is_first_of_month(day: Column) -> Column:
    return day == F.trunc(day, "MM")


def is_last_of_month(day: Column) -> Column:
    return day == F.last_day(day)


def calendar_columns(day: Column, weekend_days=(5, 6)) -> dict[str, Column]:
    """Every calendar attribute of ``day`` by its column name.

    ``weekend_days`` counts from Sunday = 0.  The default marks Friday and
    Saturday; pass ``(6, 0)`` for Saturday and Sunday.
    """
    return {
        "date_key": day_key(day),
        "date_day": day,
        "day_of_week": day_of_week(day),
        "day_name": F.date_format(day, "EEEE"),
        "day_of_month": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day),
        "month_number": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "is_weekend": day_of_week(day).isin(*weekend_days),
        "is_first_day_of_month": is_first_of_month(day),
        "is_last_day_of_month": is_last_of_month(day),
    }
