"""Contiguous daily calendar dimension.

The bounds are a one-row aggregate (min/max date, partial aggregation on
every task); the day rows come from ``explode(sequence(min, max, 1 day))``.
The calendar length is the number of days in the range — bounded by the
business period, not by the data volume — so it is safe to broadcast.

Weekday numbering
-----------------
``documented``: Monday=0 … Sunday=6, weekend = Saturday and Sunday.  This
is the stated contract of the calendar table.
``observed``: Sunday=0 … Saturday=6 with ``>= 5`` as weekend, which flags
Friday and Saturday.  This reproduces the SQL as written in the modelled
warehouse build and is kept as an explicit option.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_marts.functions import date_key


def date_bounds(df: DataFrame, ts_col: str) -> DataFrame:
    """One row: min_date, max_date of ``ts_col`` cast to date."""
    d = F.to_date(F.col(ts_col))
    return df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"))


def build_calendar(bounds: DataFrame, weekday: str = "documented") -> DataFrame:
    """Calendar rows for every day between ``min_date`` and ``max_date``."""
    if weekday == "documented":
        dow = F.weekday("full_date")
    elif weekday == "observed":
        dow = F.dayofweek("full_date") - 1
    else:
        raise ValueError("weekday must be 'documented' or 'observed'")
    days = bounds.select(F.explode(F.sequence(
        "min_date", "max_date", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return days.select(
        date_key("full_date").alias("date_key"),
        F.col("full_date"),
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.weekofyear("full_date").alias("week_of_year"),
        F.dayofmonth("full_date").alias("day_of_month"),
        dow.cast("int").alias("day_of_week"),
        F.date_format("full_date", "EEEE").alias("day_name"),
        (dow >= 5).alias("is_weekend"),
    )
