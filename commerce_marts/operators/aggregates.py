"""Aggregate patterns that are more than one built-in call.

* ``mode_of`` — most frequent value, ties to the lowest value (built-in
  ``mode(col, deterministic=True)``, partially aggregated per task).
* ``share_of_total`` — value / grand total as a percentage of a *grouped* result
  (states, bands, payment types: few rows).  The total is summed over these rows,
  so the source is read once.
* ``extremes`` — the labels with the largest and smallest measure.
* ``trend_line`` — least-squares line (``regr_slope``/``regr_intercept``),
  reported only with at least two points and two distinct x values.
* ``correlation`` — Pearson's, NULL where it is undefined.
* ``weighted_mean`` — Σ(value·weight) / Σweight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_marts.functions import pct, round_half_up


def mode_of(value: str | Column) -> Column:
    """Most frequent non-NULL value; ties resolve to the lowest value."""
    return F.mode(value, deterministic=True)


def share_of_total(df: DataFrame, measure: str, alias: str, digits: int = 1) -> DataFrame:
    """Add ``alias`` = round(100 * measure / Σ measure, digits) to a small grouped result."""
    total = F.sum(measure).over(Window.partitionBy(F.lit(0)))
    return df.withColumn(alias, pct(F.col(measure), total, digits))


def extremes(df: DataFrame, label: str, measure: str) -> DataFrame:
    """One row: highest, highest_value, lowest, lowest_value; ties go to the first label."""
    rank = F.struct(F.col(measure).alias("m"), F.col(label).alias("l"))
    down = F.struct((-F.col(measure)).alias("m"), F.col(label).alias("l"))
    return df.where(F.col(measure).isNotNull()).agg(F.min(down).alias("h"), F.min(rank).alias("s")).select(
        F.col("h.l").alias("highest"), (-F.col("h.m")).alias("highest_value"),
        F.col("s.l").alias("lowest"), F.col("s.m").alias("lowest_value"))


def trend_line(df: DataFrame, x: str, y: str, digits: int = 6) -> DataFrame:
    """One row: n_points, slope, intercept (NULL when the fit is undefined)."""
    n = F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.lit(1)))
    nx = F.count_distinct(F.when(F.col(y).isNotNull(), F.col(x)))
    ok = (n >= 2) & (nx >= 2)
    return df.agg(
        n.alias("n_points"),
        F.when(ok, round_half_up(F.regr_slope(F.col(y), F.col(x)), digits)).alias("slope"),
        F.when(ok, round_half_up(F.regr_intercept(F.col(y), F.col(x)), digits))
        .alias("intercept"),
    )


def correlation(x: Column, y: Column) -> Column:
    """Pearson's correlation of rows where neither is NULL; callers leave out other rows.

    NULL where either does not vary: the built-in ``corr`` divides by zero there, an error in
    ANSI mode."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def weighted_mean(value: str | Column, weight: str | Column) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    w = F.col(weight) if isinstance(weight, str) else weight
    return F.sum(v * w).cast("double") / F.sum(w).cast("double")
