"""Scalar column functions.

Rounding: ``round_half_up(x, n)`` scales by ``10**n``, rounds half away from
zero and scales back.  That is the arithmetic definition of ``ROUND(x, n)``
on doubles used by the modelled SQL; Spark's own ``round(x, n)`` rounds the
shortest decimal text of ``x`` and differs on values such as 1.005.

Money: amounts are summed as decimals of 18 places and 20 digits before them, so
no amount is rounded to cents before the sum.  The result is independent of row
order and of how Spark partitions the input, which a double sum is not.  An amount
or a sum that doesn't fit, or that is no number, is an error, never a wrong value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: ColumnOrName, n: int = 0) -> Column:
    """ROUND(x, n) with half-away-from-zero on the scaled double."""
    if n == 0:
        return F.round(_c(c), 0)
    scale = float(10 ** n)
    return F.round(_c(c) * F.lit(scale), 0) / F.lit(scale)


#: Fixed value: a double of 0.1 and more has at most 17 decimal places in shortest form.
MONEY = "decimal(38,18)"


def money(c: ColumnOrName) -> Column:
    """A money amount as a decimal; one that has no such decimal is an error in any mode."""
    x = _c(c)
    exact = x.try_cast(MONEY)
    return F.when(exact.isNotNull() | x.isNull(), exact).otherwise(
        F.raise_error(F.concat(F.lit("amount outside of " + MONEY + ": "), x.cast("string")))
        .cast(MONEY))


def money_total(c: ColumnOrName) -> Column:
    """Exact sum of decimals; a sum over the range is an error in any mode; NULL if none."""
    total, n = F.sum(_c(c)), F.count(_c(c))
    return F.when(total.isNotNull() | (n == 0), total).otherwise(
        F.raise_error(F.lit("sum outside of " + MONEY)).cast(MONEY))


def money_sum(c: ColumnOrName) -> Column:
    """Exact sum of a money column as a double; NULL if none."""
    return money_total(money(c)).cast("double")


def money_mean(c: ColumnOrName) -> Column:
    """Exact mean of a money column: exact sum divided by the count."""
    n = F.count(_c(c))
    return F.when(n > 0, money_sum(c) / n)


def pct(numerator: ColumnOrName, denominator: ColumnOrName, n: int = 1) -> Column:
    """round(100 * num / den, n) with a NULL result when den is 0 (NULLIF guard)."""
    num, den = _c(numerator), _c(denominator)
    return round_half_up(F.lit(100.0) * num.cast("double") / F.nullif(den, F.lit(0)), n)


# Default price-band cuts (currency units) and labels.
DEFAULT_BAND_CUTS = (50.0, 150.0, 500.0)
BAND_LABELS = ("budget", "mid_range", "premium", "luxury")


def price_band(avg_price: ColumnOrName, cuts: Sequence[float] = DEFAULT_BAND_CUTS,
               none_label: str = "no_sales", labels: Sequence[str] = BAND_LABELS) -> Column:
    """CASE chain: NULL → none_label, < cut0 → labels[0], … , else labels[-1]."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("need exactly one more label than cuts")
    p = _c(avg_price)
    expr = F.when(p.isNull(), F.lit(none_label))
    for cut, label in zip(cuts, labels):
        expr = expr.when(p < F.lit(float(cut)), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def date_key(d: ColumnOrName) -> Column:
    """Integer YYYYMMDD key of a date (or timestamp) column."""
    d = F.to_date(_c(d))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole days from start to end (end − start) on the calendar dates."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start))).cast("int")


def safe_timestamp(c: ColumnOrName) -> Column:
    """Text → timestamp without zone; unparsable text becomes NULL."""
    return _c(c).try_cast("timestamp_ntz")


def lower_trim(c: ColumnOrName) -> Column:
    return F.lower(F.trim(_c(c)))


def upper_trim(c: ColumnOrName) -> Column:
    return F.upper(F.trim(_c(c)))
