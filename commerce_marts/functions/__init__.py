"""Column-level helpers built only from ``pyspark.sql.functions``.

All of them return Column expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from commerce_marts.functions.scalar import (
    money_mean,
    money_sum,
    date_key,
    days_between,
    lower_trim,
    pct,
    price_band,
    round_half_up,
    safe_timestamp,
    upper_trim,
)

__all__ = [
    "money_mean", "money_sum", "date_key", "days_between", "lower_trim", "pct",
    "price_band", "round_half_up", "safe_timestamp", "upper_trim",
]
