"""Generic DataFrame operators (columns and thresholds are arguments)."""

from commerce_marts.operators.aggregates import mode_of, share_of_total, trend_line, weighted_mean
from commerce_marts.operators.calendar import build_calendar, date_bounds
from commerce_marts.operators.dedup import dedup_by_key, keep_first, latest_per_key
from commerce_marts.operators.keys import lookup_key, shuffled, surrogate_key

__all__ = [
    "build_calendar", "date_bounds", "dedup_by_key", "keep_first", "latest_per_key",
    "lookup_key", "mode_of", "share_of_total", "shuffled", "surrogate_key", "trend_line",
    "weighted_mean",
]
