"""Deterministic keep-one-row-per-key operators.

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY …) = 1`` keeps an arbitrary
row when the order does not decide; here every remaining column is appended
as an ascending tie-breaker, so the surviving row is reproducible.

Scale: the ``rn = 1`` filter over ``row_number`` is planned by Catalyst with
a partial ``WindowGroupLimit`` before the shuffle, so each map task ships at
most one row per key.  A key that holds a third of all rows therefore costs
one row per map task in the exchange, not a third of the table in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OrderSpec = Sequence[tuple[str, str]]


def _order_col(name: str, direction: str) -> Column:
    d = direction.lower()
    if d == "desc":
        return F.col(name).desc_nulls_last()
    if d == "asc":
        return F.col(name).asc_nulls_last()
    raise ValueError(f"direction must be asc or desc, not {direction!r}")


def keep_first(df: DataFrame, keys: Sequence[str], order: OrderSpec = (),
               tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` then ``tie_breakers``.

    ``tie_breakers`` defaults to all columns not already used, ascending with
    NULLs last.
    """
    keys = list(keys)
    used = set(keys) | {c for c, _ in order}
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in used]
    ordering = [_order_col(c, d) for c, d in order] + [
        _order_col(c, "asc") for c in tie_breakers]
    if not ordering:  # the key is the whole row: plain distinct
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup_by_key(df: DataFrame, pk: Sequence[str], order: OrderSpec = ()) -> DataFrame:
    """One row per primary key; ``order`` picks the survivor (e.g. latest answer)."""
    return keep_first(df, pk, order)


def latest_per_key(df: DataFrame, key: str | Sequence[str], ts: str,
                   tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Latest row per key by ``ts`` descending (NULL timestamps last)."""
    keys = [key] if isinstance(key, str) else list(key)
    return keep_first(df, keys, [(ts, "desc")], tie_breakers)
