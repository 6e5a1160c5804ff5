"""Physical-plan properties that the scale design depends on."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from commerce_marts.operators.dedup import dedup_by_key
from commerce_marts.operators.keys import surrogate_key
from commerce_marts.plans import marts as M


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_dedup_limits_rows_before_the_shuffle(spark):
    # one key holds a third of the rows; all copies but one must disappear map-side
    rows = [("hot", i % 7, f"v{i}") for i in range(3000)] + [
        (f"k{i}", 0, "x") for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, n int, v string").repartition(6)
    out = dedup_by_key(df, ["k"])
    plan = _plan(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    got = {r.k: (r.n, r.v) for r in out.collect()}
    assert len(got) == 6001 and got["hot"] == (0, "v0")


def test_surrogate_key_has_no_data_sized_single_partition(spark):
    df = spark.range(2000).select(F.format_string("key%05d", "id").alias("k"))
    out = surrogate_key(df, "k", "sk", num_buckets=5)
    plan = _plan(out)
    # the only single-partition step is the window over the per-bucket counts
    single = [ln for ln in plan.splitlines() if "SinglePartition" in ln]
    assert len(single) <= 1
    assert "BroadcastExchange" in plan or "BroadcastHashJoin" in plan


def test_sales_mart_avoids_distinct_expand(layers):
    plan = _plan(M.mart_sales_by_region(layers.int_orders_items_joined,
                                        layers.views["stg_customers"]))
    assert "Expand" not in plan


def test_product_mart_avoids_distinct_expand(layers):
    plan = _plan(M.mart_product_performance(layers.int_orders_items_joined,
                                            layers.int_products_enriched))
    assert "Expand" not in plan


def test_sales_mart_drops_unused_payment_mode(layers):
    plan = _plan(layers.mart_sales_by_region)
    assert "payment_type" not in plan
