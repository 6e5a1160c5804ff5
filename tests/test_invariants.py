"""Invariants over the driver's sf0.001 tables (SURVEY §5 (4)) and build checks."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from commerce_marts.plans import quality as PQ
from commerce_marts.plans import reports as R
from commerce_marts.plans.build import ConstraintViolation, build_all
from commerce_marts.plans.layers import Layers
from commerce_marts.session import scratch_path
from commerce_marts.sources.io import MissingSourceFiles, require_manifest
from commerce_marts.sources.schemas import SOURCES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data missing")


@pytest.fixture(scope="module")
def driver_layers(spark):
    return Layers.from_driver(spark, SF)


def test_fact_key_unique_and_no_orphans(driver_layers):
    f = driver_layers.fact_orders
    assert f.groupBy("order_id", "order_item_id").count().where("count > 1").count() == 0
    assert all(r.orphans == 0 for r in PQ.fk_orphans(driver_layers).collect())


def test_revenue_totals_agree(driver_layers):
    p = driver_layers
    exact = p.fact_orders.agg(F.sum(F.floor(F.col("price") * 100 + 0.5))).first()[0] / 100
    by_state = R.revenue_share_by_state(p.fact_orders, p.dim_customers)
    assert by_state.agg(F.sum("revenue")).first()[0] == pytest.approx(exact, abs=1e-6)
    mart = p.mart_sales_by_region.agg(F.sum("total_revenue")).first()[0]
    assert mart == pytest.approx(exact, abs=1e-6)
    exec_total = R.executive_summary(p.fact_orders, p.dim_customers, p.dim_products,
                                     p.dim_sellers).first().revenue_total
    assert exec_total == pytest.approx(exact, abs=1e-6)


def test_calendar_is_contiguous(driver_layers):
    d = driver_layers.dim_date.agg(F.min("full_date").alias("a"), F.max("full_date").alias("b"),
                                   F.count(F.lit(1)).alias("n")).first()
    assert (d.b - d.a).days + 1 == d.n


def test_on_time_plus_late_within_delivered(driver_layers):
    bad = driver_layers.mart_delivery_kpis.where(
        F.col("on_time_deliveries") + F.col("late_deliveries") > F.col("delivered_orders"))
    assert bad.count() == 0


def test_build_all_writes_every_layer(spark, driver_layers):
    written = build_all(spark, driver_layers, scratch_path(spark, "test-build"))
    layers = {}
    for name, (layer, _) in written.items():
        layers.setdefault(layer, set()).add(name)
    assert layers["staging"] == {s.table_name for s in SOURCES.values()}
    assert layers["warehouse"] == {"dim_date", "dim_customers", "dim_products", "dim_sellers",
                                   "fact_orders"}
    assert len(layers["marts"]) == 3


def test_build_all_rejects_constraint_violations(spark, driver_layers):
    class Broken(Layers):
        def warehouse(self):
            wh = super().warehouse()
            wh["dim_sellers"] = wh["dim_sellers"].unionByName(wh["dim_sellers"].limit(1))
            return wh

    broken = Broken(driver_layers.raw, driver_layers.band_cuts)
    with pytest.raises(ConstraintViolation, match="dim_sellers"):
        build_all(spark, broken, scratch_path(spark, "test-build-broken"))


def test_manifest_requires_all_files(spark):
    require_manifest(spark, SF, ["orders.parquet", "lineitem.parquet"])
    with pytest.raises(MissingSourceFiles, match="nope.parquet"):
        require_manifest(spark, SF, ["orders.parquet", "nope.parquet"])
