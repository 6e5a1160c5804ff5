"""Results that cover the whole job: every exported mart, every raw table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from commerce_marts.functions import money_mean, money_sum
from commerce_marts.operators.keys import surrogate_key
from commerce_marts.plans import marts as M
from commerce_marts.plans import quality as PQ
from commerce_marts.sources import io
from commerce_marts.sources.schemas import WAREHOUSE_SCHEMAS


def test_export_reads_every_mart_back(layers, tmp_path):
    back = io.export_checked(layers.marts(), str(tmp_path))
    assert set(back) == set(M.MART_KEYS)
    values = M.mart_values(back).groupBy("mart_name").count().collect()
    assert {r["mart_name"] for r in values} == set(M.MART_KEYS)


@pytest.mark.parametrize("lossy", sorted(M.MART_KEYS))
def test_lossy_export_of_any_mart_is_an_error(layers, tmp_path, monkeypatch, lossy):
    write = io.write_table

    def losing(df, path):
        if not path.endswith(lossy):
            return write(df, path)
        whole = df.sparkSession.read.parquet(write(df, f"{path}-whole"))
        return write(whole.limit(1), path)

    monkeypatch.setattr(io, "write_table", losing)
    with pytest.raises(ValueError, match=lossy):
        io.export_checked(layers.marts(), str(tmp_path))


def test_duplicate_samples_cover_every_table(fixture_raw):
    raw = dict(fixture_raw)
    for name in ("sellers", "order_payments"):
        raw[name] = raw[name].unionByName(raw[name].limit(1))
    found = {(r["table_name"], r["copies"]) for r in PQ.duplicate_key_samples(raw).collect()}
    plain = {(r["table_name"], r["copies"])
             for r in PQ.duplicate_key_samples(fixture_raw).collect()}
    assert {t for t, _ in found - plain} == {"olist_sellers_dataset.csv",
                                             "olist_order_payments_dataset.csv"}


def test_export_of_empty_marts(layers, tmp_path):
    empty = {name: df.where("1 = 0") for name, df in layers.marts().items()}
    assert all(df.count() == 0 for df in io.export_checked(empty, str(tmp_path)).values())


def _amounts(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double").repartition(3)


@pytest.mark.parametrize("values, total", [
    ([0.004] * 3, 0.012), ([1e17], 1e17), ([1e17, 0.01, -1e17], 0.01), ([1e-7] * 4, 4e-7),
    ([0.1] * 10, 1.0), ([-0.005, -0.005], -0.01)])
def test_money_is_summed_without_rounding_or_saturation(spark, values, total):
    r = _amounts(spark, values).agg(money_sum("x").alias("s"), money_mean("x").alias("m")).first()
    assert (r.s, r.m) == (total, total / len(values))


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("values", [[1e21, 1.0], [6e19, 6e19], [float("inf")], [float("nan"), 2.0]])
def test_money_over_the_range_is_an_error(spark, ansi, values):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="outside of decimal|[Oo]verflow|OUT_OF_RANGE"):
            _amounts(spark, values).agg(money_sum("x")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_marts_sum_sub_cent_amounts(layers):
    joined = layers.int_orders_items_joined.withColumn("price", F.lit(0.004))
    sales = M.mart_sales_by_region(joined, layers.views["stg_customers"])
    assert {(r["total_items"], r["total_revenue"]) for r in sales.collect()} == {
        (n, float(f"{n * 0.004:.2f}")) for n in {r["total_items"] for r in sales.collect()}}
    assert any(r["total_revenue"] > 0 for r in sales.collect())


def test_surrogate_keys_are_long(spark):
    keyed = surrogate_key(spark.createDataFrame([("b",), ("a",)], "k string"), "k", "sk")
    assert keyed.schema["sk"].dataType.simpleString() == "bigint"
    wide = spark.createDataFrame([(3_000_000_000, "u", "c", "s")], "customer_key long, "
                                 "customer_unique_id string, customer_city string, customer_state string")
    kept = io.conform(wide, WAREHOUSE_SCHEMAS["dim_customers"]).first()
    assert kept["customer_key"] == 3_000_000_000
