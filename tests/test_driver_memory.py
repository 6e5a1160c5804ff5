"""Joins of tables that grow with the data are shuffled: a broadcast is built in the driver."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from commerce_marts.plans import marts as M
from commerce_marts.plans import reports as R
from commerce_marts.plans import warehouse as W
from commerce_marts.sources import bindings as BND
from tests.test_store import plan


@pytest.fixture
def kept(spark, tmp_path):
    """Writes a frame and reads it back: Spark knows the size of its files, all below the
    broadcast limit."""
    def write(name, rows, schema):
        path = str(tmp_path / f"{name}.parquet")
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.parquet(path)
    return write


@pytest.fixture
def fact(kept):
    return kept("fact", [
        ("o1", 1, 1, 20180101, 10.0, 2, 5, -1), ("o1", 1, 2, 20180101, 5.0, 2, 5, -1),
        ("o2", 2, 2, 20180102, 1.0, 4, 3, 1), ("o3", 3, 1, 20180102, 2.0, None, None, None)],
        "order_id string, customer_key long, product_key long, order_date_key int, price double, "
        "days_to_deliver int, review_score int, delivery_delay_days int")


@pytest.fixture
def customers(kept):
    return kept("dim_customers", [(1, "SP"), (2, "RJ"), (3, "SP"), (4, "MG")],
                "customer_key long, customer_state string")


def test_reports_by_state_broadcast_no_customers(fact, customers):
    revenue = R.revenue_by_state(fact, customers)
    frames = [revenue, R.delivery_vs_satisfaction(fact, customers, 1),
              R.verify_revenue_by_state(fact, customers), R.revenue_share_by_state(fact, customers)]
    for df in frames:
        assert "Broadcast" not in plan(df)
    assert [tuple(r) for r in revenue.collect()] == [("SP", 17.0, 2), ("RJ", 1.0, 1)]


def test_reports_by_product_broadcast_no_products(kept, fact):
    products = kept("dim_products", [(1, "a", "low"), (2, "b", "low"), (3, "c", "high")],
                    "product_key long, product_category_en string, price_band string")
    top = R.top_categories(fact, products)
    for df in (top, R.price_bands(fact, products)):
        assert "Broadcast" not in plan(df)
    assert [tuple(r) for r in top.collect()] == [("a", 12.0, 2), ("b", 6.0, 2)]


def test_reports_by_customer_broadcast_no_customers(kept):
    people = kept("customers", [("c1", "u1", "SP", "s"), ("c2", "u1", "SP", "s")],
                  "customer_id string, customer_unique_id string, customer_state string, "
                  "customer_city string")
    orders = kept("orders", [("o1", "c1"), ("o2", "c2"), ("o3", "c9")],
                  "order_id string, customer_id string")
    items = kept("oij", [("c1", "delivered", "2018-01-01", 3, -1), ("c2", "delivered", "2018-01-02", 5, 2)],
                 "customer_id string, order_status string, purchase_date string, days_to_deliver int, "
                 "delivery_delay_days int").withColumn("purchase_date", F.to_date("purchase_date"))
    check, heat = R.orders_customers_check(orders, people), R.month_state_heatmap(items, people, ["SP"])
    on_time = R.on_time_by_state(items, people)
    for df in (check, heat, on_time):
        assert "Broadcast" not in plan(df)
    assert [tuple(r) for r in check.collect()] == [("SP", 2, 1)]
    assert [tuple(r) for r in heat.collect()] == [(1, 4.0)]
    assert [tuple(r) for r in on_time.collect()] == [("SP", 2, 50.0, 2.0, 4.0)]


def test_customer_keys_and_product_prices_are_not_broadcast(kept):
    orders = kept("orders", [("o1", "c1", 2), ("o2", "c2", 1)],
                  "order_id string, customer_id string, order_purchase_timestamp int")
    people = kept("customers", [("c1", "u1", "s", "SP"), ("c2", "u1", "r", "RJ")],
                  "customer_id string, customer_unique_id string, customer_city string, "
                  "customer_state string")
    dim = kept("dim_customers", [("u1", 7)], "customer_unique_id string, customer_key long")
    keys, latest = W.customer_key_lookup(orders, people, dim), W.latest_customer(people, orders)
    prices = kept("prices", [("p1", 2.0, 3)], "product_id string, avg_price_2 double, total_items_sold long")
    products = kept("products", [("p1", "x", 1.0, 1.0, 1.0, 1.0), ("p2", "x", 1.0, 1.0, 1.0, 1.0)],
                    "product_id string, product_category_name string, product_weight_g double, "
                    "product_length_cm double, product_height_cm double, product_width_cm double")
    words = kept("words", [("x", "X")], "product_category_name string, product_category_name_english string")
    enriched = M.int_products_enriched(products, words, None, prices=prices)
    assert "Broadcast" not in plan(keys) and "Broadcast" not in plan(latest)
    assert plan(enriched).count("BroadcastExchange") <= 2  # the categories; once more in the details
    assert "SortMergeJoin" in plan(enriched)
    assert sorted(map(tuple, keys.collect())) == [("o1", 7), ("o2", 7)]
    assert [tuple(r) for r in latest.collect()] == [("u1", "s", "SP")]
    assert sorted((r.product_id, r.avg_price, r.total_items_sold) for r in enriched.collect()) == [
        ("p1", 2.0, 3), ("p2", None, 0)]


def test_raw_customers_broadcast_only_nations(spark, kept, tmp_path):
    kept("orders", [(1, 5), (2, 5), (3, 9)], "o_orderkey long, o_custkey long")
    kept("customer", [(5, 0)], "c_custkey long, c_nationkey int")
    kept("nation", [(0, "A", 0), (1, "B", 0)], "n_nationkey int, n_name string, n_regionkey int")
    kept("region", [(0, "AFRICA")], "r_regionkey int, r_name string")
    raw = BND.raw_customers(spark, str(tmp_path))
    assert "SortMergeJoin" in plan(raw)
    assert sorted((r.customer_id, r.customer_unique_id, r.customer_state) for r in raw.collect()) == [
        ("1", "5", "af"), ("2", "5", "af")]
