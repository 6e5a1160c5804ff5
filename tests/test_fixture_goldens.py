"""Hand-derived results on the ten-order fixture (default price cuts 50/150/500)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from commerce_marts.plans import quality as PQ
from commerce_marts.plans import reports as R


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_warehouse_counts_and_orphans(layers):
    counts = {r["table_name"]: r["n_rows"] for r in PQ.table_counts(layers).collect()}
    assert counts["dim_date"] == 10
    assert counts["dim_customers"] == 10
    assert counts["dim_products"] == 3
    assert counts["dim_sellers"] == 2
    assert counts["fact_orders"] == 10
    assert all(r["orphans"] == 0 for r in PQ.fk_orphans(layers).collect())


def test_customer_keys_follow_string_order(layers):
    keys = {r["customer_unique_id"]: r["customer_key"] for r in layers.dim_customers.collect()}
    expected = sorted(f"u{i}" for i in range(1, 11))  # u1, u10, u2, ..., u9
    assert [keys[u] for u in expected] == list(range(1, 11))


def test_dim_products_bands(layers):
    got = _rows(layers.dim_products, "product_id", "avg_price", "price_band")
    assert got == [("p1", 100.0, "mid_range"), ("p2", 150.0, "premium"),
                   ("p3", 200.0, "premium")]


def test_fact_delivery_columns(layers):
    rows = layers.fact_orders.select("days_to_deliver", "days_estimated",
                                     "delivery_delay_days").distinct().collect()
    assert [tuple(r) for r in rows] == [(2, 5, -3)]


def test_executive_summary(layers):
    r = R.executive_summary(layers.fact_orders, layers.dim_customers, layers.dim_products,
                            layers.dim_sellers).first()
    assert (r.total_orders, r.revenue_total, r.avg_item_price) == (10, 1450.0, 145.0)
    assert (r.avg_review_score, r.avg_days_to_deliver, r.pct_late) == (4.1, 2.0, 0.0)
    assert (r.n_customers, r.n_products, r.n_sellers) == (10, 3, 2)


def test_mart_sales_by_region(layers):
    got = _rows(layers.mart_sales_by_region, "customer_state", "customer_city", "total_orders",
                "total_revenue", "total_freight", "avg_order_value", "avg_review_score",
                "avg_delivery_delay", "pct_late")
    assert got == [
        ("MG", "belo horizonte", 3, 450.0, 45.0, 150.0, 4.0, -3.0, 0.0),
        ("RJ", "rio de janeiro", 3, 450.0, 45.0, 150.0, 4.0, -3.0, 0.0),
        ("SP", "sao paulo", 4, 550.0, 55.0, 137.5, 4.25, -3.0, 0.0),
    ]


def test_mart_product_performance(layers):
    got = _rows(layers.mart_product_performance, "category_en", "price_band",
                "total_items_sold", "total_revenue", "total_freight", "avg_review_score",
                "avg_weight_g")
    assert got == [
        ("arts", "premium", 3, 450.0, 45.0, 4.0, 200.0),
        ("perfumery", "mid_range", 4, 400.0, 40.0, 5.0, 100.0),
        ("sports_leisure", "premium", 3, 600.0, 60.0, 3.0, 300.0),
    ]


def test_mart_delivery_kpis(layers):
    got = _rows(layers.mart_delivery_kpis, "customer_state", "order_year", "order_month",
                "total_orders", "avg_days_to_deliver", "min_days_to_deliver",
                "max_days_to_deliver", "on_time_rate_pct", "avg_delay_when_late")
    assert got == [("MG", 2024, 1, 3, 2.0, 2, 2, 100.0, None),
                   ("RJ", 2024, 1, 3, 2.0, 2, 2, 100.0, None),
                   ("SP", 2024, 1, 4, 2.0, 2, 2, 100.0, None)]


def test_payment_types(layers):
    got = _rows(R.payment_types(layers.staging["order_payments"]), "payment_type",
                "transactions", "avg_value", "total_value")
    assert got == [("boleto", 3, 165.0, 495.0), ("credit_card", 7, 157.14, 1100.0)]


def test_review_distribution_and_average(layers):
    dist = R.review_distribution(layers.staging["order_reviews"])
    assert _rows(dist, "review_score", "n_reviews", "pct") == [
        (3, 3, 30.0), (4, 3, 30.0), (5, 4, 40.0)]
    assert R.review_avg_score(dist).first().avg_score == 4.1


def test_price_bands(layers):
    got = _rows(R.price_bands(layers.fact_orders, layers.dim_products), "price_band", "items",
                "revenue")
    assert got == [("mid_range", 4, 400.0), ("premium", 6, 1050.0)]


def test_orders_by_weekday(layers):
    got = [tuple(r) for r in R.orders_by_weekday(layers.fact_orders, layers.dim_date)
           .select("day_name", "orders", "revenue").collect()]
    assert got == [("Monday", 2, 250.0), ("Tuesday", 2, 350.0), ("Wednesday", 2, 300.0),
                   ("Thursday", 1, 100.0), ("Friday", 1, 150.0), ("Saturday", 1, 200.0),
                   ("Sunday", 1, 100.0)]


def test_weekend_rules(layers):
    documented = [r.full_date for r in layers.dim_date.where("is_weekend").collect()]
    observed = [r.full_date for r in layers.dim_date_observed.where("is_weekend").collect()]
    assert sorted(documented) == [dt.date(2024, 1, 6), dt.date(2024, 1, 7)]
    assert sorted(observed) == [dt.date(2024, 1, 5), dt.date(2024, 1, 6)]


def test_trend_line_needs_two_distinct_x(layers):
    points = R.delivery_vs_satisfaction(layers.fact_orders, layers.dim_customers, min_orders=1)
    r = R.delivery_satisfaction_trend(points).first()
    assert r.n_points == 3 and r.slope is None and r.intercept is None


def test_grand_totals_agree(layers):
    """Σ revenue is the same through every report and the sales mart."""
    f, dc, dd = layers.fact_orders, layers.dim_customers, layers.dim_date
    total = 1450.0
    assert R.revenue_by_state(f, dc, k=None).agg(F.sum("revenue")).first()[0] == total
    assert R.revenue_over_time(f, dd).agg(F.sum("revenue")).first()[0] == total
    assert R.orders_by_weekday(f, dd).agg(F.sum("revenue")).first()[0] == total
    assert layers.mart_sales_by_region.agg(F.sum("total_revenue")).first()[0] == total


def test_dq_results_all_pass(layers):
    failing = PQ.dq_results(layers).where("status <> 'pass'").collect()
    assert failing == []
