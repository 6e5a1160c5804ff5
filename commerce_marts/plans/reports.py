"""BI result sets: the data behind figures, KPI cards and the dashboard.

Every top-k has a deterministic tie-break (the measure, then the label).
Money totals use exact cent sums, so every total agrees across reports and
across re-runs regardless of partitioning.

Reports that join the fact with a dimension take it combined per order (``per_order``) or per
product (``per_product``), so the join sends one row of these and an order is counted by its
row: staging holds one row an order, so an order of the fact has one customer and one day.
Customers and products are shuffled to these joins, never broadcast: several reports run at a
time, and each would hold all customers in the driver.  Only the calendar is small enough.
Each also takes the fact itself and combines it first.  Sums and counts are carried
separately, so every mean is the item-level mean.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_marts.functions import money_mean, money_sum, pct, round_half_up
from commerce_marts.functions.scalar import money, money_total
from commerce_marts.operators.aggregates import (correlation, extremes, share_of_total, trend_line,
                                                 weighted_mean)
from commerce_marts.operators.keys import shuffled


def per_order(fact: DataFrame) -> DataFrame:
    """Sums and counts of the items of each order, its customer and day."""
    if "_items" in fact.columns:
        return fact
    days, review = F.col("days_to_deliver"), F.col("review_score")
    rated = days.isNotNull() & review.isNotNull()
    return fact.groupBy("order_id", "customer_key", "order_date_key").agg(
        F.count(F.lit(1)).alias("_items"),
        money_total(money("price")).alias("_price_s"), F.count("price").alias("_price_n"),
        F.sum(days).alias("_days_s"), F.count(days).alias("_days_n"),
        F.sum(review).alias("_rev_s"), F.count(review).alias("_rev_n"),
        F.count(F.when(F.col("delivery_delay_days") > 0, 1)).alias("_late"),
        F.count(F.when(rated, 1)).alias("_rated"), F.sum(F.when(rated, days)).alias("_rated_days"),
        F.sum(F.when(rated, review)).alias("_rated_rev"))


def per_product(fact: DataFrame) -> DataFrame:
    """Items and price of each product."""
    if "_items" in fact.columns:
        return fact
    return fact.groupBy("product_key").agg(F.count(F.lit(1)).alias("_items"),
                                           money_total(money("price")).alias("_price_s"))


def _revenue(digits: int):
    return round_half_up(money_total("_price_s").cast("double"), digits)


def _mean(s: str, n: str):
    return F.when(F.sum(n) > 0, F.sum(s).cast("double") / F.sum(n))


def _avg_price():
    n = F.sum("_price_n")
    return F.when(n > 0, money_total("_price_s").cast("double") / n)


def _fact_state(fact: DataFrame, dim_cust: DataFrame) -> DataFrame:
    return per_order(fact).join(
        shuffled(dim_cust.select("customer_key", "customer_state")), "customer_key")


def _fact_date(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return per_order(fact).join(dim_date.select(F.col("date_key").alias("order_date_key"), "year",
                                                "month", "day_name", "day_of_week"), "order_date_key")


def _fact_product(fact: DataFrame, dim_prod: DataFrame) -> DataFrame:
    return per_product(fact).join(
        shuffled(dim_prod.select("product_key", "product_category_en", "price_band")), "product_key")


def revenue_by_state(fact: DataFrame, dim_cust: DataFrame, k: int | None = 10) -> DataFrame:
    out = _fact_state(fact, dim_cust).groupBy("customer_state").agg(
        _revenue(0).alias("revenue"), F.count("order_id").alias("orders"))
    out = out.orderBy(F.col("revenue").desc(), F.col("customer_state").asc_nulls_last())
    return out.limit(k) if k else out


def revenue_over_time(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return (_fact_date(fact, dim_date).groupBy("year", "month").agg(
        _revenue(0).alias("revenue"), F.count("order_id").alias("orders"))
        .select("year", "month", F.format_string("%d-%02d", "year", "month").alias("period"),
                "revenue", "orders")
        .orderBy("year", "month"))


def top_categories(fact: DataFrame, dim_prod: DataFrame, k: int = 15) -> DataFrame:
    return (_fact_product(fact, dim_prod).where(F.col("product_category_en").isNotNull())
            .groupBy(F.col("product_category_en").alias("category"))
            .agg(_revenue(0).alias("revenue"), F.sum("_items").alias("items_sold"))
            .orderBy(F.col("revenue").desc(), F.col("category").asc_nulls_last())
            .limit(k))


def delivery_vs_satisfaction(fact: DataFrame, dim_cust: DataFrame,
                             min_orders: int = 100) -> DataFrame:
    f = per_order(fact).where(F.col("_rated") > 0)
    return (_fact_state(f, dim_cust).groupBy("customer_state").agg(
        round_half_up(_mean("_rated_days", "_rated"), 1).alias("avg_days_to_deliver"),
        round_half_up(_mean("_rated_rev", "_rated"), 2).alias("avg_review_score"),
        F.count("order_id").alias("orders"))
        .where(F.col("orders") >= min_orders))


def delivery_satisfaction_trend(points: DataFrame) -> DataFrame:
    return trend_line(points, "avg_days_to_deliver", "avg_review_score")


def orders_by_weekday(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return (_fact_date(fact, dim_date).groupBy("day_name", "day_of_week").agg(
        F.count("order_id").alias("orders"), _revenue(0).alias("revenue"))
        .orderBy("day_of_week"))


def price_bands(fact: DataFrame, dim_prod: DataFrame) -> DataFrame:
    out = _fact_product(fact, dim_prod).groupBy("price_band").agg(
        F.sum("_items").alias("items"), _revenue(0).alias("revenue"))
    out = share_of_total(out, "items", "items_pct", 1)
    out = share_of_total(out, "revenue", "revenue_pct", 1)
    return out.orderBy(F.col("revenue").desc(), "price_band")


def payment_types(payments: DataFrame) -> DataFrame:
    return (payments.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("transactions"),
        round_half_up(money_mean("payment_value"), 2).alias("avg_value"),
        round_half_up(money_sum("payment_value"), 0).alias("total_value"))
        .orderBy(F.col("transactions").desc(), "payment_type"))


def review_distribution(reviews: DataFrame) -> DataFrame:
    out = reviews.groupBy("review_score").agg(F.count(F.lit(1)).alias("n_reviews"))
    return share_of_total(out, "n_reviews", "pct", 1).orderBy("review_score")


def review_avg_score(distribution: DataFrame) -> DataFrame:
    return distribution.agg(F.sum("n_reviews").alias("n_reviews"),
                            weighted_mean("review_score", "n_reviews").alias("avg_score"))


def executive_summary(fact: DataFrame, dim_cust: DataFrame, dim_prod: DataFrame,
                      dim_sell: DataFrame) -> DataFrame:
    return per_order(fact).agg(
        F.count("order_id").alias("total_orders"),
        _revenue(2).alias("revenue_total"),
        round_half_up(_avg_price(), 2).alias("avg_item_price"),
        round_half_up(_mean("_rev_s", "_rev_n"), 2).alias("avg_review_score"),
        round_half_up(_mean("_days_s", "_days_n"), 1).alias("avg_days_to_deliver"),
        pct(F.sum("_late"), F.sum("_days_n"), 1).alias("pct_late"),
    ).select("*",
             dim_cust.select(F.count(F.lit(1))).scalar().alias("n_customers"),
             dim_prod.select(F.count(F.lit(1))).scalar().alias("n_products"),
             dim_sell.select(F.count(F.lit(1))).scalar().alias("n_sellers"))


def verify_revenue_by_state(fact: DataFrame, dim_cust: DataFrame, k: int = 5) -> DataFrame:
    return (_fact_state(fact, dim_cust).groupBy("customer_state").agg(
        F.count("order_id").alias("total_orders"),
        _revenue(2).alias("revenue_total"),
        round_half_up(_avg_price(), 2).alias("avg_item_price"),
        round_half_up(_mean("_days_s", "_days_n"), 1).alias("avg_days_to_deliver"))
        .orderBy(F.col("revenue_total").desc(), "customer_state").limit(k))


def delivery_metrics(fact: DataFrame) -> DataFrame:
    late = F.sum(F.when(F.col("delivery_delay_days") > 0, 1).otherwise(0))
    return fact.where(F.col("days_to_deliver").isNotNull()).agg(
        F.count(F.lit(1)).alias("delivered_items"),
        round_half_up(F.avg("days_to_deliver"), 1).alias("avg_days_to_deliver"),
        round_half_up(F.avg("delivery_delay_days"), 1).alias("avg_delay_days"),
        late.cast("long").alias("late_items"),
        pct(late, F.count(F.lit(1)), 1).alias("pct_late"))


def orders_customers_check(orders: DataFrame, customers: DataFrame, k: int = 5) -> DataFrame:
    j = orders.select("order_id", "customer_id").join(
        shuffled(customers.select("customer_id", "customer_unique_id", "customer_state")),
        "customer_id")
    return (j.groupBy("customer_state").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("customer_unique_id").alias("total_customers"))
        .orderBy(F.col("total_orders").desc(), "customer_state").limit(k))


def latest_orders(orders: DataFrame, k: int = 5) -> DataFrame:
    return (orders.select("order_id", "customer_id", "order_status",
                          "order_purchase_timestamp")
            .orderBy(F.col("order_purchase_timestamp").desc_nulls_last(), "order_id")
            .limit(k))


def revenue_share_by_state(fact: DataFrame, dim_cust: DataFrame) -> DataFrame:
    out = _fact_state(fact, dim_cust).groupBy("customer_state").agg(
        _revenue(2).alias("revenue"))
    return share_of_total(out, "revenue", "revenue_pct", 1).orderBy(
        F.col("revenue").desc(), "customer_state")


def payment_share(payments: DataFrame) -> DataFrame:
    out = payments.groupBy("payment_type").agg(F.count(F.lit(1)).alias("transactions"))
    return share_of_total(out, "transactions", "transactions_pct", 1).orderBy(
        F.col("transactions").desc(), "payment_type")


def dashboard_measures(sales: DataFrame, delivery: DataFrame) -> DataFrame:
    """Dashboard cards: revenue, mean on-time rate (unweighted), ticket, review."""
    on_time = delivery.select(round_half_up(money_mean("on_time_rate_pct"), 2)).scalar()
    total = money_sum("total_revenue")
    return sales.agg(
        round_half_up(total, 2).alias("total_revenue"),
        round_half_up(total / F.sum("total_orders"), 2).alias("avg_ticket"),
        round_half_up(money_mean("avg_review_score"), 2).alias("avg_review"),
    ).select("total_revenue", on_time.alias("on_time_rate"), "avg_ticket", "avg_review")


def delivery_heatmap(delivery: DataFrame, states: Sequence[str]) -> DataFrame:
    """Rows (year, month) × one column per state: mean delivery days of the cell.

    ``states`` is given, so nothing runs to find the columns."""
    return delivery.groupBy("order_year", "order_month").pivot(
        "customer_state", list(states)).agg(F.max("avg_days_to_deliver"))


def month_state_heatmap(oij: DataFrame, customers: DataFrame, states: Sequence[str]) -> DataFrame:
    """Rows calendar month (1-12, all years together) × one column per state: mean delivery days
    of the delivered items, from item grain (means of monthly means would weigh years alike)."""
    d = oij.where((F.col("order_status") == "delivered") & F.col("customer_id").isNotNull()).groupBy(
        "customer_id", F.month("purchase_date").alias("order_month")).agg(
        F.sum("days_to_deliver").alias("_days_s"), F.count("days_to_deliver").alias("_days_n"))
    return (d.join(shuffled(customers.select("customer_id", "customer_state")), "customer_id")
            .groupBy("order_month").pivot("customer_state", list(states))
            .agg(round_half_up(_mean("_days_s", "_days_n"), 1)))


def weekday_extremes(by_weekday: DataFrame) -> DataFrame:
    """Busiest and slowest weekday of ``orders_by_weekday``."""
    return extremes(by_weekday, "day_name", "orders").select(
        F.col("highest").alias("busiest_day"), F.col("highest_value").alias("busiest_orders"),
        F.col("lowest").alias("slowest_day"), F.col("lowest_value").alias("slowest_orders"))


def delivery_insights(by_weekday: DataFrame, fact: DataFrame) -> DataFrame:
    """Weekday extremes and the correlation of delivery days with the review, over items."""
    rated = fact.where(F.col("days_to_deliver").isNotNull() & F.col("review_score").isNotNull())
    x, y = F.col("days_to_deliver").cast("double"), F.col("review_score").cast("double")
    together = rated.select(F.struct(
        F.count(F.lit(1)).alias("rated_items"),
        round_half_up(correlation(x, y), 6).alias("days_review_corr"))).scalar()
    return weekday_extremes(by_weekday).withColumn("t", together).select("*", "t.*").drop("t")


def on_time_by_state(oij: DataFrame, customers: DataFrame) -> DataFrame:
    """On-time rate and mean delay when late per state, from item grain."""
    late_days = F.when(F.col("delivery_delay_days") > 0, F.col("delivery_delay_days"))
    d = oij.where((F.col("order_status") == "delivered") & F.col("customer_id").isNotNull()).groupBy(
        "customer_id").agg(
        F.sum("days_to_deliver").alias("_days_s"), F.count("days_to_deliver").alias("_days_n"),
        F.count(F.when(F.col("delivery_delay_days") <= 0, 1)).alias("_on_time"),
        F.sum(late_days).alias("_over_s"), F.count(late_days).alias("_over_n"))
    return d.join(shuffled(customers.select("customer_id", "customer_state")), "customer_id").groupBy(
        "customer_state").agg(
        F.sum("_days_n").alias("delivered_items"),
        pct(F.sum("_on_time"), F.sum("_days_n"), 1).alias("on_time_rate_pct"),
        round_half_up(_mean("_over_s", "_over_n"), 1).alias("avg_delay_when_late"),
        round_half_up(_mean("_days_s", "_days_n"), 1).alias("avg_days_to_deliver"))


def price_vs_review(product_perf: DataFrame, top: DataFrame) -> DataFrame:
    """Price vs review per category/band, restricted to the top categories."""
    keep = top.select(F.col("category").alias("category_en"))
    return product_perf.join(keep, "category_en", "left_semi").select(
        "category_en", "price_band", "avg_item_price", "avg_review_score", "total_revenue")
