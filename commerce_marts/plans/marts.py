"""Intermediate models and the three marts.

``int_orders_items_joined`` keeps natural keys at item grain (inner join
with orders only; payments and reviews pre-aggregated per order).  The marts
group it by state/city, category/price band and state/year/month.

Naming kept from the modelled marts (documented, not "fixed"):
``delivered_orders``, ``on_time_deliveries`` and ``late_deliveries`` count
*items*; the late percentage's denominator is the number of items with a
delivery day count, so an item without an estimate counts as neither.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_marts.functions import money_mean, money_sum, pct, price_band, round_half_up
from commerce_marts.functions.scalar import DEFAULT_BAND_CUTS, money, money_total
from commerce_marts.operators.keys import shuffled
from commerce_marts.plans.warehouse import (
    delivery_columns,
    order_payments_agg,
    order_reviews_agg,
    product_prices,
)


def int_orders_items_joined(items: DataFrame, orders: DataFrame, payments: DataFrame,
                            reviews: DataFrame) -> DataFrame:
    pay = order_payments_agg(payments).drop("n_payments")
    rev = order_reviews_agg(reviews).drop("n_reviews")
    o = delivery_columns(orders).drop("days_estimated")
    joined = (items.join(o, "order_id").join(pay, "order_id", "left")
              .join(rev, "order_id", "left"))
    return joined.select(
        "order_id", "order_item_id", "customer_id", "product_id", "seller_id",
        "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date", "price", "freight_value",
        (F.col("price") + F.col("freight_value")).alias("total_item_value"),
        "total_payment_value", "main_payment_type", "review_score", "purchase_date",
        "delivered_date", "estimated_date", "days_to_deliver", "delivery_delay_days")


def int_products_enriched(products: DataFrame, translation: DataFrame, items: DataFrame,
                          cuts: Sequence[float] = DEFAULT_BAND_CUTS,
                          prices: DataFrame | None = None) -> DataFrame:
    """``prices``: ``product_prices(items)`` as written, so the items are not grouped again."""
    prices = (product_prices(items) if prices is None else prices).select(
        "product_id", F.col("avg_price_2").alias("avg_price"), "total_items_sold")
    joined = (products.join(translation, "product_category_name", "left")
              .join(shuffled(prices), "product_id", "left"))
    return joined.select(
        "product_id",
        F.col("product_category_name").alias("category_pt"),
        F.coalesce("product_category_name_english", F.lit("other")).alias("category_en"),
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
        "avg_price",
        F.coalesce("total_items_sold", F.lit(0)).alias("total_items_sold"),
        price_band("avg_price", cuts, none_label="no_sales").alias("price_band"))


def _late(c: str = "delivery_delay_days"):
    return F.sum(F.when(F.col(c) > 0, 1).otherwise(0)).cast("long")


def _on_time(c: str = "delivery_delay_days"):
    return F.sum(F.when(F.col(c) <= 0, 1).otherwise(0)).cast("long")


def _ratio(s: str, n: str):
    return F.when(F.sum(n) > 0, F.sum(s).cast("double") / F.sum(n))


def mart_sales_by_region(oij: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales KPIs per customer state and city.

    Two-level aggregation instead of two COUNT(DISTINCT) at item grain (which
    Catalyst expands to three copies of every item row before the shuffle):
    items are first combined per order — an order has exactly one customer
    row, both being deduplicated on their keys — so the join and the second level
    see one row per order.  Over a model laid out by order_id the first level needs no
    exchange.  The distinct customers are an aggregate of their own, joined by group, so
    the distinct ships its keys without the sums beside them.  Sums and counts
    are carried separately, so every mean is the item-level mean.
    """
    place = customers.select("customer_id", "customer_unique_id", "customer_state", "customer_city")
    per_order = oij.where(F.col("customer_id").isNotNull()).groupBy("order_id", "customer_id").agg(
        F.count(F.lit(1)).alias("_items"),
        money_total(money("price")).alias("_price_s"), F.count("price").alias("_price_n"),
        money_total(money("freight_value")).alias("_freight_s"),
        F.sum("review_score").alias("_rev_s"), F.count("review_score").alias("_rev_n"),
        F.sum("days_to_deliver").alias("_days_s"), F.count("days_to_deliver").alias("_days_n"),
        F.sum("delivery_delay_days").alias("_delay_s"),
        F.count("delivery_delay_days").alias("_delay_n"),
        _late().alias("_late")).join(shuffled(place.drop("customer_unique_id")), "customer_id")
    people = (oij.select("customer_id").distinct().join(shuffled(place), "customer_id")
              .groupBy(F.col("customer_state").alias("_state"), F.col("customer_city").alias("_city"))
              .agg(F.count_distinct("customer_unique_id").alias("unique_customers")))
    revenue = money_total("_price_s").cast("double")
    n_orders = F.count(F.lit(1))
    sums = per_order.groupBy("customer_state", "customer_city").agg(
        n_orders.alias("total_orders"),
        F.sum("_items").alias("total_items"),
        round_half_up(revenue, 2).alias("total_revenue"),
        round_half_up(money_total("_freight_s").cast("double"), 2).alias("total_freight"),
        round_half_up(revenue / n_orders, 2).alias("avg_order_value"),
        round_half_up(F.when(F.sum("_price_n") > 0, revenue / F.sum("_price_n")), 2)
        .alias("avg_item_price"),
        round_half_up(_ratio("_rev_s", "_rev_n"), 2).alias("avg_review_score"),
        round_half_up(_ratio("_days_s", "_days_n"), 1).alias("avg_days_to_deliver"),
        round_half_up(_ratio("_delay_s", "_delay_n"), 1).alias("avg_delivery_delay"),
        F.sum("_late").alias("late_deliveries"),
        pct(F.sum("_late"), F.sum("_days_n"), 1).alias("pct_late"))
    same = F.col("customer_state").eqNullSafe(F.col("_state")) & F.col("customer_city").eqNullSafe(F.col("_city"))
    measures = [c for c in sums.columns if c not in ("customer_state", "customer_city", "total_orders", "total_items")]
    return sums.join(people, same).select(
        "customer_state", "customer_city", "total_orders", "total_items", "unique_customers", *measures)


def mart_product_performance(oij: DataFrame, products_enriched: DataFrame) -> DataFrame:
    """Sales KPIs per English category and price band.

    The sums, the distinct products and the distinct orders per group are three
    aggregates that are joined by group: a distinct then ships its keys alone, without
    the sums beside them, and the item rows need no three-fold ``Expand``.
    """
    groups = ["category_en", "price_band"]
    j = oij.join(products_enriched.select("product_id", "category_en", "price_band",
                                          "product_weight_g"), "product_id")
    mean = lambda c: F.when(F.count(c) > 0, F.sum(c).cast("double") / F.count(c))
    sums = j.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("total_items_sold"),
        round_half_up(money_sum("price"), 2).alias("total_revenue"),
        round_half_up(money_mean("price"), 2).alias("avg_item_price"),
        round_half_up(money_sum("freight_value"), 2).alias("total_freight"),
        round_half_up(mean("review_score"), 2).alias("avg_review_score"),
        round_half_up(mean("product_weight_g"), 0).alias("avg_weight_g"))
    products = j.groupBy(*groups).agg(F.count_distinct("product_id").alias("unique_products"))
    orders = j.groupBy(*groups).agg(F.count_distinct("order_id").alias("total_orders"))
    return sums.join(products, groups).join(orders, groups).select(
        "category_en", "price_band", "total_orders", "total_items_sold", "unique_products",
        "total_revenue", "avg_item_price", "total_freight", "avg_review_score", "avg_weight_g")


def mart_delivery_kpis(oij: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivery KPIs per customer state, year and month of purchase, of delivered items.

    As in ``mart_sales_by_region`` the items are combined per order first, so the join with
    the customers sends one row an order; sums and counts are carried separately."""
    day = F.to_date("order_purchase_timestamp")
    late_days = F.when(F.col("delivery_delay_days") > 0, F.col("delivery_delay_days"))
    per_order = oij.where((F.col("order_status") == "delivered") & F.col("customer_id").isNotNull()).groupBy(
        "order_id", "customer_id", F.year(day).alias("order_year"), F.month(day).alias("order_month")).agg(
        F.sum("days_to_deliver").alias("_days_s"), F.count("days_to_deliver").alias("_days_n"),
        F.min("days_to_deliver").alias("_days_min"), F.max("days_to_deliver").alias("_days_max"),
        _on_time().alias("_on_time"), _late().alias("_late"),
        F.sum(late_days).alias("_over_s"), F.count(late_days).alias("_over_n"),
        F.sum("review_score").alias("_rev_s"), F.count("review_score").alias("_rev_n"))
    j = per_order.withColumn("_orders", F.col("order_id").isNotNull().cast("long")).drop("order_id").join(
        shuffled(customers.select("customer_id", "customer_state")), "customer_id")
    return j.groupBy("customer_state", "order_year", "order_month").agg(
        F.sum("_orders").alias("total_orders"),
        F.sum("_days_n").alias("delivered_orders"),
        round_half_up(_ratio("_days_s", "_days_n"), 1).alias("avg_days_to_deliver"),
        F.min("_days_min").alias("min_days_to_deliver"),
        F.max("_days_max").alias("max_days_to_deliver"),
        F.sum("_on_time").alias("on_time_deliveries"),
        F.sum("_late").alias("late_deliveries"),
        pct(F.sum("_on_time"), F.sum("_days_n"), 1).alias("on_time_rate_pct"),
        round_half_up(_ratio("_over_s", "_over_n"), 1).alias("avg_delay_when_late"),
        round_half_up(_ratio("_rev_s", "_rev_n"), 2).alias("avg_review_score"))


MART_KEYS = {
    "mart_sales_by_region": ("customer_state", "customer_city"),
    "mart_product_performance": ("category_en", "price_band"),
    "mart_delivery_kpis": ("customer_state", "order_year", "order_month"),
}


def mart_values(marts: Mapping[str, DataFrame]) -> DataFrame:
    """mart_name, key, column_name, value: every measure of every mart in long form."""
    out = None
    for name, df in marts.items():
        keys = MART_KEYS[name]
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in keys]
        rest = [c for c in df.columns if c not in keys]
        long = df.select(F.concat_ws(",", *parts).alias("key"),
                         *[F.col(c).cast("double").alias(c) for c in rest]).unpivot(
            ["key"], rest, "column_name", "value")
        long = long.select(F.lit(name).alias("mart_name"), "key", "column_name", "value")
        out = long if out is None else out.unionByName(long)
    return out
