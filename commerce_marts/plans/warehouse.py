"""Star schema: calendar, customer, product and seller dimensions, item fact.

Shuffle plan of ``fact_orders``: the item rows, the order rows and the two
per-order aggregates (payments, reviews) all hash on ``order_id``; they are
joined first, so the joined result stays partitioned by ``order_id`` and the
left joins add no exchange.  Payments and reviews are aggregated per order
*before* the join, so item rows never fan out.  The surrogate-key lookups
follow; whether a dimension is broadcast is decided by AQE from its measured
size at run time (above the threshold it is a sort-merge join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_marts.functions import (
    money_mean,
    money_sum,
    date_key,
    days_between,
    price_band,
    round_half_up,
)
from commerce_marts.functions.scalar import DEFAULT_BAND_CUTS
from commerce_marts.operators.calendar import build_calendar, date_bounds
from commerce_marts.operators.dedup import latest_per_key
from commerce_marts.operators.keys import lookup_key, shuffled, surrogate_key
from commerce_marts.sources.io import conform
from commerce_marts.sources.schemas import WAREHOUSE_SCHEMAS


def dim_date(orders: DataFrame, weekday: str = "documented") -> DataFrame:
    """Every day between the first and last purchase date."""
    return build_calendar(date_bounds(orders, "order_purchase_timestamp"), weekday)


def latest_customer(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Per real customer (unique id) the city/state of the most recent order."""
    joined = customers.join(shuffled(orders.select("customer_id", "order_purchase_timestamp")),
                            "customer_id")
    latest = latest_per_key(joined, "customer_unique_id", "order_purchase_timestamp",
                            tie_breakers=["customer_city", "customer_state"])
    return latest.select("customer_unique_id", "customer_city", "customer_state")


def dim_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return surrogate_key(latest_customer(customers, orders), "customer_unique_id",
                         "customer_key")


def product_prices(items: DataFrame) -> DataFrame:
    """Per product: exact mean price, 2-decimal mean, items sold."""
    return items.groupBy("product_id").agg(
        money_mean("price").alias("avg_price"),
        round_half_up(money_mean("price"), 2).alias("avg_price_2"),
        F.count(F.lit(1)).alias("total_items_sold"))


def dim_products(products: DataFrame, translation: DataFrame, items: DataFrame,
                 cuts: Sequence[float] = DEFAULT_BAND_CUTS,
                 prices: DataFrame | None = None) -> DataFrame:
    """``prices``: ``product_prices(items)`` as written, so the items are not grouped again."""
    prices = (product_prices(items) if prices is None else prices).select("product_id", "avg_price")
    enriched = (products.join(translation, "product_category_name", "left")
                .join(shuffled(prices), "product_id", "left"))
    out = enriched.select(
        "product_id",
        F.col("product_category_name").alias("product_category_pt"),
        F.col("product_category_name_english").alias("product_category_en"),
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
        "avg_price",
        price_band("avg_price", cuts, none_label="sin_ventas").alias("price_band"))
    return surrogate_key(out, "product_id", "product_key")


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return surrogate_key(
        sellers.select("seller_id", "seller_city", "seller_state"), "seller_id", "seller_key")


def order_payments_agg(payments: DataFrame, with_mode: bool = True) -> DataFrame:
    """Per order: exact total payment, main payment type (mode), payment count."""
    from commerce_marts.operators.aggregates import mode_of

    aggs = [money_sum("payment_value").alias("total_payment_value")]
    if with_mode:
        aggs.append(mode_of("payment_type").alias("main_payment_type"))
    aggs.append(F.count(F.lit(1)).alias("n_payments"))
    return payments.groupBy("order_id").agg(*aggs)


def order_reviews_agg(reviews: DataFrame) -> DataFrame:
    """Per order: mean review score rounded half away from zero, review count."""
    return reviews.groupBy("order_id").agg(
        round_half_up(F.avg("review_score"), 0).alias("review_score"),
        F.count(F.lit(1)).alias("n_reviews"))


def delivery_columns(orders: DataFrame) -> DataFrame:
    """Purchase/delivered/estimated dates and the three day counts per order."""
    purchase = F.to_date("order_purchase_timestamp")
    delivered = F.to_date("order_delivered_customer_date")
    estimated = F.to_date("order_estimated_delivery_date")
    return orders.select(
        "*",
        purchase.alias("purchase_date"), delivered.alias("delivered_date"),
        estimated.alias("estimated_date"),
        F.when(delivered.isNotNull(), days_between(purchase, delivered)).alias("days_to_deliver"),
        F.when(estimated.isNotNull(), days_between(purchase, estimated)).alias("days_estimated"),
        F.when(delivered.isNotNull() & estimated.isNotNull(),
               days_between(estimated, delivered)).alias("delivery_delay_days"))


def delivery_day_metrics(orders: DataFrame) -> DataFrame:
    return delivery_columns(orders).select(
        "order_id", "purchase_date", "delivered_date", "estimated_date",
        "days_to_deliver", "days_estimated", "delivery_delay_days")


def customer_key_lookup(orders: DataFrame, customers: DataFrame, dim_cust: DataFrame
                        ) -> DataFrame:
    """order → per-transaction customer → real customer → surrogate key."""
    oc = orders.select("order_id", "customer_id").join(
        shuffled(customers.select("customer_id", "customer_unique_id")), "customer_id")
    return lookup_key(oc, shuffled(dim_cust), "customer_unique_id", "customer_key").select(
        "order_id", "customer_key")


def fact_orders(items: DataFrame, orders: DataFrame, customers: DataFrame,
                payments: DataFrame, reviews: DataFrame, dim_cust: DataFrame,
                dim_prod: DataFrame, dim_sell: DataFrame,
                order_keys: DataFrame | None = None) -> DataFrame:
    """Item-grain fact with surrogate keys, payment, review and delivery metrics.

    ``order_keys`` (order_id, customer_key) replaces the lookup of the customer key; over
    tables in buckets of order_id the joins up to the item grain then need no exchange."""
    pay = order_payments_agg(payments, with_mode=False).select(
        "order_id", F.col("total_payment_value").alias("payment_value"))
    rev = order_reviews_agg(reviews).select(
        "order_id", F.col("review_score").cast("int").alias("review_score"))
    # The customer key is resolved at order grain (orders → customers →
    # dim_customers, both unique on their keys, so no fan-out); item rows are
    # then shuffled once, by order_id, together with the per-order aggregates.
    o = delivery_columns(orders).select(
        "order_id", "customer_id", "order_status", "purchase_date", "delivered_date",
        "estimated_date", "days_to_deliver", "days_estimated", "delivery_delay_days")
    if order_keys is not None:
        o = o.join(order_keys, "order_id").drop("customer_id")
    else:
        o = (o.join(shuffled(customers.select("customer_id", "customer_unique_id")), "customer_id")
             .join(shuffled(dim_cust.select("customer_unique_id", "customer_key")),
                   "customer_unique_id")
             .drop("customer_id", "customer_unique_id"))
    by_order = (items.select("order_id", "order_item_id", "product_id", "seller_id",
                             "price", "freight_value")
                .join(o, "order_id")
                .join(pay, "order_id", "left")
                .join(rev, "order_id", "left"))
    keyed = (lookup_key(by_order, dim_prod, "product_id", "product_key")
             .join(dim_sell.select("seller_id", "seller_key"), "seller_id"))
    return keyed.select(
        "order_id", "order_item_id", "customer_key", "product_key", "seller_key",
        date_key("purchase_date").alias("order_date_key"), "order_status", "price",
        "freight_value", "payment_value", "review_score",
        F.col("purchase_date").alias("order_purchase_date"),
        F.col("delivered_date").alias("order_delivered_date"),
        F.col("estimated_date").alias("order_estimated_date"),
        "days_to_deliver", "days_estimated", "delivery_delay_days")


def in_period(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows of a fact partitioned by ``order_month`` with their day of ``dates`` (any part of
    dim_date): months without such a day are pruned at run time."""
    days = dates.withColumn("order_month", F.floor(F.col("date_key") / 100).cast("int"))
    return fact.withColumnRenamed("order_date_key", "date_key").join(days, ["order_month", "date_key"])


def conform_fact(fact: DataFrame) -> DataFrame:
    """The fact projected onto its declared DDL (column order and types)."""
    return conform(fact, WAREHOUSE_SCHEMAS["fact_orders"])
