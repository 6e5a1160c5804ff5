"""Explicit schemas of the nine raw sources and the five warehouse tables.

Raw schemas describe the files as delivered: the order and item timestamps
arrive as text and are converted by the cleaning step with a safe cast, the
review timestamps are declared as timestamps directly.  Zip prefixes are text
(a zero-padded ``01037`` must stay ``01037``).  Inference is never used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()
TS, DT, B, L = T.TimestampNTZType(), T.DateType(), T.BooleanType(), T.LongType()


def _schema(*fields, not_null=()):
    return T.StructType([T.StructField(n, t, n not in not_null) for n, t in fields])


RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": _schema(("customer_id", S), ("customer_unique_id", S),
                         ("customer_zip_code_prefix", S), ("customer_city", S),
                         ("customer_state", S)),
    "geolocation": _schema(("geolocation_zip_code_prefix", S), ("geolocation_lat", D),
                           ("geolocation_lng", D), ("geolocation_city", S),
                           ("geolocation_state", S)),
    "order_items": _schema(("order_id", S), ("order_item_id", I), ("product_id", S),
                           ("seller_id", S), ("shipping_limit_date", S), ("price", D),
                           ("freight_value", D)),
    "order_payments": _schema(("order_id", S), ("payment_sequential", I),
                              ("payment_type", S), ("payment_installments", I),
                              ("payment_value", D)),
    "order_reviews": _schema(("review_id", S), ("order_id", S), ("review_score", I),
                             ("review_comment_title", S), ("review_comment_message", S),
                             ("review_creation_date", TS), ("review_answer_timestamp", TS)),
    "orders": _schema(("order_id", S), ("customer_id", S), ("order_status", S),
                      ("order_purchase_timestamp", S), ("order_approved_at", S),
                      ("order_delivered_carrier_date", S),
                      ("order_delivered_customer_date", S),
                      ("order_estimated_delivery_date", S)),
    "products": _schema(("product_id", S), ("product_category_name", S),
                        ("product_name_lenght", I), ("product_description_lenght", I),
                        ("product_photos_qty", I), ("product_weight_g", D),
                        ("product_length_cm", D), ("product_height_cm", D),
                        ("product_width_cm", D)),
    "sellers": _schema(("seller_id", S), ("seller_zip_code_prefix", S),
                       ("seller_city", S), ("seller_state", S)),
    "category_translation": _schema(("product_category_name", S),
                                    ("product_category_name_english", S)),
}


@dataclass(frozen=True)
class SourceSpec:
    """Where a raw source lands and how it is deduplicated on load.

    ``dedup_order`` lists ``(column, "asc"|"desc")`` pairs that decide which
    copy of a primary key survives; the remaining columns always follow as
    ascending tie-breakers so the pick is reproducible.
    """

    name: str
    file_name: str
    table_name: str
    pk: tuple[str, ...]
    dedup_order: tuple[tuple[str, str], ...] = ()

    @property
    def schema(self) -> T.StructType:
        return RAW_SCHEMAS[self.name]


# Source file names, staging table names and primary keys.
SOURCES: dict[str, SourceSpec] = {s.name: s for s in [
    SourceSpec("customers", "olist_customers_dataset.csv", "stg_customers", ("customer_id",)),
    SourceSpec("geolocation", "olist_geolocation_dataset.csv", "stg_geolocation",
               ("geolocation_zip_code_prefix",)),
    SourceSpec("order_items", "olist_order_items_dataset.csv", "stg_order_items",
               ("order_id", "order_item_id")),
    SourceSpec("order_payments", "olist_order_payments_dataset.csv", "stg_order_payments",
               ("order_id", "payment_sequential")),
    SourceSpec("order_reviews", "olist_order_reviews_dataset.csv", "stg_order_reviews",
               ("review_id",), (("review_answer_timestamp", "desc"),)),
    SourceSpec("orders", "olist_orders_dataset.csv", "stg_orders", ("order_id",)),
    SourceSpec("products", "olist_products_dataset.csv", "stg_products", ("product_id",)),
    SourceSpec("sellers", "olist_sellers_dataset.csv", "stg_sellers", ("seller_id",)),
    SourceSpec("category_translation", "product_category_name_translation.csv",
               "stg_category_translation", ("product_category_name",)),
]}

# Accepted order statuses and price bands of the mart contracts.
ORDER_STATUSES = ("delivered", "shipped", "canceled", "unavailable", "invoiced",
                  "processing", "created", "approved")
PRICE_BANDS = ("budget", "mid_range", "premium", "luxury", "no_sales")

# Warehouse tables: column, type, nullable; primary keys listed separately.
WAREHOUSE_SCHEMAS: dict[str, T.StructType] = {
    "dim_date": _schema(
        ("date_key", I), ("full_date", DT), ("year", I), ("quarter", I), ("month", I),
        ("month_name", S), ("week_of_year", I), ("day_of_month", I), ("day_of_week", I),
        ("day_name", S), ("is_weekend", B),
        not_null=("date_key", "full_date", "year", "quarter", "month", "month_name",
                  "week_of_year", "day_of_month", "day_of_week", "day_name", "is_weekend")),
    "dim_customers": _schema(
        ("customer_key", L), ("customer_unique_id", S), ("customer_city", S),
        ("customer_state", S),
        not_null=("customer_key", "customer_unique_id", "customer_city", "customer_state")),
    "dim_products": _schema(
        ("product_key", L), ("product_id", S), ("product_category_pt", S),
        ("product_category_en", S), ("product_weight_g", D), ("product_length_cm", D),
        ("product_height_cm", D), ("product_width_cm", D), ("avg_price", D),
        ("price_band", S),
        not_null=("product_key", "product_id", "product_category_pt")),
    "dim_sellers": _schema(
        ("seller_key", L), ("seller_id", S), ("seller_city", S), ("seller_state", S),
        not_null=("seller_key", "seller_id", "seller_city", "seller_state")),
    "fact_orders": _schema(
        ("order_id", S), ("order_item_id", I), ("customer_key", L), ("product_key", L),
        ("seller_key", L), ("order_date_key", I), ("order_status", S), ("price", D),
        ("freight_value", D), ("payment_value", D), ("review_score", I),
        ("order_purchase_date", DT), ("order_delivered_date", DT),
        ("order_estimated_date", DT), ("days_to_deliver", I), ("days_estimated", I),
        ("delivery_delay_days", I),
        not_null=("order_id", "order_item_id", "customer_key", "product_key", "seller_key",
                  "order_date_key", "order_status", "price", "freight_value")),
}

WAREHOUSE_KEYS: dict[str, tuple[str, ...]] = {
    "dim_date": ("date_key",),
    "dim_customers": ("customer_key",),
    "dim_products": ("product_key",),
    "dim_sellers": ("seller_key",),
    "fact_orders": ("order_id", "order_item_id"),
}
