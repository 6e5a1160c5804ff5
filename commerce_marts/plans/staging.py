"""Staging layer: deduplicated, typed and cleaned sources, plus the thin views.

``load_staging`` = per source ``dedup_by_key`` on its primary key, then the
cleaning rules:

* orders / order items: text timestamps → ``timestamp_ntz`` with a safe cast
  (unparsable text becomes NULL);
* products: NULL category → ``'sin_categoria'``, NULL numerics → 0;
* customers / sellers: city ``lower(trim())``, state ``upper(trim())``.

``staging_views`` are the projection/cast models on top (``stg_*``), e.g.
the products view renames the misspelt ``*_lenght`` columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_marts.functions import lower_trim, safe_timestamp, upper_trim
from commerce_marts.operators.dedup import dedup_by_key
from commerce_marts.sources.schemas import SOURCES

ORDER_TS = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date")

# Defaults for missing product attributes.
PRODUCT_DEFAULTS = {
    "product_category_name": "sin_categoria",
    "product_name_lenght": 0,
    "product_description_lenght": 0,
    "product_photos_qty": 0,
    "product_weight_g": 0.0,
    "product_length_cm": 0.0,
    "product_height_cm": 0.0,
    "product_width_cm": 0.0,
}


def safe_timestamps(df: DataFrame, cols) -> DataFrame:
    """Convert each listed text column to a timestamp, NULL when unparsable."""
    cols = set(cols)
    return df.select(*[safe_timestamp(c).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """COALESCE(column, default) for every column in ``defaults``; order kept."""
    return df.select(*[
        F.coalesce(F.col(c), F.lit(defaults[c]).cast(df.schema[c].dataType)).alias(c)
        if c in defaults else F.col(c) for c in df.columns])


def normalize_place(df: DataFrame, city: str, state: str) -> DataFrame:
    return df.select(*[lower_trim(c).alias(c) if c == city
                       else upper_trim(c).alias(c) if c == state else F.col(c)
                       for c in df.columns])


def clean_orders(df: DataFrame) -> DataFrame:
    return safe_timestamps(df, ORDER_TS)


def clean_order_items(df: DataFrame) -> DataFrame:
    return safe_timestamps(df, ["shipping_limit_date"])


def clean_products(df: DataFrame, defaults: Mapping[str, object] = PRODUCT_DEFAULTS
                   ) -> DataFrame:
    return fill_defaults(df, defaults)


def clean_customers(df: DataFrame) -> DataFrame:
    return normalize_place(df, "customer_city", "customer_state")


def clean_sellers(df: DataFrame) -> DataFrame:
    return normalize_place(df, "seller_city", "seller_state")


CLEANERS = {
    "orders": clean_orders,
    "order_items": clean_order_items,
    "products": clean_products,
    "customers": clean_customers,
    "sellers": clean_sellers,
}


def dedup_sources(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Primary-key dedup of every present raw source (missing sources skipped)."""
    return {name: dedup_by_key(df, SOURCES[name].pk, SOURCES[name].dedup_order)
            for name, df in raw.items()}


def stage_source(name: str, raw: DataFrame) -> DataFrame:
    """One staging table: primary-key dedup, then the source's cleaning rule."""
    spec = SOURCES[name]
    deduped = dedup_by_key(raw, spec.pk, spec.dedup_order)
    return CLEANERS.get(name, lambda d: d)(deduped)


def load_staging(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Dedup then clean: the staging tables keyed by source name."""
    return {name: stage_source(name, df) for name, df in raw.items()}


def staging_row_counts(raw: Mapping[str, DataFrame], staged: Mapping[str, DataFrame]
                       ) -> DataFrame:
    """Per source: staging table, raw rows, loaded rows, removed duplicates."""
    frames = []
    for name, df in raw.items():
        n_raw = df.agg(F.count(F.lit(1)).alias("raw_rows"))
        n_loaded = staged[name].select(F.count(F.lit(1))).scalar()
        frames.append(n_raw.select(
            F.lit(SOURCES[name].table_name).alias("table_name"),
            F.col("raw_rows"), n_loaded.alias("loaded_rows"),
            (F.col("raw_rows") - n_loaded).alias("duplicates_removed")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --- thin views ------------------------------------------------------------

def staging_view(name: str, st: DataFrame) -> DataFrame:
    """The ``stg_<name>`` model over one staging table: selection, casts, renames."""
    if name == "orders":
        return st.select("order_id", "customer_id", "order_status", *ORDER_TS)
    if name == "customers":
        return st.select("customer_id", "customer_unique_id", "customer_zip_code_prefix",
                         "customer_city", "customer_state")
    if name == "geolocation":
        return st.select(
            "geolocation_zip_code_prefix",
            F.col("geolocation_lat").cast("double").alias("geolocation_lat"),
            F.col("geolocation_lng").cast("double").alias("geolocation_lng"),
            "geolocation_city", "geolocation_state")
    if name == "order_items":
        return st.select(
            "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
            F.col("price").cast("double").alias("price"),
            F.col("freight_value").cast("double").alias("freight_value"))
    if name == "order_payments":
        return st.select(
            "order_id", "payment_sequential", "payment_type", "payment_installments",
            F.col("payment_value").cast("double").alias("payment_value"))
    if name == "order_reviews":
        return st.select(
            "review_id", "order_id", F.col("review_score").cast("int").alias("review_score"),
            "review_comment_title", "review_comment_message", "review_creation_date",
            "review_answer_timestamp")
    if name == "products":
        return st.select(
            "product_id", "product_category_name",
            F.col("product_name_lenght").cast("int").alias("product_name_length"),
            F.col("product_description_lenght").cast("int").alias("product_description_length"),
            F.col("product_photos_qty").cast("int").alias("product_photos_qty"),
            *[F.col(c).cast("double").alias(c) for c in (
                "product_weight_g", "product_length_cm", "product_height_cm",
                "product_width_cm")])
    if name == "sellers":
        return st.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
    if name == "category_translation":
        return st.select("product_category_name", "product_category_name_english")
    raise KeyError(name)


def staging_views(st: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All ``stg_*`` models."""
    return {f"stg_{n}": staging_view(n, df) for n, df in st.items()}
