"""Quality plans: raw-source profiles, model tests, warehouse constraints.

The tests mirror the model contracts: 15 not_null, 5 unique and 3
accepted_values tests over the staging views, intermediate models and marts,
plus the primary-key and NOT NULL constraints of the five warehouse tables
(``WAREHOUSE_SCHEMAS``), which Spark does not enforce on write.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_marts.operators import quality as Q
from commerce_marts.plans.layers import Layers
from commerce_marts.sources.schemas import (
    ORDER_STATUSES,
    PRICE_BANDS,
    SOURCES,
    WAREHOUSE_KEYS,
    WAREHOUSE_SCHEMAS,
)


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def profile_summary(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Per raw table: rows, columns, nulls, duplicate-PK flag; plus a TOTAL row."""
    per = _union([Q.profile_table(df, SOURCES[n].file_name, SOURCES[n].pk)
                  for n, df in raw.items()])
    total = F.grouping("table_name") == 1
    return per.rollup("table_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_columns").alias("n_columns"),
        F.sum("total_nulls").alias("total_nulls"),
        F.max("has_duplicate_pk").alias("has_duplicate_pk"),
        total.alias("_total"),
    ).select(F.when(F.col("_total"), F.lit("TOTAL")).otherwise(F.col("table_name"))
             .alias("table_name"), "n_rows", F.col("n_columns").cast("int").alias("n_columns"),
             "total_nulls",
             F.when(~F.col("_total"), F.col("has_duplicate_pk")).alias("has_duplicate_pk"))


def profile_nulls(raw: Mapping[str, DataFrame]) -> DataFrame:
    return _union([Q.profile_nulls(df, SOURCES[n].file_name) for n, df in raw.items()])


def profile_duplicate_keys(raw: Mapping[str, DataFrame]) -> DataFrame:
    return _union([Q.profile_duplicate_keys(df, SOURCES[n].file_name, SOURCES[n].pk)
                   for n, df in raw.items()])


def duplicate_key_samples(raw: Mapping[str, DataFrame]) -> DataFrame:
    """The duplicate-key sample of every raw table."""
    return _union([Q.duplicate_key_counts(df, SOURCES[n].file_name, SOURCES[n].pk)
                   for n, df in raw.items()])


def profile_numeric(raw: Mapping[str, DataFrame]) -> DataFrame:
    return _union([Q.profile_numeric(df, SOURCES[n].file_name) for n, df in raw.items()
                   if Q.numeric_columns(df)])


def profile_cardinality(raw: Mapping[str, DataFrame], approx: bool = False) -> DataFrame:
    return _union([Q.profile_cardinality(df, SOURCES[n].file_name, approx)
                   for n, df in raw.items()])


def profile_columns(raw: Mapping[str, DataFrame]) -> DataFrame:
    return _union([Q.profile_columns(df, SOURCES[n].file_name) for n, df in raw.items()])


def model_tests(p: Layers) -> list[DataFrame]:
    """The 23 model tests (15 not_null, 5 unique, 3 accepted_values), one pass for each model."""
    v = p.views
    return [
        Q.check_model(v["stg_orders"], "stg_orders", ["order_id", "order_status"], ["order_id"],
                      {"order_status": ORDER_STATUSES}),
        Q.check_model(v["stg_customers"], "stg_customers", ["customer_id"], ["customer_id"]),
        Q.check_model(v["stg_order_items"], "stg_order_items", ["order_id", "order_item_id"]),
        Q.check_model(v["stg_products"], "stg_products", ["product_id"], ["product_id"]),
        Q.check_model(v["stg_sellers"], "stg_sellers", ["seller_id"], ["seller_id"]),
        Q.check_model(p.int_orders_items_joined, "int_orders_items_joined",
                      ["order_id", "order_item_id", "price"]),
        Q.check_model(p.int_products_enriched, "int_products_enriched", ["product_id"],
                      ["product_id"], {"price_band": PRICE_BANDS}),
        Q.check_model(p.mart_sales_by_region, "mart_sales_by_region",
                      ["customer_state", "total_revenue"]),
        Q.check_model(p.mart_product_performance, "mart_product_performance", ["category_en"],
                      accepted={"price_band": PRICE_BANDS}),
        Q.check_model(p.mart_delivery_kpis, "mart_delivery_kpis", ["customer_state"]),
    ]


def warehouse_constraints(p: Layers) -> list[DataFrame]:
    """Primary key uniqueness and NOT NULL columns of the warehouse DDL."""
    out = []
    for name, df in p.warehouse().items():
        schema = WAREHOUSE_SCHEMAS[name]
        required = [f.name for f in schema.fields if not f.nullable]
        out.append(Q.check_model(df, name, required, WAREHOUSE_KEYS[name]))
    return out


def dq_results(p: Layers) -> DataFrame:
    return Q.run_checks(model_tests(p) + warehouse_constraints(p))


def dq_accepted_values(p: Layers) -> DataFrame:
    return _union([
        Q.accepted_values_profile(p.views["stg_orders"], "stg_orders", "order_status",
                                  ORDER_STATUSES),
        Q.accepted_values_profile(p.int_products_enriched, "int_products_enriched",
                                  "price_band", PRICE_BANDS),
        Q.accepted_values_profile(p.mart_product_performance, "mart_product_performance",
                                  "price_band", PRICE_BANDS),
    ])


def fk_orphans(p: Layers) -> DataFrame:
    return Q.fk_orphans(p.fact_orders, [
        ("customer_key", "dim_customers", p.dim_customers, "customer_key"),
        ("product_key", "dim_products", p.dim_products, "product_key"),
        ("seller_key", "dim_sellers", p.dim_sellers, "seller_key"),
        ("order_date_key", "dim_date", p.dim_date, "date_key"),
    ])


def table_counts(p: Layers) -> DataFrame:
    tables = {SOURCES[n].table_name: ("staging", "table", df) for n, df in p.staging.items()}
    for name, df in p.warehouse().items():
        tables[name] = ("warehouse", "fact" if name.startswith("fact") else "dimension", df)
    for name, df in p.marts().items():
        tables[name] = ("marts", "mart", df)
    return Q.table_counts(tables)
