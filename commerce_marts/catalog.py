"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each query binds the driver tables under ``sf_dir`` to the nine raw sources
and runs the named model or operator over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from commerce_marts.operators.dedup import dedup_by_key
from commerce_marts.operators.keys import surrogate_key
from commerce_marts.operators import quality as Q
from commerce_marts.plans import marts as M
from commerce_marts.plans import published as PB
from commerce_marts.plans import quality as PQ
from commerce_marts.plans import staging as S
from commerce_marts.plans import warehouse as W
from commerce_marts.plans.build import FOR_MARTS, build_all, build_run, modelled, staged
from commerce_marts.plans.layers import Layers
from commerce_marts.session import ensure_checkpoint_dir, scratch_path
from commerce_marts.sources import bindings as BND
from commerce_marts.sources.io import export_checked, read_source, write_csv
from commerce_marts.sources.schemas import SOURCES
from commerce_marts.sources.store import StoreRun, TableStore

Query = Callable[[SparkSession, str], DataFrame]


def _layers(spark: SparkSession, sf_dir: str, shared: bool = False) -> Layers:
    ensure_checkpoint_dir(spark)
    return Layers.from_driver(spark, sf_dir, materialize_shared=shared)


def _q(fn: Callable[[Layers], DataFrame], shared: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_layers(spark, sf_dir, shared))
    run.__doc__ = fn.__doc__
    return run


def _qw(fn: Callable[[Layers], DataFrame]) -> Query:
    """A query over the fact: the staging tables that the dimensions and the
    fact both read are written once and shared (see ``Layers``)."""
    return _q(fn, shared=True)


# --- cleaning ---------------------------------------------------------------

def src_orders_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the raw orders as header CSV, then scan it back with the typed reader."""
    path = write_csv(BND.raw_orders(spark, sf_dir), scratch_path(spark, "raw_orders_csv"))
    return read_source(spark, "orders", path)


def staging_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _layers(spark, sf_dir)
    return S.staging_row_counts(p.raw, p.staging)


def _dedup(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = BND.raw_sources(spark, sf_dir)[name]
        return dedup_by_key(raw, SOURCES[name].pk, SOURCES[name].dedup_order)
    return run


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = BND.raw_orders(spark, sf_dir, corrupt_dates=True)
    return S.clean_orders(dedup_by_key(raw, SOURCES["orders"].pk))


def clean_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = BND.raw_order_items(spark, sf_dir, corrupt_dates=True)
    return S.clean_order_items(dedup_by_key(raw, SOURCES["order_items"].pk))


def _clean(name: str) -> Query:
    return _q(lambda p: p.staging[name])


# --- modelling ---------------------------------------------------------------

def surrogate_key_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _layers(spark, sf_dir)
    return surrogate_key(p.staging["customers"].select("customer_id", "customer_unique_id"),
                         "customer_id", "customer_sk")


def fk_lookup_customer(p: Layers) -> DataFrame:
    return W.customer_key_lookup(p.staging["orders"], p.staging["customers"], p.dim_customers)


def _exported(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three marts, exported from staging tables and models that are written once for all."""
    with TableStore(spark, scratch_path(spark, "marts_build")).run() as run:
        over = modelled(run, staged(run, _layers(spark, sf_dir), FOR_MARTS))
        return export_checked(over.marts(), scratch_path(spark, "marts_export"))


def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales mart as read back; a lossy export of any of the three marts is an error."""
    return _exported(spark, sf_dir)["mart_sales_by_region"]


def export_roundtrip_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of the three marts as read back from their export."""
    return M.mart_values(_exported(spark, sf_dir))


def _over_build(fn: Callable) -> Query:
    """``fn(run, layers)`` over a build in the shared folder whose files go afterwards; the small
    result is brought over."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        with TableStore(spark, scratch_path(spark, "build")).run() as run:
            result = fn(run, build_run(run, _layers(spark, sf_dir), enforce_constraints=False))
            return spark.createDataFrame(result.collect(), result.schema)
    query.__doc__ = fn.__doc__
    return query


def table_counts(run: StoreRun, _: Layers) -> DataFrame:
    """Rows of every table as they were written, and the total; no table is counted again."""
    return run.catalog()


def dq_results(_: StoreRun, layers: Layers) -> DataFrame:
    """All model tests and warehouse constraints, one pass over each written model."""
    return PQ.dq_results(layers)


def warehouse_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full refresh of every layer, published, then the row counts of the published tables,
    each read back and compared with its checksum."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    try:
        build_all(spark, _layers(spark, sf_dir), store.root)
        store.verify()
        return store.catalog(total=None)
    finally:
        store.drop()


def report_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of every report: the warehouse is built and published once, the reports are
    written from it and read back as published.  The few rows are brought over, the files go."""
    store = TableStore(spark, scratch_path(spark, "book"))
    try:
        build_all(spark, _layers(spark, sf_dir), store.root)
        PB.publish_reports(store)
        kept = store.tables()
        values = PB.report_values({n: kept[n] for n in PB.report_set()})
        return spark.createDataFrame(values.collect(), values.schema)
    finally:
        store.drop()


QUERIES: dict[str, Query] = {
    # cleaning
    "src_orders_scan": src_orders_scan,
    "staging_row_counts": staging_row_counts,
    "dedup_order_items": _dedup("order_items"),
    "dedup_reviews_latest": _dedup("order_reviews"),
    "dedup_geolocation": _dedup("geolocation"),
    "clean_orders": clean_orders,
    "clean_order_items": clean_order_items,
    "clean_products": _clean("products"),
    "clean_customers": _clean("customers"),
    "clean_sellers": _clean("sellers"),
    # staging views
    **{f"stg_{n}": _q(lambda p, n=n: p.views[f"stg_{n}"]) for n in (
        "orders", "customers", "order_items", "order_payments", "order_reviews",
        "products", "sellers", "geolocation", "category_translation")},
    # modelling
    "latest_customer": _q(lambda p: p.latest_customer),
    "surrogate_key_customers": surrogate_key_customers,
    "fk_lookup_customer": _q(fk_lookup_customer),
    "order_payments_agg": _q(lambda p: W.order_payments_agg(p.views["stg_order_payments"])),
    "order_reviews_agg": _q(lambda p: W.order_reviews_agg(p.views["stg_order_reviews"])),
    "product_prices": _q(lambda p: W.product_prices(p.views["stg_order_items"])),
    "delivery_day_metrics": _q(lambda p: W.delivery_day_metrics(p.staging["orders"])),
    "dim_date": _q(lambda p: p.dim_date),
    "dim_date_observed": _q(lambda p: p.dim_date_observed),
    "dim_customers": _q(lambda p: p.dim_customers),
    "dim_products": _q(lambda p: p.dim_products),
    "dim_sellers": _q(lambda p: p.dim_sellers),
    "fact_orders": _qw(lambda p: p.fact_orders),
    "conform_fact": _qw(lambda p: W.conform_fact(p.fact_orders)),
    # marts
    "int_orders_items_joined": _q(lambda p: p.int_orders_items_joined),
    "int_products_enriched": _q(lambda p: p.int_products_enriched),
    "mart_sales_by_region": _q(lambda p: p.mart_sales_by_region),
    "mart_product_performance": _q(lambda p: p.mart_product_performance),
    "mart_delivery_kpis": _q(lambda p: p.mart_delivery_kpis),
    # reports
    **{n: (_qw if r.over_fact else _q)(r.of) for n, r in PB.report_set().items()},
    "report_book": report_book,
    # quality
    "profile_summary": _q(lambda p: PQ.profile_summary(p.raw)),
    "profile_nulls": _q(lambda p: PQ.profile_nulls(p.raw)),
    "profile_duplicate_keys": _q(lambda p: PQ.profile_duplicate_keys(p.raw)),
    "duplicate_key_sample": _q(lambda p: Q.duplicate_key_sample(
        p.raw["order_items"], SOURCES["order_items"].pk)),
    "duplicate_key_samples": _q(lambda p: PQ.duplicate_key_samples(p.raw)),
    "profile_numeric": _q(lambda p: PQ.profile_numeric(p.raw)),
    "profile_cardinality": _q(lambda p: PQ.profile_cardinality(p.raw)),
    "dq_results": _over_build(dq_results),
    "dq_accepted_values": _q(PQ.dq_accepted_values),
    "fk_orphans": _qw(PQ.fk_orphans),
    "table_counts": _over_build(table_counts),
    "export_roundtrip": export_roundtrip,
    "export_roundtrip_marts": export_roundtrip_marts,
    "warehouse_build": warehouse_build,
}

def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship query: sales by region over the full model chain."""
    return QUERIES["mart_sales_by_region"](spark, sf_dir)


__all__ = ["QUERIES", "flagship"]
