"""Lazily composed layers: raw → staging → views → warehouse → marts.

A ``Layers`` holds DataFrame definitions only; each layer is built on first
use and the same DataFrame object is reused by every consumer, so one query
plan that touches a layer twice lets Spark reuse the exchange.  Surrogate-key
dimensions write their key tags once, when first built (see ``operators.keys``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from commerce_marts.functions.scalar import DEFAULT_BAND_CUTS
from commerce_marts.plans import marts as M
from commerce_marts.plans import reports as R
from commerce_marts.plans import staging as S
from commerce_marts.plans import warehouse as W
from commerce_marts.sources.bindings import LazySources, raw_sources

# Price-band cuts suited to the driver's synthetic prices
# (mean item price per part is tens of thousands, so the default cuts of
# 50/150/500 would put every product in one band).
DRIVER_BAND_CUTS = (47000.0, 52500.0, 58000.0)


class Layers:
    def __init__(self, raw: Mapping[str, DataFrame],
                 band_cuts: Sequence[float] = DEFAULT_BAND_CUTS,
                 staging: Mapping[str, DataFrame] | None = None,
                 materialize_shared: bool = False,
                 models: Mapping[str, DataFrame] | None = None):
        """``staging`` — already deduplicated and cleaned tables (e.g. read back
        from written staging tables); when given, they replace the derivation
        from ``raw``.  ``models`` — written models by name, in place of their derivation;
        ``order_customer_keys`` (order_id, customer_key) serves the fact, ``product_prices``
        both product models."""
        self.raw = raw
        self.models = dict(models or {})
        for name, df in self.models.items():
            if name != "order_customer_keys":
                self.__dict__[name] = df
        self.band_cuts = tuple(band_cuts)
        self.materialize_shared = materialize_shared
        #: whether the staging tables derive from ``raw``
        self.stages_raw = staging is None
        if staging is not None:
            self.__dict__["staging"] = staging

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str,
                    band_cuts: Sequence[float] = DRIVER_BAND_CUTS,
                    corrupt_dates: bool = False, materialize_shared: bool = False) -> Layers:
        return cls(raw_sources(spark, sf_dir, corrupt_dates), band_cuts,
                   materialize_shared=materialize_shared)

    # staging ---------------------------------------------------------------
    #: staging tables read by several warehouse jobs (dimensions and fact)
    SHARED_STAGING = ("order_items", "orders", "customers")

    @cached_property
    def staging(self) -> Mapping[str, DataFrame]:
        """Deduplicated and cleaned sources, each defined on first use.

        With ``materialize_shared`` the tables that several warehouse jobs read
        are written once as parquet under the checkpoint folder and re-read, so
        their dedup runs once rather than once per consuming job.
        """
        def build(n):
            df = S.stage_source(n, self.raw[n])
            if self.materialize_shared and n in self.SHARED_STAGING:
                from commerce_marts.session import scratch_path
                from commerce_marts.sources.io import write_table

                spark = df.sparkSession
                df = spark.read.parquet(write_table(df, scratch_path(spark, f"staging-{n}")))
            return df

        return LazySources({n: (lambda n=n: build(n)) for n in self.raw})

    @cached_property
    def views(self) -> Mapping[str, DataFrame]:
        return LazySources({f"stg_{n}": (lambda n=n: S.staging_view(n, self.staging[n]))
                            for n in self.raw})

    # warehouse -------------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        return W.dim_date(self.staging["orders"], "documented")

    @cached_property
    def dim_date_observed(self) -> DataFrame:
        return W.dim_date(self.staging["orders"], "observed")

    @cached_property
    def latest_customer(self) -> DataFrame:
        return W.latest_customer(self.staging["customers"], self.staging["orders"])

    @cached_property
    def dim_customers(self) -> DataFrame:
        from commerce_marts.operators.keys import surrogate_key

        return surrogate_key(self.latest_customer, "customer_unique_id", "customer_key")

    @cached_property
    def dim_products(self) -> DataFrame:
        st = self.staging
        return W.dim_products(st["products"], st["category_translation"],
                              st["order_items"], self.band_cuts, self.models.get("product_prices"))

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return W.dim_sellers(self.staging["sellers"])

    @cached_property
    def fact_orders(self) -> DataFrame:
        st = self.staging
        return W.fact_orders(st["order_items"], st["orders"], st["customers"],
                             st["order_payments"], st["order_reviews"],
                             self.dim_customers, self.dim_products, self.dim_sellers,
                             self.models.get("order_customer_keys"))

    @cached_property
    def fact_by_order(self) -> DataFrame:
        return R.per_order(self.fact_orders)

    @cached_property
    def fact_by_product(self) -> DataFrame:
        return R.per_product(self.fact_orders)

    # marts -----------------------------------------------------------------
    @cached_property
    def int_orders_items_joined(self) -> DataFrame:
        v = self.views
        return M.int_orders_items_joined(v["stg_order_items"], v["stg_orders"],
                                         v["stg_order_payments"], v["stg_order_reviews"])

    @cached_property
    def int_products_enriched(self) -> DataFrame:
        v = self.views
        return M.int_products_enriched(v["stg_products"], v["stg_category_translation"],
                                       v["stg_order_items"], self.band_cuts,
                                       self.models.get("product_prices"))

    @cached_property
    def mart_sales_by_region(self) -> DataFrame:
        return M.mart_sales_by_region(self.int_orders_items_joined, self.views["stg_customers"])

    @cached_property
    def mart_product_performance(self) -> DataFrame:
        return M.mart_product_performance(self.int_orders_items_joined,
                                          self.int_products_enriched)

    @cached_property
    def mart_delivery_kpis(self) -> DataFrame:
        return M.mart_delivery_kpis(self.int_orders_items_joined, self.views["stg_customers"])

    def marts(self) -> dict[str, DataFrame]:
        return {"mart_sales_by_region": self.mart_sales_by_region,
                "mart_product_performance": self.mart_product_performance,
                "mart_delivery_kpis": self.mart_delivery_kpis}

    def warehouse(self) -> dict[str, DataFrame]:
        return {"dim_date": self.dim_date, "dim_customers": self.dim_customers,
                "dim_products": self.dim_products, "dim_sellers": self.dim_sellers,
                "fact_orders": self.fact_orders}
