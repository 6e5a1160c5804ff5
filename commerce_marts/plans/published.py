"""The report book: every business result set over a published warehouse.

``published`` opens what the last good run of ``plans.build`` published, as ``Layers`` that
start no job while they are composed and read only written files: a report is one aggregate
over the stored fact, item model, mart or staging table it names, and nothing is built again.
The pointer is read once, so all reports of a book see the same run even if another one is
published meanwhile.  With ``months`` the fact is limited to these order months by its
partition column, so files of other months are not opened.

``publish_reports`` combines the fact per order and per product, once each for all reports, then
writes every result set as a typed table of the layer ``reports`` and
publishes them together; dashboards then read a few rows.  ``report_values`` is the same book
in long form, for comparisons between two runs.

Empty tables give empty grouped reports and one row of the global ones (sums and means NULL,
counts 0).  Key columns may be NULL; they read ``NULL`` in the long form.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_marts.plans import reports as R
from commerce_marts.plans.build import DIMENSIONS, MONTH, buckets, write_together
from commerce_marts.plans.layers import DRIVER_BAND_CUTS, Layers
from commerce_marts.sources.bindings import STATES
from commerce_marts.sources.schemas import SOURCES
from commerce_marts.sources.store import INTERMEDIATE, TableStore

REPORT_LAYER = "reports"
MODELS = (*DIMENSIONS, "fact_orders", "int_orders_items_joined", "int_products_enriched",
          "mart_sales_by_region", "mart_product_performance", "mart_delivery_kpis")


class Report(NamedTuple):
    """``of``: the result set of some layers.  ``keys``: columns that name a row of it.
    ``over_fact``: whether it reads the fact, and so goes by ``published(months=...)``."""

    of: Callable[[Layers], DataFrame]
    keys: tuple[str, ...] = ()
    over_fact: bool = True


def _trend(p: Layers) -> DataFrame:
    return R.delivery_satisfaction_trend(R.delivery_vs_satisfaction(p.fact_by_order, p.dim_customers))


def report_set(states: Sequence[str] = STATES) -> dict[str, Report]:
    """Every report by name; ``states`` are the columns of the heat maps."""
    state, month = ("customer_state",), ("order_year", "order_month")
    return {
        "revenue_by_state": Report(lambda p: R.revenue_by_state(p.fact_by_order, p.dim_customers),
                                   state),
        "revenue_over_time": Report(lambda p: R.revenue_over_time(p.fact_by_order, p.dim_date),
                                    ("year", "month")),
        "top_categories": Report(lambda p: R.top_categories(p.fact_by_product, p.dim_products),
                                 ("category",)),
        "delivery_vs_satisfaction": Report(
            lambda p: R.delivery_vs_satisfaction(p.fact_by_order, p.dim_customers), state),
        "delivery_satisfaction_trend": Report(_trend),
        "orders_by_weekday": Report(lambda p: R.orders_by_weekday(p.fact_by_order, p.dim_date),
                                    ("day_name",)),
        "price_bands": Report(lambda p: R.price_bands(p.fact_by_product, p.dim_products),
                              ("price_band",)),
        "payment_types": Report(lambda p: R.payment_types(p.staging["order_payments"]),
                                ("payment_type",), False),
        "review_distribution": Report(lambda p: R.review_distribution(p.staging["order_reviews"]),
                                      ("review_score",), False),
        "review_avg_score": Report(lambda p: R.review_avg_score(
            R.review_distribution(p.staging["order_reviews"])), (), False),
        "executive_summary": Report(lambda p: R.executive_summary(
            p.fact_by_order, p.dim_customers, p.dim_products, p.dim_sellers)),
        "verify_revenue_by_state": Report(
            lambda p: R.verify_revenue_by_state(p.fact_by_order, p.dim_customers), state),
        "delivery_metrics": Report(lambda p: R.delivery_metrics(p.fact_orders)),
        "orders_customers_check": Report(lambda p: R.orders_customers_check(
            p.staging["orders"], p.staging["customers"]), state, False),
        "latest_orders": Report(lambda p: R.latest_orders(p.staging["orders"]),
                                ("order_id",), False),
        "revenue_share_by_state": Report(
            lambda p: R.revenue_share_by_state(p.fact_by_order, p.dim_customers), state),
        "payment_share": Report(lambda p: R.payment_share(p.staging["order_payments"]),
                                ("payment_type",), False),
        "dashboard_measures": Report(lambda p: R.dashboard_measures(
            p.mart_sales_by_region, p.mart_delivery_kpis), (), False),
        "delivery_heatmap": Report(lambda p: R.delivery_heatmap(p.mart_delivery_kpis, states),
                                   month, False),
        "month_state_heatmap": Report(lambda p: R.month_state_heatmap(
            p.int_orders_items_joined, p.views["stg_customers"], states), month[1:], False),
        "delivery_insights": Report(lambda p: R.delivery_insights(
            R.orders_by_weekday(p.fact_by_order, p.dim_date), p.fact_orders)),
        "on_time_by_state": Report(lambda p: R.on_time_by_state(
            p.int_orders_items_joined, p.views["stg_customers"]), state, False),
        "price_vs_review": Report(lambda p: R.price_vs_review(
            p.mart_product_performance, R.top_categories(p.fact_by_product, p.dim_products, 10)),
            ("category_en", "price_band")),
    }


def published(store: TableStore, band_cuts: Sequence[float] = DRIVER_BAND_CUTS,
              months: Sequence[int] | None = None) -> Layers:
    """``Layers`` over the published tables.  ``months`` (yyyymm) limits the fact.

    There is no raw input behind them, so profiles of raw tables can't be composed."""
    tables = store.tables()
    missing = [n for n in MODELS if n not in tables]
    if missing:
        raise ValueError(f"{store.root} publishes no {', '.join(missing)}; run build_all first")
    models = {n: tables[n] for n in MODELS}
    if months is not None:
        models["fact_orders"] = models["fact_orders"].where(F.col(MONTH).isin(list(months)))
    return Layers(dict.fromkeys(SOURCES), band_cuts, models=models,
                  staging={n: tables[s.table_name] for n, s in SOURCES.items()})


def book(layers: Layers, states: Sequence[str] = STATES,
         names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Result set by report name."""
    return {n: r.of(layers) for n, r in report_set(states).items() if names is None or n in names}


def publish_reports(store: TableStore, states: Sequence[str] = STATES,
                    names: Sequence[str] | None = None) -> None:
    """Writes the reports of the published warehouse and publishes them together."""
    over = published(store)
    with store.run() as shared:  # not published: its files go when the reports are written
        combined = write_together({
            "fact_by_order": lambda: shared.write(
                "fact_by_order", INTERMEDIATE, over.fact_by_order, "model",
                buckets=(buckets(store.spark), "customer_key")),
            "fact_by_product": lambda: shared.write(
                "fact_by_product", INTERMEDIATE, over.fact_by_product, "model")})
        results = book(Layers(over.raw, over.band_cuts, staging=over.staging,
                              models={**over.models, **combined}), states, names)
        with store.run() as run:
            write_together({n: lambda n=n, df=df: run.write(n, REPORT_LAYER, df, "report")
                            for n, df in results.items()})
            run.publish()


def report_values(results: Mapping[str, DataFrame], states: Sequence[str] = STATES) -> DataFrame:
    """report, key, column_name, value (of numbers), text (of others): every cell of every report.

    One scan of each result set, no shuffle."""
    out = None
    for name, df in results.items():
        keys = report_set(states)[name].keys
        key = F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in keys))
        cells = []
        for f in df.schema.fields:
            if f.name not in keys:
                number = isinstance(f.dataType, T.NumericType)
                cell, none = F.col(f"`{f.name}`"), F.lit(None)
                cells.append(F.struct(
                    F.lit(f.name).alias("column_name"),
                    (cell if number else none).cast("double").alias("value"),
                    (none if number else cell).cast("string").alias("text")))
        long = df.select(F.lit(name).alias("report"), key.alias("key"),
                         F.inline(F.array(*cells)))
        out = long if out is None else out.unionByName(long)
    return out
