"""Full refresh and month refresh of every layer, published after their checks.

``build_run`` writes staging, the keys, the fact, the item model and the marts, each once,
and every later stage reads written files.  The staging tables that are joined by order
(items, orders, payments, reviews), the orders' customer keys and the item model are laid out
in buckets of order_id, so the item joins of the fact and of the item model and the marts' sums
per order need no exchange.  Tables whose primary key begins with order_id are laid out before
they are deduplicated, which needs no second exchange then.  The fact is partitioned by order month.  NOT NULL and primary keys of the warehouse are checked
before the marts are built, and nothing is visible to readers until all is
(``sources.store``).  A lost executor re-reads written files.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_marts.plans import warehouse as W
from commerce_marts.plans.layers import Layers
from commerce_marts.plans.staging import stage_source
from commerce_marts.sources.schemas import SOURCES, WAREHOUSE_KEYS, WAREHOUSE_SCHEMAS
from commerce_marts.sources.store import INTERMEDIATE, ConstraintViolation, StoreRun, TableStore

__all__ = ["ConstraintViolation", "build_all", "build_run", "read_layer", "refresh_months",
           "write_together"]

#: Staging tables that are joined by order_id.
BY_ORDER = ("order_items", "orders", "order_payments", "order_reviews")
MONTH = "order_month"
DIMENSIONS = ("dim_date", "dim_customers", "dim_products", "dim_sellers")


def with_month(fact: DataFrame) -> DataFrame:
    """The fact with its partition column, yyyymm of the order date."""
    return fact.withColumn(MONTH, F.floor(F.col("order_date_key") / 100).cast("int"))


#: Tables of one layer that are written at a time; they don't depend on each other.
AT_ONCE = 4


def write_together(writes: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Runs the writes ``AT_ONCE`` at a time; what each returns, by name."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        started = {name: pool.submit(write) for name, write in writes.items()}
        return {name: job.result() for name, job in started.items()}


def buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _staged_by_order(name: str, raw: DataFrame, n: int) -> DataFrame:
    """The staging table of a source whose key begins with order_id, in ``n`` partitions of it:
    its rows are sent there once and deduplicated there.  Rows without an order_id may be many;
    they are deduplicated first."""
    known = stage_source(name, raw.where("order_id is not null").repartition(n, "order_id"))
    return known.unionByName(
        stage_source(name, raw.where("order_id is null")).repartition(n, "order_id"))


def staged(run: StoreRun, layers: Layers, names: Sequence[str] | None = None) -> Layers:
    """Writes the staging tables; ``Layers`` over them.  ``names`` limits the tables."""
    def write(name: str) -> Callable[[], DataFrame]:
        n = buckets(run.spark)
        layout = (n, "order_id") if name in BY_ORDER else None
        first = layers.stages_raw and len(SOURCES[name].pk) > 1 and SOURCES[name].pk[0] == "order_id"
        df = _staged_by_order(name, layers.raw[name], n) if first else layers.staging[name]
        return lambda: run.write(SOURCES[name].table_name, "staging", df, buckets=layout)

    # the largest tables first
    order = sorted(names or layers.raw, key=lambda n: n not in BY_ORDER)
    tables = write_together({n: write(n) for n in order})
    return type(layers)(layers.raw, layers.band_cuts, staging={
        n: tables[n] if n in tables else layers.staging[n] for n in layers.raw})


def _warehouse(run: StoreRun, built: Layers) -> Layers:
    """Writes product prices, dimensions and fact; ``Layers`` over staging and these."""
    st = built.staging
    prices = {"product_prices": run.write("product_prices", INTERMEDIATE,
                                          W.product_prices(st["order_items"]), "model")}
    built = type(built)(built.raw, built.band_cuts, staging=st, models=prices)
    write_together({name: lambda name=name: getattr(built, name) for name in DIMENSIONS})  # their keys
    models = built.warehouse()
    kept = write_together({
        name: lambda name=name: run.write(name, "warehouse", models[name], "dimension",
                                          WAREHOUSE_SCHEMAS[name], WAREHOUSE_KEYS[name])
        for name in DIMENSIONS}) | prices
    kept["order_customer_keys"] = run.write(
        "order_customer_keys", INTERMEDIATE,
        W.customer_key_lookup(st["orders"], st["customers"], kept["dim_customers"]), "lookup",
        buckets=(buckets(run.spark), "order_id"))
    over = type(built)(built.raw, built.band_cuts, staging=st, models=kept)
    kept["fact_orders"] = run.write(
        "fact_orders", "warehouse", with_month(over.fact_orders), "fact",
        WAREHOUSE_SCHEMAS["fact_orders"], WAREHOUSE_KEYS["fact_orders"], partition=MONTH)
    return type(built)(built.raw, built.band_cuts, staging=st, models=kept)


#: The staging tables behind the marts.
FOR_MARTS = (*BY_ORDER, "customers", "products", "category_translation")


def modelled(run: StoreRun, over: Layers) -> Layers:
    """Writes the item model, by order, and the product model; ``Layers`` over these too."""
    frames = {n: getattr(over, n) for n in ("int_orders_items_joined", "int_products_enriched")}
    by_order = {"int_orders_items_joined": (buckets(run.spark), "order_id")}
    models = dict(over.models) | write_together({
        n: lambda n=n, df=df: run.write(n, INTERMEDIATE, df, "model", buckets=by_order.get(n))
        for n, df in frames.items()})
    return type(over)(over.raw, over.band_cuts, staging=over.staging, models=models)


def build_run(run: StoreRun, layers: Layers, enforce_constraints: bool = True) -> Layers:
    """Writes all layers into ``run`` (not published yet); ``Layers`` over what was written,
    whose models start no job while they are composed."""
    over = _warehouse(run, staged(run, layers))
    if enforce_constraints:
        run.check()
    over = modelled(run, over)
    models = dict(over.models) | write_together({
        n: lambda n=n, df=df: run.write(n, "marts", df, "mart") for n, df in over.marts().items()})
    return type(layers)(layers.raw, layers.band_cuts, staging=over.staging, models=models)


def build_all(spark: SparkSession, layers: Layers, root: str,
              enforce_constraints: bool = True) -> dict[str, tuple[str, str]]:
    """Builds and publishes all layers under ``root``; returns name → (layer, path).

    A violation raises ``ConstraintViolation`` with the failing counts; what was published
    before stays readable.
    """
    store = TableStore(spark, root)
    with store.run() as run:
        build_run(run, layers, enforce_constraints)
        if not enforce_constraints:
            run.violations.clear()
        run.publish()
        return {name: (e["layer"], f"{store.root}/{e['layer']}/{name}/{e['run']}")
                for name, e in run.entries.items() if e["layer"] != INTERMEDIATE}


def refresh_months(store: TableStore, layers: Layers, months: Sequence[int]) -> None:
    """Rebuilds the fact of some months (yyyymm) from ``layers`` over the published dimensions
    and publishes these alone; the files of other months stay as they are."""
    with store.run() as run:
        over = type(layers)(layers.raw, layers.band_cuts, staging=layers.staging, models={
            n: store.read(n) for n in ("dim_customers", "dim_products", "dim_sellers")})
        run.write("fact_orders", "warehouse", with_month(over.fact_orders), "fact",
                  WAREHOUSE_SCHEMAS["fact_orders"], WAREHOUSE_KEYS["fact_orders"],
                  partition=MONTH, replace=months)
        run.publish()


def read_layer(spark: SparkSession, written: dict[str, tuple[str, str]], layer: str):
    """The written tables of one layer as DataFrames."""
    return {name: spark.read.parquet(path) for name, (lyr, path) in written.items()
            if lyr == layer}
