"""Publishing after checks, partitions, layout and clean-up of the table store."""

from __future__ import annotations

import contextlib
import glob
import io
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_marts.plans import build as B
from commerce_marts.plans import warehouse as W
from commerce_marts.plans.layers import Layers
from commerce_marts.session import scratch_path
from commerce_marts.sources.store import ConstraintViolation, TableStore

SCHEMA = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("v", T.StringType())])


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def publish(store, rows, **options):
    with store.run() as run:
        run.write("t", "warehouse", store.spark.createDataFrame(rows, "k long, v string"),
                  schema=SCHEMA, key=["k"], **options)
        run.publish()


def files(store):
    return sorted(glob.glob(f"{store.root}/**/*.parquet", recursive=True))


@pytest.mark.parametrize("bad,message", [([(1, "a"), (1, "b")], "t.k unique: 1"),
                                         ([(None, "a")], "t.k not_null: 1")])
def test_a_violation_leaves_the_earlier_table_readable(store, bad, message):
    publish(store, [(1, "old"), (2, None)])
    before = files(store)
    with pytest.raises(ConstraintViolation, match=message):
        publish(store, bad)
    assert sorted(map(tuple, store.read("t").collect())) == [(1, "old"), (2, None)]
    assert files(store) == before
    publish(store, [(3, "new")])
    assert [tuple(r) for r in store.read("t").collect()] == [(3, "new")]
    store.vacuum()
    assert not set(files(store)) & set(before)
    store.verify()


def test_all_tables_of_a_run_appear_together(store):
    with pytest.raises(RuntimeError, match="halfway"):
        with store.run() as run:
            run.write("t", "warehouse", store.spark.range(3).withColumnRenamed("id", "k"))
            raise RuntimeError("halfway")
    assert store.published() == {} and not files(store)


def test_an_empty_table_is_published(store):
    publish(store, [])
    assert store.read("t").count() == 0 and store.read("t").columns == ["k", "v"]
    store.verify()


def test_catalog_counts_what_was_written_and_a_total(store):
    publish(store, [(i, "x") for i in range(7)])
    with store.run() as run:
        run.write("u", "marts", store.spark.range(5), kind="mart")
        run.publish()
    assert {tuple(r) for r in store.catalog().collect()} == {
        ("t", "warehouse", "table", 7), ("u", "marts", "mart", 5), ("TOTAL", None, None, 12)}
    assert "FileScan" not in plan(store.catalog())


def test_a_damaged_table_does_not_verify(store):
    publish(store, [(i, "x") for i in range(7)])
    os.remove(files(store)[0])
    with pytest.raises(ValueError, match="t reads back"):
        store.verify()


def test_one_month_is_replaced_alone(store):
    rows = [(m * 100 + d, f"v{m}") for m in (201801, 201802, 201803) for d in (1, 2)]
    month = F.floor(F.col("k") / 100).cast("int")

    def write(rows, replace=None):
        with store.run() as run:
            run.write("t", "warehouse", store.spark.createDataFrame(rows, "k long, v string")
                      .withColumn("m", month), schema=SCHEMA, key=["k"], partition="m", replace=replace)
            run.publish()

    write(rows)
    before = files(store)
    # rows of other months in the same run are not written
    write([(20180201, "new"), (20180301, "not asked for")], replace=[201802])
    assert set(before) < set(files(store))
    store.vacuum()
    kept = [f for f in before if "m=201802" not in f]
    assert set(kept) < set(files(store)) and not set(files(store)) & (set(before) - set(kept))
    got = {(r.k, r.v) for r in store.read("t").collect()}
    assert got == {r for r in rows if r[0] // 100 != 201802} | {(20180201, "new")}
    assert store.published()["t"]["rows"] == 5
    store.verify()
    assert "PartitionFilters: [isnotnull(m" in plan(store.read("t").where("m >= 201803"))


@pytest.fixture(scope="module")
def built(spark, fixture_raw):
    store = TableStore(spark, scratch_path(spark, "store-test"))
    run = store.run()
    over = B.build_run(run, Layers(fixture_raw))
    run.publish()
    yield store, run, over
    run.close()


def test_item_joins_need_no_exchange(spark, built):
    _, run, over = built
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.adaptive.enabled")}
    for k, v in zip(before, ("-1", "false")):
        spark.conf.set(k, v)
    try:
        st = over.staging
        items = Layers(over.raw, staging=st).int_orders_items_joined
        assert "Exchange" not in plan(items)
        keys = over.models["order_customer_keys"]
        fact = W.fact_orders(st["order_items"], st["orders"], st["customers"], st["order_payments"],
                             st["order_reviews"], over.dim_customers, over.dim_products,
                             over.dim_sellers, keys)
        # four tables by order: what is exchanged are the joined items and the dimensions alone
        assert plan(fact).split("Physical Plan")[-1].count("+- Exchange") <= 4
        by_order = (st["order_items"].join(st["orders"], "order_id").join(keys, "order_id")
                    .join(W.order_payments_agg(st["order_payments"]), "order_id", "left")
                    .join(W.order_reviews_agg(st["order_reviews"]), "order_id", "left"))
        assert "Exchange" not in plan(by_order)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_the_fact_is_pruned_by_month(built):
    store, _, _ = built
    fact, dates = store.read("fact_orders"), store.read("dim_date")
    some = dates.where("year = 2018 and month = 1")
    assert "dynamicpruning" in plan(W.in_period(fact, some))
    whole = fact.join(some, fact.order_date_key == some.date_key).count()
    assert W.in_period(fact, some).count() == whole
    static = plan(fact.where("order_month between 201801 and 201802"))
    assert "PartitionFilters: [isnotnull(order_month" in static


def test_written_models_equal_the_composed_ones(built, layers):
    store, _, over = built
    for name in ("dim_customers", "mart_sales_by_region", "mart_delivery_kpis"):
        assert sorted(map(str, store.read(name).collect())) == sorted(
            map(str, getattr(layers, name).select(*store.read(name).columns).collect()))
    fact = layers.fact_orders
    assert sorted(map(str, store.read("fact_orders").select(*fact.columns).collect())) == sorted(
        map(str, fact.collect()))


def test_composing_over_a_run_starts_no_job(spark, built):
    from commerce_marts.plans import quality as PQ
    from commerce_marts.plans import reports as R

    _, _, over = built
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("composing", "")
    try:
        R.executive_summary(over.fact_orders, over.dim_customers, over.dim_products, over.dim_sellers)
        R.revenue_by_state(over.fact_orders, over.dim_customers)
        PQ.fk_orphans(over)
        PQ.dq_results(over)
        assert list(tracker.getJobIdsForGroup("composing")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_month_refresh_of_the_fact(built, fixture_raw):
    store, _, _ = built
    months = sorted(store.published()["fact_orders"]["parts"])
    before = dict(store.published()["fact_orders"]["parts"])
    rows = sorted(map(str, store.read("fact_orders").collect()))
    B.refresh_months(store, Layers(fixture_raw), [int(months[0])])
    after = store.published()["fact_orders"]["parts"]
    assert {m for m in months if after[m] != before[m]} == {months[0]}
    assert sorted(map(str, store.read("fact_orders").collect())) == rows


def test_nothing_is_left_in_the_catalog(spark, built):
    _, run, _ = built
    run.close()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("cm_")]
