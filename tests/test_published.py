"""Reports over the published warehouse."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from commerce_marts.plans import build as B
from commerce_marts.plans import published as P
from commerce_marts.plans.layers import Layers
from commerce_marts.session import scratch_path
from commerce_marts.sources.store import POINTER, TableStore
from tests.test_store import files, plan

STATES = ("SP", "RJ", "MG")


@pytest.fixture(scope="module")
def store(spark, fixture_raw):
    store = TableStore(spark, scratch_path(spark, "published-test"))
    B.build_all(spark, Layers(fixture_raw), store.root)
    P.publish_reports(store, STATES)
    yield store
    store.drop()


@pytest.mark.parametrize("name", list(P.report_set()))
def test_a_stored_report_equals_the_composed_one(store, layers, name):
    composed = P.report_set(STATES)[name].of(layers)
    kept = store.read(name)
    assert kept.columns == composed.columns
    assert [f.dataType for f in kept.schema] == [f.dataType for f in composed.schema]
    assert sorted(map(str, kept.collect())) == sorted(map(str, composed.collect()))


def test_composing_the_book_starts_no_job_and_builds_nothing(spark, store):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("book", "")
    try:
        results = P.book(P.published(store), STATES)
        assert list(tracker.getJobIdsForGroup("book")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert set(results) == set(P.report_set())
    for name, r in P.report_set(STATES).items():
        text = plan(results[name])
        assert store.root in text and "WindowGroupLimit" not in text, name
        assert ("/warehouse/fact_orders/" in text) == r.over_fact, name


@pytest.fixture
def rewritten(store):
    """Publishes another fact; the pointer is set back afterwards."""
    before = store.files.read(f"{store.root}/{POINTER}")

    def write(fact):
        with store.run() as run:
            run.write("fact_orders", "warehouse", fact, "fact", partition=P.MONTH)
            run.publish()

    yield write
    store.files.replace(f"{store.root}/{POINTER}", before)


def test_months_limit_the_files_of_the_fact(store, rewritten):
    fact = store.read("fact_orders")
    first = fact.first()[P.MONTH]
    rewritten(fact.unionByName(fact.limit(3).withColumn(P.MONTH, F.lit(first + 1))))
    for months, want in (([first], 10), ([first + 1], 3), ([first, first + 1], 13), ([], 0)):
        some = P.published(store, months=months).fact_orders
        assert some.count() == want
        assert {int(f.split(f"{P.MONTH}=")[1].split("/")[0]) for f in some.inputFiles()} >= set(months)
    text = plan(P.published(store, months=[first]).fact_orders)
    assert "PartitionFilters: [isnotnull(order_month" in text


def test_reports_of_one_book_see_one_run(store, rewritten):
    before = P.published(store)
    rows = before.fact_orders.count()
    rewritten(store.read("fact_orders").where("false"))
    assert store.read("fact_orders").count() == 0
    assert before.fact_orders.count() == rows
    summary = P.book(P.published(store), STATES, ["executive_summary"])["executive_summary"].first()
    assert summary["total_orders"] == 0 and summary["revenue_total"] is None


def test_values_hold_every_cell(store):
    results = {n: store.read(n) for n in P.report_set()}
    got = P.report_values(results, STATES).collect()
    width = {n: len(df.columns) - len(P.report_set()[n].keys) for n, df in results.items()}
    assert len(got) == sum(width[n] * df.count() for n, df in results.items())
    cells = {(r.report, r.key, r.column_name): r for r in got}
    summary = results["executive_summary"].first()
    assert cells["executive_summary", "", "total_orders"].value == summary["total_orders"]
    latest = results["latest_orders"].first()
    assert cells["latest_orders", latest["order_id"], "order_status"].text == latest["order_status"]


def test_a_store_without_a_warehouse_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="publishes no dim_date"):
        P.published(TableStore(spark, str(tmp_path)))


def test_a_dropped_store_leaves_no_files(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    with store.run() as run:
        run.write("t", "marts", spark.range(3))
        run.publish()
    store.drop()
    assert not files(store) and store.published() == {}


def test_correlation_of_what_does_not_vary_is_null(spark):
    from commerce_marts.operators.aggregates import correlation

    df = spark.createDataFrame([(1, 1.0, 2.0, 5.0), (1, 2.0, 1.0, 5.0), (1, 4.0, 0.0, 5.0),
                                (2, 1.0, 1.0, 5.0)], "g int, x double, y double, c double")
    got = {r.g: r for r in df.groupBy("g").agg(
        correlation(F.col("x"), F.col("y")).alias("xy"), correlation(F.col("x"), F.col("c")).alias("xc"),
    ).collect()}
    assert got[1].xy == pytest.approx(-0.9819805060619659) and got[1].xc is None
    assert got[2].xy is None
    assert df.where("false").agg(correlation(F.col("x"), F.col("y"))).first()[0] is None
