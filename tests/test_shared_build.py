"""The export and the warehouse build send their rows as few times as they can."""

from __future__ import annotations

import re

from commerce_marts import catalog
from commerce_marts.plans import build as B
from commerce_marts.plans import marts as M
from commerce_marts.plans import published as P
from commerce_marts.plans import reports as R
from commerce_marts.operators import quality as Q
from commerce_marts.plans.layers import Layers
from commerce_marts.sources.store import TableStore
from tests.fixture_data import frames, ten_order_rows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_export_reads_models_that_are_written_once(spark, monkeypatch):
    seen = {}

    def exported(marts, path):
        seen.update({n: df.inputFiles() for n, df in marts.items()})
        return catalog_checked(marts, path)

    catalog_checked = catalog.export_checked
    monkeypatch.setattr(catalog, "export_checked", exported)
    assert catalog.export_roundtrip(spark, "/root/testdata/sf0.001").count() > 0
    assert len(seen) == 3
    for files in seen.values():
        assert any("/int_orders_items_joined/" in f for f in files)
        assert not any("sf0.001" in f for f in files)


def test_items_are_sent_once_and_rows_without_an_order_kept(spark, tmp_path):
    rows = ten_order_rows()
    item = rows["order_items"][0]
    rows["order_items"] += [item, (None, *item[1:]), (None, *item[1:]), (None, 2, *item[2:])]
    raw = frames(spark, rows)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = B._staged_by_order("order_items", raw["order_items"], n)
    assert sorted(map(str, df.collect())) == sorted(map(str, B.Layers(raw).staging["order_items"].collect()))
    known = _plan(B._staged_by_order("order_items", raw["order_items"].where("order_id <> ''"), n))
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+, \d+\)", known)) == 2  # known rows, few others
    with TableStore(spark, str(tmp_path / "store")).run() as run:
        over = B.modelled(run, B.staged(run, B.Layers(raw), B.FOR_MARTS))
        assert run.entries["stg_order_items"]["rows"] == 12
        per_order = _plan(M.mart_sales_by_region(over.int_orders_items_joined, over.views["stg_customers"]))
        assert not re.search(r"Exchange hashpartitioning\(order_id", per_order)


def test_product_prices_are_grouped_once_in_a_build(spark, tmp_path):
    raw = frames(spark, ten_order_rows())
    with TableStore(spark, str(tmp_path / "store")).run() as run:
        over = B.build_run(run, Layers(raw))
        assert run.entries["product_prices"]["rows"] == 3
        files = " ".join(Layers(raw, staging=over.staging, models={
            "product_prices": run.read("product_prices")}).int_products_enriched.inputFiles())
        assert "/product_prices/" in files and "/stg_order_items/" not in files
        assert sorted(map(str, over.int_products_enriched.collect())) == sorted(
            map(str, Layers(raw).int_products_enriched.collect()))


def test_marts_send_orders_and_keep_places_without_a_name(spark):
    rows = ten_order_rows()
    rows["customers"] = [(c, u, z, None if c in ("c1", "c2") else city, None if c == "c1" else st)
                         for c, u, z, city, st in rows["customers"]]
    rows["order_items"] += [("o1", 2, *rows["order_items"][0][2:]), ("o3", 2, *rows["order_items"][2][2:])]
    p = Layers(frames(spark, rows))
    sales = {(r["customer_state"], r["customer_city"]): r for r in p.mart_sales_by_region.collect()}
    assert (None, None) in sales and ("SP", None) in sales
    assert (sales[None, None]["total_items"], sales[None, None]["unique_customers"]) == (2, 1)
    kpi = {r["customer_state"]: r for r in p.mart_delivery_kpis.collect()}
    assert (kpi[None]["total_orders"], kpi[None]["delivered_orders"], kpi[None]["avg_days_to_deliver"]) == (1, 2, 2.0)
    text = M.mart_delivery_kpis(p.int_orders_items_joined, p.views["stg_customers"])._jdf.queryExecution().optimizedPlan().toString()
    joined = text[text.index("Join Inner"):]  # what is below the join with the customers is combined
    assert "Aggregate [order_id" in joined and "Expand" not in text


def test_reports_read_the_fact_combined_once(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "book"))
    B.build_all(spark, Layers(frames(spark, ten_order_rows())), store.root)
    plans, book = {}, P.book

    def seen(layers, states, names):
        found = book(layers, states, names)
        plans.update({n: " ".join(df.inputFiles()) for n, df in found.items()})
        return found

    monkeypatch.setattr(P, "book", seen)
    P.publish_reports(store)
    for name in ("revenue_by_state", "revenue_over_time", "orders_by_weekday", "executive_summary",
                 "verify_revenue_by_state", "revenue_share_by_state", "price_bands", "top_categories"):
        assert "/fact_by_" in plans[name] and "/warehouse/fact_orders/" not in plans[name], name
    assert not [n for n in store.published() if n.startswith("fact_by_")]
    assert not [f for f in store.files.children(f"{store.root}/intermediate/fact_by_order")]


def test_orders_of_several_items_count_once_in_reports(spark):
    rows = ten_order_rows()
    rows["order_items"] += [("o1", 2, *rows["order_items"][0][2:]), ("o2", 2, *rows["order_items"][1][2:])]
    p = Layers(frames(spark, rows))
    got = {r["customer_state"]: (r["orders"], r["revenue"]) for r in R.revenue_by_state(
        p.fact_orders, p.dim_customers, None).collect()}
    assert got == {"SP": (4, 800.0), "RJ": (3, 450.0), "MG": (3, 450.0)}


def test_unaccepted_values_are_counted_without_sets(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("c", "ok"), (None, "z"), (None, None)],
                               "k string, s string")
    checked = Q.check_model(df, "m", ["k", "s"], ["k"], {"s": ["ok"]})
    assert "collect_set" not in checked._jdf.queryExecution().toString()
    assert {(r["column_name"], r["test"]): r["failures"] for r in checked.collect()} == {
        ("k", "not_null"): 2, ("s", "not_null"): 1, ("k", "unique"): 1, ("s", "accepted_values"): 3}
