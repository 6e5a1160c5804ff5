"""Operator edge cases: ties, NULLs, rounding, bands, keys, empty input."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from commerce_marts.functions import money_mean, pct, price_band, round_half_up
from commerce_marts.operators.aggregates import mode_of, share_of_total, trend_line
from commerce_marts.operators.calendar import build_calendar, date_bounds
from commerce_marts.operators.dedup import dedup_by_key, latest_per_key
from commerce_marts.operators.keys import surrogate_key
from commerce_marts.operators import quality as Q
from commerce_marts.plans import marts as M
from commerce_marts.plans import staging as S
from commerce_marts.plans import warehouse as W
from commerce_marts.sources.schemas import RAW_SCHEMAS


def test_dedup_latest_answer_wins(spark):
    df = spark.createDataFrame(
        [("r1", "o1", 2, None, None, None, "2024-01-02 00:00:00"),
         ("r1", "o1", 5, None, None, None, "2024-01-09 00:00:00"),
         ("r2", "o2", 3, None, None, None, None)],
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date string, "
        "review_answer_timestamp string").withColumn(
        "review_answer_timestamp", F.col("review_answer_timestamp").cast("timestamp_ntz"))
    out = dedup_by_key(df, ["review_id"], [("review_answer_timestamp", "desc")])
    assert sorted((r.review_id, r.review_score) for r in out.collect()) == [("r1", 5), ("r2", 3)]


def test_dedup_is_deterministic_under_ties(spark):
    rows = [("k", 1, "b"), ("k", 1, "a"), ("k", 1, "a"), ("j", None, "z"), ("j", 0, "z")]
    df = spark.createDataFrame(rows, "id string, x int, y string").repartition(4)
    out = sorted(tuple(r) for r in dedup_by_key(df, ["id"]).collect())
    # remaining columns ascending with NULLs last decide
    assert out == [("j", 0, "z"), ("k", 1, "a")]


def test_latest_per_key_nulls_last(spark):
    df = spark.createDataFrame(
        [("u", None, "x"), ("u", "2024-01-01 00:00:00", "y")], "k string, ts string, v string"
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert latest_per_key(df, "k", "ts").first().v == "y"


def test_safe_timestamps_and_cleaning(spark):
    raw = spark.createDataFrame(
        [("o1", "c1", "delivered", "not-a-date", None, None, "2024-01-03", "2024-01-06 00:00:00")],
        RAW_SCHEMAS["orders"])
    r = S.clean_orders(raw).first()
    assert r.order_purchase_timestamp is None and r.order_delivered_customer_date is not None
    cust = spark.createDataFrame([("c1", "u1", "01037", " Sao Paulo ", " sp")],
                                 RAW_SCHEMAS["customers"])
    c = S.clean_customers(cust).first()
    assert (c.customer_city, c.customer_state, c.customer_zip_code_prefix) == (
        "sao paulo", "SP", "01037")


def test_fill_defaults_for_products(spark):
    raw = spark.createDataFrame([("p9", None, None, None, None, None, None, None, None)],
                                RAW_SCHEMAS["products"])
    r = S.clean_products(raw).first()
    assert r.product_category_name == "sin_categoria" and r.product_weight_g == 0.0


@pytest.mark.parametrize("value,digits,expected", [
    (2.5, 0, 3.0), (-2.5, 0, -3.0), (1.005, 2, 1.0), (4.125, 2, 4.13), (0.05, 1, 0.1)])
def test_round_half_up(spark, value, digits, expected):
    got = spark.range(1).select(round_half_up(F.lit(value), digits).alias("r")).first().r
    assert got == expected


def test_review_average_rounds_half_up(spark):
    reviews = spark.createDataFrame([("o1", 2), ("o1", 3), ("o2", 4)],
                                    "order_id string, review_score int")
    got = {r.order_id: r.review_score for r in W.order_reviews_agg(reviews).collect()}
    assert got == {"o1": 3.0, "o2": 4.0}


def test_price_band_boundaries(spark):
    df = spark.createDataFrame([(None,), (49.99,), (50.0,), (150.0,), (499.99,), (500.0,)],
                               "p double")
    got = [r.b for r in df.select(price_band("p", none_label="no_sales").alias("b")).collect()]
    assert got == ["no_sales", "budget", "mid_range", "premium", "premium", "luxury"]


def test_unrounded_vs_rounded_band(spark):
    """49.996 is budget on the exact mean but mid_range after rounding to cents."""
    items = spark.createDataFrame(
        [("o1", 1, "p1", "s1", None, p, 0.0) for p in (49.99, 50.0, 50.0, 49.99, 50.0)],
        RAW_SCHEMAS["order_items"])
    products = spark.createDataFrame([("p1", "x", 1, 1, 1, 1.0, 1.0, 1.0, 1.0)],
                                     RAW_SCHEMAS["products"])
    tr = spark.createDataFrame([], RAW_SCHEMAS["category_translation"])
    dim = W.dim_products(products, tr, items).first()
    enr = M.int_products_enriched(S.staging_view("products", products), tr, items).first()
    assert (dim.price_band, enr.price_band, enr.avg_price) == ("budget", "mid_range", 50.0)
    assert enr.category_en == "other" and dim.product_category_en is None


def test_cents_mean_is_exact_and_partition_independent(spark):
    rnd = random.Random(3)
    cents = [rnd.randint(1, 10_000_000) for _ in range(5000)]
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double")
    expected = (sum(cents) / 100.0) / len(cents)  # exact sum, one division
    got = {df.repartition(n).agg(money_mean("x").alias("m")).first().m for n in (1, 3, 7)}
    assert got == {expected}


def test_pct_null_on_zero_denominator(spark):
    r = spark.range(1).select(pct(F.lit(1), F.lit(0)).alias("p")).first()
    assert r.p is None


def test_mode_ties_resolve_to_lowest_value(spark):
    df = spark.createDataFrame([("o", "voucher"), ("o", "credit_card"), ("p", "boleto"),
                                ("p", "voucher"), ("p", "voucher"), ("q", None)],
                               "order_id string, t string")
    got = {r.order_id: r.m for r in df.groupBy("order_id").agg(mode_of("t").alias("m")).collect()}
    assert got == {"o": "credit_card", "p": "voucher", "q": None}


def test_surrogate_key_matches_global_row_number(spark):
    rnd = random.Random(7)
    keys = list({"".join(rnd.choice("0123456789abcdef") for _ in range(rnd.randint(1, 12)))
                 for _ in range(3000)})
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int")
    got = surrogate_key(df.repartition(5), "k", "sk", num_buckets=7)
    expected = df.withColumn("sk", F.row_number().over(Window.orderBy("k")))
    assert sorted(tuple(r) for r in got.select("sk", "k").collect()) == sorted(
        tuple(r) for r in expected.select("sk", "k").collect())


def test_surrogate_key_default_buckets(spark):
    df = spark.createDataFrame([(f"k{i:04d}",) for i in range(997)], "k string").repartition(3)
    got = [r.sk for r in surrogate_key(df, "k", "sk").orderBy("k").collect()]
    assert got == list(range(1, 998))


def test_surrogate_key_empty_input(spark):
    df = spark.createDataFrame([], "k string")
    assert surrogate_key(df, "k", "sk").count() == 0


def test_calendar_contiguous_and_empty(spark):
    d = spark.createDataFrame([("2023-12-30 10:00:00",), ("2024-01-02 00:00:00",)], "ts string")
    d = d.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    cal = build_calendar(date_bounds(d, "ts")).orderBy("full_date").collect()
    assert [r.date_key for r in cal] == [20231230, 20231231, 20240101, 20240102]
    assert cal[2].week_of_year == 1 and cal[0].month_name == "December"
    empty = spark.createDataFrame([], "ts timestamp_ntz")
    assert build_calendar(date_bounds(empty, "ts")).count() == 0


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n long")
    got = {r.k: r.s for r in share_of_total(df, "n", "s").collect()}
    assert got == {"a": 25.0, "b": 75.0}


def test_trend_line_matches_least_squares(spark):
    xs, ys = [1.0, 2.0, 4.0, 7.0], [4.8, 4.5, 4.1, 3.2]
    df = spark.createDataFrame(list(zip(xs, ys)), "x double, y double")
    r = trend_line(df, "x", "y").first()
    slope, intercept = np.polyfit(xs, ys, 1)
    assert r.n_points == 4
    assert r.slope == pytest.approx(slope, abs=1e-6)
    assert r.intercept == pytest.approx(intercept, abs=1e-6)


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "bad"), ("b", "x")],
                               "id string, v string")
    nn = Q.check_not_null(df, "m", "v").first().failures
    un = Q.check_unique(df, "m", "id").first().failures
    av = Q.check_accepted_values(df, "m", "v", ["x"]).first().failures
    assert (nn, un, av) == (1, 1, 1)
    dup = Q.profile_duplicate_keys(df, "t", ["id"]).first()
    assert (dup.duplicated_rows, dup.duplicated_pct) == (2, 50.0)
    sample = [tuple(r) for r in Q.duplicate_key_sample(df, ["id"]).collect()]
    assert sample == [("a",), ("a",)]
    nulls = {r.column_name: r.null_count for r in Q.profile_nulls(df, "t").collect()}
    assert nulls == {"id": 1, "v": 1}


def test_single_pass_constraints_match_separate_checks(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, None), ("a", 2, "y"), (None, 3, "z"), (None, 3, None),
         ("b", None, "w")], "k1 string, k2 int, v string")
    one = Q.check_not_null_and_unique(df, "m", ["k1", "k2", "v"], ["k1", "k2"])
    two = Q.check_not_null_many(df, "m", ["k1", "k2", "v"]).unionByName(
        Q.check_unique(df, "m", ["k1", "k2"]))
    assert sorted(tuple(r) for r in one.collect()) == sorted(tuple(r) for r in two.collect())


def test_profiles_on_empty_input(spark):
    df = spark.createDataFrame([], "id string, x double")
    assert Q.profile_table(df, "t", ["id"]).first().n_rows == 0
    assert {r.column_name: r.n_distinct for r in Q.profile_cardinality(df, "t").collect()} == {
        "id": 0, "x": 0}
