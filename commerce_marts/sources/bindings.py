"""Bind the driver's parquet tables to the nine canonical raw sources.

The driver tables (orders, lineitem, customer, part, supplier, nation,
region) carry no payments, reviews, cities or delivery dates, so those are
derived deterministically from the keys.  They are stand-ins that exercise
every operator (duplicate keys, ties, NULLs, unsold products, untranslated
categories), not facts about the data.  Every derivation is a plain column
expression or an equi-join; nothing is collected.

Only ``nation`` (25 rows) and ``region`` (5 rows) are broadcast:
their size is fixed by the benchmark definition.  The join of orders with
customers is shuffled, as both grow (``operators.keys.shuffled``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_marts.functions.scalar import round_half_up
from commerce_marts.operators.keys import shuffled
from commerce_marts.sources.schemas import RAW_SCHEMAS

DRIVER_TABLES = ("orders", "lineitem", "customer", "part", "supplier", "nation", "region")


_READS: dict[tuple[int, str], DataFrame] = {}

# The states of the driver's customers, first two letters of the five regions.
STATES = ("AF", "AM", "AS", "EU", "MI")


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (memoized per session and path; reads are lazy)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    if key not in _READS:
        df = spark.read.parquet(path)
        _READS[key] = df
    return _READS[key]


def _s(c) -> F.Column:
    return c.cast("string")


def _conform(df: DataFrame, name: str) -> DataFrame:
    schema = RAW_SCHEMAS[name]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = driver_table(spark, sf_dir, "nation")
    region = driver_table(spark, sf_dir, "region")
    return F.broadcast(
        nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
        .select("n_nationkey", "n_name", "r_name"))


def _corrupt(text: F.Column, key: F.Column, corrupt: bool) -> F.Column:
    if not corrupt:
        return text
    return F.when(key % 53 == 0, F.lit("not-a-date")).otherwise(text)


def raw_orders(spark: SparkSession, sf_dir: str, corrupt_dates: bool = False) -> DataFrame:
    o = driver_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    is_f = F.col("o_orderstatus") == "F"
    status = (F.when(is_f, "delivered").when(F.col("o_orderstatus") == "O", "shipped")
              .otherwise("processing"))
    purchase = _s(F.col("o_orderdate"))
    carrier = F.when(is_f, _s(F.date_add(day, 1)))
    delivered = F.when(is_f, _s(F.date_add(day, (key % 30 + 1).cast("int"))))
    estimated = F.when(key % 97 != 0, _s(F.date_add(day, (key % 15 + 10).cast("int"))))
    df = o.select(
        _s(key).alias("order_id"), _s(key).alias("customer_id"),
        status.alias("order_status"),
        _corrupt(purchase, key, corrupt_dates).alias("order_purchase_timestamp"),
        _corrupt(purchase, key, corrupt_dates).alias("order_approved_at"),
        _corrupt(carrier, key, corrupt_dates).alias("order_delivered_carrier_date"),
        _corrupt(delivered, key, corrupt_dates).alias("order_delivered_customer_date"),
        _corrupt(estimated, key, corrupt_dates).alias("order_estimated_delivery_date"),
    )
    return _conform(df, "orders")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = driver_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nr = _nation_region(spark, sf_dir)
    oc = o.join(shuffled(c), o.o_custkey == c.c_custkey)
    df = oc.join(nr, nr.n_nationkey == (oc.c_nationkey + oc.o_orderkey % 2) % 25).select(
        _s(F.col("o_orderkey")).alias("customer_id"),
        _s(F.col("o_custkey")).alias("customer_unique_id"),
        _s(F.col("n_nationkey") + 10000).alias("customer_zip_code_prefix"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("customer_city"),
        F.lower(F.substring("r_name", 1, 2)).alias("customer_state"),
    )
    return _conform(df, "customers")


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = driver_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nr = _nation_region(spark, sf_dir)
    df = c.join(nr, nr.n_nationkey == c.c_nationkey).select(
        _s(F.col("c_nationkey") + 10000).alias("geolocation_zip_code_prefix"),
        (F.col("c_custkey") % 90).cast("double").alias("geolocation_lat"),
        (F.col("c_custkey") % 180).cast("double").alias("geolocation_lng"),
        F.col("n_name").alias("geolocation_city"),
        F.substring("r_name", 1, 2).alias("geolocation_state"),
    )
    return _conform(df, "geolocation")


def raw_order_items(spark: SparkSession, sf_dir: str, corrupt_dates: bool = False) -> DataFrame:
    li = driver_table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey")
    ship = _s(F.to_date("l_shipdate"))
    # items of every fortieth part go to the part after it, which leaves unsold products
    part = F.col("l_partkey") + F.when(F.col("l_partkey") % 40 == 0, 1).otherwise(0)
    df = li.select(
        _s(key).alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _s(part).alias("product_id"),
        _s(F.col("l_suppkey")).alias("seller_id"),
        _corrupt(ship, key, corrupt_dates).alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        round_half_up(F.col("l_extendedprice") * F.col("l_tax"), 2).alias("freight_value"),
    )
    return _conform(df, "order_items")


def raw_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment 1 per order (type by priority) and a voucher payment 2 for some.

    Both rows come out of one scan: an array of candidate payment structs per
    order is generated and the inapplicable ones are dropped.
    """
    o = driver_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    # payments of an unknown order leave orders without payments
    order_id = F.concat(F.when(key % 101 == 0, "x").otherwise(""), _s(key))
    prio = F.substring("o_orderpriority", 1, 1)
    ptype = (F.when(prio.isin("1", "2", "3"), "credit_card").when(prio == "4", "boleto")
             .otherwise("voucher"))
    first = F.struct(F.lit(1).alias("payment_sequential"), ptype.alias("payment_type"),
                     (key % 10 + 1).cast("int").alias("payment_installments"),
                     F.col("o_totalprice").alias("payment_value"))
    second = F.when(key % 4 == 0, F.struct(
        F.lit(2).alias("payment_sequential"), F.lit("voucher").alias("payment_type"),
        F.lit(1).cast("int").alias("payment_installments"),
        F.lit(10.5).alias("payment_value")))
    df = (o.select(order_id.alias("order_id"),
                   F.explode(F.array(first, second)).alias("p"))
          .where(F.col("p").isNotNull())
          .select("order_id", "p.*"))
    return _conform(df, "order_payments")


def raw_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review ``r<key>`` (re-answered later with score 5 for some keys) and ``s<key>``.

    One scan of orders; each order yields up to three candidate rows.
    """
    o = driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    key, ts = F.col("o_orderkey"), F.col("o_orderdate")

    def review(cond, prefix, score, answer_days):
        return F.when(cond, F.struct(
            F.concat(F.lit(prefix), _s(key)).alias("review_id"),
            score.cast("int").alias("review_score"),
            (ts + F.expr(f"INTERVAL {answer_days} DAY")).alias("review_answer_timestamp")))

    candidates = F.array(review(F.lit(True), "r", key * 7 % 5 + 1, 3),
                         review(key % 13 == 0, "r", F.lit(5), 9),
                         review(key % 11 == 0, "s", F.lit(4), 5))
    df = (o.select(key, ts, F.explode(candidates).alias("r"))
          .where(F.col("r").isNotNull())
          # the first review of some orders names an unknown order
          .select(F.col("r.review_id"),
                  F.concat(F.when((key % 10 == 0) & F.col("r.review_id").startswith("r"), "x")
                           .otherwise(""), _s(key)).alias("order_id"), F.col("r.review_score"),
                  F.lit(None).cast("string").alias("review_comment_title"),
                  F.when(key % 3 == 0, F.concat(F.lit("review of order "), _s(key)))
                  .alias("review_comment_message"),
                  (ts + F.expr("INTERVAL 1 DAY")).alias("review_creation_date"),
                  F.col("r.review_answer_timestamp")))
    return _conform(df, "order_reviews")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = driver_table(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    df = p.select(
        _s(key).alias("product_id"),
        F.when(key % 50 != 0, F.lower("p_brand")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        (size * 10).cast("int").alias("product_description_lenght"),
        (size % 7).cast("int").alias("product_photos_qty"),
        F.when(key % 60 != 0, size.cast("double")).alias("product_weight_g"),
        (size + 1).cast("double").alias("product_length_cm"),
        (size + 2).cast("double").alias("product_height_cm"),
        (size + 3).cast("double").alias("product_width_cm"),
    )
    return _conform(df, "products")


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = driver_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nr = _nation_region(spark, sf_dir)
    df = s.join(nr, nr.n_nationkey == s.s_nationkey).select(
        _s(F.col("s_suppkey")).alias("seller_id"),
        _s(F.col("s_nationkey") + 10000).alias("seller_zip_code_prefix"),
        F.concat(F.lit(" "), F.col("n_name")).alias("seller_city"),
        F.lower(F.substring("r_name", 1, 2)).alias("seller_state"),
    )
    return _conform(df, "sellers")


def raw_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = driver_table(spark, sf_dir, "part")
    # one category is translated under another name, so its products have no translation
    name = F.concat(F.lower("p_brand"), F.when(F.col("p_brand") == "Brand#1", "_old").otherwise(""))
    df = p.select(name.alias("product_category_name"),
                  F.upper("p_brand").alias("product_category_name_english")).distinct()
    return _conform(df, "category_translation")


class LazySources(Mapping):
    """Mapping name → DataFrame that defines each source on first access."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def raw_sources(spark: SparkSession, sf_dir: str, corrupt_dates: bool = False) -> LazySources:
    """All nine raw sources over the driver tables, each defined on first use."""
    return LazySources({
        "customers": lambda: raw_customers(spark, sf_dir),
        "geolocation": lambda: raw_geolocation(spark, sf_dir),
        "order_items": lambda: raw_order_items(spark, sf_dir, corrupt_dates),
        "order_payments": lambda: raw_order_payments(spark, sf_dir),
        "order_reviews": lambda: raw_order_reviews(spark, sf_dir),
        "orders": lambda: raw_orders(spark, sf_dir, corrupt_dates),
        "products": lambda: raw_products(spark, sf_dir),
        "sellers": lambda: raw_sellers(spark, sf_dir),
        "category_translation": lambda: raw_category_translation(spark, sf_dir),
    })
