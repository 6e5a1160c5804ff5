"""CSV landing path: canonical files → manifest → typed read → parquet → models."""

from __future__ import annotations

import os
import shutil
import tempfile
import warnings

import pytest
from pyspark.sql import functions as F

from commerce_marts.plans import reports as R
from commerce_marts.plans.layers import Layers
from commerce_marts.session import scratch_path
from commerce_marts.sources.io import (land_as_parquet, manifest_check, read_source,
                                       require_manifest, write_csv)
from commerce_marts.sources.schemas import SOURCES
from tests.fixture_data import frames, ten_order_rows


def _write_landing(spark, drop=()):
    """The fixture as the nine canonical CSV files in one local landing folder."""
    rows = ten_order_rows()
    # a multi-line, quoted review comment with a comma and an embedded quote
    rows["order_reviews"][0] = ("r1", "o1", 5, "ok", 'line one, "quoted"\nline two',
                                None, None)
    landing = tempfile.mkdtemp(prefix="cm-landing-")
    for name, df in frames(spark, rows).items():
        if name in drop:
            continue
        tmp = write_csv(df.coalesce(1), f"{landing}/_parts_{name}")
        part = next(f for f in os.listdir(tmp) if f.endswith(".csv"))
        shutil.copyfile(os.path.join(tmp, part), os.path.join(landing, SOURCES[name].file_name))
    return landing


def test_csv_landing_end_to_end(spark):
    landing = _write_landing(spark)
    require_manifest(spark, landing)
    out = scratch_path(spark, "landed")
    paths = land_as_parquet(spark, landing, out)
    assert set(paths) == set(SOURCES)
    raw = {n: spark.read.parquet(p) for n, p in paths.items()}
    comment = raw["order_reviews"].where("review_id = 'r1'").first().review_comment_message
    assert comment == 'line one, "quoted"\nline two'
    assert raw["customers"].where(F.col("customer_zip_code_prefix") == "100").count() == 1
    p = Layers(raw)
    kpi = R.executive_summary(p.fact_orders, p.dim_customers, p.dim_products,
                              p.dim_sellers).first()
    assert (kpi.total_orders, kpi.revenue_total, kpi.avg_review_score) == (10, 1450.0, 4.1)


def test_missing_source_is_skipped_with_warning(spark):
    landing = _write_landing(spark, drop=("geolocation",))
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        paths = land_as_parquet(spark, landing, scratch_path(spark, "landed-partial"))
    assert "geolocation" not in paths and len(paths) == 8
    assert any("olist_geolocation_dataset.csv" in str(w.message) for w in caught)


def test_columns_go_by_header_and_bad_cells_fail(spark, tmp_path):
    path = str(tmp_path / "sellers.csv")
    with open(path, "w") as f:
        f.write("seller_zip_code_prefix,seller_id,seller_city,seller_state\n01037,s1,sao paulo,SP\n")
    row = read_source(spark, "sellers", path).first()
    assert (row.seller_id, row.seller_zip_code_prefix) == ("s1", "01037")
    bad = str(tmp_path / "payments.csv")
    with open(bad, "w") as f:
        f.write("order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
                "o1,one,boleto,1,2.5\n")
    with pytest.raises(Exception, match="one"):
        read_source(spark, "order_payments", bad).collect()
    with pytest.raises(ValueError, match="no column"):
        read_source(spark, "order_payments", path)


def test_manifest_counts_folder_tables(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "items.parquet"))
    rows = {r.file_name: r for r in manifest_check(
        spark, str(tmp_path), ["items.parquet", "none.parquet"]).collect()}
    assert rows["items.parquet"].present and rows["items.parquet"].size_bytes > 0
    assert not rows["none.parquet"].present
    assert not manifest_check(spark, str(tmp_path / "absent"), ["x"]).first().present
