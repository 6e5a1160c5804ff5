"""CSV part files with their own headers, bad cells kept aside, profiles of scanned sources."""

from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from commerce_marts.plans import quality as PQ
from commerce_marts.sources.io import CORRUPT, land_with_quarantine, read_source
from commerce_marts.sources.schemas import SOURCES

HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state"
ITEMS = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value"


@pytest.fixture
def folder(tmp_path):
    def write(name, parts):
        at = tmp_path / "in" / name
        at.mkdir(parents=True)
        for i, text in enumerate(parts):
            (at / f"part-{i}.csv").write_text(text)
        return str(at)
    return write


def test_part_files_go_by_their_own_header(spark, folder, tmp_path):
    path = folder("sellers", [f"{HEADER}\ns1,01001,a,SP\n",
                              "seller_zip_code_prefix,seller_id,more,seller_state,seller_city\n"
                              '01002,s2,x,RJ,"b, c"\n', f"{HEADER}\n", ""])
    (tmp_path / "in" / "sellers" / "_SUCCESS").write_text("")
    with gzip.open(tmp_path / "in" / "sellers" / "part-9.csv.gz", "wt") as f:
        f.write("seller_state,seller_city,seller_id,seller_zip_code_prefix\nMG,d,s3,01003\n")
    got = sorted(map(tuple, read_source(spark, "sellers", path).collect()))
    assert got == [("s1", "01001", "a", "SP"), ("s2", "01002", "b, c", "RJ"), ("s3", "01003", "d", "MG")]


def test_a_part_file_without_a_column_is_an_error(spark, folder):
    path = folder("sellers", [f"{HEADER}\ns1,01001,a,SP\n", "seller_id,seller_city\ns2,b\n"])
    with pytest.raises(ValueError, match="part-1.csv has no column seller_zip_code_prefix"):
        read_source(spark, "sellers", path)


def test_bad_cells_are_counted_and_kept(spark, folder):
    path = folder("order_items", [f"{ITEMS}\no1,1,p,s,2018-01-01,1.5,2.5\no1,two,p,s,2018-01-01,1.5,2\n",
                                  f"{ITEMS}\no2,1,p,s,2018-01-01,cheap,2.5\no3,1,p,s,2018-01-01,3,4\n"])
    df = read_source(spark, "order_items", path, quarantine=True)
    assert df.where(F.col(CORRUPT).isNull()).count() == 2
    # reading one column that is whole everywhere still finds the bad cells of the others
    assert sorted(r[0] for r in df.where(F.col(CORRUPT).isNull()).select("order_id").collect()) == ["o1", "o3"]
    bad = sorted(r[0] for r in df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT).collect())
    assert bad == ["o1,two,p,s,2018-01-01,1.5,2", "o2,1,p,s,2018-01-01,cheap,2.5"]
    with pytest.raises(Exception, match="(?i)malformed"):
        read_source(spark, "order_items", path).collect()


def test_landing_with_quarantine_and_profiles(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / SOURCES["order_items"].file_name).write_text(
        f"{ITEMS}\no1,1,p,s,2018-01-01,1.5,2.5\no1,1,p,s,,1.5,2\no1,x,p,s,2018-01-01,1,2\n")
    (landing / SOURCES["sellers"].file_name).write_text(f"{HEADER}\ns1,01001,,SP\n")
    out, aside = str(tmp_path / "out"), str(tmp_path / "aside")
    counts = {tuple(r) for r in land_with_quarantine(spark, str(landing), out, aside).collect()}
    assert counts == {("order_items", 2, 1), ("sellers", 1, 0)}
    assert spark.read.parquet(f"{out}/order_items").count() == 2
    kept = spark.read.parquet(f"{aside}/order_items/records").first()
    assert kept["record"] == "o1,x,p,s,2018-01-01,1,2" and kept["file"].endswith(".csv")
    raw = {n: read_source(spark, n, str(landing / SOURCES[n].file_name), quarantine=n == "order_items")
           .where("true").drop(CORRUPT, "_file") for n in ("order_items", "sellers")}
    raw["order_items"] = spark.read.parquet(f"{out}/order_items")
    got = {r["table_name"]: (r["n_rows"], r["n_columns"], r["total_nulls"], r["has_duplicate_pk"])
           for r in PQ.profile_summary(raw).collect()}
    assert got == {SOURCES["order_items"].file_name: (2, 7, 1, True),
                   SOURCES["sellers"].file_name: (1, 4, 1, False), "TOTAL": (3, 11, 2, None)}
