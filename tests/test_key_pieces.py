"""Keys are grouped in pieces whose number follows the input files."""

from __future__ import annotations

from commerce_marts.operators import quality as Q


def _table(spark, tmp_path):
    spark.range(20000).selectExpr("cast(id % 19990 as string) k", "id v").write.parquet(f"{tmp_path}/t")
    return spark.read.parquet(f"{tmp_path}/t")


def test_pieces_follow_the_files(spark, tmp_path, monkeypatch):
    df = _table(spark, tmp_path)
    monkeypatch.setattr(Q, "KEY_BYTES", 10_000)
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert Q.by_key(df, ["k"]).rdd.getNumPartitions() == -(-size // 10_000) > 4
    rows = Q.duplicate_key_counts(df, "t", ["k"]).collect()
    assert [(r["key"], r["copies"]) for r in rows] == [("0", 2), ("1", 2), ("2", 2), ("3", 2)]
    found = Q.profile_table(df, "t", ["k"]).first()
    assert (found["n_rows"], found["total_nulls"], found["has_duplicate_pk"]) == (20000, 0, True)


def test_keys_have_one_exchange_of_a_given_number(spark, tmp_path):
    df = _table(spark, tmp_path)
    for of in (Q.duplicate_key_counts(df, "t", ["k"]), Q.profile_table(df, "t", ["k"]),
               Q.duplicate_key_rows(df, ["k"]), Q.check_model(df, "t", ["v"], ["k"])):
        plan = of._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning") == plan.count("REPARTITION_BY_NUM") == 1


def test_no_sets_without_accepted_values(spark, tmp_path):
    df = _table(spark, tmp_path)
    assert "collect_set" not in Q.check_model(df, "t", ["v"], ["k"])._jdf.queryExecution().toString()
    nulls = spark.createDataFrame([(None, 1), (None, None), ("a", 2), ("a", None)], "k string, v int")
    got = {(r["column_name"], r["test"]): r["failures"]
           for r in Q.check_model(nulls, "t", ["k", "v"], ["k"]).collect()}
    assert got == {("k", "not_null"): 2, ("v", "not_null"): 2, ("k", "unique"): 1}
