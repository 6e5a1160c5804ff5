"""Data-quality profiling and checks.

Every profile is computed in one aggregation pass per table (all columns in
one ``agg``) and then turned into long form with ``unpivot``; no column loop
issues a job of its own and nothing is collected.  Checks return failing
counts in the dbt convention:

* ``not_null``        — rows where the column is NULL;
* ``unique``          — key values (NULL ignored) that occur more than once;
* ``accepted_values`` — distinct non-NULL values outside the accepted list.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_marts.functions import pct, round_half_up

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def _union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


#: Bytes of input files behind one task that groups keys.
KEY_BYTES = 4 << 20


def by_key(df: DataFrame, key: Sequence[str | Column]) -> DataFrame:
    """``df`` with the rows of a key in one task, as many tasks as the files behind ``df`` call
    for: a ``groupBy`` of ``key`` needs no other exchange, and the keys that a task holds at a
    time grow neither with the table nor with the size of a file split."""
    spark = df.sparkSession
    conf, at = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    paths = [at(f) for f in df.inputFiles()]
    size = sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)
    # never one: a union puts single partitions of several tables into one task
    return df.repartition(max(2, -(-size // KEY_BYTES)), *key)


def profile_table(df: DataFrame, table: str, pk: Sequence[str] = ()) -> DataFrame:
    """One row: table, n_rows, n_columns, total_nulls, has_duplicate_pk."""
    if pk:
        # one pass: the key aggregation needed for the duplicate flag carries
        # the NULL count of all columns as one partial sum
        pk = list(pk)
        nulls = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
        per_key = by_key(df.select(*pk, nulls.alias("_n")), pk).groupBy(*pk).agg(
            F.count(F.lit(1)).alias("_c"), F.sum("_n").alias("_n"))
        base = per_key.agg(
            F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("n_rows"),
            F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_nulls"),
            (F.coalesce(F.max("_c"), F.lit(0)) > 1).alias("has_duplicate_pk"))
    else:
        nulls = [F.sum(F.col(c).isNull().cast("long")) for c in df.columns]
        total_nulls = nulls[0]
        for n in nulls[1:]:
            total_nulls = total_nulls + n
        base = df.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.coalesce(total_nulls, F.lit(0)).cast("long").alias("total_nulls"),
                      F.lit(None).cast("boolean").alias("has_duplicate_pk"))
    return base.select(F.lit(table).alias("table_name"), "n_rows",
                       F.lit(len(df.columns)).alias("n_columns"), "total_nulls",
                       "has_duplicate_pk")


def profile_nulls(df: DataFrame, table: str, only_positive: bool = True) -> DataFrame:
    """Long form: table, column, null_count, null_pct (1 decimal)."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    long = wide.unpivot("_n", cols, "column_name", "null_count")
    long = long.select(F.lit(table).alias("table_name"), "column_name",
                       F.coalesce("null_count", F.lit(0)).cast("long").alias("null_count"),
                       F.col("_n"))
    if only_positive:
        long = long.where(F.col("null_count") > 0)
    return long.select("table_name", "column_name", "null_count",
                       pct("null_count", "_n", 1).alias("null_pct"))


def duplicate_key_rows(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """One row: rows whose key occurs more than once (all copies) and total rows."""
    per_key = by_key(df.select(*pk), pk).groupBy(*pk).agg(F.count(F.lit(1)).alias("_c"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0)).cast("long")
        .alias("duplicated_rows"),
        F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("n_rows"))


def profile_duplicate_keys(df: DataFrame, table: str, pk: Sequence[str]) -> DataFrame:
    """table, pk, duplicated_rows, duplicated_pct — all copies of a duplicated key count."""
    d = duplicate_key_rows(df, pk)
    return d.select(F.lit(table).alias("table_name"), F.lit(",".join(pk)).alias("pk"),
                    "duplicated_rows", pct("duplicated_rows", "n_rows", 1)
                    .alias("duplicated_pct"))


def duplicate_key_sample(df: DataFrame, pk: Sequence[str], n: int = 4) -> DataFrame:
    """The first ``n`` rows (by key, then remaining columns) whose key is duplicated."""
    dup_keys = (by_key(df.select(*pk), pk).groupBy(*pk).agg(F.count(F.lit(1)).alias("_c"))
                .where(F.col("_c") > 1).drop("_c"))
    rest = [c for c in df.columns if c not in pk]
    rows = df.join(dup_keys, list(pk), "left_semi")
    order = [F.col(c).asc_nulls_last() for c in list(pk) + rest]
    return rows.orderBy(*order).limit(n).select(*pk)


def duplicate_key_counts(df: DataFrame, table: str, pk: Sequence[str], n: int = 4) -> DataFrame:
    """table, pk, key, copies: the first ``n`` duplicated keys of a table, NULL keys among them."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in pk]
    return (by_key(df.select(*pk), pk).groupBy(*pk).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1)
            .orderBy(*[F.col(c).asc_nulls_last() for c in pk]).limit(n)
            .select(F.lit(table).alias("table_name"), F.lit(",".join(pk)).alias("pk"),
                    F.concat_ws(",", *parts).alias("key"), "copies"))


def profile_numeric(df: DataFrame, table: str, digits: int = 2) -> DataFrame:
    """Long form: table, column, min, max, mean (rounded) of every numeric column."""
    cols = numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "table_name string, column_name string, min_value double, "
                "max_value double, mean_value double")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(F.struct(F.min(x).alias("mn"), F.max(x).alias("mx"),
                             F.avg(x).alias("mean")).alias(c))
    long = df.agg(*aggs).unpivot([], cols, "column_name", "s")
    return long.select(F.lit(table).alias("table_name"), "column_name",
                       round_half_up(F.col("s.mn"), digits).alias("min_value"),
                       round_half_up(F.col("s.mx"), digits).alias("max_value"),
                       round_half_up(F.col("s.mean"), digits).alias("mean_value"))


def profile_cardinality(df: DataFrame, table: str, approx: bool = False) -> DataFrame:
    """Long form: table, column, distinct non-NULL values (exact unless approx).

    Exact counts come from (column, value) pairs that each task makes distinct before
    the shuffle, so a frequent value is sent once per task and no row is expanded into
    one shuffled copy per column.
    """
    cols = df.columns
    if approx:
        wide = df.agg(*[F.approx_count_distinct(c).cast("long").alias(c) for c in cols])
        return wide.unpivot([], cols, "column_name", "n_distinct").select(
            F.lit(table).alias("table_name"), "column_name", "n_distinct")

    def text(f: T.StructField):
        # 0.0 and -0.0 are one value, as texts they would be two
        c = F.col(f.name) + F.lit(0.0) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) \
            else F.col(f.name)
        return c.cast("string")

    pairs = F.array(*[F.struct(F.lit(i).alias("i"), text(f).alias("v"))
                      for i, f in enumerate(df.schema.fields)])
    found = (df.select(F.explode(pairs).alias("p")).select("p.i", "p.v").where("v is not null")
             .groupBy("i", "v").agg(F.lit(1).alias("one")).groupBy("i")
             .agg(F.count("one").alias("n_distinct")))
    # a column of NULLs only still has its row
    every = df.sparkSession.range(len(cols)).select(F.col("id").cast("int").alias("i"),
                                                    F.lit(0).cast("long").alias("n_distinct"))
    names = F.array(*[F.lit(c) for c in cols])
    return (found.unionByName(every).groupBy("i").agg(F.max("n_distinct").alias("n_distinct"))
            .select(F.lit(table).alias("table_name"), F.get(names, F.col("i")).alias("column_name"),
                    "n_distinct"))


def profile_columns(df: DataFrame, table: str) -> DataFrame:
    """Column names and types of a table (metadata only, no scan)."""
    rows = [(table, i + 1, f.name, f.dataType.simpleString())
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "table_name string, ordinal int, column_name string, data_type string")


def schema_check(df: DataFrame, table: str, expected: Mapping[str, str]) -> DataFrame:
    """Compare declared types with actual ones: column, expected, actual, ok."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(table, c, e, actual.get(c), actual.get(c) == e) for c, e in expected.items()]
    return df.sparkSession.createDataFrame(
        rows, "table_name string, column_name string, expected string, actual string, "
              "ok boolean")


# --- dbt-style tests -------------------------------------------------------

def _result(df_count: DataFrame, model: str, column: str, test: str) -> DataFrame:
    return df_count.select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                           F.lit(test).alias("test"),
                           F.col("failures").cast("long").alias("failures"))


def check_not_null(df: DataFrame, model: str, column: str) -> DataFrame:
    c = df.agg(F.count(F.when(F.col(column).isNull(), F.lit(1))).alias("failures"))
    return _result(c, model, column, "not_null")


def check_not_null_many(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """not_null for several columns of one model in a single scan."""
    cols = list(columns)
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column_name", "failures")
    return long.select(F.lit(model).alias("model"), "column_name",
                       F.lit("not_null").alias("test"),
                       F.col("failures").cast("long").alias("failures"))


def check_unique(df: DataFrame, model: str, column: str | Sequence[str]) -> DataFrame:
    cols = [column] if isinstance(column, str) else list(column)
    present = F.col(cols[0]).isNotNull()
    for c in cols[1:]:
        present = present & F.col(c).isNotNull()
    keyed = df.where(present)
    c = (keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1)
         .agg(F.count(F.lit(1)).alias("failures")))
    return _result(c, model, ",".join(cols), "unique")


def check_not_null_and_unique(df: DataFrame, model: str, required: Sequence[str],
                              key: Sequence[str]) -> DataFrame:
    """NOT NULL for ``required`` and uniqueness of ``key`` in one pass.

    The key aggregation (which the uniqueness test needs anyway) carries the
    per-group NULL counts as partial sums, so the table is scanned once.
    Rows are identical to ``check_not_null_many`` + ``check_unique``.
    """
    key = list(key)
    others = [c for c in required if c not in key]
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_c"),
        *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in others])
    present = F.col(key[0]).isNotNull()
    for c in key[1:]:
        present = present & F.col(c).isNotNull()
    null_counts = {c: F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("_c"))), F.lit(0))
                   for c in required if c in key}
    null_counts.update({c: F.coalesce(F.sum(c), F.lit(0)) for c in others})
    wide = per_key.agg(
        F.count(F.when(present & (F.col("_c") > 1), F.lit(1))).alias("_dup"),
        *[null_counts[c].alias(c) for c in required])
    nn = wide.unpivot([], list(required), "column_name", "failures").select(
        F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"),
        F.col("failures").cast("long").alias("failures"))
    un = wide.select(F.lit(model).alias("model"), F.lit(",".join(key)).alias("column_name"),
                     F.lit("unique").alias("test"), F.col("_dup").cast("long").alias("failures"))
    return nn.unionByName(un)


def check_accepted_values(df: DataFrame, model: str, column: str,
                          values: Sequence[str]) -> DataFrame:
    c = (df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
         .agg(F.count_distinct(F.col(column)).alias("failures")))
    return _result(c, model, column, "accepted_values")


def check_model(df: DataFrame, model: str, not_null: Sequence[str] = (),
                key: Sequence[str] = (), accepted: Mapping[str, Sequence[str]] | None = None
                ) -> DataFrame:
    """All declared tests of a model in one pass over it.

    ``accepted`` maps at most one column to its values.  With a ``key`` the key
    aggregation carries NULL counts; rows without a whole key are spread by a salt, as they
    may be many and are never duplicates.  Unaccepted values are then counted by a scan of
    their column alone, in which a task sends each of them once: as sets beside the keys they
    would make the key aggregation sort its rows.
    Rows are those of ``check_not_null_many``, ``check_unique`` and
    ``check_accepted_values``.
    """
    if len(accepted or {}) > 1:
        raise ValueError("one column with accepted values for each pass")
    column, values = next(iter((accepted or {}).items()), (None, ()))
    bad = F.when(F.col(column).isNotNull() & ~F.col(column).isin(list(values)), F.col(column)) \
        if column else F.lit(None).cast("string")
    nulls = {c: F.sum(F.col(c).isNull().cast("long")) for c in not_null}
    key = list(key)
    if key:
        whole = F.lit(True)
        for c in key:
            whole = whole & F.col(c).isNotNull()
        salt = F.when(~whole, F.pmod(F.xxhash64(bad, *key), F.lit(1024)))
        names = [*(f"_k{i}" for i in range(len(key))), "_salt"]
        per_key = by_key(df.select(
            *[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], salt.alias("_salt"),
            *[F.col(c).isNull().cast("long").alias(f"_n{i}") for i, c in enumerate(nulls)]),
            names).groupBy(*names).agg(
            F.count(F.lit(1)).alias("_c"), *[F.sum(f"_n{i}").alias(f"_n{i}") for i in range(len(nulls))])
        wide = per_key.agg(
            F.count(F.when(F.col("_salt").isNull() & (F.col("_c") > 1), 1)).alias("_dup"),
            *[F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"_n{i}") for i in range(len(nulls))])
        if column:
            wide = wide.crossJoin(df.select(bad.alias("_bad")).agg(F.count_distinct("_bad").alias("_values")))
    else:
        wide = df.agg(F.lit(0).cast("long").alias("_dup"), F.count_distinct(bad).alias("_values"),
                      *[F.coalesce(n, F.lit(0)).alias(f"_n{i}")
                        for i, n in enumerate(nulls.values())])
    tests = [(c, "not_null", F.col(f"_n{i}")) for i, c in enumerate(nulls)]
    tests += [(",".join(key), "unique", F.col("_dup"))] if key else []
    tests += [(column, "accepted_values", F.col("_values"))] if column else []
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("test"),
                              n.cast("long").alias("failures")) for c, t, n in tests])
    return wide.select(F.explode(rows).alias("r")).select(
        F.lit(model).alias("model"), "r.column_name", "r.test", "r.failures")


def accepted_values_profile(df: DataFrame, model: str, column: str,
                            values: Sequence[str]) -> DataFrame:
    """Every observed value with its row count and whether it is accepted."""
    return (df.groupBy(F.col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                    "value", "n_rows",
                    (F.col("value").isNull() | F.col("value").isin(list(values)))
                    .alias("accepted")))


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    """Stack check results and add a pass/fail status."""
    out = _union_all(list(checks))
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def fk_orphans(fact: DataFrame, checks: Sequence[tuple[str, str, DataFrame, str]]
               ) -> DataFrame:
    """Orphan counts: (fk column, dimension name, dimension frame, dimension key).

    The fact is read once: its (foreign key, value) pairs are counted in each task, meet
    the dimension keys in one shuffle, and values that no dimension has are summed.  A
    NULL foreign key is an orphan.  A frequent value is one row per task.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(fk).cast("string").alias("key"))
                      for i, (fk, *_) in enumerate(checks)])
    known = F.lit(0).alias("known")
    all_rows = fact.select(F.explode(pairs).alias("p")).select("p.i", "p.key").groupBy(
        "i", "key").agg(F.count(F.lit(1)).alias("n")).select("i", "key", "n", known)
    for i, (_, _, dim, pk) in enumerate(checks):
        all_rows = all_rows.unionByName(dim.select(
            F.lit(i).alias("i"), F.col(pk).cast("string").alias("key"),
            F.lit(0).cast("long").alias("n"), F.lit(1).alias("known")).where("key is not null"))
    every = fact.sparkSession.range(len(checks)).select(
        F.col("id").cast("int").alias("i"), F.lit(None).cast("string").alias("key"),
        F.lit(0).cast("long").alias("n"), known)
    per_key = all_rows.unionByName(every).groupBy("i", "key").agg(
        F.sum("n").alias("n"), F.max("known").alias("known"))
    names = [F.array(*[F.lit(c[j]) for c in checks]) for j in (0, 1)]
    return (per_key.groupBy("i")
            .agg(F.sum(F.when(F.col("known") == 0, F.col("n")).otherwise(0)).alias("orphans"))
            .select(F.get(names[0], F.col("i")).alias("fk_column"),
                    F.get(names[1], F.col("i")).alias("dim_table"), F.col("orphans").cast("long")))


def table_counts(tables: Mapping[str, tuple[str, str, DataFrame]]) -> DataFrame:
    """Row count per table: (table_name, layer, kind, n_rows)."""
    rows = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), F.lit(layer).alias("layer"),
        F.lit(kind).alias("kind"), F.col("n_rows"))
        for name, (layer, kind, df) in tables.items()]
    return _union_all(rows)
