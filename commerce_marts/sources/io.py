"""Readers and writers.

* ``read_source`` — typed CSV scan (header, quoted multi-line fields).  Raw CSV
  with multi-line quotes cannot be split, so a large landing should be read
  once and written to parquet (``land_as_parquet``); every later stage reads
  columnar files with pushdown and pruning.
* ``write_table`` — idempotent overwrite of a table (create-or-replace).
* ``conform`` — select + cast to a declared table schema (insert into DDL).
* ``export_marts`` — parquet export of several result tables; ``export_checked``
  also reads every one back and compares rows and content.
* ``manifest_check`` — expected files present, with sizes.
"""

from __future__ import annotations

import csv
import re
import warnings
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_marts.sources.schemas import RAW_SCHEMAS, SOURCES

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "FAILFAST"}
#: Sources whose cells hold line breaks; only these can't be split into several tasks.
MULTI_LINE = ("order_reviews",)


#: Column that keeps a record which doesn't fit its schema.
CORRUPT = "_corrupt_record"


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files at ``path`` by the column names of their first line (the lines alone are read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    found: dict[tuple[str, ...], list[str]] = {}
    listing = fs.listFiles(root, True)
    while listing.hasNext():
        file = listing.next().getPath()
        below = file.toString()[len(fs.makeQualified(root).toString()):]
        if any(part.startswith(("_", ".")) for part in below.split("/")):
            continue
        stream, codec = fs.open(file), codecs.getCodec(file)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
            codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            line = reader.readLine()
        finally:
            reader.close()
        if line:
            names = next(csv.reader([line.removeprefix("\ufeff")], doublequote=True))
            found.setdefault(tuple(names), []).append(file.toString())
    return found


def read_source(spark: SparkSession, name: str, path: str,
                schema: T.StructType | None = None, quarantine: bool = False) -> DataFrame:
    """Typed CSV scan of one raw source (never infers the schema).

    Columns go by the names in each file's own header, in any order, so part files of a
    folder may differ; a missing column is an error.  A cell that doesn't fit its type is
    an error too, or with ``quarantine`` its record is kept as text in ``_corrupt_record``
    (and ``_file`` names its file), whatever columns are read.
    """
    schema = schema or RAW_SCHEMAS[name]
    options = {**CSV_OPTIONS, "multiLine": str(name in MULTI_LINE).lower()}
    extra = []
    if quarantine:
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
                    "columnPruning": "false"}
        extra = [T.StructField(CORRUPT, T.StringType())]
    out = None
    for header, files in sorted(_headers(spark, path).items()):
        missing = [c for c in schema.names if c not in header]
        if missing:
            raise ValueError(f"{', '.join(files[:3])} has no column {', '.join(missing)}")
        in_file = T.StructType([schema[c] if c in schema.names else T.StructField(c, T.StringType())
                                for c in header] + extra)
        part = spark.read.schema(in_file).options(**options).csv(files)
        if quarantine:
            # a cell is only checked if its column is read: the (empty) text refers to all of them
            all_read = F.substring(F.xxhash64(*header).cast("string"), 1, 0)
            part = part.withColumn("_file", F.col("_metadata.file_path")).withColumn(
                CORRUPT, F.concat(CORRUPT, all_read)).select(*schema.names, CORRUPT, "_file")
        else:
            part = part.select(*schema.names)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], T.StructType([
            *schema.fields, *extra, *([T.StructField("_file", T.StringType())] if quarantine else [])]))
    return out


def write_csv(df: DataFrame, path: str) -> str:
    """Write a raw frame as header CSV with quoting compatible with read_source."""
    (df.write.mode("overwrite").option("header", "true").option("quote", '"')
     .option("escape", '"').option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))
    return path


def land_as_parquet(spark: SparkSession, csv_dir: str, out_dir: str,
                    names: Iterable[str] | None = None) -> dict[str, str]:
    """Read each present raw CSV once and land it as parquet; missing files are skipped."""
    out = {}
    present = set(manifest_check(spark, csv_dir).where("present").select("file_name")
                  .toPandas()["file_name"])
    for name in names or SOURCES:
        spec = SOURCES[name]
        if spec.file_name not in present:
            warnings.warn(f"{spec.file_name} not found in {csv_dir}; skipping {name}",
                          stacklevel=2)
            continue
        target = f"{out_dir.rstrip('/')}/{name}"
        write_table(read_source(spark, name, f"{csv_dir.rstrip('/')}/{spec.file_name}"), target)
        out[name] = target
    return out


def land_with_quarantine(spark: SparkSession, csv_dir: str, out_dir: str, quarantine_dir: str,
                         names: Iterable[str] | None = None) -> DataFrame:
    """``land_as_parquet`` that keeps going: bad records are written, with their file and text,
    under ``quarantine_dir/<name>``.  Returns source, loaded, quarantined of the present files.

    The CSV is parsed once for each source; rows and bad records are split from what was written.
    """
    present = set(manifest_check(spark, csv_dir).where("present").select("file_name")
                  .toPandas()["file_name"])
    rows = []
    for name in names or SOURCES:
        file_name = SOURCES[name].file_name
        if file_name not in present:
            continue
        kept = f"{quarantine_dir.rstrip('/')}/{name}"
        seen = Observation(f"land-{name}")
        df = read_source(spark, name, f"{csv_dir.rstrip('/')}/{file_name}", quarantine=True)
        bad = F.col(CORRUPT).isNotNull()
        parsed = write_table(df.observe(seen, F.count(F.when(~bad, 1)).alias("loaded"),
                                        F.count(F.when(bad, 1)).alias("quarantined")),
                             f"{kept}/_parsed")
        both = spark.read.parquet(parsed)
        write_table(both.where(~bad).drop(CORRUPT, "_file"), f"{out_dir.rstrip('/')}/{name}")
        write_table(both.where(bad).select(F.col("_file").alias("file"), F.col(CORRUPT).alias("record")),
                    f"{kept}/records")
        rows.append((name, seen.get["loaded"], seen.get["quarantined"]))
    return spark.createDataFrame(rows, "source string, loaded long, quarantined long")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                fmt: str = "parquet") -> str:
    """Create-or-replace a table at ``path``."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto a declared schema: DDL column order and types."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for conform: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def export_marts(marts: Mapping[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Write each mart as parquet under ``out_dir/<name>``; returns the paths."""
    return {name: write_table(df, f"{out_dir.rstrip('/')}/{name}")
            for name, df in marts.items()}


def _content(columns: Sequence[str]) -> list[Column]:
    """Row count and an order-free checksum of all columns; decimals can't overflow here."""
    row_hash = F.xxhash64(*[F.col(c) for c in columns]).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("n_rows"), F.sum(row_hash).alias("checksum")]


def export_checked(marts: Mapping[str, DataFrame], out_dir: str) -> dict[str, DataFrame]:
    """``export_marts``, then every written mart read back.

    Count and checksum are observed on the rows as they are written, so nothing
    is computed twice; a mart that reads back otherwise is an error.
    """
    seen = {name: Observation(f"export-{name}") for name in marts}
    paths = export_marts({name: df.observe(seen[name], *_content(df.columns))
                          for name, df in marts.items()}, out_dir)
    back = {}
    for name, df in marts.items():
        back[name] = df.sparkSession.read.parquet(paths[name])
        got = back[name].agg(*_content(df.columns)).first().asDict()
        if back[name].columns != df.columns or got != seen[name].get:
            raise ValueError(f"export of {name} reads back as {got}, written was {seen[name].get}")
    return back


def manifest_check(spark: SparkSession, directory: str,
                   expected: Sequence[str] | None = None) -> DataFrame:
    """One row per expected file, or folder of part files: present flag and size in bytes.

    The directory listing comes from the ``binaryFile`` source with only path
    and length selected, so file contents are never read.
    """
    expected = list(expected or [s.file_name for s in SOURCES.values()])
    wanted = spark.createDataFrame([(e,) for e in expected], "file_name string")
    root = re.sub("^file:/+", "/", directory.rstrip("/"))
    name = F.element_at(F.split("path", "/"), len(root.split("/")) + 1)
    try:
        listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                   .load(directory).select(name.alias("file_name"), "length")
                   .groupBy("file_name").agg(F.sum("length").alias("size_bytes")))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        listing = spark.createDataFrame([], "file_name string, size_bytes long")
    return (wanted.join(listing, "file_name", "left")
            .select("file_name", F.col("size_bytes").isNotNull().alias("present"),
                    F.col("size_bytes")))


class MissingSourceFiles(RuntimeError):
    pass


def require_manifest(spark: SparkSession, directory: str,
                     expected: Sequence[str] | None = None) -> DataFrame:
    """``manifest_check`` that fails when any expected file is missing.

    Only the small per-file result (one row per expected file) is collected.
    """
    m = manifest_check(spark, directory, expected)
    missing = [r.file_name for r in m.where(~F.col("present")).select("file_name").collect()]
    if missing:
        raise MissingSourceFiles(f"missing in {directory}: {', '.join(missing)}")
    return m
