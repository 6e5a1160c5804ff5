"""Tables that become visible only after their checks.

A ``TableStore`` is a folder with one pointer file, ``_current.json``, that names the
files of every published table.  A ``StoreRun`` writes each table beside the published
one, under a folder of its own; row count, checksum and NULL counts are observed while
the rows are written, primary keys are checked on the written key columns.  ``publish``
replaces the pointer in one rename, for all tables of the run together: readers see the
tables of the last good run or those of this one, never a mixture.  A run that violates
a constraint, or fails, publishes nothing and removes what it wrote.

Partitioned tables are published by partition, so a run that rewrites one month names
new files for that month alone.  Tables that several joins read can be laid out in
buckets for the length of the run; the catalog entry this needs goes when the run ends.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_marts.sources.io import _content, conform

POINTER = "_current.json"
#: Layer of tables that only other tables are built from.
INTERMEDIATE = "intermediate"


class ConstraintViolation(RuntimeError):
    pass


class _Files:
    """The few file operations that the pointer needs, on any file system Spark reads."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark.sparkContext._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        path = self.jvm.org.apache.hadoop.fs.Path(path)
        return path, path.getFileSystem(self.conf)

    def read(self, path: str) -> str | None:
        path, fs = self._at(path)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, path: str, text: str) -> None:
        """Writes beside ``path`` and renames over it."""
        target, fs = self._at(path)
        beside, _ = self._at(f"{path}.{uuid.uuid4().hex[:8]}")
        stream = fs.create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        overwrite = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        how = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        how[0] = overwrite
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf)
        context.rename(beside, target, how)

    def remove(self, path: str) -> None:
        path, fs = self._at(path)
        fs.delete(path, True)

    def children(self, path: str) -> list[str]:
        path, fs = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = _Files(spark)

    def published(self) -> dict[str, dict]:
        """name → entry of every published table."""
        text = self.files.read(f"{self.root}/{POINTER}")
        return json.loads(text) if text else {}

    def read(self, name: str) -> DataFrame:
        return self._frame(self.published()[name])

    def tables(self) -> dict[str, DataFrame]:
        """Every published table, all as of one reading of the pointer."""
        return {name: self._frame(entry) for name, entry in self.published().items()}

    def drop(self) -> None:
        """Removes the store with all its tables."""
        self.files.remove(self.root)

    def _frame(self, entry: Mapping) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        base = f"{self.root}/{entry['layer']}/{entry['name']}"
        if entry["partition"] is None:
            return self.spark.read.schema(schema).parquet(f"{base}/{entry['run']}")
        at = entry["partition"]
        if not entry["parts"]:
            return self.spark.createDataFrame([], schema)
        paths = [f"{base}/{run}/{at}={value}" for value, run in sorted(entry["parts"].items())]
        return (self.spark.read.option("basePath", base)
                .schema(T.StructType([*schema.fields, T.StructField("run", T.StringType())]))
                .parquet(*paths).select(*schema.names))

    def verify(self) -> None:
        """Reads every published table back: its rows and checksum must be those written."""
        for name, entry in self.published().items():
            df = self._frame(entry)
            got = df.agg(*_content(df.columns)).first()
            if (got["n_rows"], str(got["checksum"])) != (entry["rows"], entry["checksum"]):
                raise ValueError(f"{name} reads back as {got}, written was {entry['rows']} rows, "
                                 f"checksum {entry['checksum']}")

    def catalog(self, total: str | None = "TOTAL") -> DataFrame:
        """table_name, layer, kind, n_rows of the published tables, and their total; nothing is
        counted again.  Intermediate tables are left out."""
        return _listing(self.spark, self.published(), total)

    def run(self) -> StoreRun:
        return StoreRun(self)

    def vacuum(self) -> None:
        """Removes the folders of runs, and of partitions, that the pointer no longer names."""
        entries = self.published()
        for layer in self.files.children(self.root):
            if layer.startswith("_"):
                continue
            for name in self.files.children(f"{self.root}/{layer}"):
                entry = entries.get(name)
                if entry is not None and entry["layer"] != layer:
                    entry = None
                base = f"{self.root}/{layer}/{name}"
                for run in self.files.children(base):
                    if entry is None or run not in {entry["run"], *(entry["parts"] or {}).values()}:
                        self.files.remove(f"{base}/{run}")
                    elif entry["parts"] is not None:
                        for part in self.files.children(f"{base}/{run}"):
                            at, _, value = part.partition("=")
                            if at == entry["partition"] and entry["parts"].get(value) != run:
                                self.files.remove(f"{base}/{run}/{part}")


def _listing(spark: SparkSession, entries: Mapping[str, Mapping], total: str | None) -> DataFrame:
    rows = [(e["name"], e["layer"], e["kind"], e["rows"]) for e in entries.values()
            if e["layer"] != INTERMEDIATE]
    if total:
        rows.append((total, None, None, sum(r[3] for r in rows)))
    return spark.createDataFrame(rows, "table_name string, layer string, kind string, n_rows long")


class StoreRun:
    """Use as a context manager: leaving it after an error removes what was written."""

    def __init__(self, store: TableStore):
        self.store, self.spark = store, store.spark
        self.id = f"run={uuid.uuid4().hex[:12]}"
        self.entries: dict[str, dict] = {}
        self.violations: list[str] = []
        self._bucketed: dict[str, str] = {}
        self._folders: list[str] = []
        self._published = False

    def __enter__(self) -> StoreRun:
        return self

    def __exit__(self, kind, error, trace) -> None:
        self.close()

    def write(self, name: str, layer: str, df: DataFrame, kind: str = "table",
              schema: T.StructType | None = None, key: Sequence[str] = (),
              partition: str | None = None, replace: Sequence | None = None,
              buckets: tuple[int, str] | None = None) -> DataFrame:
        """Writes a table and returns it as written.

        ``schema``: declared columns, types and NOT NULLs (the partition column may follow).
        ``key``: primary key.  ``partition``: column whose values are published one by one;
        with ``replace`` only these values are, the others stay as published.  ``buckets``:
        number and column of a bucketed and sorted layout.
        """
        declared = schema or df.schema
        if schema is not None:
            if partition and partition not in schema.names:
                declared = T.StructType([*schema.fields, df.schema[partition]])
            df = conform(df, declared)
        if replace is not None:
            df = df.where(F.col(partition).isin(list(replace)))
        required = [f.name for f in declared.fields if not f.nullable] if schema is not None else []
        seen = Observation(f"write-{name}")
        nulls = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{i}") for i, c in enumerate(required)]
        path = f"{self.store.root}/{layer}/{name}/{self.id}"
        self._folders.append(path)
        out = df.observe(seen, *_content(df.columns), *nulls)
        if buckets:
            n, by = buckets
            table = f"cm_{self.id[4:]}_{name}"
            self._bucketed[name] = table
            # Spark leaves the exchange out where ``df`` already comes in these partitions
            out.repartition(n, by).write.option("compression", "zstd").bucketBy(n, by).sortBy(by).option("path", path).saveAsTable(table)
        elif partition:
            # one or a few files a value: AQE splits a value that holds much and joins small ones
            (out.hint("rebalance", F.col(partition)).write.option("compression", "zstd")
             .partitionBy(partition).parquet(path))
        else:
            out.write.option("compression", "zstd").parquet(path)
        got = seen.get
        entry = {"name": name, "layer": layer, "kind": kind, "run": self.id, "rows": got["n_rows"],
                 "checksum": str(got["checksum"]), "partition": partition, "parts": None,
                 "schema": json.loads(df.schema.json())}
        if partition:
            entry["parts"] = {c.split("=", 1)[1]: self.id for c in self.store.files.children(path)
                              if c.startswith(f"{partition}=")}
        self.violations += [f"{name}.{c} not_null: {got[f'null_{i}']}"
                            for i, c in enumerate(required) if got[f"null_{i}"]]
        if replace is not None:
            entry = self._merged(name, entry, replace)
        self.entries[name] = entry
        if key:
            self._check_key(name, self.read(name), list(key))
        return self.read(name)

    def _merged(self, name: str, entry: dict, replaced: Sequence) -> dict:
        """The published table with some partitions replaced."""
        before = self.store.published().get(name)
        if before is None:
            return entry
        if before["partition"] != entry["partition"] or before["schema"] != entry["schema"]:
            raise ValueError(f"{name} was published with another layout; write it whole")
        values = {str(v) for v in replaced}
        parts = {v: run for v, run in before["parts"].items() if v not in values} | entry["parts"]
        merged = {**entry, "parts": parts}
        got = self.store._frame(merged).agg(*_content(
            T.StructType.fromJson(entry["schema"]).names)).first()
        return {**merged, "rows": got["n_rows"], "checksum": str(got["checksum"] or 0)}

    def _check_key(self, name: str, df: DataFrame, key: list[str]) -> None:
        present = F.lit(True)
        for c in key:
            present = present & F.col(c).isNotNull()
        twice = (df.where(present).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
                 .where("n > 1").agg(F.count(F.lit(1)).alias("n")).first()["n"])
        if twice:
            self.violations.append(f"{name}.{','.join(key)} unique: {twice}")

    def check(self) -> None:
        if self.violations:
            raise ConstraintViolation("; ".join(self.violations))

    def read(self, name: str) -> DataFrame:
        """A table as this run has written it."""
        if name in self._bucketed:
            return self.spark.table(self._bucketed[name])
        return self.store._frame(self.entries[name])

    def catalog(self, total: str | None = "TOTAL") -> DataFrame:
        """``TableStore.catalog`` of what this run has written."""
        return _listing(self.spark, self.entries, total)

    def publish(self) -> None:
        """Makes all tables of the run visible at once, if none violates its constraints."""
        self.check()
        entries = {**self.store.published(), **self.entries}
        self.store.files.replace(f"{self.store.root}/{POINTER}", json.dumps(entries))
        self._published = True

    def close(self) -> None:
        """Drops the catalog entries; removes the files unless they are published."""
        for table in self._bucketed.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        if not self._published:
            for folder in self._folders:
                self.store.files.remove(folder)
