"""Shared helpers of the training-data operators.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]``.  Python tasks work on Arrow
slices of bounded size (``text_slices``), so the temporary arrays of a task do
not grow with the partition; a single document is never cut.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python task turns into arrays at a time.
SLICE_BYTES = 8 << 20
#: Stands for a null doc_id inside an operator: after every other id.
NO_ID = (1 << 63) - 1
#: With this setting Spark deletes the shuffle files of a write once the write has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Odd multipliers of the rolling and mixing hashes (any odd 64-bit numbers do).
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    Where the setting is missing, a temporary folder is made in local mode only:
    on a cluster the executors would not share it, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-scratch-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder of intermediate rows that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, name: str, by: str | None = None, layout: str | None = None,
            path: str | None = None) -> DataFrame:
    """``df`` as a table written under the shared folder: cuts the lineage and
    fixes the rows, so later reads neither recompute nor see other rows.  The shuffle
    files behind it go when the table is there, as nothing reads them again.  ``by``
    names a column whose buckets lay the table out, so that joins on it need no exchange;
    ``layout`` one whose values are folders, so that a filter on it reads only these."""
    spark = df.sparkSession
    path = path or scratch(spark, name)
    out = df.write.option("compression", "zstd")
    if layout:
        out = out.partitionBy(layout)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        if by:
            bucketed = f"llm_{path.rsplit('/', 1)[1].replace('-', '_')}"
            out.bucketBy(partitions(spark), by).option("path", path).saveAsTable(bucketed)
            return spark.table(bucketed)
        out.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, so that
    tasks find it where it is not installed (as ``--py-files`` would)."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        name = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent,
                                   package.name)
        spark.sparkContext.addPyFile(name)
        _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shielded(docs: DataFrame, used: Sequence[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on ``docs`` with all columns but ``used`` under names that no operator has, then
    the columns of ``docs`` again: helper columns can't clash with the user's."""
    names = [c if c in used else f"__user_{i}" for i, c in enumerate(docs.columns)]
    done = work(docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names))))
    return done.select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names)))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def doc_key(doc_id="doc_id"):
    """The id used inside operators: null ids come last."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))


def key_to_id(key="id"):
    return F.when(F.col(key) != NO_ID, F.col(key))


def range_bounds(df: DataFrame, column: str, n: int) -> np.ndarray:
    """At most n - 1 values that cut a long column into ranges of about equal size;
    ``np.searchsorted(bounds, x, "right")`` is the range of x."""
    cuts = df.approxQuantile(column, [i / n for i in range(1, n)], 0.25 / n) if n > 1 else []
    return np.unique(np.array([min(int(x), NO_ID) for x in cuts], np.int64))


def text_slices(batch: pa.RecordBatch, column: str = "text",
                max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about ``max_bytes`` of text each."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(size.astype(np.int64)) - size) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and how many each text has (null: 0)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    offsets = offsets - offsets[0]
    kept = pc.greater(pc.binary_length(flat), 0)
    counts = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])
    return flat.filter(kept), np.diff(counts[offsets])


def encoded(flat: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words and the index of each word among them."""
    d = flat.dictionary_encode()
    return d.dictionary, d.indices.to_numpy().astype(np.int64)


def word_hashes(flat: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word; each distinct word is hashed once."""
    distinct, ids = encoded(flat)
    h = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((h(w, seed) for w in distinct.cast(pa.binary()).to_pylist()), np.uint64,
                         len(distinct))
    return hashes[ids] if len(hashes) else np.zeros(0, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


def inverse(x: int) -> int:
    return pow(int(x), -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^1 .. base^n mod 2^64; kept up to a slice's length."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = np.cumprod(np.full(n, np.uint64(base), np.uint64))
        if n <= 1 << 23:
            _POWERS[base] = have
    return have[:n]


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive entries of ``h`` (polynomial mod 2^64,
    then mixed); length ``len(h) - n + 1`` or 0."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64),
                                np.cumsum(h * powers(int(BASE), len(h)), dtype=np.uint64)])
        back = powers(inverse(int(BASE)), len(h) - n + 1)
        return mixed((total[n:] - total[:-n]) * back)


def sliding_min(h: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every ``n`` consecutive entries."""
    if len(h) < n:
        return h[:0]
    width, out = 1, h
    while 2 * width <= n:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    return np.minimum(out[:len(h) - n + 1], out[n - width:]) if n > width else out


def runs(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each c of ``counts``, concatenated."""
    counts = np.asarray(counts, np.int64)
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)
