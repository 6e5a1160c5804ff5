"""Removal of passages of ``length`` words or more that an earlier document holds.

A reference shard is what may match at all: minimisers of every ``length``-word
window (the smallest hash of its ``GRAM``-word runs) that occur in two different
texts.  Only windows with such a minimiser are exchanged, as hashes, and each gets
the smallest doc_id that has it; windows whose smallest doc_id is another's mark
their words, so overlapping windows join to maximal spans.  Windows are judged on
the input.  Equal texts are one class whose first document alone is searched: the
others are covered by it.  (README: why this replaces broadcast suffix automata.)

A window is known by its own 64-bit hash and that of its minimiser.

Nulls: a null or empty text has no words; a null doc_id comes after every other and
two null ids are not smaller than each other.  Repeated rows (equal doc_id) don't
remove each other's words; rows with equal doc_id and different texts neither.
Texts are read whole.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_marts.llm.common import (doc_key, list_array, partitions, rolling, scratch, signed,
                                       sliding_min, text_slices, word_hashes, words, written)

LENGTH = 50
GRAM = 8


def windows(h: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and minimiser of every window of ``length`` word hashes."""
    return rolling(h, length), sliding_min(rolling(h, gram), length - gram + 1)


def _documents(part: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    flat, counts = words(part.column("text"))
    h, ends = word_hashes(flat), np.cumsum(counts)
    for k, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
        yield k, flat.slice(a, b - a), h[a:b]


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, _key, _c) of every row, and the written texts: _c, first, text, one row of a
    class, laid out by _c so that later joins on it don't move texts."""
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_key().alias("_key"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
                        ).withColumn("_c", F.md5("text"))
    rows = written(keyed.drop("text"), "rows")
    first = rows.groupBy("_c").agg(F.min("_key").alias("first"))
    texts = keyed.join(first, "_c").where("_key = first").select("_c", "first", "text")
    name = f"llm_texts_{uuid.uuid4().hex[:12]}"
    n = partitions(spark)
    texts.repartition(n, "_c").dropDuplicates(["_c"]).write.bucketBy(n, "_c").sortBy("_c").option(
        "path", scratch(spark, "texts")).saveAsTable(name)
    return rows, spark.table(name)


def repeated_minimisers(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """_c, keys: the minimisers of a text that another text has too."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                own = [np.unique(windows(h, length, gram)[1]) for _, _, h in _documents(part)]
                n = [len(x) for x in own]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_c").take(pa.array(np.repeat(np.arange(len(n)), n))),
                     pa.array(signed(np.concatenate([np.zeros(0, np.uint64), *own])))],
                    names=["_c", "key"])

    found = written(texts.select("_c", "text").mapInArrow(find, "_c string, key long"), "minimisers")
    often = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return found.join(often, "key").groupBy("_c").agg(F.collect_list("key").alias("keys"))


def shared_windows(texts: DataFrame, keys: DataFrame, length: int, gram: int) -> DataFrame:
    """_c, found: hashes of the windows that also start in a document with a smaller id."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                out = []
                for k, _, h in _documents(part):
                    w, m = windows(h, length, gram)
                    some = np.isin(m, part.column("keys")[k].values.to_numpy().view(np.uint64))
                    pair = np.unique(np.stack([w[some], m[some]]), axis=1)
                    out.append((k, pair))
                n = [p.shape[1] for _, p in out]
                row = pa.array(np.repeat([k for k, _ in out], n).astype(np.int64))
                both = np.concatenate([np.zeros((2, 0), np.uint64), *(p for _, p in out)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_c").take(row), part.column("first").take(row),
                     pa.array(signed(both[0])), pa.array(signed(both[1]))],
                    names=["_c", "first", "w", "m"])

    occurring = written(texts.join(keys, "_c").select("_c", "first", "text", "keys").mapInArrow(
        emit, "_c string, first long, w long, m long"), "windows")
    earliest = occurring.groupBy("w", "m").agg(F.min("first").alias("lowest"), F.max("first").alias(
        "highest")).where("lowest < highest").select("w", "m", "lowest")
    return (occurring.join(earliest, ["w", "m"]).where("first > lowest")
            .groupBy("_c").agg(F.collect_list("w").alias("found")))


def kept(texts: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """_c, n_words, n_removed, kept (words that stay, joined by a space), kept_sha256."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                n, gone, left = [], [], []
                for k, flat, h in _documents(part):
                    marks = np.zeros(len(h) + 1, np.int64)
                    own = part.column("found")[k]
                    if own.is_valid:
                        at = np.flatnonzero(np.isin(rolling(h, length),
                                                    own.values.to_numpy().view(np.uint64)))
                        np.add.at(marks, at, 1)
                        np.add.at(marks, at + length, -1)
                    stays = np.cumsum(marks)[:-1] == 0
                    n.append(len(h))
                    gone.append(int(len(h) - stays.sum()))
                    left.append(" ".join(flat.filter(pa.array(stays)).to_pylist()))
                sha = [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in left]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_c"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(left, pa.string()), pa.array(sha, pa.string())],
                    names=["_c", "n_words", "n_removed", "kept", "kept_sha256"])

    return texts.join(found, "_c", "left").select("_c", "text", "found").mapInArrow(
        cut, "_c string, n_words long, n_removed long, kept string, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept, kept_sha256 of every row."""
    rows, texts = classes(docs)
    found = shared_windows(texts, repeated_minimisers(texts, length, gram), length, gram)
    own = kept(texts, found, length).join(texts.select("_c", "first"), "_c")
    copy = (F.col("_key") > F.col("first")) & (F.col("n_words") >= length)
    return rows.join(own, "_c").select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"))
