"""Similarity join on word n-gram sets by MinHash banding.

Equal texts form one class first; only one row of a class goes on.  Band and row
counts follow from the target recall at the threshold.  Band hashes are
shuffled; buckets of one member go, and so do buckets whose members are those of
another bucket.  Rows that buckets connect are one group if they fit into a block
of ``BLOCK`` rows; else each bucket is a group, compared in pairs of blocks.  Rows
of a group are compared on their full n-gram sets, as products of incidence
matrices.  A pair counts in the first group that it shares, so no
pair is emitted or counted twice: a block gives each member's number of links and
a spanning forest of them, from which classes of linked documents follow.

Documents with fewer than ``n`` words have one n-gram, all their words.  A null or
empty text has none and is linked to nothing, not even to another empty text.  A
null doc_id counts as the last id and comes back as null.  Repeated rows are
separate documents with equal texts.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_marts.llm.common import (BASE, doc_key, key_to_id, list_array, mixed, partitions,
                                       rolling, shielded, signed, text_slices, word_hashes, words, written)

N = 5
THRESHOLD = 0.8
RECALL = 0.999
MAX_HASHES = 128
BLOCK = 256
#: n-grams whose columns of the incidence matrices are held at a time.
COLUMNS = 8192


def banding(threshold: float = THRESHOLD, recall: float = RECALL,
            most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most selective rows whose bands reach ``recall`` at the threshold."""
    for rows in range(most, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-min(threshold ** rows, 1 - 1e-12)))
        if bands * rows <= most:
            return bands, rows
    return most, 1


def gram_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text, concatenated, and how many."""
    flat, counts = words(texts)
    h = word_hashes(flat)
    ends = np.cumsum(counts)
    sets = []
    for a, b in zip((ends - counts).tolist(), ends.tolist()):
        if b - a >= n:
            sets.append(np.unique(rolling(h[a:b], n)))
        elif b > a:
            sets.append(mixed(rolling(h[a:b], b - a) + np.uint64(b - a)))
        else:
            sets.append(h[:0])
    return np.concatenate([h[:0], *sets]), np.fromiter(map(len, sets), np.int64, len(sets))


def band_hashes(grams: np.ndarray, counts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each set (rows) and band (columns); sets are not empty."""
    starts = np.cumsum(counts) - counts
    rng = np.random.default_rng(41)
    a = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) | np.uint64(1)
    b = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    out = np.zeros((len(counts), bands), np.uint64)
    with np.errstate(over="ignore"):
        for band in range(bands):
            key = np.full(len(counts), np.uint64(band + 1))
            for r in range(band * rows, (band + 1) * rows):
                low = np.minimum.reduceat((grams * a[r] + b[r]) >> np.uint64(20), starts)
                key = mixed(key * BASE + low)
            out[:, band] = key
    return out


def signatures(texts: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """_key, _c, bands of every row; bands is null for texts without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, max_bytes=1 << 20):
                grams, counts = gram_sets(part.column("text"), n)
                some = np.flatnonzero(counts)
                keys = np.zeros((len(counts), bands), np.uint64)
                if len(some):
                    keys[some] = band_hashes(grams, counts[some], bands, rows)
                lists = list_array(signed(keys.ravel()), np.full(len(counts), bands), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_key"), part.column("_c"),
                     lists.take(pa.array(np.arange(len(counts)), mask=counts == 0))],
                    names=["_key", "_c", "bands"])

    return texts.select("_key", "_c", "text").mapInArrow(
        sign, "_key long, _c string, bands array<long>")


def with_grams(texts: DataFrame, n: int) -> DataFrame:
    """row, n, kept, grams and one row for each place (group, i, j) of a candidate."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, max_bytes=1 << 20):
                grams, counts = gram_sets(part.column("text"), n)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("row", "n", "kept", "places")),
                     list_array(signed(grams), counts, pa.int64())],
                    names=["row", "n", "kept", "places", "grams"])

    return texts.select("row", "n", "kept", "places", "text").mapInArrow(
        cut, "row long, n long, kept array<long>, places array<struct<bucket:long,block:long,"
             "blocks:long>>, grams array<long>")


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the common parts of all sets of ``left`` with all of ``right``."""
    every = np.concatenate([*left, *right])
    distinct, at = np.unique(every, return_inverse=True)
    split = sum(map(len, left))
    out = np.zeros((len(left), len(right)), np.float64)
    row = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (left, right)]
    col = [at[:split], at[split:]]
    for a in range(0, len(distinct), COLUMNS):
        width = min(COLUMNS, len(distinct) - a)
        parts = []
        for s, r, c in zip((left, right), row, col):
            hit = (c >= a) & (c < a + width)
            m = np.zeros((len(s), width), np.float32)
            m[r[hit], c[hit] - a] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out


def _forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """An edge from each linked node to the smallest node of its component."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs.tolist():
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [(find(x), x) for x in range(n) if find(x) != x]


def _compare(group: list[dict], threshold: float) -> Iterator[tuple[int, int, int]]:
    """(row, other, links): links found for a row, or with ``other`` an edge of the forest."""
    group.sort(key=lambda r: r["row"])
    bucket, i, j = group[0]["bucket"], group[0]["i"], group[0]["j"]
    left = [r for r in group if r["block"] == i]
    right = left if i == j else [r for r in group if r["block"] == j]
    if not left or not right:
        return
    sets = [[np.array(r["grams"], np.int64) for r in s] for s in (left, right)]
    common = intersections(*sets)
    size = [np.array([len(x) for x in s]) for s in sets]
    linked = common >= threshold * (size[0][:, None] + size[1][None, :] - common) - 1e-9
    if i == j:
        linked &= ~np.eye(len(left), dtype=bool)
    # the first bucket that both are in counts the pair
    for a, b in np.argwhere(linked).tolist():
        first = min(set(left[a]["kept"]) & set(right[b]["kept"]))
        linked[a, b] = first == bucket
    copies = [np.array([r["n"] for r in s]) for s in (left, right)]
    found = [(r["row"], -1, int(x)) for r, x in zip(left, linked @ copies[1]) if x]
    if i != j:
        found += [(r["row"], -1, int(x)) for r, x in zip(right, linked.T @ copies[0]) if x]
    yield from found
    own = sorted({r["row"] for r in left} | {r["row"] for r in right})
    at = {x: k for k, x in enumerate(own)}
    pairs = np.array([[at[left[a]["row"]], at[right[b]["row"]]]
                      for a, b in np.argwhere(linked).tolist()], np.int64).reshape(-1, 2)
    for a, b in _forest(pairs, len(own)):
        yield own[a], own[b], 0


def compared(members: DataFrame, threshold: float) -> DataFrame:
    """Links and forest edges of every group (bucket, i, j); one group is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []

        def out(rows):
            columns = list(zip(*rows)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                              names=["row", "other", "links"])

        for batch in batches:
            found = []
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k] for n in batch.schema.names}
                row = {n: v.values.to_numpy() if n == "grams" else v.as_py() for n, v in row.items()}
                own = (row["bucket"], row["i"], row["j"])
                if own != key:
                    if len(group) > 1:
                        found += _compare(group, threshold)
                    key, group = own, []
                group.append(row)
            yield out(found)
        if len(group) > 1:
            yield out(_compare(group, threshold))

    return (members.repartition(partitions(members.sparkSession), "bucket", "i", "j")
            .sortWithinPartitions("bucket", "i", "j", "row")
            .mapInArrow(run, "row long, other long, links long"))


def components(edges: DataFrame) -> DataFrame:
    """row, root: the smallest row of the component of every row that has an edge."""
    both = written(edges.select(F.col("row").alias("a"), F.col("other").alias("b")).unionByName(
        edges.select(F.col("other").alias("a"), F.col("row").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("l")), "labels")
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), "l"), "b").groupBy("a").agg(
            F.min("l").alias("m"))
        met = labels.join(near, "a").select("a", "l", F.least("l", "m").alias("m"))
        jump = labels.select(F.col("a").alias("m"), F.col("l").alias("j"))
        new = written(met.join(jump, "m", "left").select(
            "a", F.least("m", F.coalesce("j", "m")).alias("new"), "l"), "labels")
        if not new.where("new <> l").limit(1).count():
            return new.select(F.col("a").alias("row"), F.col("new").alias("root"))
        labels = new.select("a", F.col("new").alias("l"))


def groups(hashes: DataFrame, block: int) -> DataFrame:
    """row, kept (groups of the row), places: the groups in which rows are compared.

    Rows that share buckets, directly or through others, are one group if they fit into a
    block; else each of their buckets is a group, cut into blocks."""
    buckets = hashes.groupBy("bucket").agg(
        F.count("*").alias("size"), F.min("row").alias("other"),
        F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("who"))
    kept = buckets.where("size > 1").groupBy("who", "size", "other").agg(F.min("bucket").alias("bucket"))
    members = written(hashes.join(kept.select("bucket", "size", "other"), "bucket"), "members")
    roots = components(members.where("row <> other").select("row", "other").distinct())
    small = written(roots.join(roots.groupBy("root").agg(F.count("*").alias("all")), "root"), "roots")
    whole = small.where(F.col("all") <= block).select(
        "row", F.col("root").alias("bucket"), F.lit(1).cast("long").alias("blocks"))
    cut = members.join(small.where(F.col("all") > block).select("row"), "row").select(
        "row", "bucket", F.ceil(F.col("size") / block).alias("blocks"))
    placed = whole.unionByName(cut).withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")))
    # a row has at most as many groups as there are bands
    return placed.groupBy("row").agg(
        F.sort_array(F.collect_list("bucket")).alias("kept"),
        F.collect_list(F.struct("bucket", "block", "blocks")).alias("places"))


def join(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL,
         block: int = BLOCK) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the documents linked directly or through others),
    links (other documents whose similarity reaches the threshold)."""
    return _join(docs, n, threshold, recall, block)[0]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"_key": doc_key(), "_c": F.md5(
        F.coalesce(F.col("text").cast("string"), F.lit("")))})


def _join(docs: DataFrame, n: int, threshold: float, recall: float, block: int):
    bands, rows = banding(threshold, recall)
    texts = _keyed(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    every = written(signatures(texts, n, bands, rows), "signatures")
    classes = written(every.groupBy("_c").agg(
        F.count("*").alias("n"), F.min("_key").alias("first"), F.any_value("bands").alias("bands"))
        .withColumn("row", F.monotonically_increasing_id()), "classes")
    hashes = classes.where("bands is not null").select("row", F.explode("bands").alias("bucket"))
    candidates = classes.select("_c", "row", "n", "first").join(groups(hashes, block), "row")
    # with the id as part of the key the copies of one text don't meet in one task
    own = (texts.select("_c", "_key", "text")
           .join(candidates.withColumnRenamed("first", "_key"), ["_c", "_key"])
           .dropDuplicates(["_c", "_key"]))
    placed = (with_grams(own, n).withColumn("p", F.explode("places"))
              .withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("p.blocks") - 1)))
              .select("row", "n", "kept", "grams", "p.bucket", "p.block",
                      F.least("p.block", "x").alias("i"), F.greatest("p.block", "x").alias("j")))
    found = written(compared(placed, threshold), "links")
    links = found.where("other < 0").groupBy("row").agg(F.sum("links").alias("links"))
    roots = components(found.where("other >= 0"))
    rooted = classes.drop("bands").withColumn("some", F.lit(True)).join(roots, "row", "left").withColumn(
        "root", F.coalesce("root", "row"))
    lowest = rooted.groupBy("root").agg(F.min(F.struct("first", "row")).alias("lowest"))
    known = (rooted.join(lowest, "root").join(links, "row", "left")
             .select("_c", "n", "first", F.col("lowest.first").alias("lowest"),
                     (F.col("lowest.row") == F.col("row")).alias("stays"),
                     F.coalesce("links", F.lit(0)).alias("links")))
    has_words = F.col("bands").isNotNull()
    out = every.select("_key", "_c", has_words.alias("some")).join(known, "_c").select(
        key_to_id("_key").alias("doc_id"),
        F.when(F.col("some"), key_to_id("lowest")).otherwise(key_to_id("_key")).alias("class_id"),
        F.when(F.col("some"), F.col("links") + F.col("n") - 1).otherwise(0).cast("long").alias("links"))
    return out, known


def deduplicated(docs: DataFrame, n: int = N, threshold: float = THRESHOLD,
                 recall: float = RECALL) -> DataFrame:
    """One document of each class of linked documents, with the columns of ``docs``."""
    return shielded(docs, ("doc_id", "text"), lambda d: _one_of_each(d, n, threshold, recall))


def _one_of_each(docs: DataFrame, n: int, threshold: float, recall: float) -> DataFrame:
    stays = _join(docs, n, threshold, recall, BLOCK)[1].where("stays").select(
        "_c", F.col("first").alias("_key"))
    has_words = F.coalesce(F.col("text").cast("string").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    keyed = _keyed(docs)
    # equal rows with an equal id: the first of them
    one = Window.partitionBy("_c", "_key").orderBy(F.lit(0))
    first = keyed.where(has_words).join(stays, ["_c", "_key"]).withColumn(
        "_n", F.row_number().over(one)).where("_n = 1")
    columns = [f"`{c}`" for c in docs.columns]
    return first.select(*columns).unionByName(keyed.where(~has_words).select(*columns))
