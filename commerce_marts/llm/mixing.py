"""Mixing sources to target weights by subset-sum budget fitting.

Targets: sources share ``share`` of all sizes by weight; a target stops at
``max_repeat`` times its source's size and the excess is reshared by weight
until none is above.  The fixed point of that resharing is
``min(weight * level, max_repeat * size)`` for one level, found from running
sums over the sources ordered by ``max_repeat * size / weight``.

Budget: a source takes every document ``floor(target / size)`` times; what
remains is filled by taking some documents once more.  Documents are counted by
exact length; each length first gives its proportional share, then the lengths
with the largest remainders give one more while the rest is above the table
size, and a bounded-knapsack table (reachable sums as the bits of an integer)
fits the last few words exactly, or to the nearest reachable sum below.
Within a length the documents are chosen by a seeded hash, so reruns agree.

Only the histogram (source, length, count) goes through a task per source; the
documents of a hot (source, length) are ranked within hash buckets.

Nulls: a null text has size 0; a null source is a source of its own, last in the
order of weights; null ids are hashed like any value.  Empty texts are never
taken (0 words).  Repeated rows are separate documents.  An empty table gives no
rows.  Sources whose size is 0 get target 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_marts.llm.common import shielded, text_slices, words, written

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = 17
#: Sums up to this are fitted exactly; the knapsack table has as many bits.
TABLE = 1 << 15
#: Fixed value: bits that the sums of a second, wider fit may hold, 256 MB.
MOST_BITS = 1 << 31
#: Hash buckets over which the documents of one (source, length) are ranked.
BUCKETS = 1024


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words of the whole text), _u (seeded hash)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("source"), part.column("_h"),
                     pa.array(words(part.column("text"))[1])],
                    names=["doc_id", "source", "_h", "size"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"),
                        F.col("text").cast("string"), F.xxhash64("text").alias("_h"))
            .mapInArrow(count, "doc_id long, source string, _h long, size long"))


def targets(per_source: DataFrame, weights: Sequence[float] = WEIGHTS,
            max_repeat: float = MAX_REPEAT, share: float = 1.0) -> DataFrame:
    """Adds weight and target to (source, source_size); one row per source."""
    ranked = per_source.withColumn(
        "_n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))),
                          (F.col("_n") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(max_repeat))
    # sources in the order in which they reach their cap; those before are capped
    order = Window.orderBy("_ratio", "_n")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = ((F.sum("source_size").over(whole) * F.lit(float(share))
              - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(onward))
    levels = (ranked.withColumn("weight", weight).withColumn("_cap", cap)
              .withColumn("_ratio", F.col("_cap") / F.col("weight"))
              .withColumn("_level", level))
    # the first level that is below its own ratio holds for all sources after it
    fits = F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))
    settled = levels.withColumn("_settled", F.first(fits, ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    target = F.when(F.col("_settled").isNull(), F.col("_cap")).otherwise(
        F.least(F.col("_cap"), F.col("weight") * F.col("_settled")))
    return settled.select("source", "source_size", "weight", target.alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, table: int = TABLE) -> np.ndarray:
    """How many documents of each length to take so that their words come to
    ``budget``, or to the nearest sum below it that the table finds."""
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    total = int((lengths * counts).sum())
    taken = np.zeros(len(lengths), np.int64)
    if budget <= 0 or total <= 0:
        return taken
    if budget >= total:
        return np.where(lengths > 0, counts, 0)
    # keep a table's worth of words for the exact fit
    share = max(0, budget - table // 2)
    exact = [c * share / total for c in counts.tolist()]
    taken = np.array([int(x) for x in exact], np.int64)
    taken[lengths <= 0] = 0
    rest = budget - int((taken * lengths).sum())
    order = np.lexsort((lengths, -(np.array(exact) - taken))).tolist()
    best = _filled(lengths, counts, taken, rest, order, table)
    free = (counts > taken) & (lengths > 0) & (lengths <= rest)
    if rest > table and int((best * lengths).sum()) < budget and free.any():
        # off target: the whole rest, or twice the longest document, in steps all lengths share
        step = int(np.gcd.reduce(lengths[free]))
        parts = int(sum(min(c, rest // n).bit_length() for c, n in zip(
            (counts - taken)[free].tolist(), lengths[free].tolist())))
        wide = rest if rest // step * parts <= MOST_BITS else 2 * int(lengths[free].max())
        if wide > table:
            again = _filled(lengths, counts, taken, rest, order, wide, step)
            best = max(best, again, key=lambda t: int((t * lengths).sum()))
    return best


def _filled(lengths: np.ndarray, counts: np.ndarray, taken: np.ndarray, rest: int,
            order: list[int], table: int, step: int = 1) -> np.ndarray:
    """``taken`` and documents in ``order`` until the table holds the rest, fitted exactly."""
    taken = taken.copy()
    while rest > table:
        before = rest
        for i in order:
            if taken[i] < counts[i] and 0 < lengths[i] <= rest:
                taken[i] += 1
                rest -= int(lengths[i])
                if rest <= table:
                    break
        if rest == before:
            break
    return taken + knapsack(np.where(lengths <= rest, lengths // step, 0), counts - taken,
                            min(rest, table) // step)


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: counts of each length whose sum is the largest reachable
    one up to ``budget``; bit s of ``reach`` says that the sum s is reachable."""
    taken = np.zeros(len(lengths), np.int64)
    mask = (1 << (budget + 1)) - 1
    reach, steps = 1, []
    for i in np.argsort(lengths, kind="stable").tolist():
        length, left = int(lengths[i]), int(counts[i])
        if length <= 0 or length > budget:
            continue
        left, part = min(left, budget // length), 1
        while left and not reach >> budget & 1:  # binary parts of the count
            n = min(part, left)
            steps.append((i, n, reach))
            reach |= reach << n * length & mask
            left -= n
            part *= 2
        if reach >> budget & 1:
            break
    at = reach.bit_length() - 1
    for i, n, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += n
            at -= n * int(lengths[i])
    return taken


def plan(histogram: DataFrame, per_source: DataFrame) -> DataFrame:
    """For each (source, size): source_size, target, copies of every document and
    ``extra``, the documents of that size taken once more."""

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("size")
        size, count = frame["size"].to_numpy(np.int64), frame["n"].to_numpy(np.int64)
        whole, budget = int(frame["source_size"].iloc[0]), int(round(frame["target"].iloc[0]))
        copies = budget // whole if whole else 0
        frame["copies"] = copies
        frame["extra"] = fit(size, count, budget - copies * whole)
        return frame[["_s", "size", "source_size", "target", "copies", "extra"]]

    joined = histogram.join(per_source.select(source_key(), "source_size", "target"), "_s")
    return joined.groupBy("_s").applyInPandas(
        fill, "_s string, size long, source_size long, target double, copies long, extra long")


def source_key():
    """A source as a join key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")).alias("_s")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: float = MAX_REPEAT,
        share: float = 1.0, seed: int = SEED) -> DataFrame:
    """doc_id, source, _h (hash of the text), size, source_size, target, copies (times
    the mix takes the document), taken (copies * size); one row per document."""
    fixed = written(sizes(docs).select(
        "*", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "_h"), F.lit(1 << 62)).alias("_u")), "sizes")
    keyed = fixed.withColumn("_s", source_key()).withColumn(
        "_b", (F.col("_u") % BUCKETS).cast("int"))
    per_bucket = written(keyed.groupBy("_s", "source", "size", "_b").count(), "bucket-counts")
    histogram = per_bucket.groupBy("_s", "size").agg(F.sum("count").alias("n"))
    per_source = per_bucket.groupBy("source").agg(
        F.sum(F.col("size") * F.col("count")).alias("source_size"))
    planned = plan(histogram, targets(per_source, weights, max_repeat, share))
    upto = Window.partitionBy("_s", "size").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    quota = (per_bucket.select("_s", "size", "_b",
                               F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("_before"))
             .join(planned, ["_s", "size"]))
    rank = F.row_number().over(Window.partitionBy("_s", "size", "_b").orderBy("_u", "doc_id"))
    copies = F.col("copies") + (F.col("_before") + rank <= F.col("extra")).cast("long")
    return (keyed.join(quota, ["_s", "size", "_b"])
            .select("doc_id", "source", "_h", "size", "source_size", "target",
                    copies.alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")))


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS,
                    max_repeat: float = MAX_REPEAT, share: float = 1.0,
                    seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it.  Documents without
    words cost nothing and stay once.  Rows equal in doc_id, source and text pool their
    copies: the first ones by a hash of the row get one more."""
    return shielded(docs, ("doc_id", "source", "text"),
                    lambda d: _taken_rows(d, weights, max_repeat, share, seed))


def _taken_rows(docs: DataFrame, weights: Sequence[float], max_repeat: float, share: float,
                seed: int) -> DataFrame:
    taken = mix(docs, weights, max_repeat, share, seed)
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).alias("_id"), source_key(),
           F.col("_h")]
    pooled = taken.select(*key, "copies", "size").groupBy("_id", "_s", "_h").agg(
        F.sum(F.when(F.col("size") == 0, 1).otherwise(F.col("copies"))).alias("_copies"),
        F.count("*").alias("_rows"))
    keyed = docs.withColumn("_h", F.xxhash64("text")).select(
        *(f"`{c}`" for c in docs.columns), *key)
    joined = keyed.join(pooled, ["_id", "_s", "_h"])
    one = F.expr("_copies div _rows")
    rank = F.row_number().over(Window.partitionBy("_id", "_s", "_h").orderBy("doc_id"))
    times = F.when(F.col("_rows") == 1, F.col("_copies")).otherwise(
        one + (F.col("_rank") <= F.col("_copies") % F.col("_rows")).cast("long"))
    return (joined.withColumn("_rank", rank).withColumn("_times", times).where("_times > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_times")))
            .select(*(f"`{c}`" for c in docs.columns)))
