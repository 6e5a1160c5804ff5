"""Exact top-k inner-product search by block-at-a-time pruning.

Vectors are cut into shards and blocks by ranges of vec_id.  A block keeps its
forward index (ids and components) and, for each component ("term"), its largest
and smallest value.  For a query the summed maxima bound every score in the
block; a shard scores its blocks in the order of that bound until it falls below
the query's k-th score.  First each query searches the shard it comes from, then
all others with the k-th score found there as the starting threshold.  Queries
travel to the shards in rows of one shard's queries each; a task holds the
blocks of one shard and one such row at a time.

Scores are exact integers: floats while every sum is below 2^53, Python integers
beyond; one that passes 64 bits is an error, as is a finite component whose scaled value
passes the doubles.

Nulls: a null id or vector, and a vector with null or non-finite components,
takes no part.  Components that a shorter vector lacks count as 0.  Ties go to
the smaller vec_id.  Rows that share the query's vec_id are its own row and no
candidates; equal repeated query rows are one query.  An empty table, or one
without queries, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_marts.llm.common import partitions, range_bounds, written

K = 10
SCALE = 1024
BLOCK_ROWS = 128
#: A shard has at most about this many vectors; small tables get smaller shards.
SHARD_ROWS = 1 << 16
MIN_SHARD_ROWS = 512
_EXACT = float(1 << 53)

_ROW = ("shard int, kind int, home int, ids array<long>, dim int, flat array<double>, "
        "high array<double>, low array<double>, kth array<double>")


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and the components floor(scale * x) as doubles; unusable rows are left out."""

    def usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i is None or not v.is_valid or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all():
                    x = np.floor(x * scale)
                    if not np.isfinite(x).all():
                        raise OverflowError(f"a component of vector {i} passes the doubles")
                    ids.append(i)
                    out.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(out, pa.list_(pa.float64()))],
                names=["vec_id", "v"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
                          ).mapInArrow(usable, "vec_id long, v array<double>")


def _row(shard, kind, home, ids, matrix, high=None, low=None, kth=None) -> dict:
    return {"shard": shard, "kind": kind, "home": home, "ids": ids.tolist(),
            "dim": matrix.shape[1], "flat": matrix.ravel(), "high": high, "low": low, "kth": kth}


def _schema() -> pa.Schema:
    f, n = pa.list_(pa.float64()), pa.int32()
    return pa.schema([("shard", n), ("kind", n), ("home", n), ("ids", pa.list_(pa.int64())),
                      ("dim", n), ("flat", f), ("high", f), ("low", f), ("kth", f)])


def _matrix(row: dict) -> np.ndarray:
    return np.array(row["flat"], np.float64).reshape(len(row["ids"]), row["dim"])


def _wide(m: np.ndarray, dim: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, dim - m.shape[1]))) if m.shape[1] < dim else m


def index(found: DataFrame, every: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Block rows (kind 0) and, for each shard, one row with its queries (kind 1)."""
    spark = found.sparkSession
    n = found.count()
    rows = min(SHARD_ROWS, max(MIN_SHARD_ROWS, n // (4 * partitions(spark))))
    bounds = range_bounds(found, "vec_id", max(1, -(-n // rows)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(bounds, batch.column("vec_id").to_numpy(), "right")
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *batch.columns],
                                             names=["shard", "vec_id", "v"])

    def blocks(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        ids = group["vec_id"].to_numpy()
        vectors = [np.asarray(v, np.float64) for v in group["v"].to_pylist()]
        dim = max(map(len, vectors))
        m = np.zeros((len(ids), dim))
        for i, v in enumerate(vectors):
            m[i, :len(v)] = v
        order = np.argsort(ids, kind="stable")
        ids, m = ids[order], m[order]
        out = []
        for a in range(0, len(ids), block_rows):
            part = m[a:a + block_rows]
            out.append(_row(shard, 0, shard, ids[a:a + block_rows], part, part.max(0), part.min(0)))
        own = np.flatnonzero(ids % every == 0)
        if len(own):
            _, first = np.unique(np.column_stack([ids[own].astype(object), m[own].astype(object)])
                                 .astype(str), axis=0, return_index=True)
            own = own[np.sort(first)]
            out.append(_row(shard, 1, shard, ids[own], m[own], kth=[-np.inf] * len(own)))
        return pa.Table.from_pylist(out, _schema())

    return found.mapInArrow(place, "shard int, vec_id long, v array<double>").groupBy(
        "shard").applyInArrow(blocks, _ROW)


def _scores(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    if np.abs(q).max(initial=0) * np.abs(m).max(initial=0) * len(q) < _EXACT:
        return (m @ q).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(q, row)) for row in m]
    if any(abs(x) >> 63 for x in exact):
        raise OverflowError("an inner product passes 64 bits")
    return np.array(exact, np.int64)


class _Shard:
    """The blocks of one shard."""

    def __init__(self, rows: list[dict]):
        self.ids = [np.array(r["ids"], np.int64) for r in rows]
        dim = max(r["dim"] for r in rows)
        self.matrices = [_wide(_matrix(r), dim) for r in rows]
        self.high = np.array([np.pad(r["high"], (0, dim - r["dim"])) for r in rows])
        self.low = np.array([np.pad(r["low"], (0, dim - r["dim"])) for r in rows])
        self.dim = dim

    def search(self, own: int, q: np.ndarray, kth: float, k: int):
        """The k best (score, id) whose score is not below ``kth``."""
        q = _wide(q[None, :], self.dim)[0]
        dim = self.dim
        # summed maxima; the margin covers the rounding of very large sums
        bound = self.high @ np.maximum(q[:dim], 0) + self.low @ np.minimum(q[:dim], 0)
        bound = bound + np.abs(bound) * 1e-12
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] < kth:
                break
            s = _scores(q[:dim], self.matrices[b])
            fit = (s >= kth) & (self.ids[b] != own)
            if not fit.any():
                continue
            ids, scores = np.concatenate([ids, self.ids[b][fit]]), np.concatenate([scores, s[fit]])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                kth = max(kth, float(scores[-1]))
        return ids, scores


_FOUND = "home int, pos int, query_id long, vec_id long, score long"


def _search(rows: DataFrame, k: int) -> DataFrame:
    """Scores the queries of each shard's kind-1 rows in the shard's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, blocks, ready = None, [], None
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    shard, blocks, ready = row["shard"], [], None
                if not row["kind"]:
                    blocks.append(row)
                    continue
                if not blocks and ready is None:
                    continue
                if ready is None:
                    ready, blocks = _Shard(blocks), []
                for pos, (own, q, kth) in enumerate(zip(row["ids"], _matrix(row), row["kth"])):
                    ids, scores = ready.search(own, q, kth, k)
                    for column, values in zip(out, ([row["home"]] * len(ids), [pos] * len(ids),
                                                    [own] * len(ids), ids.tolist(),
                                                    scores.tolist())):
                        column.extend(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int32(), pa.int32(), *[pa.int64()] * 3))],
                names=["home", "pos", "query_id", "vec_id", "score"])

    return (rows.repartition(partitions(rows.sparkSession), "shard")
            .sortWithinPartitions("shard", "kind").mapInArrow(run, _FOUND))


def top_k(vectors: DataFrame, k: int = K, every: int = 100, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows for each row whose vec_id is
    divisible by ``every``."""
    spark = vectors.sparkSession
    rows = written(index(written(integers(vectors, scale), "vectors"), every), "topk-index")
    blocks, queries = rows.where("kind = 0"), rows.where("kind = 1")
    near = written(_search(rows, k), "topk-home")
    kth = near.groupBy("home", "pos").agg(F.min("score").alias("s"), F.count("*").alias("n"))
    kth = kth.where(F.col("n") >= k).groupBy("home").agg(
        F.map_from_entries(F.collect_list(F.struct("pos", F.col("s").cast("double").alias("s"))))
        .alias("_kth"))
    started = queries.join(kth, "home", "left").withColumn(
        "kth", F.transform("ids", lambda x, i: F.coalesce(
            F.element_at("_kth", i), F.lit(float("-inf"))))).drop("_kth")
    shards = sorted(r["shard"] for r in blocks.select("shard").distinct().collect())
    others = started.withColumn("shard", F.explode(F.lit(shards).cast("array<int>"))).where(
        "shard <> home")
    far = _search(blocks.unionByName(others.select(*blocks.columns)), k)
    best = Window.partitionBy("home", "pos", "query_id").orderBy(F.desc("score"), "vec_id")
    return (near.unionByName(far).withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
