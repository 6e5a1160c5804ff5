"""Katz backoff n-gram model with Good-Turing discounts and exactly normalised weights.

Order 1: P1(w) = (c + 0.1) / (N + 0.1 (V + 1)), which sums to one over the V training
tokens and one unknown.  Order k, for a history h of k - 1 tokens and h' without its
first: a seen n-gram has d_k(c) c(h, w) / c(h), with the Good-Turing discount d_k of its
order for counts up to ``MAX_R`` (where counts of counts give none between 0 and 1:
(r - 0.5) / r); others have alpha(h) P_{k-1}(w | h'), alpha(h) = (1 - mass of the seen) /
(1 - their P_{k-1}), so every history of every order sums to one.  A history without
discounted n-grams keeps one of c(h) + 1 parts for unseen words.  An unseen history backs
off with 1.  The first tokens of a document have the start as often as needed before them.

Documents are encoded in chunks of bounded text, a table bucketed by chunk.  Order
by order, a chunk sends its distinct n-grams as sorted arrays to buckets of
their hash, where they are counted; the answer is the counts in the same order, in
tables bucketed by chunk as well.  The sums of a history go the same way.  Hot
n-grams thus come once per chunk.  A chunk then holds the counts and weights of all
its n-grams and of their suffixes, so each order is evaluated from the one below.
Nothing corpus-wide reaches the driver but N, V and the first counts of counts of
each order.  Each order adds about the requests and tables of the pairs.

Nulls: a null text is an empty text, one end token; a null doc_id is learned from.
Repeated rows count again.  Texts are read whole.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_marts.llm.common import (BASE, mixed, partitions, text_slices, word_hashes, words,
                                       written)

#: Tokens of the longest n-grams.
ORDER = 2
MAX_R = 5
ADD = 0.1
END, START = np.uint64(1), np.uint64(2)
#: Bytes of text of a chunk, and tokens for each bucket of words or pairs.
CHUNK_BYTES = 4 << 20
BUCKET_TOKENS = 2_000_000


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))


def chunks(docs: DataFrame) -> DataFrame:
    """chunk, n (its tokens); doc_id and train of its documents; vocab (sorted word hashes and
    the start), ids (tokens as places in vocab), lengths (tokens of each document with its end)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in text_slices(batch, max_bytes=CHUNK_BYTES):
                flat, n = words(pc.ascii_lower(pc.fill_null(part.column("text"), "")))
                h = np.insert(word_hashes(flat), np.cumsum(n), END)
                vocab, ids = np.unique(np.append(h, START), return_inverse=True)
                ids = ids[:-1]
                yield pa.RecordBatch.from_arrays([
                    pa.array([chunk]), pa.array([len(ids)]), *(pa.array([part.column(c).to_pylist()], pa.list_(t))
                                         for c, t in (("doc_id", pa.int64()), ("train", pa.bool_()))),
                    *(pa.array([x.tobytes()], pa.binary())
                      for x in (vocab, ids.astype(np.uint32), (n + 1).astype(np.int64)))],
                    names=["chunk", "n", "doc_id", "train", "vocab", "ids", "lengths"])
                chunk += 1

    return written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~held_out()).alias("train"),
                    F.col("text").cast("string").alias("text"))
        .mapInArrow(encode, "chunk long, n long, doc_id array<long>, train array<boolean>, "
                            "vocab binary, ids binary, lengths binary"), "chunks", by="chunk")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows as Arrow scalars, which copy nothing."""
    for k in range(batch.num_rows):
        yield {n: batch.column(n)[k] for n in batch.schema.names}


class _Grams(NamedTuple):
    """Distinct n-grams of a chunk in order of their hash: hash, training count, places of their
    history and their suffix among the n-grams one shorter, each token's n-gram, and the place
    of the starts."""

    key: np.ndarray
    n: np.ndarray
    history: np.ndarray | None
    suffix: np.ndarray | None
    at: np.ndarray
    pad: int


class _Chunk:
    def __init__(self, row: dict):
        self.vocab, self.ids, self.lengths = (
            np.frombuffer(row[n].as_buffer(), t)
            for n, t in (("vocab", np.uint64), ("ids", np.uint32), ("lengths", np.int64)))
        self.ids = self.ids.astype(np.int64)
        self.train = np.repeat(row["train"].values.to_numpy(zero_copy_only=False), self.lengths)
        self._kept: dict[tuple[int, bool], _Grams] = {}

    def grams(self, k: int, pad: bool = True) -> _Grams:
        """The distinct n-grams of k tokens; with ``pad`` the k starts as well, the history of
        a document's first token."""
        if (k, pad) not in self._kept:
            self._kept[k, pad] = self._grams(k, pad)
        return self._kept[k, pad]

    def _grams(self, k: int, pad: bool) -> _Grams:
        start = int(np.searchsorted(self.vocab, START))
        if k == 1:
            n = np.bincount(self.ids, self.train, minlength=len(self.vocab)).astype(np.int64)
            return _Grams(self.vocab, n, None, None, self.ids, start)
        prev = self.grams(k - 1)
        before = np.concatenate([[0], prev.at[:-1]])
        before[np.cumsum(self.lengths) - self.lengths] = prev.pad
        code = before * len(self.vocab) + self.ids
        suffix = prev.at
        train = self.train
        if pad:
            code = np.append(code, prev.pad * len(self.vocab) + start)
            suffix, train = np.append(suffix, prev.pad), np.append(train, False)
        code, first, at = np.unique(code, return_index=True, return_inverse=True)
        h, w = np.divmod(code, len(self.vocab))
        with np.errstate(over="ignore"):
            key = mixed(mixed(prev.key[h] * BASE) + self.vocab[w])
        n = np.bincount(at, train, minlength=len(code)).astype(np.int64)
        order = np.argsort(key, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        at = place[at]
        return _Grams(key[order], n[order], h[order], suffix[first][order],
                      at[:len(self.ids)], int(at[-1]) if pad else -1)


def _word_answer(at: np.ndarray, first: np.ndarray, total: np.ndarray):
    """The place of each word in its bucket; N and V of the bucket."""
    return at.astype(np.uint32), [total.sum(), (total > 0).sum()]


def _counts_of_counts(total: np.ndarray) -> np.ndarray:
    return np.bincount(total[(total > 0) & (total <= MAX_R + 1)], minlength=MAX_R + 2)


def _owner(at: np.ndarray, first: np.ndarray) -> np.ndarray:
    owner = np.zeros(len(at), bool)
    owner[first] = True
    return owner


def _top_answer(at: np.ndarray, first: np.ndarray, total: np.ndarray):
    """Whether an n-gram is met for the first time; counts of counts of the bucket."""
    return _owner(at, first), _counts_of_counts(total)


def _inner_answer(at: np.ndarray, first: np.ndarray, total: np.ndarray):
    """Twice the n-gram's place in its bucket, and one more where it is met for the first time."""
    return ((at.astype(np.uint32) << np.uint32(1)) | _owner(at, first).astype(np.uint32),
            _counts_of_counts(total))


def tally(encoded: DataFrame, ask: Callable, answer: Callable, buckets: int, name: str) -> DataFrame:
    """chunk, found: for each bucket, counts (corpus-wide training count of what the chunk asked
    for, by hash), marks and sums (both from ``answer``)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                key, n = ask(_Chunk(row))[:2]
                of = (key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                cut = np.searchsorted(of, np.arange(buckets + 1))
                full = np.flatnonzero(np.diff(cut))
                parts = [slice(cut[b], cut[b + 1]) for b in full]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full.astype(np.int32)), pa.array(np.full(len(full), row["chunk"].as_py())),
                     pa.array([key[p].tobytes() for p in parts], pa.binary()),
                     pa.array([n[p].astype(np.uint32).tobytes() for p in parts], pa.binary())],
                    names=["bucket", "chunk", "keys", "n"])

    def count(group: pa.Table) -> pa.Table:
        group = group.sort_by("chunk")
        keys = [np.frombuffer(k.as_py(), np.uint64) for k in group["keys"]]
        n = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in group["n"]])
        _, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        total = np.bincount(at, n).astype(np.int64)
        marks, sums = answer(at, first, total)
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        return pa.table({
            "chunk": group["chunk"], "bucket": group["bucket"],
            "counts": pa.array([x.tobytes() for x in np.split(total[at], cuts)], pa.binary()),
            "marks": pa.array([x.tobytes() for x in np.split(marks, cuts)], pa.binary()),
            "sums": pa.array([[int(x) for x in sums]] + [None] * (len(keys) - 1), pa.list_(pa.int64()))})

    found = encoded.mapInArrow(send, "bucket int, chunk long, keys binary, n binary").groupBy(
        "bucket").applyInArrow(count, "chunk long, bucket int, counts binary, marks binary, sums array<long>")
    # a chunk's answers are as large as its requests
    return written(found.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct(
        "bucket", "counts", "marks", "sums"))).alias("found")), name, by="chunk")


def _sums(answers: DataFrame, n: int) -> list[int]:
    row = answers.select(F.explode("found.sums").alias("s")).agg(
        *(F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(n))).first()
    return [int(x or 0) for x in row]


def discounts(n_r: list[int]) -> np.ndarray:
    """d(r) for r up to MAX_R; n_r[r] pairs occur r times.  Index 0 is unused."""
    out = np.ones(MAX_R + 1)
    common = (MAX_R + 1) * n_r[MAX_R + 1] / n_r[1] if n_r[1] else 1.0
    for r in range(1, MAX_R + 1):
        good = (r + 1) * n_r[r + 1] / (r * n_r[r]) if n_r[r] else 0.0
        d = (good - common) / (1 - common) if common < 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


def _discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return c * np.where(c <= MAX_R, d[np.minimum(c, MAX_R)], 1.0)


def _array(parts, kind) -> np.ndarray:
    """What the buckets answered, in order of the hash."""
    return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in parts.values])


#: What a chunk is made of again.
_TEXT = ("chunk", "train", "vocab", "ids", "lengths")


def _weighed(known: DataFrame, below: int, *more: Column) -> DataFrame:
    """The chunks with counts, units and alphas of the orders up to ``below``, and ``more``; the
    scan reads nothing else."""
    return known.select(
        *_TEXT, *(F.col(f"found{k}.counts").alias(f"counts{k}") for k in range(1, below + 1)),
        *(F.col(f"histories{k}.{x}").alias(f"{x}{k}") for k in range(2, below + 1)
          for x in ("unit", "alpha")), *more)


def backed_off(group: pa.Table) -> pa.Table:
    """unit (the factor of a discounted count) and alpha of a bucket's words, for each chunk."""
    at = [np.frombuffer(x.as_py(), np.uint32) for x in group["places"]]
    every = np.concatenate(at)
    some = np.concatenate([a[np.frombuffer(x.as_py(), np.uint32)] for a, x in zip(at, group["some"])])
    c_h, mass, p = (np.bincount(some, np.concatenate(
        [np.frombuffer(x.as_py(), float) for x in group[name]]), minlength=int(every.max()) + 1)
        for name in ("c_h", "mass", "p"))
    scale = np.where(mass > c_h * (1 - 1e-9), c_h / (c_h + 1), 1.0)
    seen = c_h > 0
    unit = np.divide(scale, c_h, out=np.zeros_like(c_h), where=seen)
    alpha = np.where(seen, (1 - unit * mass) / (1 - p), 1.0)
    return pa.table({"chunk": group["chunk"], "bucket": group["bucket"],
                     "unit": pa.array([unit[a].tobytes() for a in at], pa.binary()),
                     "alpha": pa.array([alpha[a].tobytes() for a in at], pa.binary())})


def _probabilities(chunk: _Chunk, row: dict, order: int, top: int, denominator: float,
                   d: dict[int, np.ndarray]) -> np.ndarray:
    """P_order of each n-gram of the chunk, from the orders below; ``top`` is the model's order."""
    p = (_array(row["counts1"], np.int64) + ADD) / denominator
    for k in range(2, order + 1):
        grams = chunk.grams(k, k < top)
        c = _array(row[f"counts{k}"], np.int64)
        p = _array(row[f"alpha{k}"], float)[grams.history] * p[grams.suffix]
        seen = c > 0
        p[seen] = _array(row[f"unit{k}"], float)[grams.history[seen]] * _discounted(c[seen], d[k])
    return p


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    if order < 1:
        raise ValueError("the order of a model is at least 1")
    encoded = chunks(docs)
    tokens = int(encoded.agg(F.sum("n").alias("n")).first()["n"] or 0)
    buckets = max(1, partitions(docs.sparkSession), -(-tokens // BUCKET_TOKENS))

    def ask(k: int) -> Callable:
        return lambda chunk: chunk.grams(k, k < order)[:2]

    vocabulary = tally(encoded, ask(1), _word_answer, buckets, "words")
    n, v = _sums(vocabulary, 2)
    denominator = n + ADD * (v + 1)
    known = encoded.join(vocabulary.withColumnRenamed("found", "found1"), "chunk")
    d: dict[int, np.ndarray] = {}
    for k in range(2, order + 1):
        found = tally(encoded, ask(k), _top_answer if k == order else _inner_answer, buckets,
                      f"grams{k}")
        d[k] = discounts(_sums(found, MAX_R + 2))
        known = known.join(found.withColumnRenamed("found", f"found{k}"), "chunk")
        known = known.join(_histories(known, k, order, denominator, dict(d)), "chunk")

    def evaluated(row: dict) -> pa.RecordBatch:
        chunk, c = _Chunk(row), _array(row["counts1"], np.int64)
        base = np.log10((c + ADD) / denominator)
        log = np.log10(_probabilities(chunk, row, order, order, denominator, d))
        at = chunk.grams(order, order == 1).at
        starts = np.cumsum(chunk.lengths) - chunk.lengths
        return pa.RecordBatch.from_arrays(
            [row["doc_id"].values, pa.array(chunk.lengths),
             pa.array(np.add.reduceat((c[chunk.ids] > 0).astype(np.int64), starts)),
             pa.array(np.add.reduceat(base[chunk.ids], starts)),
             pa.array(np.add.reduceat(log[at], starts))],
            names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                yield evaluated(row)  # a chunk's arrays are gone before the next one's

    return _weighed(known, order, F.col("doc_id")).mapInArrow(
        evaluate, "doc_id long, n_tokens long, n_known long, base_score double, score double").select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def _histories(known: DataFrame, k: int, top: int, denominator: float,
               d: dict[int, np.ndarray]) -> DataFrame:
    """chunk, histories<k>: unit and alpha of what precedes the last token of the n-grams of order
    k, in order of the hash of the n-grams one shorter."""

    def summed(row: dict) -> pa.RecordBatch:
        chunk = _Chunk(row)
        below = _probabilities(chunk, row, k - 1, top, denominator, d)
        grams, counts = chunk.grams(k, k < top), _array(row["asked"], np.int64)
        owner = (_array(row["marks"], np.uint32) & 1 if k < top
                 else _array(row["marks"], bool)).astype(bool)
        some = owner & (counts > 0)
        h, c = grams.history[some], counts[some]
        sums = [np.bincount(h, x, minlength=len(below)) for x in (
            c, _discounted(c, d[k]), below[grams.suffix[some]])]
        places = [np.frombuffer(x.as_buffer(), np.uint32) >> np.uint32(k > 2)
                  for x in row["places"].values]
        cut = np.cumsum([0, *map(len, places)])
        full = [np.flatnonzero(sums[0][a:b]) for a, b in zip(cut, cut[1:])]
        return pa.RecordBatch.from_arrays(
            [row["buckets"].values, pa.array([row["chunk"].as_py()] * len(full)),
             pa.array([x.tobytes() for x in places], pa.binary()),
             pa.array([x.astype(np.uint32).tobytes() for x in full], pa.binary()),
             *(pa.array([s[a + x].tobytes() for a, x in zip(cut, full)], pa.binary())
               for s in sums)], names=["bucket", "chunk", "places", "some", "c_h", "mass", "p"])

    def masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                yield summed(row)

    asked = _weighed(known, k - 1, F.col(f"found{k}.counts").alias("asked"),
                     F.col(f"found{k}.marks").alias("marks"),
                     F.col(f"found{k - 1}.bucket").alias("buckets"),
                     F.col(f"found{k - 1}.marks").alias("places"))
    return written(asked.mapInArrow(
        masses, "bucket int, chunk long, places binary, some binary, c_h binary, mass binary, p binary")
        .groupBy("bucket").applyInArrow(backed_off, "chunk long, bucket int, unit binary, alpha binary")
        .groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("bucket", "unit", "alpha")))
                              .alias(f"histories{k}")), f"histories{k}", by="chunk")
