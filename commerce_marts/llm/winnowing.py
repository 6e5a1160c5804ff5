"""Document fingerprints by winnowing.

Every k-gram of code points is hashed with a rolling polynomial; from each
window of ``w`` consecutive k-grams the smallest hash is kept, ties to the
rightmost, with its position.  Two texts that share ``w + k - 1`` code points
share a fingerprint; nothing shorter than ``k`` is matched.  A text with fewer
than ``w`` k-grams is one window; a text shorter than ``k`` keeps the hash of the
whole text at position 0; an empty text has no fingerprint.

``with_next`` brings each document together with its successor by doc_id: ids
are cut into ranges, each range is one group of the shuffle, and the first
document of a range is also sent to the range before it.  Texts move once, and
no order is kept in one task.

Nulls: a null text is empty, a null doc_id comes after all others.  Rows with
equal ids follow each other in the order of their texts.  An empty table gives
no rows; the successor of a single row is the row itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_marts.llm.common import (NO_ID, doc_key, mixed, partitions, range_bounds, rolling,
                                       sliding_min, text_slices)

K, W = 20, 60
#: Low bits of a window key: the position from the right, so that ties go right.
POSITION_BITS = 24
_MASK = np.uint64((1 << POSITION_BITS) - 1)
#: Code points handled at once; longer texts go in overlapping parts.
PART = 1 << 22


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _long(codes: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, places = [], []
    step = PART - (w + k - 2)
    for a in range(0, max(1, len(codes) - (w + k - 2)), step):
        (h, p), = _batch([codes[a:a + PART]], k, w)
        fresh = p + a > (places[-1][-1] if places else -1)
        hashes.append(h[fresh])
        places.append((p + a)[fresh])
    return np.concatenate(hashes), np.concatenate(places)


def _batch(texts: list[np.ndarray], k: int, w: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, positions) of each text; all texts together are below the position limit."""
    codes = np.concatenate([*texts, np.zeros(k, np.uint64)])
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(sizes) - sizes
    grams = rolling(codes + np.uint64(1), k)
    key = (grams & ~_MASK) | (_MASK - np.arange(len(grams), dtype=np.uint64))
    least = sliding_min(key, w)
    n_windows = sizes - k + 1 - w + 1
    change = np.ones(len(least), bool)
    change[1:] = least[1:] != least[:-1]
    out = []
    for a, n, m in zip(first.tolist(), sizes.tolist(), n_windows.tolist()):
        if m > 0:
            fresh = change[a:a + m].copy()
            fresh[0] = True
            kept = least[a:a + m][fresh]
        elif n >= k:
            kept = key[a:a + n - k + 1].min(keepdims=True)
        elif n:
            power = rolling(codes[a:a + n] + np.uint64(1), n)
            kept = (mixed(power + np.uint64(n)) & ~_MASK) | (_MASK - np.uint64(a))
        else:
            kept = key[:0]
        out.append((kept >> np.uint64(POSITION_BITS), (_MASK - (kept & _MASK)).astype(np.int64) - a))
    return out


def winnow(texts: list[str], k: int = K, w: int = W) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes (40 bits) and positions of each text, in the order of the text."""
    out: list = [None] * len(texts)
    group: list[int] = []
    codes = [_codes(t) for t in texts]
    held = 0

    def flush():
        for i, found in zip(group, _batch([codes[i] for i in group], k, w)):
            out[i] = found

    for i, c in enumerate(codes):
        if len(c) > PART:
            out[i] = _long(c, k, w)
            continue
        if held + len(c) > PART:
            flush()
            group, held = [], 0
        group.append(i)
        held += len(c)
    if group:
        flush()
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes; two empty ones are alike."""
    x, y = set(a.tolist()), set(b.tolist())
    both = len(x & y)
    whole = len(x) + len(y) - both
    return both / whole if whole else 1.0


def shown(found: tuple[np.ndarray, np.ndarray]) -> str:
    """``position:hash`` of each kept k-gram, hash in hex, joined by one space."""
    return " ".join(f"{p}:{h:010x}" for h, p in zip(found[0].tolist(), found[1].tolist()))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (_b, _next, id, text) such that, sorted by (_b, _next, id, text), each row with
    _next = 0 is followed by its successor: another row of its range, or the row with
    _next = 1 that closes the range."""
    spark = docs.sparkSession
    keyed = docs.select(doc_key().alias("id"), F.coalesce(F.col("text").cast("string"),
                                                          F.lit("")).alias("text"))
    bounds = range_bounds(keyed, "id", 8 * partitions(spark))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(bounds, batch.column("id").to_numpy(), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("id")], names=["_b", "id"])

    # one row for each range: at most 8 x the shuffle partitions
    heads = {r["_b"]: r["id"] for r in keyed.select("id").mapInArrow(spread, "_b int, id long")
             .groupBy("_b").agg(F.min("id").alias("id")).collect()}
    ranges = sorted(heads)
    before = {heads[b]: ranges[i - 1] for i, b in enumerate(ranges)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            at = np.searchsorted(bounds, ids, "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(np.zeros(len(at), np.int32)), *batch.columns],
                names=["_b", "_next", "id", "text"])
            head = [i for i, x in enumerate(ids.tolist()) if x in before]
            if head:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([before[int(ids[i])] for i in head], pa.int32()),
                     pa.array(np.ones(len(head), np.int32)),
                     *batch.take(pa.array(head)).columns], names=["_b", "_next", "id", "text"])

    return keyed.mapInArrow(deal, "_b int, _next int, id long, text string")


def fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of each document and of its text with the last quarter replaced by
    the start of the next document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # the last row so far: its successor is yet to come
        for batch in batches:
            for part in text_slices(batch, max_bytes=4 << 20):
                rows = waiting + list(zip(*(part.column(c).to_pylist()
                                            for c in ("_b", "_next", "id", "text"))))
                waiting = rows[-1:]
                pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[1] and a[0] == b[0]]
                if not pairs:
                    continue
                edited = []
                for (_, _, _, text), (_, _, _, other) in pairs:
                    cut = len(text) // 4
                    edited.append(text[:len(text) - cut] + other[:cut])
                own = dict(zip(range(len(rows)), winnow([r[3] for r in rows], k, w)))
                at = [i for i, (a, b) in enumerate(zip(rows, rows[1:])) if not a[1] and a[0] == b[0]]
                new = winnow(edited, k, w)
                yield pa.RecordBatch.from_arrays([
                    pa.array([None if a[2] == NO_ID else a[2] for a, _ in pairs], pa.int64()),
                    pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest()
                              for e in edited]),
                    pa.array([shown(own[i]) for i in at]),
                    pa.array([shown(f) for f in new]),
                    pa.array([likeness(own[i][0], f[0]) for i, f in zip(at, new)], pa.float64()),
                    pa.array([likeness(own[i][0], own[i + 1][0]) for i in at], pa.float64()),
                ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint",
                          "edited_fingerprint", "near_edited", "near_next"])

    dealt = with_next(docs)
    return (dealt.repartition(partitions(docs.sparkSession), "_b")
            .sortWithinPartitions("_b", "_next", "id", "text")
            .mapInArrow(score, "doc_id long, n_chars long, edited_sha256 string, "
                        "fingerprint string, edited_fingerprint string, near_edited double, "
                        "near_next double"))
