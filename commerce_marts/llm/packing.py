"""Best-fit packing of tokenised documents into fixed-length sequences.

Bulk-synchronous best fit.  Lengths are integers up to ``capacity``, so the
range-sorted documents and the range-sorted gaps are kept run-length encoded:
pieces of one length form one run, open sequences with one gap form one run.
A step takes the longest run of pieces, its successor in the gap order (the
smallest gap that holds the length), matches as many as both runs have, pairs
the i-th piece with the i-th sequence (ranks resolve the conflicts), moves the
sequences to their smaller gap, and repeats; without a successor new sequences
open.  Every step is one record (length, first rank, count, first sequence,
offset); their number depends on the capacity alone, never on the data, and the
state of the sweep is at most ``capacity`` counts.  The pieces themselves stay
distributed: each finds its rank within its length (ranks of a hot length are
split over buckets of a hash) and looks its step up.

Nulls: a null text is an empty text; a null doc_id is packed like any other.
Empty texts are the single id 0.  Repeated rows are packed once each.  An empty
table gives no pieces.  Texts of any length are cut into pieces of ``capacity``.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_marts.llm.common import encoded, runs, text_slices, words, written

CAPACITY = 2048
#: Hash buckets over which the pieces of one length are ranked.
RANK_BUCKETS = 1024
#: Distinct words a Python worker keeps with their ids (bounds its memory).
CACHED_WORDS = 300_000
_SEPARATOR = "<|startoftext|>"
#: Words of printable ASCII without an apostrophe and of accented Latin letters (but the capital
#: dotted I).  The tokenizer lower-cases these letter by letter, composes nothing, and cuts them
#: into runs of letters, single digits and runs of the rest.
_SIMPLE = re.compile("[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
_LETTER = "a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_PARTS = re.compile(f"[{_LETTER}]+|[0-9]|[^0-9{_LETTER}]+")


class WordIds:
    """Token ids of whole texts by way of their distinct words.

    The tokenizer drops white space and never merges across it, so a text's ids
    are those of its words; each distinct word of a slice is encoded once, and
    simple words by way of their parts, which repeat more often than they do.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.separator = self.tokenizer.token_to_id(_SEPARATOR)
        self.known: dict[str, list[int]] = {}
        self.parts: dict[str, list[int]] = {}

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _part(self, part: str) -> list[int]:
        ids = self.parts.get(part)
        if ids is None:
            mapped = part if part.isascii() else self.tokenizer.pre_tokenizer.pre_tokenize_str(part)[0][0]
            ids = self.parts[part] = [t.id for t in self.tokenizer.model.tokenize(mapped)]
        return ids

    def _simple(self, word: str) -> list[int]:
        parts = _PARTS.findall(word.lower())
        if len(parts) == 1:
            return self._part(parts[0])
        return [i for part in parts for i in self._part(part)]

    def of_words(self, distinct: list[str], repeated: np.ndarray) -> list[list[int]]:
        """Ids of each word; ``repeated`` marks the words worth keeping."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        if len(self.parts) > CACHED_WORDS:
            self.parts.clear()
        out: list = [self.known.get(w) for w in distinct]
        new = [i for i, ids in enumerate(out) if ids is None]
        joined = []
        for i in new:
            word = distinct[i]
            if "<|" in word or "|>" in word:
                out[i] = self._encode(word)
            elif _SIMPLE.fullmatch(word):
                out[i] = self._simple(word)
            else:
                joined.append(i)
        for a in range(0, len(joined), 500):
            part = joined[a:a + 500]
            ids = np.array(self._encode(_SEPARATOR.join(distinct[i] for i in part)), np.uint32)
            for i, own in zip(part, np.split(ids, np.flatnonzero(ids == self.separator))):
                out[i] = (own[1:] if i != part[0] else own).tolist()
        for i in new:
            if repeated[i]:
                self.known[distinct[i]] = out[i]
        return out

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text followed by id 0, and their counts."""
        flat, n_words = words(texts)
        distinct, idx = encoded(flat)
        per_word = self.of_words(distinct.to_pylist(), np.bincount(idx, minlength=len(distinct)) > 1)
        sizes = np.fromiter((len(x) for x in per_word), np.int64, len(per_word))
        table = np.append(np.fromiter(itertools.chain.from_iterable(per_word), np.uint32,
                                      int(sizes.sum())), np.uint32(0))
        # the end of each text counts as one more word, whose only id is the last of the table
        ends = np.cumsum(n_words)
        order = np.insert(idx, ends, len(per_word)) if len(ends) else idx
        sizes = np.append(sizes, 1)
        starts = np.cumsum(sizes) - sizes
        counts = sizes[order]
        ids = table[np.repeat(starts[order], counts) + runs(counts)]
        upto = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(upto[np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])])


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The tokenizer of this Python worker, read once."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                ids, counts = word_ids(tokenizer).of_texts(part.column("text"))
                first = np.cumsum(counts) - counts
                n = -(-counts // capacity)
                row = np.repeat(np.arange(len(counts)), n)
                piece = runs(n)
                start = piece * capacity
                length = np.minimum(counts[row] - start, capacity)
                at = first[row] + start
                data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                crc = np.fromiter((zlib.crc32(data[4 * a:4 * (a + m)])
                                   for a, m in zip(at.tolist(), length.tolist())), np.int64, len(at))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)),
                     pa.array(start), pa.array(length), pa.array(crc)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Steps (length, first rank, count, first sequence, offset) that place all pieces.

    ``counts``: pieces of each length.  Gaps hold runs (first sequence, count).
    """
    steps = []
    gaps: dict[int, list[list[int]]] = defaultdict(list)
    opened = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        gap = length
        while left:
            while gap <= capacity and not gaps.get(gap):
                gap += 1
            if gap > capacity:
                # no successor: open as many as the rest needs, each filled with this length
                n = -(-left // (capacity // length))
                gaps[capacity].append([opened, n])
                opened += n
                gap = length
                continue
            run = gaps[gap][-1]
            n = min(left, run[1])
            steps.append((length, rank, n, run[0], capacity - gap))
            gaps[gap - length].append([run[0], n])
            run[0] += n
            run[1] -= n
            if not run[1]:
                gaps[gap].pop()
            rank += n
            left -= n
            gap = length if gap - length >= length else gap
    return steps


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (any columns; ``length`` 1..capacity)."""
    spark = pieces.sparkSession
    fixed = written(pieces.withColumn(
        "_b", F.pmod(F.xxhash64(*pieces.columns), F.lit(RANK_BUCKETS)).cast("int")), "pieces")
    sizes = written(fixed.groupBy("length", "_b").count(), "piece-counts")
    per_length = sizes.groupBy("length").agg(F.sum("count").alias("n")).collect()  # <= capacity rows
    steps = sweep({r["length"]: r["n"] for r in per_length}, capacity)
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("length", "_b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    ranked = (fixed.join(first, ["length", "_b"])
              .withColumn("_rank", F.col("_first") - 1 + F.row_number().over(
                  Window.partitionBy("length", "_b").orderBy(*pieces.columns))))
    plan = np.array(steps, np.int64).reshape(-1, 5)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    # at most a few records for each of the `capacity` lengths and gaps, whatever the input
    shared = spark.sparkContext.broadcast(plan)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        key = plan[:, 0] * (1 << 44) + plan[:, 1]
        for batch in batches:
            rank = batch.column("_rank").to_numpy().astype(np.int64)
            length = batch.column("length").to_numpy().astype(np.int64)
            at = np.searchsorted(key, length * (1 << 44) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(plan[at, 3] + rank - plan[at, 1]),
                 pa.array(plan[at, 4])], names=[*names, "sequence_id", "offset"])

    names = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, tokenizer, capacity), capacity)
