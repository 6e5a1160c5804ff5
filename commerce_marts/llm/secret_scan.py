"""Secrets in texts: fixed patterns, and strings that a character model calls random.

The base patterns (``assign``, ``access``, ``hex``) are matched as given.  What they match is
the labelled sample of random strings; every other run of at least ``TRAIN_CHARS`` letters,
digits and ``+/_-`` that touches no match is one of an ordinary identifier.  Two Markov
models of order 2 over these characters learn from the runs of all documents.  A run of at
least ``SCAN_CHARS`` is a secret (kind ``markov``) if the log-likelihood ratio of the models
passes ``MARGIN`` and it overlaps no base match; base matches always stay.

The identifier model backs off to shorter contexts.  The random one is mixed half and half
with the uniform distribution: the base patterns show mostly hex digits, and other random
alphabets have to be found as well.

Only the transition counts, at most 2 x 67^3 of them whatever the corpus, reach the driver.

Nulls: a null text is an empty text; a null doc_id is kept.  Empty texts and texts without
runs have no spans.  Repeated rows are scanned each.  Without any base match the random
model is uniform.  An empty table gives no rows.  Texts are read whole, at any length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_marts.llm.common import runs, text_slices

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
# the shorter matches that a pattern without the count would drop can't hide longer ones here
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Texts without these (RE2, a superset) are not given to the patterns above.
MAY_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
MAY_ACCESS, MAY_HEX = "AKIA[A-Z0-9]{16}", "[0-9a-f]{24}"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_CHARS = 6
TRAIN_CHARS, SCAN_CHARS = 8, 16
#: Natural logarithm of the odds that a run must have: about a million to one.
MARGIN = 14.0
#: Weight of the shorter context, in observations.  It is large because secrets without a base
#: match are among the identifiers' samples: a few copies of one must not make it likely.
BACKOFF = 1000.0
SLICE = 4 << 20

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
K = len(ALPHABET) + 1
_CODE = np.zeros(256, np.uint8)  # 0 is the edge of a run
_CODE[np.frombuffer(ALPHABET, np.uint8)] = np.arange(1, K)


def base_spans(text: str, kinds=KINDS) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, value start, value end) of every base match, in order."""
    out = []
    if "assign" in kinds:
        out += [(m.start(), 0, m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    if "access" in kinds:
        out += [(m.start(), 1, m.end(), m.start(), m.end()) for m in ACCESS.finditer(text)]
    if "hex" in kinds:
        out += [(m.start(), 2, m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out)


@dataclass
class Runs:
    """Runs of a slice: text of each, code point bounds in it, and bounds in ``data``."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    at: np.ndarray
    size: np.ndarray
    data: np.ndarray

    def kept(self, mask: np.ndarray) -> "Runs":
        return Runs(self.doc[mask], self.start[mask], self.end[mask], self.at[mask],
                    self.size[mask], self.data)

    def transitions(self) -> tuple[np.ndarray, np.ndarray]:
        """Index of every transition of the runs, and which run it belongs to."""
        of = np.repeat(np.arange(len(self.at)), self.size)
        place = runs(self.size)
        at = np.repeat(self.at, self.size) + place
        code = _CODE[self.data[at]].astype(np.int64)
        one = np.where(place > 0, np.concatenate([[0], code[:-1]]), 0) if len(code) else code
        two = np.where(place > 1, np.concatenate([[0, 0], code[:-2]])[:len(code)], 0)
        return (two * K + one) * K + code, of


def found_runs(texts: pa.Array, least: int) -> Runs:
    """Runs of at least ``least`` characters of the alphabet in an array of strings."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0]:offsets[-1]] if buffer else np.zeros(0, np.uint8)
    bounds = (offsets - offsets[0]).astype(np.int64)
    inside = _CODE[data] > 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = bounds[(bounds > 0) & (bounds < len(data))]
    first[edge] |= inside[edge]
    last[edge - 1] |= inside[edge - 1]
    at, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = stop - at >= least
    at, stop = at[long], stop[long]
    doc = np.searchsorted(bounds, at, "right") - 1
    # code points before a byte: those that begin before it
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)])
    start = points[at] - points[bounds[doc]]
    return Runs(doc, start, start + stop - at, at, stop - at, data)


def _strings(texts: pa.Array) -> pa.Array:
    return pc.fill_null(texts, "").cast(pa.string())


def _base(texts: pa.Array) -> dict[int, list]:
    """Base matches of the texts that have any."""
    may = {k: pc.match_substring_regex(texts, p).to_numpy(zero_copy_only=False)
           for k, p in (("assign", MAY_ASSIGN), ("access", MAY_ACCESS), ("hex", MAY_HEX))}
    out = {}
    for i in np.flatnonzero(np.any(list(may.values()), axis=0)).tolist():
        spans = base_spans(texts[i].as_py(), [k for k in may if may[k][i]])
        if spans:
            out[i] = spans
    return out


def _free(found: Runs, base: dict[int, list]) -> np.ndarray:
    """Which runs overlap no base match."""
    free = np.ones(len(found.doc), bool)
    for i, spans in base.items():
        a, b = np.searchsorted(found.doc, [i, i + 1])
        for start, _, end, _, _ in spans:
            free[a:b] &= (found.end[a:b] <= start) | (found.start[a:b] >= end)
    return free


def _random_samples(texts: pa.Array, base: dict[int, list]) -> pa.Array:
    values = []
    for i, spans in base.items():
        text = texts[i].as_py()
        values += [text[a:b] for _, _, _, a, b in spans]
    return pa.array(values, pa.string())


def transition_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the transitions in random strings and in identifiers, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, K ** 3), np.int64)
        for batch in batches:
            for part in text_slices(batch, max_bytes=SLICE):
                texts = _strings(part.column("text"))
                base = _base(texts)
                found = found_runs(texts, TRAIN_CHARS)
                for label, sample in ((1, found.kept(_free(found, base))),
                                      (0, found_runs(_random_samples(texts, base), ASSIGN_CHARS))):
                    total[label] += np.bincount(sample.transitions()[0], minlength=K ** 3)
        label, index = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(index), pa.array(total[label, index])],
                                         names=["label", "index", "n"])

    rows = (docs.select(F.col("text").cast("string").alias("text"))
            .mapInArrow(count, "label long, index long, n long").groupBy("label", "index")
            .agg(F.sum("n").alias("n")).toArrow())
    total = np.zeros((2, K ** 3))
    total[rows["label"].to_numpy(), rows["index"].to_numpy()] = rows["n"].to_numpy()
    return total[0], total[1]


def _backed_off(counts: np.ndarray) -> np.ndarray:
    """P(c | the two before), each order smoothed by the next shorter one, the last by uniform."""
    third = counts.reshape(K, K, K)
    p = np.full(K, 1 / (K - 1))
    for n in (third.sum((0, 1)), third.sum(0), third):
        p = (n + BACKOFF * p) / (n.sum(-1, keepdims=True) + BACKOFF)
    return p


def ratios(random: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of every transition."""
    chance = 0.5 * _backed_off(random) + 0.5 / (K - 1)
    return np.log(chance / _backed_off(ordinary)).ravel()


def scan(docs: DataFrame, ratio: np.ndarray, margin: float = MARGIN) -> DataFrame:
    """doc_id, found: array of (start, kind, end), kind an index of ``KINDS``, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)  # 67^3 numbers

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, max_bytes=SLICE):
                texts = _strings(part.column("text"))
                base = _base(texts)
                found = found_runs(texts, SCAN_CHARS)
                index, of = found.transitions()
                score = np.bincount(of, shared.value[index], minlength=len(found.doc))
                added = found.kept((score > margin) & _free(found, base))
                spans = {i: [s[:3] for s in own] for i, own in base.items()}
                for i, a, b in zip(added.doc.tolist(), added.start.tolist(), added.end.tolist()):
                    spans.setdefault(i, []).append((a, 3, b))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(
                        [[dict(zip(("start", "kind", "end"), s)) for s in sorted(spans.get(i, ()))]
                         for i in range(part.num_rows)], _FOUND)], names=["doc_id", "found"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        find, "doc_id long, found array<struct<start: int, kind: int, end: int>>")


_FOUND = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))


def find_secrets(docs: DataFrame) -> DataFrame:
    """``scan`` of all documents with models of all documents."""
    return scan(docs, ratios(*transition_counts(docs)))


def joined(found) -> F.Column:
    """kind:start:end of spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))
