"""Toxicity by a subsequence string-kernel support vector machine.

Kernel: gap-weighted subsequences of 3 and 4 characters of a lower-cased word
(with marks at its start and end) that span at most ``SPAN`` characters; every
skipped character costs ``DECAY``, so an insult with gaps or inserted characters
stays close to the plain one.  A word's kernel is scaled by what a word of its
length can reach.  Characters that are no letters are dropped inside a word, and
runs of three or more single letters, over tokens without letters too, are read
as one word more.  A long word is learned from and scored in the same overlapping
pieces.

Training: a bounded sample of labelled documents (``MAX_DOCS`` of each class, the
first by a hash of doc_id).  Words of sentences in clean documents are clean; a
toxic document holds at least one toxic word, its witness: at first the one with
the best odds, then the one that scores best.  Landmarks are picked by pivoted
Cholesky; a squared-hinge machine is trained on the Nystroem features, with hard
negatives added.  As the machine is linear in the features and these in the
subsequences, it folds into one weight for each subsequence of a landmark.  A
document's margin is its best word's; the margins of sampled documents that took
no part in the fit turn it into a probability.

Nulls: a null text is an empty text, which gets the margin of a word without
known subsequences.  Rows with a null doc_id or without a label are scored, not
learned from.  Repeated rows are scored alike.  Without toxic or without clean
training documents the score is 0 or 1 throughout (0 where both lack).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_marts.llm.common import encoded, shielded, text_slices, words, written

SPAN = 6
DECAY = 0.6
#: Documents of each class that the fit and its calibration may use.
MAX_DOCS = 4000
#: Clean words that the fit may see, landmarks, witnesses kept for a document.
MAX_CLEAN_WORDS = 60_000
LANDMARKS = 192
WITNESSES = 6
THRESHOLD = 0.7
#: Longer words are cut into overlapping pieces of this many characters.
PIECE = 40
#: Distinct words scored at a time, and words a Python worker keeps scored.
BLOCK = 4096
CACHED = 400_000

#: Positions of a subsequence after its first character, and its weight.
_SHAPES = [(s, DECAY ** (s[-1] - len(s))) for n in (2, 3) for s in combinations(range(1, SPAN), n)]
_P = np.uint64(0x100000001B3)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def subsequences(chosen: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence hash, weight) of all words; weights are scaled by the length."""
    marked = [f"^{w}$" for w in chosen]
    size = max(map(len, marked), default=0) + SPAN
    codes = np.zeros((len(marked), size), np.uint64)
    flat = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
    n = np.fromiter(map(len, marked), np.int64, len(marked))
    codes[np.repeat(np.arange(len(n)), n),
          np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = flat
    rows, keys, weights = [], [], []
    total = np.zeros(len(marked))
    with np.errstate(over="ignore"):
        for shape, weight in _SHAPES:
            width = size - SPAN
            key, last = codes[:, :width] * _P, codes[:, shape[-1]:shape[-1] + width]
            for s in shape:
                key = (key + codes[:, s:s + width]) * _P
            r, c = np.nonzero((last > 0) & (codes[:, :width] > 0))
            rows.append(r)
            keys.append(key[r, c] + np.uint64(len(shape)))
            weights.append(np.full(len(r), weight))
            total += np.bincount(r, minlength=len(n)) * weight ** 2
    row = np.concatenate(rows)
    return row, np.concatenate(keys), np.concatenate(weights) / np.sqrt(np.maximum(total, 1e-9))[row]


class Kernel:
    """Values of the kernel between words and fixed landmarks."""

    def __init__(self, landmarks: list[str]):
        row, key, weight = subsequences(landmarks)
        self.keys, at = np.unique(key, return_inverse=True)
        self.table = np.zeros((len(self.keys), len(landmarks)))
        np.add.at(self.table, (at, row), weight)

    def __call__(self, chosen: list[str]) -> np.ndarray:
        return np.concatenate([project(chosen[a:a + 256], self.keys, self.table)
                               for a in range(0, len(chosen), 256)]
                              or [np.zeros((0, self.table.shape[1]))])


def project(chosen: list[str], keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    row, key, weight = subsequences(chosen)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    hit = keys[at] == key
    row, at, weight = row[hit], at[hit], weight[hit]
    if table.ndim == 1:
        return np.bincount(row, weight * table[at], minlength=len(chosen))
    out = np.zeros((len(chosen), table.shape[1]))
    order = np.argsort(row, kind="stable")
    row = row[order]
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    if len(row):
        out[row[starts]] = np.add.reduceat(weight[order, None] * table[at[order]], starts)
    return out


def spellings(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words as read by the kernel, the index and the text of each word."""
    flat, counts = words(texts)
    doc = np.repeat(np.arange(len(counts)), counts)
    distinct, idx = encoded(flat)
    names = pc.replace_substring_regex(pc.utf8_lower(distinct), r"\P{L}+", "").to_pylist()
    single = np.fromiter((len(x) == 1 for x in names), bool, len(names))[idx] if len(idx) else \
        np.zeros(0, bool)
    if single.any():
        # tokens without letters, as in i - d - i - o - t, don't end a run
        lettered = np.flatnonzero(np.fromiter((len(x) > 0 for x in names), bool, len(names))[idx])
        single, run_idx, run_doc = single[lettered], idx[lettered], doc[lettered]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], single, [False]]).astype(np.int8)))
        more, of = [], []
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            for part in np.split(np.arange(a, b), np.flatnonzero(np.diff(run_doc[a:b])) + 1):
                if len(part) >= 3:
                    more.append("".join(names[run_idx[i]] for i in part))
                    of.append(int(run_doc[part[0]]))
        idx = np.concatenate([idx, np.arange(len(names), len(names) + len(more))])
        doc = np.concatenate([doc, np.array(of, np.int64)])
        names = names + more
    return names, idx, doc


def pieces(word: str) -> list[str]:
    """A word as the fit and the scorer read it: whole, or in overlapping pieces if long."""
    if len(word) <= PIECE:
        return [word]
    return [word[i:i + PIECE] for i in range(0, len(word), PIECE // 2)]


class Scorer:
    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float):
        self.keys, self.weights, self.bias = keys, weights, bias
        self.known: dict[str, float] = {}

    def words(self, names: list[str]) -> np.ndarray:
        new = list({w for w in names if w not in self.known})
        if len(self.known) > CACHED:
            self.known.clear()
            new = list(set(names))
        short = [w for w in new if len(w) <= PIECE]
        short.sort(key=len)
        for a in range(0, len(short), BLOCK):
            part = short[a:a + BLOCK]
            self.known.update(zip(part, project(part, self.keys, self.weights).tolist()))
        for w in new:
            if len(w) > PIECE:
                best = -np.inf
                for a in range(0, len(w), PIECE // 2 * 1000):
                    block = w[a:a + PIECE // 2 * 1001]
                    best = max(best, float(project(pieces(block), self.keys, self.weights).max()))
                self.known[w] = best
        return np.fromiter((self.known[w] for w in names), float, len(names)) + self.bias

    def texts(self, texts: pa.Array) -> np.ndarray:
        names, idx, doc = spellings(texts)
        out = np.full(len(texts), self.bias)
        if len(idx):
            np.maximum.at(out, doc, self.words(names)[idx])
        return out


def margins(docs: DataFrame, model, columns: list[str]) -> DataFrame:
    """The margin of every row's text beside ``columns``."""
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model.value)
        for batch in batches:
            for part in text_slices(batch, "_text"):
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in columns), pa.array(scorer.texts(part.column("_text")))],
                    names=[*columns, "margin"])

    return docs.select(*columns, F.col("text").cast("string").alias("_text")).mapInArrow(
        score, f"{fields}, margin double")


def _document_words(docs: DataFrame) -> DataFrame:
    """doc_id, toxic, word: the distinct words of each document."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                names, idx, doc = spellings(part.column("text"))
                pair = np.unique(np.stack([doc, idx]), axis=1)
                own = [pieces(w) for w in names]
                first = np.cumsum([0, *map(len, own)])
                flat = pa.array([p for ps in own for p in ps], pa.string())
                size = np.diff(first)[pair[1]]
                ends = np.cumsum(size)
                for a in range(0, len(size), BLOCK):  # pieces of so many words at a time
                    n = size[a:a + BLOCK]
                    row = pa.array(np.repeat(pair[0][a:a + BLOCK], n))
                    at = np.arange(n.sum()) - np.repeat(ends[a:a + BLOCK] - n - (ends[a] - size[a]), n)
                    word = flat.take(pa.array(np.repeat(first[pair[1][a:a + BLOCK]], n) + at))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(row), part.column("toxic").take(row), word],
                        names=["doc_id", "toxic", "word"])

    return docs.select("doc_id", "toxic", F.col("text").cast("string")).mapInArrow(
        split, "doc_id long, toxic int, word string").where("length(word) > 1").distinct()


class Columns:
    """The table of ``Kernel`` by its entries that are not zero: rows are subsequences, columns words.

    As an array it would take as many numbers as subsequences times words."""

    def __init__(self, chosen: list[str]):
        col, key, weight = subsequences(chosen)
        _, key = np.unique(key, return_inverse=True)
        order = np.lexsort((col, key))  # keeps the order of a word's equal subsequences
        col, key, weight = col[order], key[order], weight[order]
        cell = np.cumsum(np.diff(key, prepend=-1).astype(bool) | np.diff(col, prepend=-1).astype(bool)) - 1
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        self.row, self.col, self.value = key[first], col[first], np.bincount(cell, weight)
        self.starts = np.searchsorted(self.row, np.arange((self.row[-1] if len(self.row) else -1) + 2))
        self.by_word = np.argsort(self.col, kind="stable")
        self.of_word = np.searchsorted(self.col[self.by_word], np.arange(len(chosen) + 1))

    def squares(self, n: int) -> np.ndarray:
        """The sum of squares of each column."""
        return np.bincount(self.col, self.value ** 2, minlength=n)

    def products(self, i: int, n: int) -> np.ndarray:
        """The products of column ``i`` with all ``n``, from its own rows alone."""
        own = self.by_word[self.of_word[i]:self.of_word[i + 1]]
        begin, size = self.starts[self.row[own]], np.diff(self.starts)[self.row[own]]
        at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        rows = np.zeros((len(own), n))
        rows[np.repeat(np.arange(len(own)), size), self.col[at]] = self.value[at]
        return self.value[own] @ rows


def landmarks(chosen: list[str], most: int) -> list[str]:
    """Pivoted Cholesky: each next landmark is the word that those before explain least."""
    left = np.ones(len(chosen))
    factor = np.zeros((len(chosen), 0))
    out: list[str] = []
    columns = Columns(chosen) if len(chosen) else None
    for _ in range(min(most, len(chosen))):
        i = int(np.argmax(left))
        if left[i] < 1e-3:
            break
        column = columns.products(i, len(chosen))
        if not out:
            left = columns.squares(len(chosen))
        new = (column - factor @ factor[i]) / np.sqrt(max(left[i], 1e-9))
        factor = np.column_stack([factor, new])
        left = left - new ** 2
        left[i] = -1
        out.append(chosen[i])
    return out


def machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 20.0) -> np.ndarray:
    """Squared-hinge machine in the primal by Newton steps; the last entry is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(30):
        active = y * (x @ w) < 1
        xa = x[active] * weight[active, None] * c
        new = np.linalg.solve(ridge + xa.T @ x[active], xa.T @ y[active])
        if np.abs(new - w).max() < 1e-7:
            break
        w = new
    return w


def platt(margin: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability, both classes weighing the same."""
    n1, n0 = max(1, toxic.sum()), max(1, (1 - toxic).sum())
    t = np.where(toxic == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(toxic == 1, 0.5 / n1, 0.5 / n0)
    x = np.column_stack([margin, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - t)) + 1e-4 * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS):
    """(keys, weights, bias, slope, offset) of the machine, or the constant score."""
    spark = docs.sparkSession
    marked = labels.where("doc_id is not null and toxic is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    marked = marked.where(~held_out()).withColumn("_h", F.xxhash64("doc_id"))
    sample = None
    for toxic in (0, 1):
        part = marked.where(F.col("toxic") == toxic).orderBy("_h", "doc_id").limit(max_docs)
        sample = part if sample is None else sample.unionByName(part)
    # at most 2 * max_docs rows of numbers, so a broadcast of known size
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(sample), "doc_id"), "toxicity-sample")
    present = {r["toxic"] for r in rows.select("toxic").distinct().collect()}
    if present != {0, 1}:
        return 1.0 if present == {1} else 0.0
    learn = written(_document_words(rows.where("pmod(_h, 3) <> 0")), "toxicity-words")
    stats = learn.groupBy("word").agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0"))
    odds = F.log((F.col("n1") + 0.1) / (F.col("n0") + 0.5))
    best = Window.partitionBy("doc_id").orderBy(F.desc("odds"), "word")
    ranked = (learn.where("toxic = 1").join(stats.withColumn("odds", odds), "word")
              .withColumn("r", F.row_number().over(best)).where(F.col("r") <= WITNESSES))
    bags: dict = {}
    for r in ranked.orderBy("doc_id", "r").select("doc_id", "word").collect():  # max_docs * WITNESSES
        bags.setdefault(r["doc_id"], []).append(r["word"])
    clean = [r["word"] for r in stats.where("n0 > 0").orderBy(F.xxhash64("word"), "word").limit(
        MAX_CLEAN_WORDS).select("word").collect()]
    witness = {d: w[0] for d, w in bags.items()}
    if not clean or not bags:
        return float(not clean)
    hard: list[str] = []
    for last in (False, False, True):
        count: dict[str, int] = {}
        for w in witness.values():
            count[w] = count.get(w, 0) + 1
        seen = sorted(count, key=lambda w: (-count[w], w))
        plain = clean[:4000] + hard
        marks = landmarks([*seen[:600], *hard[:300], *clean[:300]], LANDMARKS)
        kernel = Kernel(marks)
        values, vectors = np.linalg.eigh(kernel(marks))
        fine = values > 1e-6
        whiten = vectors[:, fine] / np.sqrt(values[fine])
        x = kernel([*seen, *plain]) @ whiten
        y = np.concatenate([np.ones(len(seen)), -np.ones(len(plain))])
        weight = np.concatenate([np.sqrt([count[w] for w in seen]), np.ones(len(plain))])
        w = machine(x, y, weight)
        scorer = Scorer(kernel.keys, kernel.table @ (whiten @ w[:-1]), float(w[-1]))
        if last:
            break
        f = scorer.words(clean)
        hard = list(dict.fromkeys([*hard, *(clean[i] for i in np.argsort(-f)[:1500])]))
        scorer.words([w for own in bags.values() for w in own])  # all at once: kept for the loop
        for d, own in bags.items():
            witness[d] = own[int(np.argmax(scorer.words(own)))]
    model = spark.sparkContext.broadcast((scorer.keys, scorer.weights, scorer.bias))
    # at most 2 * max_docs numbers; of all the sample's toxic rows and the clean rows not fitted on
    found = margins(rows.where("toxic = 1 or pmod(_h, 3) = 0"), model, ["toxic"]).collect()
    slope, offset = platt(np.array([r["margin"] for r in found]),
                          np.array([r["toxic"] for r in found]))
    return scorer.keys, scorer.weights, scorer.bias, slope, offset


def score(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    model = fit(docs, labels, max_docs)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if isinstance(model, float):
        scored = base.select("doc_id", F.lit(model).alias("score"))
    else:
        *parts, slope, offset = model
        shared = docs.sparkSession.sparkContext.broadcast(parts)  # subsequences of the landmarks
        scored = margins(base, shared, ["doc_id"]).select("doc_id", (
            1 / (1 + F.exp(-(F.lit(slope) * F.col("margin") + F.lit(offset))))).alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, with their columns."""
    model = fit(docs, labels, max_docs)
    if isinstance(model, float):
        return docs if model < THRESHOLD else docs.limit(0)
    *parts, slope, offset = model
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    score = 1 / (1 + F.exp(-(F.lit(slope) * F.col("margin") + F.lit(offset))))
    return shielded(docs, ("text",), lambda d: margins(d, shared, d.columns).where(score < THRESHOLD))
