"""Units that the toxicity machine learns from and scores."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from commerce_marts.llm import toxicity
from commerce_marts.llm.common import ship


def test_long_words_are_learned_in_the_pieces_that_are_scored(spark):
    ship(spark)
    rng = random.Random(1)
    runs = {i: "".join(rng.choices("abcdefgh", k=n)) for i, n in enumerate([1, 2, 39, 40, 41, 60, 200, 5000])}
    docs = spark.createDataFrame([(i, 0, f"{t} so") for i, t in runs.items()], "doc_id long, toxic int, text string")
    got = {(r["doc_id"], r["word"]) for r in toxicity._document_words(docs).collect()}
    assert got == {(i, p) for i, t in runs.items() for p in [*toxicity.pieces(t), "so"] if len(p) > 1}
    assert all("".join(p[:20] for p in toxicity.pieces(t)) == t for t in runs.values() if len(t) > 40)


@pytest.mark.parametrize("text, joined", [
    ("so i - d - i - o - t no", "idiot"), ("x s c u m", "xscum"), ("a . b", None), ("i-d-i-o-t", "idiot"),
    ("b 1 2 a ... d", "bad")])
def test_letters_are_joined_over_tokens_without_letters(text, joined):
    names, idx, doc = toxicity.spellings(pa.array(["a b", text, "c d", None, "e"]))
    own = {names[i] for i, d in zip(idx, doc) if d == 1}
    assert (joined in own) if joined else not any(len(w) > 1 for w in own)
    assert not any(len(names[i]) > 1 for i, d in zip(idx, doc) if d != 1)


def test_insults_late_in_unspaced_runs_are_learned(spark):
    ship(spark)
    rng = random.Random(2)
    run = lambda k: "".join(rng.choice(["an", "the", "ver", "ing", "lo", "mu", "ra"]) for _ in range(k))
    texts, marks = [], []
    for i in range(500):
        bad = i % 3 == 0
        texts.append((i, run(30) + ("scumbagged" if bad else "") + run(30)))
        marks.append((i, int(bad)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, labels).collect() if r["held_out"]}
    assert sum(got[i] == y for i, y in marks if i in got) / len(got) > 0.9


def test_landmarks_are_those_of_the_whole_table_in_less_memory():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 25))) for _ in range(700)] + ["aaaaaaa", "abab" * 9]
    tracemalloc.start()
    got = toxicity.landmarks(words, 60)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    table = toxicity.Kernel(words).table
    assert peak < table.nbytes / 4
    left, factor, want = (table ** 2).sum(0), np.zeros((len(words), 0)), []
    for k in range(60):
        i = int(np.argmax(left)) if k else 0
        new = (table[:, i] @ table - factor @ factor[i]) / np.sqrt(left[i])
        factor, left = np.column_stack([factor, new]), left - new ** 2
        left[i] = -1
        want.append(words[i])
    assert got == want
