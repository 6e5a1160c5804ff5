"""op10's model of any order against a plain recursive one."""

from __future__ import annotations

import collections
import math
import zlib

import numpy as np
import pytest

from commerce_marts.llm import katz
from commerce_marts.llm.common import ship
from tests.llm.test_llm_operators import SCHEMA, WORD, corpus


class Plain:
    """Counts in dictionaries; P_k evaluated by recursion."""

    def __init__(self, texts, order):
        self.counts = {k: collections.Counter() for k in range(1, order + 1)}
        for t in texts:
            t = ["<s>"] * (order - 1) + t
            for i in range(order - 1, len(t)):
                for k in range(1, order + 1):
                    self.counts[k][tuple(t[i - k + 1:i + 1])] += 1
        self.n, self.v = sum(self.counts[1].values()), len(self.counts[1])
        self.d, self.after = {}, {}
        for k in range(2, order + 1):
            n_r = collections.Counter(self.counts[k].values())
            self.d[k] = katz.discounts([n_r[r] for r in range(katz.MAX_R + 2)])
            self.after[k] = collections.defaultdict(list)
            for g in self.counts[k]:
                self.after[k][g[:-1]].append(g[-1])

    def cut(self, k, c):
        return c * (self.d[k][c] if c <= katz.MAX_R else 1)

    def p(self, h, w):
        k = len(h) + 1
        if k == 1:
            return (self.counts[1][w,] + 0.1) / (self.n + 0.1 * (self.v + 1))
        seen = self.after[k].get(h)
        if not seen:
            return self.p(h[1:], w)
        c_h = sum(self.counts[k][*h, x] for x in seen)
        mass = sum(self.cut(k, self.counts[k][*h, x]) for x in seen)
        scale = c_h / (c_h + 1) if mass > c_h * (1 - 1e-9) else 1
        if self.counts[k][*h, w]:
            return scale * self.cut(k, self.counts[k][*h, w]) / c_h
        rest = 1 - sum(self.p(h[1:], x) for x in seen)
        return (1 - scale * mass / c_h) / rest * self.p(h[1:], w)


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def plain_rows(rows, order):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = [(i, [*WORD.findall((t or "").translate(table)), "</s>"]) for i, t, *_ in rows]
    model = Plain([t for i, t in texts if not held(i)], order)
    out = []
    for i, t in texts:
        padded = ["<s>"] * (order - 1) + t
        out.append((i, len(t), sum(
            math.log10(model.p(tuple(padded[j:j + order - 1]), w)) for j, w in enumerate(t))))
    return model, sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    """Short texts of few words, so that every order has seen and unseen n-grams."""
    words = "a b c d".split()
    some = [(100 + i, " ".join(words[(i * j + j * j + i // 7) % 4] for j in range(i % 9)), "en", "s", 0, 0)
            for i in range(60)]
    return [r for r in corpus() if r[0] != 40] + some


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_equal_a_recursive_model(spark, rows, order):
    ship(spark)
    model, want = plain_rows(rows, order)
    for k in range(2, order + 1):
        for h in list(model.after[k])[:20]:
            every = [w for w, in model.counts[1]]
            assert abs(sum(model.p(h, w) for w in [*every, "unknown"]) - 1) < 1e-9
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(((r.doc_id, r.n_tokens, r.score) for r in katz.score(docs, order).collect()), key=str)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    np.testing.assert_allclose([r[2] for r in got], [r[2] for r in want], rtol=1e-9)


def test_order_one_is_the_base_and_none_is_an_error(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for r in katz.score(docs, 1).collect():
        assert r.score == pytest.approx(r.base_score, rel=1e-12)
    with pytest.raises(ValueError):
        katz.score(docs, 0)


def test_an_empty_table_gives_no_rows(spark):
    assert katz.score(spark.createDataFrame([], SCHEMA), 3).collect() == []


def test_chunks_and_buckets_change_nothing(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, SCHEMA)
    key = lambda r: (str(r.doc_id), r.score)
    once = sorted(katz.score(docs.coalesce(1), 3).collect(), key=key)
    monkeypatch.setattr(katz, "CHUNK_BYTES", 300)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 50)
    many = sorted(katz.score(docs.repartition(5), 3).collect(), key=key)
    assert [r.doc_id for r in once] == [r.doc_id for r in many]
    np.testing.assert_allclose([r.score for r in once], [r.score for r in many], rtol=1e-9)
