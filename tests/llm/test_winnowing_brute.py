"""Winnowing against plain loops: each gram hashed alone, each window looked at whole."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from commerce_marts.llm import winnowing
from commerce_marts.llm.common import mixed, rolling, ship

K, W = winnowing.K, winnowing.W


def gram_hash(gram: str) -> int:
    codes = np.array([ord(c) for c in gram], np.uint64) + np.uint64(1)
    return int(rolling(codes, len(gram))[0]) >> winnowing.POSITION_BITS


def plain(text: str, k: int = K, w: int = W) -> list[tuple[int, int]]:
    """(position, hash) of the smallest gram of every window, the rightmost of equal ones."""
    if not text:
        return []
    if len(text) < k:
        codes = np.array([ord(c) for c in text], np.uint64) + np.uint64(1)
        whole = mixed(rolling(codes, len(text)) + np.uint64(len(text)))
        return [(0, int(whole[0]) >> winnowing.POSITION_BITS)]
    hashes = [gram_hash(text[i:i + k]) for i in range(len(text) - k + 1)]
    kept = {}
    for a in range(max(1, len(hashes) - w + 1)):
        best = min(range(a, min(a + w, len(hashes))), key=lambda i: (hashes[i], -i))
        kept[best] = hashes[best]
    return sorted(kept.items())


def texts() -> list[str]:
    rng = random.Random(7)
    sizes = [0, 1, K - 1, K, K + 1, W + K - 2, W + K - 1, W + K, 300, 900]
    out = ["".join(rng.choices(alphabet, k=n)) for n in sizes for alphabet in ("a", "ab", "abcdé 𝄞")]
    return out + ["ab" * 200, "x" * 500, "abc" * 30 + "z" + "abc" * 60]


def got(text: str, k: int = K, w: int = W) -> list[tuple[int, int]]:
    (hashes, places), = winnowing.winnow([text], k, w)
    return list(zip(places.tolist(), hashes.tolist()))


def test_every_window_keeps_its_rightmost_smallest_gram():
    for text in texts():
        assert got(text) == plain(text)
        assert got(text, 4, 6) == plain(text, 4, 6)
    together = winnowing.winnow(texts())
    assert [list(zip(p.tolist(), h.tolist())) for h, p in together] == list(map(plain, texts()))


def test_ties_go_right():
    places = [p for p, _ in got("x" * 200)]
    assert places == list(range(W - 1, 200 - K + 1))


@pytest.mark.parametrize("part", [2 * (W + K), 257, 1000])
def test_long_texts_in_parts_are_as_one(monkeypatch, part):
    rng = random.Random(part)
    text = "".join(rng.choices("abc ", k=3000)) + "y" * 400 + "ab" * 300
    whole = plain(text)
    monkeypatch.setattr(winnowing, "PART", part)
    assert got(text) == whole


def test_texts_that_share_a_window_share_a_fingerprint():
    rng = random.Random(3)
    for _ in range(60):
        passage = "".join(rng.choices("abcdefgh ", k=W + K - 1))
        ends = ["".join(rng.choices("abcdefgh ", k=rng.randint(0, 200))) for _ in range(4)]
        a, b = (dict(got(ends[i] + passage + ends[i + 1])) for i in (0, 2))
        assert set(a.values()) & set(b.values())
        at = len(ends[0])
        assert any(at <= p <= at + W - 1 for p in a)


def test_documents_against_their_edits_and_successors(spark):
    ship(spark)
    bodies = texts() + [None, "tail " * 40]
    rows = [(i * 3, t) for i, t in enumerate(bodies)]
    random.Random(2).shuffle(rows)
    found = {r["doc_id"]: r for r in winnowing.fingerprints(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert len(found) == len(rows)

    def alike(a, b):
        x, y = ({h for _, h in plain(t)} for t in (a, b))
        return len(x & y) / len(x | y) if x | y else 1.0

    shown = lambda t: " ".join(f"{p}:{h:010x}" for p, h in plain(t))
    for i, body in enumerate(bodies):
        text, after = body or "", bodies[(i + 1) % len(bodies)] or ""
        n = len(text) // 4
        edited = text[:len(text) - n] + after[:n]
        r = found[i * 3]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (shown(text), shown(edited))
        assert r["near_edited"] == pytest.approx(alike(text, edited))
        assert r["near_next"] == pytest.approx(alike(text, after))
