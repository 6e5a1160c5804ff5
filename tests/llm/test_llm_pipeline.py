"""The pipeline's stages, each on what its predecessor kept."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
from commerce_marts.llm import surrogates
from commerce_marts.llm.common import table, written
from commerce_marts.llm.packing import CAPACITY

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], SF), f"test-{name}"))
    assert all(f.columns == docs.columns for f in frames[:5])
    ids = [Counter(r["doc_id"] for r in f.select("doc_id").collect()) for f in frames]
    assert set(ids[1]) <= set(ids[0]) and set(ids[2]) <= set(ids[1])
    texts = [r["text"] for r in frames[2].collect() if (r["text"] or "").split()]
    assert len(texts) == len(set(texts))
    before = {r["doc_id"]: r["text"] for r in frames[2].collect()}
    for r in frames[3].collect():
        text = before[r["doc_id"]]
        assert r["text"] == (None if text is None else surrogates.replaced(text)[0])
    assert ids[3] == ids[2] and set(ids[4]) <= set(ids[3])
    pieces = frames[5].collect()
    assert Counter(r["doc_id"] for r in pieces if r["piece"] == 0) == ids[4]
    filled = defaultdict(int)
    for r in pieces:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= CAPACITY
