"""Users' columns that helpers are called like, scores beyond 64 bits, long addresses and keys."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from commerce_marts.llm import mixing, ngram_join, surrogates, topk, toxicity
from commerce_marts.llm.common import ship

EXTRA = ("_c", "_h", "_n", "_key", "_entities", "margin", "_copies", "_rank", "size", "row", "some.dot")


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    rows = [(i, f"word{i} of some text that is long enough to have five words {i % 7}", "s") for i in range(30)]
    rows += [(100, rows[0][1], "s"), (None, None, None), (101, "", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.select("*", *(F.concat(F.lit(f"user{i}-"), F.coalesce("doc_id", F.lit(-1))).alias(c)
                            for i, c in enumerate(EXTRA)))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(30)],
                                 "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("stage", ["near", "mix", "private", "toxic"])
def test_user_columns_come_back(docs, labels, stage):
    done = {"near": ngram_join.deduplicated, "mix": mixing.mixed_documents,
            "private": surrogates.replaced_documents,
            "toxic": lambda d: toxicity.clean(d, labels)}[stage](docs)
    assert done.columns == docs.columns
    rows = done.collect()
    assert len(rows) >= 9  # classes of near copies
    for r in rows:
        for i, c in enumerate(EXTRA):
            assert r[c] == f"user{i}-{-1 if r['doc_id'] is None else r['doc_id']}"


@pytest.mark.parametrize("stage", ["near", "mix", "private", "toxic"])
def test_stages_of_an_empty_table(docs, labels, stage):
    empty = docs.limit(0)
    done = {"near": ngram_join.deduplicated, "mix": mixing.mixed_documents,
            "private": surrogates.replaced_documents,
            "toxic": lambda d: toxicity.clean(d, labels)}[stage](empty)
    assert done.columns == docs.columns and done.count() == 0


def test_scores_beyond_64_bits_are_an_error():
    q = np.array([2.0 ** 40, 2.0 ** 40])
    assert topk._scores(q, np.array([[2.0 ** 21, -3.0]])).tolist() == [2 ** 61 - 3 * 2 ** 40]
    with pytest.raises(OverflowError):
        topk._scores(q, np.array([[2.0 ** 24, 0.0]]))


@pytest.mark.parametrize("text", ["x" * 70 + "@mail.example", "sk-" + "a1B2" * 20,
                                  "sk-proj-abcdEFGH_1234-5678abcd", "ghp_" + "Z9" * 60,
                                  "a@" + "b" * 80 + "." + "c." * 9 + "museum"])
def test_long_addresses_and_keys_are_replaced(text):
    new, found = surrogates.replaced(f"see {text} here", b"k")
    assert text not in new and len(found) == 1
