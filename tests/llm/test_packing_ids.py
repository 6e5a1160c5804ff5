"""Token ids and pieces of packed documents against plain encoding of the whole text."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from commerce_marts.llm import packing
from commerce_marts.llm.common import ship, table
from commerce_marts.llm.queries import tokenizer_path

ODD = ["'", "'s", "'ll", "’", "<|", "|>", "<|endoftext|>", "<|startoftext|>", "İ", "ı", "ſ", "ß", "ẞ",
       "ŉ", "Ÿ", "×", "÷", "µ", "ª", "é", "Å", "Å", "ǅ", "中文", "ไทย", "🙂", "‍", "\x00",
       "\x1c", "\x7f", " ", " ", "\u0085", "١٢", "½", "_", "-", "...", "##", "</w>", "퟿"]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def random_texts(n: int) -> list[str]:
    rng = random.Random(8)
    letters = [chr(c) for c in (*range(0x21, 0x7f), *range(0xc0, 0x180))] + ODD

    def word():
        kind = rng.random()
        if kind < 0.5:
            return "".join(rng.choices("abcdefgABCXYZ", k=rng.randint(1, 9))) + rng.choice(["", ",", ".", "!?"])
        return "".join(rng.choices(letters, k=rng.randint(1, 8)))

    return ["".join(word() + rng.choice([" ", "\n", "  ", "\t\r\n"]) for _ in range(rng.randint(0, 60)))
            for _ in range(n)]


def test_ids_are_those_of_the_tokenizer(plain):
    texts = [*random_texts(400), "", None, *ODD]
    ids, counts = packing.word_ids(tokenizer_path()).of_texts(pa.array(texts, pa.string()))
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [plain(t) for t in texts]


def test_pieces_of_documents(spark, plain):
    ship(spark)
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    placed = packing.pack_documents(docs, tokenizer_path())
    got = sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
                 for r in placed.collect())
    want = []
    for r in docs.collect():
        ids = np.array(plain(r["text"]), "<u4")
        for k, at in enumerate(range(0, len(ids), packing.CAPACITY)):
            part = ids[at:at + packing.CAPACITY]
            want.append((r["doc_id"], k, at, len(part), zlib.crc32(part.tobytes())))
    assert got == sorted(want)
