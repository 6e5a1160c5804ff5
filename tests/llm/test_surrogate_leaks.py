"""Entities of any length and layout, further kinds, and where the key comes from."""

from __future__ import annotations

import random
import re
import time

import pytest

from commerce_marts.llm import surrogates
from commerce_marts.llm.common import ship

K = b"test"


@pytest.mark.parametrize("text, gone", [
    ("Dr Maria Anna Schmidt came", ["Maria", "Anna", "Schmidt"]),
    ("Mr\nBrown, Mr\tGreen, Mr Black, Mr  White, Mr.Gray", ["Brown", "Green", "Black", "White", "Gray"]),
    ("Prof. Dr. Müller kam", ["Müller"]),
    ("Mr Brown Mrs White", ["Brown", "White"]),
    ("Dr Maria von Trapp sang", ["Maria", "Trapp"]),
    ("Mr A" + "b" * 300 + " came", ["b" * 300]),
    ("aws_secret_access_key=abc123DEF456/x", ["abc123DEF456/x"]),
    ("password: 'hunter2hunter2'", ["hunter2hunter2"]),
    ("from 2001:db8::1, fe80::1ff:fe23:4567:890a.", ["2001:db8::1", "fe80::1ff:fe23:4567:890a"]),
    ("IBAN DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432.", ["3704 0044", "WEST12345698765432"]),
    ("415 5552671, call 5551234567", ["5552671", "5551234567"])])
def test_nothing_of_an_entity_stays(text, gone):
    out, found = surrogates.replaced(text, K)
    assert found and not [g for g in gone if g in out]
    assert all(text[e["start"]:].startswith(e["value"]) for e in found)
    assert len(out) == len(text)


@pytest.mark.parametrize("text", [
    "at 12:30:45 std::vector a[1::2]", "password: required", "Mr brown and Dr who", "the token is here",
    "AB12 CDEF 1234 5678", "order 5551234567"])
def test_other_texts_stay(text):
    assert surrogates.replaced(text, K) == (text, [])


def test_titles_and_particles_stay_and_a_line_ends_a_name():
    out, found = surrogates.replaced("Prof. Dr. Maria von Trapp\nThe Von Trapps; Trapp's hat", K)
    new = {e["value"]: e["surrogate"] for e in found}
    assert list(new) == ["Prof. Dr. Maria von Trapp", "Trapp"]
    assert re.fullmatch(r"Prof\. Dr\. \w{5} von \w{5}\nThe Von Trapps; \w{5}'s hat", out)
    assert new["Prof. Dr. Maria von Trapp"].endswith(f" von {new['Trapp']}")


def test_what_is_no_account_number_may_hold_a_card():
    _, found = surrogates.replaced("DE11 4111 1111 1111 1111", K)
    assert [(e["kind"], e["value"]) for e in found] == [("card", "4111 1111 1111 1111")]


def _accounts(rng: random.Random, n: int) -> list[str]:
    out = set()
    while len(out) < n:
        body = "".join(rng.choices("0123456789", k=18))
        out.add(f"DE{98 - surrogates._remainder('DE00' + body):02d}{body}")
    return sorted(out)


def test_new_kinds_stay_distinct_and_valid():
    rng = random.Random(1)
    accounts = _accounts(rng, 500)
    new = [surrogates.surrogate("iban", a, K) for a in accounts]
    assert len(set(new)) == 500 and all(surrogates._remainder(a) == 1 and a[:2] == "DE" for a in new)
    assert not set(a[4:] for a in accounts) & {b[4:] for a, b in zip(accounts, new) if a[4:] == b[4:]}
    spaced = " ".join(accounts[0][i:i + 4] for i in range(0, 22, 4))
    assert surrogates.surrogate("iban", spaced, K).replace(" ", "") == new[0]
    hosts = [f"2001:db8::{i:x}" for i in range(16, 256)]
    found = [surrogates.surrogate("ip6", h, K) for h in hosts]
    assert len(set(found)) == len(hosts) and all(a != b for a, b in zip(hosts, found))
    assert all(re.fullmatch("20[0-9a-f]{2}:[0-9a-f]{3}::[0-9a-f]{2}", f) for f in found)


def test_the_work_grows_with_the_length_of_an_entity():
    start = time.monotonic()
    text = "sk-" + "1" * 400_000
    out, _ = surrogates.replaced(text, K)
    assert len(out) == len(text) and time.monotonic() - start < 20
    parts = [out[3 + i:3 + i + 512] for i in range(0, 400_000, 512)]
    assert all(set(p) != {"1"} for p in parts)


def test_the_key_comes_from_outside(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "Mr Brown"), (2, None), (3, "")], "doc_id long, text string")
    texts = lambda d: [r["text"] for r in d.orderBy("doc_id").collect()]
    own = texts(surrogates.with_surrogates(docs, K))
    assert own == [surrogates.replaced("Mr Brown", K)[0], None, ""]
    unset = texts(surrogates.with_surrogates(docs))
    assert unset[0] == surrogates.replaced("Mr Brown")[0]
    spark.conf.set(surrogates.KEY_SETTING, K.decode())
    try:
        assert texts(surrogates.with_surrogates(docs)) == own
    finally:
        spark.conf.unset(surrogates.KEY_SETTING)
    long = "Mr " + "A" + "bcdfghjk" * 8
    assert len({surrogates.replaced(long, k)[0] for k in (K, b"other", b"third")}) == 3
