"""Personal data in forms and scripts beyond the common ones."""

from __future__ import annotations

import re
import unicodedata

import pytest

from commerce_marts.llm import surrogates
from commerce_marts.llm.common import ship

replaced = surrogates.replaced


def test_bare_mentions_of_a_titled_name_are_replaced():
    text = ("Ann saw Brown. Mr Brown's dog and Ms Smith-Jones came; Brown, BROWN's, Jones, brown "
            "and Browning stayed. Dr O'Brien left, O'Brien's hat too.")
    out, found = replaced(text)
    assert not re.search(r"\b(Brown|BROWN|Smith|Jones|O'Brien)\b", out)
    assert "brown and Browning" in out and out.startswith("Ann saw ")
    new = {e["value"]: e["surrogate"] for e in found}
    assert new["Mr Brown"] == f"Mr {new['Brown']}" and new["BROWN"] == new["Brown"].upper()
    assert new["Ms Smith-Jones"].endswith(f"-{new['Jones']}")
    assert new["Dr O'Brien"] == f"Dr {new[chr(79) + chr(39) + 'Brien']}"
    assert all(text[e["start"]:].startswith(e["value"]) for e in found)


@pytest.mark.parametrize("phone", ["+14155552671", "+33 6 12 34 56 78", "06 12 34 56 78", "+33612345678",
                                   "01.23.45.67.89", "+44 20 7946 0958", "+49 (30) 901820", "٠١٢-٣٤٥-٦٧٨٩"])
def test_phones_of_other_groupings(phone):
    out, found = replaced(f"call {phone}, now")
    assert [(e["kind"], e["value"]) for e in found] == [("phone", phone)]
    assert out != f"call {phone}, now" and re.sub(r"\d", "0", out) == re.sub(r"\d", "0", f"call {phone}, now")


def test_phone_keeps_its_country_and_is_the_same_in_all_groupings():
    digits = lambda t: re.sub(r"\D", "", replaced(t)[0])
    assert digits("+33 6 12 34 56 78") == digits("+33612345678")
    assert digits("+33 6 12 34 56 78")[:2] == "33"
    assert digits("+33 6 12 34 56 78")[2:] == digits("06 12 34 56 78")[1:]
    assert digits("+14155552671")[1:] == digits("415-555-2671")
    every = {digits(f"{a}-345-6789") for a in range(100, 1000)} | {digits(f"0{a}-345-6789") for a in range(10, 100)}
    assert len(every) == 990


@pytest.mark.parametrize("name", ["Żółć", "Çelik", "Łukasz", "İnönü", "王小明", "王", "佐藤", "サトウ", "김철수",
                                  "محمد", "राम", "Groß", "ẞtern", "Ōta", "Ελένης", "Kelvin"])
def test_no_name_keeps_its_value(name):
    out, found = replaced(f"Mr {name} kam")
    assert [e["value"] for e in found] == [f"Mr {name}"]
    assert name not in out and len(out) == len(f"Mr {name} kam")


def test_every_letter_and_number_moves_within_its_category():
    seen = set()
    for c in map(chr, range(0x32400)):
        if unicodedata.category(c)[0] in "LN":
            new = surrogates.shaped(c, b"k", "t")
            assert new != c and len(new) == 1 and unicodedata.category(new)[0] in "LN", hex(ord(c))
            assert new not in seen, hex(ord(c))
            seen.add(new)


def test_collisions_are_an_error_in_the_written_result(spark, monkeypatch):
    ship(spark)
    docs = spark.createDataFrame([(1, "Mr Brown"), (2, "Mr Groen"), (3, "Mr 王 K@x.com k@x.com")],
                                 "doc_id long, text string")
    assert surrogates.checked(docs).count() == 3
    both = surrogates.with_surrogates(docs)
    monkeypatch.setattr(surrogates, "with_surrogates", lambda d, key: both.selectExpr(
        "doc_id", "text", "transform(_entities, e -> named_struct('kind', e.kind, 'start', e.start, "
        "'value', e.value, 'surrogate', e.value)) as _entities"))
    with pytest.raises(ValueError, match="kept their value"):
        surrogates.checked(docs)
