"""Records whose payloads hold the magic that opens a record."""

from __future__ import annotations

import hashlib
import base64

from commerce_marts.llm import warc
from commerce_marts.llm.common import ship, written


def test_round_trip_with_the_real_magic_inside_payloads(spark):
    inner = "hello" * 3
    header = (f"WARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: {len(inner)}\r\n"
              f"\r\n{inner}{warc.END}")
    valid = f"x{warc.END}{warc.MAGIC}{header}"
    invalid = f"{warc.MAGIC}no header at all{warc.END}{warc.MAGIC}"
    traps = [valid, invalid, valid * 4 + "tail", invalid + valid, warc.MAGIC, valid + invalid * 3]
    pages = [(i, "u", t) for i, t in enumerate(traps)] + [(50, "u", "plain"), (51, "u", None)]
    ship(spark)
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    found = written(warc.candidates(spark, warc.write_archives(
        warc.records(df), warc.scratch(spark, "trap"))), "trap-found")
    assert found.count() > len(pages) + 10  # false candidates are met
    got = {r["page_id"]: r for r in warc.round_trip(df).collect()}
    assert len(got) == len(pages)
    for i, _, t in pages:
        body = (t or "").encode()
        want = base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert (got[i]["payload_bytes"], got[i]["record_type"]) == (len(body), "response")
        assert got[i]["payload_digest"].endswith(want)
