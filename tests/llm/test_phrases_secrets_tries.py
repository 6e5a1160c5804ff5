"""Collocations, secret scans and conversation tries against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import string
import zlib

import pytest
from pyspark.sql import functions as F

from commerce_marts.llm import collocations, prefix_trie, secret_scan
from commerce_marts.llm.common import ship

SCHEMA = "doc_id long, text string, lang string, w1 int, found string"


@pytest.fixture(scope="module")
def shipped(spark):
    ship(spark)
    return spark


# --- collocations -----------------------------------------------------------------------


def phrase_rows() -> list[tuple]:
    rng = random.Random(3)
    vocabulary = ["a", "b", "B", "c", "new york city", "É", "d\te", "x-y"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", ", ", ".\n", "\r"])
                             for _ in range(n))
    rows = [(i, text(rng.randint(0, 60)), rng.choice(["en", "de", None, "und"]), 0, "f")
            for i in range(60)]
    rows += [(1, rows[1][1], "en", 0, None), (None, "a b c a b c", "en", 0, None),
             (70, None, "en", 0, None), (71, "", None, 0, None), (72, " .,\n", "xx", 0, None),
             (73, text(20000), "de", 0, None)]
    return rows


def brute_collocations(rows, longest, threshold, share, top):
    low = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if len(p) > 1 and c >= threshold}
        own = []
        for p, a in often.items():
            if any(len(q) > len(p) and 100 * c >= share * a and
                   any(q[i:i + len(p)] == p for i in range(len(q))) for q, c in often.items()):
                continue
            score, _, left, right = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k,
                                         counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            own.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(own)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("longest,threshold,shards,top", [(3, 10, 3, 2000), (4, 3, 2, 7)])
def test_collocations_match_brute_force(shipped, longest, threshold, shards, top):
    rows = phrase_rows()
    docs = shipped.createDataFrame(rows, SCHEMA).repartition(5)
    got = collocations.collocations(docs, longest, threshold, 50, top, shards)
    want = brute_collocations(rows, longest, threshold, 50, top)
    assert len(want) > 15
    assert sorted(map(tuple, got.collect())) == want


def test_late_phrases_get_a_whole_cycle(shipped):
    """A phrase whose words are frequent in the last shard alone is counted in the first too."""
    rows = [(0, "p q r", "en", 0, None)] + [(i, "filler", "en", 0, None) for i in range(1, 6)]
    rows += [(6 + i, "p q r. p q r", "en", 0, None) for i in range(9)]
    docs = shipped.createDataFrame(rows, SCHEMA).coalesce(1)
    for shards in (1, 3, 5):
        encoded = collocations.chunks(docs.repartition(6, "doc_id"), shards)
        counts = {tuple(r[1:4]): r["c"] for r in collocations.frequent(encoded, 3, 10, shards).collect()}
        assert sorted(counts.values()) == [19] * 6


def test_scores_beyond_64_bits(shipped):
    a, b = 3_000_000_000_000, 2_999_999_999_999
    counts = shipped.createDataFrame([(7, 1, 0, a), (7, 2, 0, a), (7, 1, 2, b)],
                                     "g long, w1 long, w2 long, c long")
    row = collocations.scored(counts, 2).first()
    assert row["score"] == 1000000 * b * b // (a * a)


def test_collocations_of_an_empty_table(shipped):
    assert collocations.collocations(shipped.createDataFrame([], SCHEMA)).count() == 0


# --- secrets ----------------------------------------------------------------------------

PLAIN = {"assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                              r"""([A-Za-z0-9+/_.=-]+)""", re.A | re.I),
         "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}


def plain_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                out.append((m.start(), order, m.end()))
    return sorted(out)


def secret_rows():
    rng = random.Random(9)
    hexes = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    syllables = ["ver", "ein", "heit", "lich", "keit", "tion", "ment", "user", "name", "get", "id"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 7)))
    prose = lambda n: " ".join(rng.choice([word(), word().title() + "_" + word(), "É" + word(), "42"])
                               for _ in range(n))
    rows = [(i, f"{prose(80)} ütoken = \"{hexes(40)}\" {prose(50)}", "", 0, "x") for i in range(60)]
    # planted for the model alone: random letters and digits without a pattern of their own
    planted = {}
    for i in range(60, 90):
        secret = "".join(rng.choices(string.ascii_letters + string.digits, k=40))
        head = prose(30) + " ñ "
        planted[i] = (len(head), len(head) + 40)
        rows.append((i, head + secret + " " + prose(30), "", 0, None))
    rows += [(90, None, "", 0, None), (91, "", "", 0, None), (None, "token: password: abcdefgh", "", 0, None),
             (92, "password: token: abcdefgh", "", 0, None), (93, "Token:ab pAsswd='abcdef'", "", 0, None),
             (94, "toKen=" + "A" * 7 + " toKen=abcdefgh ſecret=abcdefgh", "", 0, None),
             (95, "AKIA" + "B" * 15 + " AKIA" + "C" * 16 + "akia " + hexes(23) + " " + hexes(24), "", 0, None),
             (96, "secret=" + hexes(30), "", 0, None), (96, "secret=" + hexes(30), "", 0, None),
             (97, prose(60000) + " api_key: zzzzzz", "", 0, None)]
    return rows, planted


def test_secret_scan(shipped):
    rows, planted = secret_rows()
    got = secret_scan.find_secrets(shipped.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    found = collections.defaultdict(list)
    for r in got:
        found[r["doc_id"]].append([(s["start"], s["kind"], s["end"]) for s in r["found"]])
    wanted = collections.defaultdict(list)
    for doc_id, text, *_ in rows:
        wanted[doc_id].append(plain_spans(text or ""))
    base = {i: sorted([s for s in own if s[1] < 3] for own in spans) for i, spans in found.items()}
    assert base == {i: sorted(spans) for i, spans in wanted.items()}
    added = {i: [(s, e) for s, k, e in own[0] if k == 3] for i, own in found.items()}
    caught = [i for i, span in planted.items() if span in added[i]]
    assert len(caught) >= 29
    # 95 holds 23 random hex digits, one short of the pattern
    assert not any(spans for i, spans in added.items() if i not in planted and i != 95)


def test_secret_query_counts_each_kind(shipped, tmp_path):
    from commerce_marts.llm.queries import op12_secret_scan

    rows, _ = secret_rows()
    rows += [(201, "f" * 24 + " token=abcdef " + "0" * 30 + " api_key: abcdef secret=ghijkl", "", 0, None),
             (202, "AKIA" + "Z" * 20, "", 0, None), (203, "token = '" + "e" * 32 + "'", "", 0, None)]
    shipped.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    wanted = collections.Counter()
    for doc_id, text, *_ in rows:
        spans = plain_spans(text or "")
        joined = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        wanted[doc_id, *(sum(k == kind for _, k, _ in spans) for kind in range(3)),
               hashlib.sha256(joined.encode()).hexdigest()] += 1
    assert collections.Counter(tuple(r[:5]) for r in op12_secret_scan(shipped, str(tmp_path)).collect()) == wanted


def test_secret_models_sum_to_one():
    import numpy as np

    counts = np.random.default_rng(1).integers(0, 9, secret_scan.K ** 3).astype(float)
    assert np.allclose(secret_scan._backed_off(counts)[..., 1:].sum(-1)
                       + secret_scan._backed_off(counts)[..., 0], 1, atol=0.02)


def test_secrets_of_an_empty_table(shipped):
    assert secret_scan.find_secrets(shipped.createDataFrame([], SCHEMA)).count() == 0


# --- tries ------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, depth int, key string"


def conversation_rows():
    rng = random.Random(4)
    rows = []
    for c in [*range(0, 60), *range(100, 140), *range(230, 260), 500]:
        for t in range(rng.randint(1, 14)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice("xyz") * rng.randint(0, 2),
                         0, "k"))
    rows += [(i, t, "user", "same", 0, None) for i in range(700, 760) for t in range(9)]
    rows += [(20, None, "user", "first", 0, None), (20, None, "user", "first", 0, None),
             (None, 1, "user", "lost", 0, None), (21, 900, None, None, 0, None)]
    rows += [(800, t, "user", f"é{t % 7}", 0, None) for t in range(1500)]
    return rows


def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [x[3] for x in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    nodes = collections.defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes[hash(path[:d]), d].append((c, len(path) == d, path))
    children, below = collections.Counter(), collections.defaultdict(lambda: [0, 0])
    for (_, d), members in nodes.items():
        if d:
            children[hash(members[0][2][:d - 1]), d - 1] += 1
    for (_, d), members in nodes.items():
        path = members[0][2][:d]
        saved = (len(members) - 1) * len(path[-1][1]) if d else 0
        for up in range(d + 1):
            key = hash(path[:up]), up
            below[key][0] += not children[hash(path), d]
            below[key][1] += saved
    out = []
    for (k, d), members in nodes.items():
        parent = min(m[0] for m in nodes[hash(members[0][2][:d - 1]), d - 1]) if d else None
        sha = hashlib.sha256(",".join(str(c) for c, end, _ in sorted(members) if end).encode()).hexdigest()
        out.append((min(m[0] for m in members), d, parent, len(members), children[k, d], *below[k, d], sha))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [4, 1, 7])
def test_trie_matches_brute_force(shipped, size):
    rows = conversation_rows()
    got = prefix_trie.conversation_trie(shipped.createDataFrame(rows, TURNS).repartition(3), size)
    assert sorted(map(tuple, got.collect()), key=str) == brute_trie(rows)


def test_trie_of_an_empty_table(shipped):
    assert prefix_trie.conversation_trie(shipped.createDataFrame([], TURNS)).count() == 0


def test_only_diverging_blocks_are_refined(shipped):
    """Copies of one conversation stay one row of a block each; no turn is expanded per member."""
    rows = [(i * 100, t, "user", f"{t}", 0, None) for i in range(50) for t in range(8)]
    parts = prefix_trie.blocks(prefix_trie.rebuilt(prefix_trie.turn_digests(
        shipped.createDataFrame(rows, TURNS))), 4)
    assert parts.count() == 100
    every = prefix_trie.nodes(parts, 4)
    assert every.count() == 9 and every.agg(F.min("n_convs")).first()[0] == 50
