"""Phrases by dynamic itemset counting over cyclic shard scans.

The corpus is encoded once into chunks (word hashes and places), dealt over ``SHARDS``
shards.  Scans go round the shards; a step scans one shard and counts phrases of all
lengths that are active at once.  All words are active from the first step.  A longer
phrase becomes active at the step after both its subphrases (without its last, without its
first word) have reached the threshold, and each is counted until every shard was scanned
once since: its count is then exact.

Counts live in a table that each step merges with the shard's counts.  A phrase counts in
the ``shards`` steps from the one it is first met in (``born``), so in each shard once; what
is below the threshold after its cycle is dropped.  Tasks learn what has reached the
threshold from a table of 2^``SLOT_BITS`` step marks for each length, addressed by phrase
hash and broadcast, whose size is fixed.  Phrases that share a slot can only become active
too early, for a whole cycle as well: their count is exact all the same.

Words are known by a 64-bit hash seeded by their language; two frequent words with one
hash are an error, not a wrong count.

Nulls: a null text is an empty text, a null lang is ``und``; doc_id is not used, so null
and repeated ids count like others.  Texts are read whole.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_marts.llm.common import discard, scratch, signed, text_slices, written

SHARDS = 3
SLOT_BITS = 22
CHUNK_BYTES = 8 << 20
#: Classes of bytes: word, blank, end of a piece.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


def pieces_and_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of lower-cased texts in order, and the number of the piece of each."""
    low = pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.string())
    offsets = np.frombuffer(low.buffers()[1], np.int32)[low.offset:low.offset + len(low) + 1]
    buffer = low.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0]:offsets[-1]] if buffer else np.zeros(0, np.uint8)
    bounds = (offsets - offsets[0]).astype(np.int64)
    kind = _KIND[data]
    word = kind == 0
    first = word.copy()
    first[1:] &= ~word[:-1]
    edge = bounds[(bounds > 0) & (bounds < len(data))]
    first[edge] |= word[edge]
    at = np.flatnonzero(first)
    ends = np.cumsum(kind == 2, dtype=np.int32)
    piece = ends[at] + np.searchsorted(bounds, at, "right")
    # the words' bytes in a row: each word ends where the next begins
    counted = np.concatenate([[0], np.cumsum(word, dtype=np.int32)])
    places = np.append(counted[at], counted[-1]).astype(np.int32)
    flat = pa.StringArray.from_buffers(len(at), pa.py_buffer(places.tobytes()),
                                       pa.py_buffer(data[word].tobytes()))
    return flat, piece


def chunks(docs: DataFrame, shards: int) -> DataFrame:
    """shard, lang, g (hash of lang), n (words), texts and hashes of the distinct words, ids
    (words as places among them), joint (bits: whether a word and the next are in one piece)."""

    def row(turn: int, name: str, texts: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        flat, piece = pieces_and_words(pa.concat_arrays(texts))
        if not len(flat):
            return
        distinct = flat.dictionary_encode()
        seed = xxhash.xxh3_64_intdigest(name)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) or 1 for w in
                              distinct.dictionary.cast(pa.binary()).to_pylist()),
                             np.uint64, len(distinct.dictionary))
        ids = distinct.indices.to_numpy().astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([turn % shards], pa.int32()), pa.array([name]),
             pa.array(signed(np.array([seed], np.uint64))), pa.array([len(ids)]),
             pa.array([distinct.dictionary.to_pylist()], pa.list_(pa.string())),
             *(pa.array([x.tobytes()], pa.binary()) for x in (
                 hashes, ids, np.packbits(piece[1:] == piece[:-1])))],
            names=["shard", "lang", "g", "n", "texts", "hashes", "ids", "joint"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        waiting: dict[str, list[pa.Array]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for part in text_slices(batch, max_bytes=CHUNK_BYTES):
                lang = part.column("lang")
                for name in pc.unique(lang).to_pylist():
                    own = part.column("text").filter(pc.equal(lang, name))
                    waiting.setdefault(name, []).append(own)
                    size[name] = size.get(name, 0) + own.nbytes
                # a language's chunk is full, or there are many languages with a little each
                all_of_them = sum(size.values()) > 4 * CHUNK_BYTES
                for name in [n for n, x in size.items() if all_of_them or x > CHUNK_BYTES]:
                    yield from row(turn, name, waiting.pop(name))
                    del size[name]
                    turn += 1
        for name, texts in waiting.items():
            yield from row(turn, name, texts)
            turn += 1

    out = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                      F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")).mapInArrow(
        encode, "shard int, lang string, g long, n long, texts array<string>, hashes binary, "
                "ids binary, joint binary")
    return written(out, "phrase-chunks", layout="shard")


def _slot(words: list[np.ndarray]) -> np.ndarray:
    x = words[0]
    for w in words[1:]:
        x = ((x << np.uint64(21)) | (x >> np.uint64(43))) ^ w
    return (x >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _slot_column(n: int) -> F.Column:
    """``_slot`` of the first n word columns."""
    x = F.col("w1")
    for i in range(2, n + 1):
        x = F.shiftleft(x, 21).bitwiseOR(F.shiftrightunsigned(x, 43)).bitwiseXOR(F.col(f"w{i}"))
    return F.shiftrightunsigned(x, 64 - SLOT_BITS).cast("int")


def _active(a: np.ndarray, b: np.ndarray, step: int, shards: int) -> np.ndarray:
    """Whether step marks of two subphrases allow that both were first there at most
    ``shards`` steps ago."""
    out = np.zeros(len(a), bool)
    for last in range(max(0, step - shards), step):
        upto = np.uint32((2 << last) - 1)
        bit = np.uint32(1 << last)
        out |= ((a & bit) > 0) & ((b & upto) > 0) | ((b & bit) > 0) & ((a & upto) > 0)
    return out


def shard_counts(encoded: DataFrame, step: int, shards: int, longest: int, marks) -> DataFrame:
    """g, w1.., n: counts of the phrases active at ``step`` in its shard, one row for each chunk."""
    names = [f"w{i}" for i in range(1, longest + 1)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = marks.value
        for batch in batches:
            for k in range(batch.num_rows):
                hashes, ids, joint = (np.frombuffer(batch.column(c)[k].as_buffer(), t) for c, t in (
                    ("hashes", np.uint64), ("ids", np.uint32), ("joint", np.uint8)))
                joint = np.unpackbits(joint, count=len(ids) - 1).astype(bool)
                at, gram, words = np.arange(len(ids)), ids.astype(np.int64), [hashes]
                for n in range(1, longest + 1):
                    if n > 1:
                        # a phrase is a phrase and the one a word further, both there by now
                        two = np.flatnonzero((at[1:] == at[:-1] + 1) & joint[at[:-1]])
                        code, gram = np.unique(gram[two] * len(words[0]) + gram[two + 1],
                                               return_inverse=True)
                        head, tail = np.divmod(code, max(1, len(words[0])))
                        live = _active(mark[head], mark[tail], step, shards)
                        words = [*(w[head] for w in words), words[-1][tail]]
                        at = at[two]
                    else:
                        live = np.full(len(hashes), step < shards)
                    if live.any():
                        found = np.bincount(gram, minlength=len(live))[live]
                        full = [signed(w[live]) for w in words]
                        full += [np.zeros(len(found), np.int64)] * (longest - n)
                        lang = pa.array(np.full(len(found), batch.column("g")[k].as_py()))
                        yield pa.RecordBatch.from_arrays(
                            [lang, *(pa.array(x) for x in (*full, found))], names=["g", *names, "n"])
                    if n == longest:
                        break
                    mark = tables[n - 1][_slot(words)]
                    there = mark[gram] > 0
                    if not there.any():
                        break
                    at, gram = at[there], gram[there]

    return encoded.where(F.col("shard") == step % shards).select(
        "g", "hashes", "ids", "joint").mapInArrow(count, "g long, " + ", ".join(f"{w} long" for w in names) + ", n long")


def frequent(encoded: DataFrame, longest: int, threshold: int, shards: int = SHARDS) -> DataFrame:
    """g, w1.., c: every phrase of up to ``longest`` words that occurs ``threshold`` times or more."""
    spark = encoded.sparkSession
    names = ["g", *(f"w{i}" for i in range(1, longest + 1))]
    kind = np.uint16 if longest * shards <= 16 else np.uint32  # a bit for each step
    tables = [np.zeros(1 << SLOT_BITS, kind) for _ in range(longest - 1)]
    state, path, latest = None, None, -1
    for step in range(longest * shards):
        if step >= shards and step > latest + shards:
            break  # whatever became active has had its cycle
        shared = spark.sparkContext.broadcast(tables)
        rows = shard_counts(encoded, step, shards, longest, shared).select(
            *names, F.lit(0).cast("long").alias("c"), "n", F.lit(step).alias("born"),
            F.lit(None).cast("int").alias("reached"))
        if state is not None:
            rows = rows.unionByName(state.withColumn("n", F.lit(0).cast("long")))
        merged = (rows.groupBy(*names)
                  .agg(F.sum("c").alias("c"), F.sum("n").alias("n"), F.min("born").alias("born"),
                       F.max("reached").alias("reached"))
                  .withColumn("c", F.col("c") + F.when(step < F.col("born") + shards, F.col("n"))
                              .otherwise(0)))
        # words are all met in the first cycle; a phrase's cycle begins where it is first met
        through = F.when(_length(1, longest), F.lit(step >= shards - 1)).otherwise(
            step >= F.col("born") + shards - 1)
        enough = F.col("c") >= threshold
        before, path = path, scratch(spark, f"phrases-{step}")
        state = written(merged.where(enough | ~through).select(
            *names, "c", "born", F.coalesce("reached", F.when(enough, step)).alias("reached")),
            "phrases", path=path)
        if before:
            discard(spark, before)
        shared.destroy()  # with its files
        for n in range(1, longest):
            slots = state.where((F.col("reached") == step) & _length(n, longest)).select(
                _slot_column(n).alias("slot")).distinct().toArrow()["slot"].to_numpy()
            if len(slots):
                tables[n - 1][slots] |= kind(1 << step)
                latest = step
    return state.where(F.col("c") >= threshold).select(*names, "c")


def _length(n: int, longest: int) -> F.Column:
    """Whether a phrase has exactly n words; the columns behind are 0."""
    has = F.col(f"w{n}") != 0
    return has if n == longest else has & (F.col(f"w{n + 1}") == 0)


def _part(columns: list[str], longest: int, name: str) -> list[F.Column]:
    """The columns as a phrase of their own, padded with 0."""
    return [(F.col(columns[i]) if i < len(columns) else F.lit(0).cast("long")).alias(f"{name}{i + 1}")
            for i in range(longest)]


def scored(counts: DataFrame, longest: int) -> DataFrame:
    """g, w1.., a, l, r, score: each phrase of two words or more at its lowest-scoring cut."""
    keys = [f"w{i}" for i in range(1, longest + 1)]

    def looked_up(phrases: DataFrame, columns: list[str], name: str) -> DataFrame:
        part = [f"{name}_{i}" for i in range(1, longest + 1)]
        table = counts.select(*(F.col(k).alias(p) for k, p in zip(keys, part)), F.col("c").alias(name))
        for p, c in zip(part, _part(columns, longest, "")):
            phrases = phrases.withColumn(f"{p}_", c)
        on = [F.col(f"{p}_") == F.col(p) for p in part]
        return phrases.join(table, on).drop(*part, *(f"{p}_" for p in part))

    out = None
    wide = "decimal({},0)"
    for n in range(2, longest + 1):
        own = counts.where(_length(n, longest)).withColumnRenamed("c", "a")
        for k in range(1, n):
            own = looked_up(looked_up(own, keys[:k], f"l{k}"), keys[k:n], f"r{k}")
        square = F.col("a").cast(wide.format(15)) * F.col("a").cast(wide.format(15)) * F.lit(
            1000000).cast(wide.format(7))
        cuts = [F.struct(
            F.expr(f"square div (cast(l{k} as decimal(19,0)) * cast(r{k} as decimal(19,0)))")
            .alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
            for k in range(1, n)]
        best = F.array_min(F.array(*cuts))
        own = own.withColumn("square", square.cast(wide.format(38))).withColumn("best", best)
        own = own.select("g", *keys, "a", "best.l", "best.r", F.col("best.score").cast("long").alias("score"))
        out = own if out is None else out.unionByName(own)
    return out


def uncovered(phrases: DataFrame, longest: int, share: int) -> DataFrame:
    """Phrases not inside a longer one with at least ``share`` percent of their occurrences."""
    keys = [f"w{i}" for i in range(1, longest + 1)]
    inside = None
    for n in range(3, longest + 1):
        longer = phrases.where(_length(n, longest))
        for m in range(2, n):
            for at in range(n - m + 1):
                part = longer.select(*_part(keys[at:at + m], longest, "w"), F.col("a").alias("longer"))
                inside = part if inside is None else inside.unionByName(part)
    if inside is None:
        return phrases
    most = inside.groupBy(*keys).agg(F.max("longer").alias("longer"))
    return phrases.join(most, keys, "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)).drop("longer")


def dictionary(encoded: DataFrame, needed: DataFrame) -> DataFrame:
    """word, text of the words in ``needed`` (column word, distinct)."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                hashes = np.frombuffer(batch.column("hashes")[k].as_buffer(), np.uint64)
                at = np.flatnonzero(some[_slot([hashes])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(hashes[at])), batch.column("texts")[k].values.take(pa.array(at))],
                    names=["word", "text"])

    spark = encoded.sparkSession
    slots = needed.select(F.shiftrightunsigned("word", 64 - SLOT_BITS).cast("int").alias("slot")
                          ).distinct().toArrow()["slot"].to_numpy()  # at most 2^SLOT_BITS
    table = np.zeros(1 << SLOT_BITS, bool)
    table[slots] = True
    shared = spark.sparkContext.broadcast(table)
    spelled = (encoded.select("hashes", "texts").mapInArrow(spell, "word long, text string")
               .groupBy("word").agg(F.min("text").alias("text"), F.max("text").alias("other")))
    return needed.join(spelled, "word").select("word", F.when(
        F.col("text") == F.col("other"), F.col("text")).otherwise(
        F.raise_error(F.lit("two words have one hash")).cast("string")).alias("text"))


def collocations(docs: DataFrame, longest: int = 3, threshold: int = 10, share: int = 50,
                 top: int = 2000, shards: int = SHARDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases."""
    keys = [f"w{i}" for i in range(1, longest + 1)]
    encoded = chunks(docs, shards)
    counts = frequent(encoded, longest, threshold, shards)
    # only the first of each language are spelled out, with all ties of the last one
    by_score = Window.partitionBy("g").orderBy(F.desc("score"), F.desc("a"))
    first = written(uncovered(scored(counts, longest), longest, share).withColumn(
        "at", F.rank().over(by_score)).where(F.col("at") <= top), "phrases-first")
    needed = first.select(F.explode(F.array(*keys)).alias("word")).where("word <> 0").distinct()
    known = written(dictionary(encoded, needed), "phrase-words")
    for k in keys:
        first = first.join(known.select(F.col("word").alias(k), F.col("text").alias(f"{k}_text")), k, "left")
    total = encoded.groupBy("lang", "g").agg(F.sum("n").alias("n"))
    return (first.withColumn("phrase", F.concat_ws(" ", *(f"{k}_text" for k in keys)))
            .join(total, "g")
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(
                F.desc("score"), F.desc("a"), "phrase")))
            .where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
