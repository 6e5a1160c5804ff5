"""Prefix trie of conversations by fixed-length block hashing.

A conversation's turns are cut into blocks of ``BLOCK`` turns.  A block's key is the
hash of the key before it and the digests of its turns, so equal keys are equal
prefixes.  Conversations are grouped by successive block keys first.  A block that has
no sibling under its parent key has the same members at each of its turns and is
expanded once; only where siblings diverge are the (already grouped) blocks refined
turn by turn.  The work grows with blocks, not with members times turns.

A node is owned by its smallest member, so the nodes of one owner are the lower end
of its path.  Sums over subtrees are sums along the owner's own nodes, plus what each
owner sends to the nodes above its own: at most one row for each turn.

Turns are known by the MD5 of role and text, prefixes by an MD5 chain.  A prefix is
hashed in order, in one streaming task for each conversation (memory does not grow
with it); the ids that end at one node are joined in pieces of ``ID_RANGE`` ids and
only these pieces stream through one task, as SHA-256 has to see them in order.

Nulls: rows without conv_id belong to no conversation; a null turn comes first; null
role or text is empty.  Turns with equal numbers are ordered by their digest, repeated
rows are repeated turns.  An empty table gives no rows.  Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_marts.llm.common import written

BLOCK = 4
ID_RANGE_BITS = 7
ROOT = bytes(16)
HEAD_GROUP, HEAD_SPREAD = 100, 6


def turn_digests(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest (of role and text), chars of every turn."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.length(text).cast("long").alias("chars"))


def rebuilt(turns: DataFrame, group: int = HEAD_GROUP, spread: int = HEAD_SPREAD) -> DataFrame:
    """conv_id, skip, own, turn, digest, chars: of each conversation c the first
    h = crc32(c) % ``spread`` turns of conversation c - c % ``group`` (own = 0) and its own
    (own = 1), the first ``skip`` of which are to be left out."""
    leader = F.col("conv_id") % group == 0
    h = F.when(leader, 0).otherwise(F.crc32(F.col("conv_id").cast("string")) % spread).cast("int")
    first = (turns.where(leader)
             .withColumn("at", F.row_number().over(Window.partitionBy("conv_id").orderBy(
                 F.asc_nulls_first("turn"), "digest")))
             .where(F.col("at") < spread)
             .select(F.col("conv_id").alias("leader"), "at", "digest", "chars"))
    heads = (turns.where(~leader).select("conv_id").distinct()
             .withColumn("leader", F.col("conv_id") - F.col("conv_id") % group)
             .join(first, "leader").where(F.col("at") <= h)
             .select("conv_id", h.alias("skip"), F.lit(0).alias("own"),
                     F.col("at").cast("long").alias("turn"), "digest", "chars"))
    return heads.union(turns.select("conv_id", h.alias("skip"), F.lit(1).alias("own"), "turn",
                                    "digest", "chars"))


def blocks(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """conv_id, block, before, key, digests, chars, last of every block of every conversation.
    ``digests`` are the block's turn digests in a row; ``last`` marks a conversation's last
    block, which for one without turns is empty."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        conv, skip, number, before, digests, chars = None, 0, 0, ROOT, [], []

        def close(last: bool) -> bytes:
            joined = b"".join(digests)
            key = hashlib.md5(before + joined).digest() if joined else before
            rows.append((conv, number, before, key, joined, list(chars), last))
            digests.clear()
            chars.clear()
            return key

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(),
                    pa.list_(pa.int64()), pa.bool_()))],
                names=["conv_id", "block", "before", "key", "digests", "chars", "last"])
            rows.clear()
            return batch

        for batch in batches:
            for c, s, own, digest, n in zip(*(batch.column(x).to_pylist() for x in (
                    "conv_id", "skip", "own", "digest", "chars"))):
                if c != conv:
                    if conv is not None:
                        close(True)
                    conv, skip, number, before = c, s, 0, ROOT
                if own and skip:
                    skip -= 1
                    continue
                if len(digests) == size:
                    before = close(False)
                    number += 1
                digests.append(digest)
                chars.append(n)
            if rows:
                yield out()
        if conv is not None:
            close(True)
            yield out()

    return (turns.repartition("conv_id")
            .sortWithinPartitions("conv_id", "own", F.asc_nulls_first("turn"), "digest")
            .select("conv_id", "skip", "own", "digest", "chars")
            .mapInArrow(cut, "conv_id long, block long, before binary, key binary, "
                             "digests binary, chars array<long>, last boolean"))


def _turn_key(i):
    """Key of the first i turns after ``before``, i counted in this block."""
    return F.unhex(F.md5(F.concat("before", F.expr(f"substring(digests, 1, 16 * ({i}))"))))


def _expanded(groups: DataFrame, size: int) -> DataFrame:
    """One row for each turn of each block: key, parent, depth, conv_id, n_convs, chars."""
    return (groups.select("*", F.posexplode("chars").alias("at", "n"))
            .select(_turn_key("at + 1").alias("key"),
                    F.when(F.col("at") == 0, F.col("before")).otherwise(_turn_key("at")).alias("parent"),
                    (F.col("block") * size + F.col("at") + 1).alias("depth"), "conv_id", "n_convs",
                    F.col("n").alias("chars")))


def nodes(parts: DataFrame, size: int = BLOCK) -> DataFrame:
    """key, parent, depth, conv_id (smallest member), n_convs, chars of every node."""
    groups = (parts.where(F.length("digests") > 0).groupBy("block", "before", "key")
              .agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"),
                   F.first("digests").alias("digests"), F.first("chars").alias("chars")))
    groups = written(groups, "trie-blocks")
    diverging = groups.groupBy("block", "before").agg(F.count("*").alias("n")).where("n > 1").select(
        "block", "before", F.lit(True).alias("diverges"))
    marked = groups.join(diverging, ["block", "before"], "left")
    whole = _expanded(marked.where("diverges is null"), size)
    refined = (_expanded(marked.where("diverges"), size).groupBy("key", "parent", "depth")
               .agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
                    F.max("chars").alias("chars")))
    root = (parts.where("last").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
            .where("n_convs > 0")
            .select(F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"),
                    F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
                    F.lit(0).cast("long").alias("chars")))
    return whole.unionByName(refined).unionByName(root)


def ends(parts: DataFrame) -> DataFrame:
    """key, ends_sha256: hash of the sorted ids of the conversations that end at a node."""
    pieces = (parts.where("last").groupBy("key", F.shiftright("conv_id", ID_RANGE_BITS).alias("part"))
              .agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")),
                                                lambda c: c.cast("string"))).alias("ids")))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, done = None, None, []
        for batch in batches:
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k != key:
                    if key is not None:
                        done.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)],
                                                 schema=schema)
                done = []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([sha.hexdigest()])],
                                             schema=schema)

    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    return (pieces.repartition("key").sortWithinPartitions("key", "part").select("key", "ids")
            .mapInArrow(digest, "key binary, ends_sha256 string"))


def trie(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """The nodes of ``turns`` (columns of ``rebuilt``): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    parts = written(blocks(turns, size), "trie-parts")
    every = written(nodes(parts, size), "trie-nodes")
    children = every.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(
        F.count("*").alias("n_children"))
    parents = every.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    every = written(
        every.join(children, "key", "left").join(ends(parts), "key", "left")
        .join(parents, "parent", "left")
        .select("key", "depth", "conv_id", "parent_conv_id", "n_convs",
                F.coalesce("n_children", F.lit(0)).alias("n_children"),
                F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
                ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), "trie-linked")

    # what an owner sends upwards: a leaf, and what its own nodes save
    owners = every.groupBy("conv_id").agg(
        F.min("depth").alias("top"), F.sum("saved").alias("saved"),
        F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves")
    ).where("top > 0 and (saved > 0 or leaves > 0)")
    above = F.least(F.size("chars").cast("long"), F.col("top") - 1 - F.col("block") * size)
    sent = (parts.join(owners, "conv_id").where(above > 0)
            .select("before", "digests", "saved", "leaves",
                    F.explode(F.sequence(F.lit(1).cast("long"), above)).alias("at"))
            .select(_turn_key("at").alias("key"), "saved", "leaves")
            .union(owners.select(F.lit(ROOT).alias("key"), "saved", "leaves"))
            .groupBy("key").agg(F.sum("saved").alias("sent_saved"), F.sum("leaves").alias("sent_leaves")))
    below = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0)
    shared = (every.where("n_convs > 1")
              .withColumn("own_saved", F.sum("saved").over(below))
              .withColumn("own_leaf", F.sum(leaf).over(below)))
    # an owner's chain may end in nodes of its own alone: these save nothing, their leaf is one
    tails = every.where("n_convs = 1").groupBy("conv_id").agg(F.lit(1).alias("tail"))
    shared = (shared.join(tails, "conv_id", "left").join(sent, "key", "left")
              .withColumn("n_leaves", F.col("own_leaf") + F.coalesce("tail", F.lit(0))
                          + F.coalesce("sent_leaves", F.lit(0)))
              .withColumn("saved_tokens", F.col("own_saved") + F.coalesce("sent_saved", F.lit(0))))
    alone = every.where("n_convs = 1").withColumn("n_leaves", F.lit(1)).withColumn(
        "saved_tokens", F.lit(0))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return shared.select(*names, "ends_sha256").unionByName(alone.select(*names, "ends_sha256")).select(
        *(F.col(c).cast("long").alias(c) for c in names), "ends_sha256")


def conversation_trie(conversations: DataFrame, size: int = BLOCK) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(turn_digests(conversations)), size)
