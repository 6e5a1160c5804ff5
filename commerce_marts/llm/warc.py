"""WARC archives: written by Spark's text writer, read back by boundary chains.

Writing.  A record is its header, a blank line and its block; the writer's line
separator is the two line ends that close a record, so Spark writes, commits and
(gzip) compresses the archives on whatever file system the shared folder is on.
Records with equal payloads are written once: the one with the largest page_id
is a ``response``, the others are ``revisit`` records without payload.

Reading.  The archives are split at the magic that opens a record, which may also
occur inside a payload.  Each task emits, for every place with the magic, the
offset where a record starting there would end: a candidate and its successor.
Pointer jumping from the start of each file (the pointers double every round)
keeps only the candidates on the chain; the others are part of the record that
covers them, and their bytes are given back to it.  Rounds grow with the
logarithm of the records of a file, and no file goes through one task.

Nulls: a null html is an empty payload, a null url an empty target, a null
page_id is kept.  Repeated rows: each row has a record; rows that share the
largest page_id of a payload are all responses.  An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commerce_marts.llm.common import scratch, written

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: RFC 4648 base32 digits.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: each five hex digits are
    twenty bits, which are four base-32 digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to (null: response)."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    keyed = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                         payload.alias("payload"))
    digests = keyed.select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload").cast("binary")).alias("payload_digest"))
    shared = (digests.where(F.col("payload_bytes") >= min_bytes)
              .groupBy("payload_digest").agg(F.max("page_id").alias("_last"),
                                             F.count("*").alias("_n"))
              .where("_n > 1").drop("_n"))
    # only ids and digests are matched; the payloads stay where they are read
    revisits = (digests.join(shared, "payload_digest")
                .where("payload_bytes >= %d and not (page_id <=> _last)" % min_bytes)
                .select("page_id", "payload_digest", F.col("_last").alias("refers_to")).distinct())
    own = keyed.select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload").cast("binary")).alias("payload_digest"))
    return (own.join(revisits.withColumnRenamed("page_id", "_p")
                     .withColumnRenamed("payload_digest", "_d"),
                     F.col("page_id").eqNullSafe(F.col("_p"))
                     & (F.col("payload_digest") == F.col("_d")), "left").drop("_p", "_d"))


def write_archives(found: DataFrame, path: str, compression: str = "gzip") -> str:
    """One archive a task; ``found`` as from ``records``."""
    revisit = F.col("refers_to").isNotNull()
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    target = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]", "%0A")
    length = F.lit(len(HTTP)) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    header = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), name,
        F.lit(">\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "), target,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/"
                  "identical-payload-digest\r\nWARC-Refers-To: <urn:page:"),
            F.col("refers_to").cast("string"), F.lit(">"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        length.cast("string"), F.lit(END + HTTP))
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    (found.select(F.concat(header, block).alias("value"))
     .write.option("lineSep", END).option("compression", compression).text(path))
    return path


_FIELD = {k: re.compile(rb"^" + k.encode() + rb":[ \t]*(.*?)[ \t]*$", re.M | re.I)
          for k in ("WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Payload-Digest",
                    "Content-Length")}
_PAGE = re.compile(rb"<urn:page:(-?\d+)>")


def _fields(chunk: bytes) -> dict | None:
    """Header fields of a record that starts here (without the magic), or None."""
    end = chunk.find(b"\r\n\r\n")
    if end < 0:
        return None
    header = chunk[:end].replace(b"\r\n", b"\n")
    found = {k: m[1] for k, r in _FIELD.items() if (m := r.search(header))}
    if not found.get("Content-Length", b"").isdigit() or len(found["Content-Length"]) > 18:
        return None
    page = {k: int(m[1]) if (m := _PAGE.match(found.get(k, b""))) else None
            for k in ("WARC-Record-ID", "WARC-Refers-To")}
    return {"type": found.get("WARC-Type", b"").decode("latin-1"), "page_id": page["WARC-Record-ID"],
            "refers_to": page["WARC-Refers-To"], "body": end + 4,
            "claimed": found.get("WARC-Payload-Digest", b"").decode("latin-1").removeprefix("sha1:"),
            "length": int(found["Content-Length"])}


def _payload(block: bytes) -> bytes:
    """The part of an HTTP message after its header."""
    at = block.find(b"\r\n\r\n")
    return block[at + 4:] if at >= 0 else b""


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


_CANDIDATE = ("file string, block long, at long, upto long, type string, page_id long, "
              "refers_to long, claimed string, body long, length long, payload_bytes long, payload_digest string, "
              "chunk binary")


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every place with the magic: ``at`` and ``upto`` count bytes from the start of its
    split; ``length`` is null where no header follows.  ``chunk`` (the bytes up to the
    next magic) is kept only where another candidate of the split may cover it, or
    it is not a whole record, or its split is not the first of the file."""
    size = len(MAGIC)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, pos, covered = None, 0, 0
        for batch in batches:
            rows = []
            for file, block, value in zip(batch.column("file").to_pylist(),
                                          batch.column("block").to_pylist(),
                                          batch.column("value")):
                chunk = value.as_buffer().to_pybytes() if value.is_valid else b""
                if (file, block) != split:
                    split, covered = (file, block), 0
                    pos = 0
                    if block == 0:  # what stands before the first magic of a file
                        pos = len(chunk) + size
                        continue
                at, pos = pos - size, pos + len(chunk) + size
                found = _fields(chunk)
                upto = whole = None
                size_of = digest = None
                if found:
                    upto = at + size + found["body"] + found["length"] + len(END)
                    whole = found["body"] + found["length"] + len(END) == len(chunk)
                    if whole:
                        body = _payload(chunk[found["body"]:found["body"] + found["length"]])
                        size_of, digest = len(body), _digest(body)
                keep = not whole or at < covered or block > 0
                covered = max(covered, upto or 0)
                f = found or {}
                rows.append((file, block, at, upto, f.get("type"), f.get("page_id"),
                             f.get("refers_to"), f.get("claimed"), f.get("body"), f.get("length"), size_of, digest,
                             chunk if keep else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 13, types)],
                names=names)

    names = [c.split()[0] for c in _CANDIDATE.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in _CANDIDATE.split(", ")]
    lines = (spark.read.option("lineSep", MAGIC).text(path)
             .select(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.col("value").cast("binary").alias("value")))
    relative = written(lines.mapInArrow(scan, _CANDIDATE), "warc-candidates")
    # a split starts where the splits before it end; a few rows for each file
    total = relative.groupBy("file", "block").agg(
        F.max(F.col("at") + size + F.coalesce(F.octet_length("chunk").cast("long"),
                                              F.col("upto") - F.col("at") - size)).alias("_t"))
    base = total.select("file", "block", F.coalesce(F.sum(F.col("_t") + F.lit(size)).over(
        Window.partitionBy("file").orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    return relative.join(base, ["file", "block"]).select(
        "file", (F.col("at") + F.col("_base")).alias("at"),
        (F.col("upto") + F.col("_base")).alias("upto"), "type", "page_id", "refers_to", "claimed",
        "body", "length", "payload_bytes", "payload_digest", "chunk")


def reachable(found: DataFrame) -> DataFrame:
    """(file, at) of the candidates on the chain from the start of each file."""
    nodes = found.select("file", "at", F.col("upto").alias("ptr"), (F.col("at") == 0).alias("on"))
    nodes = written(_known(nodes, nodes), "warc-chain")
    while nodes.where("ptr is not null").limit(1).count():
        ahead = nodes.where("ptr is not null")
        reached = ahead.where("on").select("file", F.col("ptr").alias("at")).distinct()
        jumped = ahead.join(nodes.select("file", F.col("at").alias("ptr"), F.col("ptr").alias("_p")),
                            ["file", "ptr"]).select("file", "at", F.col("_p").alias("ptr"), "on")
        moved = jumped.unionByName(nodes.where("ptr is null"))
        nodes = written(moved.join(reached.withColumn("_r", F.lit(True)), ["file", "at"], "left")
                        .select("file", "at", "ptr", (F.col("on") | F.col("_r").isNotNull())
                                .alias("on")), "warc-chain")
    return nodes.where("on").select("file", "at")


def _known(nodes: DataFrame, places: DataFrame) -> DataFrame:
    """Pointers that lead to no candidate (the end of a file) become null."""
    at = places.select("file", F.col("at").alias("ptr"), F.lit(True).alias("_k"))
    return nodes.join(at, ["file", "ptr"], "left").select(
        "file", "at", F.when(F.col("_k"), F.col("ptr")).alias("ptr"), "on")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives: file, at, type, page_id, refers_to, claimed (the digest in
    the header), payload_bytes, payload_digest (of the payload as read)."""
    found = written(candidates(spark, path), "warc-found")
    chain = written(reachable(found), "warc-reached")
    marked = found.join(chain.withColumn("_on", F.lit(True)), ["file", "at"], "left")
    whole = marked.where("_on and payload_digest is not null")
    # the rest: records in which the magic occurs, with the false candidates they cover
    open_ = marked.where("_on and payload_digest is null and length is not null")
    # an archive is one file of bounded size; only its few false candidates are ordered
    loose = open_.select("file", "at", "upto", F.col("at").alias("_o"), "chunk").unionByName(
        marked.where("_on is null").select("file", "at", F.lit(None).cast("long").alias("upto"),
                                           F.lit(None).cast("long").alias("_o"), "chunk"))
    upto = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding,
                                                                Window.currentRow)
    pieces = loose.select("file", "at", "chunk", F.last("_o", ignorenulls=True).over(upto)
                          .alias("_owner"), F.last("upto", ignorenulls=True).over(upto)
                          .alias("_end")).where("at < _end")
    bodies = pieces.groupBy("file", "_owner").agg(
        F.sort_array(F.collect_list(F.struct("at", "chunk"))).alias("_parts"))

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                data = MAGIC.encode().join(p["chunk"] or b"" for p in row["_parts"])
                f = _fields(data)
                body = _payload(data[f["body"]:f["body"] + f["length"]])
                out.append((row["file"], row["_owner"], len(body), _digest(body)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*out) if out else [()] * 4,
                    (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                names=["file", "at", "payload_bytes", "payload_digest"])

    joined = bodies.mapInArrow(join_up,
                               "file string, at long, payload_bytes long, payload_digest string")
    columns = ["file", "at", "type", "page_id", "refers_to", "claimed", "payload_bytes",
               "payload_digest"]
    rebuilt = open_.drop("payload_bytes", "payload_digest").join(joined, ["file", "at"])
    return whole.select(*columns).unionByName(rebuilt.select(*columns))


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the pages as WARC archives and reads them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to.  A revisit has the payload of the
    response it refers to."""
    spark = pages.sparkSession
    path = write_archives(records(pages, min_bytes), scratch(spark, "warc"))
    read = written(read_records(spark, path), "warc-records")
    responses = read.where("type = 'response'")
    payloads = responses.groupBy(F.col("page_id").alias("refers_to"),
                                 F.col("payload_digest").alias("claimed")).agg(
        F.first("payload_bytes").alias("payload_bytes"))
    revisits = read.where("type = 'revisit'").drop("payload_bytes", "payload_digest").join(
        payloads, ["refers_to", "claimed"]).withColumnRenamed("claimed", "payload_digest")
    columns = ["page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
               "refers_to"]
    return responses.select(*columns).unionByName(revisits.select(*columns))
