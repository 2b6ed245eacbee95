"""WARC archives with revisit records, read back by boundary-chain verification.

**Writing.** One WARC/1.1 record per page: the payload's SHA-1, a response with the page as an
HTTP message, or, where a page with the same payload of at least ``MIN_REVISIT`` bytes and a
larger id exists, a revisit that refers to it and holds the HTTP header only. Records are
written by Spark's text sink with the record end as line separator, so a lost task is
written again and no file is left half.

**Reading.** The archives are split at the magic ``WARC/1.1``, which also stands in payloads.
Each task emits, for every place of the magic in its file blocks, the candidate record and
the offset at which its declared length says the next one begins (``_candidates``). Offsets
are absolute after adding the sizes of the file's earlier blocks. Within a block the chains
are followed to where they leave it; pointer jumping over these exits, doubling its reach
each round, finds the entries that the file's start leads to, and only records on their
chains are kept. A magic inside a payload is on no such chain, whatever header follows it.
Payloads that hold the magic are put together from their parts, found by absolute offsets in
a written table, so that it doesn't matter how Spark splits the files at either read; a
record that isn't found again is an error. Groups are blocks of a file and single
records, never more.

Defined results: a null html is the empty payload; a null or odd url is written with control
characters and blanks escaped; pages that share the largest id of a payload are all
responses; a group of equal payloads without any id is all responses; smaller payloads
are always responses; no pages give no records; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, table, written

MAGIC, END = "WARC/1.1\r\n", "\r\n\r\n"
MIN_REVISIT = 1000
#: Bytes of a file in which parts look for the record that holds them.
CELL = 1 << 14
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CANDIDATE = ("file string, block long, local long, size long, length long, kind string, page_id long, refers_to long, "
             "digest string, payload_bytes long, whole boolean")


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Writes the records of all pages below ``path``."""
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("id"), F.col(f"`{url}`").cast("string").alias("uri"),
                        payload.alias("payload"), F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).alias("n"))
    same = rows.where(F.col("n") >= MIN_REVISIT).groupBy("digest").agg(F.max("id").alias("keep"), F.count("*").alias("copies"))
    same = written(same.where("copies > 1 AND keep IS NOT NULL").select("digest", "keep"), "payloads")
    rows = rows.join(same, "digest", "left")
    revisit = F.col("keep").isNotNull() & ~F.col("id").eqNullSafe(F.col("keep"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n"), F.lit(END))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))
    header = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name("id"), F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce("uri", F.lit("")), r"[\x00-\x20\x7F]", "%20"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name("keep"))).otherwise(""),
        F.lit("\r\nContent-Length: "), block, F.lit(END))
    record = F.concat(header, http, F.when(revisit, "").otherwise(F.col("payload")))
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def _parsed(body: bytes) -> tuple | None:
    """(bytes from the magic to the next record, kind, page, refers to, digest, payload
    bytes, payload or None if it isn't whole) of what follows a magic; None if no header."""
    cut = body.find(b"\r\n\r\n")
    if cut < 0:
        return None
    fields = dict(re.findall(rb"(?m)^([A-Za-z-]+): *([^\r\n]*)", body[:cut]))
    fields = {k.lower(): v for k, v in fields.items()}
    length = fields.get(b"content-length", b"")
    if not length.isdigit() or b"warc-type" not in fields:
        return None
    number = lambda v: int(m[1]) if (m := re.fullmatch(rb"<urn:page:(-?\d+)>", v)) else None
    block = body[cut + 4:cut + 4 + int(length)]
    http = block.find(b"\r\n\r\n")
    said = re.search(rb"(?i)content-length: *(\d+)", block[:max(http, 0)])
    whole = len(body) >= cut + 8 + int(length)
    return (len(MAGIC) + cut + 8 + int(length), fields[b"warc-type"].decode("utf-8", "replace"), number(fields.get(b"warc-record-id", b"")),
            number(fields.get(b"warc-refers-to", b"")), fields.get(b"warc-payload-digest", b"").decode("ascii", "replace").removeprefix("sha1:"),
            int(said[1]) if said else None, block[http + 4:] if whole and http >= 0 else None)


def _record(body: bytes) -> tuple:
    """The columns from ``length`` on of a candidate; a response's digest and payload bytes
    are those of the payload read, if it is whole."""
    if (parsed := _parsed(body)) is None:
        return (None,) * 6 + (False,)
    length, kind, page, refers, digest, n, payload = parsed
    if kind == "response" and payload is not None:
        digest, n = hashlib.sha1(payload).hexdigest(), len(payload)
    return length, kind, page, refers, digest, n, payload is not None or kind != "response"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """(file, block, place of its first byte in the block, bytes) of each part between magics."""
    at, place = None, 0
    for batch in batches:
        for file, block, body in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if (file, block) != at:
                at, place = (file, block), 0
            yield file, block, place, body
            place += len(body) + len(MAGIC)


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    long, text = pa.int64(), pa.string()
    schema = pa.schema([("file", text), ("block", long), ("local", long), ("size", long), ("length", long), ("kind", text), ("page_id", long),
                        ("refers_to", long), ("digest", text), ("payload_bytes", long), ("whole", pa.bool_())])
    return _batched(((file, block, place, len(body), *_record(body)) for file, block, place, body in _parts(batches)), schema)


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("local", pa.int64()), ("body", pa.binary())])
    return _batched(_parts(batches), schema, 200)


def _split(spark, path: str) -> DataFrame:
    """(file, block, body) of the parts between magics, in the order of the file."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("body"))


def _exits(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Where each candidate's chain leaves the block; null if it breaks inside."""
    rows = rows.sort_values("at", ascending=False)
    end, known, out = int(rows["end"].iloc[0]), {}, []
    for at, length in zip(rows["at"], rows["length"], strict=True):
        exit_ = None
        if not pd.isna(length):
            following = int(at + length)
            exit_ = following if following >= end else known.get(following)
        known[int(at)] = exit_
        out.append(exit_)
    return pd.DataFrame({"file": rows["file"], "at": rows["at"], "exit": pd.array(out, "Int64")})


def _walked(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The candidates on the chain from the block's entry."""
    follows = dict(zip(rows["at"].tolist(), rows["length"].tolist(), strict=True))
    at, kept = int(rows["entry"].iloc[0]), set()
    while at in follows and not pd.isna(follows[at]):
        kept.add(at)
        at = int(at + follows[at])
    return rows[rows["at"].isin(kept)][["file", "block", "at"]]


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, block, at) of the records that the file's start leads to; ``candidates`` has
    file, block, at (offset of the magic), length and end (offset where the block ends)."""
    exits = written(candidates.select("file", "block", "at", "length", "end").groupBy("file", "block")
                    .applyInPandas(_exits, "file string, at long, exit long"), "exits")
    entries = exits.select("file", F.col("exit").alias("at")).where("at IS NOT NULL").distinct().unionByName(
        exits.where("at = 0").select("file", "at")).distinct()
    hops = written(exits.join(entries, ["file", "at"]).where("exit IS NOT NULL"), "hops")  # one or so per block
    reached = exits.where("at = 0").select("file", "at")
    while True:
        further = reached.join(hops, ["file", "at"]).select("file", F.col("exit").alias("at"))
        new = written(further.join(entries, ["file", "at"], "left_semi").join(reached, ["file", "at"], "left_anti").distinct(), "reached")
        if new.isEmpty():
            break
        reached = written(reached.union(new), "reached")
        double = hops.select("file", F.col("at").alias("exit"), F.col("exit").alias("end"))
        hops = written(hops.join(double, ["file", "exit"]).select("file", "at", F.col("end").alias("exit")), "hops")
    starts = candidates.join(reached, ["file", "at"], "left_semi").groupBy("file", "block").agg(F.min("at").alias("entry"))
    return candidates.select("file", "block", "at", "length").join(starts, ["file", "block"]).groupBy("file", "block") \
        .applyInPandas(_walked, "file string, block long, at long")


def _joined(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """A record put together from the parts between the magics in its payload."""
    body = MAGIC.encode().join(rows.sort_values("part")["body"])
    return pd.DataFrame([(key[0], key[1], *_record(body))], columns=["file", "at", "length", "kind", "page_id", "refers_to", "digest",
                                                                      "payload_bytes", "whole"]).astype({"refers_to": "Int64", "page_id": "Int64"})


def read_archives(spark, path: str) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    found = written(_split(spark, path).mapInArrow(_candidates, CANDIDATE), "candidates")
    blocks = found.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    blocks = written(_bases(blocks), "blocks")
    # a part begins after its magic; the first part of a file has none before it
    placed = written(found.join(blocks, ["file", "block"]).withColumn("at", F.col("base") + F.col("local") - len(MAGIC)).where("at >= 0"), "placed")
    kept = written(reachable(placed), "reachable")
    columns = ["page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to"]
    records = placed.join(kept.select("file", "at"), ["file", "at"], "left_semi")
    whole = records.where("whole").select(*columns)
    broken = written(records.where("NOT whole").select("file", "at", (F.col("at") + F.col("length")).alias("until")), "broken")
    if broken.isEmpty():
        return whole
    # the parts of these files are read again, written once and placed by their own blocks: the
    # second read may be split differently from the first
    stored = written(_split(spark, path).join(broken.select("file").distinct(), "file", "left_semi")
                     .mapInArrow(_bodies, "file string, block long, local long, body binary"), "bodies")
    parts = stored.join(_bases(stored.groupBy("file", "block").agg(F.sum(F.octet_length("body") + len(MAGIC)).alias("bytes"))), ["file", "block"]) \
        .select("file", (F.col("base") + F.col("local") - len(MAGIC)).alias("part"), "body")
    cell = lambda offset: F.floor(offset / CELL)
    owners = broken.select("file", F.col("at").alias("own"), "until", F.explode(F.sequence(cell(F.col("at")), cell(F.col("until")))).alias("cell"))
    held = parts.withColumn("cell", cell(F.col("part"))).join(owners, ["file", "cell"]).where("own <= part AND part < until")
    again = held.select("file", "own", "part", "body").groupBy("file", "own").applyInPandas(
        _joined, "file string, at long, length long, kind string, page_id long, refers_to long, digest string, payload_bytes long, whole boolean")
    found = broken.select("file", "at").join(again, ["file", "at"], "left")
    lost = F.raise_error(F.lit("a record of the archive was not found again")).cast("string")
    return whole.unionByName(found.withColumn("kind", F.coalesce("kind", lost)).select(*columns))


def _bases(blocks: DataFrame) -> DataFrame:
    """(file, block, base, end): where the parts of a block begin and end in the file, from
    the bytes of each block (magics included)."""
    upto = F.sum("bytes").over(Window.partitionBy("file").orderBy("block"))  # one row per block
    return blocks.select("file", "block", (upto - F.col("bytes")).alias("base"), (upto - len(MAGIC)).alias("end"))


def op3_warc(spark, sf_dir):
    path = scratch(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path)


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS d FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS keep FROM q)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> keep THEN keep END AS refers_to FROM k
"""
