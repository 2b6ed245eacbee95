"""Exact deduplication with a cuckoo-filter index of live digests.

Documents become digests: SHA-256 of the whole text after lower-casing A-Z. The digests
are dealt to shards by a hash of their own; in each shard a cuckoo filter (16-bit
fingerprints, four slots a bucket, two candidate buckets) answers first. A miss means the
digest is new; a hit is verified against the full digests stored under its bucket, so a
fingerprint collision never merges two texts. When an insertion finds no slot after
``MAX_KICKS`` moves, the filter is doubled and rebuilt from the stored keys.

Deletion is by copy. Beside the entries the index keeps its live rows (digest, doc_id), so
that the copies left are counted and the largest doc_id among them found by grouped
aggregation, never inside a shard; a digest's fingerprint and key go with its last copy.

A shard is sized for ``SHARD_KEYS`` entries, so the number of shards grows with the data;
an insertion that outgrows them deals the stored digests to more.
Copies are combined within each batch before they are shuffled: a text with a billion
copies reaches its shard as one row per batch that read it.

Defined results: null and empty texts are equal (the empty text); the largest doc_id of
equal texts stays, nulls count below every id, and if all ids are null ``keep_id`` is null;
rows that repeat the kept id are the same document and are all marked kept (``distinct``
then keeps one of them); very long texts are hashed whole; an empty table gives an empty
result; deleting a row that isn't live changes nothing, deleting one of several equal rows
takes away one; input columns beyond id and text are never read by the index.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, table, written

SLOTS, FINGERPRINT_BITS, MAX_KICKS, START_BUCKETS = 4, 16, 200, 1024
SHARD_KEYS = 200_000
ENTRY = "shard int, digest binary, keep_id long, n long"


class CuckooFilter:
    """Approximate membership of 64-bit keys with deletion. ``insert`` returns False when
    it is full; its owner then rebuilds a larger one."""

    def __init__(self, n_buckets: int = START_BUCKETS):
        self.mask = n_buckets - 1  # a power of two, so that the two buckets name each other
        self.slots: list[list[int]] = [[] for _ in range(n_buckets)]

    def places(self, key: int) -> tuple[int, int, int]:
        fp = (key >> 48) % ((1 << FINGERPRINT_BITS) - 1) + 1
        first = key & self.mask
        return fp, first, self.other(first, fp)

    def other(self, bucket: int, fp: int) -> int:
        return bucket ^ ((fp * 0x5BD1E995) & self.mask)

    def contains(self, key: int) -> bool:
        fp, a, b = self.places(key)
        return fp in self.slots[a] or fp in self.slots[b]

    def insert(self, key: int) -> bool:
        fp, a, b = self.places(key)
        for bucket in (a, b):
            if len(self.slots[bucket]) < SLOTS:
                self.slots[bucket].append(fp)
                return True
        bucket = b
        for kick in range(MAX_KICKS):
            row = self.slots[bucket]
            row[kick % SLOTS], fp = fp, row[kick % SLOTS]
            bucket = self.other(bucket, fp)
            if len(self.slots[bucket]) < SLOTS:
                self.slots[bucket].append(fp)
                return True
        return False

    def delete(self, key: int) -> bool:
        fp, a, b = self.places(key)
        for bucket in (a, b):
            if fp in self.slots[bucket]:
                self.slots[bucket].remove(fp)
                return True
        return False


class Shard:
    """A filter and, by the filter's first bucket, the stored keys with their records."""

    def __init__(self, n_buckets: int = START_BUCKETS):
        self.filter = CuckooFilter(n_buckets)
        self.content: dict[int, list[list]] = {}
        self.resized = 0

    @staticmethod
    def key(digest: bytes) -> int:
        return int.from_bytes(digest[:8], "little")

    def find(self, digest: bytes) -> list | None:
        key = self.key(digest)
        if not self.filter.contains(key):
            return None
        return next((r for r in self.content.get(key & self.filter.mask, ()) if r[0] == digest), None)

    def add(self, digest: bytes, doc_id, n: int) -> None:
        if record := self.find(digest):
            record[1] = doc_id if record[1] is None else record[1] if doc_id is None else max(record[1], doc_id)
            record[2] += n
            return
        record, key = [digest, doc_id, n], self.key(digest)
        self.content.setdefault(key & self.filter.mask, []).append(record)
        if not self.filter.insert(key):
            self.grow()

    def remove(self, digest: bytes) -> bool:
        record = self.find(digest)
        if record is None:
            return False
        key = self.key(digest)
        self.filter.delete(key)
        self.content[key & self.filter.mask].remove(record)
        return True

    def replace(self, digest: bytes, doc_id, n: int) -> None:
        """The record of a live digest after a deletion; none are left when n is 0."""
        if n == 0:
            self.remove(digest)
        elif record := self.find(digest):
            record[1:] = doc_id, n

    def grow(self) -> None:
        """Twice the buckets, filled again from the stored keys."""
        records = list(self.records())
        n = len(self.filter.slots)
        while True:
            n *= 2
            self.resized += 1
            self.filter, self.content = CuckooFilter(n), {}
            for r in records:
                key = self.key(r[0])
                self.content.setdefault(key & self.filter.mask, []).append(r)
                if not self.filter.insert(key):
                    break
            else:
                return

    def records(self) -> Iterator[list]:
        for bucket in self.content.values():
            yield from bucket


def _frame(shard: int, kept: Shard) -> pd.DataFrame:
    rows = [(shard, d, i, n) for d, i, n in kept.records()]
    out = pd.DataFrame(rows, columns=["shard", "digest", "keep_id", "n"])
    out["keep_id"] = out["keep_id"].astype("Int64")
    return out


def _ids(column: pd.Series) -> list:
    return [None if pd.isna(x) else int(x) for x in column]


def _combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Copies within a batch as one row."""
    for rows in batches:
        rows["keep_id"] = rows["keep_id"].astype("Int64")
        yield rows.groupby(["shard", "digest"], as_index=False, sort=False).agg(keep_id=("keep_id", "max"), n=("n", "sum"))


def _filled(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    shard = Shard()
    for digest, doc_id, n in zip(rows["digest"], _ids(rows["keep_id"]), rows["n"], strict=True):
        shard.add(bytes(digest), doc_id, int(n))
    return _frame(int(key[0]), shard)


def _changed(key: tuple, stored: pd.DataFrame, new: pd.DataFrame, gone: bool) -> pd.DataFrame:
    shard = Shard()
    for digest, doc_id, n in zip(stored["digest"], _ids(stored["keep_id"]), stored["n"], strict=True):
        shard.add(bytes(digest), doc_id, int(n))
    for digest, doc_id, n in zip(new["digest"], _ids(new["keep_id"]), new["n"], strict=True):
        if gone:
            shard.replace(bytes(digest), doc_id, int(n))
        else:
            shard.add(bytes(digest), doc_id, int(n))
    return _frame(int(key[0]), shard)


def _found(key: tuple, stored: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    shard = Shard()
    for digest, doc_id, n in zip(stored["digest"], _ids(stored["keep_id"]), stored["n"], strict=True):
        shard.add(bytes(digest), doc_id, int(n))
    return _frame(int(key[0]), shard).iloc[:0] if asked.empty else pd.DataFrame(
        [(int(key[0]), d, *(r[1:] if r else (None, 0))) for d in {bytes(x) for x in asked["digest"]} for r in [shard.find(d)]],
        columns=["shard", "digest", "keep_id", "n"]).astype({"keep_id": "Int64"})


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest) of every document."""
    sha = F.unhex(F.sha2(ascii_lower(F.col(f"`{text}`")), 256))
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), sha.alias("digest"))


class CuckooIndex:
    """Live digests, sharded; ``entries`` holds (shard, digest, keep_id, n), ``live`` the rows
    (doc_id, digest, n) behind them."""

    def __init__(self, entries: DataFrame, n_shards: int, live: DataFrame):
        self.entries, self.n_shards, self.live = entries, n_shards, live

    @classmethod
    def build(cls, rows: DataFrame, n_rows: int | None = None) -> CuckooIndex:
        """Index of (doc_id, digest) rows, which must stay readable (a table or file); the
        shards are as many as the rows ask for."""
        n_rows = rows.count() if n_rows is None else n_rows
        n_shards = max(1, math.ceil(n_rows / SHARD_KEYS))
        n_shards = max(n_shards, min(rows.sparkSession.sparkContext.defaultParallelism * 4, math.ceil(n_rows / 1000)) or 1)
        combined = cls._dealt(rows, n_shards)
        return cls(written(combined.groupBy("shard").applyInPandas(_filled, ENTRY), "cuckoo"), n_shards, _copies(rows))

    @staticmethod
    def _shard(n_shards: int) -> Column:
        return F.pmod(F.crc32("digest"), F.lit(n_shards)).cast("int").alias("shard")

    @classmethod
    def _dealt(cls, rows: DataFrame, n_shards: int) -> DataFrame:
        return rows.select(cls._shard(n_shards), "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n")) \
            .mapInPandas(_combined, ENTRY)

    @staticmethod
    def _with(entries: DataFrame, new: DataFrame, change) -> DataFrame:
        return entries.groupBy("shard").cogroup(new.groupBy("shard")).applyInPandas(change, ENTRY)

    def insert(self, rows: DataFrame) -> CuckooIndex:
        """The index with further (doc_id, digest) rows. Where the stored digests and the
        new rows ask for more shards, both are dealt to those."""
        rows = written(rows.select("doc_id", "digest"), "inserted")
        n_shards = max(self.n_shards, math.ceil((self.entries.count() + rows.count()) / SHARD_KEYS))
        entries = self.entries.withColumn("shard", self._shard(n_shards))
        entries = written(self._with(entries, self._dealt(rows, n_shards), lambda k, a, b: _changed(k, a, b, False)), "cuckoo")
        live = self.live.unionByName(_copies(rows)).groupBy("doc_id", "digest").agg(F.sum("n").alias("n"))
        return CuckooIndex(entries, n_shards, written(live, "cuckoo-live"))

    def delete(self, rows: DataFrame) -> CuckooIndex:
        """The index without one copy for each of these (doc_id, digest) rows; rows that aren't
        live change nothing."""
        gone = written(_copies(rows), "deleted").select(F.col("doc_id").alias("id"), F.col("digest").alias("sha"), F.col("n").alias("less"))
        same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("sha"))
        left = F.greatest(F.col("n") - F.coalesce("less", F.lit(0)), F.lit(0))
        live = written(self.live.join(gone, same, "left").select("doc_id", "digest", left.alias("n"), F.col("less").isNotNull().alias("hit")), "cuckoo-live")
        touched = live.where("hit").select("digest").distinct()
        after = live.join(touched, "digest", "left_semi").groupBy("digest").agg(
            F.max(F.when(F.col("n") > 0, F.col("doc_id"))).alias("keep_id"), F.sum("n").alias("n"))
        after = after.select(self._shard(self.n_shards), "digest", "keep_id", "n")
        entries = written(self._with(self.entries, after, lambda k, a, b: _changed(k, a, b, True)), "cuckoo")
        return CuckooIndex(entries, self.n_shards, live.where("n > 0").drop("hit"))

    def lookup(self, rows: DataFrame) -> DataFrame:
        """(digest, keep_id, n) of the digests asked for; n is 0 for those not live."""
        return self._with(self.entries, self._dealt(rows, self.n_shards), _found).select("digest", "keep_id", "n")


def _copies(rows: DataFrame) -> DataFrame:
    """(doc_id, digest, n): equal rows as one."""
    return rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = written(digests(docs, doc_id, text), "digests")
    entries = CuckooIndex.build(rows).entries.select("digest", "keep_id", F.col("n").alias("group_size"))
    return rows.join(entries, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def distinct(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their columns: one row for each different text."""
    entries = CuckooIndex.build(written(digests(docs, doc_id, text), "digests")).entries
    keep = entries.select(F.col("keep_id").alias("id"), F.col("digest").alias("sha"))
    packed = docs.select(F.struct("*").alias("row"), F.col(f"`{doc_id}`").cast("long").alias("id"),
                         F.unhex(F.sha2(ascii_lower(F.col(f"`{text}`")), 256)).alias("sha"))
    same = packed["id"].eqNullSafe(keep["id"]) & (packed["sha"] == keep["sha"])
    stays = packed.join(keep, same, "left_semi")
    once = F.row_number().over(Window.partitionBy("id", "sha").orderBy("id"))
    return stays.withColumn("copy", once).where("copy = 1").select("row.*")


def op10_cuckoo_dedup(spark, sf_dir):
    return dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP10_SQL = """
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, h AS text_sha256
FROM n WINDOW w AS (PARTITION BY h)
"""
