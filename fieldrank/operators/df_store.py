"""Document frequencies kept up to date by deltas.

Each change adds or removes a batch of documents and writes its document frequencies with a sign;
nothing that was counted before is read again. A manifest row per change is written last: only
changes in it count. It holds the batch's number of documents and its fingerprint, the sum
of a hash of every (doc_id, text). Sums add up over changes, so the store knows which documents it
stands for, in any order and however they came: ``load`` gives the statistics only for an
input with the same fingerprint, which one cheap pass over that input finds.

A document removed must be the one added (same id and text); a term whose count falls below zero is an
error when the table is read. Repeated rows count each.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldrank.operators.stats import doc_freq

MANIFEST = "change string, n_docs long, fingerprint decimal(38,0)"


def fingerprint(docs: DataFrame) -> DataFrame:
    """One row (n_docs, fingerprint) of (doc_id, text) rows, the same for any order and partitioning."""
    h = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text").cast("decimal(38,0)")
    return docs.agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)").alias("fingerprint"))


@dataclass
class DocFreqStore:
    spark: SparkSession
    path: str

    def add(self, docs: DataFrame) -> None:
        self._change(docs, 1)

    def remove(self, docs: DataFrame) -> None:
        self._change(docs, -1)

    def _change(self, docs: DataFrame, sign: int) -> None:
        change = uuid.uuid4().hex
        doc_freq(docs).select(F.lit(change).alias("change"), "term", (F.col("df") * sign).alias("df")).write.mode("append").parquet(f"{self.path}/deltas")
        fingerprint(docs).select(F.lit(change).alias("change"), (F.col("n_docs") * sign).alias("n_docs"),
                                 (F.col("fingerprint") * sign).cast("decimal(38,0)").alias("fingerprint")) \
            .coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def manifest(self) -> DataFrame:
        """(change, n_docs, fingerprint) of the finished changes."""
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")

    def state(self) -> DataFrame:
        """One row (n_docs, fingerprint) of the documents that the store stands for."""
        zero = F.lit(0).cast("decimal(38,0)")
        return self.manifest().agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"),
                                   F.coalesce(F.sum("fingerprint"), zero).cast("decimal(38,0)").alias("fingerprint"))

    def corpus_size(self) -> DataFrame:
        """As ``stats.corpus_size``: one row ``n_total``, the documents + 1."""
        return self.state().select((F.col("n_docs") + 1).alias("n_total"))

    def table(self) -> DataFrame:
        """(term, df) over all finished changes, as a full count of the documents that are left."""
        done = F.broadcast(self.manifest().select("change"))  # a row per change
        total = self.spark.read.schema("change string, term string, df long").parquet(f"{self.path}/deltas") \
            .join(done, "change", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
        below = F.raise_error(F.concat(F.lit("more documents removed than added with the term "), F.col("term"))).cast("long")
        return total.where("df <> 0").select("term", F.when(F.col("df") > 0, F.col("df")).otherwise(below).alias("df"))

    def compact(self, path: str) -> "DocFreqStore":
        """A store at ``path`` with the same state in one change; the old folder is left to its owner."""
        new, change = DocFreqStore(self.spark, path), uuid.uuid4().hex
        self.table().select(F.lit(change).alias("change"), "term", "df").write.parquet(f"{path}/deltas")
        self.state().select(F.lit(change).alias("change"), "n_docs", "fingerprint").coalesce(1).write.parquet(f"{path}/manifest")
        return new

    def load(self, docs: DataFrame) -> DataFrame | None:
        """The table if the store stands for exactly these documents, else None."""
        return self.table() if fingerprint(docs).first() == self.state().first() else None


def load_or_count(store: DocFreqStore, docs: DataFrame) -> DataFrame:
    """The stored table for these documents; where the store stands for others, a full count that
    becomes a store of its own beside it."""
    kept = store.load(docs)
    if kept is not None:
        return kept
    fresh = DocFreqStore(store.spark, f"{store.path}-{uuid.uuid4().hex[:12]}")
    fresh.add(docs)
    return fresh.table()
