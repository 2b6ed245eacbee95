"""A stored page index (T9, A3-A5): segments, replaced and removed pages, merge.

The parsed pages and their index are written once and shared by all rankers: ``pages`` html is
read when a segment is added, never when one ranks. Below ``path`` lie

* ``coll``: the parsed pages, one row per version of a page;
* ``terms``: the index of each version (``operators.index``), a row per page with its terms and postings in
  arrays, written in buckets of the page, so that a ranker joins them without an exchange of the index;
* ``removed``: (page, segment) of removed pages;
* ``log``: one row per finished change. It is written last, and only segments in it count, so a
  change that failed half-way leaves nothing that is read.

A version is named "page:segment" and is the ``page_id`` of the index, so nothing of an older
version is ever joined. Which version of a page is live (the newest, unless a later removal)
is decided on ``coll`` alone, for the candidate pairs. ``add`` and ``remove`` only append
files; ``merge`` writes the live versions to a new folder and leaves the old one to its
owner. A page's id must be a number and unique within one ``add``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldrank.operators.index import PageIndex, kept_index, page_rows, page_rows_of_repeated
from fieldrank.plans.rankers import RankingJob, ranked
from fieldrank.sources.corpus import scratch_path, snapshot
from fieldrank.sources.tables import candidates

#: The bucket columns of the index table.
KEYS = {"terms": ["page_id"]}


@dataclass
class IndexStore:
    spark: SparkSession
    path: str
    buckets: int = 64
    name: str = field(default_factory=lambda: f"fieldrank_{uuid.uuid4().hex[:12]}")

    # ---- changes -------------------------------------------------------------------
    def add(self, collection: DataFrame) -> int:
        """Adds or replaces the pages of ``collection`` as a new segment; its number."""
        segment = self._next()
        versions = collection.withColumn("page", F.col("page_id").cast("long")).withColumn("segment", F.lit(segment)) \
            .withColumn("page_id", F.concat_ws(":", "page", "segment"))
        versions.write.mode("append").parquet(f"{self.path}/coll")
        own = self.spark.read.parquet(f"{self.path}/coll").where(F.col("segment") == segment)  # html is read once
        self._write(self._rows(own.withColumn("url_pos", F.col("page"))))
        self._done(segment, "add")
        return segment

    def remove(self, pages: DataFrame) -> int:
        """Removes the pages (``page_id``) that were added so far; the number of the change."""
        segment = self._next()
        pages.select(F.col("page_id").cast("long").alias("page"), F.lit(segment).alias("segment")).write.mode("append").parquet(f"{self.path}/removed")
        self._done(segment, "remove")
        return segment

    def merge(self, path: str) -> "IndexStore":
        """A store at ``path`` with the live versions only, as one segment."""
        new = IndexStore(self.spark, path, self.buckets)
        live = snapshot(self.live(), f"{path}/live")  # its size is known then, and no page is shuffled for a small one
        self.versions().join(live, "page_id", "left_semi").drop("url_pos").write.parquet(f"{path}/coll")
        rows = self.spark.read.parquet(f"{self.path}/terms")  # files, not buckets: each new bucket gets one file
        new._write(rows.join(live, "page_id", "left_semi"))
        self._log().where("kind = 'add'").write.parquet(f"{path}/log")
        return new

    # ---- views ---------------------------------------------------------------------
    def versions(self) -> DataFrame:
        """All versions of the parsed pages of finished changes; ``page_id`` names the version, ``page`` the
        page, which also orders equal scores."""
        done = F.broadcast(self._log().select("segment"))  # a row per change
        return self.spark.read.parquet(f"{self.path}/coll").join(done, "segment", "left_semi").withColumn("url_pos", F.col("page"))

    def live(self) -> DataFrame:
        """``page_id`` of the version of each page that counts."""
        changes = self.versions().select("page", "segment", F.lit(True).alias("there"))
        if self._exists("removed"):
            done = F.broadcast(self._log().select("segment"))
            gone = self.spark.read.parquet(f"{self.path}/removed").join(done, "segment", "left_semi")
            changes = changes.unionByName(gone.select("page", "segment", F.lit(False).alias("there")))
        return changes.groupBy("page").agg(F.max(F.struct("segment", "there")).alias("last")) \
            .where("last.there").select(F.concat_ws(":", "page", "last.segment").alias("page_id"))

    def collection(self) -> DataFrame:
        """The live versions of the parsed pages."""
        return self.versions().join(self.live(), "page_id", "left_semi")

    def index(self) -> PageIndex:
        """The index of all versions."""
        return kept_index(self._table("terms"), self.buckets)

    def job(self, queries: DataFrame, corpus: DataFrame) -> RankingJob:
        """Rankers over the live pages: candidates from the stored words (of all versions, then the live
        ones: no words are exchanged), all else from the index."""
        versions = self.versions()
        pairs = candidates(queries, versions).join(self.live(), "page_id", "left_semi")
        return RankingJob(queries, versions, corpus, pairs, stored=self.index())

    # ---- files ---------------------------------------------------------------------
    def _log(self) -> DataFrame:
        return self.spark.read.schema("segment int, kind string").parquet(f"{self.path}/log")

    def _exists(self, part: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def _next(self) -> int:
        """A number above those of all changes, unfinished ones included."""
        parts = [self.spark.read.parquet(f"{self.path}/{part}").agg(F.max("segment")).first()[0] for part in ("log", "coll", "removed") if self._exists(part)]
        return max([0, *filter(None, parts)]) + 1

    def _done(self, segment: int, kind: str) -> None:
        self.spark.createDataFrame([(segment, kind)], "segment int, kind string").coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def _rows(self, own: DataFrame) -> DataFrame:
        """The index rows of a segment's pages; only ids that repeat, if any, take the way of a shuffle."""
        repeated = snapshot(own.groupBy("page_id").count().where("count > 1").select("page_id"), scratch_path(self.spark, "repeated"))
        if repeated.isEmpty():
            return page_rows(own)
        own = own.join(repeated.withColumn("_repeated", F.lit(True)), "page_id", "left")
        return page_rows(own.where("_repeated IS NULL")).unionByName(page_rows_of_repeated(own.where("_repeated")))

    def _write(self, rows: DataFrame) -> None:
        for table, keys in KEYS.items():
            self._open(table)
            rows.repartition(self.buckets, *keys).write.bucketBy(self.buckets, *keys).sortBy(*keys).mode("append").format("parquet") \
                .option("path", f"{self.path}/{table}").saveAsTable(f"{self.name}_{table}")

    def _open(self, table: str) -> None:
        """Names a table that an earlier session wrote."""
        if self.spark.catalog.tableExists(f"{self.name}_{table}"):
            return
        if self._exists(table):
            columns = self.spark.read.parquet(f"{self.path}/{table}").schema.toDDL()
            self.spark.sql(f"CREATE TABLE {self.name}_{table} ({columns}) USING parquet CLUSTERED BY ({', '.join(KEYS[table])}) "
                           f"SORTED BY ({', '.join(KEYS[table])}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{table}'")

    def _table(self, table: str) -> DataFrame:
        self._open(table)
        return self.spark.table(f"{self.name}_{table}")


def ranked_pages(scored: DataFrame, digits: int = 6) -> DataFrame:
    """``ranked`` with the page's own id in place of its version's."""
    return ranked(scored, digits).withColumn("page_id", F.substring_index("page_id", ":", 1).cast("long"))
