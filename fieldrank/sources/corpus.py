"""Corpus files (S2), statistics snapshots (S6) and the query vocabulary file.

Output locations are folders under the session's shared ``spark.checkpoint.dir`` (see
``session.checkpoint_dir``), never a machine-local temporary folder.
"""

from __future__ import annotations

import os
import uuid
from hashlib import sha1
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldrank.session import checkpoint_dir

#: Files a task of ``write_corpus`` writes, about; splits a task of ``scan_corpus`` reads; and the name of a
#: null or empty value, as Spark's writer has it.
TASK_FILES = 2_000
TASK_SPLITS = 64
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/fieldrank-{name}-{uuid.uuid4().hex[:12]}"


def write_corpus(docs: DataFrame, root: str, dir_col: str = "source", mode: str = "overwrite") -> None:
    """One document per file in a two-level tree ``root/dir=<dir>/<doc>``; rows of one (dir, doc) are
    lines of one file, null and empty names count as one. Documents are dealt over tasks of about
    ``TASK_FILES`` files by both names, so a large directory is written by many.

    On a local or mounted file system the tasks write the files themselves, named by the document
    (Hadoop's local file system starts a ``chmod`` process for each file and each checksum); on any
    other Spark's writer does, one record per file with a commit per task, and names them itself."""
    spark = docs.sparkSession
    name = lambda c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(NO_VALUE))
    rows = docs.select(name(dir_col).alias("dir"), name("doc_id").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    files = rows.repartition(max(1, -(-docs.count() // TASK_FILES)), "dir", "doc").groupBy("dir", "doc") \
        .agg(F.array_join(F.sort_array(F.collect_list("text")), "\n").alias("text"))  # a file's rows: one document
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() != "file":
        (files.drop("doc").write.mode(mode).partitionBy("dir").option("maxRecordsPerFile", 1)
         .option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(root))
        return
    rows.where(F.lit(False)).write.mode(mode).partitionBy("dir", "doc").text(root)  # the folder, as the mode says
    write = _file_writer(place.toUri().getPath(), uuid.uuid4().hex[:12])
    files.mapInArrow(write, "files long").agg(F.sum("files")).collect()


def _file_writer(root: str, run: str):
    """Writes each row (dir, doc, text) as Spark's text writer would. A file appears whole, under a name
    that only the document and the write decide, so a task that runs again replaces its own files."""
    def fitting(name: str) -> str:
        name = quote(name, safe=" ")
        return name if len(name) <= 200 else f"{name[:150]}-{sha1(name.encode()).hexdigest()}"

    def write(batches):
        made, n = set(), 0
        for batch in batches:
            for folder, doc, text in zip(*(column.to_pylist() for column in batch.columns)):
                where, name = f"{root}/dir={fitting(folder)}", f"{fitting(doc)}-{run}.txt"
                if where not in made:
                    os.makedirs(where, exist_ok=True)
                    made.add(where)
                attempt = f"{where}/.{run}-{TaskContext.get().taskAttemptId()}"
                with open(attempt, "wb") as out:
                    out.write(text.encode() + b"\n")
                os.replace(attempt, f"{where}/doc={name}")
                n += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([n], pa.int64())})
    return write


def scan_corpus(spark: SparkSession, root: str) -> DataFrame:
    """(path, text) — every file under ``root`` is one document (whole-file text).
    ``wholetext`` needs one file to fit in a task; small files are packed into splits by
    ``spark.sql.files.maxPartitionBytes`` / ``openCostInBytes``, a few in each, and a task reads up to
    ``TASK_SPLITS`` splits in turn, as long as there are some tasks for every core."""
    # keyword arguments: ``text()`` would reset an earlier ``.option("wholetext", ...)``
    df = spark.read.text(root, wholetext=True, recursiveFileLookup=True)
    splits, least = df.rdd.getNumPartitions(), 4 * spark.sparkContext.defaultParallelism
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")).coalesce(max(least, -(-splits // TASK_SPLITS)))


def snapshot(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Persist a statistics table as parquet and return the re-read table. Unlike the
    reference's cache file, the caller names the path and the mode; nothing is reused
    implicitly from an earlier run."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def load_or_compute(spark: SparkSession, path: str, compute) -> DataFrame:
    """Read the snapshot at ``path`` if it exists, else compute, write and re-read it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.read.parquet(path)  # a damaged snapshot is an error, never overwritten
    return snapshot(compute(), path)


def write_vocab(terms: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Query vocabulary file: one token per line."""
    terms.select(F.col("term").alias("value")).distinct().write.mode(mode).text(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """(term) from a one-token-per-line file (blank lines dropped)."""
    v = spark.read.text(path).select(F.trim("value").alias("term"))
    return v.where(F.length("term") > 0).distinct()
