"""Views over the parquet test tables that give the rankers their inputs.

The test tables hold raw text, not (query, page) feature records, so the inputs are
derived by fixed rules (the same rules are spelled in SQL in ``fieldrank/oracle.py``):

* queries:    every sentence of every ``benchmark`` text (split on ``.!?`` and newlines),
              lower-cased, normalised to its words (letters, digits and ``_`` of any script);
              ``query_id`` is "item-sentence". Whole texts, all rows.
* pages:      ``pages.html`` parsed into url, title, ``<h1>`` headers, link-text anchors (case
              kept) and the lower-cased words of all its text outside tags as body; anchor
              count = occurrences + page_id % 5; pagerank = page_id % 11 (stand-ins, stated
              openly).
* documents:  the corpus for document frequencies (whitespace tokens, case kept).
* judged pages: the pages whose id has a ``labels`` row, with all five fields,
              relevance ``2 * quality - toxic`` (grades -1..2).
* candidates: the (query, page) pairs to rank: the page's body holds a run of ``RUN_WORDS``
              consecutive words of the query (of all its words, if it has fewer).

A *collection* is one row per page with the schema
``page_id, url, title, headers, anchors array<struct<text,cnt>>, body_tokens,
body_length, pagerank[, rel]``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldrank.functions.text import regex_tokens

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

SENTENCE_SPLIT = r"[.!?\n]+"
WORD = r"[\p{L}\p{N}_]+"
RUN_WORDS = 4
#: Longs in the bitmap of the query runs (1 MB): of runs that no query has, about one in
#: 8,000,000 / (runs of the queries) passes it.
BITMAP_WORDS = 1 << 17


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id STRING, query STRING)."""
    b = table(spark, sf_dir, "benchmark").select(
        "item_id", F.posexplode(F.split(F.col("text"), SENTENCE_SPLIT, -1)).alias("sno", "sent")
    )
    words = F.regexp_extract_all(F.lower(F.col("sent")), F.lit(WORD), 0)
    return (
        b.where(F.size(words) > 0)
        .select(
            F.concat_ws("-", "item_id", "sno").alias("query_id"),
            F.array_join(words, " ").alias("query"),
        )
    )


def _norm_text(x):
    return F.array_join(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(WORD), 0), " ")


def pages_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    title = _norm_text(F.regexp_extract(html, "<title>([^<]*)</title>", 1))
    headers = F.transform(F.regexp_extract_all(html, F.lit("<h1>([^<]*)</h1>"), 1), _norm_text)
    body = regex_tokens(F.regexp_replace(html, "<[^>]*>", " "), WORD)
    links = F.filter(
        F.transform(F.regexp_extract_all(html, F.lit('<a href="[^"]*">([^<]*)</a>'), 1), _norm_text),
        lambda x: x != F.lit(""),
    )
    p = table(spark, sf_dir, "pages").select(
        "page_id", "url", title.alias("title"), headers.alias("headers"),
        body.alias("body_tokens"), links.alias("links"),
    )
    # anchors: distinct link texts of the page with their count (+ page_id % 5); built
    # inside the row, so no shuffle is needed
    anchors = F.transform(
        F.array_distinct(F.col("links")),
        lambda t: F.struct(
            t.alias("text"),
            (F.size(F.filter(F.col("links"), lambda x: x == t)) + (F.col("page_id") % 5)).cast("int").alias("cnt"),
        ),
    )
    return p.select(
        "page_id", "url", "title", "headers", anchors.alias("anchors"), "body_tokens",
        F.size("body_tokens").cast("int").alias("body_length"),
        (F.col("page_id") % 11).cast("int").alias("pagerank"),
    )


def judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, rel DOUBLE) with rel = 2 * quality - toxic."""
    return table(spark, sf_dir, "labels").select(
        "doc_id", (2 * F.col("quality") - F.col("toxic")).cast("double").alias("rel")
    )


def judged_pages_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with a judgment of their id, all fields, carrying ``rel``."""
    j = judgments(spark, sf_dir).withColumnRenamed("doc_id", "page_id")
    return pages_collection(spark, sf_dir).join(j, "page_id")


def _runs(words: Column, n: int) -> Column:
    """The runs of ``n`` consecutive words, as strings; none if there are fewer words."""
    some = F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(F.size(words) >= n, some).otherwise(F.array().cast("array<string>"))


def run_hash(words: Column, at: Column, n: int) -> Column:
    """64-bit hash of the ``n`` words from the (0-based) place ``at``."""
    return F.xxhash64(F.lit(n), *[F.get(words, at + i) for i in range(n)])


def bitmap(hashes: DataFrame, words: int = BITMAP_WORDS) -> DataFrame:
    """One row ``bits array<long>``: ``words`` longs with one bit set for each hash ``h``. Its
    size doesn't depend on how many there are; more of them only let more false hits pass."""
    at = F.pmod(F.col("h"), F.lit(words * 64))
    marked = hashes.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(at & 63))")).alias("marks"))
    every = hashes.sparkSession.range(0, words, 1, 1).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("marks"))
    full = marked.unionByName(every).groupBy("word").agg(F.bit_or("marks").alias("marks"))
    return full.agg(F.sort_array(F.collect_list(F.struct("word", "marks"))).alias("all")).select(F.col("all.marks").alias("bits"))


def in_bitmap(h: Column, bits: Column, words: int = BITMAP_WORDS) -> Column:
    """Whether the bit of a hash is set: always for the hashes the bitmap was built of."""
    at = F.pmod(h, F.lit(words * 64))
    return F.getbit(F.element_at(bits, (F.shiftright(at, 6) + 1).cast("int")), at.bitwiseAND(63).cast("int")) == 1


def query_runs(queries: DataFrame) -> DataFrame:
    """(query_id, run): the runs of ``RUN_WORDS`` words of a query, all its words if fewer."""
    q = queries.select("query_id", F.split("query", " ").alias("w"))
    return q.select("query_id", F.explode(F.array_distinct(F.when(F.size("w") < RUN_WORDS, F.array(F.array_join("w", " ")))
                                                           .otherwise(_runs(F.col("w"), RUN_WORDS)))).alias("run"))


def candidates(queries: DataFrame, collection: DataFrame) -> DataFrame:
    """(query_id, page_id): pairs that share a run of words.

    The runs of a page are hashed inside its row and probed in a bitmap of the query runs
    (a scalar subquery of bounded size); only runs that pass it, those of some query and a
    share of false hits, are spelled out and leave the task. The join on the run itself is exact, a frequent
    run is split by adaptive execution, and runs are distinct per page before it."""
    q = query_runs(queries)
    w = F.split("run", " ")
    hashes = q.select("run").distinct().select(F.xxhash64(F.size(w), *[F.get(w, F.lit(i)) for i in range(RUN_WORDS)]).alias("h"))
    bits = bitmap(hashes).scalar()
    words, at = F.col("body_tokens"), F.col("at")
    placed = collection.select("page_id", "body_tokens", F.posexplode("body_tokens").alias("at", "_word"))
    lengths = F.array(*[F.struct(F.lit(n).alias("n"), run_hash(words, at, n).alias("h")) for n in range(1, RUN_WORDS + 1)])
    hits = placed.select("page_id", "body_tokens", "at", F.inline(lengths)) \
        .where((at + F.col("n") <= F.size(words)) & in_bitmap(F.col("h"), bits))
    p = hits.select("page_id", F.array_join(F.slice(words, at + 1, F.col("n")), " ").alias("run")).distinct()
    return p.join(q, "run").select("query_id", "page_id").distinct()


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) — the corpus for document frequencies."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")
