"""Corpus statistics (A1, A2, J1, S7) and query-term tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldrank.functions.scoring import idf_expr, logify
from fieldrank.functions.text import tok_corpus_distinct, tok_query


def doc_freq(corpus: DataFrame, vocab: DataFrame | None = None) -> DataFrame:
    """A1: (term, df) = number of documents containing the term.

    Tokens are de-duplicated inside each document (``array_distinct``) so one
    partial+final aggregation suffices; the partial (map-side) aggregation collapses a
    term that sits in every document to one row per partition before the shuffle, so a
    stop word cannot skew the exchange. With ``vocab`` (one ``term`` column) the tokens
    are first semi-joined against it."""
    toks = corpus.select(F.explode(tok_corpus_distinct(F.col("text"))).alias("term"))
    if vocab is not None:
        toks = toks.join(vocab.select("term").distinct(), "term", "left_semi")
    return toks.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def corpus_size(corpus: DataFrame) -> DataFrame:
    """One row ``n_total`` = number of documents + 1 (the reference's count starts at 1)."""
    return corpus.agg((F.count(F.lit(1)) + 1).alias("n_total"))


def idf(df_table: DataFrame, n_total: DataFrame) -> DataFrame:
    """A2 for every term of the df table: (term, df, idf)."""
    return df_table.crossJoin(F.broadcast(n_total)).select(
        "term", "df", idf_expr(F.col("n_total"), F.col("df")).alias("idf")
    )


def query_terms(queries: DataFrame) -> DataFrame:
    """T7 + A3 per query, built inside each query row (no shuffle):
    (query_id, term, ti, n, qlen, k) — ``n`` the multiplicity of the term, ``ti`` its index
    among the query's distinct terms, ``qlen`` the token count with duplicates, ``k`` the
    number of distinct terms."""
    q = queries.select("query_id", tok_query(F.col("query")).alias("terms"))
    q = q.select(
        "query_id",
        F.size("terms").alias("qlen"),
        F.size(F.array_distinct("terms")).alias("k"),
        F.posexplode(F.array_distinct("terms")).alias("ti", "term"),
        "terms",
    )
    return q.select(
        "query_id", "term", F.col("ti").cast("int").alias("ti"),
        F.size(F.filter("terms", lambda x: x == F.col("term"))).cast("long").alias("n"),
        F.col("qlen").cast("int").alias("qlen"), F.col("k").cast("int").alias("k"),
    )


def join_term_idf(qterms: DataFrame, corpus: DataFrame, log: bool = True) -> DataFrame:
    """J1 + M3 + C4: query terms with df (0 if unknown), idf and the query weight
    ``logify(n) * idf`` (``n * idf`` with ``log`` off). The df table is restricted to the query vocabulary first, so it is
    never larger than the vocabulary and the left join stays a broadcast join."""
    vocab = qterms.select("term").distinct()
    dfv = doc_freq(corpus, vocab)
    n_total = corpus_size(corpus)
    out = (
        qterms.join(dfv, "term", "left")
        .crossJoin(F.broadcast(n_total))
        .withColumn("df", F.coalesce(F.col("df"), F.lit(0)).cast("long"))
        .withColumn("idf", idf_expr(F.col("n_total"), F.col("df")))
        .withColumn("qw", (logify(F.col("n").cast("double")) if log else F.col("n").cast("double")) * F.col("idf"))
        .drop("n_total")
    )
    return out
