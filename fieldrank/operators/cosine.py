"""Weighted fielded cosine with L1 norms.

The page vector of a (query, page) pair holds all url/title/header/anchor terms of the
page but only the query's terms of the body (the reference's body_hits list only those).
Its L1 norm therefore splits into a query-independent part and a small correction:

    L1(q, d) = S(d) + sum over t in q with a body hit of (|s(t) + b(t)| - |s(t)|)
    S(d)     = sum over page terms of |s(t)|

``S(d)`` is one aggregation per page; the correction is a
sum over the matched query-term rows. No (query x page x all page terms) explosion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldrank.functions.scoring import logify
from fieldrank.operators.index import PageIndex
from fieldrank.operators.match import body_part, page_keys, static_part
from fieldrank.params import CosineWeights, TfRule


def static_norms(index: PageIndex, weights=CosineWeights().as_tuple(), rule: TfRule = TfRule()) -> DataFrame:
    """Per page: ``S`` = sum of |s(t)|; a feature record lists its body terms itself, so its
    sum holds them all."""
    L = F.col("L")
    listed = F.coalesce(body_part(weights, L, rule), F.lit(0.0)) if index.keyed_by_query else F.lit(0.0)
    return index.terms.groupBy(*page_keys(index)).agg(
        F.sum(F.abs(static_part(weights, L, rule) + listed)).alias("S"),
    )


def query_norms(qterms: DataFrame) -> DataFrame:
    """Per query: L1 norm of the query vector ``n1`` = sum of |logify(n) * idf|."""
    return qterms.groupBy("query_id").agg(F.sum(F.abs("qw")).alias("n1"))


def cosine_scores(cands: DataFrame, index: PageIndex, qterms: DataFrame,
                  weights=CosineWeights().as_tuple(), rule: TfRule = TfRule()) -> DataFrame:
    """Cosine per candidate pair: ``dot / (n1 * L1(q, d))``, 0 when the norm is 0."""
    s = static_norms(index, weights, rule)
    qn = query_norms(qterms)
    # left joins: a page without any token, or a query without any, is still scored (0)
    j = cands.join(s, page_keys(index), "left").join(qn, "query_id", "left")
    delta = F.lit(0.0) if index.keyed_by_query else F.col("delta")
    norm = F.coalesce(F.col("n1"), F.lit(0.0)) * (F.coalesce(F.col("S"), F.lit(0.0)) + delta)
    return j.withColumn("cosine", F.when(norm > 0, F.col("dot") / norm).otherwise(F.lit(0.0)))


def page_field_vectors(index: PageIndex) -> DataFrame:
    """C2 (with M1, M2): (page_id, field, term, tf, ntf, weight) for the five fields;
    ``ntf = tf / L`` and ``weight = logify(ntf)``; the body holds every body term."""
    L = F.col("L")
    cols = {"url": "tf_url", "title": "tf_title", "header": "tf_header", "body": "tf_body", "anchor": "tf_anchor"}
    arr = F.array(*[F.struct(F.lit(f).alias("field"), F.col(c).alias("tf")) for f, c in cols.items()])
    v = index.terms.select(*page_keys(index), "term", "L", F.explode(arr).alias("x")).where("x.tf > 0")
    ntf = F.col("x.tf") / F.col("L")
    return v.select(*page_keys(index), F.col("x.field").alias("field"), "term",
                    F.col("x.tf").alias("tf"), ntf.alias("ntf"), logify(ntf).alias("weight"))


def page_vector(index: PageIndex, weights=CosineWeights().as_tuple()) -> DataFrame:
    """C3 over the full page (all body terms): (page_id, term, weight)."""
    L = F.col("L")
    b = F.coalesce(body_part(weights, L), F.lit(0.0))
    nz = (F.col("tf_url") + F.col("tf_title") + F.col("tf_header") + F.col("tf_body") + F.col("tf_anchor")) > 0
    return index.terms.where(nz).select(*page_keys(index), "term", (static_part(weights, L) + b).alias("weight"))
