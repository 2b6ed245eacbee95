"""Candidate pairs, their matched terms, and the per-(query, page) aggregates the rankers share.

The pairs to rank are an explicit relation (query_id, page_id). Their query terms are joined
to the page terms by (page, term), so rows are made for candidate pairs only, at most one per
pair and query term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldrank.functions.scoring import logify
from fieldrank.operators.index import TERM_SCALARS, PageIndex, of_pairs
from fieldrank.params import CosineWeights, TfRule


def _w(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def tf_weight(tf: str, L: Column, rule: TfRule = TfRule()) -> Column:
    """M1 and M2 of a count column under the rule's switches."""
    x = F.col(tf) / L if rule.normalize else F.col(tf).cast("double")
    return logify(x) if rule.logify else x


def static_part(weights, L: Column, rule: TfRule = TfRule()) -> Column:
    """s(t): signed weighted sum of the url/title/header/anchor components of a term."""
    url, title, header, _body, anchor = weights
    return (
        _w(url) * tf_weight("tf_url", L, rule)
        + _w(title) * tf_weight("tf_title", L, rule)
        + _w(header) * tf_weight("tf_header", L, rule)
        + _w(anchor) * tf_weight("tf_anchor", L, rule)
    )


def body_part(weights, L: Column, rule: TfRule = TfRule()) -> Column:
    """b(t): weighted body component, null when the term has no body hit."""
    return F.when(F.col("tf_body") > 0, _w(weights[3]) * tf_weight("tf_body", L, rule))


def page_keys(index: PageIndex) -> list[str]:
    return ["page_id"] + (["query_id"] if index.keyed_by_query else [])


def match_terms(qterms: DataFrame, index: PageIndex, cands: DataFrame | None = None) -> DataFrame:
    """(page_id, query_id, term, ti, n, qlen, k, [idf, qw], TERM_SCALARS, tf_*, rtf_*) for every
    query term present in any field of a candidate page of the query. Feature records are
    candidates of their own query."""
    if index.keyed_by_query:
        return index.terms.join(qterms, ["term", "query_id"])
    return of_pairs(index, "terms", cands.join(qterms, "query_id"))


def pair_aggregates(matched: DataFrame, weights=CosineWeights().as_tuple(), extra=(), rule: TfRule = TfRule()) -> DataFrame:
    """Per (query_id, page_id): baseline hits, candidate flag, cosine dot product and the
    query-dependent part of the page L1 norm (see ``cosine.py``). Buffers are fixed-width
    numbers only, so this is a hash aggregation."""
    L = F.col("L")
    # s(t) and b(t) are each used several times: computed once in their own columns so the
    # aggregate's generated code stays small
    matched = matched.withColumn("_s", static_part(weights, L, rule)).withColumn("_b", body_part(weights, L, rule))
    s, b = F.col("_s"), F.col("_b")
    return matched.groupBy("query_id", "page_id").agg(
        F.sum("tf_body").cast("long").alias("hits"),
        F.max(F.col("tf_body") > 0).alias("has_body"),
        F.sum(F.col("qw") * (s + F.coalesce(b, F.lit(0.0)))).alias("dot"),
        F.coalesce(F.sum(F.when(b.isNotNull(), F.abs(s + b) - F.abs(s))), F.lit(0.0)).alias("delta"),
        F.first("qlen", ignorenulls=True).alias("qlen"),
        F.first("k", ignorenulls=True).alias("k"),
        *[F.max(c).alias(c) for c in TERM_SCALARS],
        *extra,
    )


def pair_pages(index: PageIndex, queries_stats: DataFrame, cands: DataFrame | None = None) -> DataFrame:
    """Every candidate pair with the page attributes and the query's lengths."""
    base = index.pages if index.keyed_by_query else index.pages.join(cands, "page_id")
    return base.join(queries_stats, "query_id", "left")


def candidates(pairs: DataFrame, index: PageIndex, queries_stats: DataFrame, cands: DataFrame | None = None) -> DataFrame:
    """Every candidate pair with the page attributes and its aggregates (zeros where no term
    matched, or the query has no term at all)."""
    out = pair_pages(index, queries_stats, cands).join(pairs.drop("qlen", "k", *TERM_SCALARS), ["page_id", "query_id"], "left")
    fill = {"hits": F.lit(0).cast("long"), "has_body": F.lit(False), "dot": F.lit(0.0), "delta": F.lit(0.0)}
    for c, v in fill.items():
        if c in out.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), v))
    return out
