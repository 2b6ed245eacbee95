"""End-to-end rankers (C1, C6, C9, C11) over a collection or feature records.

``RankingJob`` derives the shared pieces lazily (query terms with idf, the page index, the
matched term rows of the candidate pairs, their aggregates); building a ranker starts no
Spark job and caches nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldrank.functions.scoring import window_boost
from fieldrank.operators import bm25f as bm
from fieldrank.operators.cosine import cosine_scores
from fieldrank.operators.evaluate import rank_within
from fieldrank.operators.index import PageIndex, build_index
from fieldrank.operators.match import candidates, match_terms, pair_aggregates, pair_pages
from fieldrank.operators.stats import join_term_idf, query_terms
from fieldrank.operators.window import smallest_windows
from fieldrank.params import BM25FParams, CosineWeights, TfRule, WindowBoost

OUT_COLS = ("query_id", "rank", "page_id", "url", "score")


@dataclass
class RankingJob:
    queries: DataFrame      # query_id, query
    collection: DataFrame   # see sources.tables
    corpus: DataFrame       # doc_id, text (document frequencies)
    candidate_pairs: DataFrame | None = None  # query_id, page_id to rank; not for feature records, which carry query_id
    weights: CosineWeights = CosineWeights()
    rule: TfRule = TfRule()
    stored: PageIndex | None = None  # an index that is kept (operators.store); else it is built of the collection
    full_index: bool = False  # keep every body term (page vectors); rankers need query terms only

    @cached_property
    def qterms(self) -> DataFrame:
        """(query_id, term, ti, n, qlen, k) — from the queries only."""
        return query_terms(self.queries)

    @cached_property
    def qterms_idf(self) -> DataFrame:
        """query terms with df, idf and query weight."""
        return join_term_idf(self.qterms, self.corpus, self.rule.logify)

    @cached_property
    def index(self) -> PageIndex:
        if self.stored is not None:
            return self.stored
        return build_index(self.collection, None if self.full_index else self.qterms.select("query_id", "term"))

    @cached_property
    def matched(self) -> DataFrame:
        return match_terms(self.qterms_idf, self.index, self.candidate_pairs)

    @cached_property
    def query_stats(self) -> DataFrame:
        return self.qterms.select("query_id", "qlen", "k").distinct()

    def pairs(self, weights: CosineWeights | None = None) -> DataFrame:
        w = (weights or self.weights).as_tuple()
        return candidates(pair_aggregates(self.matched, w, rule=self.rule), self.index, self.query_stats, self.candidate_pairs)

    @cached_property
    def pages_of_pairs(self) -> DataFrame:
        """Candidate pairs with the page attributes only: nothing is matched for them."""
        return pair_pages(self.index, self.query_stats, self.candidate_pairs)

    @cached_property
    def cands(self) -> DataFrame:
        """Candidate pairs with their aggregates."""
        return self.pairs()

    def rank(self, scored: DataFrame, digits: int = 6) -> DataFrame:
        return ranked(scored, digits)

    # ---- rankers -------------------------------------------------------------------
    def baseline(self) -> DataFrame:
        """Total body hits, descending; ties in input order. Feature records count every
        listed hit. Needs no corpus statistics, so it matches the plain query terms."""
        m = match_terms(self.qterms, self.index, self.candidate_pairs)
        hits = m.groupBy("query_id", "page_id").agg(F.sum("tf_body").cast("long").alias("hits"))
        c = candidates(hits, self.index, self.query_stats, self.candidate_pairs)
        return c.select("query_id", "page_id", "url", F.coalesce("listed_hits", "hits").cast("double").alias("score"), "rel", "pagerank", "tie")

    def cosine(self, weights: CosineWeights | None = None) -> DataFrame:
        """Weighted fielded cosine with L1 norms."""
        w = (weights or self.weights)
        c = self.cands if weights is None else self.pairs(weights)
        s = cosine_scores(c, self.index, self.qterms_idf, w.as_tuple(), self.rule)
        return s.select("query_id", "page_id", "url", F.col("cosine").alias("score"), "rel", "qlen", "tie")

    @cached_property
    def windows(self) -> DataFrame:
        return smallest_windows(self.qterms, self.index, self.candidate_pairs)

    def cosine_with_windows(self, weights: CosineWeights | None = None) -> DataFrame:
        """Cosine per candidate pair plus its smallest window (null when none); the window rows
        are unioned into the pair aggregation."""
        w = (weights or self.weights).as_tuple()
        rows = self.matched.unionByName(self.windows, allowMissingColumns=True)
        agg = pair_aggregates(rows, w, extra=[F.min("window_size").alias("window_size")], rule=self.rule)
        c = candidates(agg, self.index, self.query_stats, self.candidate_pairs)
        s = cosine_scores(c, self.index, self.qterms_idf, w, self.rule)
        return s.select("query_id", "page_id", "url", F.col("cosine").alias("score"), "rel", "qlen", "window_size", "tie")

    def cosine_window(self, boost: WindowBoost = WindowBoost(), weights: CosineWeights | None = None) -> DataFrame:
        """Cosine x window boost."""
        c = self.cosine_with_windows(weights)
        b = window_boost(float(boost.boost), boost.function, F.col("qlen"), F.col("window_size"))
        return c.select("query_id", "page_id", "url", (b * F.col("score")).alias("score"), "rel",
                        "qlen", "window_size", b.alias("boost"), F.col("score").alias("cosine"), "tie")

    @cached_property
    def avg_len(self) -> DataFrame:
        return bm.avg_field_len(self.pages_of_pairs)

    def bm25f(self, params: BM25FParams = BM25FParams()) -> DataFrame:
        """C11: BM25F text score + lambda * Vf(pagerank)."""
        s = bm.bm25f_scores(self.matched, self.avg_len, self.index, self.query_stats, params, self.candidate_pairs)
        return s.select("query_id", "page_id", "url", F.col("bm25f").alias("score"), "text_score", "rel", "tie")


def ranked(scored: DataFrame, digits: int = 6) -> DataFrame:
    """R1 + the ranking schema (query_id, rank, page_id, url, score rounded)."""
    r = rank_within(scored, "score")
    return r.select("query_id", F.col("rank").cast("int").alias("rank"), "page_id", "url",
                    F.round("score", digits).alias("score"))
