"""Properties and brute-force cross-checks on small inputs and on the sf0.001 test tables."""

import itertools
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldrank.operators.cosine import static_norms
from fieldrank.operators.evaluate import ndcg_per_query, ranking_completeness
from fieldrank.operators.window import smallest_window
from fieldrank.plans.catalog import docs_job, pages_job
from fieldrank.plans.rankers import ranked

SF = "/root/testdata/sf0.001"


def brute_window(lists):
    """Shortest span covering one position of every list (all combinations)."""
    if any(len(x) == 0 for x in lists):
        return None
    return min(max(c) - min(c) + 1 for c in itertools.product(*lists))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40), max_size=5), min_size=1, max_size=4))
def test_window_merge_matches_brute_force(spark, sets):
    # positions are distinct across terms in a token list: make them so
    seen, lists = set(), []
    for s in sets:
        lst = sorted(p for p in s if p not in seen)
        seen.update(lst)
        lists.append(lst)
    df = spark.createDataFrame([(lists,)], "l array<array<int>>")
    got = df.select(smallest_window(F.col("l")).alias("w")).first()["w"]
    assert got == brute_window(lists)


@pytest.fixture(scope="module")
def pj(spark):
    return pages_job(spark, SF)


def test_rank_is_permutation(pj):
    r = ranked(pj.bm25f())
    c = ranking_completeness(r, pj.cands).first()
    assert (c["missing"], c["unexpected"], c["duplicated"]) == (0, 0, 0)
    bad = r.groupBy("query_id").agg(F.max("rank").alias("m"), F.count(F.lit(1)).alias("n")).where("m != n").count()
    assert bad == 0


def test_windows_add_one_exchange_at_most_and_no_window(pj):
    from fieldrank.operators.window import field_windows, query_term_postings

    post = query_term_postings(pj.qterms, pj.index, pj.candidate_pairs)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    before, after = plan(post), plan(field_windows(post))
    assert after.count("Window ") <= before.count("Window ") and "array_sort" not in after
    assert after.count("Exchange hashpartitioning") <= before.count("Exchange hashpartitioning") + 1


def test_window_at_least_distinct_terms(pj):
    w = pj.windows.join(pj.query_stats, "query_id")
    assert w.where("window_size < k").count() == 0
    assert w.count() > 0


def test_boost_between_one_and_b(pj):
    c = pj.cosine_window()
    assert c.where("boost < 1.0 OR boost > 16.0").count() == 0


def test_split_norm_equals_literal_norm(spark, pj):
    """S(d) + query-dependent correction == L1 norm of the literal page vector (all
    non-body terms plus the query's body terms)."""
    L = F.col("L")
    from fieldrank.operators.match import body_part, static_part
    from fieldrank.params import CosineWeights
    w = CosineWeights().as_tuple()
    t = pj.index.terms.select("page_id", "term", static_part(w, L).alias("s"), body_part(w, L).alias("b"),
                              (F.col("tf_url") + F.col("tf_title") + F.col("tf_header") + F.col("tf_anchor")).alias("nb"))
    q = pj.qterms.select("query_id", "term").distinct()
    c = pj.cands.select("query_id", "page_id", "delta")
    # literal: per (query, page), sum |weight| over page terms where the term is non-body, or in the query
    lit = (c.join(t, "page_id").join(q.withColumn("inq", F.lit(True)), ["query_id", "term"], "left")
           .where((F.col("nb") > 0) | (F.col("inq") & F.col("b").isNotNull()))
           .select("query_id", "page_id",
                   F.abs(F.col("s") + F.when(F.col("inq"), F.coalesce("b", F.lit(0.0))).otherwise(0.0)).alias("a"))
           .groupBy("query_id", "page_id").agg(F.sum("a").alias("literal")))
    split = c.join(static_norms(pj.index, w), "page_id").select("query_id", "page_id", (F.col("S") + F.col("delta")).alias("split"))
    rows = lit.join(split, ["query_id", "page_id"]).collect()
    assert len(rows) == pj.cands.count()
    for r in rows:
        assert r["literal"] == pytest.approx(r["split"], rel=1e-9, abs=1e-9)


def test_ndcg_in_unit_interval_and_ideal_is_one(spark):
    j = docs_job(spark, SF)
    n = ndcg_per_query(ranked_with_rel(j.bm25f()))
    assert n.where("ndcg < 0 OR ndcg > 1.0000001").count() == 0
    ideal = j.cands.select("query_id", "page_id", F.col("rel").alias("score"), "rel", "url")
    assert ndcg_per_query(ranked_with_rel(ideal)).where("abs(ndcg - 1.0) > 1e-9").count() == 0


def ranked_with_rel(scored):
    from fieldrank.operators.evaluate import rank_within
    return rank_within(scored, "score")


def test_results_unchanged_by_repartitioning(spark):
    from fieldrank.plans.rankers import RankingJob
    from fieldrank.sources import tables as T
    a = ranked(pages_job(spark, SF).cosine()).collect()
    q, c = T.queries(spark, SF).repartition(3), T.pages_collection(spark, SF).repartition(5)
    j = RankingJob(q, c, T.corpus(spark, SF).repartition(7), T.candidates(q, c))
    b = ranked(j.cosine()).collect()
    key = lambda r: (r["query_id"], r["rank"])
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)
    assert math.isfinite(sum(r["score"] for r in a))
