"""Parameter sweeps and ranker comparison.

Features (matched term rows, cosine parts, windows, average lengths) are computed once;
the parameter settings enter as a small table cross joined after them (row count known,
so broadcasting it is safe). Ranking and NDCG are then partitioned by ``(param_id, query_id)``.
"""

from __future__ import annotations

import copy
import dataclasses
import math
import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldrank.functions.scoring import window_boost
from fieldrank.operators import bm25f as bm
from fieldrank.operators.cosine import query_norms
from fieldrank.operators.evaluate import dcg_per_group, idcg_per_query, mean_ndcg, ndcg_from, rank_within
from fieldrank.operators.match import body_part, static_part
from fieldrank.params import BOOST_FUNCTIONS, BOOST_GRID, BM25F_SETTINGS, FIELDS, CosineWeights, cosine_weight_grid
from fieldrank.plans.rankers import RankingJob
from fieldrank.sources.corpus import scratch_path, snapshot


def _eval(scored: DataFrame, part=("param_id",), first=0) -> DataFrame:
    """rank per (param, query) -> DCG per (param, query); IDCG once per query from the pages of
    the ``first`` setting (the same for every setting), read from the ranked rows, which
    are a written table -> NDCG -> mean per param."""
    r = rank_within(scored.select(*part, "query_id", "score", "tie", "rel"), "score", part=(*part, "query_id"))
    dcg = dcg_per_group(r, part=(*part, "query_id"))
    return mean_ndcg(ndcg_from(dcg, idcg_per_query(r.where(F.col(part[0]) == first))), part=part)


def boost_params(spark: SparkSession) -> DataFrame:
    rows = [(i, fn, b) for i, (fn, b) in enumerate((fn, b) for fn in BOOST_FUNCTIONS for b in BOOST_GRID)]
    return spark.createDataFrame(rows, "param_id int, function string, boost double")


def sweep_window_boost(job: RankingJob, spark: SparkSession) -> DataFrame:
    """Mean NDCG for B in 2..1024 x {inverse, sigmoid}; cosine and windows once."""
    c = job.cosine_with_windows().select("query_id", "page_id", F.col("score").alias("cosine"), "qlen",
                                         "window_size", "rel", "tie")
    s = c.crossJoin(F.broadcast(boost_params(spark))).withColumn(  # 20 rows
        "score", window_boost(F.col("boost"), F.col("function"), F.col("qlen"), F.col("window_size")) * F.col("cosine"))
    m = _eval(s)
    return m.join(F.broadcast(boost_params(spark)), "param_id").select("function", "boost", "mean_ndcg", "n_queries")


def sweep_bm25f(job: RankingJob, spark: SparkSession, settings=BM25F_SETTINGS) -> DataFrame:
    """Mean NDCG per BM25F setting; matched rows and averages computed once."""
    pt = bm.param_table(spark, settings)
    p = bm.P.columns(settings)
    m = bm.with_term_weight(job.matched.crossJoin(F.broadcast(job.avg_len)).crossJoin(F.broadcast(pt)), p)
    text = m.groupBy("param_id", "query_id", "page_id").agg(F.sum(bm.text_contribution(p)).alias("text_score"))
    c = job.cands.crossJoin(F.broadcast(pt)).join(text, ["param_id", "query_id", "page_id"], "left")
    s = c.select("param_id", "query_id", "page_id", "rel", "tie",
                 (F.coalesce("text_score", F.lit(0.0)) + F.col("lamd") * bm._vf(p, F.col("pagerank"))).alias("score"))
    out = _eval(s)
    return out.join(F.broadcast(pt.select("param_id", "setting")), "param_id").select("setting", "mean_ndcg", "n_queries")


def cosine_params(spark: SparkSession, grid=None) -> DataFrame:
    grid = grid or cosine_weight_grid()
    rows = [(i, *w.as_tuple()) for i, w in enumerate(grid)]
    return spark.createDataFrame(rows, "param_id int, w_url double, w_title double, w_header double, "
                                       "w_body double, w_anchor double")


def sweep_cosine_weights(job: RankingJob, spark: SparkSession, grid=None) -> DataFrame:
    """Mean NDCG per field-weight setting. The weights change every term's page
    weight, so the matched rows and the static norms are evaluated per setting (cross
    join of the small parameter table), then aggregated once per (param, query, page)."""
    prm = cosine_params(spark, grid)
    w = tuple(F.col(f"w_{f}") for f in ("url", "title", "header", "body", "anchor"))
    L = F.col("L")
    m = job.matched.crossJoin(F.broadcast(prm))
    m = m.withColumn("_s", static_part(w, L)).withColumn("_b", body_part(w, L))
    s, b = F.col("_s"), F.col("_b")
    sums = m.groupBy("param_id", "query_id", "page_id").agg(
        F.sum(F.col("qw") * (s + F.coalesce(b, F.lit(0.0)))).alias("dot"),
        F.coalesce(F.sum(F.when(b.isNotNull(), F.abs(s + b) - F.abs(s))), F.lit(0.0)).alias("delta"))
    nonbody = F.col("tf_url") + F.col("tf_title") + F.col("tf_header") + F.col("tf_anchor")
    norms = job.index.terms.where(nonbody > 0).join(job.candidate_pairs.select("page_id").distinct(), "page_id", "left_semi") \
        .crossJoin(F.broadcast(prm)).groupBy("page_id", "param_id").agg(F.sum(F.abs(static_part(w, L))).alias("S"))
    j = job.cands.drop("dot", "delta").crossJoin(F.broadcast(prm)) \
        .join(sums, ["param_id", "query_id", "page_id"], "left").join(norms, ["page_id", "param_id"], "left") \
        .join(query_norms(job.qterms_idf), "query_id", "left")
    norm = F.coalesce("n1", F.lit(0.0)) * (F.coalesce("S", F.lit(0.0)) + F.coalesce("delta", F.lit(0.0)))
    scored = j.withColumn("score", F.when(norm > 0, F.coalesce("dot", F.lit(0.0)) / norm).otherwise(F.lit(0.0)))
    out = _eval(scored)
    return out.join(F.broadcast(prm), "param_id").select(
        "w_url", "w_title", "w_header", "w_body", "w_anchor", "mean_ndcg", "n_queries")


def with_stored_features(job: RankingJob, spark: SparkSession) -> RankingJob:
    """The job with what a weight sweep reads (matched terms, pairs, terms of the candidates'
    pages, query weights) written once, so that further sweeps parse and match nothing."""
    keep = lambda df, name: snapshot(df, scratch_path(spark, name))
    out = copy.copy(job)
    out.qterms_idf, out.matched = keep(job.qterms_idf, "query-terms"), keep(job.matched, "matched")
    out.cands = keep(job.cands, "pairs")
    out.candidate_pairs = out.cands.select("query_id", "page_id")
    terms = job.index.terms.join(out.candidate_pairs.select("page_id").distinct(), "page_id", "left_semi")
    out.index = dataclasses.replace(job.index, terms=keep(terms, "page-terms"))
    return out


def next_settings(best: list[CosineWeights], count: int, spread: float, rng: random.Random) -> list[CosineWeights]:
    """``count`` settings around the best ones in turn, every weight times exp of a uniform
    number in -spread..spread."""
    return [CosineWeights(**{f: getattr(best[k % len(best)], f) * math.exp(rng.uniform(-spread, spread)) for f in FIELDS})
            for k in range(count)]


def best_settings(means: dict[CosineWeights, float], keep: int) -> list[CosineWeights]:
    """The ``keep`` settings of the highest mean NDCG (at 9 digits), ties to those tried first."""
    return sorted(means, key=lambda w: -round(means[w], 9))[:keep]


def search_cosine_weights(job: RankingJob, spark: SparkSession, seed: int = 1, rounds: int = 2, per_round: int = 12,
                          keep: int = 4, spread: float = math.log(8)) -> DataFrame:
    """Seeded random search for field weights over all judged pairs. Round 0 tries the fixed
    grid; each further round tries ``per_round`` settings around the ``keep`` best so far,
    with half the spread and half the survivors of the round before. The features are stored
    once; a round is one sweep, of which one row per setting comes to the driver. Returns every
    setting tried (round, w_*, mean_ndcg, n_queries) and ``best``, true for one row."""
    stored, rng = with_stored_features(job, spark), random.Random(seed)
    grid, means, rows = list(cosine_weight_grid()), {}, []
    for n in range(rounds + 1):
        got = {tuple(r)[:5]: r for r in sweep_cosine_weights(stored, spark, grid).collect()}
        for w in grid:
            if (r := got.get(w.as_tuple())) is not None:  # without judged pairs there is nothing to compare
                means[w] = r["mean_ndcg"]
                rows.append((n, *w.as_tuple(), r["mean_ndcg"], r["n_queries"]))
        if not means:
            break
        grid = next_settings(best_settings(means, keep), per_round, spread, rng)
        keep, spread = max(1, keep // 2), spread / 2
    top = best_settings(means, 1)
    return spark.createDataFrame(
        [(*r, r[1:6] == top[0].as_tuple()) for r in rows],
        "round int, w_url double, w_title double, w_header double, w_body double, w_anchor double, "
        "mean_ndcg double, n_queries long, best boolean")


def compare_rankers(job: RankingJob) -> DataFrame:
    """NDCG per query for the four rankers side by side (one row per query)."""
    parts = {
        "baseline": job.baseline(),
        "cosine": job.cosine(),
        "bm25f": job.bm25f(),
        "cosine_window": job.cosine_window(),
    }
    u = None
    for name, df in parts.items():
        d = df.select(F.lit(name).alias("ranker"), "query_id", "page_id", "score", "rel", "tie")
        u = d if u is None else u.unionByName(d)
    r = rank_within(u, "score", part=("ranker", "query_id"))
    n = ndcg_from(dcg_per_group(r, part=("ranker", "query_id")), idcg_per_query(r.where("ranker = 'baseline'")))
    return n.groupBy("query_id").pivot("ranker", list(parts)).agg(F.first("ndcg")).select(
        "query_id", *[F.col(k).alias(f"ndcg_{k}") for k in parts])


__all__ = ["sweep_window_boost", "sweep_bm25f", "sweep_cosine_weights", "search_cosine_weights", "compare_rankers",
           "boost_params", "cosine_params"]
