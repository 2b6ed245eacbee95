"""BM25F with a static-rank term.

Parameters enter either as literals (one setting) or as columns of a parameter table that
is cross joined onto the matched rows (sweeps): every expression below takes a ``P`` whose
attributes are Columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldrank.functions.scoring import bm25f_field_norm, vf, vf_logarithmic, vf_saturation, vf_sigmoid
from fieldrank.params import BM25FParams

# raw tf column and page length (inside ``ps``) per field, in the order url,title,header,body,anchor
RAW_TF = ("tf_url", "rtf_title", "rtf_header", "tf_body", "rtf_anchor")
LENGTH = ("len_url", "len_title", "len_header", "L", "len_anchor")
AVG = ("avg_url", "avg_title", "avg_header", "avg_body", "avg_anchor")


@dataclass
class P:
    B: tuple
    W: tuple
    K1: Column
    lamd: Column
    l1: Column
    l2: Column
    vf: object  # str name, callable, or Column holding a name
    custom: dict = field(default_factory=dict)  # name -> callable, for names in a Column

    @staticmethod
    def of(p: BM25FParams) -> "P":
        lit = lambda x: F.lit(float(x))
        return P(tuple(map(lit, p.B)), tuple(map(lit, p.W)), lit(p.K1), lit(p.lamd),
                 lit(p.lamd_prime), lit(p.lamd_prime2), p.vf)

    @staticmethod
    def columns(settings: tuple[BM25FParams, ...] = ()) -> "P":
        """Parameters read from the columns of ``param_table(settings)``."""
        c = F.col
        return P(tuple(c(f"b_{f}") for f in ("url", "title", "header", "body", "anchor")),
                 tuple(c(f"w_{f}") for f in ("url", "title", "header", "body", "anchor")),
                 c("k1"), c("lamd"), c("l1"), c("l2"), c("vf"),
                 {f"custom{i}": s.vf for i, s in enumerate(settings) if not isinstance(s.vf, str)})


def param_table(spark, settings: tuple[BM25FParams, ...]) -> DataFrame:
    rows = [(i, s.name, *s.B, *s.W, float(s.K1), float(s.lamd), float(s.lamd_prime), float(s.lamd_prime2),
             s.vf if isinstance(s.vf, str) else f"custom{i}") for i, s in enumerate(settings)]
    names = ["param_id", "setting"] + [f"b_{f}" for f in ("url", "title", "header", "body", "anchor")] + \
        [f"w_{f}" for f in ("url", "title", "header", "body", "anchor")] + ["k1", "lamd", "l1", "l2", "vf"]
    return spark.createDataFrame(rows, names)


def avg_field_len(cands: DataFrame) -> DataFrame:
    """One row of five average field lengths over the candidate (query, page) pairs.

    url/title/body divide by the number of pairs; header divides by the number of header
    strings and anchor by the number of distinct anchor texts (1 for a page without any);
    body uses the raw body_length (0 if missing), not the clamped one. Empty -> 0.0."""
    n = F.count(F.lit(1))

    def ratio(num: str, den: Column) -> Column:
        d = den.cast("double")
        return F.when(F.coalesce(d, F.lit(0.0)) != 0, F.sum(num) / d).otherwise(F.lit(0.0))

    return cands.agg(
        ratio("len_url", n).alias("avg_url"),
        ratio("len_title", n).alias("avg_title"),
        ratio("len_header", F.sum("n_header_d")).alias("avg_header"),
        ratio("body_len_raw", n).alias("avg_body"),
        ratio("len_anchor", F.sum("n_anchor_d")).alias("avg_anchor"),
    )


def term_weight(p: P) -> Column:
    """M9 + M10: ``sum over fields of W_f * tf_f / B'_f``."""
    out = F.lit(0.0)
    for i in range(5):
        out = out + p.W[i] * bm25f_field_norm(F.col(RAW_TF[i]), p.B[i], F.col(LENGTH[i]), F.col(AVG[i]))
    return out


def _vf(p: P, pagerank: Column) -> Column:
    if isinstance(p.vf, Column):
        out = (F.when(p.vf == "logarithmic", vf_logarithmic(pagerank, p.l1, p.l2))
                .when(p.vf == "saturation", vf_saturation(pagerank, p.l1, p.l2))
                .when(p.vf == "sigmoid", vf_sigmoid(pagerank, p.l1, p.l2)))
        for name, fn in p.custom.items():  # callables are named by their setting
            out = out.when(p.vf == name, fn(pagerank, p.l1, p.l2))
        return out
    return vf(p.vf, pagerank, p.l1, p.l2)


def with_term_weight(df: DataFrame, p: P) -> DataFrame:
    """Adds ``_w`` (M9 + M10) as its own column: it is used three times by the text score
    and inlining it would blow the generated code past the JIT method limit."""
    return df.withColumn("_w", term_weight(p))


def text_contribution(p: P) -> Column:
    """C10 per matched term row (after ``with_term_weight``): ``n * w * idf / (K1 + w)``
    (query duplicates counted via n)."""
    w = F.col("_w")
    den = p.K1 + w
    return F.col("n") * F.when(den != 0, w * F.col("idf") / den).otherwise(F.lit(0.0))


def bm25f_scores(matched: DataFrame, avg: DataFrame, index, queries_stats: DataFrame, params: BM25FParams = BM25FParams(),
                 cands: DataFrame | None = None) -> DataFrame:
    """C11: text score + ``lambda * Vf(pagerank)`` for every candidate pair."""
    from fieldrank.operators.match import candidates

    p = P.of(params)
    m = with_term_weight(matched.crossJoin(F.broadcast(avg)), p)  # one row
    agg = m.groupBy("query_id", "page_id").agg(
        F.sum(text_contribution(p)).alias("text_score"))
    j = candidates(agg, index, queries_stats, cands)
    return j.withColumn("text_score", F.coalesce("text_score", F.lit(0.0))).withColumn(
        "bm25f", F.col("text_score") + p.lamd * _vf(p, F.col("pagerank")))
