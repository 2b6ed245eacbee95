"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame`` and, where the
operator is SQL-expressible, its DuckDB twin (see ``fieldrank/oracle.py``).

Every query reads the base tables (or what Spark derives from them) in full. Output
columns are aliased identically on both sides; doubles are rounded to 6 digits.
"""

from __future__ import annotations

from dataclasses import replace
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldrank import oracle as O
from fieldrank.operators import bm25f as bm
from fieldrank.operators import stats
from fieldrank.operators.evaluate import mean_ndcg, ndcg_per_query, query_result_counts, rank_within
from fieldrank.params import BM25FParams, CosineWeights, TfRule
from fieldrank.plans.rankers import RankingJob, ranked
from fieldrank.sources import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def pages_job(spark: SparkSession, sf_dir: str, full_index: bool = False) -> RankingJob:
    q, c = T.queries(spark, sf_dir), T.pages_collection(spark, sf_dir)
    return RankingJob(q, c, T.corpus(spark, sf_dir), T.candidates(q, c), full_index=full_index)


def docs_job(spark: SparkSession, sf_dir: str) -> RankingJob:
    q, c = T.queries(spark, sf_dir), T.judged_pages_collection(spark, sf_dir)
    return RankingJob(q, c, T.corpus(spark, sf_dir), T.candidates(q, c))


def terms_once(job: RankingJob) -> RankingJob:
    """The job with its term table written once, for rankers that match it and sum its norms."""
    terms = CO.snapshot(job.index.terms, CO.scratch_path(job.collection.sparkSession, "terms"))
    job.index = replace(job.index, terms=terms)
    return job


def parsed_once(job: RankingJob) -> RankingJob:
    """The job over its parsed pages and candidate pairs, each written once: its parts read them
    several times, and parsing html and probing every word's runs is most of a ranking's work."""
    spark = job.collection.sparkSession
    pages = CO.snapshot(job.collection, CO.scratch_path(spark, "parsed"))
    pairs = CO.snapshot(T.candidates(job.queries, pages), CO.scratch_path(spark, "pairs"))
    return replace(job, collection=pages, candidate_pairs=pairs)


def matched_once(job: RankingJob) -> RankingJob:
    """The job with its query terms' statistics and its matched terms written once, for parts that read them
    several times: documents are read and pairs meet the index a single time."""
    job = idf_once(job)
    job.matched = CO.snapshot(job.matched, CO.scratch_path(job.collection.sparkSession, "matched"))
    return job


def idf_once(job: RankingJob) -> RankingJob:
    """The job with its query terms' statistics written once: their size is known where they are joined."""
    job.qterms_idf = CO.snapshot(job.qterms_idf, CO.scratch_path(job.collection.sparkSession, "idf"))
    return job


# ------------------------------------------------------------------ corpus statistics
@register("doc_freq", O.with_sql("SELECT term, count(*) AS df FROM d_tok GROUP BY term"))
def q_doc_freq(spark, sf):
    return stats.doc_freq(T.corpus(spark, sf))


@register("idf", O.with_sql(
    "SELECT term, count(*) AS df, round(ln((SELECT n_total FROM d_n)) - ln(count(*) + 1), 6) AS idf "
    "FROM d_tok GROUP BY term"))
def q_idf(spark, sf):
    c = T.corpus(spark, sf)
    return stats.idf(stats.doc_freq(c), stats.corpus_size(c)).select("term", "df", r6("idf").alias("idf"))


@register("join_term_idf", O.with_sql(
    "SELECT query_id, term, n, df, round(idf, 6) AS idf FROM q_idf"))
def q_join_term_idf(spark, sf):
    j = stats.join_term_idf(stats.query_terms(T.queries(spark, sf)), T.corpus(spark, sf))
    return j.select("query_id", "term", "n", "df", r6("idf").alias("idf"))


@register("tfidf_query", O.with_sql("SELECT query_id, term, round(qw, 6) AS weight FROM q_idf"))
def q_tfidf_query(spark, sf):
    j = stats.join_term_idf(stats.query_terms(T.queries(spark, sf)), T.corpus(spark, sf))
    return j.select("query_id", "term", r6("qw").alias("weight"))


# ------------------------------------------------------------------ rankers (pages)
@register("rank_baseline", O.with_sql(O.ranked_sql("pg_pairs", "CAST(hits AS DOUBLE)")))
def q_rank_baseline(spark, sf):
    j = parsed_once(pages_job(spark, sf))
    return j.rank(j.baseline())


@register("rank_cosine", O.with_sql(O.ranked_sql("pg_pairs_cos", "cosine")))
def q_rank_cosine(spark, sf):
    j = parsed_once(pages_job(spark, sf))
    return j.rank(j.cosine())


# M1 and M2 switched off, each alone and both
for _name, _rule in (("rank_cosine_raw_tf", TfRule(False, False)), ("rank_cosine_no_log", TfRule(True, False)),
                     ("rank_cosine_no_norm", TfRule(False, True))):
    register(_name, O.with_sql(O.ranked_sql("sw_pairs_cos", "cosine"), extra=O.pairs_cte(
        "pg", name="sw_pairs", normalize=_rule.normalize, logify=_rule.logify)))(
        lambda spark, sf, rule=_rule: (lambda j: j.rank(j.cosine()))(replace(pages_job(spark, sf), rule=rule)))


@register("rank_bm25f", O.with_sql(O.ranked_sql("pg_bm25f", "bm25f")))
def q_rank_bm25f(spark, sf):
    j = parsed_once(pages_job(spark, sf))
    return j.rank(j.bm25f())


@register("rank_cosine_window", O.with_sql(O.ranked_sql("pg_cw", "cw")))
def q_rank_cosine_window(spark, sf):
    j = parsed_once(pages_job(spark, sf))
    return j.rank(j.cosine_window())


def stored_job(spark: SparkSession, sf_dir: str) -> RankingJob:
    """Rankers over a stored index with a history: half of the pages added with other titles, then
    all of them (the first half replaced), a third removed, added again, and merged."""
    from fieldrank.operators.store import IndexStore
    store = IndexStore(spark, CO.scratch_path(spark, "index"), buckets=max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    coll = CO.snapshot(T.pages_collection(spark, sf_dir), CO.scratch_path(spark, "parsed"))  # added twice and a third again
    store.add(coll.where("page_id % 2 = 0").withColumn("title", F.concat(F.lit("old "), "title")))
    store.add(coll)
    third = coll.where("page_id % 3 = 0")
    store.remove(third)
    store.add(third)
    return store.merge(CO.scratch_path(spark, "index")).job(T.queries(spark, sf_dir), T.corpus(spark, sf_dir))


@register("stored_rank_bm25f", O.with_sql(O.ranked_sql("pg_bm25f", "bm25f")))
def q_stored_rank_bm25f(spark, sf):
    from fieldrank.operators.store import ranked_pages
    return ranked_pages(stored_job(spark, sf).bm25f())


@register("stored_rank_cosine_window", O.with_sql(O.ranked_sql("pg_cw", "cw")))
def q_stored_rank_cosine_window(spark, sf):
    from fieldrank.operators.store import ranked_pages
    return ranked_pages(stored_job(spark, sf).cosine_window())


@register("smallest_window", O.with_sql("SELECT query_id, page_id, window_size FROM pg_win"))
def q_smallest_window(spark, sf):
    return pages_job(spark, sf).windows


@register("avg_field_len", O.with_sql(
    "SELECT round(avg_url, 6) AS avg_url, round(avg_title, 6) AS avg_title, round(avg_header, 6) AS avg_header, "
    "round(avg_body, 6) AS avg_body, round(avg_anchor, 6) AS avg_anchor FROM pg_avg"))
def q_avg_field_len(spark, sf):
    a = pages_job(spark, sf).avg_len
    return a.select(*[r6(c).alias(c) for c in bm.AVG])


@register("query_result_counts", O.with_sql(
    "SELECT query_id, CAST(count(*) AS BIGINT) AS n_pages FROM pg_pairs GROUP BY query_id"))
def q_query_result_counts(spark, sf):
    return query_result_counts(ranked(pages_job(spark, sf).baseline()))


# ------------------------------------------------------------------ evaluation (judged pages)
def ndcg_cte(src: str, score: str, name: str = "ndcg_q", part: str = "query_id") -> dict[str, str]:
    return {name: f"""SELECT {part}, dcg, idcg, CASE WHEN idcg > 0 THEN dcg / idcg ELSE 1.0 END AS ndcg, n_ranked FROM (
          SELECT {part},
            sum((pow(2.0, greatest(rel, 0)) - 1) / log2(rnk + 1)) AS dcg,
            sum((pow(2.0, greatest(rel, 0)) - 1) / log2(irnk + 1)) AS idcg,
            count(*) AS n_ranked
          FROM (SELECT {part}, rel,
                  row_number() OVER (PARTITION BY {part} ORDER BY round({score}, 9) DESC, tie) AS rnk,
                  row_number() OVER (PARTITION BY {part} ORDER BY rel DESC) AS irnk
                FROM {src}) GROUP BY {part})"""}


def _ndcg_sql(src: str, score: str) -> str:
    return O.with_sql("SELECT query_id, round(dcg, 6) AS dcg, round(idcg, 6) AS idcg, round(ndcg, 6) AS ndcg, "
                      "n_ranked FROM ndcg_q", extra=ndcg_cte(src, score))


def _ndcg(scored: DataFrame) -> DataFrame:
    from fieldrank.operators.evaluate import rank_within
    r = rank_within(scored, "score")
    n = ndcg_per_query(r)
    return n.select("query_id", r6("dcg").alias("dcg"), r6("idcg").alias("idcg"), r6("ndcg").alias("ndcg"), "n_ranked")


@register("ndcg", _ndcg_sql("dc_bm25f", "bm25f"))
def q_ndcg(spark, sf):
    return _ndcg(docs_job(spark, sf).bm25f())


@register("score_mean_ndcg", O.with_sql(
    "SELECT round(avg(ndcg), 6) AS mean_ndcg, count(*) AS n_queries FROM ndcg_q", extra=ndcg_cte("dc_bm25f", "bm25f")))
def q_score_mean_ndcg(spark, sf):
    from fieldrank.operators.evaluate import rank_within
    r = rank_within(docs_job(spark, sf).bm25f(), "score")
    m = mean_ndcg(ndcg_per_query(r))
    return m.select(r6("mean_ndcg").alias("mean_ndcg"), "n_queries")


# ------------------------------------------------------------------ tokenisers (raw page text)
from fieldrank.functions import text as TX  # noqa: E402
from fieldrank.functions import scoring as SC  # noqa: E402
from fieldrank.oracle import toks as _toks, url_toks as _url_toks  # noqa: E402

_RAW_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
_RAW_H1 = "regexp_extract_all(html, '<h1>([^<]*)</h1>', 1)"
_RAW_A = """regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)"""


def _pos_tokens_sql(key: str, arr: str, src: str = "pages") -> str:
    return (f"SELECT {key}, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, unnest(t) AS token "
            f"FROM (SELECT {key}, {arr} AS t FROM {src})")


def _pos_tokens(df: DataFrame, key: str, arr) -> DataFrame:
    return df.select(key, F.posexplode(arr).alias("pos", "token")).withColumn("pos", F.col("pos").cast("int"))


def _pages(spark, sf):
    return T.table(spark, sf, "pages")


@register("tok_url", _pos_tokens_sql("page_id", _url_toks("url")))
def q_tok_url(spark, sf):
    return _pos_tokens(_pages(spark, sf), "page_id", TX.tok_url(F.col("url")))


@register("tok_title_lower", _pos_tokens_sql("page_id", _toks(_RAW_TITLE, True)))
def q_tok_title_lower(spark, sf):
    return _pos_tokens(_pages(spark, sf), "page_id", TX.tok_lower(F.regexp_extract("html", "<title>([^<]*)</title>", 1)))


@register("tok_title_raw", _pos_tokens_sql("page_id", _toks(_RAW_TITLE)))
def q_tok_title_raw(spark, sf):
    return _pos_tokens(_pages(spark, sf), "page_id", TX.tok_raw(F.regexp_extract("html", "<title>([^<]*)</title>", 1)))


@register("tok_header_lower", _pos_tokens_sql(
    "page_id", f"flatten(list_transform({_RAW_H1}, lambda h: {_toks('h', True)}))"))
def q_tok_header_lower(spark, sf):
    h = F.regexp_extract_all("html", F.lit("<h1>([^<]*)</h1>"), 1)
    return _pos_tokens(_pages(spark, sf), "page_id", TX.tok_headers_lower(h))


@register("tok_header_raw", _pos_tokens_sql(
    "page_id", f"flatten(list_transform({_RAW_H1}, lambda h: {_toks('h')}))"))
def q_tok_header_raw(spark, sf):
    h = F.regexp_extract_all("html", F.lit("<h1>([^<]*)</h1>"), 1)
    return _pos_tokens(_pages(spark, sf), "page_id", TX.tok_headers_raw(h))


@register("tok_anchor", f"""SELECT page_id, link_no, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos,
        unnest(t) AS token, unnest(r) AS token_raw FROM (
      SELECT page_id, CAST(link_no AS INTEGER) AS link_no, {_toks('a', True)} AS t, {_toks('a')} AS r FROM (
        SELECT page_id, unnest(l) AS a, generate_subscripts(l, 1) - 1 AS link_no
        FROM (SELECT page_id, {_RAW_A} AS l FROM pages)))""")
def q_tok_anchor(spark, sf):
    a = _pages(spark, sf).select("page_id", F.posexplode(
        F.regexp_extract_all("html", F.lit('<a href="[^"]*">([^<]*)</a>'), 1)).alias("link_no", "a"))
    z = F.arrays_zip(TX.tok_lower(F.col("a")).alias("token"), TX.tok_raw(F.col("a")).alias("token_raw"))
    return a.select("page_id", F.col("link_no").cast("int").alias("link_no"), F.posexplode(z).alias("pos", "z")).select(
        "page_id", "link_no", F.col("pos").cast("int").alias("pos"), "z.token", "z.token_raw")


@register("tok_query", O.with_sql("SELECT query_id, qpos AS pos, term FROM q_tok"))
def q_tok_query(spark, sf):
    q = T.queries(spark, sf)
    return q.select("query_id", F.posexplode(TX.tok_query(F.col("query"))).alias("pos", "term")).withColumn(
        "pos", F.col("pos").cast("int"))


@register("body_postings", O.with_sql(
    "SELECT page_id, term, CAST(count(*) AS BIGINT) AS tf, array_to_string(list_sort(list(pos)), ' ') AS positions "
    "FROM pg_tok WHERE f = 'body' GROUP BY page_id, term"))
def q_body_postings(spark, sf):
    post = pages_job(spark, sf, full_index=True).index.postings.where("field = 'body'")
    return post.select("page_id", "term", "tf", F.array_join(F.col("positions").cast("array<string>"), " ").alias("positions"))


@register("body_length_clamp", O.with_sql(
    "SELECT page_id, CAST(len(body_tokens) AS INTEGER) AS body_length, "
    "greatest(1000.0, coalesce(CAST(len(body_tokens) AS DOUBLE), 1.0)) AS clamped FROM pg_coll"))
def q_body_length_clamp(spark, sf):
    c = T.pages_collection(spark, sf)
    return c.select("page_id", "body_length", TX.body_length_clamp(F.col("body_length")).alias("clamped"))


@register("body_hits_total", O.with_sql("SELECT query_id, page_id, hits FROM pg_pairs"))
def q_body_hits_total(spark, sf):
    return pages_job(spark, sf).cands.select("query_id", "page_id", "hits")


# ------------------------------------------------------------------ term frequencies and vectors
@register("tf_counts", O.with_sql(
    "SELECT page_id, term, CAST(count(*) AS DOUBLE) AS tf FROM pg_tok WHERE f = 'title' GROUP BY page_id, term"))
def q_tf_counts(spark, sf):
    t = pages_job(spark, sf, full_index=True).index.terms.where("tf_title > 0")
    return t.select("page_id", "term", F.col("tf_title").cast("double").alias("tf"))


@register("tf_body", O.with_sql(
    "SELECT m.query_id, m.page_id, m.term, CAST(m.tf_body AS BIGINT) AS tf FROM pg_m m "
    "SEMI JOIN pg_pairs USING (query_id, page_id) WHERE m.tf_body > 0"))
def q_tf_body(spark, sf):
    j = pages_job(spark, sf)
    return j.matched.where("tf_body > 0").select("query_id", "page_id", "term", F.col("tf_body").alias("tf"))


@register("tf_anchor", O.with_sql(
    "SELECT page_id, term, CAST(tf_anchor AS BIGINT) AS tf FROM pg_pt WHERE tf_anchor > 0"))
def q_tf_anchor(spark, sf):
    t = pages_job(spark, sf, full_index=True).index.terms.where("tf_anchor > 0")
    return t.select("page_id", "term", F.col("tf_anchor").alias("tf"))


_PFV_SQL = """SELECT page_id, field, term, CAST(tf AS BIGINT) AS tf, round(tf / L, 9) AS ntf,
        round(CASE WHEN tf / L > 0 THEN 1 + ln(tf / L) ELSE 0.0 END, 6) AS weight
    FROM (SELECT page_id, term, unnest(['url', 'title', 'header', 'body', 'anchor']) AS field,
                 unnest([tf_url, tf_title, tf_header, tf_body, tf_anchor]) AS tf FROM pg_pt)
    JOIN (SELECT page_id, L FROM pg_ps) USING (page_id) WHERE tf > 0"""


def _pfv(spark, sf):
    from fieldrank.operators.cosine import page_field_vectors
    v = page_field_vectors(pages_job(spark, sf, full_index=True).index)
    return v.select("page_id", "field", "term", "tf", F.round("ntf", 9).alias("ntf"), r6("weight").alias("weight"))


@register("page_field_vectors", O.with_sql(_PFV_SQL))
def q_page_field_vectors(spark, sf):
    return _pfv(spark, sf)


@register("tf_normalize", O.with_sql(f"SELECT page_id, field, term, ntf FROM ({_PFV_SQL})"))
def q_tf_normalize(spark, sf):
    return _pfv(spark, sf).select("page_id", "field", "term", "ntf")


@register("tf_logify", O.with_sql(f"SELECT page_id, field, term, weight FROM ({_PFV_SQL})"))
def q_tf_logify(spark, sf):
    return _pfv(spark, sf).select("page_id", "field", "term", "weight")


def _page_weight_sql(src: str, w: CosineWeights = CosineWeights()) -> str:
    lg = O.lg
    return (f"{w.url} * {lg('tf_url / L')} + {w.title} * {lg('tf_title / L')} + {w.header} * {lg('tf_header / L')} + "
            f"{w.anchor} * {lg('tf_anchor / L')} + (CASE WHEN tf_body > 0 THEN {w.body} * {lg('tf_body / L')} ELSE 0.0 END)")


@register("page_vector", O.with_sql(
    f"SELECT page_id, term, round({_page_weight_sql('x')}, 6) AS weight FROM "
    "(SELECT t.*, ps.L FROM pg_pt t JOIN pg_ps ps USING (page_id)) "
    "WHERE tf_url + tf_title + tf_header + tf_body + tf_anchor > 0"))
def q_page_vector(spark, sf):
    from fieldrank.operators.cosine import page_vector
    v = page_vector(pages_job(spark, sf, full_index=True).index)
    return v.select("page_id", "term", r6("weight").alias("weight"))


@register("query_vector", O.with_sql("SELECT query_id, term, round(qw, 6) AS weight FROM q_idf"))
def q_query_vector(spark, sf):
    return q_tfidf_query(spark, sf)


@register("cosine_l1", O.with_sql("SELECT query_id, page_id, round(cosine, 6) AS cosine FROM pg_pairs_cos"))
def q_cosine_l1(spark, sf):
    return pages_job(spark, sf).cosine().select("query_id", "page_id", r6("score").alias("cosine"))


@register("join_shared_terms", O.with_sql(
    f"SELECT query_id, page_id, term, round(qw, 6) AS query_weight, round({_page_weight_sql('m')}, 6) AS page_weight "
    "FROM pg_m SEMI JOIN pg_pairs USING (query_id, page_id) "
    "WHERE tf_url + tf_title + tf_header + tf_body + tf_anchor > 0"))
def q_join_shared_terms(spark, sf):
    from fieldrank.operators.match import body_part, static_part
    j = pages_job(spark, sf)
    w = CosineWeights().as_tuple()
    L = F.col("L")
    m = j.matched.where("tf_url + tf_title + tf_header + tf_body + tf_anchor > 0")
    pw = static_part(w, L) + F.coalesce(body_part(w, L), F.lit(0.0))
    return m.select("query_id", "page_id", "term", r6("qw").alias("query_weight"), r6(pw).alias("page_weight"))


# ------------------------------------------------------------------ BM25F parts


def _bm25_rows_sql(cols: str, where: str = "") -> str:
    return O.with_sql(f"SELECT {cols} FROM (SELECT m.* FROM pg_m m SEMI JOIN pg_pairs USING (query_id, page_id)) "
                      f"CROSS JOIN pg_avg {where}")


def _bm25_rows(spark, sf):
    j = pages_job(spark, sf)
    return j.matched.crossJoin(F.broadcast(j.avg_len))


@register("bm25f_raw_tf", _bm25_rows_sql(
    "query_id, page_id, term, tf_url, rtf_title AS tf_title, rtf_header AS tf_header, tf_body, rtf_anchor AS tf_anchor",
    "WHERE tf_url + rtf_title + rtf_header + tf_body + rtf_anchor > 0"))
def q_bm25f_raw_tf(spark, sf):
    m = _bm25_rows(spark, sf).where("tf_url + rtf_title + rtf_header + tf_body + rtf_anchor > 0")
    return m.select("query_id", "page_id", "term", "tf_url", F.col("rtf_title").alias("tf_title"),
                    F.col("rtf_header").alias("tf_header"), "tf_body", F.col("rtf_anchor").alias("tf_anchor"))


def _norm_sql(i: int, prm: BM25FParams = BM25FParams()) -> str:
    raw = ("tf_url", "rtf_title", "rtf_header", "tf_body", "rtf_anchor")[i]
    ln_ = ("len_url", "len_title", "len_header", "L", "len_anchor")[i]
    av = ("avg_url", "avg_title", "avg_header", "avg_body", "avg_anchor")[i]
    bp = f"(1 + {prm.B[i]} * ({ln_} / nullif({av}, 0) - 1))"
    return f"(CASE WHEN {av} = 0 OR {bp} = 0 THEN 0.0 ELSE {raw} / {bp} END)"


_FN = ("url", "title", "header", "body", "anchor")


@register("bm25f_field_norm", _bm25_rows_sql(
    "query_id, page_id, term, " + ", ".join(f"round({_norm_sql(i)}, 6) AS n_{f}" for i, f in enumerate(_FN))))
def q_bm25f_field_norm(spark, sf):
    p = BM25FParams()
    m = _bm25_rows(spark, sf)
    cols = [r6(SC.bm25f_field_norm(F.col(bm.RAW_TF[i]), p.B[i], F.col(bm.LENGTH[i]), F.col(bm.AVG[i]))).alias(f"n_{f}")
            for i, f in enumerate(_FN)]
    return m.select("query_id", "page_id", "term", *cols)


@register("bm25f_weight", _bm25_rows_sql(
    "query_id, page_id, term, round(" + O.bm25f_expr(BM25FParams())[0] + ", 6) AS w"))
def q_bm25f_weight(spark, sf):
    m = _bm25_rows(spark, sf)
    return m.select("query_id", "page_id", "term", r6(bm.term_weight(bm.P.of(BM25FParams()))).alias("w"))


@register("bm25f_text", O.with_sql("SELECT query_id, page_id, round(text_score, 6) AS text_score FROM pg_bm25f"))
def q_bm25f_text(spark, sf):
    return pages_job(spark, sf).bm25f().select("query_id", "page_id", r6("text_score").alias("text_score"))


def _vf_sql(name: str, l1: float, l2: float) -> str:
    prm = BM25FParams(lamd=1.0, lamd_prime=l1, lamd_prime2=l2, vf=name)
    expr = O.bm25f_expr(prm)[1].split("*", 1)[1]
    return f"SELECT page_id, CAST(page_id % 11 AS INTEGER) AS pagerank, round({expr}, 6) AS vf FROM pages"


def _vf_q(fn, l1, l2):
    def q(spark, sf):
        c = T.pages_collection(spark, sf)
        return c.select("page_id", "pagerank", r6(fn(F.col("pagerank"), l1, l2)).alias("vf"))
    return q


# Vf settings of the published BM25F runs (lambda', lambda'')
register("vf_logarithmic", _vf_sql("logarithmic", 2.0, 1.0))(_vf_q(SC.vf_logarithmic, 2.0, 1.0))
register("vf_saturation", _vf_sql("saturation", 20.0, 1.0))(_vf_q(SC.vf_saturation, 20.0, 1.0))
register("vf_sigmoid", _vf_sql("sigmoid", 1.0, 0.5))(_vf_q(SC.vf_sigmoid, 1.0, 0.5))


# ------------------------------------------------------------------ windows
@register("all_terms_in_field", O.with_sql(
    "SELECT query_id, page_id, CASE WHEN fld LIKE 'anchor:%' THEN 'anchor' ELSE fld END AS field, "
    "CAST(count(*) AS BIGINT) AS n_instances FROM pg_ek GROUP BY ALL"))
def q_all_terms_in_field(spark, sf):
    from fieldrank.operators.window import all_terms_in_field, query_term_postings
    j = pages_job(spark, sf)
    full = all_terms_in_field(query_term_postings(j.qterms, j.index, j.candidate_pairs))
    return full.groupBy("query_id", "page_id", "field").agg(F.count(F.lit(1)).alias("n_instances"))


@register("window_boost", O.with_sql("SELECT query_id, page_id, qlen, window_size, round(boost, 6) AS boost FROM pg_cw"))
def q_window_boost(spark, sf):
    c = pages_job(spark, sf).cosine_window()
    return c.select("query_id", "page_id", "qlen", "window_size", r6("boost").alias("boost"))


def _boost_fn_sql(fn: str) -> str:
    e = {"inverse": "greatest(1.0, 16.0 * (CAST(qlen AS DOUBLE) / window_size))",
         "sigmoid": "greatest(1.0, 16.0 * (1 - 1 / (1 + exp(-CAST(window_size - qlen AS DOUBLE)))))"}[fn]
    return O.with_sql(f"SELECT query_id, page_id, qlen, window_size, round({e}, 6) AS boost "
                      "FROM pg_win JOIN q_stats USING (query_id)")


def _boost_q(fn):
    def q(spark, sf):
        j = pages_job(spark, sf)
        w = j.windows.join(j.query_stats, "query_id")
        return w.select("query_id", "page_id", "qlen", "window_size",
                        r6(fn(16.0, F.col("qlen"), F.col("window_size"))).alias("boost"))
    return q


register("boost_inverse", _boost_fn_sql("inverse"))(_boost_q(SC.boost_inverse))
register("boost_sigmoid", _boost_fn_sql("sigmoid"))(_boost_q(SC.boost_sigmoid))


# ------------------------------------------------------------------ ranking and evaluation (judged pages)
@register("rank_within_query", O.with_sql(O.ranked_sql("dc_pairs_cos", "cosine")))
def q_rank_within_query(spark, sf):
    j = docs_job(spark, sf)
    return j.rank(j.cosine())


@register("dcg", O.with_sql("SELECT query_id, round(dcg, 6) AS dcg FROM ndcg_q", extra=ndcg_cte("dc_bm25f", "bm25f")))
def q_dcg(spark, sf):
    return _ndcg(docs_job(spark, sf).bm25f()).select("query_id", "dcg")


@register("idcg", O.with_sql("SELECT query_id, round(idcg, 6) AS idcg FROM ndcg_q", extra=ndcg_cte("dc_bm25f", "bm25f")))
def q_idcg(spark, sf):
    return _ndcg(docs_job(spark, sf).bm25f()).select("query_id", "idcg")


@register("mean_ndcg", O.with_sql(
    "SELECT round(avg(ndcg), 6) AS mean_ndcg, count(*) AS n_queries FROM ndcg_q",
    extra=ndcg_cte("dc_pairs_cos", "cosine")))
def q_mean_ndcg(spark, sf):
    from fieldrank.operators.evaluate import rank_within
    r = rank_within(docs_job(spark, sf).cosine(), "score")
    return mean_ndcg(ndcg_per_query(r)).select(r6("mean_ndcg").alias("mean_ndcg"), "n_queries")


@register("join_judgments", O.with_sql(
    "SELECT r.query_id, r.rank, r.page_id, CAST(2 * l.quality - l.toxic AS DOUBLE) AS rel FROM ("
    + O.ranked_sql("dc_bm25f", "bm25f") + ") r JOIN labels l ON l.doc_id = r.page_id"))
def q_join_judgments(spark, sf):
    from fieldrank.operators.evaluate import join_judgments
    r = ranked(docs_job(spark, sf).bm25f())
    return join_judgments(r, T.judgments(spark, sf).withColumnRenamed("doc_id", "page_id"), "page_id").select(
        "query_id", "rank", "page_id", "rel")


@register("ranking_completeness", O.with_sql(
    "SELECT (SELECT count(*) FROM pg_pairs x ANTI JOIN r USING (query_id, page_id)) AS missing, "
    "(SELECT count(*) FROM r ANTI JOIN pg_pairs USING (query_id, page_id)) AS unexpected, "
    "(SELECT count(*) FROM (SELECT query_id, page_id FROM r GROUP BY ALL HAVING count(*) > 1)) AS duplicated",
    extra={"r": O.ranked_sql("pg_bm25f", "bm25f")}))
def q_ranking_completeness(spark, sf):
    from fieldrank.operators.evaluate import ranking_completeness
    j = parsed_once(pages_job(spark, sf))
    return ranking_completeness(ranked(j.bm25f()), j.pages_of_pairs)


# ------------------------------------------------------------------ sweeps
from fieldrank.params import BOOST_FUNCTIONS, BOOST_GRID, BM25F_SETTINGS, cosine_weight_grid  # noqa: E402
from fieldrank.plans import sweeps as SW  # noqa: E402


def _values(rows, cols) -> str:
    def v(x):
        return f"'{x}'" if isinstance(x, str) else repr(float(x)) if isinstance(x, float) else str(x)
    body = ", ".join("(" + ", ".join(v(x) for x in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({', '.join(cols)})"


_BP = _values([(i, fn, b) for i, (fn, b) in enumerate((fn, b) for fn in BOOST_FUNCTIONS for b in BOOST_GRID)],
              ["param_id", "function", "boost"])
_BOOST_COLS = ("(CASE WHEN w.window_size IS NULL THEN 1.0 WHEN w.window_size = s.qlen THEN bp.boost "
               "WHEN w.window_size > s.qlen THEN (CASE bp.function "
               "WHEN 'inverse' THEN greatest(1.0, bp.boost * (CAST(s.qlen AS DOUBLE) / w.window_size)) "
               "WHEN 'sigmoid' THEN greatest(1.0, bp.boost * (1 - 1 / (1 + exp(-CAST(w.window_size - s.qlen AS DOUBLE))))) "
               "ELSE 1.0 END) ELSE 1.0 END)")


@register("sweep_window_boost", O.with_sql(
    "SELECT function, boost, round(avg(ndcg), 6) AS mean_ndcg, count(*) AS n_queries "
    "FROM sw_nd JOIN bp USING (param_id) GROUP BY function, boost",
    extra={"bp": _BP,
           "sw_sc": f"""SELECT bp.param_id, x.query_id, x.page_id, x.tie, x.rel, {_BOOST_COLS} * x.cosine AS score
                FROM dc_pairs_cos x JOIN q_stats s USING (query_id) LEFT JOIN dc_win w USING (query_id, page_id)
                CROSS JOIN bp""",
           **ndcg_cte("sw_sc", "score", "sw_nd", "param_id, query_id")}))
def q_sweep_window_boost(spark, sf):
    return SW.sweep_window_boost(terms_once(parsed_once(docs_job(spark, sf))), spark).withColumn("mean_ndcg", r6("mean_ndcg"))


def _bm25_sweep_sql() -> str:
    ext = {}
    parts = []
    for i, prm in enumerate(BM25F_SETTINGS):
        ext.update(O.bm25f_cte("dc", prm, name=f"dc_bm_{i}"))
        parts.append(f"SELECT {i} AS param_id, '{prm.name}' AS setting, query_id, page_id, tie, rel, bm25f AS score FROM dc_bm_{i}")
    ext["sb_sc"] = " UNION ALL ".join(parts)
    ext.update(ndcg_cte("sb_sc", "score", "sb_nd", "param_id, query_id"))
    return O.with_sql("SELECT setting, round(avg(ndcg), 6) AS mean_ndcg, count(*) AS n_queries FROM sb_nd "
                      "JOIN (SELECT DISTINCT param_id, setting FROM sb_sc) USING (param_id) GROUP BY setting", extra=ext)


@register("sweep_bm25f", _bm25_sweep_sql())
def q_sweep_bm25f(spark, sf):
    return SW.sweep_bm25f(parsed_once(docs_job(spark, sf)), spark).withColumn("mean_ndcg", r6("mean_ndcg"))


def _cos_sweep_sql(grid=None) -> str:
    ext = {}
    parts = []
    for i, w in enumerate(grid or cosine_weight_grid()):
        ext.update(O.pairs_cte("dc", w, name=f"dc_cw_{i}"))
        parts.append(f"SELECT {i} AS param_id, {w.url} AS w_url, {w.title} AS w_title, {w.header} AS w_header, "
                     f"{w.body} AS w_body, {w.anchor} AS w_anchor, query_id, page_id, tie, rel, cosine AS score "
                     f"FROM dc_cw_{i}_cos")
    ext["sc_sc"] = " UNION ALL ".join(parts)
    ext.update(ndcg_cte("sc_sc", "score", "sc_nd", "param_id, query_id"))
    return O.with_sql("SELECT w_url, w_title, w_header, w_body, w_anchor, round(avg(ndcg), 6) AS mean_ndcg, "
                      "count(*) AS n_queries FROM sc_nd JOIN (SELECT DISTINCT param_id, w_url, w_title, w_header, "
                      "w_body, w_anchor FROM sc_sc) USING (param_id) GROUP BY ALL", extra=ext)


@register("sweep_cosine_weights", _cos_sweep_sql())
def q_sweep_cosine_weights(spark, sf):
    return SW.sweep_cosine_weights(parsed_once(docs_job(spark, sf)), spark).withColumn("mean_ndcg", r6("mean_ndcg"))


def _compare_sql() -> str:
    srcs = {"baseline": ("dc_pairs", "CAST(hits AS DOUBLE)"), "cosine": ("dc_pairs_cos", "cosine"),
            "bm25f": ("dc_bm25f", "bm25f"), "cosine_window": ("dc_cw", "cw")}
    parts = [f"SELECT '{k}' AS ranker, query_id, page_id, tie, rel, {sc} AS score FROM {src}" for k, (src, sc) in srcs.items()]
    ext = {"cr_sc": " UNION ALL ".join(parts)}
    ext.update(ndcg_cte("cr_sc", "score", "cr_nd", "ranker, query_id"))
    cols = ", ".join(f"round(max(CASE WHEN ranker = '{k}' THEN ndcg END), 6) AS ndcg_{k}" for k in srcs)
    return O.with_sql(f"SELECT query_id, {cols} FROM cr_nd GROUP BY query_id", extra=ext)


@register("compare_rankers", _compare_sql())
def q_compare_rankers(spark, sf):
    c = SW.compare_rankers(matched_once(terms_once(parsed_once(docs_job(spark, sf)))))
    return c.select("query_id", *[r6(x).alias(x) for x in c.columns if x != "query_id"])


# ------------------------------------------------------------------ files: readers, writers, snapshots
from fieldrank.sources import corpus as CO  # noqa: E402
from fieldrank.sources import textfmt as TF  # noqa: E402


def term_positions(coll: DataFrame, queries: DataFrame) -> DataFrame:
    """(_row, _positions): the places (from 1) of the terms of any query in each body of ``coll``, whose rows
    ``_row`` names: a body is read once for all its queries. Its tokens stay in one partition."""
    known = stats.query_terms(queries).select("term").distinct()
    parts = int(coll.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tokens = coll.select("_row", "body_tokens").repartition(parts, "_row").select("_row", F.posexplode("body_tokens").alias("at", "term"))
    places = tokens.join(known, "term", "left_semi").groupBy("_row", "term").agg(F.sort_array(F.collect_list(F.col("at") + 1)).alias("positions"))
    return places.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("term", "positions"))).alias("_positions"))


def feature_records(spark, sf) -> DataFrame:
    """Feature records (the reference's input shape) of the page candidates of every
    distinct query text: body_hits hold the query's terms (and, where the page id divides by
    5, a listed term outside the query). Each query also has a record without any token."""
    q, coll = T.queries(spark, sf), T.pages_collection(spark, sf).withColumn("_row", F.monotonically_increasing_id())
    coll = CO.snapshot(coll, CO.scratch_path(spark, "parsed"))
    texts = q.groupBy("query").agg(F.min("query_id").alias("query_id"))
    c = T.candidates(q, coll).join(texts, "query_id")
    place = F.row_number().over(Window.partitionBy("query").orderBy("page_id")) - 1  # a query's candidates
    c = c.withColumn("url_pos", place.cast("int"))
    terms = F.array_distinct(TX.tok_query(F.col("query")))
    known = F.filter(terms, lambda t: F.map_contains_key("_positions", t))
    hits = F.transform(known, lambda t: F.struct(t.alias("term"), F.try_element_at("_positions", t).alias("positions")))
    extra = F.array(F.struct(F.lit("zz_listed").alias("term"), F.array(F.lit(3), F.lit(7)).alias("positions")))
    hits = F.concat(hits, F.filter(extra, lambda h: F.col("page_id") % 5 == 0))
    anchors = F.map_from_entries(F.transform("anchors", lambda a: F.struct(a["text"], a["cnt"])))
    pages = coll.drop("body_tokens").join(term_positions(coll, q), "_row", "left") \
        .withColumn("_positions", F.coalesce("_positions", F.create_map().cast("map<string,array<int>>")))
    rows = c.join(pages, "page_id").select("query", "url", "url_pos", "title", "headers", F.map_from_entries(hits).alias("body_hits"),
                                          "body_length", "pagerank", anchors.alias("anchors"))
    rows = CO.snapshot(rows, CO.scratch_path(spark, "records"))  # read for blocks, lines and their order
    none = rows.groupBy("query").agg((F.max("url_pos") + 1).cast("int").alias("url_pos")).withColumn("url", F.lit("///"))
    return rows.unionByName(none, allowMissingColumns=True)


def records_job(spark, sf) -> RankingJob:
    """The rankers' only way in the reference: a feature file, read and ranked."""
    path = CO.scratch_path(spark, "features")
    TF.write_feature_file(feature_records(spark, sf), path)
    _, coll = TF.features_to_collection(TF.read_feature_file(spark, path))
    coll = CO.snapshot(coll, CO.scratch_path(spark, "records"))
    queries = CO.snapshot(coll.select("query_id", F.col("query_id").alias("query")).distinct(), CO.scratch_path(spark, "queries"))
    return terms_once(idf_once(RankingJob(queries, coll, T.corpus(spark, sf))))


def _features_rank(ranker):
    def q(spark, sf):
        r = rank_within(ranker(records_job(spark, sf)), "score")
        return r.select(F.col("query_id").alias("query"), "rank", "url", r6("score").alias("score"))
    return q


def _features_sql(src: str, score: str) -> str:
    return O.with_sql("SELECT q.query, r.rank, r.url, r.score FROM (" + O.ranked_sql(src, score) + ") r JOIN fr_q q USING (query_id)")


register("features_rank_baseline", O.with_sql(
    "SELECT q.query, CAST(row_number() OVER (PARTITION BY query_id ORDER BY hits DESC, tie) AS INTEGER) AS rank, url, hits AS score "
    "FROM (SELECT x.query_id, x.tie, x.url, CAST(coalesce(b.hits, 0) AS DOUBLE) AS hits FROM fr_pairs x LEFT JOIN "
    "(SELECT page_id, count(*) AS hits FROM fr_body GROUP BY page_id) b USING (page_id)) JOIN fr_q q USING (query_id)"))(
    _features_rank(lambda j: j.baseline()))
register("features_rank_cosine", _features_sql("fr_pairs_cos", "cosine"))(_features_rank(lambda j: j.cosine()))
register("features_rank_bm25f", _features_sql("fr_bm25f", "bm25f"))(_features_rank(lambda j: j.bm25f()))
register("features_rank_cosine_window", _features_sql("fr_cw", "cw"))(_features_rank(lambda j: j.cosine_window()))


def _flat_features(df: DataFrame) -> DataFrame:
    hits = F.array_join(F.transform(F.sort_array(F.map_entries(F.coalesce("body_hits", F.create_map().cast("map<string,array<int>>")))),
                                    lambda e: F.concat_ws(" ", e["key"], F.array_join(e["value"].cast("array<string>"), " "))), ";")
    anch = F.array_join(F.transform(F.sort_array(F.map_entries(F.coalesce("anchors", F.create_map().cast("map<string,int>")))),
                                    lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    return df.select("query", "url", "url_pos", "title", F.size("headers").cast("int").alias("n_headers"),
                     F.array_join("headers", "|").alias("headers"), hits.alias("body_hits"),
                     "body_length", "pagerank", anch.alias("anchors"))


_FEAT_SQL = O.with_sql("""SELECT q.query, c.url, CAST(x.tie AS INTEGER) AS url_pos,
        CASE WHEN r.page IS NOT NULL THEN c.title END AS title, CAST(len(c.headers) AS INTEGER) AS n_headers,
        array_to_string(c.headers, '|') AS headers, coalesce(h.body_hits, '') AS body_hits,
        CAST(l.body_length AS INTEGER) AS body_length, CASE WHEN r.page IS NOT NULL THEN c.pagerank END AS pagerank,
        coalesce(a.anchors, '') AS anchors
    FROM fr_cand x JOIN fr_q q USING (query_id) JOIN fr_coll c ON c.page_id = x.page_id LEFT JOIN fr_rec r ON r.page_id = x.page_id
    LEFT JOIN fr_len l ON l.page_id = x.page_id
    LEFT JOIN (SELECT page_id, string_agg(term || ' ' || pos, ';' ORDER BY term) AS body_hits FROM (
          SELECT page_id, term, array_to_string(list_sort(list(pos)), ' ') AS pos FROM fr_body GROUP BY page_id, term) GROUP BY page_id) h
      ON h.page_id = x.page_id
    LEFT JOIN (SELECT page_id, string_agg(text || '=' || cnt, ';' ORDER BY text) AS anchors FROM fr_anch GROUP BY page_id) a
      ON a.page_id = x.page_id""")


@register("read_features_roundtrip", _FEAT_SQL)
def q_read_features_roundtrip(spark, sf):
    path = CO.scratch_path(spark, "features")
    TF.write_feature_file(feature_records(spark, sf), path)
    return _flat_features(TF.read_feature_file(spark, path))


@register("read_judgments_roundtrip", O.with_sql(
    "SELECT DISTINCT q.query, x.url, x.rel FROM dc_pairs x JOIN fx_queries q USING (query_id)"))
def q_read_judgments_roundtrip(spark, sf):
    j = docs_job(spark, sf)
    judged = j.cands.select("query_id", "url", "rel").join(T.queries(spark, sf), "query_id").select(
        "query", "url", "rel").distinct()
    path = CO.scratch_path(spark, "judgments")
    TF.write_judgments(judged, path)
    return TF.read_judgments(spark, path)


@register("write_ranking_roundtrip", O.with_sql(
    "SELECT q.query, r.rank, r.url FROM (" + O.ranked_sql("pg_bm25f", "bm25f") + ") r JOIN fx_queries q USING (query_id)"))
def q_write_ranking_roundtrip(spark, sf):
    r = ranked(parsed_once(pages_job(spark, sf)).bm25f()).join(T.queries(spark, sf), "query_id")
    path = CO.scratch_path(spark, "ranking")
    TF.write_ranking(r, path)
    return TF.read_ranking(spark, path)


@register("score_files", O.with_sql(
    "SELECT round(avg(ndcg), 6) AS mean_ndcg, count(*) AS n_queries FROM sf_nd",
    extra={"sf_sc": "SELECT b.query_id, b.tie, b.bm25f AS score, CAST(2 * l.quality - l.toxic AS DOUBLE) AS rel "
                    "FROM pg_bm25f b SEMI JOIN fr_q USING (query_id) JOIN labels l ON l.doc_id = b.page_id",
           **ndcg_cte("sf_sc", "score", "sf_nd")}))
def q_score_files(spark, sf):
    """NDCG of a ranking file against a judgments file, joined on query text and url; ranked
    urls without a judgment are dropped."""
    from fieldrank.operators.evaluate import join_judgments
    one = T.queries(spark, sf).groupBy("query").agg(F.min("query_id").alias("query_id"))
    r = ranked(parsed_once(pages_job(spark, sf)).bm25f()).join(one, "query_id")
    r = CO.snapshot(r, CO.scratch_path(spark, "ranked"))  # both files are made of it, each in several passes
    ranking, judged = CO.scratch_path(spark, "ranking"), CO.scratch_path(spark, "judgments")
    TF.write_ranking(r, ranking)
    labels = T.judgments(spark, sf).withColumnRenamed("doc_id", "page_id")
    TF.write_judgments(r.join(labels, "page_id").select("query", "url", "rel"), judged)
    j = join_judgments(TF.read_ranking(spark, ranking), TF.read_judgments(spark, judged), ["query", "url"], part=("query",))
    return mean_ndcg(ndcg_per_query(j, part=("query",))).select(r6("mean_ndcg").alias("mean_ndcg"), "n_queries")


@register("corpus_scan", O.with_sql("SELECT term, count(*) AS df FROM d_tok GROUP BY term"))
def q_corpus_scan(spark, sf):
    root = CO.scratch_path(spark, "corpus")
    CO.write_corpus(T.table(spark, sf, "documents"), root)
    return stats.doc_freq(CO.scan_corpus(spark, root))


@register("df_snapshot_roundtrip", O.with_sql("SELECT term, count(*) AS df FROM d_tok GROUP BY term"))
def q_df_snapshot_roundtrip(spark, sf):
    return CO.snapshot(stats.doc_freq(T.corpus(spark, sf)), CO.scratch_path(spark, "df"))


def changed_statistics(spark, sf):
    """A store of document frequencies with a history: two batches, a third of the documents removed and
    added again, compacted."""
    from fieldrank.operators.df_store import DocFreqStore
    store, docs = DocFreqStore(spark, CO.scratch_path(spark, "stats")), T.corpus(spark, sf)
    store.add(docs.where("doc_id % 2 = 0"))
    store.add(docs.where("doc_id % 2 <> 0 OR doc_id IS NULL"))
    third = docs.where("doc_id % 3 = 0")
    store.remove(third)
    store.add(third)
    return store.compact(CO.scratch_path(spark, "stats")), docs


@register("df_incremental", O.with_sql("SELECT term, count(*) AS df FROM d_tok GROUP BY term"))
def q_df_incremental(spark, sf):
    store, docs = changed_statistics(spark, sf)
    return store.load(docs)  # None, an error, unless it stands for exactly these documents


@register("idf_incremental", O.with_sql(
    "SELECT term, count(*) AS df, round(ln((SELECT n_total FROM d_n)) - ln(count(*) + 1), 6) AS idf "
    "FROM d_tok GROUP BY term"))
def q_idf_incremental(spark, sf):
    store, _ = changed_statistics(spark, sf)
    return stats.idf(store.table(), store.corpus_size()).select("term", "df", r6("idf").alias("idf"))


@register("query_vocab_df", O.with_sql(
    "SELECT term, count(*) AS df FROM d_tok WHERE term IN (SELECT term FROM q_tok) GROUP BY term"))
def q_query_vocab_df(spark, sf):
    path = CO.scratch_path(spark, "vocab")
    CO.write_vocab(stats.query_terms(T.queries(spark, sf)), path)
    return stats.doc_freq(T.corpus(spark, sf), CO.read_vocab(spark, path))


@register("join_params", O.with_sql(
    "SELECT function, boost, count(*) AS n_pairs, count(*) FILTER (WHERE b > 1.0) AS n_boosted FROM ("
    f"SELECT bp.function, bp.boost, {_BOOST_COLS} AS b FROM pg_pairs x JOIN q_stats s USING (query_id) "
    "LEFT JOIN pg_win w USING (query_id, page_id) CROSS JOIN bp) GROUP BY function, boost", extra={"bp": _BP}))
def q_join_params(spark, sf):
    from fieldrank.functions.scoring import window_boost
    j = pages_job(spark, sf)
    c = j.cands.select("query_id", "page_id", "qlen").join(j.windows, ["query_id", "page_id"], "left")
    x = c.crossJoin(F.broadcast(SW.boost_params(spark)))
    b = window_boost(F.col("boost"), F.col("function"), F.col("qlen"), F.col("window_size"))
    return x.groupBy("function", "boost").agg(F.count(F.lit(1)).alias("n_pairs"),
                                               F.count(F.when(b > 1.0, 1)).alias("n_boosted"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
