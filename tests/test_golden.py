"""Golden values worked by hand from the ranking formulas (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from fieldrank.functions import scoring as S
from fieldrank.operators.evaluate import ndcg_per_query
from fieldrank.operators.window import smallest_window
from fieldrank.params import BM25FParams, CosineWeights, WindowBoost
from fieldrank.plans.rankers import RankingJob
from fieldrank.sources.textfmt import ANCHOR_COUNT_KEY as AC, features_to_collection, read_feature_file

APPROX = dict(abs=1e-6)


def _window(spark, lists):
    return spark.createDataFrame([(lists,)], "l array<array<int>>").select(smallest_window(F.col("l")).alias("w")).first()["w"]


def test_smallest_window(spark):
    assert _window(spark, [[1, 9], [4, 10]]) == 2
    assert _window(spark, [[1, 9], []]) is None
    assert _window(spark, [[], []]) is None
    assert _window(spark, [[5]]) == 1
    assert _window(spark, [[3, 3, 8], [8, 8]]) == 1  # listed hits may repeat and coincide


def _eval1(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize("w,expected", [(3, 10.666667), (4, 8.0), (5, 6.4), (32, 1.0), (33, 1.0)])
def test_boost_inverse(spark, w, expected):
    assert _eval1(spark, S.boost_inverse(16.0, F.lit(2), F.lit(w))) == pytest.approx(expected, **APPROX)


@pytest.mark.parametrize("w,expected", [(3, 4.303063), (4, 1.907246), (5, 1.0), (32, 1.0)])
def test_boost_sigmoid(spark, w, expected):
    assert _eval1(spark, S.boost_sigmoid(16.0, F.lit(2), F.lit(w))) == pytest.approx(expected, **APPROX)


def test_window_boost_branches(spark):
    wb = lambda w: _eval1(spark, S.window_boost(16.0, "inverse", F.lit(2), F.lit(w).cast("int")))
    assert wb(2) == 16.0          # window == qlen
    assert wb(None) == 1.0        # no window
    assert wb(1) == 1.0           # window < qlen (query "the the")
    assert _eval1(spark, S.window_boost(16.0, "other", F.lit(2), F.lit(5))) == 1.0


@pytest.mark.parametrize("rels,expected", [
    ([3, 2, 0, 1], 0.992620), ([0, 1], 0.630930), ([-1, 2], 0.630930),
    ([1.5, 0.5, 2], 0.823206), ([0, 0], 1.0),
])
def test_ndcg(spark, rels, expected):
    df = spark.createDataFrame([(1, i + 1, float(r)) for i, r in enumerate(rels)], "query_id int, rank int, rel double")
    assert ndcg_per_query(df).first()["ndcg"] == pytest.approx(expected, **APPROX)


def test_static_rank_functions(spark):
    assert _eval1(spark, S.vf_logarithmic(F.lit(6), 2.0)) == pytest.approx(2.079442, **APPROX)
    assert _eval1(spark, S.vf_logarithmic(F.lit(0), 2.0)) == pytest.approx(0.693147, **APPROX)
    assert _eval1(spark, S.vf_saturation(F.lit(6), 20.0)) == pytest.approx(0.230769, **APPROX)
    assert _eval1(spark, S.vf_sigmoid(F.lit(6), 1.0, 0.5)) == pytest.approx(0.952574, **APPROX)


TWO_PAGES = f"""query: alpha beta
  url: http://x.org/alpha_beta?q=1
    title: alpha beta: home
    header: alpha
    header: beta gamma
    body_hits: alpha 1 9
    body_hits: beta 4 10
    body_length: 264
    pagerank: 6
    anchor_text: alpha site
      {AC}: 3
  url: http://x.org/none
    body_length: 5
    pagerank: 0
"""


@pytest.fixture
def two_page_job(spark, tmp_text):
    queries, coll = features_to_collection(read_feature_file(spark, tmp_text("train", TWO_PAGES)))
    corpus = spark.createDataFrame([(1, "alpha x"), (2, "alpha beta"), (3, "y"), (4, "z")], "doc_id long, text string")
    return RankingJob(queries, coll, corpus)


def _by_url(df, col):
    return {r["url"]: r[col] for r in df.collect()}


def test_two_pages_idf(two_page_job):
    idf = {r["term"]: r["idf"] for r in two_page_job.qterms_idf.collect()}
    assert idf["alpha"] == pytest.approx(0.510826, **APPROX)
    assert idf["beta"] == pytest.approx(0.916291, **APPROX)


def test_two_pages_cosine(two_page_job):
    s = _by_url(two_page_job.cosine(), "score")
    assert s["http://x.org/alpha_beta?q=1"] == pytest.approx(0.151397, **APPROX)
    assert s["http://x.org/none"] == 0.0


def test_two_pages_window(two_page_job):
    c = two_page_job.cosine_window(WindowBoost(16.0, "inverse")).collect()
    got = {r["url"]: (r["window_size"], r["boost"], r["score"]) for r in c}
    assert got["http://x.org/alpha_beta?q=1"][0] == 2
    assert got["http://x.org/alpha_beta?q=1"][1] == 16.0
    assert got["http://x.org/alpha_beta?q=1"][2] == pytest.approx(2.422345, **APPROX)
    assert got["http://x.org/none"] == (None, 1.0, 0.0)


def test_two_pages_avg_len(two_page_job):
    a = two_page_job.avg_len.first()
    assert (a["avg_url"], a["avg_title"], a["avg_header"], a["avg_body"], a["avg_anchor"]) == \
        pytest.approx((5.0, 1.5, 1.0, 134.5, 1.0))


def test_two_pages_bm25f(two_page_job):
    s = two_page_job.bm25f(BM25FParams())
    got = {r["url"]: (r["text_score"], r["score"]) for r in s.collect()}
    assert got["http://x.org/alpha_beta?q=1"][0] == pytest.approx(0.647422, **APPROX)
    assert got["http://x.org/alpha_beta?q=1"][1] == pytest.approx(6.885747, **APPROX)
    assert got["http://x.org/none"][1] == pytest.approx(2.079442, **APPROX)


def test_two_pages_baseline_keeps_unmatched(two_page_job):
    s = _by_url(two_page_job.baseline(), "score")
    assert s == {"http://x.org/alpha_beta?q=1": 4.0, "http://x.org/none": 0.0}


def test_cosine_weights_change_scores(two_page_job):
    a = _by_url(two_page_job.cosine(), "score")
    b = _by_url(two_page_job.cosine(CosineWeights(url=-1705, title=-288, header=-85, body=-97, anchor=-17)), "score")
    assert a["http://x.org/alpha_beta?q=1"] != b["http://x.org/alpha_beta?q=1"]


MISSING_LEN = """query: common rare
  url: http://y.org/a
    body_hits: common 3
  url: http://y.org/b
    body_hits: common 1 2
    body_hits: rare 7
    body_length: 500
"""


def test_df_equal_n_and_missing_body_length(spark, tmp_text):
    queries, coll = features_to_collection(read_feature_file(spark, tmp_text("m", MISSING_LEN)))
    corpus = spark.createDataFrame([(1, "common x"), (2, "common rare"), (3, "common")], "doc_id long, text string")
    job = RankingJob(queries, coll, corpus)
    idf = {r["term"]: (r["df"], r["idf"]) for r in job.qterms_idf.collect()}
    # N = 3 documents + 1; 'common' is in every document -> idf = ln(4) - ln(4) = 0
    assert idf["common"] == (3, pytest.approx(0.0, abs=1e-12))
    assert idf["rare"][1] == pytest.approx(0.693147, **APPROX)
    a = job.avg_len.first()
    assert a["avg_body"] == pytest.approx(250.0)  # missing body_length counts 0, no clamp
    p = {r["page_id"]: r for r in job.index.pages.collect()}
    assert sorted(r["L"] for r in p.values()) == [1000.0, 1000.0]  # missing -> 1 -> clamp, 500 -> clamp
