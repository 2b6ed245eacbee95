"""Identity, word, plug-in, judgment and planning rules of the library."""

import math

import pytest
from pyspark.sql import functions as F

from fieldrank.operators.evaluate import idcg_per_query, join_judgments, ndcg_per_query
from fieldrank.params import BM25FParams
from fieldrank.plans import catalog
from fieldrank.plans.rankers import RankingJob, ranked
from fieldrank.plans.sweeps import sweep_bm25f
from fieldrank.sources import corpus as CO
from fieldrank.sources import tables as T
from fieldrank.sources import textfmt as TF

SF = "/root/testdata/sf0.001"


@pytest.fixture
def small(spark, tmp_path):
    """Tables with more than 1,000 sentences in one text and words of other scripts."""
    text = ". ".join(f"straße été слово w{i}" for i in range(1500))
    spark.createDataFrame([(1, text), (2, "only here")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    pages = [(1, "http://a/", "<title>Grüße WELT</title><h1>Kopf</h1><body>x straße été слово w7 y</body>"),
             (2, "http://b/", "<body>only</body>"), (3, "http://c/", "<body>only here, ok</body>")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    return str(tmp_path)


def test_queries_keep_their_identity_and_words(spark, small):
    q = T.queries(spark, small)
    assert q.count() == 1501 and q.select("query_id").distinct().count() == 1501
    assert q.where("query_id = '1-1200'").first()["query"] == "straße été слово w1200"


def test_candidates_share_a_run_and_case_is_kept(spark, small):
    c = T.pages_collection(spark, small)
    got = sorted(tuple(r) for r in T.candidates(T.queries(spark, small), c).collect())
    assert got == [("1-7", 1), ("2-0", 3)]
    r = c.where("page_id = 1").first()
    assert r["title"] == "Grüße WELT" and "grüße" in r["body_tokens"] and r["body_tokens"][-1] == "y"


def test_custom_vf_in_sweep_equals_ranker(spark):
    j = catalog.docs_job(spark, SF)
    five = BM25FParams(name="five", vf=lambda pagerank, a, b: F.lit(5.0) + pagerank)
    zero = BM25FParams(name="zero", vf=lambda pagerank, a, b: F.lit(0.0) * pagerank)
    got = {r["setting"]: r["mean_ndcg"] for r in sweep_bm25f(j, spark, (five, zero)).collect()}
    for p in (five, zero):
        from fieldrank.operators.evaluate import mean_ndcg, rank_within
        want = mean_ndcg(ndcg_per_query(rank_within(j.bm25f(p), "score"))).first()["mean_ndcg"]
        assert got[p.name] == pytest.approx(want)
    assert got["five"] != got["zero"]


def test_idcg_equals_sorted_sum(spark):
    rel = [3.0, 0.0, 1.0, 1.0, -1.0, 2.0, 1.0]
    df = spark.createDataFrame([(1, r) for r in rel] + [(2, -1.0)], "query_id int, rel double")
    got = {r["query_id"]: r["idcg"] for r in idcg_per_query(df).collect()}
    want = sum((2 ** max(r, 0) - 1) / math.log2(k + 2) for k, r in enumerate(sorted(rel, reverse=True)))
    assert got[1] == pytest.approx(want) and got[2] == 0


def test_unjudged_rows_drop_or_raise(spark):
    r = spark.createDataFrame([("q", 1, "a"), ("q", 2, "b"), ("q", 3, "c")], "query string, rank int, url string")
    j = spark.createDataFrame([("q", "a", 1.0), ("q", "c", 2.0)], "query string, url string, rel double")
    got = sorted(tuple(x) for x in join_judgments(r, j, ["query", "url"], part=("query",)).select("url", "rank", "rel").collect())
    assert got == [("a", 1, 1.0), ("c", 2, 2.0)]
    with pytest.raises(KeyError):
        join_judgments(r, j, ["query", "url"], "error", ("query",))


FEATURES = "query: a b\n" + "".join(
    f"  url: p{i}\n    body_hits: a 4\n    body_length: 10\n" for i in range(8)) + """  url: ///
  url: q
    body_hits: a 1 5
    body_hits: other 2 3 4
query: c d
  url: z
    title: c
"""


def test_feature_records_keep_ties_pages_and_hits(spark, tmp_text):
    q, c = TF.features_to_collection(TF.read_feature_file(spark, tmp_text("f", FEATURES)))
    j = RankingJob(q, c, spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string"))
    for df in (j.baseline(), j.cosine(), j.bm25f(), j.cosine_window()):
        rows = [r for r in ranked(df).orderBy("query_id", "rank").collect() if r["query_id"] == "a b"]
        urls = [r["url"] for r in rows]
        assert sorted(urls) == sorted([f"p{i}" for i in range(8)] + ["///", "q"])
        assert [u for u in urls if u[0] == "p"] == [f"p{i}" for i in range(8)]  # equal scores in input order
    assert {r["url"]: r["score"] for r in j.baseline().collect()}["q"] == 5.0


def test_each_field_weight_matters(spark):
    got = {tuple(r[c] for c in ("w_url", "w_title", "w_header", "w_body", "w_anchor")): r["mean_ndcg"]
           for r in catalog.QUERIES["sweep_cosine_weights"](spark, "/root/testdata/sf0.01").collect()}
    assert len(set(got.values())) > len(got) // 2


def test_raw_and_lower_counts_differ(spark):
    t = catalog.pages_job(spark, SF, full_index=True).index.terms
    assert t.where("tf_title <> rtf_title").count() > 0


@pytest.mark.parametrize("name", ["rank_bm25f", "rank_cosine_window", "ndcg", "sweep_window_boost"])
def test_scoring_plans_without_a_job_and_nothing_stays_cached(spark, name):
    """All that a key scores is planned lazily; only its rank starts a job (it writes the
    scored rows, so that both passes read the same ones)."""
    sc = spark.sparkContext
    for t in ("pages", "documents", "benchmark", "labels"):
        T.table(spark, SF, t)  # schema jobs
    sc.setJobGroup(f"plan-{name}", "")
    job = (catalog.pages_job if name.startswith("rank") else catalog.docs_job)(spark, SF)
    {"rank_bm25f": job.bm25f, "rank_cosine_window": job.cosine_window, "ndcg": job.bm25f, "sweep_window_boost": job.cosine_with_windows}[name]()
    jobs = len(sc.statusTracker().getJobIdsForGroup(f"plan-{name}"))
    sc._jsc.clearJobGroup()
    assert jobs <= 5  # schema reads of the tables only
    catalog.QUERIES[name](spark, SF).collect()
    assert sc._jsc.getPersistentRDDs().size() == 0


def test_snapshot_is_loaded_if_present(spark, tmp_path):
    path, calls = str(tmp_path / "df"), []

    def compute():
        calls.append(1)
        return spark.createDataFrame([("a", 1)], "term string, df long")
    assert CO.load_or_compute(spark, path, compute).count() == 1
    assert CO.load_or_compute(spark, path, compute).count() == 1 and len(calls) == 1
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("damaged")
    with pytest.raises(Exception):
        CO.load_or_compute(spark, str(tmp_path / "bad"), compute).count()
    assert len(calls) == 1
