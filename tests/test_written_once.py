"""What a ranking job reads several times is written once, and what nobody reads isn't made."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from fieldrank.operators.evaluate import ranking_completeness
from fieldrank.operators.index import build_index, kept_index, page_rows, page_rows_of_repeated
from fieldrank.operators.store import IndexStore
from fieldrank.plans import catalog
from fieldrank.plans.rankers import RankingJob

SF = "/root/testdata/sf0.001"


def exchanged(df):
    """The columns that the exchanges of a plan carry."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    parts = re.findall(r"\n\(\d+\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
    assert parts
    return {re.sub(r"#\d+L?", "", c.strip()) for p in parts for c in p.split(",")}


def plan(df):
    return df._jdf.queryExecution().toString()


def test_parsed_pages_are_not_parsed_again(spark):
    lazy = catalog.pages_job(spark, SF)
    job = catalog.parsed_once(lazy)
    assert "html" not in plan(job.bm25f()) and "html" in plan(lazy.bm25f())
    rows = lambda j: sorted(map(str, j.bm25f().select("query_id", "page_id", F.round("score", 9)).collect()))
    assert rows(job) == rows(lazy)


def test_average_lengths_need_no_terms(spark):
    job = catalog.parsed_once(catalog.pages_job(spark, SF))
    assert "tf_body" not in plan(job.avg_len) and "n_total" not in plan(job.avg_len)


def test_postings_of_records_hold_their_own_query_only(spark):
    coll = spark.createDataFrame([("p", "a b", "http://a.c", 0, "a c", ["b"], [("c a", 1)], {"a": [1, 2], "zz": [3]}, 9, 1)],
                                 "page_id string, query_id string, url string, url_pos int, title string, headers array<string>, "
                                 "anchors array<struct<text:string,cnt:int>>, body_hits map<string,array<int>>, body_length int, pagerank int")
    queries = spark.createDataFrame([("a b", "a b"), ("c", "c")], "query_id string, query string")
    index = RankingJob(queries, coll, spark.createDataFrame([(1, "a")], "doc_id long, text string")).index
    assert {r.term for r in index.postings.collect()} == {"a", "b"}
    assert {r.term for r in index.terms.collect()} == {"http", "a", "b", "c", "zz"}  # the norms count every term


def test_tokens_of_records_are_not_shuffled(spark):
    """A record is moved once and its tokens are counted there; its terms meet the statistics of query terms without an exchange."""
    job = catalog.records_job(spark, SF)
    index = build_index(job.collection, job.qterms.select("query_id", "term"))
    assert "term" not in exchanged(index.terms)
    matched = job.matched._sc._jvm.PythonSQLUtils.explainString(job.matched._jdf.queryExecution(), "simple")
    assert matched.count("Exchange") == matched.count("BroadcastExchange") > 0


def test_completeness_counts(spark):
    ranked = spark.createDataFrame([("q", 1), ("q", 1), ("q", 2), (None, 3)], "query_id string, page_id long")
    expected = spark.createDataFrame([("q", 1), ("q", 4), ("q", 4), (None, 3)], "query_id string, page_id long")
    got = ranking_completeness(ranked, expected)
    assert tuple(got.first()) == (3, 2, 1)  # a null key equals no other
    assert plan(got).count("Join") == 0
    assert tuple(ranking_completeness(ranked.limit(0), expected.limit(0)).first()) == (0, 0, 0)


COLLECTION = "page_id long, url string, title string, headers array<string>, anchors array<struct<text:string,cnt:int>>, " \
    "body_tokens array<string>, body_length int, pagerank int"
ODD_PAGES = [(1, "http://a.b/x_y", "Title a A", ["h a", "h A"], [("a A", 3), ("", None), ("a b", 0), (None, 2)], ["a", None, "a", "b"], None, None),
             (2, None, None, None, None, None, None, None), (3, "", "", [], [], [], 5, 2), (4, "c", "c", ["c"], [("c", 2)], ["c"] * 700, 700, 1)]


def test_kept_rows_equal_the_index(spark):
    coll = spark.createDataFrame(ODD_PAGES, COLLECTION)
    twice = coll.unionByName(coll.where("page_id = 1").withColumn("title", F.lit("b b"))).unionByName(coll.where("page_id = 4"))
    for pages, made in ((coll, page_rows), (coll, page_rows_of_repeated), (twice, page_rows_of_repeated), (coll.limit(0), page_rows)):
        want, kept = build_index(pages), made(pages)
        for part in ("pages", "terms", "postings"):
            w, g = getattr(want, part), getattr(kept_index(kept, 4), part)
            assert sorted(w.columns) == sorted(g.columns)
            assert sorted(map(str, w.collect())) == sorted(map(str, g.select(w.columns).collect()))


def test_store_keeps_a_row_per_page(spark, tmp_path):
    coll = spark.createDataFrame(ODD_PAGES, COLLECTION)
    assert "Exchange" not in plan(page_rows(coll)) and "Generate" not in plan(page_rows(coll))  # tokens are counted in their page
    store = IndexStore(spark, str(tmp_path / "s"), buckets=2)
    store.add(coll.unionByName(coll.where("page_id = 4")))  # an id that repeats
    assert spark.read.parquet(str(tmp_path / "s" / "terms")).count() == 5
    store.remove(coll.where("page_id = 2"))
    merged = store.merge(str(tmp_path / "m"))
    assert merged.index().by_page.count() == 4 and {r.page_id for r in merged.index().terms.collect()} == {"1:1", "4:1"}


def test_compared_rankers_match_once(spark):
    job = catalog.matched_once(catalog.parsed_once(catalog.docs_job(spark, SF)))
    for scored in (job.cosine(), job.bm25f()):
        assert "n_total" not in plan(scored)  # documents are counted and pairs matched by then
