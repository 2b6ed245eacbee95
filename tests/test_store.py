"""The stored index: same ranks as a fresh one, after any history of changes."""

import os

import pytest

from fieldrank.operators.store import IndexStore, ranked_pages
from fieldrank.plans.catalog import pages_job
from fieldrank.plans.rankers import ranked
from fieldrank.sources import tables as T
from test_scale import exchanged

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    return T.queries(spark, SF), T.pages_collection(spark, SF), T.corpus(spark, SF)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def files(path):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part")}


def test_history_equals_a_fresh_index(spark, inputs, tmp_path):
    queries, coll, corpus = inputs
    path = str(tmp_path / "s")
    store = IndexStore(spark, path, buckets=4)
    assert store.add(coll.where("page_id % 2 = 0").withColumn("body_length", T.F.lit(3))) == 1
    before = files(path)
    assert store.add(coll) == 2  # replaces the first half
    assert {f: t for f, t in files(path).items() if f in before} == before  # a change only appends
    want = rows(ranked(pages_job(spark, SF).bm25f()))
    assert rows(ranked_pages(store.job(queries, corpus).bm25f())) == want
    store.remove(coll.where("page_id % 5 = 1"))
    left = pages_job(spark, SF)
    c = coll.where("page_id % 5 <> 1")
    left = type(left)(queries, c, corpus, T.candidates(queries, c))
    want = rows(ranked(left.cosine()))
    assert want and rows(ranked_pages(store.job(queries, corpus).cosine())) == want
    again = IndexStore(spark, path, buckets=4)  # as another session opens it
    assert rows(ranked_pages(again.job(queries, corpus).cosine())) == want
    merged = again.merge(str(tmp_path / "m"))
    assert merged.collection().count() == c.count() == merged.index().pages.count()
    assert rows(ranked_pages(merged.job(queries, corpus).cosine())) == want
    assert merged.add(coll.where("page_id % 5 = 1")) == 3
    assert rows(ranked_pages(merged.job(queries, corpus).bm25f())) == rows(ranked(pages_job(spark, SF).bm25f()))


def test_ranker_reads_no_html_and_moves_no_index(spark, inputs, tmp_path):
    queries, coll, corpus = inputs
    store = IndexStore(spark, str(tmp_path / "s"), buckets=4)
    store.add(coll)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        matched = store.job(queries, corpus).matched
        plan = matched._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "pages.parquet" not in plan and "html#" not in plan
    assert not exchanged(matched) & {"body_tokens", "html", "_word"}
    lines = plan.split("\n")
    at = next(k for k, line in enumerate(lines) if "Scan parquet" in line and "_terms" in line)
    join = max(k for k in range(at) if "SortMergeJoin" in lines[k])
    assert not any("Exchange" in line for line in lines[join + 1:at])  # its bucketed index is joined where it lies


def test_unfinished_change_is_not_read(spark, inputs, tmp_path):
    queries, coll, corpus = inputs
    store = IndexStore(spark, str(tmp_path / "s"), buckets=4)
    store.add(coll.where("page_id < 20"))
    coll.withColumn("page", T.F.col("page_id")).withColumn("segment", T.F.lit(2)).withColumn("page_id", T.F.lit("7:2")) \
        .write.mode("append").parquet(f"{tmp_path}/s/coll")  # a change that failed before its log row
    assert store.collection().count() == 20
    assert store.add(coll.where("page_id = 30")) == 3 and store.collection().count() == 21
