"""Plans and results that must hold when one query, page or block is very large."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from fieldrank.operators.evaluate import DISCOUNT_BLOCK, idcg_per_query, join_judgments, rank_within
from fieldrank.sources import tables as T

SF = "/root/testdata/sf0.001"

def exchanged(df):
    """The columns that the exchanges of a plan carry."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    parts = re.findall(r"\n\(\d+\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
    assert parts
    return {re.sub(r"#\d+L?", "", c.strip()) for p in parts for c in p.split(",")}

def test_hot_query_is_ranked_by_several_tasks(spark):
    """One query holds most rows, half of them with one score; ranks equal a plain sort."""
    random.seed(1)
    rows = [("hot" if k % 3 else f"q{k % 7}", k, float(random.choice([1.0, random.random()])), f"u{k}") for k in range(6000)] + [(None, 1, None, "x"), (None, 2, 0.5, "y")]
    df = spark.createDataFrame(rows, "query_id string, page_id long, score double, url string")
    ranked = rank_within(df)
    want, groups = {}, {}
    for q, p, s, _ in rows:
        groups.setdefault(q, []).append((s is None, -round(s or 0.0, 9), p))
    for q, g in groups.items():
        for r, (_, _, p) in enumerate(sorted(g), 1):
            want[q, p] = r
    assert {(r.query_id, r.page_id): r["rank"] for r in ranked.collect()} == want and ranked.columns == [*df.columns, "rank"]
    parts = df.repartitionByRange(8, "query_id", F.col("score").desc(), "page_id").where("query_id = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert parts > 3  # the same partitioning as the rank's: the hot query lies in several partitions

def test_rank_of_nothing(spark):
    df = spark.createDataFrame([], "query_id string, page_id long, score double")
    assert rank_within(df).collect() == []

def test_judged_ranks_count_judged_rows_only(spark):
    r = spark.createDataFrame([("q", k, f"u{k}") for k in range(1, 400)], "query string, rank int, url string")
    j = spark.createDataFrame([("q", f"u{k}", 1.0) for k in range(2, 400, 3)], "query string, url string, rel double")
    got = sorted(tuple(x) for x in join_judgments(r, j, ["query", "url"], part=("query",)).select("rank", "url").collect())
    assert got == [(n, f"u{k}") for n, k in enumerate(range(2, 400, 3), 1)]

def test_ideal_gain_of_very_many_pages(spark):
    """The ideal gain of more pages of one relevance than a block of discounts holds."""
    n = 3 * DISCOUNT_BLOCK + 17
    df = spark.range(n).select(F.lit(1).alias("query_id"), F.when(F.col("id") < 5, 2.0).otherwise(1.0).alias("rel"))
    got = idcg_per_query(df).first()["idcg"]
    assert got == pytest.approx(sum((3 if k <= 5 else 1) / math.log2(k + 1) for k in range(1, n + 1)))
    text = idcg_per_query(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "_upto_sum" in text

def test_candidates_exchange_hits_only(spark):
    q, c = T.queries(spark, SF), T.pages_collection(spark, SF)
    for setting in ("-1", "10485760"):  # with and without broadcasts of the query side
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)
        try:
            columns = exchanged(T.candidates(q, c))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

        assert not columns & {"body_tokens", "html", "_word", "at"}

def test_bitmap_passes_all_hits_and_few_others(spark):
    runs = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    bits = T.bitmap(runs).scalar()
    probed = spark.range(200_000).select("id", T.in_bitmap(F.xxhash64("id"), bits).alias("hit"))
    assert probed.where("id < 20000 AND NOT hit").count() == 0
    assert probed.where("id >= 20000 AND hit").count() < 180_000 * 0.01

def test_candidates_equal_all_pairs_by_brute_force(spark):
    q = spark.createDataFrame([("a", "x"), ("b", "x y"), ("c", "x y z"), ("d", "p q r s"), ("e", "p q r s t u"), ("f", "x x x x x"), ("g", "no where")], "query_id string, query string")
    random.seed(4)
    pages = [(k, [random.choice("xyzpqrstu") for _ in range(random.choice([0, 1, 3, 60]))]) for k in range(60)] + [(99, ["x"] * 4), (100, None)]
    c = spark.createDataFrame(pages, "page_id long, body_tokens array<string>")

    def runs(w, n):
        return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
    want = {(i, p) for i, text in [tuple(r) for r in q.collect()] for p, w in pages
            if runs(text.split(), min(4, len(text.split()))) & runs(w or [], min(4, len(text.split())))}
    assert {tuple(r) for r in T.candidates(q, c).collect()} == want
    assert T.candidates(q.where("query_id = 'none'"), c).collect() == []
