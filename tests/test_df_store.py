"""Document frequencies kept by deltas against full recounts."""

import random

import pytest
from pyspark.sql import functions as F

from fieldrank.operators.df_store import DocFreqStore, load_or_count
from fieldrank.operators.stats import corpus_size, doc_freq


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_any_history_equals_a_recount(spark, tmp_path):
    random.seed(9)
    make = lambda k: (k, " ".join(random.choices("abcdefgh", k=random.randrange(6))) or None)
    store, held = DocFreqStore(spark, str(tmp_path / "s")), []
    for step in range(4):
        new = [make(step * 10 + k) for k in range(6)]
        store.add(docs_of(spark, new))
        held += new
        gone = random.sample(held, 3)
        store.remove(docs_of(spark, gone))
        held = [r for r in held if r not in gone]
    held += [held[0], (None, "a b"), (None, "a b")]  # repeated rows count each
    store.add(docs_of(spark, [held[0], (None, "a b"), (None, "a b")]))
    docs = docs_of(spark, random.sample(held, len(held))).repartition(5)
    assert rows(store.table()) == rows(doc_freq(docs))
    assert rows(store.corpus_size()) == rows(corpus_size(docs))
    small = store.compact(str(tmp_path / "c"))
    assert rows(small.load(docs)) == rows(doc_freq(docs)) and small.manifest().count() == 1


def test_snapshot_is_reused_for_the_same_input_only(spark, tmp_path):
    store = DocFreqStore(spark, str(tmp_path / "s"))
    docs = docs_of(spark, [(1, "a b"), (2, "b"), (3, None)])
    store.add(docs)
    assert rows(store.load(docs)) == [("a", 1), ("b", 2)]
    for other in ([(1, "a b"), (2, "b")], [(1, "a b"), (2, "c"), (3, None)], [(1, "a b"), (4, "b"), (3, None)], [(1, "a b"), (2, "b"), (3, "")]):
        assert store.load(docs_of(spark, other)) is None
        assert rows(load_or_count(store, docs_of(spark, other))) == rows(doc_freq(docs_of(spark, other)))
    assert store.load(docs_of(spark, []).where("doc_id > 0")) is None


def test_unfinished_and_impossible_changes(spark, tmp_path):
    store = DocFreqStore(spark, str(tmp_path / "s"))
    store.add(docs_of(spark, [(1, "a")]))
    spark.createDataFrame([("broken", "a", 5)], "change string, term string, df long").write.mode("append").parquet(f"{tmp_path}/s/deltas")
    assert rows(store.table()) == [("a", 1)]  # a change without its manifest row isn't read
    store.remove(docs_of(spark, [(2, "zz")]))
    with pytest.raises(Exception, match="more documents removed"):
        store.table().collect()
    assert store.table().where(F.col("term") == "a").count() == 1
