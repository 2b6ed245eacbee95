import collections

import pytest

import corpus_pipeline as C
from fieldrank.llm import cuckoo
from fieldrank.llm.common import table, written

from test_bagminhash import brute_classes
from test_mixing import brute as brute_mix

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Output rows of each stage, each run on what the one before wrote."""
    docs, out = table(spark, SF, "documents"), {"input": table(spark, SF, "documents").collect()}
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, SF), name)
        out[name] = docs.collect()
        out[name + ".columns"] = docs.columns
    return out


def test_stages_keep_columns_and_order(spark, stages):
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "exact_dedup", "minhash_near_dedup", "mix_sources", "best_fit_packing"]
    columns = table(spark, SF, "documents").columns
    for name, _ in C.STAGES[:-1]:
        assert stages[name + ".columns"] == columns


def test_quality_stage_keeps_good(spark, stages):
    kept = {r["doc_id"] for r in stages["quality_classifier"]}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    good, bad = [i for i in labels if labels[i] == 1], [i for i in labels if labels[i] == 0]
    assert sum(i in kept for i in good) / len(good) > 0.95 and sum(i in kept for i in bad) / len(bad) < 0.3


def test_exact_and_near_stages_equal_brute_force(stages):
    low = lambda t: (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    keep = {}
    for r in stages["quality_classifier"]:
        keep[low(r["text"])] = max(r["doc_id"], keep.get(low(r["text"]), -1))
    assert sorted(keep.values()) == sorted(r["doc_id"] for r in stages["exact_dedup"])
    rows = [(r["doc_id"], r["text"]) for r in stages["exact_dedup"]]
    assert sorted(set(brute_classes(rows))) == sorted(r["doc_id"] for r in stages["minhash_near_dedup"])


def test_mix_and_packing_use_every_row(stages):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in stages["minhash_near_dedup"]]
    times = {i: n for i, _, _, _, n in brute_mix(rows) if n}
    assert collections.Counter(r["doc_id"] for r in stages["mix_sources"]) == times
    first = collections.Counter(r["doc_id"] for r in stages["best_fit_packing"] if r["piece"] == 0)
    assert first == times


def test_run_returns_the_last_stage(spark, stages):
    got = C.run(spark, SF)
    assert got.columns == stages["best_fit_packing.columns"]
    assert got.count() == len(stages["best_fit_packing"])


def test_all_stages_take_empty_tables(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_stage_takes_null_ids_and_texts(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "a b", "en", None, 3), (1, "a b", "en", None, 3)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert cuckoo.distinct(docs).count() == 2
    assert C.near_dedup(spark, docs, SF).count() == 2
    assert C.mix_sources(spark, docs, SF).columns == docs.columns
