"""The corpus writer and scanner (S2): one file per document, whatever the names."""

from __future__ import annotations

import pytest

from fieldrank.operators.stats import doc_freq
from fieldrank.sources.corpus import scan_corpus, write_corpus

ROWS = [("a", 1, "x y"), ("a", 2, "x"), ("a", 2, "z x"), ("b", 2, "x\n\nw"), (None, 3, "n"), ("", 3, "n m"), ("b", None, None),
        ("c/d %", 4, "é")] + [("big", n, f"t{n % 3}") for n in range(100, 140)]


@pytest.fixture(params=["file", "viewfs"])
def root(request, spark, tmp_path):
    if request.param == "file":
        return str(tmp_path / "corpus")
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{tmp_path.name}.link./in", f"file://{tmp_path}")
    return f"viewfs://{tmp_path.name}/in/corpus"


def test_one_file_per_document_in_few_directories(spark, root, tmp_path, monkeypatch):
    monkeypatch.setattr("fieldrank.sources.corpus.TASK_FILES", 7)
    write_corpus(spark.createDataFrame(ROWS, "source string, doc_id long, text string"), root)
    folders = {p.parent for p in (tmp_path / "corpus").rglob("*.txt")}
    assert len(folders) == 5  # a directory per source, none per document
    got = [(r.path, sorted(r.text.split())) for r in scan_corpus(spark, root).collect()]
    assert len({p for p, _ in got}) == len(got) == 46
    want = [["x", "y"], ["x", "x", "z"], ["w", "x"], ["m", "n", "n"], [], ["é"], *[[f"t{n % 3}"] for n in range(100, 140)]]
    assert sorted(t for _, t in got) == sorted(want)
    df = {r.term: r.df for r in doc_freq(scan_corpus(spark, root)).collect()}
    assert df["x"] == 3 and df["n"] == 1 and df["t0"] == 13


def test_modes(spark, root):
    first = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x")], "source string, doc_id long, text string")
    second = spark.createDataFrame([("a", 2, "y")], "source string, doc_id long, text string")
    texts = lambda: sorted(r.text for r in scan_corpus(spark, root).collect())
    write_corpus(first, root)
    write_corpus(second, root, mode="append")
    assert texts() == ["x\n", "x\n", "y\n"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_corpus(first, root, mode="error")
    write_corpus(second, root)
    assert texts() == ["y\n"]


def test_long_names(spark, tmp_path):
    rows = [("s" * 300, "d" * 300 + str(n), f"t{n}") for n in range(2)]
    write_corpus(spark.createDataFrame(rows, "source string, doc_id string, text string"), str(tmp_path / "c"))
    assert sorted(r.text for r in scan_corpus(spark, str(tmp_path / "c")).collect()) == ["t0\n", "t1\n"]
