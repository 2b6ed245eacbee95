import hashlib

import pytest

from fieldrank.llm import warc as W

INNER = W.MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
ROWS = [(1, "u", "a" * 1500), (2, None, "a" * 1500), (3, "u\r\nv", "x" + INNER + INNER + "y" * 30), (4, "u", None), (5, "u", ""),
        (6, "u", ("é" + INNER + "\r\n\r\n") * 40), (7, "u", ("é" + INNER + "\r\n\r\n") * 40), (8, "u", W.MAGIC), (9, "u", "short"),
        (10, "u", "short"), (None, "u", "a" * 1500), (11, "u", INNER * 300), (2, None, "a" * 1500), (12, "u", "z" * 1000), (13, "u", "z" * 1000)]


def expected(rows):
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        keep = max((j for j, _, g in rows if (g or "") == (h or "") and j is not None), default=None)
        revisit = len(b) >= 1000 and keep is not None and keep != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", keep if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", ["3000", "134217728"])
def test_round_trip_with_magic_in_payloads(spark, tmp_path, split):
    """Small splits put block borders inside records, headers and magics."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        pages = spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, digest string")
        W.write_archives(pages.coalesce(2), str(tmp_path / "w"))
        got = [tuple(r) for r in W.read_archives(spark, str(tmp_path / "w")).collect()]
        assert sorted(got, key=str) == expected(ROWS)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("first,second", [("2500", "134217728"), ("134217728", "1700"), ("2500", "3300")])
def test_splits_may_change_between_the_reads(spark, tmp_path, monkeypatch, first, second):
    """The second read and the action see other splits than the first read, as when executors
    come or go: no record is lost."""
    rows = [(k, "u", f"{k}" + INNER * (k % 7) + "y" * 50 * k) for k in range(60)]
    W.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(3), str(tmp_path / "w"))
    split, sizes = W._split, [first, second]

    def other(spark, path):
        spark.conf.set("spark.sql.files.maxPartitionBytes", sizes.pop(0) if sizes else second)
        return split(spark, path)
    monkeypatch.setattr(W, "_split", other)
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        found = W.read_archives(spark, str(tmp_path / "w"))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
        assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_long_payload(spark, tmp_path):
    rows = [(1, "u", "word " * 400_000 + INNER), (2, "u", "after")]
    W.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
    assert sorted((tuple(r) for r in W.read_archives(spark, str(tmp_path / "w")).collect()), key=str) == expected(rows)


def test_empty(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    W.write_archives(pages, str(tmp_path / "w"))
    assert W.read_archives(spark, str(tmp_path / "w")).count() == 0
