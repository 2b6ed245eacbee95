"""Reader/writer rules for the indented key: value formats (synthetic inputs)."""

from pyspark.sql import functions as F

from fieldrank.plans import catalog
from fieldrank.sources import textfmt as TF

AC = TF.ANCHOR_COUNT_KEY

FEATURES = f"""query: q one
  url: http://a.org/x:1
    title: first
    title: second
    header: h1
    header: h2
    body_hits: t 1 2
    body_hits: t 5
    body_hits: u 3
    junk line without colon
    unknown_key: ignored
    body_length: 10
    pagerank: 3
    anchor_text: click here
      {AC}: 2
    anchor_text: click here
      {AC}: 7
    anchor_text: other
      {AC}: 1
  url: http://b.org
query: q two
  url: http://c.org
    body_length: 4
query: q one
  url: http://z.org
"""


def test_feature_reader_rules(spark, tmp_text):
    df = TF.read_feature_file(spark, tmp_text("f", FEATURES))
    rows = {(r["query"], r["url"]): r for r in df.collect()}
    assert len(rows) == 4
    a = rows[("q one", "http://a.org/x:1")]
    assert a["url_pos"] == 0 and a["title"] == "second"
    assert a["headers"] == ["h1", "h2"]
    assert a["body_hits"] == {"t": [5], "u": [3]}          # repeated term: last wins
    assert a["body_length"] == 10 and a["pagerank"] == 3
    assert a["anchors"] == {"click here": 7, "other": 1}   # repeated anchor text: last wins
    b = rows[("q one", "http://b.org")]
    assert b["url_pos"] == 1 and b["title"] is None and b["body_hits"] == {} and b["anchors"] == {}


def test_last_block_wins(spark, tmp_text):
    df = TF.last_block_wins(TF.read_feature_file(spark, tmp_text("f", FEATURES)))
    got = sorted((r["query"], r["url"]) for r in df.collect())
    assert got == [("q one", "http://z.org"), ("q two", "http://c.org")]


def test_judgments_reader(spark, tmp_text):
    txt = "query: q\n  url: http://a.org/p q 1.5\n  url: http://b.org -1\nquery: r\n  url: http://c.org 0\n"
    got = sorted(tuple(r) for r in TF.read_judgments(spark, tmp_text("j", txt)).collect())
    assert got == [("q", "http://a.org/p q", 1.5), ("q", "http://b.org", -1.0), ("r", "http://c.org", 0.0)]


def test_ranking_write_read_roundtrip(spark, tmp_path):
    rows = [(1, "q a", 1, "http://x"), (1, "q a", 2, "http://y"), (2, "q b", 1, "http://z")]
    df = spark.createDataFrame(rows, "query_id long, query string, rank int, url string")
    path = str(tmp_path / "ranked")
    TF.write_ranking(df, path)
    got = sorted(tuple(r) for r in TF.read_ranking(spark, path).collect())
    assert got == [("q a", 1, "http://x"), ("q a", 2, "http://y"), ("q b", 1, "http://z")]


def test_feature_write_read_roundtrip(spark, tmp_text, tmp_path):
    src = TF.read_feature_file(spark, tmp_text("f", FEATURES)).drop("file", "block")
    path = str(tmp_path / "feat")
    TF.write_feature_file(TF.last_block_wins(TF.read_feature_file(spark, tmp_text("g", FEATURES))).drop("file", "block"), path)
    back = TF.read_feature_file(spark, path).drop("file", "block")
    cols = ["query", "url", "title", "headers", "body_hits", "body_length", "pagerank", "anchors"]
    norm = lambda d: sorted((tuple(str(r[c]) for c in cols) for r in d.collect()))
    assert norm(back) == norm(TF.last_block_wins(TF.read_feature_file(spark, tmp_text("h", FEATURES))).drop("file", "block"))
    assert src.count() == 4


def test_features_to_collection_dedupes(spark, tmp_text):
    q, c = TF.features_to_collection(TF.read_feature_file(spark, tmp_text("f", FEATURES)))
    assert sorted(r["query"] for r in q.collect()) == ["q one", "q two"]
    assert sorted(r["url"] for r in c.collect()) == ["http://c.org", "http://z.org"]


def _records(df):
    cols = ["query", "url", "url_pos", "title", "headers", "body_hits", "body_length", "pagerank", "anchors"]
    return sorted(tuple(str(r[c]) for c in cols) for r in df.collect())


def _in_splits(spark, size, read):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = read()
        return df.collect() if not isinstance(df, list) else df
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_block_over_many_splits(spark, tmp_text):
    """A file that is one query's block, cut anywhere: inside records, at any line."""
    text = "query: only one\n" + "".join(
        f"  url: http://p{i}.org/a:{i}\n    title: t {i}\n    header: h{i}\n    header: g{i}\n    body_hits: only {i} {i + 5}\n"
        f"    body_length: {i}\n    anchor_text: a{i}\n      {AC}: {i}\n" for i in range(40))
    path = tmp_text("one", text)
    whole = _records(TF.read_feature_file(spark, path))
    assert len(whole) == 40 and whole[0][0] == "only one"
    for size in (len(text) // 8, 90, 37):
        rows = _in_splits(spark, size, lambda: TF._lines(spark, path).select("stream", "part", "split").distinct())
        assert len(rows) >= (8 if size > 90 else 30)
        assert _in_splits(spark, size, lambda: _records(TF.read_feature_file(spark, path))) == whole
        got = _in_splits(spark, size, lambda: TF.read_ranking(spark, path))
        assert sorted((r["rank"], r["url"]) for r in got) == [(i + 1, f"http://p{i}.org/a:{i}") for i in range(40)]


def test_blocks_records_and_odd_lines_over_splits(spark, tmp_text):
    text = "  url: before any query\nno colon here\n" + FEATURES + "query:\n  url: of a query without text\n  query: indented\n\n  url: u v\n    title: x: y\n"
    path = tmp_text("odd", text)
    whole = _records(TF.read_feature_file(spark, path))
    assert [r[:3] for r in whole if r[0] == "indented"] == [("indented", "u v", "0")] and len(whole) == 5
    for size in (20, 61, 150):
        assert _in_splits(spark, size, lambda: _records(TF.read_feature_file(spark, path))) == whole


def test_one_query_in_several_files_is_read_back_in_order(spark, tmp_path):
    rows = [("q1", "hot query", k, f"http://u{k}") for k in range(1, 501)] + [("q0", "cold", 1, "http://c"), ("q2", "last", 1, "http://l")]
    df = spark.createDataFrame(rows, "query_id string, query string, rank int, url string")
    path = str(tmp_path / "hot")
    TF.write_ranking(df, path, file_lines=60)
    files = TF.manifest(spark, path).orderBy("file").collect()
    assert len(files) >= 9 and max(f["lines"] for f in files) <= 60
    assert [f["first_line"] for f in files] == [sum(g["lines"] for g in files[:k]) for k in range(len(files))]
    assert sorted((r["query"], r["rank"], r["url"]) for r in TF.read_ranking(spark, path).collect()) == sorted((q, k, u) for _, q, k, u in rows)


def test_files_without_manifest_are_read_each_for_itself(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a").write_text("query: a\n  url: u1\n")
    (tmp_path / "d" / "b").write_text("  url: of nothing\nquery: b\n  url: u2\n  url: u3\n")
    got = sorted(tuple(r) for r in TF.read_ranking(spark, str(tmp_path / "d")).collect())
    assert got == [("a", 1, "u1"), ("b", 1, "u2"), ("b", 2, "u3")]


def test_many_anchors_and_repeated_counts(spark, tmp_text):
    body = f"      {AC}: 9\n    anchor_text: x\n      {AC}: 1\n      {AC}: 2\n    anchor_text: none\n    anchor_text: x\n      {AC}: 5\n    anchor_text: y\n      {AC}: 3\n"
    (r,) = TF.read_feature_file(spark, tmp_text("a", "query: q\n  url: u\n" + body)).collect()
    assert r["anchors"] == {"x": 5, "y": 3}


def test_lines_are_gathered_where_they_are_read(spark, tmp_text):
    """A row per query, record and split start, not one per line; what is read is not sorted by lines again."""
    path = tmp_text("f", "title: before any query\n" + FEATURES)
    assert [(r["k"], r["v"], len(r["lines"])) for r in TF._lines(spark, path).orderBy("n").collect()] == [
        (None, None, 1), ("query", "q one", 0), ("url", "http://a.org/x:1", 15), ("url", "http://b.org", 0),
        ("query", "q two", 0), ("url", "http://c.org", 1), ("query", "q one", 0), ("url", "http://z.org", 0)]
    for df in (TF.read_ranking(spark, path), TF.read_judgments(spark, path), TF.features_to_collection(TF.read_feature_file(spark, path))[1]):
        assert "Window" not in df._jdf.queryExecution().toString()


def test_records_over_batches(spark, tmp_text):
    path = tmp_text("odd", "  url: before any query\n" + FEATURES + "query:\n  url: of a query without text\nquery: last\n  url: u\n")
    whole = _records(TF.read_feature_file(spark, path))
    assert [r[:3] for r in whole if r[0] == "last"] == [("last", "u", "0")] and len(whole) == 5
    for rows in (1, 2, 3, 7):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        try:
            assert _records(TF.read_feature_file(spark, path)) == whole
            assert _in_splits(spark, 150, lambda: _records(TF.read_feature_file(spark, path))) == whole
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_records_of_one_place_take_turns(spark, tmp_path):
    """Lines of two records with one place are sorted by their place in the record; the others stay whole."""
    rows = [("q", "u1", 0, "t", ["h"], {"b": [1], "a": [2, 3]}, 5, 6, {"x": 1}), ("q", "u2", 1, "t", [], None, None, None, None),
            ("q", "u2", 1, "t", [], None, None, None, None)]
    df = spark.createDataFrame(rows, "query string, url string, url_pos int, title string, headers array<string>, body_hits map<string,array<int>>, "
                                     "body_length int, pagerank int, anchors map<string,int>")
    path = str(tmp_path / "f")
    TF.write_feature_file(df, path)
    names = sorted(r["file"] for r in TF.manifest(spark, path).collect())
    text = "".join((tmp_path / "f" / n).read_text() for n in names)
    assert [x.strip() for x in text.splitlines()] == [
        "query: q", "url: u1", "title: t", "header: h", "body_hits: a 2 3", "body_hits: b 1", "body_length: 5", "pagerank: 6", "anchor_text: x",
        f"{AC}: 1", "url: u2", "url: u2", "title: t", "title: t"]


def test_positions_of_query_terms(spark):
    rows = [(7, ["a", "b", "a", None, "zz"]), (8, ["zz"]), (9, None), (10, []), (11, ["b"])]
    coll = spark.createDataFrame(rows, "_row long, body_tokens array<string>")
    queries = spark.createDataFrame([("1", "a b"), ("2", "b c"), ("3", "")], "query_id string, query string")
    got = {r["_row"]: r["_positions"] for r in catalog.term_positions(coll, queries).collect()}
    assert got == {7: {"a": [1, 3], "b": [2]}, 11: {"b": [1]}}
