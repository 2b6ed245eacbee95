"""Readers and writers for the reference's indented ``key: value`` text formats.

Reading: the lines of a split are gathered by the task that reads them, a row per record, so
that a query's block may be of any size and no value ever holds one. The rows are written once, with the
file, the split, the place in it and what is open there; over the splits (one row each) a prefix scan
hands on what was open at the end of the splits before. So a block is read by as many tasks as it
has splits, and all that is joined later sees the same numbering. Only the lines of one record (one page)
meet in a row, and only records that a split's end cuts are shuffled. Rules:

* key = text before the first colon, value = the rest, both trimmed (URLs keep colons);
* unknown keys and lines without a colon are ignored, and so is what stands before the first query;
* ``query`` starts a block, ``url`` a record; later ``title``/``body_length``/``pagerank`` lines
  of the same record override earlier ones; ``header`` lines accumulate in order;
* ``body_hits: term p1 p2 ...`` — a repeated term keeps its last list;
* the anchor count line (``ANCHOR_COUNT_KEY``) belongs to the nearest preceding ``anchor_text``; a repeated
  anchor text keeps its last count.

Repeated ``query:`` blocks and repeated urls are kept as separate rows (``url_pos`` and
``block`` record the order); ``last_block_wins`` applies the reference's dictionary
semantics (the last block of a query text replaces earlier ones).

Writing: rows are range-partitioned and sorted by (query, place), lines are made of them after that, so that a
query's lines may fill several files; a file holds at most ``FILE_LINES`` lines. Beside them
lies a manifest (``ORDER``: file, first line, number of lines), by which the readers go through the
files as one text. Files without a manifest are read each for itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldrank.sources.corpus import scratch_path, snapshot

# ---------------------------------------------------------------------------
# Key names of the feature-file format (must match the input files).
#   query, url, title, header, body_hits, body_length, pagerank, anchor_text,
#   and the anchor count key below
# ---------------------------------------------------------------------------
ANCHOR_COUNT_KEY = "stanford_anchor_count"

KEYS = ("query", "url", "title", "header", "body_hits", "body_length", "pagerank", "anchor_text", ANCHOR_COUNT_KEY)
SPACE = " \t\r"
#: Lines of a written file, and the folder of its manifest.
FILE_LINES, ORDER = 5_000_000, "_order"


def manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """(file, first_line, lines) of the files that ``_write_lines`` left below ``path``; None
    where there is no manifest."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{ORDER}")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.parquet(f"{path}/{ORDER}")


#: A piece of a split: an opening line (``k``: query or url, ``v``) with the lines after it up to the next one. What
#: stands before the first opening line of a split is a piece without ``k``. ``q`` and ``u`` count the
#: query and url lines of the split so far, ``text`` and ``u0`` are its open query and ``u`` at its line.
PIECE = "name string, split long, n long, k string, v string, q long, u long, text string, u0 long, last boolean, lines array<struct<k:string,v:string>>"


def _pieces():
    """Gathers the lines (name, split, value) of known keys in a task, which reads its splits in order, to ``PIECE``
    rows. Held back from batch to batch are the lines of the open piece; of the library, tasks need no more than this."""
    names = [c.split()[0] for c in PIECE.split(", ")]

    def known(batch):
        """(name, split, k, v) of the lines with a known key."""
        value = batch.column("value").cast(pa.string())
        key = pc.ascii_trim(pc.replace_substring_regex(value, pattern="(?s):.*", replacement=""), characters=SPACE)
        kept = pc.fill_null(pc.and_(pc.match_substring(value, ":"), pc.is_in(key, value_set=pa.array(KEYS))), False)
        value = pc.replace_substring_regex(value.filter(kept), pattern="(?s)^[^:]*:", replacement="")
        columns = [batch.column("name").cast(pa.string()).filter(kept), batch.column("split").filter(kept), key.filter(kept), pc.ascii_trim(value, characters=SPACE)]
        return pa.Table.from_arrays(columns, ["name", "split", "k", "v"])

    def gathered(rows, before, end):
        """The pieces of ``rows`` whose end is known, the rows of the open one and the counts before it."""
        name, split, k, v = (rows.column(c).combine_chunks() for c in ("name", "split", "k", "v"))
        at_split, code = np.asarray(split), np.asarray(name.dictionary_encode().indices)
        new = np.ones(len(code), bool)
        new[1:] = (at_split[1:] != at_split[:-1]) | (code[1:] != code[:-1])
        new[0] = before["at"] != (name[0].as_py(), split[0].as_py())
        is_query, is_url = (np.asarray(pc.equal(k, x)) for x in ("query", "url"))
        opening = is_query | is_url
        at = np.flatnonzero(new | opening)
        size = len(at)
        first, query, url = new[at], is_query[at], is_url[at]
        here = np.arange(size)
        start = np.maximum.accumulate(np.where(first, here, -1))  # the split's first piece, -1: in a batch before
        base = lambda x: np.where(start < 0, x, 0)

        def count(marks, x):
            upto = np.append(0, np.cumsum(marks))
            return upto[1:] - upto[np.maximum(start, 0)] + base(x)
        q, u, n = count(query, before["q"]), count(url, before["u"]), here - np.maximum(start, 0) + base(before["n"])
        opened = np.maximum.accumulate(np.where(query, here, -1))
        held = (opened < 0) | (opened < start)  # no query line of this split in these rows
        values = v.take(pa.array(at))
        none = held & ((start >= 0) | (before["text"] is None))
        text = pa.concat_arrays([values, pa.array([before["text"]], pa.string())]).take(pa.array(np.where(held, size, opened), mask=none))
        u0 = np.where(held, before["u0"], u[np.maximum(opened, 0)])
        of = np.cumsum(new | opening) - 1
        inside = ~opening & ~query[of]  # lines between a query and its first url belong to no record
        lines = pa.StructArray.from_arrays([k.filter(pa.array(inside)), v.filter(pa.array(inside))], ["k", "v"])
        offsets = np.append(0, np.cumsum(np.bincount(of[inside], minlength=size)))
        lines = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lines)
        opens = pa.array(query | url)
        none_open = pa.scalar(None, pa.string())
        row = pa.array(at)
        out = [name.take(row), split.take(row), pa.array(n), pc.if_else(opens, k.take(row), none_open), pc.if_else(opens, values, none_open),
               pa.array(q), pa.array(u), text, pa.array(u0, mask=none), pa.array(np.append(first[1:], True)), lines]
        out = pa.RecordBatch.from_arrays(out, names)
        if end:
            return out, None, None
        k = size - 1  # the open piece, counted again with the next rows
        if k == 0:
            return None, rows, before
        after = {"at": (name[int(at[k - 1])].as_py(), split[int(at[k - 1])].as_py()), "q": q[k - 1], "u": u[k - 1], "n": n[k - 1] + 1,
                 "text": text[k - 1].as_py(), "u0": 0 if none[k - 1] else u0[k - 1]}
        return out.slice(0, k), rows.slice(int(at[k])), after

    def pieces(batches):
        rest, before = None, {"at": None, "q": 0, "u": 0, "n": 0, "text": None, "u0": 0}
        for batch in batches:
            rows = known(batch)
            if rows.num_rows:
                out, rest, before = gathered(rows if rest is None else pa.concat_tables([rest, rows]), before, False)
                if out is not None:
                    yield out
        if rest is not None:
            yield gathered(rest, before, True)[0]
    return pieces


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(stream, part, split, ...): the lines of known keys as ``PIECE`` rows, written once. ``stream`` is read as one
    text, in the order of part (the file), split and ``n``. Nothing is shuffled: a task gathers what it reads."""
    order = manifest(spark, path)
    name = F.col("_metadata.file_path" if order is None else "_metadata.file_name")
    raw = spark.read.text(path).select(name.alias("name"), F.col("_metadata.file_block_start").alias("split"), "value")
    pieces = raw.mapInArrow(_pieces(), PIECE)
    if order is None:
        pieces = pieces.withColumn("stream", F.col("name")).withColumn("part", F.lit(0).cast("long"))
    else:
        files = order.select(F.col("file").alias("name"), F.col("first_line").alias("part"))
        pieces = pieces.join(files, "name").withColumn("stream", F.lit(path))
    return snapshot(pieces.drop("name"), scratch_path(spark, "lines"))


def _filled(spark: SparkSession, path: str) -> DataFrame:
    """``_lines`` with what is open at each piece: ``query`` (its text), ``block`` (number of the query
    line in the stream) and ``url_pos`` (-1 before the block's first url). Pieces outside a block or in
    one without a text are left out."""
    lines = _lines(spark, path)
    split = ["stream", "part", "split"]
    upto = Window.partitionBy("stream").orderBy("part", "split")  # one row per split
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    ends = lines.where("last").select(*split, "q", "u", "text", "u0") \
        .withColumn("_before", F.coalesce(F.sum("u").over(before), F.lit(0)))
    carried = ends.select(
        *split, F.coalesce(F.sum("q").over(before), F.lit(0)).alias("_q0"), "_before", F.last("text", ignorenulls=True).over(before).alias("_text0"),
        F.last(F.when(F.col("q") > 0, F.col("_before") + F.col("u0")), ignorenulls=True).over(before).alias("_start0"))
    at = lines.join(snapshot(carried, scratch_path(spark, "splits")), split)
    start = F.coalesce(F.col("u0") + F.col("_before"), F.col("_start0"))  # urls of the stream before the open query
    return at.select(*split, "n", "k", "v", "last", "lines", F.coalesce("text", "_text0").alias("query"), (F.col("_q0") + F.col("q")).alias("block"),
                     (F.col("_before") + F.col("u") - start - 1).cast("int").alias("url_pos")).where(F.length("query") > 0)


def _last_value(lines: Column, key: str) -> Column:
    return F.try_element_at(F.filter(lines, lambda x: x["k"] == key), F.lit(-1))["v"]


def _let(value: Column, body) -> Column:
    """``body(value)`` with the array ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _dedupe_last(arr: Column, key: str) -> Column:
    """Keep the last entry for every ``key`` value (dictionary assignment semantics): entries
    sorted by (key, place), of equal keys the last."""
    placed = F.sort_array(F.transform(arr, lambda e, i: F.struct(e[key].alias("key"), i.alias("i"), e.alias("e"))))
    return F.transform(_let(placed, lambda s: F.filter(s, lambda x, i: F.coalesce(F.get(s, i + 1)["key"] != x["key"], F.lit(True)))), lambda x: x["e"])


def _anchors(lines: Column) -> Column:
    """(text, cnt) of the anchor texts that a count follows before the next text: the last one."""
    known = F.filter(lines, lambda x: x["k"].isin("anchor_text", ANCHOR_COUNT_KEY))

    def pairs(known: Column) -> Column:
        texts = F.filter(F.transform(known, lambda x, i: F.when(x["k"] == "anchor_text", i)), lambda i: i.isNotNull())
        return _let(texts, lambda texts: F.transform(texts, lambda i, m: F.struct(
            F.get(known, i)["v"].alias("text"), F.get(known, F.coalesce(F.get(texts, m + 1), F.size(known)) - 1).alias("last"))))
    found = F.filter(_let(known, pairs), lambda a: a["last"]["k"] == ANCHOR_COUNT_KEY)
    return F.transform(found, lambda a: F.struct(a["text"].alias("text"), a["last"]["v"].cast("int").alias("cnt")))


def read_feature_file(spark: SparkSession, path: str) -> DataFrame:
    """(query, url, url_pos, title, headers, body_hits, body_length, pagerank, anchors,
    file, block)."""
    pieces = _filled(spark, path).where("url_pos >= 0").withColumnRenamed("stream", "file")
    is_url = F.coalesce(F.col("k") == "url", F.lit(False))
    whole = is_url & ~F.col("last")  # the next record or query begins in the same split
    cut = pieces.where(~whole).groupBy("file", "block", "url_pos").agg(  # at most two pieces of a split
        F.max(F.when(is_url, F.col("query"))).alias("query"), F.max(F.when(is_url, F.col("v"))).alias("url"),
        F.flatten(F.sort_array(F.collect_list(F.struct("part", "split", "n", "lines")))["lines"]).alias("lines"))  # one page's lines
    r = pieces.where(whole).select("file", "block", "url_pos", "query", F.col("v").alias("url"), "lines").unionByName(cut)
    lines = F.col("lines")
    hits = F.transform(F.filter(lines, lambda x: x["k"] == "body_hits"), lambda x: F.struct(
        F.trim(F.substring_index(x["v"], " ", 1)).alias("term"),
        F.transform(F.filter(F.split(F.trim(F.regexp_extract(x["v"], r"^\S*\s*(.*)$", 1)), r"\s+", -1),
                             lambda t: t != F.lit("")), lambda t: t.cast("int")).alias("positions"),
    ))
    return r.select(
        "query", "url", "url_pos",
        _last_value(lines, "title").alias("title"),
        F.transform(F.filter(lines, lambda x: x["k"] == "header"), lambda x: x["v"]).alias("headers"),
        F.map_from_entries(_dedupe_last(hits, "term")).alias("body_hits"),
        _last_value(lines, "body_length").cast("int").alias("body_length"),
        _last_value(lines, "pagerank").cast("int").alias("pagerank"),
        F.map_from_entries(_dedupe_last(_anchors(lines), "text")).alias("anchors"),
        "file", "block",
    )


def last_block_wins(df: DataFrame, key: str = "query") -> DataFrame:
    """Keep only the last block of every repeated query text (file order, then block order)."""
    last = df.groupBy(F.col(key).alias("_key")).agg(F.max(F.struct("file", "block")).alias("_last"))
    last = snapshot(last, scratch_path(df.sparkSession, "blocks"))  # a row per query: small beside the records
    same = F.col(key).eqNullSafe(F.col("_key")) & F.struct("file", "block").eqNullSafe(F.col("_last"))
    return df.join(last, same, "left_semi")


def read_judgments(spark: SparkSession, path: str) -> DataFrame:
    """S3: ``query: Q`` then ``  url: U REL`` lines -> (query, url, rel); REL is the last
    space-separated token (``rsplit(' ', 1)``)."""
    u = _filled(spark, path).where("k = 'url'")
    m = F.regexp_extract("v", r"^(.*) (\S+)$", 1)
    return u.select("query", F.trim(m).alias("url"),
                    F.regexp_extract("v", r"^(.*) (\S+)$", 2).cast("double").alias("rel"))


def read_ranking(spark: SparkSession, path: str) -> DataFrame:
    """``query: Q`` then ``  url: U`` lines, best first -> (query, rank, url)."""
    return _filled(spark, path).where("k = 'url'").select("query", (F.col("url_pos") + 1).alias("rank"), F.col("v").alias("url"))


def _write_lines(lines: DataFrame, path: str, mode: str = "overwrite", file_lines: int = FILE_LINES) -> None:
    """``lines``: (qkey, o1, o2, text), written in this order over the files as they are named,
    at most ``file_lines`` lines each, with the manifest of their order. A query's lines may fill any
    number of files."""
    order = ["qkey", "o1", "o2"]
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    _write_ordered(lines.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("text"), path, mode, file_lines)


def _write_ordered(text: DataFrame, path: str, mode: str, file_lines: int = FILE_LINES) -> None:
    """``text``: the lines in the order of its partitions, written with the manifest."""
    spark = text.sparkSession
    text.write.mode(mode).option("maxRecordsPerFile", file_lines).text(path)
    files = spark.read.text(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("lines"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files.select("file", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("first_line"), "lines") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/{ORDER}")


def _in_turn(lists: Column) -> Column:
    """The first elements of all lists, then the second ones and so on."""
    most = F.array_max(F.transform(lists, F.size))
    turns = F.transform(F.sequence(F.lit(0), most - 1), lambda i: F.transform(F.filter(lists, lambda x: F.size(x) > i), lambda x: F.get(x, i)))
    return F.when(F.size(lists) == 1, F.get(lists, 0)).otherwise(F.flatten(turns))


def write_ranking(ranked: DataFrame, path: str, key_col: str = "query_id", query_col: str = "query",
                  mode: str = "overwrite", file_lines: int = FILE_LINES) -> None:
    """Per query (``key_col`` identifies a block) ``query: Q`` followed by ``  url: U``
    lines in rank order."""
    head = ranked.select(F.col(key_col).alias("qkey"), F.lit(0).alias("o1"), F.lit(0).alias("o2"),
                         F.concat(F.lit("query: "), F.col(query_col)).alias("text")).distinct()
    body = ranked.select(F.col(key_col).alias("qkey"), F.col("rank").alias("o1"), F.lit(0).alias("o2"),
                         F.concat(F.lit("  url: "), F.col("url")).alias("text"))
    _write_lines(head.unionByName(body), path, mode, file_lines)


def write_judgments(judged: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Judgments file: ``query: Q`` then ``  url: U REL`` (query, url, rel)."""
    head = judged.select(F.col("query").alias("qkey"), F.lit(0).alias("o1"), F.lit("").alias("o2"),
                         F.concat(F.lit("query: "), F.col("query")).alias("text")).distinct()
    body = judged.select(F.col("query").alias("qkey"), F.lit(1).alias("o1"), F.col("url").alias("o2"),
                         F.concat(F.lit("  url: "), F.col("url"), F.lit(" "), F.col("rel").cast("string")).alias("text"))
    _write_lines(head.unionByName(body), path, mode)


def write_feature_file(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Feature file from records (query, url, url_pos, title, headers, body_hits map,
    body_length, pagerank, anchors map). Lines per record: url, title, headers,
    body_hits (terms sorted), body_length, pagerank, anchor_text / anchor count."""
    ind = "    "
    kv = lambda k, v: F.concat(F.lit(f"{ind}{k}: "), v)
    hits = F.transform(F.sort_array(F.map_entries(F.coalesce("body_hits", F.create_map().cast("map<string,array<int>>")))),
                       lambda e: kv("body_hits", F.concat_ws(" ", e["key"], F.array_join(e["value"].cast("array<string>"), " "))))
    anchors = F.flatten(F.transform(
        F.sort_array(F.map_entries(F.coalesce("anchors", F.create_map().cast("map<string,int>")))),
        lambda e: F.array(kv("anchor_text", e["key"]),
                          F.concat(F.lit(f"{ind}  {ANCHOR_COUNT_KEY}: "), e["value"].cast("string")))))
    text_lines = F.concat(
        F.array(F.concat(F.lit("  url: "), F.col("url"))),
        F.when(F.col("title").isNotNull(), F.array(kv("title", F.col("title")))).otherwise(F.array().cast("array<string>")),
        F.transform(F.coalesce("headers", F.array().cast("array<string>")), lambda h: kv("header", h)),
        hits,
        F.when(F.col("body_length").isNotNull(), F.array(kv("body_length", F.col("body_length").cast("string"))))
        .otherwise(F.array().cast("array<string>")),
        F.when(F.col("pagerank").isNotNull(), F.array(kv("pagerank", F.col("pagerank").cast("string"))))
        .otherwise(F.array().cast("array<string>")),
        anchors,
    )
    head = records.select("query").distinct().select(F.col("query").alias("qkey"), F.lit(-1).alias("o1"),
                                                     F.array(F.concat(F.lit("query: "), F.col("query"))).alias("texts"))
    body = records.select(F.col("query").alias("qkey"), F.col("url_pos").alias("o1"), text_lines.alias("texts"))
    order, parts = ["qkey", "o1"], int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # records are moved and sorted whole; lines of records of one place, where there are several, take turns
    place = Window.partitionBy(*order)
    placed = head.unionByName(body).repartitionByRange(parts, *order) \
        .withColumn("_all", F.collect_list("texts").over(place)).withColumn("_nth", F.row_number().over(place.orderBy("o1"))).where("_nth = 1")
    text = placed.select(*order, _in_turn(F.col("_all")).alias("texts")).sortWithinPartitions(*order).select(F.explode("texts").alias("text"))
    _write_ordered(text, path, mode)


def features_to_collection(records: DataFrame, dedupe: bool = True) -> tuple[DataFrame, DataFrame]:
    """Turn feature records into (queries, collection) for ``RankingJob``.

    query_id is the query text, page_id names the record's place (file, block, url_pos), so
    nothing is merged by a hash; equal scores keep the order of url_pos. Every record is a candidate
    of its own query (the collection carries ``query_id``). With ``dedupe`` the reference's
    dictionary semantics apply: the last block of a repeated query text wins, and a url
    repeated inside a block keeps its last record."""
    if dedupe:
        records = last_block_wins(records)
        again = records.groupBy(F.col("query").alias("_query"), F.col("url").alias("_url")) \
            .agg(F.max("url_pos").alias("_last"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
        again = snapshot(again, scratch_path(records.sparkSession, "repeated"))  # urls that come again in their block
        same = F.col("query").eqNullSafe(F.col("_query")) & F.col("url").eqNullSafe(F.col("_url"))
        records = records.join(again, same, "left").where(F.col("_last").isNull() | (F.col("url_pos") == F.col("_last"))).drop("_query", "_url", "_last")
    recs = records.withColumn("query_id", F.col("query")).withColumn(
        "page_id", F.concat_ws(":", "file", "block", "url_pos"))
    queries = recs.select("query_id", "query").distinct()
    anchors = F.transform(F.map_entries(F.coalesce("anchors", F.create_map().cast("map<string,int>"))),
                          lambda e: F.struct(e["key"].alias("text"), e["value"].alias("cnt")))
    coll = recs.select("page_id", "query_id", "url", "url_pos", "title", "headers", anchors.alias("anchors"),
                       "body_hits", "body_length", "pagerank")
    return queries, coll
