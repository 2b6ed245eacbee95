"""Per-page index of a collection: positional postings (T9) and per-term field tfs.

Plan: every token event of a page is generated inside its row, body tokens outside the query
vocabulary are dropped there, and the events are counted per (page, term) before they are
shuffled by that key: no page text crosses the network. The unit of skew is a term of one
page, so a stop word that fills a third of the corpus still spreads over all partitions.

Fields (lowercase view, used by cosine and windows): url (case kept, 0-based), title,
header (all headers concatenated), anchor (one instance per distinct anchor text, weight
``max(cnt, 1)``), body (positions as given; 1-based from token lists). Raw view (BM25F):
title_raw, header_raw, anchor_raw — case kept, anchors unweighted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldrank.functions.text import (
    body_length_clamp, tok_headers_lower, tok_headers_raw, tok_lower, tok_raw, tok_url,
)

LOWER_FIELDS = ("url", "title", "header", "body", "anchor")
RAW_FIELDS = ("title_raw", "header_raw", "anchor_raw")

EVENT = "struct<field:string,instance:int,pos:int,term:string,w:int>"


def _events(tokens: Column, field: str, base: int = 0, instance: Column | int = 0, w: Column | int = 1) -> Column:
    inst = instance if isinstance(instance, Column) else F.lit(instance)
    wt = w if isinstance(w, Column) else F.lit(w)
    return F.transform(
        tokens,
        lambda t, i: F.struct(
            F.lit(field).alias("field"), inst.cast("int").alias("instance"),
            (i + base).cast("int").alias("pos"), t.alias("term"), wt.cast("int").alias("w"),
        ),
    )


def _anchor_events(anchors: Column, tok, field: str, weighted: bool) -> Column:
    return F.flatten(
        F.transform(
            anchors,
            lambda a, j: _events(tok(a["text"]), field, 0, j,
                                 F.greatest(F.coalesce(a["cnt"], F.lit(1)), F.lit(1)) if weighted else 1),
        )
    )


# numeric page scalars every matched term row needs (grouping keys of the term table, so
# the aggregations stay hash-based with fixed-width buffers)
TERM_SCALARS = ("L", "len_url", "len_title", "len_header", "len_anchor")
# page attributes only needed once per (query, page) pair; joined back by page_id
# (``tie`` orders equal scores: the place in the input; ``listed_hits`` counts every body hit
# that a feature record lists, whatever its term)
PAGE_ATTRS = ("url", "pagerank", "rel", "body_len_raw", "n_header_d", "n_anchor_d", "tie", "listed_hits")


def page_scalars(coll: DataFrame) -> list[Column]:
    """Per-page scalars used by the rankers, computed inside the row."""
    anchors = F.coalesce(F.col("anchors"), F.array().cast("array<struct<text:string,cnt:int>>"))
    headers = F.coalesce(F.col("headers"), F.array().cast("array<string>"))
    rel = F.col("rel").cast("double") if "rel" in coll.columns else F.lit(None).cast("double")
    listed = F.lit(None)
    if "body_hits" in coll.columns:
        positions = F.map_values(F.coalesce("body_hits", F.create_map().cast("map<string,array<int>>")))
        listed = F.aggregate(positions, F.lit(0), lambda n, p: n + F.size(p))
    return [
        body_length_clamp(F.col("body_length")).alias("L"),
        F.size(tok_url(F.col("url"))).cast("double").alias("len_url"),
        F.size(tok_raw(F.col("title"))).cast("double").alias("len_title"),
        F.size(tok_headers_raw(headers)).cast("double").alias("len_header"),
        F.aggregate(anchors, F.lit(0), lambda acc, a: acc + F.size(tok_raw(a["text"]))).cast("double").alias("len_anchor"),
        F.col("url").alias("url"),
        F.coalesce(F.col("pagerank"), F.lit(0)).cast("int").alias("pagerank"),
        rel.alias("rel"),
        F.coalesce(F.col("body_length").cast("double"), F.lit(0.0)).alias("body_len_raw"),
        F.greatest(F.size(headers), F.lit(1)).cast("double").alias("n_header_d"),
        F.greatest(F.size(anchors), F.lit(1)).cast("double").alias("n_anchor_d"),
        F.col("url_pos" if "url_pos" in coll.columns else "page_id").alias("tie"),
        listed.cast("long").alias("listed_hits"),
    ]


def _body_events(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Body events via plain generators (code-generated, no per-token lambda): the body is
    by far the largest field."""
    cols = [*keys, *TERM_SCALARS]
    if "body_tokens" in pages.columns:
        ev = pages.select(*cols, F.posexplode(F.col("body_tokens")).alias("pos", "term"))
        ev = ev.withColumn("pos", (F.col("pos") + 1).cast("int"))
    else:  # feature-record shape: body_hits map term -> positions (only the query's terms)
        ev = pages.select(*cols, F.explode(F.col("body_hits")).alias("term", "positions"))
        ev = ev.select(*cols, "term", F.explode("positions").alias("pos")).withColumn("pos", F.col("pos").cast("int"))
    ev = ev.where(F.col("term").isNotNull() & F.col("pos").isNotNull())
    return ev.select(*cols, F.lit("body").alias("field"), F.lit(0).alias("instance"), "pos", "term",
                     F.lit(1).alias("w"))


@dataclass
class PageIndex:
    pages: DataFrame      # page_id, [query_id], TERM_SCALARS, PAGE_ATTRS
    postings: DataFrame   # page_id, [query_id], field, instance, term, tf, w, positions
    terms: DataFrame      # page_id, [query_id], term, TERM_SCALARS, tf_url..tf_anchor, rtf_title..rtf_anchor
    keyed_by_query: bool  # True for feature records: pages belong to one query
    by_page: DataFrame | None = None  # a kept index: a row per page (``PAGE_ROW``), of which the others are views
    buckets: int = 0      # of ``by_page``, by page_id

    @property
    def keys(self) -> list[str]:
        return ["page_id"] + (["query_id"] if self.keyed_by_query else [])


def _field_events(lower: bool) -> Column:
    """The tokens of a page's fields other than the body, in lower case or as they are."""
    anchors = F.coalesce(F.col("anchors"), F.array().cast("array<struct<text:string,cnt:int>>"))
    headers = F.coalesce(F.col("headers"), F.array().cast("array<string>"))
    if lower:
        parts = (_events(tok_url(F.col("url")), "url"), _events(tok_lower(F.col("title")), "title"),
                 _events(tok_headers_lower(headers), "header"), _anchor_events(anchors, tok_lower, "anchor", weighted=True))
    else:
        parts = (_events(tok_raw(F.col("title")), "title_raw"), _events(tok_headers_raw(headers), "header_raw"),
                 _anchor_events(anchors, tok_raw, "anchor_raw", weighted=False))
    return F.concat(*[part.cast(f"array<{EVENT}>") for part in parts])


def _tables_from(pages: DataFrame, keys: list[str], vocab: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Postings and the per-term field tf table from the parsed pages. With
    ``vocab`` (``term``, with ``query_id`` for feature records), postings and body tokens outside it are
    dropped before aggregating: the rankers read those of query terms only (norms use non-body
    fields, lengths the page scalars), and the body is the bulk of the tokens. The norm of a feature
    record counts all the body terms that it lists, so its term table keeps them."""
    lower, raw = _field_events(lower=True), _field_events(lower=False)
    if "body_tokens" not in pages.columns:  # records are moved once, not their tokens
        pages = pages.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), "page_id")
        hits = F.flatten(F.transform(F.map_entries("body_hits"), lambda e: F.transform(
            F.filter(e["value"], lambda p: p.isNotNull()), lambda p: F.struct(
                F.lit("body").alias("field"), F.lit(0).alias("instance"), p.cast("int").alias("pos"), e["key"].alias("term"), F.lit(1).alias("w")))))
        hits = F.coalesce(hits, F.array().cast(f"array<{EVENT}>")).cast(f"array<{EVENT}>")
        placed = pages.select(*keys, *TERM_SCALARS, F.inline(F.concat(hits, lower)))
        ev = pages.select(*keys, *TERM_SCALARS, F.inline(F.concat(hits, lower, raw)))
        if vocab is not None:
            own = [c for c in keys if c in vocab.columns]  # the terms of a record's own query
            placed = placed.join(vocab.select(*own, "term").distinct(), [*own, "term"], "left_semi")
        return _counted(placed, ev, keys)
    body = _body_events(pages, keys)
    placed = body.unionByName(pages.select(*keys, *TERM_SCALARS, F.inline(lower)))
    if vocab is not None:
        known = vocab.select("term").distinct()
        placed, body = (x.join(known, "term", "left_semi") for x in (placed, body))
    ev = body.unionByName(pages.select(*keys, *TERM_SCALARS, F.inline(F.concat(lower, raw))))
    return _counted(placed, ev, keys)


def _counted(placed: DataFrame, ev: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Postings of the ``placed`` tokens and the term table of all tokens ``ev``."""
    postings = placed.groupBy(*keys, "field", "instance", "term").agg(
        F.count(F.lit(1)).alias("tf"),
        F.max("w").alias("w"),
        F.sort_array(F.collect_list("pos")).alias("positions"),
    )

    def fsum(field: str, weighted: bool = False) -> Column:
        v = F.col("w") if weighted else F.lit(1)
        return F.coalesce(F.sum(F.when(F.col("field") == field, v)), F.lit(0)).cast("long")

    terms = ev.groupBy(*keys, "term", *TERM_SCALARS).agg(
        fsum("url").alias("tf_url"), fsum("title").alias("tf_title"), fsum("header").alias("tf_header"),
        fsum("body").alias("tf_body"), fsum("anchor", weighted=True).alias("tf_anchor"),
        fsum("title_raw").alias("rtf_title"), fsum("header_raw").alias("rtf_header"),
        fsum("anchor_raw").alias("rtf_anchor"),
    )
    return postings, terms


#: A page's row of a kept index: what ``PageIndex.terms`` and ``postings`` hold of it, in arrays.
TERM_TFS = ("tf_url", "tf_title", "tf_header", "tf_body", "tf_anchor", "rtf_title", "rtf_header", "rtf_anchor")
PAGE_ROW = ("page_id", *TERM_SCALARS, *PAGE_ATTRS, "terms", "postings")


_ROW_TYPES = "terms array<struct<term:string," + ",".join(f"{c}:bigint" for c in TERM_TFS) + ">>, " \
    "postings array<struct<field:string,instance:int,term:string,tf:bigint,w:int,positions:array<int>>>"
_FIELDS = (*LOWER_FIELDS, *RAW_FIELDS)  # in the order of TERM_TFS
_CHUNK = 256  # pages whose tokens are sorted at once


def page_rows(coll: DataFrame) -> DataFrame:
    """``PAGE_ROW`` of pages whose ids don't repeat: a page's tokens are made in its row, as elsewhere, and
    counted where they are, a chunk of pages at a time; nothing is exploded or shuffled."""
    body = F.coalesce("body_tokens", F.array().cast("array<string>")).alias("body")
    pages = coll.select("page_id", *page_scalars(coll), body, F.concat(_field_events(lower=True), _field_events(lower=False)).alias("events"))
    kept = pages.select("page_id", *TERM_SCALARS, *PAGE_ATTRS).schema
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
    return pages.mapInArrow(_counter(), f"{types}, {_ROW_TYPES}")


def _counter():
    """Counts the tokens of each page (``body``, ``events``); of the library, tasks need no more than this."""
    def chunk_rows(body, events):
        """The arrays of ``terms`` and ``postings`` of some pages' tokens."""
        n, lists = len(body), (body, events)
        lengths = [np.asarray(pc.fill_null(pc.list_value_length(x), 0)) for x in lists]
        own, (words, rest) = [np.repeat(np.arange(n), k) for k in lengths], [x.flatten() for x in lists]
        first = np.cumsum(lengths[0]) - lengths[0]
        code = pc.index_in(rest.field("field"), pa.array(_FIELDS))
        join = lambda x, y: np.concatenate([x, np.asarray(y, dtype=np.int64)])
        nothing, one = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
        page, field = np.concatenate(own), join(nothing + _FIELDS.index("body"), code)
        instance, pos = join(nothing, rest.field("instance")), join(np.arange(len(words)) - first[own[0]] + 1, rest.field("pos"))
        w, words = join(one, rest.field("w")), pa.concat_arrays([words.cast(pa.string()), rest.field("term").cast(pa.string())])
        coded = words.dictionary_encode()
        there = np.asarray(words.is_valid())
        term = np.asarray(coded.indices.fill_null(0), dtype=np.int64)
        order = np.lexsort((pos, instance, field, term, page))
        order = order[there[order]]
        page, term, field, instance, pos, w = (x[order] for x in (page, term, field, instance, pos, w))

        def starts(*keys):
            new = np.ones(len(page), bool)
            new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            return np.flatnonzero(new)

        def rows(at, columns):
            offsets = np.concatenate([[0], np.cumsum(np.bincount(page[at], minlength=n))])
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(list(columns.values()), list(columns)))

        texts = lambda at: coded.dictionary.take(pa.array(term[at]))
        at = starts(page, term)
        group = np.cumsum(np.isin(np.arange(len(page)), at)) - 1
        tfs = {c: np.bincount(group, np.where(field == k, w if c == "tf_anchor" else 1, 0), len(at)) for k, c in enumerate(TERM_TFS)}
        terms = rows(at, {"term": texts(at), **{c: pa.array(v.astype(np.int64)) for c, v in tfs.items()}})
        at = starts(page, term, field, instance)
        ends = np.append(at, len(page)).astype(np.int64)
        most = np.maximum.reduceat(w, at) if len(at) else w
        low = field[at] < len(LOWER_FIELDS)
        held = np.repeat(low, np.diff(ends))
        at, size, most = at[low], np.diff(ends)[low], most[low]
        positions = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(pos[held], pa.int32()))
        postings = rows(at, {"field": pa.array(_FIELDS).take(pa.array(field[at])), "instance": pa.array(instance[at], pa.int32()), "term": texts(at),
                             "tf": pa.array(size), "w": pa.array(most, pa.int32()), "positions": positions})
        return terms, postings

    def counted(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                chunk = batch.slice(at, _CHUNK)
                terms, postings = chunk_rows(chunk.column("body"), chunk.column("events"))
                names = [n for n in chunk.schema.names if n not in ("body", "events")]
                yield pa.RecordBatch.from_arrays([*[chunk.column(n) for n in names], terms, postings], [*names, "terms", "postings"])
    return counted


def page_rows_of_repeated(coll: DataFrame) -> DataFrame:
    """``PAGE_ROW`` of pages whose ids may repeat. Rows of one id share their postings, and their terms where
    the lengths are equal, so these are in the first row of the id or of its lengths, and empty in the others."""
    index = build_index(coll)
    nest = lambda df, keys, cols, name: df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*cols))).alias(name))
    terms = nest(index.terms, ["page_id", *TERM_SCALARS], ["term", *TERM_TFS], "terms")
    postings = nest(index.postings, ["page_id"], ["field", "instance", "term", "tf", "w", "positions"], "postings")
    first = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy("page_id")) == 1
    pages = index.pages.withColumn("_first", first("page_id")).withColumn("_length", first("page_id", *TERM_SCALARS))
    rows = pages.join(terms, ["page_id", *TERM_SCALARS], "left").join(postings, "page_id", "left")
    return rows.withColumn("terms", F.when(F.col("_length"), F.col("terms"))).withColumn("postings", F.when(F.col("_first"), F.col("postings"))).select(*PAGE_ROW)


def kept_index(rows: DataFrame, buckets: int) -> PageIndex:
    """The index whose ``PAGE_ROW`` rows are kept in ``buckets`` by page_id."""
    return PageIndex(pages=rows.select("page_id", *TERM_SCALARS, *PAGE_ATTRS), postings=rows.select("page_id", F.inline("postings")),
                     terms=rows.select("page_id", *TERM_SCALARS, F.inline("terms")), keyed_by_query=False, by_page=rows, buckets=buckets)


def of_pairs(index: PageIndex, part: str, pair_terms: DataFrame) -> DataFrame:
    """The rows of ``terms`` or ``postings`` (``part``) joined with ``pair_terms`` (query_id, page_id, term, ...).
    A kept index is first joined by page with the terms that the page's queries ask for, where it lies; only
    what they ask for leaves the array."""
    if index.by_page is None:
        return getattr(index, part).join(pair_terms, ["page_id", "term"])
    asked = pair_terms.select("page_id", "term").repartition(index.buckets, "page_id").groupBy("page_id").agg(F.collect_set("term").alias("_asked"))
    scalars = TERM_SCALARS if part == "terms" else ()
    found = index.by_page.select("page_id", *scalars, part).join(asked, "page_id")
    asked_for = F.filter(part, lambda x: F.array_contains("_asked", x["term"]))
    return found.select("page_id", *scalars, F.inline(asked_for)).join(pair_terms, ["page_id", "term"])


def build_index(coll: DataFrame, vocab: DataFrame | None = None) -> PageIndex:
    """Index of ``coll``; ``vocab`` restricts the body terms kept (see ``_tables_from``)."""
    keyed = "query_id" in coll.columns
    keys = ["page_id"] + (["query_id"] if keyed else [])
    src = [c for c in ("url", "title", "headers", "anchors", "body_tokens", "body_hits") if c in coll.columns]
    pages = coll.select(*keys, *page_scalars(coll), *[c for c in src if c != "url"])
    postings, terms = _tables_from(pages, keys, vocab)
    return PageIndex(pages=pages.select(*keys, *TERM_SCALARS, *PAGE_ATTRS), postings=postings, terms=terms,
                     keyed_by_query=keyed)
