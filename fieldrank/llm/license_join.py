"""License scan: an exact set-similarity join of text blocks with license templates.

A block (paragraph) meets a template when it holds at least ``THRESHOLD`` of the template's
distinct words and all that the template names as its licence's own. The join finds every such pair without comparing each block with each
template:

* all tokens are put in one global order, rarest in the corpus first;
* length filter: a block with fewer than ``need = ceil(threshold * size)`` template tokens
  can't meet the template;
* prefix filter: a meeting pair shares a token among the template's first
  ``size - need + 1`` and the block's first ``held - need + 1`` tokens in that order, so only
  those (rare) tokens are joined on;
* positional filter: a first shared token at places i and j (from 0) leaves at most
  ``min(size - i, held - j)`` common ones;
* the remaining pairs are verified by counting the whole intersection.

Tokens outside every template can't be shared, so blocks are cut to the template vocabulary
when they are read; frequencies are counted over all blocks that can meet any template. The templates and their
vocabulary are a fixed, small parameter (a few hundred tokens); they are the only thing
that is broadcast or sent to the driver.

The phrase search beside it finds every place where a phrase's words stand consecutively in
the whole text. All work is done by DataFrame expressions.

Defined results: null, empty and wordless texts have no words, places or labels (empty
strings, score 0); repeated rows are scanned each for itself and give equal rows; a block
may meet several templates (equal containments too), and a document has each label once; very long texts are scanned
whole; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, let, table, written

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK_BREAK = r"\n[ \t\r]*\n"
THRESHOLD = 0.8

# The phrases searched and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public license notices, by label, and the words without which a block isn't that
# licence's, however much else it shares. A label may have several templates.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Released under the MIT License", "mit"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache", "2"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0", "apache", "2"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", "gnu", "3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation", "gnu"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", "creative", "commons", "attribution", "4"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", "cc", "by", "nc", "4"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla", "2"),
]


def tokens(lowered: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of lower-cased text."""
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def template_sets(templates=None) -> list[tuple[int, str, list[str], list[str]]]:
    """(number, label, distinct tokens, those that must be there) of each template that has any;
    a template is a label, a text and any number of words of it."""
    out = []
    for i, (label, text, *must) in enumerate(TEMPLATES if templates is None else templates):
        lowered = text.translate(str.maketrans(UPPER, LOWER))
        if found := sorted(set(re.split(NOT_WORD, lowered)) - {""}):
            if not set(must) <= set(found):
                raise ValueError(f"words of template {i} that must be there aren't in its text")
            out.append((i, label, found, sorted(set(must))))
    return out


def needed(size: int, threshold: float) -> int:
    """Smallest overlap with overlap / size >= threshold."""
    need = max(1, math.ceil(threshold * size) - 1)
    while need / size < threshold:
        need += 1
    return need


def phrase_places(lowered: Column, w: Column, phrase: str) -> Column:
    """Starts (words from 0) of every place of ``phrase`` in the words ``w``; texts without
    one of its words are not searched."""
    parts = phrase.split(" ")
    some = reduce(lambda a, b: a & b, [F.contains(lowered, F.lit(p)) for p in parts])
    some = some & (F.size(w) >= len(parts))
    here = lambda i: reduce(lambda a, b: a & b, [F.get(w, i + k) == p for k, p in enumerate(parts)])
    return F.when(some, F.filter(F.sequence(F.lit(0), F.size(w) - len(parts)), here)).otherwise(F.array().cast("array<int>"))


def scanned(docs: DataFrame, text: str, phrases: dict[str, str], vocabulary: list[str], least: int) -> DataFrame:
    """One pass over the texts: word count, phrase places, and per block its tokens of the
    template vocabulary (blocks with fewer than ``least`` of them dropped)."""
    lowered = ascii_lower(F.col(f"`{text}`"))
    known = F.array(*[F.lit(t) for t in vocabulary]) if vocabulary else F.array().cast("array<string>")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    places = lambda w: F.struct(F.size(w).cast("long").alias("n_words"), *[
        phrase_places(F.col("lowered"), w, p).alias(f"p{k}") for k, p in enumerate(phrases)])
    blocks = F.filter(F.transform(F.split(F.col("lowered"), BLOCK_BREAK), lambda b: F.array_intersect(known, tokens(b))),
                      lambda b: F.size(b) >= least)
    return docs.select(F.struct(*rest).alias("row"), lowered.alias("lowered")).select(
        "row", let(tokens(F.col("lowered")), places).alias("s"), blocks.alias("blocks"))


def set_join(blocks: DataFrame, templates, threshold: float) -> DataFrame:
    """(rid, block, template, containment) of every block (rid, block, held: distinct
    template tokens) that meets a template."""
    vocabulary = sorted({t for _, _, found, _ in templates for t in found})
    counts = blocks.select(F.explode("held").alias("token")).groupBy("token").count().collect()  # one row per template token
    count = {r["token"]: r["count"] for r in counts}
    place = {t: k for k, t in enumerate(sorted(vocabulary, key=lambda t: (count.get(t, 0), t)))}
    ordered = {i: sorted(place[t] for t in found) for i, _, found, _ in templates}
    index = [(i, rank, at, len(ranks), needed(len(ranks), threshold)) for i, ranks in ordered.items()
             for at, rank in enumerate(ranks[: len(ranks) - needed(len(ranks), threshold) + 1])]
    spark = blocks.sparkSession
    prefixes = F.broadcast(spark.createDataFrame(index, "template int, token int, at int, size int, need int"))
    sets = F.broadcast(spark.createDataFrame([(i, ordered[i], [place[t] for t in must]) for i, _, _, must in templates],
                                             "template int, ranks array<int>, must array<int>"))
    ranks = F.create_map(*[F.lit(x) for t in vocabulary for x in (t, place[t])])
    rare = F.array(*[F.lit(r) for r in sorted({x[1] for x in index})])
    ranked = blocks.select("rid", "block", F.sort_array(F.transform("held", lambda t: ranks[t])).alias("held"))
    shared = ranked.where(F.arrays_overlap("held", rare)) \
        .select("rid", "block", "held", F.posexplode("held").alias("j", "token")).join(prefixes, "token")
    shared = shared.where((F.size("held") >= F.col("need")) & (F.col("j") <= F.size("held") - F.col("need"))
                          & (F.least(F.col("size") - F.col("at"), F.size("held") - F.col("j")) >= F.col("need")))
    pairs = shared.select("rid", "block", "held", "template", "need").distinct().join(sets, "template")
    common = F.size(F.array_intersect("held", "ranks"))
    whole = F.size(F.array_except("must", "held")) == 0
    return pairs.where((common >= F.col("need")) & whole).select("rid", "block", "template", (common / F.size("ranks")).alias("containment"))


def scan(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD, phrases: dict[str, str] | None = None,
         templates=None) -> DataFrame:
    """One row per document: ``row`` (struct of the input columns but the text), n_words,
    n_base, first_word, last_word, base_labels, labels (arrays) and score: 1 where a phrase
    stands, else the highest containment that meets the threshold, else 0."""
    phrases = PHRASES if phrases is None else phrases
    sets = template_sets(templates)
    vocabulary = sorted({t for _, _, found, _ in sets for t in found})
    least = min((needed(len(found), threshold) for _, _, found, _ in sets), default=1)
    rows = scanned(docs, text, phrases, vocabulary, least).withColumn("rid", F.monotonically_increasing_id())
    rows = written(rows, "license-blocks")  # from here on the ids stand
    met = set_join(rows.select("rid", F.posexplode("blocks").alias("block", "held")), sets, threshold)
    names = F.create_map(*[F.lit(x) for i, label, _, _ in sets for x in (i, label)])
    found = met.groupBy("rid").agg(F.collect_set(names[F.col("template")]).alias("met"), F.max("containment").alias("containment"))
    none = F.array().cast("array<string>")
    places = F.flatten(F.array(*[F.col(f"s.p{k}") for k in range(len(phrases))])) if phrases else F.array().cast("array<int>")
    base = F.array_sort(F.array_distinct(F.flatten(F.array(*[
        F.when(F.size(F.col(f"s.p{k}")) > 0, F.array(F.lit(label))).otherwise(none) for k, label in enumerate(phrases.values())])))) \
        if phrases else none
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("met", none))))
    return rows.join(found, "rid", "left").withColumn("places", places).withColumn("base", base).select(
        "row", F.col("s.n_words").alias("n_words"), F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.col("base").alias("base_labels"), labels.alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"))


def op8_license_join(spark, sf_dir):
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_words", "n_base", "first_word", "last_word", F.concat_ws(",", "base_labels").alias("base_labels"),
                      F.concat_ws(",", "labels").alias("labels"), F.round("score", 9).alias("score"))


def _sql() -> str:
    """The same by brute force: every block against every template."""
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    low = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    listed = lambda words: f"[{', '.join(repr(t) for t in words)}]::VARCHAR[]"
    rows = ", ".join(f"({i}, '{label}', {listed(found)}, {listed(must)})" for i, label, found, must in template_sets())

    def places(phrase):
        parts = phrase.split(" ")
        test = " AND ".join(f"w[i + {k}] = '{p}'" for k, p in enumerate(parts))
        return f"CASE WHEN len(w) >= {len(parts)} THEN list_filter(range(1, len(w) + 2 - {len(parts)}), lambda i: {test}) ELSE [] END"

    found = ", ".join(f"{places(p)} AS p{k}" for k, p in enumerate(PHRASES))
    every = " || ".join(f"p{k}" for k in range(len(PHRASES)))
    base = " || ".join(f"CASE WHEN len(p{k}) > 0 THEN ['{label}'] ELSE []::VARCHAR[] END" for k, label in enumerate(PHRASES.values()))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {low} AS t FROM documents),
w AS (SELECT rid, doc_id, regexp_extract_all(t, '{word}') AS w FROM d),
p AS (SELECT rid, doc_id, len(w) AS n_words, {found} FROM w),
b AS (SELECT rid, unnest(string_split_regex(t, '\\n[ \\t\\r]*\\n')) AS block FROM d),
s AS (SELECT rid, list_distinct(regexp_extract_all(block, '{word}')) AS held FROM b),
tm(template, label, tokens, must) AS (VALUES {rows}),
m AS (SELECT rid, label, len(list_intersect(held, tokens)) / len(tokens)::DOUBLE AS containment
      FROM s, tm WHERE list_has_all(held, must)),
f AS (SELECT rid, list(DISTINCT label) AS met, max(containment) AS containment FROM m WHERE containment >= {THRESHOLD} GROUP BY rid),
r AS (SELECT rid, doc_id, n_words, {every} AS places, {base} AS base FROM p)
SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base, (list_min(places) - 1)::BIGINT AS first_word,
       (list_max(places) - 1)::BIGINT AS last_word, array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(base || coalesce(met, []::VARCHAR[]))), ',') AS labels,
       round(CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(containment, 0) END, 9)::DOUBLE AS score
FROM r LEFT JOIN f USING (rid)
"""


OP8_SQL = _sql()
