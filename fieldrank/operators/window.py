"""Smallest query-term window (J4, C7) and the window boost.

For each (query, page) the window is the shortest span ``max - min + 1`` that holds every
distinct query term inside one field: url, title, the concatenated headers, the body, or a
single anchor text. No such field -> no window (null = infinite).

Plan:
1. postings of the candidate pairs' query terms: an equi-join on (page, term);
2. relational division (J4): one aggregation per (query, page, field, instance) counts the
   terms and keeps the fields that hold every one. A field has one row per term, so a count
   of rows does; a bit mask would, too, but for queries of more than 64 terms;
3. per surviving field: the sorted position arrays, one per term, are merged in the row by
   one ``aggregate`` whose state is a place in each array. The heads span a window, and those
   at its start move on, until an array ends. Nothing is flattened or sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldrank.operators.index import LOWER_FIELDS, PageIndex, of_pairs

INT_MAX = 2**31 - 1


def query_term_postings(qdistinct: DataFrame, index: PageIndex, cands: DataFrame | None = None) -> DataFrame:
    """(page_id, query_id, field, instance, term, ti, k, qlen, positions) of candidate pairs."""
    q = qdistinct.select("query_id", "term", "ti", "k", "qlen")
    if index.keyed_by_query:
        return index.postings.where(F.col("field").isin(*LOWER_FIELDS)).join(q, ["term", "query_id"])
    return of_pairs(index, "postings", cands.join(q, "query_id")).where(F.col("field").isin(*LOWER_FIELDS))


GROUP = ("query_id", "page_id", "field", "instance")


def all_terms_in_field(qpost: DataFrame) -> DataFrame:
    """(query_id, page_id, field, instance, k, lists) of the groups that contain every
    distinct query term, with the positions of each term."""
    g = qpost.groupBy(*GROUP, "k").agg(F.count(F.lit(1)).alias("_nt"), F.collect_list("positions").alias("lists"))
    return g.where(F.col("_nt") == F.col("k")).drop("_nt")


def _once(value, body):
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def smallest_window(lists):
    """C7 on one group: ``lists`` = column of array<array<int>>, each inner array sorted; null
    when one is empty. As many steps as positions."""
    events = F.aggregate(lists, F.lit(0), lambda n, x: n + F.size(x))
    init = F.struct(F.array_repeat(F.lit(0), F.size(lists)).alias("at"), F.lit(None).cast("int").alias("best"))

    def moved(acc, heads, start):
        return F.struct(
            F.transform(acc["at"], lambda i, j: F.when(F.get(heads, j) == start, i + 1).otherwise(i)).alias("at"),
            F.least(F.coalesce(acc["best"], F.lit(INT_MAX)), (F.array_max(heads) - start + 1).cast("int")).alias("best"))

    def step(acc, _):
        heads = F.transform(acc["at"], lambda i, j: F.get(F.get(lists, j), i))
        return _once(heads, lambda h: F.when(F.exists(h, lambda x: x.isNull()), acc).otherwise(
            _once(F.array_min(h), lambda start: moved(acc, h, start))))

    swept = F.aggregate(F.sequence(F.lit(1), events), init, step, lambda acc: acc["best"])
    return F.when(events > 0, swept)


def field_windows(qpost: DataFrame) -> DataFrame:
    """(query_id, page_id, field, instance, window) for every field holding all terms."""
    one = F.when(F.col("k") == 1, 1)
    return all_terms_in_field(qpost).select(*GROUP, one.otherwise(smallest_window(F.col("lists"))).alias("window_size"))


def smallest_windows(qdistinct: DataFrame, index: PageIndex, cands: DataFrame | None = None) -> DataFrame:
    """(query_id, page_id, window) for candidate pairs with a finite window."""
    fw = field_windows(query_term_postings(qdistinct, index, cands))
    return fw.groupBy("query_id", "page_id").agg(F.min("window_size").alias("window_size"))
