"""Ranking within a query (R1), judgments (J5), NDCG (R2-R5, A10) and output checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldrank.functions.scoring import ndcg_discount, ndcg_gain
from fieldrank.sources.corpus import scratch_path, snapshot

DISCOUNT_BLOCK = 4096  # places whose discounts are summed at once
SCORE_DIGITS = 9  # ties are decided on round(score, 9), then on the input order


def rank_within(df: DataFrame, score: str = "score", part=("query_id",), tiebreak: str | None = None,
                out: str = "rank") -> DataFrame:
    """Full descending order per query, ties on ``round(score, 9)`` in input order
    (``tie``, else ``page_id``); every row is kept (no top-k).

    No task holds a whole query. First pass: rows are range-partitioned by (query, score,
    tie), sorted and numbered inside each partition, and written to the shared folder, so
    that both passes see the same partitions whatever is lost or recomputed. Second pass: the rows
    of each query and partition are counted, and the counts of the partitions before are
    added to the places. The write starts when the rank is planned."""
    tie = tiebreak or ("tie" if "tie" in df.columns else "page_id")
    keys, spark = list(part), df.sparkSession
    order = [*keys, F.col("_key").desc(), F.col(tie).asc()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("_key", F.round(F.col(score), SCORE_DIGITS)).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # the id is the partition's number above 33 bits of the place in it
    stored = snapshot(placed.withColumn("_at", F.monotonically_increasing_id()).drop("_key"), scratch_path(spark, "rank"))
    stored = stored.withColumn("_pid", F.shiftright("_at", 33))
    runs = stored.groupBy(*keys, "_pid").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))  # a row per partition
    runs = runs.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_pid").alias("_of_pid"),
                       (F.col("_first") - F.coalesce(before, F.lit(0)) - 1).alias("_start"))
    same = F.col("_pid") == F.col("_of_pid")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return stored.join(runs, same).select(*[c for c in df.columns if c != out], (F.col("_at") - F.col("_start")).cast("int").alias(out))


def join_judgments(ranked: DataFrame, judgments: DataFrame, on, on_missing: str = "drop", part=("query_id",)) -> DataFrame:
    """Attach ``rel`` to ranked rows. ``drop`` keeps judged rows only and re-numbers the
    ranks among them (what NDCG over the judged list sees); ``error`` raises when a ranked
    row has no judgment (the reference's behaviour)."""
    if on_missing == "error":
        missing = ranked.join(judgments, on, "left_anti").limit(1).count()
        if missing:
            raise KeyError("ranked rows without a judgment")
    j = ranked.join(judgments, on, "inner")
    return rank_within(j.withColumn("_r", -F.col("rank")), "_r", part, tiebreak="rank").drop("_r")


def ndcg_per_query(ranked: DataFrame, part=("query_id",), rank: str = "rank", rel: str = "rel") -> DataFrame:
    """R2-R4 per query: DCG in ranked order, IDCG over the same relevances, ``ndcg = dcg /
    idcg`` or 1.0 when IDCG is 0."""
    return ndcg_from(dcg_per_group(ranked, part, rank, rel), idcg_per_query(ranked, rel, part), part)


def dcg_per_group(ranked: DataFrame, part=("query_id",), rank: str = "rank", rel: str = "rel") -> DataFrame:
    """R2 only: DCG per group from ranked rows (one exchange-free aggregation after the rank)."""
    return ranked.groupBy(*part).agg(
        F.sum(ndcg_gain(F.col(rel)) / ndcg_discount(F.col(rank))).alias("dcg"),
        F.count(F.lit(1)).alias("n_ranked"))


def idcg_per_query(candidates: DataFrame, rel: str = "rel", part=("query_id",)) -> DataFrame:
    """R3 per query: the ideal order depends on the relevances only, so pages are counted per
    relevance and each count takes the next places; no page is sorted. The discounts of a
    count's places are the difference of two cumulative sums: those before a block of places
    come from a small table, the rest is added inside the block. Settings or rankers that
    rank the same candidates share it."""
    counts = candidates.groupBy(*part, rel).agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*part).orderBy(F.col(rel).desc()))  # one row per relevance
    placed = counts.withColumn("_upto", upto).withColumn("_from", F.col("_upto") - F.col("_c"))
    gain = ndcg_gain(F.col(rel))
    blocks = discount_blocks(placed.agg(F.max("_upto").alias("most")))
    for end in ("_from", "_upto"):
        placed = placed.withColumn("_block", F.floor(F.col(end) / DISCOUNT_BLOCK)).join(blocks, "_block", "left") \
            .withColumn(f"{end}_sum", F.col("_before") + _discounts(F.col("_block") * DISCOUNT_BLOCK, F.col(end))).drop("_block", "_before")
    return placed.groupBy(*part).agg(
        F.sum(F.when(gain > 0, gain * (F.col("_upto_sum") - F.col("_from_sum"))).otherwise(0.0)).alias("idcg"))


def _discounts(start: Column, end: Column) -> Column:
    """Sum of the places' discounts ``1 / log2(place + 1)`` after ``start`` up to ``end``: at most one block."""
    places = F.when(end > start, F.sequence(start + 1, end)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(places, F.lit(0.0), lambda a, k: a + 1 / ndcg_discount(k))


def discount_blocks(most: DataFrame) -> DataFrame:
    """(_block, _before): the sum of all discounts before each block of ``DISCOUNT_BLOCK``
    places, up to the place ``most`` (one row)."""
    block = F.col("_block") * DISCOUNT_BLOCK
    blocks = most.where("most IS NOT NULL").select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("most") / DISCOUNT_BLOCK))).alias("_block"))
    sums = blocks.withColumn("_own", _discounts(block, block + DISCOUNT_BLOCK))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row per 4,096 places of the longest query
    return sums.select("_block", F.coalesce(F.sum("_own").over(before), F.lit(0.0)).alias("_before"))


def ndcg_from(dcg: DataFrame, idcg: DataFrame, part=("query_id",)) -> DataFrame:
    """R4 from per-group DCG and per-query IDCG (both small)."""
    j = dcg.join(idcg, list(part))
    return j.withColumn("ndcg", F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(F.lit(1.0)))


def mean_ndcg(per_query: DataFrame, part=()) -> DataFrame:
    """A10: mean over queries (per parameter setting when ``part`` is given)."""
    agg = [F.avg("ndcg").alias("mean_ndcg"), F.count(F.lit(1)).alias("n_queries")]
    return per_query.groupBy(*part).agg(*agg) if part else per_query.agg(*agg)


def ranking_completeness(ranked: DataFrame, expected: DataFrame, keys=("query_id", "page_id")) -> DataFrame:
    """One row with the number of expected pairs never ranked, ranked pairs not
    expected, and pairs ranked more than once (all 0 for a complete ranking)."""
    k = list(keys)
    there = lambda r, e: [F.lit(r).cast("long").alias("_r"), F.lit(e).cast("long").alias("_e")]
    pairs = ranked.select(*k, *there(1, 0)).unionByName(expected.select(*k, *there(0, 1)))
    counts = pairs.groupBy(*k).agg(F.sum("_r").alias("_r"), F.sum("_e").alias("_e"))
    unknown = F.lit(False)  # a null key equals no other
    for c in k:
        unknown = unknown | F.col(c).isNull()
    total = lambda n, where: F.coalesce(F.sum(F.when(where, F.col(n))), F.lit(0).cast("long"))
    return counts.agg(total("_e", unknown | (F.col("_r") == 0)).alias("missing"), total("_r", unknown | (F.col("_e") == 0)).alias("unexpected"),
                      F.count(F.when(F.col("_r") > 1, 1)).alias("duplicated"))


def query_result_counts(ranked: DataFrame, part=("query_id",)) -> DataFrame:
    """Pages per query (the output's line count is their sum plus one line per query)."""
    return ranked.groupBy(*part).agg(F.count(F.lit(1)).alias("n_pages"))
