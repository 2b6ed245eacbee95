"""Mixing sources to target weights by capped water-filling.

Every source has a size (its words), a weight, and a cap of ``max_epochs`` times its size.
The budget is dealt out by weight; a source above its cap is clamped to it and the excess
is dealt to the others by weight, until none is above. A source whose target is 2.3 times
its size is then taken twice whole, and a seeded 0.3 of it a third time.

The fractional repetition takes the documents in the order of a seeded hash of their ids
until the source's words reach the target (to within half a document). So each source has
one cut in that order: the sums of 4,096 buckets tell the one that holds it, and only
that bucket's documents are ordered, one row per (hash, id, size, text hash) with its count. A
document then knows its times from the row of its source alone: texts are neither ordered nor
grouped. Null or repeated ids share a hash, but are counted before they meet. Rows that are equal
in all of these and lie on the cut are numbered in blocks of 8,192 rows of a written table.

Defined results: a null, empty or blank text has size 0 and is never counted as words (it
still follows its place in the hash order for its repetitions); a null source is a source
of its own, the last one; rows that tie in hash, id, size and text are exchangeable;
repeated rows count each for itself; very long texts are read whole; a budget above the
sum of all caps gives every source its cap; an empty table gives an empty result. Input
columns are kept as a struct, so their names can't clash with computed ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table, words, written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Hex digits of the hash that name the bucket: 16 ** 3 = 4,096 buckets a source.
BUCKET_DIGITS = 3
#: Equal rows on a cut are numbered in blocks of 2 ** 13 rows.
BLOCK_BITS = 13


def cyclic_weights(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """``sources`` (one row each) with a weight: by code point of the name, null last,
    the given weights in turn. One row per source is ordered, never documents."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    return sources.withColumn("weight", F.element_at(cycle, (place % len(weights) + 1).cast("int")))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS, budget: int | None = None) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``: least(cap, level * weight)
    for the water level at which the targets sum to the budget (default: all sizes).

    Each round clamps the sources above their cap and raises the level for the others;
    only three sums come to the driver. The level never falls, so a clamped source stays
    so and the rounds end when no further source is clamped."""
    cap = F.col("source_size") * max_epochs
    total, weight = sources.agg(F.sum("source_size"), F.sum(F.when(cap > 0, F.col("weight")))).first()
    budget = (total or 0) if budget is None else budget
    level, clamped = (budget / weight if weight else 0.0), -1
    while True:
        above = cap <= F.lit(level) * F.col("weight")
        n, held, free = sources.where(cap > 0).agg(
            F.sum(above.cast("int")), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))).first()
        if not free or n == clamped:
            break
        level, clamped = (budget - (held or 0)) / free, n
    if weight and not free:
        return sources.withColumn("target", cap.cast("double"))
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(float(level)) * F.col("weight")))


def _targets(sums: DataFrame, max_epochs: int, weigh) -> DataFrame:
    """One row per source: key, source_size, target, ``whole`` repetitions, and the words of the
    ``extra`` one."""
    sources = written(weigh(sums.groupBy("key", "source").agg(F.sum("words").alias("source_size"))), "mix-sources")
    targets = water_fill(sources, max_epochs).select("key", "source_size", "target")
    targets = targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    return targets.withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))


def _cuts(sized: DataFrame, sums: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with the source's ``cut``, the last place whose rows get the extra repetition
    (null: none in its bucket), in ``cut_bucket``; ``cut_rows`` rows have that place and
    ``cut_taken`` of them get it."""
    before = F.sum("words").over(Window.partitionBy("key").orderBy("bucket")) - F.col("words")
    split = sums.select("key", "bucket", "words", before.alias("before")).join(targets.select("key", "extra"), "key")
    split = split.where((F.col("extra") > 0) & (F.col("before") <= F.col("extra")) & (F.col("extra") < F.col("before") + F.col("words")))
    inside = sized.join(split.drop("words"), ["key", "bucket"])
    same = inside.groupBy("key", "bucket", "extra", "before", "place").agg(F.count("*").alias("rows"))
    n, size = F.col("rows"), F.col("place.size")
    same = same.withColumn("upto", F.col("before") + F.sum(n * size).over(Window.partitionBy("key").orderBy("place")) - n * size)
    # the k-th of equal rows gets it where its middle, upto + k * size - size / 2, is within extra
    fits = lambda k: 2 * (F.col("upto") + k * size) - size <= 2 * F.col("extra")
    near = F.floor((2 * F.col("extra") - 2 * F.col("upto") + size) / (2 * F.greatest(size, F.lit(1))))
    k = near + F.when(fits(near + 1), 1).when(fits(near), 0).otherwise(-1)  # the division rounds
    taken = F.when(size == 0, F.when(fits(F.lit(0)), n).otherwise(0)).otherwise(F.greatest(F.lit(0), F.least(n, k)))
    same = same.withColumn("taken", taken.cast("long"))
    last = F.max_by(F.struct("place", "rows", "taken"), F.when(F.col("taken") > 0, F.col("place")))
    cuts = same.groupBy("key", "bucket").agg(last.alias("c"))
    return targets.join(cuts.select("key", F.col("bucket").alias("cut_bucket"), F.col("c.place").alias("cut"), F.col("c.rows").alias("cut_rows"),
                                    F.col("c.taken").alias("cut_taken")), "key", "left")


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: str = "",
        max_epochs: int = MAX_EPOCHS, weigh=cyclic_weights, size: Column | None = None, tie: Column | None = None) -> DataFrame:
    """One row per document: ``row`` (struct of all input columns), size, source_size,
    target (its source's) and ``times``, how often the mix takes the document. ``size`` and
    ``tie`` (a hash of the content) are taken from the text unless given."""
    name = F.col(f"`{source}`").cast("string")
    hashed = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))))
    sized = docs.select(
        F.struct("*").alias("row"), name.alias("source"), F.coalesce(F.concat(F.lit("s"), name), F.lit("n")).alias("key"),
        F.substring(hashed, 1, BUCKET_DIGITS).alias("bucket"),
        F.struct(hashed.alias("hash"), F.col(f"`{doc_id}`").alias("id"),
                 (F.size(words(F.col(f"`{text}`"))).cast("long") if size is None else size).alias("size"),
                 (F.xxhash64(F.col(f"`{text}`").cast("string")) if tie is None else tie).alias("tie")).alias("place"))
    places = written(sized.drop("row"), "mix-places")
    sums = written(places.groupBy("key", "source", "bucket").agg(F.sum("place.size").alias("words")), "mix-buckets")
    cuts = written(_cuts(places, sums, _targets(sums, max_epochs, weigh)), "mix-cuts")
    joined = sized.drop("source").join(cuts, "key")
    bucket, on_cut = F.col("bucket"), (F.col("bucket") == F.col("cut_bucket")) & (F.col("place") == F.col("cut"))
    more = (bucket < F.col("cut_bucket")) | ((bucket == F.col("cut_bucket")) & (F.col("place") <= F.col("cut")))
    out = lambda rows, once: rows.select(
        "row", "place.size", "source_size", "target", (F.col("whole") + F.when(once, 1).otherwise(0)).cast("long").alias("times"))
    torn = F.coalesce(on_cut & (F.col("cut_taken") < F.col("cut_rows")), F.lit(False))
    if cuts.where("cut_taken > 0 AND cut_taken < cut_rows").isEmpty():
        return out(joined, more)
    # equal rows on a cut, of which some get the extra repetition: numbered by blocks of a written table
    equal = written(joined.where(torn).withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)), "mix-equal")
    blocks = equal.groupBy("key", "block").agg(F.count("*").alias("n"))
    blocks = blocks.select("key", "block", (F.sum("n").over(Window.partitionBy("key").orderBy("block")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("key", "block").orderBy("place"))
    numbered = equal.withColumn("number", number).join(blocks, ["key", "block"])
    return out(joined.where(~torn), more).unionByName(out(numbered, F.col("before") + F.col("number") <= F.col("cut_taken")))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: the input's columns, each document as often as it is taken."""
    taken = mix(docs, **options).where("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("row.*")


def op9_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("row.doc_id", "row.source", "size", "source_size", "target",
                        (F.col("times") * F.col("size")).alias("taken"))


OP9_SQL = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 3 * source_size / weight::DOUBLE AS ratio,
         sum(3 * source_size) OVER o - 3 * source_size AS held, sum(weight) OVER o - weight AS gone
  FROM sources WHERE source_size > 0 WINDOW o AS (ORDER BY 3 * source_size / weight::DOUBLE, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
lvl AS (
  SELECT l AS level FROM (
    SELECT ((SELECT sum(source_size) FROM sources) - held)::DOUBLE / ((SELECT sum(weight) FROM filled) - gone)::DOUBLE AS l, ratio, held
    FROM filled) WHERE l <= ratio ORDER BY ratio, held LIMIT 1),
targets AS (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, (SELECT level FROM lvl) * weight) AS target FROM sources),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
ordered AS (
  SELECT doc_id, source, size,
         sum(size) OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM sized)
SELECT o.doc_id, o.source, o.size, p.source_size, p.target,
       (size * (whole + CASE WHEN target - whole * source_size > 0
                             AND 2 * upto - size <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered o JOIN parts p ON o.source IS NOT DISTINCT FROM p.source
"""
