"""Robust multivariate outliers: minimum covariance determinant per language and source.

Each document's text becomes a vector of transformed statistics (``VECTOR``). For every
group (language, source) the MCD estimate is found by concentration steps: take the share
``CORE`` of the group with the smallest Mahalanobis distances, estimate mean and covariance
from it, and repeat while the determinant falls. Three starts are tried (medians with median
absolute deviations, medians with equal spreads, mean and covariance of the whole group) and
the core of least determinant is kept; a last step re-estimates from all rows below the
cutoff.

One rule holds for groups of every size: the same estimate is made of each language and of
all documents, and a group of n documents is combined with its language's as n rows of its
own and ``PRIOR`` rows of the language's (the language's likewise with that of all). So a large
source is judged by itself alone and a single document by its language. A document is rejected
when its squared distance exceeds ``CUTOFF``. That is far beyond the chi-squared quantiles
(20.5 for 0.999): line and word repetitions of good texts have long tails, and clean documents
are to stay.

One concentration step is one grouped aggregation: rows are summed by (group, distance
rounded on a log scale), at most a few thousand rows a group, and a running sum over those
finds the core and its moments together. So a group that holds most of the corpus is
combined before the shuffle, and no group meets in one task. Covariances get the variance
floor ``FLOOR`` on the diagonal: statistics that are zero in nearly every document would
else have none. Distances come from the Cholesky factor by forward substitution, in
columns. All work is done by DataFrame expressions.

Defined results: null, empty and blank texts have no words (all statistics 0, base fails);
null language or source is a group of its own; a group none of whose documents passes the
base rules is not estimated (they are rejected anyway). Rows that repeat count each for
itself, rows of equal distance enter the core together; very long texts are read whole; an
empty table gives an empty result. Only id, text, language and source are read, other columns
are carried along (``judged``) in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, let, table, words, written

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Half of a group, as the usual MCD: junk in less than the other half stays out of the core.
CORE = 0.5
#: Rows that the estimate of a group's language counts as beside the group's own.
PRIOR = 200
#: Steps end when no logarithm of a determinant falls by more than this.
LEAST_FALL = 1e-3
#: Squared robust distance beyond which a document is an outlier (ten robust standard
#: deviations), and the variance floor.
CUTOFF, FLOOR = 100.0, 0.09
#: The median of the chi-squared distribution with as many degrees of freedom as VECTOR.
CHI2_MEDIAN = 4.351
#: Distances are ranked by log(1 + d2), rounded to so many digits.
GRID_DIGITS = 2
SALTS = 32
#: The group of all rows.
ALL = '{"level":0}'

VECTOR = {
    "x0": lambda c: F.log1p(c("n_words")),
    "x1": lambda c: 3 * F.log1p(c("word_chars") / F.greatest(c("n_words"), F.lit(1))),
    "x2": lambda c: F.log1p(100 * c("n_symbols") / F.greatest(c("n_words"), F.lit(1))),
    "x3": lambda c: F.log1p(c("n_dup_lines")),
    "x4": lambda c: F.log1p(100 * c("n_repeat_words") / F.greatest(c("n_words"), F.lit(1))),
}
P = len(VECTOR)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def repeat_words(w: Column) -> Column:
    """Words covered by three-word windows that occur twice or more, given the words.

    Windows are sorted with their places; those equal to a neighbour repeat. Texts without
    two equal windows (by hash, so none is missed) skip the sort."""
    places = F.sequence(F.lit(0), F.size(w) - 3)
    hashes = F.transform(places, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def starts(s):
        twice = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["g"] == x["g"], F.lit(False))
                         | F.coalesce(F.get(s, k + 1)["g"] == x["g"], F.lit(False)))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    window = lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("i"))
    covered = F.aggregate(
        let(F.sort_array(F.transform(places, window)), starts), F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    some = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(w) < 4, 0).when(some, covered).otherwise(0)


def statistics(text: Column) -> Column:
    """Struct of the five base statistics of a whole text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeat_words(w).cast("long").alias("n_repeat_words")))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _levels() -> Column:
    """The groups that a row counts in: its (lang, source), its language, all rows."""
    lang, source = F.col("lang"), F.col("source")
    return F.array(F.to_json(F.struct(F.lit(2).alias("level"), lang, source)),
                   F.to_json(F.struct(F.lit(1).alias("level"), lang)), F.lit(ALL))


def _with_distance(rows: DataFrame, shape: DataFrame, how: str = "inner") -> DataFrame:
    """``d2`` of each row from its group's mean m* and Cholesky factor l*_*, once per start
    of the group. The shapes are repeated for each salt, so the rows of a large group meet in
    ``SALTS`` tasks."""
    salted = shape.withColumn("salt", F.explode(F.array(*[F.lit(k) for k in range(SALTS)])))
    out = rows.join(salted, ["group", "salt"], how)
    for i in range(P):
        z = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            z = z - F.col(f"l{i}_{j}") * F.col(f"z{j}")
        out = out.withColumn(f"z{i}", z / F.col(f"l{i}_{i}"))
    return out.withColumn("d2", sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, P)), F.col("z0") * F.col("z0")))


def _moments() -> list[Column]:
    return [F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(P)],
            *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in PAIRS]]


MEANS = [f"m{i}" for i in range(P)]
COVARIANCES = [f"c{i}_{j}" for i, j in PAIRS]
FACTORS = [f"l{i}_{j}" for i, j in PAIRS]


def _factored(out: DataFrame) -> DataFrame:
    """With the Cholesky factor of the covariance, and the logarithm of its determinant."""
    for i in range(P):
        for j in range(i + 1):
            rest = F.col(f"c{i}_{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            out = out.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(rest, F.lit(FLOOR / 10))) if i == j else rest / F.col(f"l{j}_{j}"))
    return out.withColumn("logdet", 2 * sum((F.log(f"l{i}_{i}") for i in range(1, P)), F.log("l0_0")))


def _shape(sums: DataFrame, *keys: str) -> DataFrame:
    """Mean, covariance with the floor added, and factor from the sums."""
    out = sums
    for i in range(P):
        out = out.withColumn(f"m{i}", F.round(F.col(f"s{i}") / F.col("n"), 9))
    for i, j in PAIRS:
        cov = F.round(F.col(f"s{i}_{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"), 9)
        out = out.withColumn(f"c{i}_{j}", F.greatest(cov, F.lit(0.0)) + FLOOR if i == j else cov)
    return _factored(out).select(*keys, *MEANS, *COVARIANCES, *FACTORS, "logdet")


def _starts(rows: DataFrame) -> DataFrame:
    """(group, start, m*, l*_*): medians with a diagonal of median absolute deviations,
    medians with equal spreads, mean and covariance of all rows. Values are rounded to the
    grid before the medians, so that the exact percentile keeps a bounded map per group."""
    middle = written(rows.groupBy("group").agg(*[F.percentile(F.round(f"x{i}", GRID_DIGITS), 0.5).alias(f"m{i}") for i in range(P)]), "medians")
    middles = middle.withColumn("salt", F.explode(F.array(*[F.lit(k) for k in range(SALTS)])))
    spread = rows.join(middles, ["group", "salt"]).groupBy("group").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(P)],
        *[F.percentile(F.round(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), GRID_DIGITS), 0.5).alias(f"d{i}") for i in range(P)])
    diagonal = [(F.sqrt(F.pow(1.4826 * F.col(f"d{i}"), 2) + FLOOR) if i == j else F.lit(0.0)).alias(f"l{i}_{j}") for i, j in PAIRS]
    equal = [F.lit(float(i == j)).alias(f"l{i}_{j}") for i, j in PAIRS]
    whole = _shape(rows.groupBy("group").agg(*_moments()), "group")
    return written(spread.select("group", F.lit(0).alias("start"), *MEANS, *diagonal)
                   .unionByName(middle.select("group", F.lit(1).alias("start"), *MEANS, *equal))
                   .unionByName(whole.select("group", F.lit(2).alias("start"), *MEANS, *FACTORS)), "mcd-starts")


def _concentrated(rows: DataFrame, shape: DataFrame) -> DataFrame:
    """Shape of the core: the share CORE of each group with the smallest distances."""
    rung = F.round(F.log1p("d2"), GRID_DIGITS)
    rungs = _with_distance(rows, shape.select("group", "start", *MEANS, *FACTORS)).groupBy("group", "start", rung.alias("rung")).agg(*_moments())
    upto = Window.partitionBy("group", "start").orderBy("rung")
    totals = rungs.withColumn("before", F.sum("n").over(upto) - F.col("n")) \
        .withColumn("all", F.sum("n").over(Window.partitionBy("group", "start"))).where(F.col("before") < CORE * F.col("all"))
    sums = [c for c in rungs.columns if c not in ("group", "start", "rung")]
    return _shape(totals.groupBy("group", "start").agg(*[F.sum(c).alias(c) for c in sums]), "group", "start")


def _least(rows: DataFrame) -> DataFrame:
    """The core of least determinant of each group, over all starts and steps. A start goes on
    while its determinant falls; determinants have a floor, so all end. One small table per
    step is written, with a row per group and start still open."""
    seen = now = written(_concentrated(rows, _starts(rows)), "mcd-step")
    while not now.isEmpty():
        last = now.select("group", "start", F.col("logdet").alias("last"))
        after = written(_concentrated(rows, now).join(last, ["group", "start"]), "mcd-step")
        now = after.where(F.col("logdet") < F.col("last") - LEAST_FALL).drop("last")
        seen = seen.unionByName(now)
    best = seen.groupBy("group").agg(F.min_by(F.struct(*[c for c in seen.columns if c != "group"]), F.struct("logdet", "start")).alias("b"))
    return written(best.select("group", "b.*").drop("start", "logdet"), "mcd-core")


def mcd_shapes(rows: DataFrame) -> DataFrame:
    """Reweighted MCD estimate (m*, c*_*, l*_*) of each ``group`` of ``rows`` (group, salt,
    x0, x1, ...), and its number of rows."""
    shape = _least(rows)
    # the core's spread is too small for the whole group: its median distance tells by how much
    scale = _with_distance(rows, shape).groupBy("group").agg(
        F.count("*").alias("members"), (F.expm1(F.percentile(F.round(F.log1p("d2"), GRID_DIGITS), 0.5)) / CHI2_MEDIAN).alias("scale"))
    scaled = written(shape.join(scale, "group"), "mcd-scale")
    inside = _with_distance(rows, scaled).where(F.col("d2") <= CUTOFF * F.greatest(F.col("scale"), F.lit(1.0)))
    return written(_shape(inside.groupBy("group").agg(*_moments()), "group").drop("logdet").join(scaled.select("group", "members"), "group"), "mcd")


def _combined(shapes: DataFrame, above: DataFrame) -> DataFrame:
    """``shapes`` (with ``over``, the group above) as the mean and covariance of ``members`` rows
    of their own estimate and ``PRIOR`` rows of that of the group above."""
    names = [*MEANS, *COVARIANCES]
    top = above.select(F.col("group").alias("over"), *[F.col(c).alias(f"o_{c}") for c in names])
    both = shapes.join(top, "over").withColumn("w", F.col("members") / (F.col("members") + PRIOR))
    v = 1 - F.col("w")
    gap = [F.col(f"m{i}") - F.col(f"o_m{i}") for i in range(P)]
    means = [(F.col("w") * F.col(m) + v * F.col(f"o_{m}")).alias(m) for m in MEANS]
    covs = [(F.col("w") * F.col(f"c{i}_{j}") + v * F.col(f"o_c{i}_{j}") + F.col("w") * v * gap[i] * gap[j]).alias(f"c{i}_{j}") for i, j in PAIRS]
    return _factored(both.select("group", "members", *means, *covs)).select("group", "members", *MEANS, *COVARIANCES, *FACTORS)


def group_shapes(rows: DataFrame) -> DataFrame:
    """Final shape of each (lang, source) of ``rows`` (lang, source, salt, x0, ...)."""
    groups = _levels()
    leveled = written(rows.select(F.explode(groups).alias("group"), "salt", *VECTOR), "vectors")
    names = written(rows.select("lang", "source").distinct(), "groups").select(
        groups[0].alias("group"), groups[1].alias("language"))
    shapes = mcd_shapes(leveled)
    languages = shapes.join(names.select(F.col("language").alias("group"), F.lit(ALL).alias("over")).distinct(), "group")
    languages = written(_combined(languages, shapes.where(F.col("group") == ALL)), "languages")
    return written(_combined(shapes.join(names.withColumnRenamed("language", "over"), "group"), languages).drop("members"), "shapes")


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document: ``row`` (struct of the input columns but the text), the base
    statistics, base_failed, distance2 (null where the group isn't estimated) and kept."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    read = docs.select(F.struct(*rest).alias("row"),
                       F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{source}`").cast("string").alias("source"),
                       statistics(F.col(f"`{text}`")).alias("s"))
    rows = written(read.select("row", "lang", "source", "s.*"), "statistics")
    rows = rows.withColumn("base_failed", base_failed())
    rows = rows.withColumns({k: f(F.col) for k, f in VECTOR.items()})
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    shapes = group_shapes(rows.where(~F.col("base_failed")))
    measured = _with_distance(rows.withColumn("group", _levels()[0]), shapes, "left")
    return measured.select("row", *STATS, "base_failed", F.col("d2").alias("distance2"),
                           (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= CUTOFF)).alias("kept"))


def op4_outliers(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return judged(docs).select("row.doc_id", *STATS, "base_failed", "kept", F.round("distance2", 6).alias("distance2"))
