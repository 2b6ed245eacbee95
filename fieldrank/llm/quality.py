"""Quality scores: document classifier combined with host and path posteriors.

A logistic regression on a text's shape (``shape``: length, letters, marks, symbols,
repetition) gives each document a probability p of being good. It is fitted on at most
``TRAIN_ROWS`` labelled rows (a documented bound; chosen by a hash of the id).

Sites lend evidence to one another by hierarchical empirical Bayes. With the corpus mean m
as the global prior, a host with n documents has the posterior mean
(sum p + k m) / (n + k), and a path of the host the same with the host's posterior as its
prior. The prior weight k of each level is estimated from the data by moments: the spread
of the means between sites against the spread within them. Sparse sites thus shrink toward
the level above. A document's own p is left out of its site's sums. The score is p with its
odds multiplied by those of the path's posterior over the corpus mean's; the shift of the
log-odds is held within ``MOST_SHIFT``, so a site alone rejects no clear document.

Sums are grouped aggregations with partial sums before the shuffle; only (host, path,
n, sum p, sum p squared) rows are joined back. In documents without an address the source
stands for the host and source and language for the path.

Defined results: null, empty and wordless texts have the shape of zeros and are scored so;
null host or path is a site of its own; labels that are null or without a document are not
used; without labels of both classes every p is the share of good labels; a site with one document
has its prior; repeated rows count each for itself; very long texts are read whole; an
empty table gives an empty result.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sorted_distinct, table, written

TRAIN_ROWS = 4000
#: A document is rejected below CUT: only clear cases go.
CUT, MOST_SHIFT, MOST_WEIGHT = 0.2, 2.0, 1000.0
L2, ROUNDS, RATE = 1e-3, 400, 0.05
SYMBOLS, MARKS = "#*$%&|<>~^@_=+\\/{}[]!", ".,;:?"
CACHE_CHUNKS = 50_000
SHAPE = ("log_words", "word_length", "letters", "upper", "digits", "symbols", "marks", "no_letter", "distinct", "repeated_lines", "repeated_runs")


class Chunks(dict):
    """Chunk between white space -> its number; counts of its characters by kind."""

    def __init__(self):
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.counts = array("i")

    def __missing__(self, chunk: str) -> int:
        letters = sum(map(str.isalpha, chunk))
        self.counts.extend((len(chunk), letters, sum(map(str.isupper, chunk)), sum(map(str.isdigit, chunk)),
                            sum(map(SYMBOLS.__contains__, chunk)), sum(map(MARKS.__contains__, chunk)), letters == 0))
        place = self[chunk] = len(self)
        return place


def shape(texts: list[str | None], chunks: Chunks) -> np.ndarray:
    """One row of SHAPE for each text."""
    out = np.zeros((len(texts), len(SHAPE)))
    for k, text in enumerate(texts):
        found = (text or "").split()
        if not found:
            continue
        at = np.fromiter(map(chunks.__getitem__, found), np.int64, len(found))
        counts = np.frombuffer(chunks.counts, np.int32).reshape(-1, 7)[at].sum(axis=0, dtype=np.int64)
        chars, letters, upper, digits, symbols, marks, bare = counts.tolist()
        n = len(found)
        lines = [x for x in text.split("\n") if x.strip()]
        runs = sorted_distinct(at[:-2] * 1_000_003 * 1_000_003 + at[1:-1] * 1_000_003 + at[2:]) if n > 2 else at
        out[k] = (np.log1p(n), chars / n, letters / chars, upper / max(letters, 1), digits / chars, np.log1p(100 * symbols / n),
                  np.log1p(10 * marks / n), bare / n, len(sorted_distinct(at)) / n, 1 - len(set(lines)) / max(len(lines), 1),
                  1 - len(runs) / max(n - 2, 1) if n > 2 else 0)
        if len(chunks) > CACHE_CHUNKS:
            chunks.reset()
    return out


class Model(NamedTuple):
    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-((x - self.middle) / self.spread @ self.weights + self.bias)))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Logistic regression on standardised columns; the rarer class counts as much as the other."""
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return Model(np.zeros(len(SHAPE)), np.ones(len(SHAPE)), np.zeros(len(SHAPE)), float(np.log(rate / (1 - rate))))
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - middle) / spread
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w, b, m, v = np.zeros(z.shape[1]), 0.0, np.zeros(z.shape[1] + 1), np.zeros(z.shape[1] + 1)
    for k in range(1, ROUNDS + 1):
        g = (1 / (1 + np.exp(-(z @ w + b))) - y) * weight
        grad = np.append(g @ z + L2 * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        step = RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model(middle, spread, w, float(b))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
          rows: int = TRAIN_ROWS) -> Model:
    known = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("double").alias("label")) \
        .where("label IS NOT NULL AND id IS NOT NULL")
    known = F.broadcast(known.orderBy(F.xxhash64(F.col("id").cast("string")), "id", "label").limit(rows))  # at most ``rows`` rows
    chosen = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).join(known, "id")

    def shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunks = Chunks()
        for batch in batches:
            yield pd.DataFrame({"x": list(shape(batch["text"].tolist(), chunks)), "y": batch["label"]})

    got = chosen.select("text", "label").mapInPandas(shapes, "x array<double>, y double").orderBy(F.xxhash64("x"), "y").limit(rows).collect()
    return fit(np.array([r["x"] for r in got]).reshape(-1, len(SHAPE)), np.array([r["y"] for r in got]))


def scorer(model: Model):
    """Column function: the probability of a text column."""

    @F.pandas_udf("double")
    def probability(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        chunks = Chunks()
        for part in parts:
            texts = part.tolist()
            yield pd.Series(model.probability(shape(texts, chunks)))

    return probability


def _prior_weight(sites: DataFrame, mean: Column) -> float:
    """k of a level by moments; ``sites`` has n, s (sum p), q (sum p squared), and ``mean``
    is the prior mean. k = within / between, held within [1, MOST_WEIGHT]."""
    own = F.col("s") / F.col("n")
    r = sites.where("n > 1").agg(F.count("*"), F.sum("n"), F.sum(F.col("q") - F.col("n") * own * own), F.sum(F.col("n") * (own - mean) * (own - mean))).first()
    groups, n, inside, outside = (float(x or 0) for x in r)
    if groups < 2 or n <= groups:
        return MOST_WEIGHT
    within = inside / (n - groups)
    between = max((outside - groups * within) / n, 1e-9)
    return round(min(max(within / between, 1.0), MOST_WEIGHT), 6)


def combined(scored: DataFrame) -> DataFrame:
    """``scored`` (host, path, p and other columns) with host_prior, path_prior and score."""
    paths = written(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")), "paths")
    hosts = written(paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")]), "hosts")
    n, s = hosts.agg(F.sum("n"), F.sum("s")).first()
    mean = min(max(round((s or 0.0) / n, 9), 1e-6), 1 - 1e-6) if n else 0.5
    k_host = _prior_weight(hosts, F.lit(mean))
    above = hosts.select(F.col("host").alias("h"), F.col("n").alias("hn"), F.col("s").alias("hs"))
    sites = paths.join(above, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    sites = sites.withColumn("host_mean", (F.col("hs") + k_host * mean) / (F.col("hn") + k_host))
    k_path = _prior_weight(sites, F.col("host_mean"))
    sites = sites.select(F.col("host").alias("h"), F.col("path").alias("d"), "n", "s", "hn", "hs")
    out = scored.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("d"))).drop("h", "d")
    others = lambda s, n, prior, k: (F.col(s) - F.col("p") + k * prior) / (F.col(n) - 1 + k)  # noqa: E731  without the document itself
    within = lambda x: F.least(F.greatest(x, F.lit(1e-6)), F.lit(1 - 1e-6))
    odds = lambda x: F.log(within(x) / (1 - within(x)))
    out = out.withColumn("host_prior", F.round(others("hs", "hn", F.lit(mean), k_host), 9))
    out = out.withColumn("path_prior", F.round(others("s", "n", F.col("host_prior"), k_path), 9))
    shift = F.greatest(F.least(odds(F.col("path_prior")) - float(np.log(mean / (1 - mean))), F.lit(MOST_SHIFT)), F.lit(-MOST_SHIFT))
    return out.withColumn("score", F.round(1 / (1 + F.exp(-(odds(F.col("p")) + shift))), 6)).drop("n", "s", "hn", "hs")


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", host: Column | None = None,
           path: Column | None = None) -> DataFrame:
    """One row per document: doc_id, row_hash (of id, text, host and path), host, path, p,
    host_prior, path_prior, score and kept."""
    host = F.col("source").cast("string") if host is None else host
    path = F.concat_ws("/", F.col("source").cast("string"), F.col("lang").cast("string")) if path is None else path
    p = scorer(train(docs, labels, doc_id=doc_id, text=text))
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body, host, path).alias("row_hash"), host.alias("host"),
                       path.alias("path"), F.round(p(body), 9).alias("p"))
    return combined(written(rows, "evidence")).withColumn("kept", F.col("score") >= CUT)


def good(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that the classifier keeps, with their columns."""
    keep = scored(docs, labels, text, doc_id).where("kept").select(F.col("doc_id").alias("kid"), "row_hash")
    path = F.concat_ws("/", F.col("source").cast("string"), F.col("lang").cast("string"))
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{doc_id}`").alias("id"),
                       F.xxhash64(F.col(f"`{text}`").cast("string"), F.col("source").cast("string"), path).alias("hash"))
    return rows.join(keep, rows["id"].eqNullSafe(keep["kid"]) & (rows["hash"] == keep["row_hash"]), "left_semi").select("row.*")


def op5_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return scored(docs, table(spark, sf_dir, "labels")).drop("row_hash")
