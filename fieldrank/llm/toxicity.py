"""Toxicity scores from a counterfactual-regularised classifier.

The classifier is a logistic regression on the distinct words of a text, their prefixes and
their four-letter runs, hashed to ``2 ** BITS`` places; each place is scaled by its
naive-Bayes log ratio between the classes, places seen in fewer than ``MIN_DOCS`` training
texts are dropped. It is fitted on at most ``TRAIN_ROWS`` labelled rows (a documented bound;
chosen by a hash of the id, whatever the size of the corpus).

Identity terms must not decide: in every labelled text that mentions one, all its sentences
with the term are swapped to each other term of the same axis, and the loss is charged
``PENALTY`` times the mean squared change of the score. A group that happens to be
mentioned more often in toxic texts thus gets no weight of its own.

Fitting is a small numpy loop on the driver; scoring runs in Spark over every whole text,
the weights (one float a place, fixed size) travel with the function.

Defined results: a null, empty or wordless text gets the model's base score; held_out is
crc32(doc_id as text) mod 4 = 2 (a null id counts as the empty text and is never trained
on); labels of held-out ids, null labels and labels without a document are not used; without any usable
labels every score is 0.5; repeated rows get equal scores; very long texts are read whole.
Only id and text are read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sorted_distinct, table

BITS, TRAIN_ROWS, MIN_DOCS = 18, 3000, 5
L2, PENALTY, ROUNDS, RATE = 1e-3, 10.0, 200, 0.05
CUT = 0.3
#: A rare positive class counts at most so many times as much.
MOST_WEIGHT = 3.0
WORD = r"[^\W\d_]+"
CACHE_WORDS, BATCH_DOCS, BATCH_CHARS = 150_000, 500, 2_000_000

# Identity terms by axis; a term is swapped for the others of its axis.
IDENTITY_TERMS = {
    "religion": ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"],
    "origin": ["american", "european", "african", "asian", "mexican", "arab", "indian", "chinese", "german", "french", "spanish"],
    "gender": ["man", "woman", "transgender", "nonbinary"],
    "genders": ["men", "women"],
    "orientation": ["gay", "lesbian", "straight", "bisexual", "queer"],
    "skin": ["black", "white", "brown"],
    "ability": ["deaf", "blind", "disabled", "autistic"],
    "age": ["young", "old", "elderly"],
}


class WordFeatures(dict):
    """Word -> its number, with its hashed features."""

    def __init__(self, bits: int = BITS):
        self.mask = (1 << bits) - 1
        self.pattern = re.compile(WORD)
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.flat, self.size = array("i"), array("q")

    def __missing__(self, word: str) -> int:
        import xxhash

        s = f"^{word}$"
        grams = {word, s[:4], s[:5], s[:6], *(s[i:i + 4] for i in range(len(s) - 3))}
        self.flat.extend(xxhash.xxh3_64_intdigest(g) & self.mask for g in grams)
        self.size.append(len(grams))
        place = self[word] = len(self)
        return place

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, feature) pairs, each once, sorted."""
        found = [[self[w] for w in set(self.pattern.findall((t or "").lower()))] for t in texts]
        word = np.array([k for x in found for k in x], np.int64)
        doc = np.repeat(np.arange(len(texts)), [len(x) for x in found])
        flat, size = np.array(self.flat, np.int64), np.array(self.size, np.int64)
        start, n = np.cumsum(size) - size, size[word]
        upto = np.cumsum(n)
        feature = flat[np.repeat(start[word] - upto + n, n) + np.arange(upto[-1] if len(upto) else 0)]
        pairs = sorted_distinct(np.repeat(doc, n) * (self.mask + 1) + feature)
        if len(self) > CACHE_WORDS:
            self.reset()
        return pairs // (self.mask + 1), pairs & self.mask


def swaps(text: str | None, terms=None) -> list[str]:
    """The text with each identity term it mentions swapped, in all sentences that have it,
    for each other term of the axis."""
    out = []
    sentences = re.split(r"(?<=[.!?\n])", (text or "").lower())
    held = set(re.findall(WORD, (text or "").lower()))
    for axis in (IDENTITY_TERMS if terms is None else terms).values():
        for term in axis:
            if term in held:
                pattern = re.compile(rf"(?<![^\W\d_]){re.escape(term)}(?![^\W\d_])")
                out += ["".join(pattern.sub(other, s) for s in sentences) for other in axis if other != term]
    return out


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def fit(examples: list[tuple[list[int], float]], changes: list[tuple[list[int], list[int]]], bits: int = BITS,
        penalty: float = PENALTY) -> Model:
    """``examples``: (features, label); ``changes``: (features a swap adds, features it takes)."""
    dim = 1 << bits
    y = np.array([label for _, label in examples], float)
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return Model(np.zeros(dim, np.float32), float(np.log(rate / (1 - rate))))
    row = np.repeat(np.arange(len(y), dtype=np.int32), [len(f) for f, _ in examples])
    col = np.concatenate([np.asarray(f, np.int32) for f, _ in examples])
    ones, zeros = np.bincount(col, y[row], dim), np.bincount(col, 1 - y[row], dim)
    ratio = np.log((ones + 1) / (y.sum() + 2)) - np.log((zeros + 1) / (len(y) - y.sum() + 2))
    ratio[ones + zeros < MIN_DOCS] = 0
    used = ratio[col] != 0
    row, col = row[used], col[used]
    scale = ratio[col]
    crow = np.repeat(np.arange(len(changes)), [len(a) + len(b) for a, b in changes])
    ccol = np.array([f for a, b in changes for f in (*a, *b)], np.int64)
    csign = np.array([s for a, b in changes for s in [1.0] * len(a) + [-1.0] * len(b)]) * ratio[ccol] if len(ccol) else np.zeros(0)
    weight = np.where(y > 0, min(MOST_WEIGHT, max(1.0, (len(y) - y.sum()) / y.sum())), 1.0) / len(y)
    w, b, m, v = np.zeros(dim), 0.0, np.zeros(dim + 1), np.zeros(dim + 1)
    for k in range(1, ROUNDS + 1):
        p = 1 / (1 + np.exp(-(np.bincount(row, w[col] * scale, len(y)) + b)))
        g = (p - y) * weight
        grad = np.bincount(col, g[row] * scale, dim) + L2 * w
        if len(changes):
            moved = np.bincount(crow, w[ccol] * csign, len(changes))
            grad += 2 * penalty / len(changes) * np.bincount(ccol, moved[crow] * csign, dim)
        grad = np.append(grad, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        step = RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model((w * ratio).astype(np.float32), float(b))


def in_fold(doc_id: Column) -> Column:
    """True for held-out ids."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, rows: int) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents outside the held-out fold."""
    known = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("double").alias("label"))
    known = known.where(F.col("label").isNotNull() & F.col("id").isNotNull() & ~in_fold(F.col("id")))
    known = F.broadcast(known.orderBy(F.xxhash64(F.col("id").cast("string")), "id", "label").limit(rows))  # at most ``rows`` rows
    return docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).join(known, "id").select("text", "label")


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
          rows: int = TRAIN_ROWS, terms=None, penalty: float = PENALTY, bits: int = BITS) -> Model:
    def examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordFeatures(bits)
        for batch in batches:
            for first in range(0, len(batch), BATCH_DOCS):
                part = batch.iloc[first:first + BATCH_DOCS]
                swapped = [swaps(t, terms) for t in part["text"]]
                doc, feature = words.of([t for own, others in zip(part["text"], swapped, strict=True) for t in (own, *others)])
                sets = iter(np.split(feature, np.searchsorted(doc, np.arange(1, len(part) + sum(map(len, swapped))))))
                out = []
                for y, others in zip(part["label"], swapped, strict=True):
                    own, other = next(sets), [next(sets) for _ in others]
                    out.append((own.tolist(), y, [np.setdiff1d(f, own).tolist() for f in other], [np.setdiff1d(own, f).tolist() for f in other]))
                yield pd.DataFrame(out, columns=["f", "label", "plus", "minus"])

    chosen = training_rows(docs, labels, label, doc_id, text, rows)
    got = chosen.mapInPandas(examples, "f array<int>, label double, plus array<array<int>>, minus array<array<int>>") \
        .orderBy(F.xxhash64("f"), "label").limit(rows).collect()  # bounded by ``rows``
    return fit([(r["f"], r["label"]) for r in got], [c for r in got for c in zip(r["plus"], r["minus"], strict=True)], bits, penalty)


def scorer(model: Model, bits: int = BITS):
    """Column function: the model's probability for a text column."""
    weights, bias = model

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = WordFeatures(bits)
        for part in parts:
            texts, out, first = part.tolist(), [], 0
            while first < len(texts):
                last = chars = 0
                for last in range(first, min(first + BATCH_DOCS, len(texts))):
                    chars += len(texts[last] or "")
                    if chars > BATCH_CHARS:
                        break
                doc, feature = words.of(texts[first:last + 1])
                z = np.bincount(doc, weights[feature], last + 1 - first) + bias
                out.append(1 / (1 + np.exp(-z)))
                first = last + 1
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return score


def op2_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    score = scorer(train(docs, labels))
    return docs.select("doc_id", in_fold(F.col("doc_id")).alias("held_out"), F.round(score("text"), 9).alias("score")) \
        .withColumn("predicted", (F.col("score") >= CUT).cast("int"))
