"""Scalar maths of the rankers and of NDCG, as Column expressions.

Divisions are guarded with ``when`` so that ANSI mode (on by default) never raises.
"""

from __future__ import annotations

from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "lit", "logify", "normalize", "boost_inverse", "boost_sigmoid", "window_boost",
    "vf_logarithmic", "vf_saturation", "vf_sigmoid", "vf", "bm25f_field_norm",
    "ndcg_gain", "ndcg_discount", "idf_expr",
]

Num = Union[Column, float, int]


def lit(x: Num) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def logify(x: Column) -> Column:
    """M2: ``1 + ln(x)`` if x > 0 else 0."""
    return F.when(x > 0, F.lit(1.0) + F.ln(x)).otherwise(F.lit(0.0))


def normalize(tf: Column, length: Column) -> Column:
    """M1: tf divided by the (clamped, hence >= 1000) body length."""
    return tf.cast("double") / length


def boost_inverse(boost: Num, qlen: Column, window: Column) -> Column:
    """M4: ``max(1, B * qlen / window)``."""
    return F.greatest(F.lit(1.0), lit(boost) * (qlen.cast("double") / window.cast("double")))


def boost_sigmoid(boost: Num, qlen: Column, window: Column) -> Column:
    """M5: ``max(1, B * (1 - 1 / (1 + exp(-(window - qlen)))))``."""
    x = (window - qlen).cast("double")
    return F.greatest(F.lit(1.0), lit(boost) * (F.lit(1.0) - F.lit(1.0) / (F.lit(1.0) + F.exp(-x))))


def window_boost(boost: Num, function: Union[str, Column], qlen: Column, window: Column) -> Column:
    """window == qlen -> B; no window -> 1; window > qlen -> boost function;
    window < qlen (repeated query terms) -> 1; unknown function -> 1."""
    fn = function if isinstance(function, Column) else F.lit(function)
    scaled = (
        F.when(fn == "inverse", boost_inverse(boost, qlen, window))
        .when(fn == "sigmoid", boost_sigmoid(boost, qlen, window))
        .otherwise(F.lit(1.0))
    )
    return (
        F.when(window.isNull(), F.lit(1.0))
        .when(window == qlen, lit(boost))
        .when(window > qlen, scaled)
        .otherwise(F.lit(1.0))
    )


def vf_logarithmic(pagerank: Column, l1: Num, l2: Num = 1.0) -> Column:
    """M6: ``ln(l1 + pr)`` if positive else 0."""
    v = lit(l1) + pagerank.cast("double")
    return F.when(v > 0, F.ln(v)).otherwise(F.lit(0.0))


def vf_saturation(pagerank: Column, l1: Num, l2: Num = 1.0) -> Column:
    """M7: ``pr / (l1 + pr)`` if the denominator is positive else 0."""
    den = lit(l1) + pagerank.cast("double")
    return F.when(den > 0, pagerank.cast("double") / den).otherwise(F.lit(0.0))


def vf_sigmoid(pagerank: Column, l1: Num, l2: Num = 1.0) -> Column:
    """M8: ``1 / (l1 + exp(-pr * l2))`` if the denominator is positive else 0."""
    den = lit(l1) + F.exp(-pagerank.cast("double") * lit(l2))
    return F.when(den > 0, F.lit(1.0) / den).otherwise(F.lit(0.0))


_VF = {"logarithmic": vf_logarithmic, "saturation": vf_saturation, "sigmoid": vf_sigmoid}


def vf(name_or_fn, pagerank: Column, l1: Num, l2: Num) -> Column:
    """Static-rank plug-in: a built-in name or a callable ``(pagerank, l1, l2) -> Column``."""
    fn = _VF[name_or_fn] if isinstance(name_or_fn, str) else name_or_fn
    return fn(pagerank, l1, l2)


def bm25f_field_norm(raw_tf: Column, b: Num, length: Column, avg: Column) -> Column:
    """M9: ``tf / (1 + B * (len / avg - 1))``; 0 when avg = 0 or the denominator is 0."""
    bp = F.lit(1.0) + lit(b) * (length.cast("double") / avg - F.lit(1.0))
    return F.when((avg == 0) | (bp == 0), F.lit(0.0)).otherwise(raw_tf.cast("double") / bp)


def ndcg_gain(rel: Column) -> Column:
    """``2 ** max(rel, 0) - 1``."""
    return F.pow(F.lit(2.0), F.greatest(rel.cast("double"), F.lit(0.0))) - F.lit(1.0)


def ndcg_discount(rank: Column) -> Column:
    """``log2(rank + 1)`` for a 1-based rank."""
    return F.log2(rank.cast("double") + F.lit(1.0))


def idf_expr(n_total: Column, df: Column) -> Column:
    """A2: ``ln(N) - ln(df + 1)`` with N = number of documents + 1, df = 0 if unknown."""
    return F.ln(n_total.cast("double")) - F.ln(F.coalesce(df, F.lit(0)).cast("double") + F.lit(1.0))
