"""Model parameters as immutable dataclasses.

They enter the plans as literals (folded by Catalyst) or, for sweeps, as rows of a
small parameter DataFrame that is cross joined (broadcast, row count known) after the
expensive features have been computed once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Union

from pyspark.sql import Column

# Field order used by every per-field parameter vector.
FIELDS = ("url", "title", "header", "body", "anchor")

# ---------------------------------------------------------------------------
# The parameter settings published with the reference's results.
#   cosine field weights      url -100, title -90, header -80, body -90, anchor -10
#   best cosine weights found url -1705, title -288, header -85, body -97, anchor -17
#   smallest-window boost     B = 16, function "inverse"; B swept over 2, 4, ..., 1024
#   BM25F logarithmic  B [1, .1, 1, 1, .1]  W [1, .9, .8, .9, .7]  K1 1    lambda 3   lambda' 2   lambda'' 1
#   BM25F sigmoid      B [1, .5, .5, .5, .1] W [1, .9, .8, .9, .7] K1 1.2  lambda 25  lambda' 1   lambda'' 0.5
#   BM25F saturation   B [1, 1, .5, .5, .1]  W [1, .9, .8, .9, .7] K1 1    lambda 25  lambda' 20  lambda'' 1
#   body length clamp  max(1000, body_length), missing body_length = 1
#   corpus size        number of documents + 1
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CosineWeights:
    url: float = -100.0
    title: float = -90.0
    header: float = -80.0
    body: float = -90.0
    anchor: float = -10.0

    def as_tuple(self) -> tuple[float, float, float, float, float]:
        return (self.url, self.title, self.header, self.body, self.anchor)


BEST_COSINE_WEIGHTS = CosineWeights(url=-1705.0, title=-288.0, header=-85.0, body=-97.0, anchor=-17.0)


@dataclass(frozen=True)
class WindowBoost:
    boost: float = 16.0
    function: str = "inverse"  # "inverse" | "sigmoid"; anything else gives boost 1


BOOST_GRID = tuple(float(2**i) for i in range(1, 11))  # 2, 4, ..., 1024
BOOST_FUNCTIONS = ("inverse", "sigmoid")

VfFunc = Callable[[Column, float, float], Column]


@dataclass(frozen=True)
class BM25FParams:
    B: tuple[float, float, float, float, float] = (1.0, 0.1, 1.0, 1.0, 0.1)
    W: tuple[float, float, float, float, float] = (1.0, 0.9, 0.8, 0.9, 0.7)
    K1: float = 1.0
    lamd: float = 3.0
    lamd_prime: float = 2.0
    lamd_prime2: float = 1.0
    # name of a built-in static-rank function, or a callable (pagerank, l1, l2) -> Column
    vf: Union[str, VfFunc] = field(default="logarithmic", compare=False)
    name: str = "logarithmic"


BM25F_LOGARITHMIC = BM25FParams()
BM25F_SIGMOID = BM25FParams(
    B=(1.0, 0.5, 0.5, 0.5, 0.1), K1=1.2, lamd=25.0, lamd_prime=1.0, lamd_prime2=0.5,
    vf="sigmoid", name="sigmoid",
)
BM25F_SATURATION = BM25FParams(
    B=(1.0, 1.0, 0.5, 0.5, 0.1), K1=1.0, lamd=25.0, lamd_prime=20.0, lamd_prime2=1.0,
    vf="saturation", name="saturation",
)
BM25F_SETTINGS = (BM25F_LOGARITHMIC, BM25F_SIGMOID, BM25F_SATURATION)


def cosine_weight_grid() -> tuple[CosineWeights, ...]:
    """Deterministic weight settings for the cosine sweep: the two published settings
    plus every setting that scales one field of the default by 1/4 or 4."""
    base = CosineWeights()
    out = [base, BEST_COSINE_WEIGHTS]
    for f in FIELDS:
        for scale in (0.25, 4.0):
            out.append(CosineWeights(**{**base.__dict__, f: getattr(base, f) * scale}))
    return tuple(out)


@dataclass(frozen=True)
class TfRule:
    """How a term count becomes a weight: divided by the clamped body length or not (M1), then
    1 + ln of it or itself (M2). Off means the value passes through unchanged."""
    normalize: bool = True
    logify: bool = True
