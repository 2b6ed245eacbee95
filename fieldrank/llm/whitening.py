"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Entries become integers x = floor(1024 c) + 100000. With n vectors and sums S, the integer
scatter n^2 V = n sum(x x') - S S' is exact: tasks sum products of entries as integers, Spark
sums those as decimals, and the driver holds one matrix of the number of components squared.

1. **Polynomial.** Modulo primes below 2^31, side by side in each task of a small Spark job,
   the scatter is brought to Hessenberg form by similarity and its characteristic polynomial
   follows by the recurrence over the leading blocks. Chinese remaindering joins the
   residues; there are enough primes for Maclaurin's bound on the coefficients.
2. **Roots.** All roots are real and not negative, so the number of roots above a point is
   the number of sign changes in the coefficients shifted there (Budan's count, exact for real
   roots, with multiplicity). Each of the largest roots is isolated by halving in
   integers until its interval is 2^-``ROOT_BITS`` of it.
3. **Components.** (scatter - root) is eliminated with pivots in fixed point of ``FRACTION``
   bits and solved a few times from a fixed start (inverse iteration in the null space);
   each vector is kept orthogonal to the earlier ones, so equal roots give a basis of
   their space. Then everything is rounded to doubles once.

The covariance of the whitened vectors is measured in a second pass over all vectors.

Defined results: vectors that are null, empty or hold null, non-finite or too large entries
(2^52 or more: their x may not fit a long) are dropped, and so are those of another length than most have (of the longest of equally frequent ones);
components whose variance is zero don't exist, so constant or few vectors give fewer
components, one vector or an empty table no row; a ``deviation`` beyond a long is null there
and whole in ``deviation_exact`` (38 digits; null beyond them); repeated rows and rows
without an id count each; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
PRIMES_PER_TASK = 16
ROOT_BITS, FRACTION, SOLVES = 120, 320, 3
#: Entries from here on are dropped (their x may not fit a long). Bits of the parts in which sums travel.
LARGEST, LIMB = 2.0**52, 60
OUT = "vec_id long, component int, n long, deviation_exact decimal(38,0), whitened double, explained double"


def finite(vector: Column) -> Column:
    """Whether a vector has entries, and all are numbers whose x is a long."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST)
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, number), F.lit(False))


def fit_list(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x array<double>: the raw entries) of the vectors that remain, and their length."""
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("c")).where(finite(F.col("c")))
    lengths = rows.groupBy(F.size("c").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()  # one row per length
    dim = lengths["dim"] if lengths else 0
    return rows.where(F.size("c") == dim), dim


def integers(batch: pa.Array, dim: int) -> np.ndarray:
    """x - ``SHIFT`` of a batch."""
    return np.floor(SCALE * batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)).astype(np.int64)


def _moments(dim: int):
    """A task's number of rows (-1, -1), sums of entries (i, -1) and of products (i, j <= i), exact:
    in parts of ``LIMB`` bits, so that they add up in Spark whatever their size."""
    def parts(i: int, j: int, value: int) -> Iterator[tuple[int, int, int, int]]:
        limb = 0
        while value not in (0, -1):
            yield i, j, limb, value & ((1 << LIMB) - 1)
            value, limb = value >> LIMB, limb + 1
        if value:
            yield i, j, limb, value

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products, n = np.zeros(dim, object), np.zeros((dim, dim), object), 0
        for batch in batches:
            y = integers(batch.column(0), dim)
            if not len(y):
                continue
            n += len(y)
            most = max(1, int(y.max()), -int(y.min()))
            step = min(2**53 // most**2, 1 << 16)  # products of so many rows add up exactly in doubles
            if step:
                for part in (y[k:k + step].astype(np.float64) for k in range(0, len(y), step)):
                    products += (part.T @ part).astype(np.int64)
            else:
                products += y.astype(object).T @ y.astype(object)
            sums += y.sum(axis=0) if step else y.astype(object).sum(axis=0)
        i, j = np.tril_indices(dim)
        cells = [(-1, -1, n), *((a, -1, s) for a, s in enumerate(sums)), *zip(i.tolist(), j.tolist(), products[i, j], strict=True)]
        found = [x for a, b, v in cells for x in parts(a, b, int(v))]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), [pa.int32()] * 3 + [pa.int64()], strict=True)],
                                             names=["i", "j", "limb", "v"])
    return task


def scatter(rows: DataFrame, dim: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums S of x, and n^2 V as a matrix of Python integers."""
    found = rows.select("c").mapInArrow(_moments(dim), "i int, j int, limb int, v long").groupBy("i", "j", "limb") \
        .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()  # a few numbers per pair of components
    moments: dict[tuple[int, int], int] = {}
    for r in found:
        moments[r.i, r.j] = moments.get((r.i, r.j), 0) + (int(r.v) << (LIMB * r.limb))
    n = moments[-1, -1]
    y = [moments.get((i, -1), 0) for i in range(dim)]
    m = np.array([[n * moments.get((max(i, j), min(i, j)), 0) - y[i] * y[j] for j in range(dim)] for i in range(dim)], object)
    return n, [s + n * SHIFT for s in y], m  # a shift of x leaves the covariance as it is


def primes(count: int) -> list[int]:
    """The largest primes below 2^31, by Fermat's and Euler's tests to the bases that decide up to 3.2e9."""
    def prime(p: int) -> bool:
        d, s = p - 1, 0
        while d % 2 == 0:
            d, s = d // 2, s + 1
        return all((x := pow(a, d, p)) in (1, p - 1) or any((x := x * x % p) == p - 1 for _ in range(s - 1)) for a in (2, 3, 5, 7))
    out, p = [], 2**31 - 1
    while len(out) < count:
        if prime(p):
            out.append(p)
        p -= 2
    return out


def polynomials(m: np.ndarray, mods: list[int]) -> np.ndarray:
    """Coefficients (of x^0 on, the last is 1) of the characteristic polynomial modulo each prime."""
    dim, p = len(m), np.array(mods, np.int64)
    h = np.array([(m % q).astype(np.int64) for q in mods])
    which, q = np.arange(len(mods)), p[:, None]
    for k in range(dim - 2):
        # similarity: a pivot that isn't zero goes to row k + 1, then the rows below are cleared
        pivot = k + 1 + (h[:, k + 1:, k] != 0).argmax(axis=1)
        for axis in (1, 2):
            a = h[which, pivot].copy() if axis == 1 else h[which, :, pivot].copy()
            if axis == 1:
                h[which, pivot], h[:, k + 1] = h[:, k + 1].copy(), a
            else:
                h[which, :, pivot], h[:, :, k + 1] = h[:, :, k + 1].copy(), a
        inverse = np.array([pow(int(v), -1, w) if v else 0 for v, w in zip(h[:, k + 1, k], mods, strict=True)], np.int64)
        factor = h[:, k + 2:, k] * inverse[:, None] % q
        h[:, k + 2:] = (h[:, k + 2:] - factor[:, :, None] * h[:, None, k + 1] % q[:, :, None]) % q[:, :, None]
        for r in range(dim - k - 2):
            h[:, :, k + 1] = (h[:, :, k + 1] + factor[:, r, None] * h[:, :, k + 2 + r]) % q
    chain = [np.zeros((len(mods), dim + 1), np.int64)]
    chain[0][:, 0] = 1
    for k in range(dim):
        now = (np.roll(chain[k], 1, axis=1) - h[:, k, k, None] * chain[k]) % q
        below = np.ones(len(mods), np.int64)
        for i in range(k - 1, -1, -1):
            below = below * h[:, i + 1, i] % p
            now = (now - (h[:, i, k] * below % p)[:, None] * chain[i]) % q
        chain.append(now)
    return chain[dim]


def characteristic(spark, m: np.ndarray) -> list[int]:
    """Integer coefficients (of x^0 on) of det(x - m); ``m`` symmetric, no root negative."""
    dim, trace = len(m), int(sum(m.diagonal()))
    bound = max(math.comb(dim, k) * (trace**k // dim**k + 1) for k in range(dim + 1))  # Maclaurin: e_k <= C(dim, k) (trace / dim)^k
    mods = primes(bound.bit_length() // 30 + 2)
    rows = m.tolist()

    def task(batches):
        for batch in batches:
            own = [mods[k] for g in batch.column(0).to_pylist() for k in range(g * PRIMES_PER_TASK, min(len(mods), (g + 1) * PRIMES_PER_TASK))]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(list(polynomials(np.array(rows, object), own)), pa.list_(pa.int64()))], names=["p", "r"])

    groups = math.ceil(len(mods) / PRIMES_PER_TASK)
    found = spark.range(0, groups, 1, groups).mapInArrow(task, "p long, r array<long>").collect()  # (dim + 1) numbers per prime
    value, modulus = [0] * (dim + 1), 1
    for row in found:
        inverse = pow(modulus, -1, row.p)
        value = [v + modulus * ((r - v) * inverse % row.p) for v, r in zip(value, row.r, strict=True)]
        modulus *= row.p
    return [v - modulus if 2 * v > modulus else v for v in value]


def roots_above(poly: list[int], num: int, bits: int) -> int:
    """Number of roots above num / 2^bits of a polynomial with real roots only: sign changes
    of the coefficients shifted there (times a power of two, which changes no sign)."""
    dim = len(poly) - 1
    c = [v << (bits * (dim - k)) for k, v in enumerate(poly)]  # 2^(bits dim) p(y / 2^bits) in y, then y = num + z
    for k in range(dim):
        for i in range(dim - 1, k - 1, -1):
            c[i] += num * c[i + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(poly: list[int], count: int) -> list[tuple[int, int]]:
    """The largest positive roots, falling and with multiplicity, as (num, bits): each within
    2^-ROOT_BITS of itself above num / 2^bits."""
    top = max(2, -poly[-2] if len(poly) > 1 else 0).bit_length()  # the sum of the roots is above each
    known: dict[tuple[int, int], int] = {}

    def above(num: int, bits: int) -> int:
        if (num, bits) not in known:
            known[num, bits] = roots_above(poly, num, bits)
        return known[num, bits]

    out = []
    for k in range(1, min(count, above(0, 0)) + 1):
        low, high, bits = 0, 1 << top, 0
        while low == 0 or (high - low) << ROOT_BITS > low:
            if (low + high) % 2:
                low, high, bits = 2 * low, 2 * high, bits + 1
            middle = (low + high) // 2
            if above(middle, bits) >= k:
                low = middle
            else:
                high = middle
            while bits and low % 2 == high % 2 == 0:
                low, high, bits = low // 2, high // 2, bits - 1
        out.append((low, bits))
    return out


def eigenvectors(m: np.ndarray, roots: list[tuple[int, int]]) -> np.ndarray:
    """Unit vectors of the roots, one per row, rounded to doubles."""
    dim, out = len(m), []
    down = np.frompyfunc(lambda v: v >> FRACTION, 1, 1)
    scale = max(1, int(sum(m.diagonal())).bit_length())  # entries are brought to size 1
    for number, (num, bits) in enumerate(roots):
        root = (num << FRACTION) >> (bits + scale) if bits + scale < FRACTION * 4 else 0
        lu = np.array([[(int(v) << FRACTION) >> scale for v in row] for row in m], object)
        lu[range(dim), range(dim)] -= root
        rows = list(range(dim))
        for k in range(dim):
            pivot = max(range(k, dim), key=lambda r: abs(lu[r, k]))
            if pivot != k:
                lu[[k, pivot]], rows[k], rows[pivot] = lu[[pivot, k]], rows[pivot], rows[k]
            if not lu[k, k]:
                lu[k, k] = 1  # the null space: the least number there is
            for r in range(k + 1, dim):
                lu[r, k] = (lu[r, k] << FRACTION) // lu[k, k]
            if k + 1 < dim:
                lu[k + 1:, k + 1:] -= down(np.outer(lu[k + 1:, k], lu[k, k + 1:]))
        v = np.array([(1 << FRACTION) * ((7 * i + 13 * number) % 31 + 1) for i in range(dim)], object)
        for _ in range(SOLVES):
            v = v[rows]
            for k in range(1, dim):
                v[k] -= int(lu[k, :k] @ v[:k]) >> FRACTION
            for k in range(dim - 1, -1, -1):
                v[k] = ((v[k] << FRACTION) - (int(lu[k, k + 1:] @ v[k + 1:]) if k + 1 < dim else 0)) // lu[k, k]
            for twice in range(2):
                for u in out:
                    v = v - down(u * (int(u @ v) >> FRACTION))
                size = math.isqrt(int(v @ v))
                v = np.array([(int(e) << FRACTION) // size for e in v], object)
        out.append(v)
    return np.array([[float(e / (1 << FRACTION)) if abs(e) < 1 << 1000 else 0.0 for e in map(int, u)] for u in out]).reshape(len(out), dim)


class Whitening:
    """What is fitted: n, sums S of x, components (unit, one per row), their variances, the trace."""

    def __init__(self, n: int, sums: list[int], components: np.ndarray, variances: np.ndarray, explained: np.ndarray):
        self.n, self.sums, self.components, self.variances, self.explained = n, sums, components, variances, explained

    def project(self, y: np.ndarray) -> tuple[np.ndarray, list]:
        """Whitened coordinates of integer entries (x - SHIFT), and each row's exact deviation."""
        mine = [s - self.n * SHIFT for s in self.sums]
        most = max([abs(int(y.max())), abs(int(y.min()))]) * self.n + max(map(abs, mine)) if y.size else 0
        if y.dtype != object and most**2 * y.shape[1] < 2**63:
            apart = y * self.n - np.array(mine, np.int64)
            return self._scaled(apart.astype(np.float64)), (apart * apart).sum(axis=1).tolist()
        apart = y.astype(object) * self.n - np.array(mine, object)
        return self._scaled(apart.astype(np.float64)), [int(v) for v in (apart * apart).sum(axis=1)]

    def _scaled(self, apart: np.ndarray) -> np.ndarray:
        return (apart / self.n) @ self.components.T / np.sqrt(self.variances)


def fit(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the fit list; None if it is empty or nothing varies."""
    if not dim:
        return None
    n, sums, m = scatter(rows, dim)
    trace = int(sum(m.diagonal()))
    roots = largest_roots(characteristic(rows.sparkSession, m), components) if trace else []
    if not roots:
        return None
    ratio = lambda num, den: float(Decimal(num) / Decimal(den))
    return Whitening(n, sums, eigenvectors(m, roots), np.array([ratio(num, n * n << bits) for num, bits in roots]),
                     np.array([ratio(num, trace << bits) for num, bits in roots]))


def transform(rows: DataFrame, dim: int, fitted: Whitening) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation_exact, whitened, explained."""
    k = len(fitted.variances)
    most = 10**38

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            white, deviation = fitted.project(integers(batch.column(1), dim))
            ids, many = batch.column(0), len(white)
            whole = pa.array([Decimal(v) if v < most else None for v in deviation], pa.decimal128(38, 0))
            at = pa.array(np.repeat(np.arange(many), k))
            yield pa.RecordBatch.from_arrays([ids.take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)), pa.array(np.full(many * k, fitted.n)),
                                              whole.take(at), pa.array(white.ravel()), pa.array(np.tile(fitted.explained, many))],
                                             names=[c.split()[0] for c in OUT.split(", ")])

    return rows.select("vec_id", "c").mapInArrow(task, OUT)


def identity_error(rows: DataFrame, dim: int, fitted: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, over all rows."""
    k = len(fitted.variances)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            white, _ = fitted.project(integers(batch.column(0), dim))  # centred by the exact mean
            total += white.T @ white
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int32()), pa.array(total.ravel())], names=["at", "v"])

    sums = rows.select("c").mapInArrow(task, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()  # k * k numbers
    return max(abs(r.v / fitted.n - (r.at // k == r.at % k)) for r in sums)


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Fit and result: OUT with ``deviation`` as a long and ``identity_error``."""
    rows, dim = fit_list(vectors)
    fitted = fit(rows, dim, components)
    if fitted is None:
        out, error = vectors.sparkSession.createDataFrame([], OUT), 0.0
    else:
        out, error = transform(rows, dim, fitted), identity_error(rows, dim, fitted)
    return out.select("vec_id", "component", "n", F.expr("try_cast(deviation_exact AS long)").alias("deviation"), "whitened", "explained",
                      F.lit(error).alias("identity_error"), "deviation_exact")


def op12_whitening(spark, sf_dir):
    return whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
