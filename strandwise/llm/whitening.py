"""Whitening embeddings by the exact characteristic polynomial of their integer scatter matrix.

Entries become integers, so the scatter matrix n * sum(x x') - S S' is exact: tasks add up products of whole numbers, and
one row an entry of the matrix (its size is that of a vector squared, whatever the number of vectors) goes to the driver.
The characteristic polynomial comes from its residues: tasks reduce the matrix to Hessenberg form modulo some primes each,
and the Chinese remainder theorem joins the coefficients. All its roots are real, so the sign changes of its shifted
coefficients count the roots above any number exactly (Descartes); bisection isolates the largest ones and refines them far
beyond double precision. Each component is the null vector of the scatter matrix minus its root, by inverse iteration in
fixed-point integers. Spark then projects every vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import gcd, isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.llm.common import table
from strandwise.scratch import written

#: x = floor(STEP * c) + LIFT; components that are returned.
STEP, LIFT, COMPONENTS = 1024, 100_000, 8
#: Primes that are reduced at once; bits of a root's place within the trace; fraction bits of the inverse iteration.
PRIMES, ROOT_BITS, SOLVE_BITS = 16, 160, 400
LONG = (1 << 63) - 1


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and v (doubles): the rows whose vector is not null or empty and holds finite entries only."""
    v = F.col(vector).cast("array<double>")
    good = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return embeddings.select(F.col("vec_id"), v.alias("v")).filter(good)


def _whole(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length of the vectors in a batch: length, their rows, floor(STEP * c) as an array of longs (without LIFT).

    Entries beyond what a long holds end at its limits.
    """
    sizes = pc.list_value_length(column).to_numpy()
    flat = np.floor(STEP * column.flatten().to_numpy(zero_copy_only=False))
    x = np.clip(flat, -(2.0**62), 2.0**62).astype(np.int64)
    ends = np.cumsum(sizes)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, x[(ends[rows] - size)[:, None] + np.arange(size)]


def _exact(x: np.ndarray) -> np.ndarray:
    """x' x without rounding: as doubles where no sum can pass 2^53, else as Python's integers."""
    top = int(np.abs(x).max(initial=0))
    if top * top * len(x) < 1 << 53:
        y = x.astype(np.float64)
        return np.einsum("ni,nj->ij", y, y).astype(np.int64).astype(object)
    y = x.astype(object)
    return y.T.dot(y)


def moments(vectors: DataFrame) -> DataFrame:
    """size, i, j, s: the sum of x_i x_j over the vectors of each length (j >= i), of x_i (j = -1), and their number (i = j = -1). x is without LIFT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for size, rows, x in _whole(batch.column(0)):
                got = [len(rows), x.astype(object).sum(axis=0), _exact(x)]
                held[size] = [a + b for a, b in zip(held[size], got, strict=True)] if size in held else got
        for size, (n, s, m) in held.items():
            out = [(size, -1, -1, str(n)), *((size, i, -1, str(v)) for i, v in enumerate(s)), *((size, i, j, str(m[i, j])) for i in range(size) for j in range(i, size))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["size", "i", "j", "s"])

    sums = vectors.select("v").mapInArrow(run, "size long, i long, j long, s string")
    return sums.groupBy("size", "i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))


def primes_below(top: int, count: int) -> list[int]:
    found: list[int] = []
    at = top
    small = np.array([p for p in range(3, isqrt(top) + 1, 2) if all(p % q for q in range(3, isqrt(p) + 1, 2))])
    while len(found) < count:
        at -= 1 if at % 2 == 0 else 2
        if (at % small[small <= isqrt(at)]).all():
            found.append(at)
    return found


def polynomials(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Characteristic polynomial (coefficients from the constant up, the leading one is 1) modulo each prime, by Hessenberg reduction. Primes are below 2^31."""
    d, k = len(matrix), len(primes)
    mod = np.array(primes, np.int64)[:, None]
    h = np.array([[[v % p for v in row] for row in matrix] for p in primes], np.int64)
    every = np.arange(k)

    def inverse(a: np.ndarray) -> np.ndarray:
        return np.array([pow(int(x), -1, p) if x else 0 for x, p in zip(a, primes, strict=True)], np.int64)

    for c in range(d - 2):
        # The first row below the diagonal that is not 0 there becomes the pivot's, for each prime by itself.
        pivot = c + 1 + (h[:, c + 1 :, c] != 0).argmax(axis=1)
        a, b = h[every, c + 1].copy(), h[every, pivot].copy()
        h[every, c + 1], h[every, pivot] = b, a
        a, b = h[every, :, c + 1].copy(), h[every, :, pivot].copy()
        h[every, :, c + 1], h[every, :, pivot] = b, a
        factor = h[:, c + 2 :, c] * inverse(h[:, c + 1, c])[:, None] % mod
        h[:, c + 2 :] = (h[:, c + 2 :] - factor[:, :, None] * h[:, c + 1][:, None, :] % mod[:, :, None]) % mod[:, :, None]
        h[:, :, c + 1] = (h[:, :, c + 1] + (h[:, :, c + 2 :] * factor[:, None, :] % mod[:, :, None]).sum(axis=2)) % mod
    # p_m(t) = (t - h_mm) p_(m-1) - sum of h_(m-i,m) * product of the subdiagonal below * p_(m-i-1)
    poly = np.zeros((d + 1, k, d + 1), np.int64)
    poly[0, :, 0] = 1
    for m in range(1, d + 1):
        poly[m, :, 1:] = poly[m - 1, :, :-1]
        poly[m] = (poly[m] - h[:, m - 1, m - 1][:, None] * poly[m - 1] % mod) % mod
        beta = np.ones(k, np.int64)
        for i in range(1, m):
            beta = beta * h[:, m - i, m - i - 1] % mod[:, 0]
            poly[m] = (poly[m] - (h[:, m - i - 1, m - 1] * beta % mod[:, 0])[:, None] * poly[m - i - 1] % mod) % mod
    return poly[d]


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """The exact characteristic polynomial of a symmetric matrix that has no negative root. Tasks take PRIMES primes each."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # No coefficient passes the product of (1 + root), which is at most (1 + trace / d)^d.
    bits = d * (trace // max(d, 1) + 2).bit_length() + 2
    primes = primes_below((1 << 31) - 1, bits // 30 + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, PRIMES):
                mine = batch.column(0).to_pylist()[lo : lo + PRIMES]
                yield pa.RecordBatch.from_arrays([pa.array(mine), pa.array(polynomials(matrix, mine).tolist())], ["prime", "residues"])

    tasks = -(-len(primes) // PRIMES)
    rows = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(tasks).mapInArrow(run, "prime long, residues array<long>").collect()
    whole = 1
    for p in primes:
        whole *= p
    out = [0] * (d + 1)
    for r in rows:
        rest = whole // r.prime
        share = rest * pow(rest, -1, r.prime)
        for i, x in enumerate(r.residues):
            out[i] += x * share
    out = [x % whole for x in out]
    return [x - whole if 2 * x > whole else x for x in out]


def roots_above(poly: list[int], at: int) -> int:
    """How many roots of a polynomial with real roots only are larger than a whole number, each as often as it occurs: Descartes' rule is exact for them."""
    c = list(poly)
    d = len(c) - 1
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += at * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _value(poly: list[int], at: int) -> int:
    out = 0
    for c in reversed(poly):
        out = out * at + c
    return out


def largest_roots(poly: list[int], top: int, count: int) -> tuple[list[int], int]:
    """The ``count`` largest roots as whole multiples of 2^-shift, and shift. Each stands less than one unit below the root, or on it.

    Roots are bracketed by exact counts; once a bracket holds one root alone, the sign of the polynomial halves it.
    """
    d = len(poly) - 1
    shift = max(ROOT_BITS - top.bit_length(), 0)
    scaled = [c << shift * (d - i) for i, c in enumerate(poly)]
    limit = (top + 1) << shift
    known = {0: roots_above(scaled, 0), limit: 0}  # numbers of roots above

    out = []
    for k in range(1, min(count, d) + 1):
        if known[0] < k:
            out.append(0)
            continue
        lo, hi = max(x for x, n in known.items() if n >= k), min(x for x, n in known.items() if n < k)
        while hi - lo > 1:
            if known[lo] - known[hi] == 1 and (end := _value(scaled, hi)):
                while hi - lo > 1:  # one root in between: the sign changes there
                    mid = (lo + hi) // 2
                    v = _value(scaled, mid)
                    if v == 0:
                        lo = mid
                        break
                    lo, hi = (lo, mid) if (v > 0) == (end > 0) else (mid, hi)
                break
            mid = (lo + hi) // 2
            known[mid] = roots_above(scaled, mid)
            lo, hi = (mid, hi) if known[mid] >= k else (lo, mid)
        out.append(lo if _value(scaled, hi) else hi)
    return out, shift


def _solved(lu: list[list[int]], order: list[int], b: list[int]) -> list[int]:
    d = len(lu)
    y = [b[i] for i in order]
    for i in range(d):
        y[i] -= sum(lu[i][j] * y[j] for j in range(i)) >> SOLVE_BITS
    for i in range(d - 1, -1, -1):
        y[i] = ((y[i] << SOLVE_BITS) - sum(lu[i][j] * y[j] for j in range(i + 1, d))) // lu[i][i]
    return y


def _factored(matrix: list[list[int]]) -> tuple[list[list[int]], list[int]]:
    """LU factors with row pivots in fixed point; a pivot that is 0 (the root itself) is one unit."""
    m, d = [list(r) for r in matrix], len(matrix)
    order = list(range(d))
    for c in range(d):
        best = max(range(c, d), key=lambda r: abs(m[r][c]))
        m[c], m[best], order[c], order[best] = m[best], m[c], order[best], order[c]
        m[c][c] = m[c][c] or 1
        for r in range(c + 1, d):
            f = m[r][c] = (m[r][c] << SOLVE_BITS) // m[c][c]
            if f:
                m[r][c + 1 :] = [x - (f * y >> SOLVE_BITS) for x, y in zip(m[r][c + 1 :], m[c][c + 1 :], strict=True)]
    return m, order


def _unit(v: list[int]) -> list[int]:
    """v at length one in fixed point."""
    norm = isqrt(sum(x * x for x in v))
    return [(x << SOLVE_BITS) // norm for x in v] if norm else v


def components(matrix: list[list[int]], roots: list[int], shift: int) -> list[list[float]]:
    """Unit vectors of the roots' null spaces. Roots closer than a 2^-100 part share a space, in which vectors are made orthogonal to one another."""
    d, scale = len(matrix), SOLVE_BITS
    size = max(max(abs(x) for r in matrix for x in r), 1)
    out: list[list[int]] = []
    for k, root in enumerate(roots):
        at = Fraction(root, 1 << shift)
        if k == 0 or abs(roots[k - 1] - root) << 100 > root:
            group = k
        # The matrix in units of its largest entry.
        moved = [[((x << scale) - (at.numerator * (1 << scale) // at.denominator if i == j else 0)) // size for j, x in enumerate(r)] for i, r in enumerate(matrix)]
        lu, order = _factored(moved)
        v = [(1 << scale) * ((7919 * (i + 1) * (k + 1)) % 101 + 1) // 101 for i in range(d)]
        for _ in range(4):
            for other in out[group:k]:
                along = sum(a * b for a, b in zip(v, other, strict=True)) >> scale
                v = [a - (along * b >> scale) for a, b in zip(v, other, strict=True)]
            v = _unit(_solved(lu, order, _unit(v)))
        for other in out[group:k]:
            along = sum(a * b for a, b in zip(v, other, strict=True)) >> scale
            v = [a - (along * b >> scale) for a, b in zip(v, other, strict=True)]
        out.append(_unit(v))
    return [[x / (1 << scale) for x in v] for v in out]


class Whitening:
    """n, sums (of x), trace and roots (of the covariance, exact to doubles), vectors, of the vectors of length ``size``."""

    def __init__(self, n: int, sums: list[int], trace: float, roots: list[float], vectors: list[list[float]]):
        self.n, self.sums, self.trace, self.roots, self.vectors, self.size = n, sums, trace, roots, vectors, len(sums)


def fit(vectors: DataFrame, count: int = COMPONENTS) -> Whitening | None:
    """The largest ``count`` components with a variance above 0; None without vectors. Of several lengths the largest counts."""
    spark = vectors.sparkSession
    sums = written(moments(vectors), "whitening-moments")
    size = sums.agg(F.max("size")).first()[0]
    if size is None:
        return None
    got = {(r.i, r.j): int(r.s) for r in sums.filter(F.col("size") == size).collect()}  # size^2 / 2 rows
    n, s = got[-1, -1], [got[i, -1] for i in range(size)]
    scatter = [[n * got[min(i, j), max(i, j)] - s[i] * s[j] for j in range(size)] for i in range(size)]
    lifted = [x + n * LIFT for x in s]
    trace = sum(scatter[i][i] for i in range(size))
    if not trace:
        return Whitening(n, lifted, 0.0, [], [])
    common = gcd(*(x for r in scatter for x in r))
    small = [[x // common for x in r] for r in scatter]
    roots, shift = largest_roots(characteristic(spark, small), trace // common, count)
    roots = [r for r in roots if r > 0]
    unit = Fraction(common, n * n)
    return Whitening(n, lifted, float(trace * Fraction(1, n * n)), [float(Fraction(r, 1 << shift) * unit) for r in roots], components(small, roots, shift))


def project(vectors: DataFrame, fitted: Whitening) -> DataFrame:
    """vec_id, deviation, w (the whitened entries) of each vector. A deviation beyond a long is null."""
    n, sums, size = fitted.n, fitted.sums, fitted.size
    # x - S / n as (n x - S) / n: the numerator is exact.
    way = np.array(fitted.vectors).reshape(len(fitted.vectors), size) / np.sqrt(fitted.roots)[:, None]
    kind = vectors.schema["vec_id"].dataType.simpleString()
    exact = np.array([s - n * LIFT for s in sums], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, rows, x in _whole(batch.column(1)):
                if length != size:
                    continue
                top = n * int(np.abs(x).max(initial=0)) + max(abs(int(v)) for v in exact)
                if top * top * size <= LONG:
                    far = n * x - exact.astype(np.int64)
                    deviation = (far * far).sum(axis=1).tolist()
                    centred = far / n
                else:
                    far = n * x.astype(object) - exact
                    deviation = [v if v <= LONG else None for v in (far * far).sum(axis=1).tolist()]
                    centred = (far / n).astype(np.float64)
                w = np.einsum("nd,kd->nk", centred, way)
                ids = batch.column(0).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([ids, pa.array(deviation, pa.int64()), pa.array(w.tolist(), pa.list_(pa.float64()))], ["vec_id", "deviation", "w"])

    return vectors.select("vec_id", "v").mapInArrow(run, f"vec_id {kind}, deviation long, w array<double>")


def identity_error(projected: DataFrame, count: int) -> float:
    """The largest absolute entry of the whitened entries' covariance (divisor n, centred before multiplying) minus the identity."""
    if not count:
        return 0.0
    means = projected.agg(*[F.avg(F.get("w", F.lit(i))) for i in range(count)]).first()
    centred = [F.get("w", F.lit(i)) - float(m) for i, m in enumerate(means)]
    found = projected.agg(*[F.avg(centred[i] * centred[j]) for i in range(count) for j in range(i, count)]).first()
    want = [float(i == j) for i in range(count) for j in range(i, count)]
    return max(abs(a - b) for a, b in zip(found, want, strict=True))


def whiten(embeddings: DataFrame, count: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable vector and component.

    Vectors that are null, empty, shorter than the longest, or hold null or non-finite entries give no rows. Components
    without variance are left out: there is nothing to scale to one; equal vectors only, or an empty table, give no rows.
    Rows that repeat an id count each; other columns are ignored. Equal roots share a space, of which any orthonormal
    vectors are given.
    """
    vectors = usable(embeddings, vector)
    fitted = fit(vectors, count)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    if fitted is None or not fitted.roots:
        return embeddings.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    projected = project(vectors, fitted)
    error = identity_error(projected, len(fitted.roots))
    rows = projected.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened"))
    shares = F.array(*[F.lit(r / fitted.trace) for r in fitted.roots])
    return rows.select("vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
