"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter.

1. Components become integers; the distinct integer vectors are the fit list. Tasks add up exact products of its
   columns and Spark sums them, so that ``A = n * sum(x x') - S S'``, which is ``n**2`` times the covariance, is known
   to the last digit.
2. ``det(z - A)`` is computed modulo enough 31-bit primes, one row of a Spark job each, by reduction to Hessenberg
   form; Chinese remaindering gives its integer coefficients. Their number and size depend on the dimension and the
   logarithm of the counts only.
3. All roots are real, so the sign changes of the polynomial's coefficients after a shift by ``a`` count the roots
   above ``a`` exactly. Bisection on that count isolates the largest distinct roots of the square-free part and
   gives their multiplicities; they are then narrowed to many more digits than a double has.
4. Each component spans the null space of ``A - z``, found by inverse iteration in decimal arithmetic; several
   components of one root are made orthogonal. The sign is such that the largest entry is positive.

Every row is then projected where it lies, without a shuffle.

Defined results: rows whose vector is null or holds null, NaN or infinite entries are left out. Vectors shorter than
the longest count as filled up with zeros. Equal vectors enter the fit list once and are all returned; null ids and
extra columns do not matter. Integers beyond 64 bits are cut to the nearest 64-bit one. A deviation beyond 64 bits is
null. Where the covariance has rank below the number of components, those left have ``explained`` 0 and a null
``whitened``, and ``identity_error`` covers the others (null if there is none). An empty table gives no rows.
"""

from __future__ import annotations

import decimal
import random
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import comb, gcd, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.llm.common import pick, store

#: bits of the pieces in which wide integers are multiplied, and of the digits in which sums travel
PIECE, DIGIT = 18, 24
#: rows multiplied at once: products of two pieces then stay below 2**53
ROWS = 4096
#: digits kept beyond those that the distance of two roots takes
GUARD = 60


def quantised(vector: Column, scale: int) -> Column:
    """``floor(scale * c)`` of every entry, or null where the vector does not take part."""
    wide = vector.cast("array<double>")
    usable = F.forall(wide, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(wide, lambda c: F.floor(F.lit(float(scale)) * c).cast("long"))
    return F.when(wide.isNotNull() & usable, whole)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    values = np.asarray(batch.column("x").flatten(), np.int64)
    return values.reshape(batch.num_rows, -1)


def _pieces(x: np.ndarray) -> list[np.ndarray]:
    """Pieces of ``PIECE`` bits of signed integers, lowest first; the last one has the sign."""
    top = max(int(x.max()).bit_length(), int(~x.min()).bit_length() if x.min() < 0 else 0)
    n = max(1, -(-top // PIECE))
    low = [((x >> (PIECE * i)) & ((1 << PIECE) - 1)).astype(np.float64) for i in range(n - 1)]
    return [*low, (x >> (PIECE * (n - 1))).astype(np.float64)]


def exact_products(x: np.ndarray) -> np.ndarray:
    """``x' x`` in Python integers."""
    out = np.zeros((x.shape[1],) * 2, object)
    for start in range(0, len(x), ROWS):
        parts = _pieces(x[start : start + ROWS])
        for i, a in enumerate(parts):
            for j, b in enumerate(parts):
                out += (a.T @ b).astype(np.int64).astype(object) << (PIECE * (i + j))
    return out


def _exact_sums(x: np.ndarray) -> np.ndarray:
    out = np.zeros(x.shape[1], object)
    for start in range(0, len(x), ROWS):
        for i, a in enumerate(_pieces(x[start : start + ROWS])):
            out += a.sum(0).astype(np.int64).astype(object) << (PIECE * i)
    return out


def _digits(cells: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(cell, place, digit): signed numbers in digits of ``DIGIT`` bits, so that sums over tasks fit a long."""
    for cell, value in cells:
        place, rest = 0, abs(value)
        while rest:
            digit = rest & ((1 << DIGIT) - 1)
            yield cell, place, digit if value > 0 else -digit
            place, rest = place + 1, rest >> DIGIT


def _scatter(d: int):
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cell 0 is the number of rows, then come the sums, then the upper triangle of the products."""
        n, sums, products = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                n, sums, products = n + len(x), sums + _exact_sums(x), products + exact_products(x)
        rows = list(_digits(enumerate([n, *sums, *products[upper]])))
        cols = list(zip(*rows)) or [()] * 3
        kinds = [pa.int32(), pa.int32(), pa.int64()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=["cell", "place", "digit"])

    return run


def _is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide all numbers below 3,215,031,751."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        if not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_over(bound: int) -> list[int]:
    """The largest primes below 2**31 whose product passes ``bound``."""
    out, product, p = [], 1, (1 << 31) + 1
    while product <= bound:
        p -= 2
        if _is_prime(p):
            out.append(p)
            product *= p
    return out


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``a`` modulo the prime ``p``, zero below the first subdiagonal."""
    a = a.copy()
    for m in range(1, len(a) - 1):
        below = np.flatnonzero(a[m:, m - 1])
        if not len(below):
            continue
        if below[0]:
            i = m + below[0]
            a[[m, i]] = a[[i, m]]
            a[:, [m, i]] = a[:, [i, m]]
        u = a[m + 1 :, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1 :] = (a[m + 1 :] - u[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1 :] * u % p).sum(1)) % p
    return a


def characteristic(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of ``det(z - a)`` modulo ``p``, highest power first."""
    h, d = hessenberg(a, p), len(a)
    # row k: the polynomial of the leading k by k part, lowest power first
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        weight, run = np.zeros(k, np.int64), 1
        weight[k - 1] = h[k - 1, k - 1]
        for i in range(k - 2, -1, -1):
            run = run * int(h[i + 1, i]) % p
            weight[i] = run * int(h[i, k - 1]) % p
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - (weight[:, None] * polys[:k] % p).sum(0)) % p
    return polys[d, ::-1]


def characteristic_polynomial(spark: SparkSession, a: np.ndarray) -> list[int]:
    """Integer coefficients of ``det(z - a)``, highest power first, of a positive semidefinite integer matrix."""
    d, trace = len(a), sum(int(a[i, i]) for i in range(len(a)))
    # with roots not below zero, no coefficient passes that of equal roots
    bound = max(-(-comb(d, k) * trace**k // d**k) for k in range(d + 1))
    primes = primes_over(2 * bound + 1)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            rows = [characteristic((a % primes[i]).astype(np.int64), primes[i]).tolist() for i in ids]
            yield pa.record_batch([pa.array(ids), pa.array(rows, pa.list_(pa.int64()))], names=["id", "residues"])

    jobs = spark.range(0, len(primes), 1, min(len(primes), 4 * spark.sparkContext.defaultParallelism))
    rows = {r["id"]: r["residues"] for r in jobs.mapInArrow(residues, "id long, residues array<long>").collect()}
    product = 1
    for p in primes:
        product *= p
    basis = [product // p * pow(product // p, -1, p) for p in primes]
    out = []
    for k in range(d + 1):
        value = sum(rows[i][k] * b for i, b in enumerate(basis)) % product
        out.append(value - product if 2 * value > product else value)
    return out


def _shifted(poly: list[int], by: int) -> list[int]:
    """The polynomial of ``z + by``, highest power first."""
    out = list(poly)
    for upto in range(len(out), 1, -1):
        for i in range(1, upto):
            out[i] += by * out[i - 1]
    return out


def roots_above(poly: list[int], at: int) -> int:
    """The number of roots above ``at``, with multiplicity, of a polynomial with real roots only."""
    signs = [c > 0 for c in _shifted(poly, at) if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _scaled(poly: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are ``2**bits`` times as large."""
    return [c << (bits * i) for i, c in enumerate(poly)]


def _primitive(poly: list[int]) -> list[int]:
    first = next((i for i, c in enumerate(poly) if c), len(poly))
    common = gcd(*poly) or 1
    return [c // common for c in poly[first:]]


def _derived(poly: list[int]) -> list[int]:
    n = len(poly) - 1
    return [c * (n - i) for i, c in enumerate(poly[:-1])]


def _remainder(a: list[int], b: list[int]) -> list[int]:
    """A multiple of the remainder of ``a`` by ``b``."""
    a = list(a)
    while len(a) >= len(b):
        lead = a[0]
        a = [x * b[0] for x in a]
        for i, y in enumerate(b):
            a[i] -= lead * y
        a = a[1:]
    return _primitive(a)


def square_free(poly: list[int]) -> list[int]:
    """The polynomial with the same roots, each once."""
    for p in primes_over(1 << 60):  # a constant common divisor modulo a prime proves that there is none
        a, b = [c % p for c in poly], [c % p for c in _derived(poly)]
        if a[0] and b[0] and len(_common_mod(a, b, p)) == 1:
            return poly
    a, b = poly, _derived(poly)
    while b:
        a, b = b, _remainder(a, b)
    a = _primitive(a)
    out, rest = [], [Fraction(c) for c in poly]
    while len(rest) >= len(a):
        q = rest[0] / a[0]
        out.append(q)
        rest = [r - q * a[i] if i < len(a) else r for i, r in enumerate(rest)][1:]
    scale = 1
    for q in out:
        scale = scale * q.denominator // gcd(scale, q.denominator)
    return _primitive([int(q * scale) * (1 if out[0] > 0 else -1) for q in out])


def _common_mod(a: list[int], b: list[int], p: int) -> list[int]:
    while b:
        inverse = pow(b[0], -1, p)
        while len(a) >= len(b):
            q = a[0] * inverse % p
            a = [(x - q * b[i]) % p if i < len(b) else x for i, x in enumerate(a)][1:]
        while a and not a[0]:
            a = a[1:]
        a, b = b, a
    return a


@dataclass
class Root:
    """The root lies above ``low`` and not above ``low + 1``, both over ``2**bits``."""

    low: int
    bits: int
    times: int


def largest_roots(poly: list[int], wanted: int) -> list[Root]:
    """The largest positive roots, ``wanted`` with multiplicity (or all), isolated and narrowed."""
    while len(poly) > 1 and not poly[-1]:
        poly = poly[:-1]
    if len(poly) < 2:
        return []
    top = -poly[1]  # the sum of the roots
    once, bits = square_free(poly), 0
    while True:
        ends = _isolated(_scaled(once, bits), top << bits, wanted)
        if ends is not None:
            break
        bits = 2 * bits + 16
    whole, out, left = _scaled(poly, bits), [], wanted
    counts = {e: roots_above(whole, e) for low in ends for e in (low, low + 1)}
    for low in ends:
        times = counts[low] - counts[low + 1]
        out.append(Root(low, bits, times))
        left -= times
        if left <= 0:
            break
    # far more bits than the distance to the next root takes
    more = max(64, 2 * (top << bits).bit_length())
    fine = _scaled(once, bits + more)
    for root in out:
        low, high = root.low << more, (root.low + 1) << more
        positive = _value(fine, high) > 0 or (_value(fine, high) == 0 and _value(fine, high + 1) > 0)
        while high - low > 1:
            mid = (low + high) // 2
            value = _value(fine, mid)
            if value == 0:
                low, high = mid - 1, mid
            elif (value > 0) == positive:
                high = mid
            else:
                low = mid
        root.low, root.bits = low, root.bits + more
    return out


def _value(poly: list[int], at: int) -> int:
    out = 0
    for c in poly:
        out = out * at + c
    return out


def _isolated(poly: list[int], top: int, wanted: int) -> list[int] | None:
    """Integers below the largest roots, one root in each unit step, or None if a step has several roots."""
    known = {top: 0, 0: roots_above(poly, 0)}
    out = []
    for k in range(min(wanted, known[0])):
        low = max(a for a, n in known.items() if n > k)
        high = min(a for a, n in known.items() if n <= k)
        while high - low > 1:
            mid = (low + high) // 2
            known[mid] = roots_above(poly, mid)
            low, high = (mid, high) if known[mid] > k else (low, mid)
        if known[low] - known[high] > 1:
            return None
        out.append(low)
    return out


def null_space(a: np.ndarray, root: Root) -> list[list[decimal.Decimal]]:
    """Orthonormal vectors that ``a`` maps to ``root`` times themselves."""
    d = len(a)
    with decimal.localcontext() as context:
        context.prec = int(0.302 * (2 * root.bits + int(abs(a).max()).bit_length())) + GUARD
        context.Emin, context.Emax = decimal.MIN_EMIN, decimal.MAX_EMAX
        shift = (decimal.Decimal(2 * root.low + 1)) / (decimal.Decimal(2) ** (root.bits + 1))
        m = [[decimal.Decimal(int(a[i, j])) - (shift if i == j else 0) for j in range(d)] for i in range(d)]
        order = list(range(d))
        for k in range(d):
            best = max(range(k, d), key=lambda i: abs(m[i][k]))
            m[k], m[best], order[k], order[best] = m[best], m[k], order[best], order[k]
            if not m[k][k]:
                m[k][k] = decimal.Decimal(10) ** (-context.prec)
            for i in range(k + 1, d):
                f = m[i][k] = m[i][k] / m[k][k]
                if f:
                    row, pivot = m[i], m[k]
                    for j in range(k + 1, d):
                        row[j] -= f * pivot[j]

        def solved(v):
            v = [v[i] for i in order]
            for i in range(d):
                v[i] -= sum(m[i][j] * v[j] for j in range(i))
            for i in range(d - 1, -1, -1):
                v[i] = (v[i] - sum(m[i][j] * v[j] for j in range(i + 1, d))) / m[i][i]
            return v

        def unit(v, others):
            for _ in range(2):
                for o in others:
                    along = sum(x * y for x, y in zip(v, o))
                    v = [x - along * y for x, y in zip(v, o)]
            size = sum(x * x for x in v).sqrt()
            return [x / size for x in v]

        starts, out = random.Random(d), []
        for _ in range(root.times):
            v = [decimal.Decimal(starts.randint(1, 1 << 20)) for _ in range(d)]
            for _ in range(3):
                v = unit(solved(v), out)
            out.append(v)
        return out


@dataclass
class Fit:
    """What the projection needs; components are columns of ``axes``."""

    n: int
    sums: list[int]
    axes: np.ndarray
    spread: np.ndarray  # standard deviations along the components
    explained: list[float]


def fitted(spark: SparkSession, n: int, sums: list[int], products: np.ndarray, components: int) -> Fit:
    d = len(sums)
    a = n * products - np.array([[s * t for t in sums] for s in sums], object).reshape(d, d)
    trace = sum(int(a[i, i]) for i in range(d))
    axes, spread, explained = [], [], []
    if trace:
        for root in largest_roots(characteristic_polynomial(spark, a), min(components, d)):
            value = Fraction(2 * root.low + 1, 2 << root.bits)
            for v in null_space(a, root)[: components - len(axes)]:
                v = np.array([float(x) for x in v])
                axes.append(v * np.sign(v[np.abs(v).argmax()]))
                spread.append(_root(value) / n)
                explained.append(float(value / trace))
    return Fit(n, sums, np.array(axes).reshape(-1, d).T, np.array(spread), explained)


def _root(x: Fraction) -> float:
    """The square root, to double precision."""
    return isqrt((x.numerator << 400) // x.denominator) / (1 << 200)


def _centred(x: np.ndarray, fit: Fit) -> tuple[np.ndarray, list[int | None]]:
    """``x - S / n`` in doubles, and the exact sums of ``(n x - S) ** 2`` (None beyond 64 bits)."""
    if not len(x):
        return np.zeros(x.shape), []
    reach = fit.n * max(abs(int(x.max())), abs(int(x.min()))) + max(abs(s) for s in fit.sums)
    if reach * reach * x.shape[1] < 1 << 63:
        apart = fit.n * x - np.array(fit.sums, np.int64)
        return apart / float(fit.n), (apart * apart).sum(1).tolist()
    if reach < 1 << 63:
        apart = fit.n * x - np.array(fit.sums, np.int64)
    else:
        apart = fit.n * x.astype(object) - np.array(fit.sums, object)
    near = apart.astype(np.float64)
    exact = []
    for row, size in zip(apart, (near * near).sum(1)):
        value = sum(int(v) ** 2 for v in row) if size < 1.1 * 2.0**63 else 1 << 63
        exact.append(value if value < 1 << 63 else None)
    return near / fit.n, exact


def _project(fit: Fit, components: int):
    """Each row once for every component."""
    have = len(fit.spread)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                apart, deviation = _centred(_matrix(batch), fit)
                rows, made = batch.num_rows, np.full((batch.num_rows, components), np.nan)
                made[:, :have] = apart @ fit.axes / fit.spread
                none = np.tile(np.arange(components) >= have, rows)
                ids = batch.column("vec_id").take(pa.array(np.repeat(np.arange(rows), components)))
                far = pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(rows), components)))
                numbers = np.tile(np.arange(1, components + 1, dtype=np.int32), rows)
                yield pa.record_batch(
                    [ids, pa.array(numbers), far, pa.array(made.reshape(-1), mask=none)],
                    names=["vec_id", "component", "deviation", "whitened"],
                )

    return run


def _spans(fit: Fit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = _centred(_matrix(batch), fit)[0] @ fit.axes / fit.spread
            yield pa.record_batch([pa.array(c) for c in made.T], names=[f"w{i}" for i in range(made.shape[1])])

    return run


def _identity_error(fit_list: DataFrame, fit: Fit) -> float | None:
    """Measured on the whitened fit list: its covariance, centred before multiplying, against the identity."""
    k = len(fit.spread)
    if not k:
        return None
    names = [f"w{i}" for i in range(k)]
    white = fit_list.select("x").mapInArrow(_spans(fit), ", ".join(f"{c} double" for c in names))
    mean = white.agg(*[F.avg(c).alias(c) for c in names]).first()
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    sums = [F.avg((F.col(names[a]) - mean[a]) * (F.col(names[b]) - mean[b])) for a, b in pairs]
    found = white.agg(*[s.alias(f"p{i}") for i, s in enumerate(sums)]).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(found, pairs))


def whiten(embeddings: DataFrame, components: int = 4, scale: int = 256) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: one row for each usable vector and
    each of the first ``components`` components (no more than there are dimensions)."""
    spark = embeddings.sparkSession
    rows = embeddings.select(
        pick(embeddings, "vec_id", "long"), quantised(F.col("embedding"), scale).alias("x")
    ).where("x is not null")
    longest, shortest = rows.agg(F.max(F.size("x")), F.min(F.size("x"))).first()
    d = longest or 0
    if shortest != longest:
        rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("x"))))
    shape = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not d:
        return spark.createDataFrame([], shape)
    fit_list = store(rows.select("x").distinct(), "fit-list")
    cells = fit_list.mapInArrow(_scatter(d), "cell int, place int, digit long").groupBy("cell", "place")
    totals = [0] * (1 + d + d * (d + 1) // 2)
    for cell, place, digit in cells.agg(F.sum("digit")).collect():  # bounded by the dimension
        totals[cell] += digit << (DIGIT * place)
    n, sums = totals[0], totals[1 : d + 1]
    products = np.zeros((d, d), object)
    products[np.triu_indices(d)] = totals[d + 1 :]
    products = np.where(np.tri(d, k=-1, dtype=bool), products.T, products)
    fit = fitted(spark, n, sums, products, components)
    error = _identity_error(fit_list, fit)
    k = min(components, d)
    made = rows.mapInArrow(_project(fit, k), "vec_id long, component int, deviation long, whitened double")
    share = F.array(*[F.lit(float(e)) for e in [*fit.explained, *[0.0] * (k - len(fit.explained))]])
    return made.select(
        "vec_id",
        "component",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(share, F.col("component")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
