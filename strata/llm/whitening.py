"""Whitening of vectors by exact arithmetic: the characteristic polynomial of their integer scatter
from its residues, its roots isolated by sign changes, components by inverse iteration."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, written

#: A component c becomes floor(64 c) + 1000000.
SCALE, SHIFT = 64, 1_000_000
#: Bits of a limb, whose products summed over ROWS rows stay exact as doubles.
LIMB, ROWS = 20, 8192
#: Bits of a digit of a sum that crosses the shuffle, and how many there are.
DIGIT, DIGITS = 40, 5
#: Bits to which a root is isolated relative to itself, and bits of fractions in the iteration.
ROOT, FRACTION = 160, 512


@dataclass(frozen=True)
class Fit:
    """What one dimension's distinct vectors tell: their number, the sums of x - SHIFT, and for each
    component, by falling eigenvalue, its unit vector, its eigenvalue and its share of the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0


def whole(vector: str) -> Column:
    """The vector as whole numbers less SHIFT; NULL unless all its entries are numbers that fit a long
    times SCALE."""
    entry = lambda x: F.floor(x.cast("double") * SCALE).cast("long")
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float(2**55))
    fine = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, fits)
    return F.when(fine, F.transform(vector, entry))


def matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def pieces_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, each of one dimension and at most ROWS rows."""
    sizes = batch["x"].value_lengths().to_numpy()
    for size in np.unique(sizes):
        alike = batch.filter(pa.array(sizes == size))
        yield from (alike.slice(k, ROWS) for k in range(0, len(alike), ROWS))


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """Whole numbers as doubles in [-2^(LIMB-1), 2^(LIMB-1)), the k-th times 2^(LIMB k)."""
    out = []
    while True:
        low = ((x + (1 << LIMB - 1)) & ((1 << LIMB) - 1)) - (1 << LIMB - 1)
        out.append(low.astype(np.float64))
        x = (x - low) >> LIMB
        if not x.any():
            return out


def products(x: np.ndarray) -> np.ndarray:
    """x.T @ x of at most ROWS whole rows, exact, as Python's numbers."""
    parts = limbs(x)
    total = np.zeros((x.shape[1],) * 2, object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            total = total + ((a.T @ b).astype(np.int64).astype(object) << LIMB * (i + j))
    return total


def digits(values: np.ndarray) -> list[pa.Array]:
    """Whole numbers as DIGITS columns of longs that may be summed column by column."""
    out = []
    for k in range(DIGITS):
        out.append(pa.array([int(v) for v in (values & ((1 << DIGIT) - 1) if k < DIGITS - 1 else values)], pa.int64()))
        values = values >> DIGIT
    return out


def scatter(rows: DataFrame) -> dict[int, tuple[int, list[int], list[list[int]]]]:
    """By dimension of the vectors x: their number, their sums, and the integer scatter
    n sum(x x') - sum(x) sum(x)'.

    A task sends one row for each entry of the matrix; the driver gets these sums only, whose size is
    that of the matrix.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece in pieces_of(batch):
                x = matrix(piece["x"])
                # A column of ones gives the sums and the number of rows as well.
                x = np.concatenate([x, np.ones((len(x), 1), np.int64)], 1)
                sums[x.shape[1]] = sums.get(x.shape[1], 0) + products(x)
        for size, total in sums.items():
            i, j = np.triu_indices(size)
            columns = [pa.array(np.full(len(i), size - 1)), pa.array(i), pa.array(j), *digits(total[i, j])]
            yield pa.RecordBatch.from_arrays(columns, ["d", "i", "j", *[f"v{k}" for k in range(DIGITS)]])

    names = [f"v{k}" for k in range(DIGITS)]
    parts = map_batches(rows.select("x"), run, "d long, i long, j long, " + ", ".join(f"{v} long" for v in names))
    found: dict[int, np.ndarray] = {}
    for row in parts.groupBy("d", "i", "j").agg(*[F.sum(v).alias(v) for v in names]).collect():
        m = found.setdefault(row.d, np.zeros((row.d + 1,) * 2, object))
        m[row.i, row.j] = m[row.j, row.i] = sum(row[v] << DIGIT * k for k, v in enumerate(names))
    out = {}
    for d, m in found.items():
        n, s = m[d, d], m[:d, d]
        out[d] = (n, list(s), (n * m[:d, :d] - np.outer(s, s)).tolist())
    return out


def primes(bits: int) -> list[int]:
    """The largest primes below 2^31, together of more than so many bits."""

    def prime(p: int) -> bool:
        # These bases are enough below 3.2 * 10^9.
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):
            x = pow(base, odd, p)
            if x not in (1, p - 1) and all((x := x * x % p) != p - 1 for _ in range(twos - 1)):
                return False
        return True

    out, p, product = [], 1 << 31, 1
    while product.bit_length() <= bits:
        p -= 1
        if p % 2 and prime(p):
            out.append(p)
            product *= p
    return out


def polynomial_mod(m: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(tI - m) modulo p, from that of t^0 on: reduction to Hessenberg form by
    similar matrices, then the recurrence of its leading minors."""
    d = len(m)
    h = np.array([[v % p for v in row] for row in m], np.int64)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        h[[k, pivot]] = h[[pivot, k]]
        h[:, [k, pivot]] = h[:, [pivot, k]]
        factors = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factors[:, None] * h[k]) % p
        # The column takes on what the rows lost; summed in halves, so that no product overflows.
        low, high = factors & 0xFFFF, factors >> 16
        columns = h[:, k + 1 :]
        more = (columns * low % p).sum(1) + ((columns * high % p).sum(1) % p << 16)
        h[:, k] = (h[:, k] + more) % p
    minors = [np.array([1], np.int64)]
    for k in range(d):
        nxt = np.zeros(k + 2, np.int64)
        nxt[1:] = minors[k]
        nxt[:-1] = (nxt[:-1] - h[k, k] * minors[k]) % p
        product = 1
        for i in range(k - 1, -1, -1):
            product = product * int(h[i + 1, i]) % p
            if not product:
                break
            nxt[: i + 1] = (nxt[: i + 1] - int(h[i, k]) * product % p * minors[i]) % p
        minors.append(nxt % p)
    return [int(v) for v in minors[d]]


def polynomial(rows: DataFrame, m: list[list[int]]) -> list[int]:
    """Coefficients of det(tI - m) for a matrix whose eigenvalues are not negative: its residues are
    found by a task for each prime and put together by Chinese remaindering."""
    d, spark = len(m), rows.sparkSession
    trace = sum(m[k][k] for k in range(d))
    # A coefficient is a sum of at most 2^d products of eigenvalues, whose sum is the trace.
    chosen = primes(d * max(1, (trace // d + 1).bit_length()) + d + 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                residues = pa.array([polynomial_mod(m, p)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([p]), residues], ["p", "residues"])

    # A table of the primes alone would be a local relation, one task; each is to be its own.
    given = spark.range(0, len(chosen), 1, min(len(chosen), 8 * spark.sparkContext.defaultParallelism))
    given = given.select(F.element_at(F.lit(chosen).cast("array<long>"), (F.col("id") + 1).cast("int")).alias("p"))
    found = map_batches(given, run, "p long, residues array<long>").collect()
    product = reduce(mul, chosen, 1)
    total = [0] * (d + 1)
    for row in found:
        others = product // row.p
        weight = others * pow(others, -1, row.p)
        total = [t + r * weight for t, r in zip(total, row.residues, strict=True)]
    return [c - product if c > product // 2 else c for c in (t % product for t in total)]


def above(c: list[int], at: int, bits: int) -> int:
    """How many roots exceed at / 2^bits: the sign changes of the polynomial moved there, which is
    exact as all roots are real."""
    d = len(c) - 1
    # Times 2^(bits d), so that all stays whole.
    moved = [v << bits * (d - k) for k, v in enumerate(c)]
    for k in range(d):
        for j in range(d - 1, k - 1, -1):
            moved[j] += at * moved[j + 1]
    signs = [v > 0 for v in moved if v]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def value(c: list[int], at: int, bits: int) -> int:
    """The sign-giving value of the polynomial at at / 2^bits."""
    total, d = 0, len(c) - 1
    for k in range(d, -1, -1):
        total = total * at + (c[k] << bits * (d - k))
    return total


def roots(c: list[int], most: int) -> list[tuple[int, int, int]]:
    """The largest `most` positive roots, falling, as (at, bits, multiplicity) for at / 2^bits, to a
    relative error of 2^-ROOT. Roots that are closer than that are one of their joint multiplicity."""
    top = 1 << max(1, 2 + max((abs(v).bit_length() // (len(c) - 1 - k) for k, v in enumerate(c[:-1])), default=1))
    found: list[tuple[int, int, int]] = []
    # Intervals (low, high] / 2^bits that hold roots above, largest first.
    work = [(0, top, 0, above(c, 0, 0), 0)]
    while work and sum(f[2] for f in found) < most:
        low, high, bits, over_low, over_high = work.pop()
        count = over_low - over_high
        if not count:
            continue
        if count == 1 and low:
            found.append((*refined(c, low, high, bits), 1))
            continue
        if high - low == 1 and low >> ROOT:
            found.append((low + high, bits + 1, count))
            continue
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        # Far below the top, halve the exponent rather than the interval.
        if not low:
            middle = 1 << (high.bit_length() - 1) // 2 if high > 4 else middle
        over = above(c, middle, bits)
        work.append((low, middle, bits, over_low, over))
        work.append((middle, high, bits, over, over_high))
    return found


def refined(c: list[int], low: int, high: int, bits: int) -> tuple[int, int]:
    """The one root in (low, high] / 2^bits, by halving."""
    if not (last := value(c, high, bits)):
        return high, bits
    while not (high - low == 1 and low >> ROOT):
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        here = value(c, middle, bits)
        if not here:
            return middle, bits
        if (here > 0) == (last > 0):
            high = middle
        else:
            low = middle
    return low + high, bits + 1


def null_space(m: list[list[int]], at: int, bits: int, size: int) -> np.ndarray:
    """Orthonormal vectors of the eigenvalue at / 2^bits of multiplicity `size`: inverse iteration in
    numbers of FRACTION bits after the point, two solutions of (m - eigenvalue) y = start each."""
    d = len(m)
    scale = max(abs(v) for row in m for v in row).bit_length()
    # The matrix is scaled to entries of about one.
    a = np.array(m, object) << FRACTION - scale
    root = at << FRACTION - scale - bits if FRACTION - scale >= bits else at >> bits + scale - FRACTION
    a[np.diag_indices(d)] -= root
    start = np.array([[pow(3, 1 + i + 7 * j * j, 1009) - 504 for j in range(size)] for i in range(d)], object)
    y = start << FRACTION - 10
    for _ in range(2):
        y = orthonormal(solved(a, y))
    return np.array([[float(v / (1 << FRACTION)) for v in row] for row in y.tolist()])


def solved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a y = b by elimination with pivots, in whole multiples of 2^-FRACTION."""
    d = len(a)
    work = np.concatenate([a, b], 1)
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(work[k + i, k]))
        work[[k, pivot]] = work[[pivot, k]]
        if not work[k, k]:
            work[k, k] = 1  # the matrix is singular to the last bit
        factors = (work[k + 1 :, k] << FRACTION) // work[k, k]
        work[k + 1 :, k:] -= factors[:, None] * work[k, k:] >> FRACTION
    y = np.zeros_like(b)
    for k in range(d - 1, -1, -1):
        rest = work[k, d:] - ((work[k, k + 1 : d] @ y[k + 1 :]) >> FRACTION if k < d - 1 else 0)
        y[k] = (rest << FRACTION) // work[k, k]
    return y


def orthonormal(y: np.ndarray) -> np.ndarray:
    """The columns made orthonormal one after the other, twice for those almost dependent."""
    out = y.copy()
    for _ in range(2):
        for j in range(out.shape[1]):
            v = out[:, j]
            v = (v << FRACTION) // max(abs(x) for x in v)
            for i in range(j):
                u = out[:, i]
                v = v - (u * ((u @ v) >> FRACTION) >> FRACTION)
            out[:, j] = (v << FRACTION) // math.isqrt(v @ v)
    return out


def components(rows: DataFrame, m: list[list[int]], most: int) -> tuple[np.ndarray, list[float]]:
    """Unit vectors, as rows, of the largest `most` positive eigenvalues, and these as shares of the
    trace. Each is found in a task of its own."""
    spark, trace = rows.sparkSession, sum(m[k][k] for k in range(len(m)))
    if not trace:
        return np.zeros((0, len(m))), []
    wanted = roots(polynomial(rows, m), most)
    given = spark.range(0, len(wanted), 1, len(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                found = null_space(m, *wanted[k]).T
                flat = pa.array([found.ravel().tolist()], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array([k]), flat], ["k", "vectors"])

    found = sorted(map_batches(given, run, "k long, vectors array<double>").collect())
    vectors = np.concatenate([np.array(row.vectors).reshape(-1, len(m)) for row in found])[:most]
    # Either sign will do; the largest entry is positive.
    largest = np.abs(vectors).argmax(1)
    vectors *= np.sign(vectors[np.arange(len(vectors)), largest])[:, None]
    shares = [at / (trace << bits) for at, bits, size in wanted for _ in range(size)][:most]
    return vectors, shares


def centred(x: np.ndarray, fit: Fit) -> np.ndarray:
    """n x - S, exact: as longs if all fit, else as Python's numbers."""
    most = fit.n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, fit.sums))
    return (x if most < 1 << 62 else x.astype(object)) * fit.n - np.array(fit.sums, np.int64 if most < 1 << 62 else object)


def whitened(apart: np.ndarray, fit: Fit) -> np.ndarray:
    """Rows n x - S projected on the components, of unit variance each."""
    return (apart / fit.n).astype(np.float64) @ fit.components.T / np.sqrt(fit.values)


def identity_errors(rows: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """By dimension the largest entry of the covariance of the whitened vectors less the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece in pieces_of(batch):
                x = matrix(piece["x"])
                w = whitened(centred(x, fits[x.shape[1]]), fits[x.shape[1]])
                w = np.concatenate([w, np.ones((len(w), 1))], 1)
                sums[x.shape[1]] = sums.get(x.shape[1], 0) + w.T @ w
        for d, total in sums.items():
            i, j = (k.ravel() for k in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d)), pa.array(i), pa.array(j), pa.array(total[i, j])], ["d", "i", "j", "v"])

    found = map_batches(rows.select("x"), run, "d long, i long, j long, v double").groupBy("d", "i", "j").agg(F.sum("v").alias("v"))
    sums = {d: np.zeros((len(f.values) + 1,) * 2) for d, f in fits.items()}
    for row in found.collect():
        sums[row.d][row.i, row.j] = row.v
    out = {}
    for d, total in sums.items():
        mean = total[:-1, -1] / total[-1, -1]
        apart = total[:-1, :-1] / total[-1, -1] - np.outer(mean, mean) - np.eye(len(mean))
        out[d] = float(np.abs(apart).max(initial=0.0))
    return out


def fit(rows: DataFrame, most: int) -> dict[int, Fit]:
    """Rows (x) of distinct vectors, by dimension: each is fitted on its own, as vectors of different
    dimension have no covariance."""
    fits = {}
    for d, (n, sums, m) in scatter(rows).items():
        vectors, shares = components(rows, m, most)
        trace = sum(m[k][k] for k in range(d)) / n**2 if n else 0.0
        fits[d] = Fit(n, sums, vectors, np.array(shares) * trace, np.array(shares))
    errors = identity_errors(rows, fits)
    return {d: Fit(f.n, f.sums, f.components, f.values, f.explained, errors[d]) for d, f in fits.items()}


def whiten(rows: DataFrame, most: int = 16, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for each vector and component, up to `most`: key, component, n, deviation, whitened,
    explained, identity_error.

    A vector that is NULL, empty, or has an entry that is NULL, not finite or not below 2^55 in size
    takes no part. The fit is over distinct whole-numbered vectors, so copies weigh once, but every
    row is returned, whatever its key. Components of no variance are left out: if all vectors are
    equal, there are none and no rows. Vectors of different dimensions are fitted apart. The deviation
    is a decimal of 38 digits. Other columns play no part.
    """
    given = rows.select(F.col(key).alias("key"), whole(vector).alias("x")).where("x IS NOT NULL")
    # Copies meet before the shuffle, so one vector that many rows hold is a row of each task.
    fits = fit(written(given.select("x").distinct(), "vectors"), most)
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_of(batch):
                x = matrix(piece["x"])
                own = fits[x.shape[1]]
                k, n = len(own.values), len(x)
                if not k:
                    continue
                apart = centred(x, own)
                small = np.abs(apart).max() < 1 << 25
                away = ((apart if small else apart.astype(object)) ** 2).sum(1)
                away = pa.array(away) if small else pa.array([int(v) for v in away], WIDE)
                columns = [
                    piece["key"].take(pa.array(np.repeat(np.arange(n), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * k, own.n)),
                    away.cast(WIDE).take(pa.array(np.repeat(np.arange(n), k))),
                    pa.array(whitened(apart, own).ravel()),
                    pa.array(np.tile(own.explained, n)),
                    pa.array(np.full(n * k, own.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, NAMES)

    schema = f"key {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return map_batches(given, run, schema).withColumnRenamed("key", key)


WIDE = pa.decimal128(38, 0)
NAMES = ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"]
