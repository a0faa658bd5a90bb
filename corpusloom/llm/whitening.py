"""Whitening of embeddings along exact principal components.

Entries become integers, so the scatter matrix ``M = n * sum(x x') - S S'`` (``n * n`` times the covariance)
is summed without any rounding. Its characteristic polynomial is found exactly: one task per few primes
brings the matrix to Hessenberg form modulo a prime and reads off the coefficients there, and the Chinese
remainder theorem puts them together. All roots are real, so the sign changes of the polynomial moved to a
point count exactly the roots beyond it; bisection isolates the roots to some 100 bits. Each component then
comes from inverse iteration in whole numbers on ``M - root * I``, one task per root; a root that several
components share gives as many orthogonal vectors.

Dropped, as they have no place in a fit: rows whose vector is null, is empty, or holds null or non-finite
entries, and rows whose vector is not as long as the most frequent length (ties: the longer). Components end
where the exact rank ends (equal vectors, a single row and an empty table have none, so no rows). Repeated
rows and null ids count and stay like any other. Columns besides the id and the vector are not read.
``deviation`` is null where it passes 64 bits; ``deviation_text`` always has it in full.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Components at most.
COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Bits of a root below the largest one's first.
ROOT_BITS = 110
#: Bits behind the point in the inverse iteration, beyond twice those of the matrix.
MORE_BITS = 128
LIMB = 30
PRIMES_PER_TASK = 16
#: Integers up to here are exact as doubles.
EXACT = 1 << 53
SUMS = T.StructType([T.StructField(c, T.IntegerType()) for c in ("i", "j", "limb")] + [T.StructField("part", T.LongType())])


@dataclass(frozen=True)
class Whitening:
    """What was learnt: ``n`` vectors, their integer sums, components by rows, square roots of the covariance's eigenvalues."""

    n: int
    sums: list[int]
    components: np.ndarray
    spreads: list[float]
    explained: list[float]


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """``(vec_id, vector)`` of the rows that count, and their length."""
    v = F.col(vector_col).cast("array<double>")
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    rows = df.select(F.col(id_col).alias("vec_id"), v.alias("vector")).filter(v.isNotNull() & ~odd & (F.size(v) > 0))
    size = F.size("vector").alias("d")
    most = rows.groupBy(size).count().agg(F.max(F.struct("count", "d")).alias("top")).collect()[0].top
    d = most.d if most else 0
    return rows.filter(F.size("vector") == d), d


def _integers(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """``floor(64 * c)`` by rows: doubles where all are exact, else Python integers."""
    c = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    if not len(c) or np.abs(c).max() < 1 << 40:
        return np.floor(c * SCALE)
    whole = np.empty(c.shape, dtype=object)
    for at, value in np.ndenumerate(c):
        whole[at] = int(value) * SCALE if abs(value) >= EXACT else math.floor(value * SCALE)
    return whole


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """A whole number in parts that many tasks' sums of fit 64 bits."""
    limb = 0
    while not -(1 << LIMB) <= value < 1 << LIMB:
        yield limb, value & ((1 << LIMB) - 1)
        value >>= LIMB
        limb += 1
    yield limb, value


def _scatter(rows: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """``n``, the sums and the sums of products, exactly. ``j = -1`` holds sums, ``i = j = -1`` the count."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)
        for batch in batches:
            x = _integers(batch, d)
            if not len(x):
                continue
            n += len(x)
            if x.dtype == object:
                sums += x.sum(axis=0)
                squares += x.T.dot(x)
                continue
            most = int(np.abs(x).max()) or 1
            if most * most >= EXACT:
                x = np.vectorize(int, otypes=[object])(x)
                sums += x.sum(axis=0)
                squares += x.T.dot(x)
                continue
            step = max(1, EXACT // (most * most))
            for at in range(0, len(x), step):
                block = x[at : at + step]
                sums += block.sum(axis=0).astype(np.int64)
                squares += (block.T @ block).astype(np.int64)
        if n:
            values = [(-1, -1, n)] + [(i, -1, int(sums[i])) for i in range(d)]
            values += [(i, j, int(squares[i, j])) for i in range(d) for j in range(i + 1)]
            found = [(i, j, limb, part) for i, j, value in values for limb, part in _limbs(value)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if k == 3 else pa.int32()) for k, c in enumerate(zip(*found))], names=SUMS.names
            )

    totals: dict[tuple[int, int], int] = {}
    for r in rows.mapInArrow(add, SUMS).groupBy("i", "j", "limb").agg(F.sum("part").alias("part")).collect():
        totals[r.i, r.j] = totals.get((r.i, r.j), 0) + (r.part << (LIMB * r.limb))
    squares = [[totals.get((max(i, j), min(i, j)), 0) for j in range(d)] for i in range(d)]
    return totals.get((-1, -1), 0), [totals.get((i, -1), 0) for i in range(d)], squares


# -- the characteristic polynomial


def _is_prime(p: int) -> bool:
    """Miller-Rabin with bases that settle every number below 3 * 10^9."""
    if any(p % q == 0 for q in (2, 3, 5, 7, 11, 13)):
        return p in (2, 3, 5, 7, 11, 13)
    odd, twos = p - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, p)
        if x not in (1, p - 1) and all((x := x * x % p) != p - 1 for _ in range(twos - 1)):
            return False
    return True


def _primes(bits: int) -> list[int]:
    """Primes below 2^31, the largest first, whose product has more than ``bits`` bits."""
    out, have, p = [], 0, (1 << 31) - 1
    while have <= bits:
        if _is_prime(p):
            out.append(p)
            have += 30
        p -= 2
    return out


def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of ``det(x I - matrix)`` modulo a prime, the constant one first."""
    h = matrix % p
    d = len(h)
    for k in range(1, d - 1):
        pivots = np.flatnonzero(h[k:, k - 1])
        if not len(pivots):
            continue
        r = k + int(pivots[0])
        if r != k:
            h[[k, r]] = h[[r, k]]
            h[:, [k, r]] = h[:, [r, k]]
        ratio = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        if ratio.any():
            h[k + 1 :] = (h[k + 1 :] - ratio[:, None] * h[k] % p) % p
            h[:, k] = (h[:, k] + (h[:, k + 1 :] * ratio % p).sum(axis=1)) % p
    # Leading blocks: each one's polynomial from those of the smaller ones.
    leading = np.zeros((d + 1, d + 1), dtype=np.int64)
    leading[0, 0] = 1
    for k in range(1, d + 1):
        row = np.zeros(d + 1, dtype=np.int64)
        row[1:] = leading[k - 1, :-1]
        row = (row - h[k - 1, k - 1] * leading[k - 1]) % p
        below = 1
        for i in range(k - 1, 0, -1):
            below = below * int(h[i, i - 1]) % p
            if not below:
                break
            row = (row - below * int(h[i - 1, k - 1]) % p * leading[i - 1]) % p
        leading[k] = row
    return leading[d].tolist()


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Coefficients, the constant one first, of a symmetric matrix without negative eigenvalues."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    # The k-th coefficient is at most binom(d, k) * (trace / d)^k.
    bits = max(math.comb(d, k).bit_length() + k * (trace // d + 1).bit_length() for k in range(d + 1)) + 2
    primes = _primes(bits)
    schema = T.StructType([T.StructField("p", T.LongType()), T.StructField("c", T.ArrayType(T.LongType()))])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ps = batch.column(0).to_pylist()
            found = [polynomial_mod(np.array([[v % p for v in row] for row in matrix], dtype=np.int64), p) for p in ps]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=schema.names)

    tasks = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(math.ceil(len(primes) / PRIMES_PER_TASK))
    # Primes follow from the matrix's size, not from rows: the answer is (d + 1) numbers per prime.
    modulo, found = 1, np.zeros(d + 1, dtype=object)
    for r in tasks.mapInArrow(reduce, schema).collect():
        step = (np.array(r.c, dtype=object) - found) * pow(modulo, -1, r.p) % r.p
        found, modulo = found + step * modulo, modulo * r.p
    return [int(c) - modulo if 2 * int(c) > modulo else int(c) for c in found]


# -- its roots


def roots_beyond(poly: list[int], point: int) -> int:
    """How many roots, each as often as it occurs, lie beyond ``point``; all roots are real."""
    c = list(reversed(poly))
    if point:
        for end in range(len(c), 1, -1):
            for i in range(1, end):
                c[i] += point * c[i - 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(poly: list[int], point: int) -> int:
    out = 0
    for c in reversed(poly):
        out = out * point + c
    return out


def largest_roots(poly: list[int], most: int, bound: int) -> tuple[int, list[tuple[int, int]]]:
    """``(scale bits, [(root times 2^bits rounded up, times it occurs)])`` by falling root, positive ones only.

    Roots that stay together down to ``ROOT_BITS`` bits below the bound count as one.
    """
    bits = max(0, ROOT_BITS - bound.bit_length())
    d = len(poly) - 1
    scaled = [c << (bits * (d - k)) for k, c in enumerate(poly)]
    positive = roots_beyond(scaled, 0)
    todo, out, have = [(0, (bound << bits) + 1, positive, 0)], [], 0
    while todo and have < most:
        low, high, beyond_low, beyond_high = todo.pop()
        held = beyond_low - beyond_high
        if not held:
            continue
        if held == 1:
            sign = _value(scaled, high) > 0
            if _value(scaled, high):
                while high - low > 1:
                    middle = (low + high) // 2
                    value = _value(scaled, middle)
                    if not value:
                        high = middle
                        break
                    low, high = (low, middle) if (value > 0) == sign else (middle, high)
        elif high - low > 1:
            middle = (low + high) // 2
            beyond = roots_beyond(scaled, middle)
            todo += [(low, middle, beyond_low, beyond), (middle, high, beyond, beyond_high)]
            continue
        out.append((high, held))
        have += held
    return bits, out


# -- components


def null_vectors(matrix: list[list[int]], bits: int, root: int, count: int) -> list[list[float]]:
    """``count`` orthogonal unit vectors that ``matrix - root / 2^bits`` sends nearest to zero."""
    d = len(matrix)
    a = np.array(matrix, dtype=object) * (1 << bits)
    for i in range(d):
        a[i, i] -= root
    # Roundings stay far below the root's last bit.
    work = 2 * max(int(v).bit_length() for v in a.ravel()) + MORE_BITS
    a = a << work
    order = list(range(d))
    for k in range(d - 1):
        r = k + int(np.argmax(np.abs(a[k:, k])))
        if r != k:
            a[[k, r]] = a[[r, k]]
            order[k], order[r] = order[r], order[k]
        if not a[k, k]:
            a[k, k] = 1
        ratio = (a[k + 1 :, k] << work) // a[k, k]
        a[k + 1 :, k + 1 :] -= (ratio[:, None] * a[k, k + 1 :]) >> work
        a[k + 1 :, k] = ratio
    if not a[d - 1, d - 1]:
        a[d - 1, d - 1] = 1

    def solve(b: np.ndarray) -> np.ndarray:
        x = b[order]
        for k in range(1, d):
            x[k] -= int(a[k, :k].dot(x[:k])) >> work
        for k in range(d - 1, -1, -1):
            x[k] = ((x[k] - (int(a[k, k + 1 :].dot(x[k + 1 :])) >> work)) << work) // a[k, k]
        return x

    def unit(x: np.ndarray) -> np.ndarray:
        norm = math.isqrt(int(x.dot(x)))
        return (x << work) // norm if norm else x

    found: list[np.ndarray] = []
    for nth in range(count):
        # A start that no eigenvector of use is likely to be orthogonal to; it is fixed, so results repeat.
        x = np.array([(1 << work) + (((nth + 3) * (i + 1) * 7_919 % 1_009) << (work - 8)) for i in range(d)], dtype=object)
        for _ in range(3):
            x = unit(x)
            for _ in range(2):
                for known in found:
                    x = x - ((known * (int(x.dot(known)) >> work)) >> work)
            x = unit(solve(unit(x)))
        for _ in range(2):
            for known in found:
                x = x - ((known * (int(x.dot(known)) >> work)) >> work)
        found.append(unit(x))
    return [[int(v) / (1 << work) for v in x] for x in found]


def _components(spark, matrix: list[list[int]], bits: int, roots: list[tuple[int, int]]) -> np.ndarray:
    """Rows: the components in the order of the roots. One task per root."""
    schema = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("nth", T.IntegerType()), T.StructField("v", T.ArrayType(T.DoubleType()))])

    def iterate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column(0).to_pylist():
                found = null_vectors(matrix, bits, *roots[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at] * len(found), pa.int32()), pa.array(range(len(found)), pa.int32()), pa.array(found, pa.list_(pa.float64()))],
                    names=schema.names,
                )

    tasks = spark.createDataFrame([(k,) for k in range(len(roots))], "at int").repartition(len(roots), "at")
    rows = tasks.mapInArrow(iterate, schema).collect()
    return np.array([r.v for r in sorted(rows, key=lambda r: (r.at, r.nth))])


def _root_of(above: int, below: int) -> float:
    """Square root of a fraction, to double precision also where the fraction itself is out of a double's range."""
    return math.isqrt((above << 400) // below) / (1 << 200)


def learn(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """Fit on all rows of ``usable``; None if there is no spread at all."""
    n, sums, squares = _scatter(rows, d) if d else (0, [], [])
    matrix = [[n * squares[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    trace = sum(matrix[i][i] for i in range(d))
    if not trace:
        return None
    common = math.gcd(*(v for row in matrix for v in row))
    small = [[v // common for v in row] for row in matrix]
    spark = rows.sparkSession
    poly = characteristic_polynomial(spark, small)
    bits, roots = largest_roots(poly, components, trace // common)
    vectors = _components(spark, small, bits, roots)[:components]
    each = [root for root, times in roots for _ in range(times)][: len(vectors)]
    return Whitening(
        n, [s + SHIFT * n for s in sums], vectors,
        [_root_of(root * common, n * n << bits) for root in each], [root * common / (trace << bits) for root in each],
    )


def _projector(model: Whitening, d: int) -> Callable[[pa.RecordBatch], tuple[list[int], np.ndarray]]:
    """Function from a batch to the exact squared deviations and the whitened vectors by rows."""
    n, sums = model.n, [s - SHIFT * model.n for s in model.sums]
    turned = model.components.T / np.array(model.spreads)
    far = max(map(abs, sums), default=0)

    def project(batch: pa.RecordBatch) -> tuple[list[int], np.ndarray]:
        x = _integers(batch, d)
        most = int(np.abs(x).max()) if x.size else 0
        reach = n * most + far
        if x.dtype != object and reach * reach * d < 1 << 63:
            apart = x.astype(np.int64) * n - np.array(sums, dtype=np.int64)
            square = (apart * apart).sum(axis=1).tolist()
        else:
            if x.dtype != object:
                x = np.vectorize(int, otypes=[object])(x) if x.size else x.astype(object)
            apart = x * n - np.array(sums, dtype=object)
            square = [int(v) for v in (apart * apart).sum(axis=1)]
        return square, (apart / n).astype(np.float64) @ turned

    return project


def identity_error(rows: DataFrame, d: int, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity, over all rows."""
    project, k = _projector(model, d), len(model.spreads)
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("s", T.DoubleType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            _, w = project(batch)
            total += w.T @ w
        i, j = np.indices((k, k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=schema.names
        )

    off = F.abs(F.col("s") / F.lit(float(model.n)) - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    sums = rows.mapInArrow(add, schema).groupBy("i", "j").agg(F.sum("s").alias("s"))
    return sums.agg(F.max(off).alias("error")).collect()[0].error


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_text)``, a row per vector and component."""
    rows, d = usable(df, id_col, vector_col)
    model = learn(rows, d, components)
    schema = T.StructType([
        T.StructField("vec_id", rows.schema["vec_id"].dataType), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
        T.StructField("deviation_text", T.StringType()),
    ])
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    error, project, k = identity_error(rows, d, model), _projector(model, d), len(model.spreads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2_048):
                batch = whole.slice(at, 2_048)
                square, w = project(batch)
                m = len(square)
                again = pa.array(np.repeat(np.arange(m), k))
                fits = pa.array([s if s < 1 << 63 else None for s in square], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, model.n)), fits.take(again), pa.array(w.ravel()),
                        pa.array(np.tile(np.array(model.explained), m)), pa.array(np.full(m * k, error)),
                        pa.array([str(s) for s in square], pa.string()).take(again),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)
