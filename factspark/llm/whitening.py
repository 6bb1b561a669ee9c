"""Whitening of embeddings on exact principal components.

Entries become integers, so that the scatter matrix of the distinct vectors is exact. Its
characteristic polynomial is found modulo many primes, by reduction to Hessenberg form
spread over tasks, and put together by Chinese remaindering. All its roots are real, so
that the signs of its shifted coefficients count the roots above any bound; the largest
ones are bracketed that way and then narrowed to many more digits than a double holds.
Inverse iteration in the null space of the matrix less each root gives the components.

What the driver holds depends on the length of the vectors alone, never on their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Context, Decimal, localcontext
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factspark.llm.blocks import gather, prepare
from factspark.llm.components import stored

#: Bits of an integer that enter a matrix product at once, and rows of one product: sums
#: of so many products of such numbers are exact in doubles.
LIMB_BITS = 16
PRODUCT_ROWS = 4096
#: Leading bits to which roots are narrowed, and digits of the inverse iteration.
ROOT_BITS = 224
DIGITS = 120
#: Solutions taken one from the other; each brings out the component by the root's accuracy.
ITERATIONS = 3

_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(vector: Column) -> Column:
    """Whether all entries are finite numbers; false for null."""
    infinite = (float("inf"), float("-inf"))
    return F.coalesce(~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | c.isin(*infinite)), F.lit(False))


def fixed_point(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """``vec_id`` and the whole numbers ``x`` = floor(scale * entry) of all usable vectors."""
    found = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{vector_column}`").cast("array<double>").alias("v")
    )
    return found.filter(usable(F.col("v"))).select("vec_id", F.transform("v", lambda c: F.floor(scale * c).cast("long")).alias("x"))


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    values = column.combine_chunks()
    values = pa.concat_arrays(values.chunks) if isinstance(values, pa.ChunkedArray) else values
    return np.asarray(values.flatten()).reshape(len(values), size)


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """``x`` as a sum of parts of few bits, the k-th times 2 ** (LIMB_BITS * k)."""
    out = []
    while x.size and (x.max() >= 1 << LIMB_BITS or x.min() < -(1 << LIMB_BITS)):
        out.append((x & ((1 << LIMB_BITS) - 1)).astype(np.float64))
        x = x >> LIMB_BITS
    return [*out, x.astype(np.float64)]


def moments(x: np.ndarray) -> dict[int, np.ndarray]:
    """Sums of products and, in the last column, sums of entries, in units of 2 ** (LIMB_BITS * key)."""
    size = x.shape[1]
    out: dict[int, np.ndarray] = {}
    for first in range(0, len(x), PRODUCT_ROWS):
        parts = limbs(x[first : first + PRODUCT_ROWS])
        for a, left in enumerate(parts):
            for b, right in enumerate(parts):
                out.setdefault(a + b, np.zeros((size, size + 1), np.int64))[:, :size] += (left.T @ right).astype(np.int64)
            out[a][:, size] += left.sum(0).astype(np.int64)
    return out


def scatter(fit: DataFrame, size: int) -> tuple[int, list[int], list[list[int]]]:
    """The number n of vectors, their sums S, and n * (sum of products) - S S', all exact."""
    prepare(fit.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for table in gather(batches):
            for place, sums in moments(_matrix(table["x"], size)).items():
                total[place] = total[place] + sums if place in total else sums
        row, column = np.divmod(np.arange(size * (size + 1)), size + 1)
        kept = row <= column
        for place, sums in total.items():
            yield pa.record_batch({
                "i": pa.array(row[kept], pa.int32()), "j": pa.array(column[kept], pa.int32()),
                "place": pa.array(np.full(kept.sum(), place), pa.int32()), "value": pa.array(sums.ravel()[kept], pa.int64()),
            })

    sums = fit.mapInArrow(run, "i int, j int, place int, value long")
    sums = sums.groupBy("i", "j", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    exact = [[0] * (size + 1) for _ in range(size)]
    for r in sums.collect():
        exact[r["i"]][r["j"]] += int(r["value"]) << (LIMB_BITS * r["place"])
    n, total = fit.count(), [row[size] for row in exact]
    return n, total, [[n * exact[min(i, j)][max(i, j)] - total[i] * total[j] for j in range(size)] for i in range(size)]


def _is_prime(n: int) -> bool:
    """Exact below 2 ** 32."""
    if n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 7, 61):
        x = pow(base, odd, n)
        if x in (0, 1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return n > 1


def primes_for(bound: int) -> list[int]:
    """Primes below 2 ** 31, the largest first, whose product is above twice ``bound``."""
    out, product, candidate = [], 1, (1 << 31) - 1
    while product <= 2 * bound:
        if _is_prime(candidate):
            out.append(candidate)
            product *= candidate
        candidate -= 2
    return out


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """The characteristic polynomial modulo the prime ``p``, the constant first."""
    h = matrix % p
    d = len(h)
    for k in range(1, d - 1):
        rows = np.flatnonzero(h[k:, k - 1])
        if not len(rows):
            continue
        r = k + int(rows[0])
        h[[k, r]] = h[[r, k]]
        h[:, [k, r]] = h[:, [r, k]]
        factor = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factor[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factor % p).sum(1)) % p
    # Leading parts of a Hessenberg matrix: each one's polynomial from those before.
    out = np.zeros((d + 1, d + 1), np.int64)
    out[0, 0] = 1
    for k in range(1, d + 1):
        weights = np.empty(k, np.int64)
        step = 1
        for i in range(k - 1, -1, -1):
            weights[i] = step * int(h[i, k - 1]) % p
            step = step * int(h[i, i - 1]) % p
        out[k, 1:] = out[k - 1, :-1]
        out[k] = (out[k] - (weights[:, None] * out[:k] % p).sum(0)) % p
    return out[d]


def polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """The characteristic polynomial of a symmetric matrix without negative eigenvalues, the constant first."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    primes = primes_for(max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1)))
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("id").to_pylist()
            found = []
            for k in places:
                reduced = np.array([[x % primes[k] for x in row] for row in matrix], np.int64)
                found.append(polynomial_modulo(reduced, primes[k]).tolist())
            yield pa.record_batch({"id": batch.column("id"), "found": pa.array(found, pa.list_(pa.int64()))})

    tasks = spark.range(0, len(primes), 1, min(len(primes), 4 * spark.sparkContext.defaultParallelism))
    rows = tasks.mapInArrow(run, "id long, found array<long>").collect()
    product = math.prod(primes)
    out = [0] * (d + 1)
    for r in rows:
        rest = product // primes[r["id"]]
        unit = rest * pow(rest, -1, primes[r["id"]])
        for i, x in enumerate(r["found"]):
            out[i] += x * unit
    out = [x % product for x in out]
    return [x - product if 2 * x > product else x for x in out]


def roots_above(coefficients: Sequence[int], bound: int) -> int:
    """How many roots of a polynomial with only real roots lie above ``bound``, repeats counted."""
    shifted = list(coefficients)
    d = len(shifted) - 1
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            shifted[j] += bound * shifted[j + 1]
    signs = [x > 0 for x in shifted if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(coefficients: Sequence[int], at: int) -> int:
    out = 0
    for c in reversed(coefficients):
        out = out * at + c
    return out


def _scaled(coefficients: Sequence[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2 ** bits times as large."""
    d = len(coefficients) - 1
    return [c << (bits * (d - i)) for i, c in enumerate(coefficients)]


def _narrowed(coefficients: Sequence[int], rank: int, low: int, high: int) -> int:
    """The whole number at or next above the rank-th largest root, which lies in (low, high]."""
    above_low, above_high = roots_above(coefficients, low), roots_above(coefficients, high)
    while high - low > 1:
        middle = (low + high) // 2
        if above_low - above_high == 1:
            # One simple root is left in between: its side shows in the sign.
            value = _value(coefficients, middle)
            above = (value > 0) == (above_low % 2 == 0) if value else False
        else:
            count = roots_above(coefficients, middle)
            above = count >= rank
        if above:
            low, above_low = middle, above_low if above_low - above_high == 1 else count
        else:
            high, above_high = middle, above_high if above_low - above_high == 1 else count
    return high


def largest_roots(coefficients: Sequence[int], count: int) -> list[Fraction]:
    """The largest positive roots of a polynomial with only real roots, none negative, to ROOT_BITS bits."""
    zeros = next(i for i, c in enumerate(coefficients) if c)
    kept = list(coefficients[zeros:])
    d = len(kept) - 1
    out = []
    high = 1 + max(-kept[d - 1], 0) if d else 0
    for rank in range(1, min(count, d) + 1):
        top = _narrowed(kept, rank, 0, high)
        bits = 0
        while top.bit_length() < ROOT_BITS:
            more = ROOT_BITS + 1 - top.bit_length()
            bits += more
            top = _narrowed(_scaled(kept, bits), rank, (top - 1) << more, top << more)
        out.append(Fraction(2 * top - 1, 1 << (bits + 1)))
        high = -(-top >> bits) if bits else top
    return out


def _solve(rows: np.ndarray, right: np.ndarray, least: Decimal) -> np.ndarray:
    """Elimination with row exchanges on numbers of many digits; a vanishing pivot counts as ``least``."""
    a = np.concatenate([rows, right[:, None]], axis=1)
    d = len(a)
    for k in range(d):
        r = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if r != k:
            a[[k, r]] = a[[r, k]]
        if abs(a[k, k]) < least:
            a[k, k] = least
        if k + 1 < d:
            a[k + 1 :, k:] = a[k + 1 :, k:] - (a[k + 1 :, k] / a[k, k])[:, None] * a[k, k:]
    x = np.array([Decimal(0)] * d, object)
    for k in range(d - 1, -1, -1):
        x[k] = (a[k, d] - (a[k, k + 1 : d] * x[k + 1 :]).sum()) / a[k, k]
    return x


def components(matrix: list[list[int]], roots: Sequence[Fraction]) -> np.ndarray:
    """Unit eigenvectors of a symmetric matrix for its ``roots``, as columns; equal roots get orthogonal ones."""
    d = len(matrix)
    found: list[np.ndarray] = []
    with localcontext(Context(prec=DIGITS, Emax=10**9, Emin=-(10**9))):
        exact = np.array([[Decimal(x) for x in row] for row in matrix], object)
        for root in roots:
            value = Decimal(root.numerator) / Decimal(root.denominator)
            shifted = exact.copy()
            for i in range(d):
                shifted[i, i] = exact[i, i] - value
            least = value * Decimal(10) ** (5 - DIGITS)
            vector = np.array([Decimal(1 + (7 * i + 3 * len(found)) % 11) for i in range(d)], object)
            for _ in range(ITERATIONS):
                for other in found:
                    vector = vector - (vector * other).sum() * other
                vector = _solve(shifted, vector / (vector * vector).sum().sqrt(), least)
                for other in found:
                    vector = vector - (vector * other).sum() * other
                vector = vector / (vector * vector).sum().sqrt()
            found.append(vector)
        return np.array([[float(x) for x in v] for v in found], np.float64).reshape(len(found), d).T


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: as 64-bit numbers where they fit, else as Python's."""
        largest = max(int(x.max()), -int(x.min())) if x.size else 0
        if self.n * largest + max(map(abs, self.sums)) < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def project(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.vectors / np.sqrt(self.values)


def fit_whitening(fit: DataFrame, size: int, count: int) -> Whitening:
    """The whitening by the largest ``count`` components of the vectors ``x`` of ``fit``."""
    n, sums, matrix = scatter(fit, size)
    trace = sum(matrix[i][i] for i in range(size))
    roots = largest_roots(polynomial(fit.sparkSession, matrix), count) if trace else []
    values = np.array([float(r / n**2) for r in roots])
    explained = np.array([float(r / trace) for r in roots])
    return Whitening(n, sums, components(matrix, roots), values, explained)


def identity_error(fit: DataFrame, size: int, model: Whitening) -> float:
    """How far the covariance of the whitened ``fit`` is from the identity: the largest difference."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, total = np.zeros((k, k)), np.zeros(k)
        for table in gather(batches):
            w = model.project(model.centred(_matrix(table["x"], size)))
            products += w.T @ w
            total += w.sum(0)
        yield pa.record_batch({"place": pa.array(range(k * k + k)), "value": pa.array(np.append(products.ravel(), total))})

    sums = fit.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    found = np.array([r["value"] for r in sorted(sums, key=lambda r: r["place"])]) / model.n
    products, means = found[: k * k].reshape(k, k), found[k * k :]
    return float(np.abs(products - np.outer(means, means) - np.eye(k)).max())


def _deviations(centred: np.ndarray) -> pa.Array:
    """Sums of squares of rows, exact; null where one does not fit 64 bits."""
    if centred.dtype != object:
        largest = max(int(centred.max()), -int(centred.min())) if centred.size else 0
        if largest**2 * centred.shape[1] < 1 << 63:
            return pa.array((centred * centred).sum(1), pa.int64())
        centred = centred.astype(object)
    sums = (centred * centred).sum(1).tolist()
    return pa.array([x if x < 1 << 63 else None for x in sums], pa.int64())


def _whitened(points: DataFrame, size: int, model: Whitening, error: float) -> DataFrame:
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            centred = model.centred(_matrix(table["x"], size))
            rows = np.repeat(np.arange(len(table)), k)
            yield pa.record_batch({
                "vec_id": table["vec_id"].combine_chunks().take(pa.array(rows)),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(table))),
                "n": pa.array(np.full(len(rows), model.n, np.int64)),
                "deviation": _deviations(centred).take(pa.array(rows)),
                "whitened": pa.array(model.project(centred).ravel()),
                "explained": pa.array(np.tile(model.explained, len(table))),
                "identity_error": pa.array(np.full(len(rows), error)),
            })

    return points.mapInArrow(run, _RESULT)


def whiten(
    vectors: DataFrame, count: int = 4, scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable vector.

    A vector is usable if it is not null and all entries are finite. Entries become
    floor(scale * entry), held to 64 bits; each distinct vector counts once for means,
    covariances and components. Repeated rows give repeated results; a null id stays
    null. Vectors of each length are a space of their own, fitted one length after the
    other. Components without variance are left out, so that equal vectors, a single one
    or empty ones give no rows, and so does an empty table. ``deviation`` is null where it
    does not fit 64 bits. Other columns are ignored.
    """
    points = stored(fixed_point(vectors, id_column, vector_column, scale), "fixed-points")
    fit = stored(points.select("x").distinct(), "distinct-points")
    sizes = sorted(r["size"] for r in fit.select(F.size("x").alias("size")).distinct().collect())
    found = []
    for size in filter(None, sizes):
        mine = fit.filter(F.size("x") == size)
        model = fit_whitening(mine, size, count)
        if len(model.values):
            found.append(_whitened(points.filter(F.size("x") == size), size, model, identity_error(mine, size, model)))
    if not found:
        return vectors.sparkSession.createDataFrame([], _RESULT)
    return reduce(DataFrame.unionByName, found)
