"""Whitening of embeddings by exact arithmetic: the principal components of fixed-point vectors.

1. Every entry becomes an integer, so sums and products over all vectors are exact integers: one pass of the data gives the
   scatter matrix M = n^2 V of the covariance V, without a rounding error however far the data lie from zero.
2. The characteristic polynomial of M: modulo many primes of 31 bits, by reduction to Hessenberg form, one prime a row of a
   table; Chinese remaindering gives its integer coefficients. The number of primes follows from a bound of the
   coefficients, so the polynomial is exact.
3. All its roots are real. For such a polynomial the sign variations of the coefficients of p(x + a) are exactly the number
   of roots above a, multiplicities included; bisection on that count isolates the greatest roots, and exact signs of p
   narrow each one down to 2**-160 of the trace. Roots that agree that far are one multiple root.
4. Components: inverse iteration with M - e I in fixed-point arithmetic of some 300 bits, for a multiple root with a block of
   vectors, orthogonal to each other.

What the driver holds is bounded by the square of the dimension; vectors are met in Spark tasks only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from math import gcd, isqrt, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm.registry import query
from callweave.session import cut_lineage

#: Fixed point of the entries: x = floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Entries from here on do not fit a long after scaling by the number of rows; their vectors are left out.
LARGEST = float(1 << 40)
#: Roots are told apart down to the trace times two to the minus this.
BITS = 160
#: Bits behind the point when vectors are solved for.
POINT = 128
#: Steps of inverse iteration; each one takes the other components down by the root's resolution over the gap to the next root.
STEPS = 3


def usable(vector: Column) -> Column:
    """Whether a vector is there, not empty, and all its entries are finite numbers below the largest."""
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & whole, F.lit(False))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """floor(SCALE * c) of all entries, a row for each vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * SCALE).astype(np.int64).reshape(len(column), dims)


def _products(y: np.ndarray) -> np.ndarray:
    """Sum of the outer products of the rows, as Python integers."""
    top = max(int(np.abs(y).max()), 1) if y.size else 1
    rows = (1 << 53) // (top * top)
    out = np.zeros((y.shape[1], y.shape[1]), object)
    if not rows:
        y = y.astype(object)
        return y.T @ y
    # sums below 2**53 are exact in doubles
    for start in range(0, len(y), rows):
        part = y[start : start + rows].astype(np.float64)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def _moments(dims: int):
    upper = np.triu_indices(dims)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            y = _matrix(batch.column(0), dims)
            n += len(y)
            sums += y.sum(0).astype(object)
            products += _products(y)
        if n:
            values = [n, *sums.tolist(), *products[upper].tolist()]
            cells = pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), cells], names=["cell", "value"])

    return moments


def _tasks(spark: SparkSession, rows: list[tuple], schema: str, work: Callable) -> list[tuple]:
    """``work(index)`` of every row index in Spark tasks; its result rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pylist([work(rows[i])])

    parts = min(len(rows), max(spark.sparkContext.defaultParallelism, 1))
    return [tuple(r) for r in spark.range(0, len(rows), 1, parts).mapInArrow(run, schema).collect()]


def primes(bits: int) -> list[int]:
    """The greatest primes below 2**31 whose product has more than ``bits`` bits."""
    found, size, at = [], 0, (1 << 31) - 1
    while size <= bits:
        if _prime(at):
            found.append(at)
            size += at.bit_length() - 1
        at -= 2
    return found


def _prime(n: int) -> bool:
    """Deterministic for odd numbers of 31 bits."""
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(s - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x I - matrix) modulo ``p``, lowest power first."""
    h = (matrix % p).astype(np.int64)
    d = len(h)
    for j in range(d - 2):
        nonzero = np.flatnonzero(h[j + 1 :, j])
        if not len(nonzero):
            continue
        i = j + 1 + int(nonzero[0])
        h[[i, j + 1]] = h[[j + 1, i]]
        h[:, [i, j + 1]] = h[:, [j + 1, i]]
        u = h[j + 2 :, j] * pow(int(h[j + 1, j]), -1, p) % p
        h[j + 2 :] = (h[j + 2 :] - u[:, None] * h[j + 1] % p) % p
        h[:, j + 1] = (h[:, j + 1] + (h[:, j + 2 :] * u % p).sum(1)) % p
    # polynomials of the leading blocks, one after the other
    poly = np.zeros((d + 1, d + 1), np.int64)
    poly[0, 0] = 1
    for k in range(1, d + 1):
        poly[k, 1:] = poly[k - 1, :-1]
        below, factors = 1, np.empty(k, np.int64)
        for i in range(k):
            factors[i] = int(h[k - 1 - i, k - 1]) * below % p
            below = below * int(h[k - 1 - i, k - 2 - i]) % p if i < k - 1 else 0
        poly[k] = (poly[k] - (factors[:, None] * poly[k - 1 :: -1][:k] % p).sum(0)) % p
    return poly[d].tolist()


def remaindered(moduli: list[int], rows: list[list[int]]) -> list[int]:
    """The integers of least absolute value with the given remainders."""
    whole = 1
    for p in moduli:
        whole *= p
    parts = [whole // p * pow(whole // p, -1, p) for p in moduli]
    out = []
    for remainders in zip(*rows, strict=True):
        value = sum(r * part for r, part in zip(remainders, parts, strict=True)) % whole
        out.append(value - whole if value > whole // 2 else value)
    return out


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Exact det(x I - matrix) of a positive semidefinite matrix of Python integers, lowest power first."""
    d, trace = len(matrix), int(sum(matrix.diagonal()))
    # elementary symmetric sums of non-negative roots are greatest when all are equal
    moduli = primes(d * (trace // d + 2).bit_length() + 2)
    work = lambda p: {"p": p, "c": polynomial_modulo(matrix, p)}
    found = dict(_tasks(spark, moduli, "p long, c array<long>", work))
    return remaindered(moduli, [found[p] for p in moduli])


def _above(poly: list[int], at: int) -> int:
    """Number of roots above ``at``, for a polynomial with real roots only."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += at * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(poly: list[int], at: int) -> int:
    out = 0
    for c in reversed(poly):
        out = out * at + c
    return out


def greatest_roots(poly: list[int], count: int) -> tuple[list[tuple[int, int]], int]:
    """The greatest positive roots as (numerator, multiplicity), falling, and the power of two that is their denominator.

    Taken until they are ``count`` with multiplicities, or all positive ones; a numerator is off by 1 at most.
    """
    d = len(poly) - 1
    trace = -poly[d - 1]
    if trace <= 0:
        return [], 0
    shift = max(BITS - trace.bit_length(), 0)
    scaled = [c << (shift * (d - k)) for k, c in enumerate(poly)]
    out, taken = [], 0
    open_ = [(0, (trace << shift) + 1, _above(scaled, 0), 0)]  # low, high, roots above low, roots above high
    while open_ and taken < count:
        low, high, over_low, over_high = open_.pop()
        if over_low == over_high:
            continue
        if high - low == 1:
            out.append((high, over_low - over_high))
            taken += over_low - over_high
        elif over_low - over_high == 1:
            out.append((_narrowed(scaled, low, high), 1))
            taken += 1
        else:
            middle = (low + high) // 2
            over = _above(scaled, middle)
            open_ += [(low, middle, over_low, over), (middle, high, over, over_high)]
    return out, shift


def _narrowed(poly: list[int], low: int, high: int) -> int:
    """The only root in (low, high], rounded up."""
    top = _value(poly, high)
    while top and high - low > 1:
        middle = (low + high) // 2
        value = _value(poly, middle)
        if value == 0:
            return middle
        if (value > 0) == (top > 0):
            high = middle
        else:
            low = middle
    return high


def eigenvectors(matrix: np.ndarray, root: int, shift: int, count: int) -> np.ndarray:
    """``count`` orthonormal vectors of the null space of matrix - root / 2**shift, by inverse iteration."""
    d = len(matrix)
    a = np.array([[int(v) << (shift + POINT) for v in row] for row in matrix], object)
    for i in range(d):
        a[i, i] -= root << POINT
    order = list(range(d))
    for j in range(d):
        i = j + max(range(d - j), key=lambda k: abs(a[j + k, j]))
        if i != j:
            a[[i, j]] = a[[j, i]]
            order[i], order[j] = order[j], order[i]
        if not a[j, j]:
            a[j, j] = 1
        if j + 1 < d:
            factor = (a[j + 1 :, j] << POINT) // a[j, j]
            a[j + 1 :, j + 1 :] -= (factor[:, None] * a[j, j + 1 :]) >> POINT
            a[j + 1 :, j] = factor
    rng = np.random.default_rng(11)
    block = [np.array([int(v) << POINT for v in rng.integers(-1000, 1001, d)], object) for _ in range(count)]
    for _ in range(STEPS):
        block = _orthonormal([_solved(a, v[order]) for v in block])
    return np.array([[int(x) / (1 << POINT) for x in v] for v in block])


def _solved(lu: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solution by the triangles, brought to entries of POINT bits."""
    d = len(b)
    x = b.copy()
    for i in range(1, d):
        x[i] -= int((lu[i, :i] * x[:i]).sum()) >> POINT
    # many more bits, as the last pivots may be far smaller than the right side
    x = x << (BITS + POINT)
    for i in range(d - 1, -1, -1):
        rest = x[i] - (int((lu[i, i + 1 :] * x[i + 1 :]).sum()) >> POINT if i + 1 < d else 0)
        x[i] = (rest << POINT) // lu[i, i]
    excess = max(max(abs(int(v)) for v in x).bit_length() - POINT, 0)
    return x >> excess


def _orthonormal(block: list[np.ndarray]) -> list[np.ndarray]:
    out = []
    for v in block:
        for _ in range(2):
            for u in out:
                v = v - ((u * (int((u * v).sum()) >> POINT)) >> POINT)
            length = isqrt(int((v * v).sum())) or 1
            v = np.array([(int(x) << POINT) // length for x in v], object)
        out.append(v)
    return out


@dataclass
class Whitening:
    """Components fitted to ``n`` vectors of ``dims`` entries: sums of the integer entries without the offset, axes as rows,
    standard deviations and shares of the trace. A component without variance has deviation 0."""

    dims: int
    n: int
    sums: list[int]
    axes: np.ndarray
    deviations: list[float]
    explained: list[float]


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = 8) -> Whitening:
    """The ``components`` leading principal components of the usable vectors, fewer where they have fewer dimensions.

    Vectors that are null or empty or hold a null, a non-finite number or one of 2**40 or more are left out, and so are those
    whose length is not the most frequent one (of equally frequent ones the greatest). Repeated rows count as often as
    they come. Without a usable vector ``n`` and ``dims`` are 0. Axes are turned so that the entry of greatest size is positive.
    """
    spark = vectors.sparkSession
    known = vectors.select(F.col(f"`{vector_col}`").alias("v")).filter(usable(F.col("v")))
    lengths = known.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths is None:
        return Whitening(0, 0, [], np.zeros((0, 0)), [], [])
    dims = lengths["dims"]
    cells = known.filter(F.size("v") == dims).mapInArrow(_moments(dims), "cell int, value decimal(38,0)")
    # as many rows as a symmetric matrix has cells, whatever the number of vectors
    cells = dict(map(tuple, cells.groupBy("cell").agg(F.sum("value").cast("decimal(38,0)")).collect()))
    values = [int(cells[i]) for i in range(len(cells))]
    n, sums = values[0], values[1 : dims + 1]
    scatter = np.zeros((dims, dims), object)
    for i, j, v in zip(*np.triu_indices(dims), values[dims + 1 :], strict=True):
        scatter[i, j] = scatter[j, i] = n * v - sums[i] * sums[j]
    wanted = min(components, dims)
    common = gcd(*[int(x) for x in scatter.ravel()]) or 1
    reduced = scatter // common
    trace = int(sum(reduced.diagonal()))
    roots, shift = greatest_roots(characteristic_polynomial(spark, reduced), wanted) if trace else ([], 0)
    work = lambda r: {"root": str(r[0]), "axes": eigenvectors(reduced, r[0], shift, r[1]).tolist()}
    axes = dict(_tasks(spark, roots, "root string, axes array<array<double>>", work)) if roots else {}
    rows, deviations, explained = [], [], []
    for root, _ in roots:
        for axis in axes[str(root)]:
            axis = np.array(axis)
            rows.append(axis * (1 if axis[np.argmax(np.abs(axis))] > 0 else -1))
            deviations.append(sqrt(root * common / ((n * n) << shift)))
            explained.append(root / (trace << shift))
    while len(rows) < wanted:
        rows.append(np.zeros(dims))
        deviations.append(0.0)
        explained.append(0.0)
    return Whitening(dims, n, sums, np.array(rows[:wanted]).reshape(wanted, dims), deviations[:wanted], explained[:wanted])


def apply(vectors: DataFrame, fitted: Whitening, vector_col: str = "embedding") -> DataFrame:
    """``vectors`` with ``deviation`` (sum of (n x - S)^2, exact) and ``whitened``, the array of the components' values.

    Vectors that ``fit`` would leave out, and those of another length, give no row. The value of a component without variance
    is null. Other columns pass; input columns named ``deviation`` or ``whitened`` are replaced. An empty table gives an empty one.
    """
    kept = [c for c in vectors.columns if c not in ("deviation", "whitened")]
    rows = vectors.select(*[F.col(f"`{c}`") for c in kept])
    rows = rows.filter(usable(F.col(f"`{vector_col}`")) & (F.size(F.col(f"`{vector_col}`")) == fitted.dims))
    added = [T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([*rows.schema.fields, *added])
    at, n, dims, k = kept.index(vector_col), fitted.n, fitted.dims, len(fitted.deviations)
    sums, axes, scale = fitted.sums, fitted.axes, fitted.deviations

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch.column(at), dims)
            top = int(np.abs(y).max()) * n + max(map(abs, sums), default=0) if y.size else 0
            if top < 1 << 62:
                moved = y * n - np.array(sums, np.int64)
            else:
                moved = y.astype(object) * n - np.array(sums, object)
            exact = moved if top * top * dims < 1 << 62 else moved.astype(object)
            deviation = (exact * exact).sum(1)
            values = moved.astype(np.float64) / n @ axes.T / np.array([s or np.nan for s in scale])
            flat = pa.array(values.ravel(), pa.float64(), from_pandas=True)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * k, pa.int32()), flat)
            deviation = pa.array([Decimal(int(v)) for v in deviation], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([*batch.columns, deviation, lists], names=[*kept, "deviation", "whitened"])

    return rows.mapInArrow(whiten, schema)


def identity_error(whitened: DataFrame, fitted: Whitening) -> float:
    """Greatest entry by size of the covariance of ``whitened`` minus the identity, over components with variance."""
    live = [i for i, s in enumerate(fitted.deviations) if s]
    if not live:
        return 0.0
    value = lambda i: F.col("whitened")[i]
    means = whitened.agg(*[F.avg(value(i)) for i in live]).first()
    centred = {i: value(i) - F.lit(m) for i, m in zip(live, means, strict=True)}
    pairs = [(i, j) for i in live for j in live if i <= j]
    found = whitened.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs, strict=True))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark, folder):
    """Every vector's eight leading components, whitened."""
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    fitted = fit(vectors)
    rows = cut_lineage(apply(vectors, fitted).drop("embedding"))
    explained = F.array(*[F.lit(x) for x in fitted.explained]).cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"),
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(identity_error(rows, fitted)).alias("identity_error"),
    )
