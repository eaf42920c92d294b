"""Op 12: embedding whitening by mixed-precision refinement.

Entries become integers, so sums and the covariance are exact.  Its
eigenvectors are first computed in float32 and then corrected by Ogita-Aishima
iterations (matrix products only) in the widest float numpy has.  Where
eigenvalues lie too close for a correction, the vectors of that cluster are
separated by a small eigenproblem of their own.  All tables that leave Spark are
dimension by dimension, whatever the number of vectors.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StructField, StructType

from tidemark.llm.common import keep_columns, table

#: Fixed values of the contract: scale and shift of an entry.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Rows multiplied at once, and the size of an entry up to which their products are exact in float64: 2^10 * 2^21 * 2^21 < 2^53.
ROWS_AT_ONCE, EXACT_ENTRY = 1 << 10, 1 << 21
#: Entries beyond this have no exact long (they count as non-finite).
LARGEST = float(1 << 53)
WIDE = np.longdouble


def integer_rows(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Which vectors of a list column remain, and the integer matrix of those of each length (or of length ``dim``).

    A vector remains if it and all of its entries are there and finite and their integers exact."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(values * SCALE)
        bad = ~(np.abs(x) < LARGEST - SHIFT)
    starts = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])
    bad_before = np.concatenate([[0], np.cumsum(bad)])
    remains = (lengths >= 0) & (bad_before[starts[1:]] == bad_before[starts[:-1]])
    found = {}
    for n in np.unique(lengths[remains]) if dim is None else [dim]:
        rows = np.flatnonzero(remains & (lengths == n))
        at = starts[rows][:, None] + np.arange(n)[None, :]
        found[int(n)] = x[at].astype(np.int64) + SHIFT
    return remains if dim is None else remains & (lengths == dim), found


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` of integer matrices as Python integers."""
    total = np.zeros((a.shape[1], b.shape[1]), dtype=object)
    for i in range(0, len(a), ROWS_AT_ONCE):
        p, q = a[i:i + ROWS_AT_ONCE], b[i:i + ROWS_AT_ONCE]
        if max(np.abs(p).max(initial=0), np.abs(q).max(initial=0)) <= EXACT_ENTRY:
            total += (p.T.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
        else:
            total += p.T.astype(object) @ q.astype(object)
    return total


def _vectors(df: DataFrame, vector_col: str, run: Callable, schema: str) -> DataFrame:
    """``run`` over the Arrow arrays of the vector column, a generator of record batches per task."""
    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(b.column(0) for b in batches)

    return df.select(F.col(f"`{vector_col}`").alias("v")).mapInArrow(per_task, schema)


def _summed(parts: DataFrame) -> dict[tuple[int, int, int], int]:
    """Exact sums of the entries ``(len, i, j, s)`` that every task sends once, as ``{(len, i, j): sum}``.

    Its size follows from the dimension, not from the rows."""
    total = parts.groupBy("len", "i", "j").agg(F.sum(F.col("s").cast(DecimalType(38, 0))).alias("s")).collect()
    return {(r["len"], r["i"], r["j"]): int(r["s"]) for r in total}


_ENTRY = pa.schema([("len", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("s", pa.string())])


def _entries(dim: int, matrix: np.ndarray) -> pa.RecordBatch:
    i, j = (x.ravel() for x in np.indices(matrix.shape))
    return pa.record_batch([pa.array([dim] * len(i), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                            pa.array([str(v) for v in matrix.ravel()], pa.string())], schema=_ENTRY)


@dataclass
class Moments:
    """Exact moments of the integer vectors: count, sums, and n^2 times their covariance (divisor n)."""

    n: int
    sums: list[int]
    scaled: np.ndarray  # Python integers

    @property
    def dim(self) -> int:
        return len(self.sums)

    def covariance(self) -> np.ndarray:
        """The covariance in the widest float, each entry rounded once."""
        def wide(v: int) -> np.longdouble:
            q = Fraction(int(v), self.n * self.n)
            head = float(q)
            return WIDE(head) + WIDE(float(q - Fraction(head)))

        return np.array([[wide(v) for v in row] for row in self.scaled], dtype=WIDE).reshape(self.dim, self.dim)


def moments(df: DataFrame, vector_col: str) -> Moments | None:
    """Two passes: counts and sums, then products of the vectors less their integer means.

    Vectors of another length than the most frequent one (the longer on a tie) lack
    entries or have too many; they count as vectors with null entries."""
    def count(columns):
        sums, n = defaultdict(lambda: 0), defaultdict(int)
        for c in columns:
            for dim, x in integer_rows(c)[1].items():
                n[dim] += len(x)
                sums[dim] = sums[dim] + exact_product(np.ones((len(x), 1), np.int64), x)
        for dim, m in n.items():
            yield _entries(dim, np.concatenate([[[m]], sums[dim]], axis=1).astype(object))

    first = _summed(_vectors(df, vector_col, count, "len int, i int, j int, s string"))
    sizes = {k[0]: v for k, v in first.items() if k[2] == 0}
    if not sizes or not (dim := max(sizes, key=lambda d: (sizes[d], d))):
        return None
    n, sums = sizes[dim], [first[dim, 0, j + 1] for j in range(dim)]
    means = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)

    def multiply(columns):
        total = None
        for c in columns:
            y = integer_rows(c, dim)[1][dim] - means
            total = exact_product(y, y) + (0 if total is None else total)
        if total is not None:
            yield _entries(dim, total)

    second = _summed(_vectors(df, vector_col, multiply, "len int, i int, j int, s string"))
    products = np.array([[second[dim, i, j] for j in range(dim)] for i in range(dim)], dtype=object)
    rest = np.array([s - n * int(m) for s, m in zip(sums, means)], dtype=object)
    return Moments(n, sums, n * products - np.outer(rest, rest))


def _clusters(values: np.ndarray, gap) -> list[np.ndarray]:
    """Runs of sorted eigenvalues whose neighbours are within ``gap``, of two or more."""
    order = np.argsort(-values, kind="stable")
    cuts = np.flatnonzero(values[order][:-1] - values[order][1:] > gap) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def refined_eigen(a: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and orthonormal eigenvectors of the symmetric matrix ``a`` (of the widest float).

    Float32 vectors are the start.  A round forms R = I - X'X and S = X'AX and
    corrects X by X + XE.  E is R/2, which restores orthogonality, and an antisymmetric part that divides by differences
    of eigenvalues, so rounding errors can only turn the vectors.  Pairs closer than the round's error bound
    only take R/2; before that, the vectors of each such
    cluster are turned by the eigenvectors of their own small matrix,
    shifted by its mean eigenvalue so that the differences keep their digits.  The bound keeps E below 1/2, so
    every round contracts; what a cluster is shrinks with the bound."""
    dim = len(a)
    scale = np.abs(a).max(initial=0)
    if not scale:
        return np.zeros(dim, WIDE), np.eye(dim, dtype=WIDE)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    eye, norm = np.eye(dim, dtype=WIDE), np.sqrt((a * a).sum())
    floor = np.finfo(WIDE).eps * norm

    def state(x):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diagonal(s) / (1 - np.diagonal(r))
        off = s - np.diag(np.diagonal(s))
        return r, s, values, 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))

    best, idle = None, 0
    for _ in range(rounds):
        r, s, values, bound = state(x)
        if best is None or bound < best[0] / 2:
            idle = 0
        else:
            idle += 1
        if best is None or bound < best[0]:
            best = (bound, values, x.copy())
        if bound <= floor or idle == 3:
            break
        turned = False
        for c in _clusters(values, bound):
            own = x[:, c]
            small = own.T @ (a @ own) - values[c].mean() * (own.T @ own)
            top = np.abs(small).max()
            if top > floor:
                x[:, c] = own @ np.linalg.eigh((small / top).astype(np.float64))[1][:, ::-1].astype(WIDE)
                turned = True
        if turned:
            r, s, values, bound = state(x)
        gaps = values[None, :] - values[:, None]
        near = np.abs(gaps) <= bound
        mean = (values[None, :] + values[:, None]) / 2
        x = x + x @ (r / 2 + np.where(near, 0, (s + mean * r) / np.where(near, 1, gaps)))
    _, values, x = best
    r = eye - x.T @ x
    x = x + x @ ((r + r.T) / 4)  # orthogonality to the last digit, for eigenvalues that rounding makes tie too
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


@dataclass
class Whitener:
    """What the tasks need: bounded by the dimension."""

    moments: Moments
    values: np.ndarray
    projection: np.ndarray  # dim x components, divided by sqrt(e)
    explained: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates: integer parts are subtracted before anything is rounded."""
        n = self.moments.n
        whole = np.array([s // n for s in self.moments.sums], dtype=np.int64)
        rest = np.array([(s - int(w) * n) / n for s, w in zip(self.moments.sums, whole)])
        return ((x - whole).astype(np.float64) - rest) @ self.projection

    def deviations(self, x: np.ndarray) -> list[int]:
        """Per row the exact sum over dimensions of (n*x - S)^2."""
        n, sums = self.moments.n, self.moments.sums
        mean = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
        rest = [s - n * int(m) for s, m in zip(sums, mean)]
        y = x - mean
        if np.abs(y).max(initial=0) * max(1, *map(abs, rest)) < (1 << 62) // max(1, len(sums)) and np.abs(y).max(initial=0) <= EXACT_ENTRY:
            squares, crossed = (y * y).sum(axis=1).tolist(), (y @ np.array(rest, dtype=np.int64)).tolist()
        else:
            big = y.astype(object)
            squares, crossed = (big * big).sum(axis=1).tolist(), (big @ np.array(rest, dtype=object)).tolist()
        fixed = sum(r * r for r in rest)
        return [n * n * int(a) - 2 * n * int(b) + fixed for a, b in zip(squares, crossed)]


def fit(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitener | None:
    """The whitening of all remaining vectors of ``df``; None if there are none.

    Components whose eigenvalue is zero (within rounding of the trace) cannot be
    whitened and are left out."""
    m = moments(df, vector_col)
    if m is None:
        return None
    v = m.covariance()
    values, vectors = refined_eigen(v)
    trace = np.diagonal(v).sum()
    keep = int((values[:components] > trace * m.dim * WIDE(2.0 ** -50)).sum())
    projection = (vectors[:, :keep] / np.sqrt(values[:keep])).astype(np.float64)
    return Whitener(m, values.astype(np.float64), projection, (values[:keep] / trace if keep else values[:0]).astype(np.float64))


def identity_error(df: DataFrame, vector_col: str, w: Whitener) -> float:
    """Largest entry of the whitened vectors' covariance less the identity, measured in a pass over all of them."""
    k, dim = w.projection.shape[1], w.moments.dim

    def run(columns):
        total, sums = np.zeros((k, k)), np.zeros(k)
        for c in columns:
            z = w.project(integer_rows(c, dim)[1][dim])
            total, sums = total + z.T @ z, sums + z.sum(axis=0)
        both = np.concatenate([total, sums[None, :]])
        i, j = (x.ravel() for x in np.indices(both.shape))
        yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(both.ravel())], names=["i", "j", "s"])

    rows = _vectors(df, vector_col, run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    both = np.zeros((k + 1, k))
    for r in rows:
        both[r["i"], r["j"]] = r["s"]
    mean = both[k] / w.moments.n
    return float(np.abs(both[:k] / w.moments.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


PRODUCED = [StructField("component", IntegerType()), StructField("n", LongType()), StructField("deviation", DecimalType(38, 0)),
            StructField("whitened", DoubleType()), StructField("explained", DoubleType()), StructField("identity_error", DoubleType())]


def whiten(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component: the other columns of ``df`` and component, n, deviation, whitened,
    explained, identity_error.

    Dropped: null vectors, vectors with a null or non-finite entry (also one whose
    integer a double cannot hold exactly) or of another length than most.  Repeated
    rows count and are returned as often as they occur.  Tied eigenvalues share a space: which
    orthonormal vectors stand for it is arbitrary, but the same for all rows.  No
    row remains, or all remaining ones are equal: an empty result.  Columns of ``df`` that carry a produced name
    are replaced; the vector column is not returned."""
    spark = df.sparkSession
    others = [c for c in keep_columns(df, [f.name for f in PRODUCED]).columns if c != vector_col]
    out = StructType([df.schema[c] for c in others] + PRODUCED)
    w = fit(df, vector_col, components)
    if w is None or not w.projection.shape[1]:
        return spark.createDataFrame([], out)
    error, dim, k = identity_error(df, vector_col, w), w.moments.dim, w.projection.shape[1]
    inner = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(out)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            remains, found = integer_rows(b.column(b.num_columns - 1), dim)
            x = found[dim]
            rows = np.repeat(np.flatnonzero(remains), k)
            kept = [b.column(i).take(pa.array(rows)) for i in range(b.num_columns - 1)]
            deviation = pa.array([str(d) for d in w.deviations(x) for _ in range(k)], pa.string()).cast(pa.decimal128(38, 0))
            m = len(x)
            yield pa.RecordBatch.from_arrays(kept + [
                pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, w.moments.n), pa.int64()), deviation,
                pa.array(w.project(x).ravel()), pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, error))], names=inner.fieldNames())

    named = df.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{vector_col}`")).toDF(*[f"c{i}" for i in range(len(others) + 1)])
    return named.mapInArrow(run, inner).toDF(*out.fieldNames())


def q_whiten(spark, sf_dir):
    rows = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return rows.select("vec_id", "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained",
                       "identity_error")
