"""Embedding whitening by spectrum slicing.

Components become integers x = floor(64 c) + 1000000. Two passes over the vectors give their number and sums,
and the sum of outer products of the vectors centred at the rounded mean: integers, so they are exact
whatever the order of the tasks, and the covariance is rounded once. What reaches the driver is one d x d
matrix; its leading eigenpairs are found there:

1. ``inertia`` factors V - s I as L D L' (Bunch-Kaufman pivots). By Sylvester's law, the number of positive
   eigenvalues of D is the number of eigenvalues of V above s.
2. ``isolate`` slices the spectrum by such counts until each leading eigenvalue, or each group that is equal
   within rounding, has an interval of its own.
3. ``refine`` runs Rayleigh quotient iterations in the interval (cubic convergence) from an inverse iteration;
   a quotient that leaves the interval is dropped and the interval halved by another count.
4. Counts on both sides of every eigenvalue certify its number.

Rows are then projected in the tasks. ``identity_error`` is measured on the whitened rows in a pass of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import reachable, written

#: Entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
_EPS = np.finfo(float).eps
_EXACT = 1 << 53


# --- eigenpairs by spectrum slicing ------------------------------------------------------------


def inertia(a: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of the symmetric matrix ``a`` above ``shift``: positive eigenvalues of D in
    P (a - shift I) P' = L D L' with 1 x 1 and 2 x 2 pivots."""
    m = a - shift * np.eye(len(a))
    tiny = _EPS * max(float(np.abs(m).max(initial=0)), np.finfo(float).tiny / _EPS)
    limit, positive = (1 + math.sqrt(17)) / 8, 0
    while (n := len(m)) > 0:
        below = np.abs(m[1:, 0])
        r = int(below.argmax()) + 1 if n > 1 else 0
        most = float(below[r - 1]) if n > 1 else 0.0
        if max(abs(m[0, 0]), most) <= tiny:  # a zero of D, within rounding
            m = m[1:, 1:]
            continue
        two = False
        if abs(m[0, 0]) < limit * most:
            row = np.abs(m[r])
            row[r] = 0
            other = float(row.max())
            if abs(m[0, 0]) * other >= limit * most * most:
                pass
            elif abs(m[r, r]) >= limit * other:
                order = np.arange(n)
                order[[0, r]] = r, 0
                m = m[np.ix_(order, order)]
            else:
                two = True
                if r != 1:
                    order = np.arange(n)
                    order[[1, r]] = r, 1
                    m = m[np.ix_(order, order)]
        if two:
            d, c = m[:2, :2], m[2:, :2]
            det = d[0, 0] * d[1, 1] - d[0, 1] * d[1, 0]
            positive += 1 if det < 0 else 2 * int(d[0, 0] + d[1, 1] > 0)
            inverse = np.array([[d[1, 1], -d[0, 1]], [-d[1, 0], d[0, 0]]]) / det
            m = m[2:, 2:] - c @ inverse @ c.T
        else:
            positive += int(m[0, 0] > 0)
            c = m[1:, 0]
            m = m[1:, 1:] - np.outer(c, c / m[0, 0])
    return positive


@dataclass(frozen=True)
class Slice:
    """Eigenvalues number ``first`` to ``last`` (from 1, falling) lie in (low, high]."""
    low: float
    high: float
    first: int
    last: int


def isolate(a: np.ndarray, k: int) -> list[Slice]:
    """Slices of the ``k`` largest eigenvalues, one for each, or for each group that is equal within rounding."""
    radius = np.abs(a).sum(axis=1) - np.abs(np.diag(a))
    scale = max(float(np.abs(a).sum(axis=1).max(initial=0)), np.finfo(float).tiny)
    equal = 4 * len(a) * _EPS * scale
    low, high = float((np.diag(a) - radius).min()) - equal, float((np.diag(a) + radius).max()) + equal
    todo, done = [Slice(low, high, 1, len(a))], []
    while todo:
        s = todo.pop()
        if s.first == s.last or s.high - s.low <= equal:
            done.append(s)
            continue
        mid = (s.low + s.high) / 2
        above = min(max(inertia(a, mid), s.first - 1), s.last)
        if above < s.last and above < k:
            todo.append(Slice(s.low, mid, above + 1, s.last))
        if above >= s.first:
            todo.append(Slice(mid, s.high, s.first, above))
    return sorted(done, key=lambda s: s.first)


def _solved(a: np.ndarray, shift: float, x: np.ndarray) -> np.ndarray:
    """A unit vector along (a - shift I)^-1 x."""
    m = a - shift * np.eye(len(a))
    step = _EPS * max(float(np.abs(a).max()), np.finfo(float).tiny)
    for _ in range(8):
        try:
            y = np.linalg.solve(m, x)
            if np.isfinite(y).all() and (most := float(np.abs(y).max())) > 0:
                return y / most / float(np.linalg.norm(y / most))
        except np.linalg.LinAlgError:
            pass
        m = m + step * np.eye(len(a))  # the shift is an eigenvalue to the last bit
        step *= 2
    return x / np.linalg.norm(x)


def _cleared(x: np.ndarray, near: list[np.ndarray]) -> np.ndarray:
    """x made orthogonal to earlier vectors, as a unit vector."""
    for _ in range(2):
        for v in near:
            x = x - (v @ x) * v
    return x / np.linalg.norm(x)


def refine(a: np.ndarray, s: Slice, near: list[np.ndarray], start: np.ndarray) -> tuple[float, np.ndarray, Slice]:
    """The eigenpair in slice ``s`` (one eigenvalue): (value, unit vector, the slice as narrowed)."""
    scale = max(float(np.abs(a).sum(axis=1).max()), np.finfo(float).tiny)
    while True:
        x = _cleared(start, near)
        for _ in range(2):
            x = _cleared(_solved(a, (s.low + s.high) / 2, x), near)
        rho, best = float(x @ a @ x), (math.inf, 0.0, x)
        for _ in range(12):
            if not s.low <= rho <= s.high:
                break
            residual = float(np.linalg.norm(a @ x - rho * x))
            stalled = residual >= best[0] / 2
            best = min(best, (residual, rho, x), key=lambda b: b[0])
            if residual == 0 or stalled and best[0] <= 64 * len(a) * _EPS * scale:
                return best[1], best[2], s
            x = _cleared(_solved(a, rho, x), near)
            rho = float(x @ a @ x)
        if s.high - s.low <= 4 * len(a) * _EPS * scale:
            return rho, x, s
        mid = (s.low + s.high) / 2
        s = Slice(mid, s.high, s.first, s.last) if inertia(a, mid) >= s.first else Slice(s.low, mid, s.first, s.last)


def _parted(a: np.ndarray, values: np.ndarray, q: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Plane rotations between vectors of nearly equal eigenvalues, which iterations alone leave mixed."""
    for _ in range(3):
        h = q.T @ a @ q
        for i in range(len(values)):
            for j in range(i + 1, len(values)):
                if abs(h[i, i] - h[j, j]) > 1e-6 * scale or abs(h[i, j]) <= _EPS * scale / 8:
                    continue
                t = math.atan2(2 * h[i, j], h[i, i] - h[j, j]) / 2
                if abs(t) > math.pi / 4:
                    t -= math.copysign(math.pi / 2, t)
                turn = np.array([[math.cos(t), -math.sin(t)], [math.sin(t), math.cos(t)]])
                q[:, [i, j]] = q[:, [i, j]] @ turn
                h[:, [i, j]] = h[:, [i, j]] @ turn
                h[[i, j]] = turn.T @ h[[i, j]]
    return np.einsum("ij,ik,kj->j", q, a, q), q


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (falling) and their unit vectors in columns, numbers certified by counts."""
    d, k = len(a), min(k, len(a))
    if not k:
        return np.zeros(0), np.zeros((d, 0))
    scale = max(float(np.abs(a).sum(axis=1).max()), np.finfo(float).tiny)
    values, vectors = [], []
    r = np.random.default_rng(7)  # fixed start vectors: reruns agree
    for s in isolate(a, k):
        for number in range(s.first, min(s.last, k) + 1):
            near = [v for e, v in zip(values, vectors) if e - s.high <= 1e-3 * scale]
            if s.first == s.last:
                value, vector, _ = refine(a, s, near, r.standard_normal(d))
            else:  # equal within rounding: any orthogonal vectors of the slice
                vector, middle = _cleared(r.standard_normal(d), near), (s.low + s.high) / 2
                for _ in range(4):
                    vector = _cleared(_solved(a, middle, vector), near)
                value = float(vector @ a @ vector)
            values.append(value)
            vectors.append(vector)
    values, q = _parted(a, np.array(values), np.array(vectors).T, scale)
    order = np.argsort(-values, kind="stable")
    values, q = values[order], q[:, order]
    margin = 16 * d * _EPS * scale
    for number, value in enumerate(values, 1):
        if not inertia(a, value + margin) < number <= inertia(a, value - margin):
            raise ArithmeticError(f"eigenvalue {number} is not certified by the counts")
    return values, q * np.sign(q[np.abs(q).argmax(axis=0), np.arange(k)])


# --- exact sums over the rows ---------------------------------------------------------------


def _finite(vec: Column) -> Column:
    return F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x): the integers of the vectors without null or non-finite entries."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0)).filter(_finite(F.col("v")))
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


@dataclass(frozen=True)
class Whitening:
    """The fit: n vectors with sums S, eigenvalues (falling), unit vectors in columns, trace and covariance."""
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    covariance: np.ndarray


def _outer_sums(rows: DataFrame, centre: np.ndarray) -> tuple[list[list[int]], list[int]]:
    """Exact sums of y y' (upper half, by rows) and y for y = x - centre."""
    d = len(centre)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = np.zeros((d, d), object), np.zeros(d, object)
        for b in batches:
            y = _matrix(b["x"], d) - centre
            first += y.sum(axis=0, dtype=np.int64) if np.abs(y).max(initial=0) < _EXACT >> 20 else y.astype(object).sum(axis=0)
            most = int(np.abs(y).max(initial=0))
            step = _EXACT // max(1, most * most)  # so many rows' products add up exactly in doubles
            if step:
                for k in range(0, len(y), step):
                    f = y[k:k + step].astype(float)
                    total += (f.T @ f).astype(np.int64).astype(object)
            elif len(y):
                total += y.T.astype(object) @ y.astype(object)
        i, j = np.triu_indices(d)
        yield pa.record_batch([pa.array(np.append(i, np.full(d, -1)), pa.int32()), pa.array(np.append(j, np.arange(d)), pa.int32()),
                               pa.array([str(v) for v in [*total[i, j], *first]])], names=["i", "j", "s"])

    parts = rows.select("x").mapInArrow(add, "i int, j int, s string")
    sums = parts.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    outer, first = [[0] * d for _ in range(d)], [0] * d
    for r in sums.toLocalIterator():  # d (d + 3) / 2 rows, however many vectors there are
        if r.i < 0:
            first[r.j] = int(r.s)
        else:
            outer[r.i][r.j] = outer[r.j][r.i] = int(r.s)
    return outer, first


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on all ``rows`` (vec_id, x) of one length; None if there are none."""
    head = rows.select("x", F.size("x").alias("d"))
    total = head.agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("d")).first()
    if not total.n:
        return None
    n, d = int(total.n), int(total.d)
    sums = [0] * d
    for r in (head.select(F.posexplode("x").alias("j", "c")).groupBy("j")
              .agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s")).toLocalIterator()):  # d rows
        sums[r.j] = int(r.s)
    centre = np.array([round(Fraction(s, n)) for s in sums], np.int64)
    outer, first = _outer_sums(rows, centre)
    # centred products, rounded once: sum (y - m)(y - m)' / n with m = sum y / n
    v = np.array([[float(Fraction(n * outer[i][j] - first[i] * first[j], n * n)) for j in range(d)] for i in range(d)])
    trace = float(sum(Fraction(n * outer[i][i] - first[i] * first[i], n * n) for i in range(d)))
    if not trace:  # all vectors are equal
        return Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), trace, v)
    values, vectors = leading(v, components)
    keep = values > 64 * d * _EPS * max(trace, np.finfo(float).tiny)  # no direction of no variance
    return Whitening(n, sums, values[keep], vectors[:, keep], trace, v)


def _projector(fit: Whitening):
    """x matrix -> (whitened matrix, exact deviations)."""
    d, n, sums = len(fit.sums), fit.n, fit.sums
    centre = [s // n for s in sums]
    rest = np.array([float(Fraction(s - n * c, n)) for s, c in zip(sums, centre)])  # S / n = centre + rest
    base, left = np.array(centre, np.int64), [s - n * c for s, c in zip(sums, centre)]
    scaled = fit.vectors / np.sqrt(fit.values)

    def project(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = x - base
        most = int(np.abs(y).max(initial=0))
        if (n * (most + 1)) ** 2 * d < 1 << 63:
            z = n * y - np.array(left, np.int64)
            dev = (z * z).sum(axis=1)
        else:  # beyond 64 bits on the way: whole numbers of any size
            z = n * y.astype(object) - np.array(left, object)
            dev = np.array([int(v) for v in (z * z).sum(axis=1)], object)
        return (y - rest) @ scaled, dev

    return project


def identity_error(rows: DataFrame, fit: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance (centred, divisor n) minus the identity."""
    k, d = len(fit.values), len(fit.sums)
    if not k:
        return 0.0
    project = _projector(fit)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = np.zeros((k, k)), np.zeros(k)
        for b in batches:
            w, _ = project(_matrix(b["x"], d))
            total += w.T @ w
            first += w.sum(axis=0)
        i, j = np.triu_indices(k)
        yield pa.record_batch([pa.array(np.append(i, np.full(k, -1)), pa.int32()), pa.array(np.append(j, np.arange(k)), pa.int32()),
                               pa.array(np.append(total[i, j], first))], names=["i", "j", "s"])

    parts = rows.select("x").mapInArrow(add, "i int, j int, s double")
    cov, mean = np.zeros((k, k)), np.zeros(k)
    for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).toLocalIterator():  # k (k + 3) / 2 rows
        if r.i < 0:
            mean[r.j] = r.s / fit.n
        else:
            cov[r.i, r.j] = cov[r.j, r.i] = r.s / fit.n
    # the rows are centred already: what is left of their mean is rounding
    return float(np.abs(cov - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per remaining vector and component: vec_id, component (from 1, falling eigenvalue), n, deviation
    (exact), whitened, explained, identity_error.

    Vectors that are null, empty or hold null or non-finite entries are dropped. Of vectors of several lengths
    those of the most frequent length stay (the larger one on a tie). Components are at most the vectors'
    length; directions without variance (within rounding) have none, so a single vector or equal vectors give
    no rows. Rows that repeat an id are vectors of their own; an empty table gives an empty one; other columns
    are not looked at. A deviation beyond 64 bits is an error, as it cannot be a long.
    """
    reachable(df.sparkSession)
    rows = whole_vectors(df, id_col, vec_col)
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("k"), F.desc("d")).limit(1).collect()
    if sizes:
        rows = rows.filter(F.size("x") == sizes[0].d)
    rows = written(rows, "whitening-rows")
    fit = fit_whitening(rows, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fit is None or not len(fit.values):
        return df.sparkSession.createDataFrame([], schema)
    error, project = identity_error(rows, fit), _projector(fit)
    k, d, n = len(fit.values), len(fit.sums), fit.n
    explained = fit.values / fit.trace

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                w, dev = project(_matrix(part["x"], d))
                m = len(w)
                yield pa.record_batch([
                    part["vec_id"].take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)), pa.array(np.repeat(dev, k), pa.int64()), pa.array(w.ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(put, schema)
