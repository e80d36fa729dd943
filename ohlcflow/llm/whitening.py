"""Operator 11: embedding whitening with eigenvectors by contour integration.

Spark reduces the table to counts, exact sums and one centred d x d scatter
matrix (partial sums per partition, then an aggregate by matrix entry); only
these d * d numbers, which do not grow with the table, reach the driver. There
FEAST finds the leading eigenpairs: a contour around the wanted part of the
spectrum, quadrature of the resolvent applied to a random block by complex
shifted solves, Rayleigh-Ritz in the filtered space, repeated until the
residuals stop at rounding level. Sylvester's inertia, counted by a pivoted
symmetric factorisation of the shifted matrix, places the contour in the gap
below the last wanted eigenvalue and verifies that the contour holds exactly as
many eigenvalues as pairs were found; if not, the block is enlarged.

Entries c become x = floor(scale * c) + shift. Means are removed in integer
arithmetic before anything is multiplied.

Defined cases: a vector that is null, empty, or holds null or non-finite
entries takes no part; where lengths differ, the most frequent length does
(the shortest of equally frequent ones); rows are not made distinct; a null
vec_id is a row like others; components are those whose eigenvalue is above
rounding level (d * 2^-52 of the largest), so a table without variance, or
without rows, gives none; entries beyond 2^52 after scaling are cut to it;
deviations that pass 64 bits (some 10^6
rows do it) are null in ``deviation`` and whole in ``deviation_exact``, null
there beyond 38 digits; eigenvectors of equal eigenvalues are
any orthonormal ones, their largest entry positive; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE, SHIFT = 1024, 100000
COMPONENTS = 8
NODES = 16                 # quadrature points on the half circle
ROUNDS = 40                # of one block size
EPS = np.finfo(float).eps
LARGE = 2.0 ** 52
EXACT = "decimal(38,0)"


# ------------------------------------------------------------------ eigenpairs
def inertia(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric matrix lie above ``shift``: the
    positive pivots of a completely pivoted factorisation with 1 x 1 and 2 x 2
    blocks (Bunch and Parlett)."""
    m = a - shift * np.eye(len(a))
    above, alpha = 0, (1 + 17 ** 0.5) / 8
    while len(m):
        size = np.abs(m)
        diag = np.diagonal(size)
        p = int(diag.argmax())
        off = size - np.diag(diag)
        i, j = np.unravel_index(int(off.argmax()), off.shape)
        if diag[p] == 0 and off[i, j] == 0:
            break
        pivot = [p] if diag[p] >= alpha * off[i, j] else [int(i), int(j)]
        rest = np.setdiff1d(np.arange(len(m)), pivot)
        block, side = m[np.ix_(pivot, pivot)], m[np.ix_(rest, pivot)]
        above += int(block[0, 0] > 0) if len(pivot) == 1 else 1          # a 2 x 2 pivot is indefinite
        m = m[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        m = (m + m.T) / 2
    return above


def bounds(a: np.ndarray) -> tuple[float, float]:
    """An interval that holds all eigenvalues (Gershgorin)."""
    d, r = np.diagonal(a), np.abs(a).sum(1) - np.abs(np.diagonal(a))
    pad = EPS * np.abs(a).max() * len(a)
    return float((d - r).min() - pad), float((d + r).max() + pad)


def bracket(a: np.ndarray, k: int, steps: int = 30) -> tuple[float, float]:
    """(lo, hi] that holds the k-th largest eigenvalue, narrowed by inertia."""
    lo, hi = bounds(a)
    for _ in range(steps):
        mid = (lo + hi) / 2
        if not lo < mid < hi:
            break
        if inertia(a, mid) >= k:
            lo = mid
        else:
            hi = mid
    return lo, hi


def feast(a: np.ndarray, lo: float, hi: float, block: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs with values in (lo, hi], by falling value."""
    node, weight = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(0.5j * np.pi * (node + 1))
    centre, radius = (lo + hi) / 2, (hi - lo) / 2
    y = np.random.RandomState(seed).standard_normal((len(a), block))
    eye, best = np.eye(len(a)), np.inf
    found = None
    for _ in range(ROUNDS):
        q = np.zeros_like(y)
        for t, w in zip(turn, weight):
            z = centre + radius * t
            q += w / 2 * (radius * t * np.linalg.solve(z * eye - a, y)).real
        q, _ = np.linalg.qr(q)
        value, turned = np.linalg.eigh(q.T @ a @ q)
        y = q @ turned
        inside = np.flatnonzero((value > lo) & (value <= hi))[::-1]
        left = np.linalg.norm(a @ y[:, inside] - y[:, inside] * value[inside], axis=0)
        worst = left.max() / max(abs(lo), abs(hi)) if len(inside) else np.inf
        if found is None or worst < best or len(inside) != len(found[0]):
            best, found = worst, (value[inside], y[:, inside])
        elif best <= 1e-12:
            break
    return found if best <= 1e-12 else (found[0][:0], found[1][:, :0])


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, above rounding level, and unit eigenvectors."""
    d = len(a)
    k = min(k, d)
    _, top = bracket(a, 1) if d else (0, 0)
    floor = top * d * EPS
    if not d or top <= 0:
        return np.zeros(0), np.zeros((d, 0))
    k = min(k, inertia(a, floor))
    if not k:
        return np.zeros(0), np.zeros((d, 0))
    # The contour's lower end: in the gap below eigenvalue k (or, where k and
    # k + 1 agree to rounding, below the whole cluster).
    lo, n = bracket(a, k)[0], k
    while True:
        n = inertia(a, lo)
        below = bracket(a, n + 1)[1] if n < d else bounds(a)[0]
        if n == d:
            lo = below - 1e-3 * top
            break
        if lo - below > 1e-9 * top:
            lo = (lo + below) / 2
            break
        lo = bracket(a, n + 1)[0]
    hi = top + max(0.05 * (top - lo), 1e-6 * top)
    block = min(d, 2 * n)
    while True:
        value, vector = feast(a, lo, hi, block)
        if len(value) == n:                     # inertia: none missed, none twice
            break
        if block == d:
            raise ArithmeticError("the contour's eigenpairs do not match the inertia count")
        block = min(d, 2 * block)
    value, vector = value[:k], vector[:, :k]
    big = np.abs(vector).argmax(0)
    return value, vector * np.sign(vector[big, np.arange(vector.shape[1])])


# ------------------------------------------------------------------- the table
def _vectors(batch: pa.RecordBatch, scale: int, shift: int, dim: int | None = None):
    """(rows, dim, x) of the usable vectors of a batch, a group per length."""
    column = batch.column("_vec")
    lists = column.to_numpy(zero_copy_only=False)
    by: dict[int, list[int]] = {}
    for i, v in enumerate(lists):
        if v is not None and len(v) and (dim is None or len(v) == dim):
            by.setdefault(len(v), []).append(i)
    for n, rows in by.items():
        c = np.array([lists[i] for i in rows], np.float64)          # null entries become NaN
        good = np.isfinite(c).all(1)
        x = np.floor(np.clip(scale * c[good], -LARGE, LARGE)).astype(np.int64) + shift
        yield np.array(rows)[good], n, x


def _centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x - total / n in double precision."""
    whole = np.array([s // n for s in total], np.int64)
    rest = np.array([s % n / n for s in total])
    return (x - whole) - rest


def _deviation(x: np.ndarray, n: int, total: list[int]) -> list:
    """Sums of (n * x - total)^2, exact, of any size."""
    whole = np.array([s // n for s in total], np.int64)
    near = x - whole
    if not len(x):
        return []
    if (int(np.abs(near).max()) + 1) * n < 2 ** 62 // max(1, x.shape[1]) and (
            ((int(np.abs(near).max()) + 1) * n) ** 2 * x.shape[1] < 2 ** 63):
        d = near * n - np.array([s % n for s in total], np.int64)
        return (d * d).sum(1).tolist()
    d = near.astype(object) * n - np.array([s % n for s in total], object)
    return [int(v) for v in (d * d).sum(1)]


def sums(rows: DataFrame, scale: int, shift: int) -> tuple[int, int, list[int]]:
    """(n, dimension, sums per dimension) of the usable vectors."""
    def run(batches):
        totals: dict[int, list] = {}
        for b in batches:
            for at, d, x in _vectors(b, scale, shift):
                t = totals.setdefault(d, [0, np.zeros(d, object)])
                t[0] += len(at)
                t[1] += (x >> 26).sum(0).astype(object) * (1 << 26) + (x & ((1 << 26) - 1)).sum(0).astype(object)
        for d, (n, s) in totals.items():
            values = [n, *s.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * len(values), pa.int32()), pa.array(range(-1, d), pa.int32()),
                 pa.array([str(v) for v in values])], names=["d", "i", "s"])

    parts = rows.mapInArrow(run, "d int, i int, s string").select("d", "i", F.col("s").cast("decimal(38,0)").alias("s"))
    total = stored(parts.groupBy("d", "i").agg(F.sum("s").alias("s")), "sums")
    first = total.where("i = -1").orderBy(F.desc("s"), "d").select("d", "s").limit(1).collect()
    if not first or not int(first[0].s):
        return 0, 0, []
    d = first[0].d
    got = {r.i: int(r.s) for r in total.where((F.col("d") == d) & (F.col("i") >= 0)).collect()}
    return int(first[0].s), d, [got[i] for i in range(d)]


def _products(rows: DataFrame, width: int, of) -> np.ndarray:
    """Sum over all rows of the products of [1, values]: a symmetric matrix of
    1 + width rows. Partial sums per partition, then an aggregate per entry."""
    up = np.triu_indices(width + 1)

    def run(batches):
        m = np.zeros((width + 1, width + 1))
        for b in batches:
            for v in of(b):
                v = np.hstack([np.ones((len(v), 1)), v])
                m += v.T @ v
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(up[0]))), pa.array(m[up])], names=["k", "v"])

    entry = rows.mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v"))
    out = np.zeros((width + 1, width + 1))
    for k, v in entry.toPandas().itertuples(index=False):        # (d + 1)(d + 2) / 2 numbers
        out[up[0][k], up[1][k]] = out[up[1][k], up[0][k]] = v
    return out


def covariance(products: np.ndarray, n: int) -> np.ndarray:
    """Divisor n; the products are of values centred up to rounding, and what
    is left of their mean is removed."""
    mean = products[0, 1:] / n
    return products[1:, 1:] / n - np.outer(mean, mean)


def whiten(df: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error and
    deviation_exact (decimal) of every usable row and component."""
    rows = df.select(F.col(id_col).cast("bigint").alias("_id"), F.col(vector_col).alias("_vec"))
    n, dim, total = sums(rows, scale, shift)
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double, deviation_exact string")
    none = df.sparkSession.createDataFrame([], schema).withColumn("deviation_exact", F.col("deviation_exact").cast(EXACT))
    if not n:
        return none

    def centred(batch):
        for _, _, x in _vectors(batch, scale, shift, dim):
            yield _centred(x, n, total)

    v = covariance(_products(rows, dim, centred), n)
    value, vector = leading(v, components)
    if not len(value):
        return none
    turn = vector / np.sqrt(value)
    check = covariance(_products(rows, len(value), lambda b: (c @ turn for c in centred(b))), n)
    error = float(np.abs(check - np.eye(len(value))).max())
    explained = value / np.trace(v)
    k = len(value)

    def run(batches):
        for b in batches:
            ids = b.column("_id")
            for at, _, x in _vectors(b, scale, shift, dim):
                m = len(at)
                if not m:
                    continue
                each = np.repeat(np.arange(m), k)
                exact = _deviation(x, n, total)
                deviation = pa.array([v if v < 2 ** 63 else None for v in exact], pa.int64())
                exact = pa.array([str(v) for v in exact], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, n, np.int64)), deviation.take(pa.array(each)),
                     pa.array((_centred(x, n, total) @ turn).ravel()), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * k, error)), exact.take(pa.array(each))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
                           "deviation_exact"])

    return rows.mapInArrow(run, schema).withColumn("deviation_exact", F.expr(f"try_cast(deviation_exact AS {EXACT})"))
