"""Embedding whitening by the leading eigenvectors of a distributed, centred covariance.

Entries become integers, x = floor(64 * c) + 1000000, and the fit list is each distinct vector once.  Its
count and sums are exact.  Tasks centre their vectors, multiply, and send partial products by stripes of
rows, which are added in two steps on executors.  The driver holds one width x width matrix: Householder
reflections make it tridiagonal, Sturm counts with bisection give the leading eigenvalues, inverse
iteration the vectors, made orthogonal again inside clusters of near eigenvalues.  The components (width x
16 numbers at most) go to the tasks that project all rows.

Centring is done on small numbers: a whole number near the mean is taken off exactly first, then the rest
of the mean (at most a half), so a million's digits are not lost.

Defined cases: rows with a null vector or a null or non-finite entry are dropped; shorter vectors are filled
up with entries of 0; entries whose integer would leave a long end near its limits; repeated rows are
projected each but fitted once; a null vec_id is kept; directions without variance (below width * 2^-52 of
the largest eigenvalue) have no component, so one single vector, or none, gives no rows; deviation is null
where the sum does not fit a long (its exact text is in deviation_text); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.llm.common import stage
from layerforge.llm.exact_topk import finite

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
STRIPE, LANES, WIDEST = 64, 16, 1 << 62


@dataclass
class Fit:
    """n vectors; mean = pivot + rest (rest at most a half); eigenvalues; components as columns; trace."""

    n: int
    sums: list[int]
    pivot: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float


def as_integers(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, x) of the rows that take part, all of one width, and that width."""
    able = vectors.where(finite("embedding"))
    width = able.agg(F.max(F.size("embedding"))).head()[0] or 0
    whole = lambda c: F.greatest(F.least(F.floor(c.cast("double") * SCALE), F.lit(WIDEST)), F.lit(-WIDEST)) + OFFSET
    x = F.concat(F.transform("embedding", whole),
                 F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(width) - F.size("embedding")))
    return able.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")), width


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(width: int):
    """mapInArrow: x -> (dim, n, s), one row per dimension and task, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * width
        for b in batches:
            m = _matrix(b.column(0), width)
            if not len(m):
                continue
            kind = np.int64 if max(abs(int(m.max())), abs(int(m.min()))) * len(m) < WIDEST else object
            own = m.astype(kind).sum(axis=0).tolist()
            n, total = n + len(m), [a + b for a, b in zip(total, own)]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()),
                                          pa.array([str(t) for t in total])], ["dim", "n", "s"])

    return run


def _products(width: int, pivot: np.ndarray, rest: np.ndarray):
    """mapInArrow: x -> (stripe, lane, block): the task's sum of centred products, by stripes of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for b in batches:
            c = (_matrix(b.column(0), width) - pivot).astype(np.float64) - rest
            total += c.T @ c
        lane = TaskContext.get().partitionId() % LANES
        for at in range(0, width, STRIPE):
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([lane], pa.int32()),
                                              pa.array([total[at:at + STRIPE].tobytes()], pa.binary())], ["stripe", "lane", "block"])

    return run


def _added(keys: list[str]):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b) for b in rows["block"])
        return pd.DataFrame({**{k: [rows[k].iloc[0]] for k in keys}, "block": [total.tobytes()]})

    return run


def centred_covariance(fit_rows: DataFrame, width: int, n: int, pivot: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Covariance (divisor n) of the rows' vectors; partial sums are added on executors in two steps."""
    parts = fit_rows.mapInArrow(_products(width, pivot, rest), "stripe int, lane int, block binary")
    lanes = parts.groupBy("stripe", "lane").applyInPandas(_added(["stripe", "lane"]), "stripe int, lane int, block binary")
    whole = lanes.groupBy("stripe").applyInPandas(_added(["stripe"]), "stripe int, block binary")
    rows = sorted((r["stripe"], r["block"]) for r in whole.collect())  # width x width numbers
    v = np.concatenate([np.frombuffer(b).reshape(-1, width) for _, b in rows]) / n
    return (v + v.T) / 2


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Householder form of a symmetric matrix: diagonal, off-diagonal, and the unit reflection vectors."""
    a, size, mirrors = a.copy(), len(a), []
    for k in range(size - 2):
        x = a[k + 1:, k]
        scale = np.abs(x[1:]).max(initial=0.0)
        if scale == 0.0:
            mirrors.append(None)
            continue
        u = x / max(scale, abs(x[0]))
        u[0] += np.copysign(np.linalg.norm(u), u[0])
        u /= np.linalg.norm(u)
        mirrors.append(u)
        # H a H with H = 1 - 2 u u': a rank-two change of what remains.
        rest = a[k + 1:, k + 1:]
        p = rest @ u
        p = 2 * (p - (u @ p) * u)
        rest -= np.outer(u, p) + np.outer(p, u)
        x -= 2 * (u @ x) * u
        a[k, k + 1:] = x
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def count_below(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues of the tridiagonal matrix lie below each of ``at``."""
    tiny = np.finfo(float).tiny * max(1.0, np.square(off).max(initial=0.0))
    pivot, count = np.ones_like(at), np.zeros(len(at), np.int64)
    for i, d in enumerate(diag):
        pivot = (d - at) - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading_values(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k greatest eigenvalues, falling, each bisected until no number lies between its bounds."""
    size = len(diag)
    beside = np.concatenate([np.abs(off), [0.0]]) + np.concatenate([[0.0], np.abs(off)])
    room = np.finfo(float).eps * size * max(np.abs(diag).max() + beside.max(), np.finfo(float).tiny)
    low = np.full(k, (diag - beside).min() - room)
    high = np.full(k, (diag + beside).max() + room)
    wanted = size - 1 - np.arange(k)  # index of the eigenvalue in rising order
    while True:
        mid = low + (high - low) / 2
        if not ((mid > low) & (mid < high)).any():
            return mid
        above = count_below(diag, off, mid) <= wanted
        low, high = np.where(above, mid, low), np.where(above, high, mid)


def _solve(diag: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """(T - shift) x = b by elimination with row exchanges; zero pivots become ``tiny``."""
    size, x = len(diag), b.copy()
    upper = np.zeros((size, 3))  # rows of the eliminated matrix: pivot and two to its right
    row = np.array([diag[0] - shift, off[0] if size > 1 else 0.0, 0.0])
    for i in range(size - 1):
        below = np.array([off[i], diag[i + 1] - shift, off[i + 1] if i + 2 < size else 0.0])
        if abs(below[0]) > abs(row[0]):
            row, below = below, row
            x[i], x[i + 1] = x[i + 1], x[i]
        if row[0] == 0.0:
            row[0] = tiny
        factor = below[0] / row[0]
        upper[i] = row
        row = np.array([below[1] - factor * row[1], below[2] - factor * row[2], 0.0])
        x[i + 1] -= factor * x[i]
    upper[-1] = row
    if abs(upper[-1, 0]) < tiny:
        upper[-1, 0] = np.copysign(tiny, upper[-1, 0])
    for i in range(size - 1, -1, -1):
        x[i] -= upper[i, 1] * (x[i + 1] if i + 1 < size else 0.0) + upper[i, 2] * (x[i + 2] if i + 2 < size else 0.0)
        x[i] /= upper[i, 0]
        top = np.abs(x[i:]).max()
        if top > 1e100:  # only the direction counts
            x /= top
    return x


def inverse_iteration(diag: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix for eigenvalues in falling order.

    Eigenvalues that follow one another by less than a thousandth of the norm form a cluster; the vectors of
    a cluster are made orthogonal to each other in every round.
    """
    norm = max(np.abs(diag).max() + 2 * np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    eps, rng = np.finfo(float).eps, np.random.default_rng(0)
    out, first, shift = np.zeros((len(diag), len(values))), 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            first = k
        shift = min(value, shift - 4 * eps * norm) if k > first else value  # equal values still differ a little
        x = rng.normal(size=len(diag))
        for _ in range(rounds):
            x = _solve(diag, off, shift, x / np.linalg.norm(x), eps * norm)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[:, first:k] @ (out[:, first:k].T @ x)
        out[:, k] = x / np.linalg.norm(x)
    return out


def eigen(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k leading eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    top = np.abs(v).max(initial=0.0)
    if top == 0.0:
        return np.zeros(k), np.zeros((len(v), k))
    diag, off, mirrors = tridiagonal(v / top)
    values = leading_values(diag, off, k)
    vectors = inverse_iteration(diag, off, values)
    for at, u in reversed(list(enumerate(mirrors))):
        if u is not None:
            vectors[at + 1:] -= 2 * np.outer(u, u @ vectors[at + 1:])
    return values * top, vectors / np.linalg.norm(vectors, axis=0)


def fit_whitening(fit_rows: DataFrame, width: int, k: int = COMPONENTS) -> Fit | None:
    """Mean and components of distinct vectors ``x`` (staged); None where there is nothing to whiten."""
    sums = fit_rows.mapInArrow(_sums(width), "dim int, n long, s string").groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = sorted((r["dim"], int(r["n"]), int(r["s"])) for r in sums.collect())
    if not found or not found[0][1]:
        return None
    n, total = found[0][1], [s for _, _, s in found]
    pivot = [(2 * s + n) // (2 * n) for s in total]
    rest = np.array([(s - n * p) / n for s, p in zip(total, pivot)])
    v = centred_covariance(fit_rows, width, n, np.array(pivot, np.int64), rest)
    values, vectors = eigen(v, min(k, width))
    real = values > width * np.finfo(float).eps * max(values[0], 0.0)
    if not real.any():
        return None
    return Fit(n, total, np.array(pivot, np.int64), rest, values[real], vectors[:, real], float(np.trace(v)))


def _project(m: np.ndarray, fit: Fit) -> np.ndarray:
    return ((m - fit.pivot).astype(np.float64) - fit.rest) @ fit.components / np.sqrt(fit.values)


def _moments(fit: Fit, width: int):
    """mapInArrow: x -> one row a task: count, mean and centred products of the whitened vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if b.num_rows:
                w = _project(_matrix(b.column(0), width), fit)
                c = w - w.mean(axis=0)
                held = merged(held, (len(w), w.mean(axis=0), c.T @ c))
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64()), pa.array([held[1].tobytes()], pa.binary()),
                                              pa.array([held[2].tobytes()], pa.binary())], ["n", "mean", "products"])

    return run


def merged(a, b):
    """Count, mean and centred products of two disjoint sets of rows together."""
    if a is None:
        return b
    n, apart = a[0] + b[0], b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def identity_error(fit_rows: DataFrame, fit: Fit, width: int) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    held = None
    for r in fit_rows.mapInArrow(_moments(fit, width), "n long, mean binary, products binary").collect():  # a row a task
        held = merged(held, (r["n"], np.frombuffer(r["mean"]), np.frombuffer(r["products"]).reshape(len(fit.values), -1)))
    return float(np.abs(held[2] / held[0] - np.eye(len(fit.values))).max())


def deviations(m: np.ndarray, fit: Fit) -> list[int]:
    """Exact sum over dimensions of (n * x - S)^2 per row, as Python integers."""
    y = m - fit.pivot
    off = [s - fit.n * int(p) for s, p in zip(fit.sums, fit.pivot)]
    most = fit.n * max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0)))) + max(map(abs, off))
    kind = np.int64 if most ** 2 * max(1, m.shape[1]) < 1 << 63 else object
    apart = y.astype(kind) * fit.n - np.array(off, kind)
    return [int(d) for d in (apart * apart).sum(axis=1)]


def _whitened(fit: Fit, width: int, error: float):
    """mapInArrow: (vec_id, x) -> a row per vector and component."""

    k, explained = len(fit.values), fit.values / fit.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                m = _matrix(b.column(1), width)
                far = deviations(m, fit)
                spread = np.repeat(np.arange(len(m)), k)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(spread)), pa.array(np.tile(np.arange(1, k + 1), len(m)), pa.int32()),
                     pa.array(np.full(len(spread), fit.n), pa.int64()),
                     pa.array([d if d < 1 << 63 else None for d in far], pa.int64()).take(pa.array(spread)),
                     pa.array([str(d) for d in far]).take(pa.array(spread)),
                     pa.array(_project(m, fit).ravel()), pa.array(np.tile(explained, len(m))),
                     pa.array(np.full(len(spread), error))],
                    ["vec_id", "component", "n", "deviation", "deviation_text", "whitened", "explained", "identity_error"])

    return run


WHITENED = ("vec_id long, component int, n long, deviation long, deviation_text string, whitened double, "
            "explained double, identity_error double")


def whiten(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component, see the module for the cases."""
    rows, width = as_integers(vectors)
    if width:
        fit_rows = stage(rows.select("x").distinct(), "whitening-fit")
        fit = fit_whitening(fit_rows, width, k)
        if fit is not None:
            return rows.mapInArrow(_whitened(fit, width, identity_error(fit_rows, fit, width)), WHITENED)
    return vectors.sparkSession.createDataFrame([], WHITENED)
