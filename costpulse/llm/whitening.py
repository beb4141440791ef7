"""Embedding whitening: exact covariance on Spark, refined eigenvectors, one projection pass.

An entry c becomes the whole number x = floor(64 c) + 1000000 (beyond the range of a long it
stays at its end). The fit list is every distinct x vector once: n vectors, per-dimension sums S,
covariance V = sum (x - S/n)(x - S/n)^T / n.

1. Tasks sum z z^T with z = x - m, m the rounded mean: small whole numbers, multiplied in
   float64 blocks whose sums stay below 2^53, so nothing is rounded; larger entries are
   multiplied as Python integers. Spark adds the d^2 cells of all tasks as 38-digit decimals.
   V = (n sum z z^T - r r^T) / n^2 with r = S - n m is then exact, and is rounded once.
2. ``refined``: eigenvectors of V in float32, corrected by Ogita-Aishima steps (four
   matrix products each) in extended precision. Where eigenvalues lie closer than the current
   error the step can't tell the vectors apart: such clusters are re-solved inside their
   own subspace, by the eigenvectors of X_J^T (V - mu I) X_J, and go on with the rest.
3. One pass projects every row; a second one over the fit list measures whitened's covariance.

Rows whose vector is null or empty, holds null or non-finite entries or has another length
than most vectors (ties: the longer) are dropped; nothing else is. Repeated ids keep their rows.
Components without variance have no unit-variance projection and are left out, so all-equal
vectors, like an empty table, give no rows. ``deviation`` is null where it passes a long.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costpulse.llm.common import cut

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
EXACT = 1 << 53                # whole numbers that float64 adds without rounding
LONG = (1 << 63) - 1
ROWS_AT_ONCE = 4096
STEPS = 12


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray         # eigenvalues, falling
    vectors: np.ndarray        # unit eigenvectors as columns
    trace: float


# ------------------------------------------------------------------------ eigenvectors

def _clusters(values: np.ndarray, gap) -> list[np.ndarray]:
    """Index groups of two or more values whose neighbours (sorted) lie within ``gap``."""
    order = np.argsort(values)
    groups = np.split(order, np.flatnonzero(np.diff(values[order]) > gap) + 1)
    return [g for g in groups if len(g) > 1]


def refined(v: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of the symmetric ``v``, in double
    precision: a float32 start, then refinement in extended precision."""
    d = len(v)
    top = float(np.abs(v).max()) if d else 0.0
    if top == 0.0:
        return np.zeros(d), np.eye(d)
    wide = np.longdouble
    a = v.astype(wide) / wide(top)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(wide)
    one = np.eye(d, dtype=wide)
    norm = np.abs(a).sum(axis=1).max()
    best, stalled = None, 0
    for _ in range(steps):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2       # rounding must not stretch close vectors
        values = np.diag(s) / (1 - np.diag(r))
        error = float(np.abs(s - np.diag(values)).max() + norm * np.abs(r).max())
        stalled = stalled + 1 if best is not None and error >= best[0] / 2 else 0
        if best is None or error < best[0]:
            best = (error, values, x)
        if stalled == 2:
            break
        delta = 2 * (np.linalg.norm((s - np.diag(values)).astype(float), 2)
                     + float(norm) * np.linalg.norm(r.astype(float), 2))
        near = np.abs(values[:, None] - values[None, :]) <= delta
        far = np.where(near, wide(1), values[None, :] - values[:, None])
        e = np.where(near, r / 2, (s + values[None, :] * r) / far)
        x = x + x @ e
        for group in _clusters(values, delta):
            inside = x[:, group]
            mu = values[group].mean()
            # an exact orthonormal frame of the cluster's subspace, then its own problem:
            # shifted by mu, the small differences of the values are all that is left
            part = inside.T @ (a @ inside) - mu * (inside.T @ inside)
            gram = inside.T @ inside
            part, size = (part + part.T) / 2, np.abs(part).max()
            if size > 0:
                own = np.linalg.eigh((part / size).astype(float))[1].astype(wide)
                x[:, group] = inside @ (own @ (one[:len(group), :len(group)] * wide(1.5)
                                               - own.T @ gram @ own / 2))
    _, values, x = best
    x = x @ (one * wide(1.5) - x.T @ x / 2)
    x = x / np.sqrt((x * x).sum(axis=0))
    order = np.argsort(-values, kind="stable")
    return (values[order] * wide(top)).astype(float), x[:, order].astype(float)


# ------------------------------------------------------------------------ covariance

def whole(c: np.ndarray) -> np.ndarray:
    """x of float64 entries."""
    x = np.floor(c * SCALE) + SHIFT
    safe = np.clip(x, -(2.0 ** 62), 2.0 ** 62)
    out = np.floor(np.clip(c, -(2.0 ** 55), 2.0 ** 55) * SCALE).astype(np.int64) + SHIFT
    return np.where(safe == x, out, np.where(x > 0, LONG, -LONG - 1))


def _matrix(column, d: int) -> np.ndarray:
    """(rows, d) of a list column whose lists all have length d."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _rounded(vector: str, out: str):
    """Rows with ``vector`` replaced by the x vector ``out``."""
    def run(batches):
        for b in batches:
            at = b.schema.get_field_index(vector)
            col = b.column(at)
            flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            sizes = np.diff(np.asarray(col.offsets))
            x = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)),
                                         pa.array(whole(flat)))
            columns = list(b.columns)
            columns[at] = x
            names = list(b.schema.names)
            names[at] = out
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def _products(middle: list[int]):
    """Cells (i, j, sum of z_i z_j) of a task, i <= j; the sum as text, as it may pass 64 bits."""
    d = len(middle)

    def run(batches):
        m = np.array(middle, np.int64)
        total = np.zeros((d, d), object)
        fast = np.zeros((d, d), np.int64)
        held = 0
        for b in batches:
            x = _matrix(b.column(0), d)
            for lo in range(0, len(x), ROWS_AT_ONCE):
                part = x[lo:lo + ROWS_AT_ONCE]
                reach = max(abs(int(part.max()) - min(middle)), abs(int(part.min()) - max(middle)))
                if reach * reach * len(part) < EXACT:
                    z = (part - m).astype(np.float64)
                    fast += (z.T @ z).astype(np.int64)
                    held += reach * reach * len(part)
                    if held >= 1 << 61:
                        total += fast.astype(object)
                        fast[:] = 0
                        held = 0
                else:
                    z = part.astype(object) - np.array(middle, object)
                    total += z.T @ z
        total += fast.astype(object)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
             pa.array([str(x) for x in total[i, j]])], ["i", "j", "s"])
    return run


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``rows`` whose vector is complete, finite and of the usual length, as array<double>."""
    whole_rows = rows.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.exists(
        vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    usual = (whole_rows.groupBy(F.size(vector).alias("d")).count()
             .orderBy(F.desc("count"), F.desc("d")).first())
    return whole_rows.filter(F.size(vector) == (usual["d"] if usual else 0)).withColumn(
        vector, F.col(vector).cast("array<double>"))


def fit_list(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(x): each distinct x vector of ``usable`` rows once, written to the checkpoint folder."""
    x = rows.select(vector).mapInArrow(_rounded(vector, "x"), "x array<long>")
    return cut(x.distinct())


def fit(listed: DataFrame) -> Whitening | None:
    """The whitening of a fit list; None if it is empty."""
    sums = (listed.select(F.posexplode("x").alias("i", "x")).groupBy("i")
            .agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"))
            .orderBy("i").collect())                      # one row per dimension
    if not sums:
        return None
    n, s = sums[0]["n"], [int(r["s"]) for r in sums]
    middle = [max(-LONG // 2, min(LONG // 2, (2 * t + n) // (2 * n))) for t in s]
    cells = (listed.mapInArrow(_products(middle), "i int, j int, s string")
             .groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    d = len(s)
    rest = [t - n * m for t, m in zip(s, middle)]
    v = np.zeros((d, d))
    trace = Fraction(0)
    for c in cells:                                       # d (d + 1) / 2 rows, whatever the input
        exact = Fraction(n * int(c["s"]) - rest[c["i"]] * rest[c["j"]], n * n)
        v[c["i"], c["j"]] = v[c["j"], c["i"]] = float(exact)
        if c["i"] == c["j"]:
            trace += exact
    values, vectors = refined(v)
    return Whitening(n, s, values, vectors, float(trace))


# ------------------------------------------------------------------------ projection

def _kept(w: Whitening, most: int) -> int:
    """Components with variance, up to ``most``."""
    floor = len(w.values) * np.finfo(float).eps * (w.values[0] if len(w.values) else 0.0)
    return int((w.values[:most] > max(floor, 0.0)).sum())


def _projector(w: Whitening, k: int):
    middle = [(2 * t + w.n) // (2 * w.n) for t in w.sums]
    offset = np.array([float(Fraction(t - w.n * m, w.n)) for t, m in zip(w.sums, middle)])
    basis = w.vectors[:, :k] / np.sqrt(w.values[:k])

    def project(x: np.ndarray) -> np.ndarray:
        return ((x - np.array(middle, np.int64)).astype(np.float64) - offset) @ basis
    return project


def _deviations(x: np.ndarray, w: Whitening) -> list:
    """sum over dimensions of (n x - S)^2, exact; None beyond a long."""
    reach = w.n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, w.sums))
    if reach < 1 << 62:
        y = w.n * x - np.array(w.sums, np.int64)
        far = int(np.abs(y).max())
        if far * far * x.shape[1] <= LONG:
            return (y * y).sum(axis=1).tolist()
    y = x.astype(object) * w.n - np.array(w.sums, object)
    return [t if t <= LONG else None for t in (y * y).sum(axis=1).tolist()]


def _moments(w: Whitening, k: int):
    def run(batches):
        project = _projector(w, k)
        first, second = np.zeros(k), np.zeros((k, k))
        for b in batches:
            if b.num_rows:
                p = project(_matrix(b.column(0), len(w.sums)))
                first += p.sum(axis=0)
                second += p.T @ p
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, np.full(k, -1)).astype(np.int32)),
             pa.array(np.append(j, np.arange(k)).astype(np.int32)),
             pa.array(np.append(second[i, j], first))], ["i", "j", "s"])
    return run


def identity_error(listed: DataFrame, w: Whitening, k: int) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    cells = (listed.mapInArrow(_moments(w, k), "i int, j int, s double")
             .groupBy("i", "j").agg(F.sum("s").alias("s")).collect())
    mean = {c["j"]: c["s"] / w.n for c in cells if c["i"] < 0}
    return max(abs(c["s"] / w.n - mean[c["i"]] * mean[c["j"]] - (c["i"] == c["j"]))
               for c in cells if c["i"] >= 0)


def _projected(w: Whitening, k: int, error: float):
    def run(batches):
        project = _projector(w, k)
        explained = np.tile(w.values[:k] / w.trace, 1)
        for b in batches:
            for lo in range(0, b.num_rows, ROWS_AT_ONCE):
                part = b.slice(lo, ROWS_AT_ONCE)
                rows = part.num_rows
                x = whole(_matrix(part.column(1), len(w.sums)))
                times = pa.array(np.repeat(np.arange(rows), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(times), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                     pa.array(np.full(rows * k, w.n, np.int64)),
                     pa.array(_deviations(x, w), pa.int64()).take(times),
                     pa.array(project(x).reshape(-1)), pa.array(np.tile(explained, rows)),
                     pa.array(np.full(rows * k, error))],
                    ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whitened(rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
             components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of every usable row
    and component; see the module text."""
    rows = usable(rows.select(F.col(key).alias("key"), F.col(vector).alias("_v")), "_v")
    kind = rows.schema["key"].dataType.simpleString()
    shape = (f"key {kind}, component int, n long, deviation long, whitened double, "
             "explained double, identity_error double")
    listed = fit_list(rows, "_v")
    w = fit(listed)
    k = _kept(w, components) if w else 0
    if not k:
        return rows.sparkSession.createDataFrame([], shape).withColumnRenamed("key", key)
    out = rows.select("key", "_v").mapInArrow(_projected(w, k, identity_error(listed, w, k)), shape)
    return out.withColumnRenamed("key", key)
