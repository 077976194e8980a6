"""Embedding whitening: principal components by mixed-precision refinement.

1. Entries become integers, floor(scale * c). Each distinct integer vector of
   a dimension stands once in the fit list; its count and sums are integers,
   hence exact.
2. The covariance of the fit list is summed by blocks of rows, centred before
   they are multiplied. A task sends one matrix for each dimension it met,
   ``PARTS`` tasks add these up, so the driver gets at most ``PARTS`` matrices.
3. Its eigenvectors are found in float32 and corrected in higher precision
   (numpy's long double) by the iterations of Ogita and Aishima (2018): with
   R = I - X'X and S = X'AX, X becomes X + XE, where e_ij =
   (s_ij + l_j r_ij) / (l_j - l_i). They converge quadratically where
   eigenvalues are apart. Where some are nearer than the error bound, e_ij =
   r_ij / 2 keeps their vectors orthogonal, and a sub-solve of X_J' A X_J,
   shifted by its mean, turns them inside their common space (2019, clustered
   eigenvalues), so that the next iterations tell them apart.
4. Every row is projected by the tasks that read it.

The driver holds a few matrices of d x d numbers, whatever the number of rows.

Defined cases: rows whose vector is null or holds null or non-finite entries,
and entries whose integer does not fit a long, are left out; so are empty
vectors. Rows with a null id stay. Copies and repeated rows are each returned
and stand once in the fit list. Vectors of several dimensions are whitened
each with their own dimension. A component whose eigenvalue is zero within
rounding (constant data, fewer vectors than dimensions) has a null
``whitened`` and takes no part in ``identity_error``, which is null if there
is no other; ``explained`` is null where all variances are zero. ``deviation``
is null where it does not fit a long. An empty table gives no rows. Other
columns of the input are not read, so their names may be anything.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, ship, shipped, stored

PARTS = 8
BLOCK_ROWS = 4096
HIGH = np.longdouble


def refine(a: np.ndarray, x: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors) of the symmetric ``a``, falling, from the
    approximate eigenvectors ``x``, both in long double."""
    a, x = a.astype(HIGH), x.astype(HIGH)
    eye = np.eye(len(a), dtype=HIGH)
    size = np.sqrt((a * a).sum())
    tiny = 64 * np.finfo(np.float64).eps * size  # nearer eigenvalues of a float64 matrix are equal
    values, least = np.diag(x.T @ a @ x).copy(), np.inf
    if size == 0:
        return values, x
    for _ in range(rounds):
        r = eye - x.T @ x
        s = x.T @ a @ x
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        far = max(2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum())), tiny)
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > far
        step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ step
        moved = float(np.sqrt((step * step).sum()))
        turned = _turn_clusters(a, x, values, far, tiny)
        if not turned and (moved <= 64 * np.finfo(HIGH).eps * len(a) or (moved < 1e-14 and moved >= least)):
            break
        least = moved
    for _ in range(2):  # what the last step left of the lengths and angles
        x = x + x @ (eye - x.T @ x) / 2
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def _turn_clusters(a: np.ndarray, x: np.ndarray, values: np.ndarray, far, tiny) -> bool:
    """Solve the small problem of each run of eigenvalues that are nearer to
    each other than ``far``, in place. True if some vectors moved."""
    order = np.argsort(-values, kind="stable")
    breaks = np.flatnonzero(-np.diff(values[order]) > far) + 1
    moved = False
    for run in np.split(order, breaks):
        if len(run) < 2:
            continue
        basis = x[:, run]
        mean = values[run].mean()
        small = basis.T @ (a @ basis - mean * basis)
        scale = np.abs(small).max()
        if scale <= tiny:
            continue  # equal within rounding: any basis of the space will do
        _, turn = np.linalg.eigh(((small + small.T) / (2 * scale)).astype(np.float64))
        x[:, run] = basis @ turn[:, ::-1].astype(HIGH)
        # a turn that was needed: more than the rounding of its float64 solve
        moved |= bool(np.abs(np.abs(turn[:, ::-1]) - np.eye(len(run))).max() > 1e-12)
    return moved


def eigen(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling (eigenvalues, eigenvectors) to double precision."""
    scale = float(np.abs(cov).max()) or 1.0
    _, start = np.linalg.eigh((cov / scale).astype(np.float32))
    values, vectors = refine(cov / scale, start[:, ::-1])
    return (values * scale).astype(np.float64), vectors.astype(np.float64)


@dataclass
class Whitening:
    """What one dimension's rows are projected with."""

    n: int
    sums: list[int]
    axes: np.ndarray  # d x components, each over the root of its eigenvalue; NaN where that is zero
    explained: list[float | None]
    identity_error: float | None = None


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n, each entry rounded once where integers allow."""
    mean = [s // n for s in sums]
    rest = np.array([(s - m * n) / n for s, m in zip(sums, mean)])
    return (x - np.array(mean)).astype(np.float64) - rest


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n x - sums)^2, exact; None beyond a long."""
    big = n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, sums))
    if big * big * len(sums) < 1 << 63:
        d = n * x - np.array(sums)
        return (d * d).sum(axis=1).tolist()
    got = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in got]


def _matrix(cells: list[bytes], d: int) -> np.ndarray:
    return np.frombuffer(b"".join(cells), np.int64).reshape(-1, d)


def _by_dimension(b, column: str) -> Iterator:
    """(dimension, row numbers, integer matrix) of a batch, by blocks."""
    cells = b.column(column).to_pylist()
    dims = np.array([len(c) // 8 for c in cells], np.int64)
    for d in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == d)
        for at in range(0, len(rows), BLOCK_ROWS):
            part = rows[at : at + BLOCK_ROWS]
            yield d, part, _matrix([cells[i] for i in part], d)


def integer_vectors(vectors: DataFrame, vec_id: str, embedding: str, scale: float) -> DataFrame:
    """(id, x binary): the rows that stay, x as 64-bit integers."""
    base = vectors.select(pick(vectors, vec_id).cast("long").alias("id"), pick(vectors, embedding).cast("array<double>").alias("e"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            e, keep, out = b.column("e"), [], []
            for i in range(b.num_rows):
                v = e[i].values
                if v is None or not len(v) or v.null_count:
                    continue
                with np.errstate(all="ignore"):
                    x = np.floor(v.to_numpy() * scale) + 0.0
                if np.all((x >= -(2.0**63)) & (x < 2.0**63)):  # NaN fails too
                    keep.append(i)
                    out.append(x.astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(keep, pa.int64())), pa.array(out, pa.binary())], ["id", "x"])

    return base.mapInArrow(run, "id long, x binary")


def fit_sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """dimension -> (n, sums) of the fit list."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total: dict[int, list] = {}
        for b in batches:
            for d, rows, x in _by_dimension(b, "x"):
                t = total.setdefault(d, [0, [0] * d])
                t[0] += len(rows)
                # in two halves, so that no sum of a block leaves 64 bits
                high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
                t[1] = [s + (h << 32) + q for s, h, q in zip(t[1], high, low)]
        cells = [(d, j, n, str(s)) for d, (n, sums) in total.items() for j, s in enumerate(sums)]
        if cells:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*cells)], ["d", "j", "n", "s"])

    parts = fit.mapInArrow(run, "d long, j long, n long, s string")
    got = parts.groupBy("d", "j").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(got.collect()):  # one row for each dimension
        out.setdefault(r["d"], (r["n"], []))[1].append(int(r["s"]))
    return out


def _summed_products(fit: DataFrame, centre) -> dict[int, np.ndarray]:
    """dimension -> sum of y'y over the fit list, y = centre(dimension, x)."""

    def add(total: dict, d: int, m: np.ndarray) -> None:
        total[d] = m if d not in total else total[d] + m

    def out(total: dict) -> Iterator:
        import pyarrow as pa

        for d, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int64()), pa.array([m.tobytes()])], ["d", "m"])

    def products(batches: Iterator) -> Iterator:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for d, _, x in _by_dimension(b, "x"):
                y = centre(d, x)
                add(total, d, y.T @ y)
        yield from out(total)

    def added(batches: Iterator) -> Iterator:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for d, m in zip(b.column("d").to_pylist(), b.column("m")):
                add(total, d, np.frombuffer(m.as_buffer()))
        yield from out(total)

    parts = fit.mapInArrow(products, "d long, m binary").repartition(PARTS)
    total: dict[int, np.ndarray] = {}
    for r in parts.mapInArrow(added, "d long, m binary").collect():  # PARTS matrices a dimension
        add(total, r["d"], np.frombuffer(r["m"]))
    return {d: m.reshape(round(len(m) ** 0.5), -1) for d, m in total.items()}


def fit_whitening(fit: DataFrame, components: int) -> dict[int, Whitening]:
    """The model of each dimension that ``fit`` (x binary, distinct) has."""
    spark = fit.sparkSession
    sums = fit_sums(fit)
    if not sums:
        return {}
    shared = ship(spark, sums)
    covs = _summed_products(fit, lambda d, x: _centred(x, *shipped(shared)[d]))
    models: dict[int, Whitening] = {}
    for d, (n, s) in sums.items():
        cov = covs[d] / n
        values, axes = eigen(cov)
        k, trace = min(components, d), float(np.trace(cov))
        solid = values[:k] > d * np.finfo(np.float64).eps * max(values[0], 0)
        root = np.where(solid, np.sqrt(np.where(solid, values[:k], 1)), np.nan)
        share = [max(float(e), 0.0) / trace if trace > 0 else None for e in values[:k]]
        models[d] = Whitening(n, s, axes[:, :k] / root, share)
    # measured on the whitened fit list, centred anew
    model = ship(spark, models)

    def whitened(d: int, x: np.ndarray) -> np.ndarray:
        m = shipped(model)[d]
        y = np.nan_to_num(_centred(x, m.n, m.sums) @ m.axes)
        return np.column_stack((y, np.ones(len(y))))  # with the means

    for d, both in _summed_products(fit, whitened).items():
        m = models[d]
        mean = both[-1, :-1] / m.n
        cov = both[:-1, :-1] / m.n - np.outer(mean, mean)
        solid = ~np.isnan(m.axes[0])
        if solid.any():
            m.identity_error = float(np.abs(cov - np.eye(len(cov)))[np.ix_(solid, solid)].max())
    return models


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: float = 256.0, components: int = 4) -> DataFrame:
    """(vec_id long, component int, n long, deviation long, whitened double,
    explained double, identity_error double): a row for each row that stays
    and each of the first ``components`` components."""
    rows = stored(integer_vectors(vectors, vec_id, embedding, scale), "integer-vectors")
    fit = stored(rows.select("x").distinct(), "fit-list")
    model = ship(vectors.sparkSession, fit_whitening(fit, components))

    def project(batches: Iterator) -> Iterator:
        import pyarrow as pa

        models = shipped(model)
        for b in batches:
            ids = b.column("id")
            for d, at, x in _by_dimension(b, "x"):
                m = models[d]
                k = m.axes.shape[1]
                y = _centred(x, m.n, m.sums) @ m.axes
                deviation = _deviations(x, m.n, m.sums)
                cols = [
                    ids.take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(at) * k, m.n)),
                    pa.array([v for v in deviation for _ in range(k)], pa.int64()),
                    pa.array(y.ravel(), mask=np.isnan(y.ravel())),
                    pa.array(m.explained * len(at), pa.float64()),
                    pa.array([m.identity_error] * (len(at) * k), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kinds = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.mapInArrow(project, kinds).withColumnRenamed("id", vec_id)
