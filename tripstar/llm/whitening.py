"""Embedding whitening by Chebyshev-filtered subspace iteration.

An entry c of a vector counts as the integer floor(256 c). The covariance V is that of the *fit list*, each
distinct integer vector once, so copies weigh nothing. Its leading eigenvectors are found without forming V:
every product V Q of a block of a few dozen columns is one pass over the fit list, in which tasks centre their
rows before they multiply and add up XᵀXQ; sums of the tasks' parts are added by Spark, and only a matrix of
dimensions times columns reaches the driver, whatever the number of vectors.

A short Lanczos run bounds the spectrum from below. Then each round damps the unwanted eigenvalues (from that
bound to the smallest Ritz value of the block) by a Chebyshev polynomial, whose three-term recurrence is one
pass a degree, makes the block orthonormal by QR and solves the small Rayleigh-Ritz problem. It ends when the
residuals of the wanted pairs are certified, ``|V q - e q| <= tolerance * e_1``, or, where rounding allows no
better, when they stop falling and are below ``accept * e_1``; otherwise it raises. Guard columns beyond the
wanted ones keep close eigenvalues apart. A block as wide as the space needs one round.

Defined cases: rows whose vector is null or has a null, infinite or NaN entry give no row; the dimension is
that of the longest vector left, shorter ones (also empty ones) are filled with zeros; repeated rows give rows
each; null ids stay; entries beyond 64 bits count as the nearest 64-bit number; a ``deviation`` beyond 64 bits is
null; components without variance (an eigenvalue up to 1e-12 of the first, all of them where a single distinct
vector is left) are not returned, as nothing can be divided by their root; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.llm.common import materialise

SCALE = 256
# Columns beside the wanted components, degree of the filter in a round, and most rounds.
GUARD, DEGREE, ROUNDS = 28, 12, 60
# Residuals, relative to the first eigenvalue: what ends the iteration, and what it may end at if no round helps.
TOLERANCE, ACCEPT = 1e-14, 1e-12
LANCZOS = 12
# Rows that are centred and multiplied at a time.
ROWS = 4096


def integer_vectors(vectors: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """(id, x): the integer vector of every usable row as little-endian 64-bit integers."""
    kind = vectors.schema[id_col].dataType.simpleString()
    picked = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            usable = lists.is_valid().to_numpy(zero_copy_only=False)
            lengths = np.where(usable, lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
            flat = lists.flatten().to_numpy(zero_copy_only=False)  # null entries are NaN
            ends = np.cumsum(lengths)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            usable &= bad[ends] == bad[ends - lengths]
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(flat * SCALE)
            x = np.where(x >= 2.0 ** 63, np.iinfo(np.int64).max, np.maximum(np.nan_to_num(x, nan=0.0), -2.0 ** 63).astype("<i8", casting="unsafe"))
            raw = x.astype("<i8").tobytes()
            keep = np.flatnonzero(usable)
            out = [raw[8 * a:8 * b] for a, b in zip((ends - lengths)[keep].tolist(), ends[keep].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), pa.array(out, pa.binary())], names=["id", "x"])

    return picked.mapInArrow(run, f"id {kind}, x binary")


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of packed vectors, filled up with zeros."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(x.ljust(8 * dims, b"\0") for x in raw), dtype="<i8").reshape(len(raw), dims)


@dataclass
class Fit:
    """The fit list (a written table of distinct ``x``) and its exact first moments."""

    rows: DataFrame
    dims: int
    n: int
    sums: list[int]

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def product(self, q: np.ndarray) -> np.ndarray:
        """V q, one pass over the fit list."""
        dims, mean, columns = self.dims, self.mean, q.shape[1]

        def run(batches):
            total = np.zeros((dims, columns))
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    centred = _matrix(batch.column(0).slice(at, ROWS), dims) - mean
                    total += centred.T @ (centred @ q)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["cell", "value"])

        cells = self.rows.mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
        out = np.zeros(dims * columns)
        for r in cells.collect():  # dimensions times columns of the block
            out[r["cell"]] = r["value"]
        return out.reshape(dims, columns) / self.n


def fit_list(integers: DataFrame) -> Fit:
    """Distinct vectors, written once, with their number and sums. Starts three jobs."""
    dims = integers.agg(F.max(F.length("x"))).first()[0]
    dims = (dims or 0) // 8
    rows = materialise(integers.select(F.rpad("x", 8 * dims, F.lit(b"\0")).alias("x") if dims else F.col("x")).distinct(), "fit-list")

    def moments(batches):
        # halves of 32 bits, so that sums of up to 2^31 rows stay exact
        high, low, n = np.zeros(dims, np.int64), np.zeros(dims, np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                x = _matrix(batch.column(0).slice(at, ROWS), dims)
                high += (x >> 32).sum(axis=0)
                low += (x & 0xFFFFFFFF).sum(axis=0)
                n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1, dtype=np.int32)), pa.array([*high.tolist(), 0]), pa.array([*low.tolist(), n])],
                                         names=["dim", "high", "low"])

    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    found = {r["dim"]: (int(r["high"]) << 32) + int(r["low"]) for r in rows.mapInArrow(moments, "dim int, high long, low long").groupBy("dim").agg(*exact).collect()}
    return Fit(rows, dims, found.get(dims, 0), [found.get(i, 0) for i in range(dims)])


def lower_bound(fit: Fit, steps: int, rng: np.random.Generator) -> float:
    """A bound below V's spectrum by Lanczos: the smallest Ritz value less the norm of what is left over."""
    q = rng.standard_normal((fit.dims, 1))
    basis = [q / np.linalg.norm(q)]
    alpha, beta = [], []
    for _ in range(min(steps, fit.dims)):
        w = fit.product(basis[-1])
        alpha.append((basis[-1].T @ w).item())
        for b in (*basis, *basis):
            w = w - b * (b.T @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(1.0, abs(alpha[0])):
            break
        basis.append(w / beta[-1])
    inner = np.diag(alpha) + np.diag(beta[:len(alpha) - 1], 1) + np.diag(beta[:len(alpha) - 1], -1)
    return max(0.0, float(np.linalg.eigvalsh(inner)[0]) - beta[-1])


def chebyshev(fit: Fit, q: np.ndarray, degree: int, low: float, high: float, top: float) -> np.ndarray:
    """The filtered block: the scaled Chebyshev polynomial of V that stays small on [low, high]."""
    half, centre = (high - low) / 2, (high + low) / 2
    sigma = half / (top - centre)
    factor = sigma
    before, now = q, (fit.product(q) - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        follow = 1 / (2 / sigma - factor)
        before, now = now, (fit.product(now) - centre * now) * (2 * follow / half) - before * (factor * follow)
        factor = follow
    return now


@dataclass
class Components:
    values: np.ndarray  # falling
    vectors: np.ndarray  # one column each
    residual: float  # the largest, relative to the first value
    identity_error: float


def leading_components(fit: Fit, wanted: int, guard: int = GUARD, degree: int = DEGREE, rounds: int = ROUNDS,
                       tolerance: float = TOLERANCE, accept: float = ACCEPT, seed: int = 11) -> Components:
    """The ``wanted`` largest eigenpairs of V, certified by their residuals. Every product is a job."""
    rng = np.random.default_rng(seed)
    wanted, block = min(wanted, fit.dims), min(fit.dims, wanted + guard)
    q = np.linalg.qr(rng.standard_normal((fit.dims, block)))[0] if block < fit.dims else np.eye(fit.dims)
    low = lower_bound(fit, LANCZOS, rng) if block < fit.dims else 0.0
    best = None
    for turn in range(rounds):
        if turn:
            high = max(values[-1], low + 1e-9 * values[0])  # noqa: F821 - set by the turn before
            if high >= values[wanted - 1]:  # no gap left below the wanted values: any of the equal ones will do
                break
            q = np.linalg.qr(chebyshev(fit, q, degree, low, high, values[0]))[0]
        image = fit.product(q)
        small = q.T @ image
        values, turns = np.linalg.eigh((small + small.T) / 2)
        values, turns = values[::-1], turns[:, ::-1]
        q, image = q @ turns, image @ turns
        scale = max(values[0], np.finfo(float).tiny)
        residual = float(np.linalg.norm(image[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max() / scale)
        keep = values[:wanted] > 1e-12 * scale
        whitened = (q[:, :wanted].T @ image[:, :wanted])[np.ix_(keep, keep)] / np.sqrt(np.outer(values[:wanted][keep], values[:wanted][keep]))
        error = float(np.abs(whitened - np.eye(keep.sum())).max()) if keep.any() else 0.0
        fell = best is None or residual < best.residual / 2
        if best is None or residual < best.residual:
            best = Components(values[:wanted][keep], q[:, :wanted][:, keep], residual, error)
        if residual <= tolerance or block == fit.dims or (not fell and best.residual <= accept):
            break
    if best.residual > accept:
        raise RuntimeError(f"no certified components after {rounds} rounds: residual {best.residual:.1e}")
    return best


def total_variance(fit: Fit) -> float:
    """The trace of V."""
    mean, dims = fit.mean, fit.dims

    def run(batches):
        total = 0.0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                total += float(((_matrix(batch.column(0).slice(at, ROWS), dims) - mean) ** 2).sum())
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["total"])

    return fit.rows.mapInArrow(run, "total double").agg(F.sum("total")).first()[0] / fit.n


def whiten(vectors: DataFrame, components: int = 4, vec_col: str = "embedding", id_col: str = "vec_id", guard: int = GUARD) -> DataFrame:
    """For every usable row and component: the id, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``. Starts the jobs of the fit while it is called; the result itself is map-only."""
    integers = integer_vectors(vectors, vec_col, id_col)
    fit = fit_list(integers)
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = None
    if fit.dims and fit.n > 1:
        found = leading_components(fit, components, guard)
    if found is None or not len(found.values):
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    explained = found.values / total_variance(fit)
    n, dims, mean, sums, error = fit.n, fit.dims, fit.mean, fit.sums, found.identity_error
    basis = found.vectors / np.sqrt(found.values)
    biggest = np.iinfo(np.int64).max

    def deviations(x: np.ndarray) -> list[int | None]:
        reach = n * int(max(abs(int(x.min())), abs(int(x.max())))) + max(map(abs, sums))
        if reach * reach * dims <= biggest:
            return ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((n * x.astype(object) - np.array(sums, dtype=object)) ** 2).sum(axis=1)
        return [v if v <= biggest else None for v in exact]

    def run(batches):
        k = len(explained)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                if not part.num_rows:
                    continue
                x = _matrix(part.column(1), dims)
                rows = np.repeat(np.arange(len(x)), k)
                number = np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows)), pa.array(number), pa.array(np.full(len(rows), n, np.int64)),
                     pa.array(deviations(x), pa.int64()).take(pa.array(rows)), pa.array(((x - mean) @ basis).ravel()),
                     pa.array(np.tile(explained, len(x))), pa.array(np.full(len(rows), error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return integers.mapInArrow(run, schema).withColumnRenamed("id", id_col)
