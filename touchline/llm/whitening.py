"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance V is never formed. A pass over the blocks of vectors gives V Q for a narrow block Q, as
centred X times Q and back, and the driver sees matrices of a row per dimension only. Each round
filters the block by a Chebyshev polynomial in V, its three-term recurrence a pass per degree, which stays
within one on the unwanted part of the spectrum and grows fast above it; QR and a Rayleigh-Ritz step on the
filtered block follow. Rounds end when the residual of every wanted pair is certified. A round that gains
little widens the block, so the iteration ends in any case: a block of all dimensions is exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from touchline.llm.topk import _matrix, _usable as finite
from touchline.session import pin, unpin

BLOCK = 4096
"""Vectors in a block."""
AT_DRIVER = 64
"""Matrices of a pass, a row per dimension each, that the driver adds up by itself."""
LARGEST = float(1 << 44)
"""Size of a component from which on a vector takes no part: a block's sums must fit a long."""
CERTIFIED = 2e-14
"""Residual of a pair, over the largest eigenvalue, that ends the rounds at once."""
SETTLED = 1e-11
"""Residual that ends them when it falls no further, which is where rounding stops it."""
NO_VARIANCE = 1e-12
"""Eigenvalues up to this share of the largest count as none."""
_LONG = 1 << 63


def usable(vectors: DataFrame, scale: int, id_: str, vector: str) -> DataFrame:
    """``id`` and ``x``, the components times ``scale`` rounded down, of the vectors that take part."""
    given = F.col(vector)
    near = F.forall(given, lambda c: F.abs(c.cast("double") * scale) < LARGEST)
    whole = F.transform(given, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    rows = vectors.where(finite(given) & (F.size(given) > 0)).where(near)
    return rows.select(F.col(id_).cast("long").alias("id"), whole.alias("x"))


def _pack(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = _matrix(pa.chunked_array([batch.column(0).slice(at, BLOCK)]), dims)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(x)], pa.int64()), pa.array([x.sum(0).tolist()], pa.list_(pa.int64())),
                     pa.array([x.astype(np.int64).tobytes()], pa.binary())],
                    names=["n", "sums", "x"],
                )

    return run


def _read(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for x in batch.column(0):
            yield np.frombuffer(x.as_buffer(), np.int64).reshape(-1, dims)


class Vectors:
    """Blocks of the distinct vectors, in the shared folder, with their number and exact sums."""

    def __init__(self, rows: DataFrame, dims: int):
        self.dims = dims
        self.table = pin(rows.select("x").distinct().mapInArrow(_pack(dims), "n long, sums array<long>, x binary"))
        self.tasks = self.table.select("x").rdd.getNumPartitions()
        parts = self.table.select("n", F.posexplode("sums").alias("dim", "s")).groupBy("dim").agg(
            F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
        self.n = int(parts[0].n)
        self.sums = [int(r.s) for r in sorted(parts, key=lambda r: r.dim)]
        # One rounding per dimension, however large the sums are.
        self.mean = np.array([s / self.n for s in self.sums])

    def times(self, q: np.ndarray) -> tuple[np.ndarray, float]:
        """V ``q`` and the trace of V, by one pass."""
        dims, mean, width = self.dims, self.mean, q.shape[1]

        def run(blocks: Iterator[np.ndarray]) -> np.ndarray:
            total = np.zeros((dims + 1, width))
            for x in blocks:
                centred = x - mean
                total[:-1] += centred.T @ (centred @ q)
                total[-1, 0] += np.einsum("ij,ij->", centred, centred)
            return total

        total = self._sum(run) / self.n
        return total[:-1], float(total[-1, 0])

    def spread(self, project: np.ndarray) -> np.ndarray:
        """The covariance of the centred vectors times ``project``, by one pass."""
        mean, width = self.mean, project.shape[1]

        def run(blocks: Iterator[np.ndarray]) -> np.ndarray:
            # The last row holds plain sums: the projected mean is zero but for rounding.
            total = np.zeros((width + 1, width))
            for x in blocks:
                w = (x - mean) @ project
                total[:-1] += w.T @ w
                total[-1] += w.sum(0)
            return total

        total = self._sum(run) / self.n
        return total[:-1] - np.outer(total[-1], total[-1])

    def _sum(self, run: Callable[[Iterator[np.ndarray]], np.ndarray]) -> np.ndarray:
        """The matrices that ``run`` makes in each task, added up.

        Beyond ``AT_DRIVER`` tasks they are first added up in the square root of as many, so that the driver gets few.
        """
        dims = self.dims

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield _matrix_row(run(_read(batches, dims)))

        def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [_matrix_of(*row) for batch in batches for row in zip(*map(pa.Array.to_pylist, batch.columns))]
            if parts:
                yield _matrix_row(sum(parts))

        parts = self.table.select("x").mapInArrow(each, _MATRIX)
        if self.tasks > AT_DRIVER:
            parts = parts.repartition(math.isqrt(self.tasks)).mapInArrow(together, _MATRIX)
        return sum(_matrix_of(r.width, r.cells) for r in parts.collect())


_MATRIX = "width int, cells binary"


def _matrix_row(m: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([m.shape[1]], pa.int32()), pa.array([m.tobytes()], pa.binary())], names=["width", "cells"])


def _matrix_of(width: int, cells: bytes) -> np.ndarray:
    return np.frombuffer(cells).reshape(-1, width)


def _floor_of(vectors, rng: np.random.Generator, steps: int) -> float:
    """A value below the spectrum, from ``steps`` of Lanczos with all directions kept orthogonal."""
    dims = vectors.dims
    q = rng.standard_normal(dims)
    basis, diagonal, beside = [q / np.linalg.norm(q)], [], []
    for _ in range(min(steps, dims)):
        y = vectors.times(basis[-1][:, None])[0][:, 0]
        diagonal.append(float(basis[-1] @ y))
        for _ in range(2):
            y = y - np.array(basis).T @ (np.array(basis) @ y)
        beside.append(float(np.linalg.norm(y)))
        if beside[-1] <= 1e-12 * max(abs(d) for d in diagonal):
            break
        basis.append(y / beside[-1])
    rest = beside[:len(diagonal) - 1]
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(rest, 1) + np.diag(rest, -1))
    return max(0.0, float(values[0]) - beside[-1])


@dataclass
class Spectrum:
    """The leading eigenvalues, falling, their unit vectors as columns, residuals, the trace, and passes taken."""

    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    trace: float
    passes: int


def _ritz(block: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, falling, with the block and its image turned to the Ritz vectors."""
    h = block.T @ image
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], block @ turn, image @ turn


def leading(vectors, wanted: int = 4, guard: int = 28, degree: int = 6, lanczos: int = 4, seed: int = 0) -> Spectrum:
    """The ``wanted`` leading eigenpairs of the covariance of ``vectors``, certified by their residuals.

    ``vectors`` has ``dims`` and ``times(q)``. Filters dampen the spectrum from a floor that Lanczos steps give up to
    the smallest Ritz value of the block, which has ``guard`` directions beyond the wanted ones.
    """
    dims = vectors.dims
    wanted, rng = min(wanted, dims), np.random.default_rng(seed)
    width = min(dims, wanted + guard)
    block = np.linalg.qr(rng.standard_normal((dims, width)))[0]
    image, trace = vectors.times(block)
    passes, before = 1, np.inf
    low = _floor_of(vectors, rng, lanczos) if width < dims and trace > 0 else 0.0
    passes += min(lanczos, dims) if width < dims and trace > 0 else 0
    while True:
        values, block, image = _ritz(block, image)
        residuals = np.linalg.norm(image[:, :wanted] - block[:, :wanted] * values[:wanted], axis=0)
        worst = residuals.max() / values[0] if values[0] > 0 else 0.0
        whole = block.shape[1] == dims
        if worst <= CERTIFIED or (worst <= SETTLED and worst > before / 4) or (whole and before < np.inf):
            return Spectrum(values[:wanted], block[:, :wanted], residuals, trace, passes)
        slow, before = worst > before / 10, worst
        if whole:
            filtered = image
        else:
            # Polynomial scaled to one at the largest Ritz value, so that nothing overflows.
            high, top = max(values[-1], low), values[0]
            floor = min(low, 0.9 * high)
            centre, half = (high + floor) / 2, max((high - floor) / 2, 1e-300)
            first = half / (centre - top) if top != centre else -1.0
            sigma, last, filtered = first, block, (image - centre * block) * (first / half)
            for _ in range(degree - 1):
                new = 1 / (2 / first - sigma)
                y, _ = vectors.times(filtered)
                last, filtered = filtered, (y - centre * filtered) * (2 * new / half) - last * (sigma * new)
                sigma = new
            passes += degree - 1
        if slow and not whole:
            more = min(dims - filtered.shape[1], filtered.shape[1])
            filtered = np.concatenate([filtered / np.linalg.norm(filtered, axis=0).max(), rng.standard_normal((dims, more))], 1)
        block = np.linalg.qr(filtered / np.maximum(np.linalg.norm(filtered, axis=0), 1e-300))[0]
        image, _ = vectors.times(block)
        passes += 1


@dataclass
class Whitening:
    """``project`` takes a centred vector to its whitened components; NaN columns have no variance.

    ``identity_error`` is the largest absolute entry of the whitened vectors' covariance minus the identity,
    NaN where no component has variance.
    """

    n: int
    sums: list[int]
    mean: np.ndarray
    project: np.ndarray
    spectrum: Spectrum
    identity_error: float
    dims: int


def fit(rows: DataFrame, components: int = 4) -> Whitening | None:
    """A whitening fitted on each distinct vector of ``usable`` once; None where there are none."""
    sizes = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if sizes is None:
        return None
    dims = sizes.dims
    vectors = Vectors(rows.where(F.size("x") == dims), dims)
    found = leading(vectors, components)
    there = found.values > max(NO_VARIANCE * found.values[0], 0.0)
    project = np.full((dims, len(there)), np.nan)
    project[:, there] = found.vectors[:, there] / np.sqrt(found.values[there])
    error = np.nan
    if there.any():
        error = float(np.abs(vectors.spread(project[:, there]) - np.eye(int(there.sum()))).max())
    unpin(vectors.table)
    return Whitening(vectors.n, vectors.sums, vectors.mean, project, found, error, dims)


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None where a long can't hold it."""
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    kind = np.int64 if reach ** 2 * x.shape[1] < _LONG else object
    gap = x.astype(kind) * n - np.array(sums, kind)
    return [int(d) if d < _LONG else None for d in (gap * gap).sum(1).tolist()]


def apply(rows: DataFrame, by: Whitening) -> DataFrame:
    """A row per vector of ``usable`` and component. Vectors of other lengths than the fitted one are left out."""
    explained = by.spectrum.values / by.spectrum.trace if by.spectrum.trace > 0 else np.full(by.project.shape[1], np.nan)
    n, sums, mean, project, error, dims = by.n, by.sums, by.mean, by.project, by.identity_error, by.dims
    width = project.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = _matrix(pa.chunked_array([part.column(1)]), dims)
                rows = len(x)
                of = pa.array(np.repeat(np.arange(rows), width))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(of),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * width, n, np.int64)),
                    pa.array(_deviation(x, n, sums), pa.int64()).take(of),
                    pa.array(((x - mean) @ project).ravel(), pa.float64(), from_pandas=True),
                    pa.array(np.tile(explained, rows), pa.float64(), from_pandas=True),
                    pa.array(np.full(rows * width, error), pa.float64(), from_pandas=True),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.where(F.size("x") == dims).mapInArrow(run, _OUT)


_OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(
    vectors: DataFrame, components: int = 4, scale: int = 256, id_: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Whitened coordinates of every vector on the leading principal components, a row per component.

    Null vectors, empty ones, those with null or non-finite components, and those with a component of 2^44 or more
    (in units of ``1 / scale``) take no part. Where lengths differ, the commonest speaks (of equals the
    longer) and other vectors are left out. Fewer dimensions make fewer components. A component without variance has
    null ``whitened``; without any variance ``explained`` and ``identity_error`` are null too. Repeated rows count once
    in the fit and come back each. A null id stays null. An empty table gives no rows. Other columns are left
    behind, whatever their names.
    """
    rows = usable(vectors, scale, id_, vector)
    by = fit(rows, components)
    return vectors.sparkSession.createDataFrame([], _OUT) if by is None else apply(rows, by)
