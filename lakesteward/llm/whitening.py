"""Whitening of embeddings by their leading principal components, found by Chebyshev-filtered subspace iteration.

Entries are read as the integers ``floor(256 * c)``. The fit list is each different vector once, written to the shared folder;
its size and sums are exact. The covariance is never built: each step multiplies it with a few columns, in one pass over the
fit list that adds up Yᵀ(YQ) of the centred vectors Y task by task and then dimension by dimension. A Chebyshev polynomial of degree DEGREE
in the covariance, by its three-term recurrence, damps the part of the spectrum below the block's least Ritz value; then come QR
and Rayleigh-Ritz, until the wanted pairs are certified: their residuals are below RESIDUAL of the largest eigenvalue, or as small
as rounding lets them get. Only arrays of dimensions times columns come to the driver or go out from it.

Defined results: rows whose vector is null, or holds null or non-finite entries, have no result; the space has as many dimensions as most
different vectors (the larger number on a tie), and rows of another length have no result; a component without
variance (at most NO_VARIANCE of the largest) is not returned, so a table of one different vector, or none, gives no rows; null ids and repeated
rows stay rows of their own; integers are kept within 2^53; a deviation too large for a long is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored

COMPONENTS = 4
SCALE = 256
MOST = 2.0**53
COLUMNS = 32
DEGREE = 10
ROUNDS = 60
AMPLIFIED = 1e10
RESIDUAL = 2e-14
# Residuals that no longer halve are taken as rounding from here on.
ROUNDING = 1e-11
NO_VARIANCE = 1e-12


def integer_rows(vectors: pa.Array) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Places of usable vectors, their integers, and the length of each."""
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(vectors)
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = np.maximum(lengths, 0)
    ends = np.cumsum(sizes)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    usable = np.flatnonzero((lengths >= 0) & (bad[ends] == bad[ends - sizes]))
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.clip(np.floor(SCALE * values), -MOST, MOST)
    whole = np.where(np.isfinite(whole), whole, 0).astype(np.int64)
    return usable, [whole[ends[i] - sizes[i]:ends[i]] for i in usable.tolist()], lengths[usable]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as little-endian integers of 4 bytes, or of 8 where one of them needs it."""
    for batch in batches:
        _, rows, _ = integer_rows(batch.column(0))
        wide = [bool(len(r)) and bool(np.abs(r).max() >= 1 << 31) for r in rows]
        data = [r.astype("<i8" if w else "<i4").tobytes() for r, w in zip(rows, wide)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(data, pa.binary()), pa.array([8 if w else 4 for w in wide], pa.int32()), pa.array([len(r) for r in rows], pa.int32())],
            names=["x", "width", "dims"],
        )


def _matrices(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The vectors of a batch of packed rows of one dimension as integer matrices."""
    widths = batch.column(1).to_numpy()
    for width in (4, 8):
        rows = batch.column(0).filter(pa.array(widths == width))
        if len(rows):
            yield np.frombuffer(b"".join(rows.to_pylist()), f"<i{width}").reshape(len(rows), -1)


@dataclass
class Fit:
    """The fit list ``x, width``, its size, its exact sums, and their quotients."""

    vectors: DataFrame
    n: int
    sums: list[int]

    @property
    def mean(self) -> np.ndarray:
        return np.array([_quotient(s, self.n) for s in self.sums])


def _quotient(a: int, b: int) -> float:
    return a / b


def fit_list(embeddings: DataFrame) -> Fit | None:
    """The different vectors of the table's space with their sums; None if there are none."""
    packed = embeddings.select("embedding").mapInArrow(_packed, "x binary, width int, dims int")
    different = stored(packed.distinct(), "vectors")
    spaces = different.groupBy("dims").agg(F.count("*").alias("n"))
    best = spaces.agg(F.max(F.struct("n", "dims")).alias("best")).first().best
    if best is None or not best.dims:
        return None
    vectors = different.where(F.col("dims") == best.dims).select("x", "width")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * best.dims
        for batch in batches:
            for x in _matrices(batch):
                # Rows at a time whose sum fits 64 bits.
                for at in range(0, len(x), 512):
                    part = x[at:at + 512].astype(np.int64).sum(axis=0)
                    total = [a + b for a, b in zip(total, part.tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(best.dims), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["dim", "s"]
        )

    rows = vectors.mapInArrow(add, "dim int, s decimal(38,0)").groupBy("dim").agg(F.sum("s").alias("s")).collect()
    return Fit(vectors, best.n, [int(r.s) for r in sorted(rows, key=lambda r: r.dim)])


def _added(fit: Fit, make, rows: int, columns: int) -> np.ndarray:
    """Sum over the fit list of the ``rows x columns`` arrays that ``make`` gives for centred vectors, one pass."""
    sent = fit.vectors.sparkSession.sparkContext.broadcast(fit.mean)
    names = [f"c{k}" for k in range(columns)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, total = sent.value, np.zeros((rows, columns))
        for batch in batches:
            for x in _matrices(batch):
                total += make(x - mean)
        yield pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int32()), *map(pa.array, total.T.copy())], names=["dim", *names])

    schema = ", ".join(["dim int", *[f"{n} double" for n in names]])
    summed = fit.vectors.mapInArrow(add, schema).groupBy("dim").agg(*[F.sum(n).alias(n) for n in names]).collect()
    return np.array([list(r)[1:] for r in sorted(summed, key=lambda r: r.dim)])


def covariance_times(fit: Fit, block: np.ndarray) -> np.ndarray:
    """The covariance of the fit list times some columns."""
    return _added(fit, lambda y: y.T @ (y @ block), *block.shape) / fit.n


def total_variance(fit: Fit) -> float:
    """The trace of the covariance."""
    return float(_added(fit, lambda y: np.sum(y * y, axis=0)[:, None], len(fit.sums), 1).sum()) / fit.n


def _ritz(block: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Falling Ritz values, Ritz vectors and their images, of an orthonormal block and its image."""
    small = block.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], block @ turn, image @ turn


def leading_components(times, dims: int, wanted: int = COMPONENTS, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors (columns) of a covariance, largest first; ``times`` multiplies it with a block.

    Pairs without variance are left out.
    """
    wanted, width = min(wanted, dims), min(dims, COLUMNS)
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, width)))[0]
    values, block, image = _ritz(block, times(block))
    before = np.inf
    for _ in range(ROUNDS):
        top = float(values[0])
        if top <= 0:
            return np.zeros(0), np.zeros((dims, 0))
        live = np.flatnonzero(values[:wanted] > NO_VARIANCE * top)
        residual = float(np.linalg.norm(image[:, live] - block[:, live] * values[live], axis=0).max()) / top
        if width == dims or residual <= RESIDUAL or (residual <= ROUNDING and residual > before / 2):
            signs = np.sign(block[np.abs(block[:, live]).argmax(axis=0), live])
            return values[live], block[:, live] * signs
        before = residual
        # Damped: from 0 to the least Ritz value, which no wanted eigenvalue is below.
        half = max(float(values[-1]), NO_VARIANCE * top) / 2
        # No larger a degree than keeps the smaller pairs apart from rounding of the largest.
        degree = int(np.clip(np.log(AMPLIFIED) / np.arccosh(max(top / half - 1, 1 + 1e-12)), 1, DEGREE))
        sigma = first = half / (top - half)
        last, now = block, (image - half * block) * (first / half)
        for _ in range(degree - 1):
            following = 1 / (2 / first - sigma)
            last, now = now, (times(now) - half * now) * (2 * following / half) - sigma * following * last
            sigma = following
        block = np.linalg.qr(now)[0]
        values, block, image = _ritz(block, times(block))
    raise RuntimeError("the components did not settle")


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum of (n * x - S)^2 over the dimensions of each row, exact; null beyond a long."""
    most = max(n * int(np.abs(x).max(initial=0)), max(map(abs, sums))) * 2
    if most * most * x.shape[1] < 1 << 63:
        return pa.array(((n * x.astype(np.int64) - np.array(sums, np.int64)) ** 2).sum(axis=1), pa.int64())
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of each usable row and component."""
    spark = embeddings.sparkSession
    id_type = embeddings.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = fit_list(embeddings)
    if fit is None:
        return spark.createDataFrame([], schema)
    dims = len(fit.sums)
    values, vectors = leading_components(lambda block: covariance_times(fit, block), dims, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    explained = values / total_variance(fit)
    turn = vectors / np.sqrt(values)
    spread = _added(fit, lambda y: (w := y @ turn).T @ w, len(values), len(values)) / fit.n
    error = float(np.abs(spread - np.eye(len(values))).max())
    sent = spark.sparkContext.broadcast((turn, fit.mean, fit.n, fit.sums))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, mean, n, sums = sent.value
        width = turn.shape[1]
        for batch in batches:
            places, rows, lengths = integer_rows(batch.column(1))
            here = np.flatnonzero(lengths == dims)
            if not len(here):
                continue
            x = np.stack([rows[i] for i in here.tolist()])
            each = np.repeat(np.arange(len(here)), width)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(places[here][each])), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(here))),
                    pa.array(np.full(len(each), n)), _deviations(x, n, sums).take(pa.array(each)),
                    pa.array(((x - mean) @ turn).reshape(-1)), pa.array(np.tile(explained, len(here))), pa.array(np.full(len(each), error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return embeddings.select("vec_id", "embedding").mapInArrow(project, schema)
