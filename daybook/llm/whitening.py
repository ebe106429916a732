"""Embedding whitening by Chebyshev-filtered subspace iteration.

Method. Entries become whole numbers, x = floor(64 c) + 1000000, and each distinct vector enters the fit list once. The
list is written as packed blocks; every pass over them computes V Q = X'(X Q) / n with centred X, for a block Q of a few
columns: tasks multiply, the sums of tasks are added in a second level, and the driver gets d x k numbers from few tasks.
Lanczos steps bound the spectrum from below. Then cycles of a Chebyshev recurrence, one pass a degree, damp what lies
between that bound and the smallest Ritz value of the block; QR makes the block orthonormal again, and a Rayleigh-Ritz
step turns it to its best eigenvectors. Cycles end when the residuals of the wanted pairs are at rounding level. A block
that does not get there grows; at d columns one Rayleigh-Ritz step is exact. The start is random, with a fixed seed.

Sums are whole numbers of any size, and rows are centred before they are multiplied as (n x - S) / n, with n x - S exact.

``whitened`` takes columns ``id`` and ``vector``; other columns are not read. Vectors that are null, or hold null or
non-finite entries, are left out. An x beyond a long is the nearest long. Vectors of another length are a space of their
own, with their own fit. Components without variance (beyond the rank, or all of them where every vector is the same)
have no whitened value and no rows; empty vectors and empty tables give no rows. Repeated rows each get theirs; a null
id stays null. Ties between eigenvalues are broken by rounding. A deviation beyond a long is null.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import staged

OFFSET, SCALE = 1_000_000, 64.0
BLOCK_BYTES = 1 << 21  # of one packed block
GUARD = 16  # columns beside the wanted ones
DEGREE, LANCZOS, CYCLES = 10, 10, 8
ROUNDING = 2e-15  # residual, relative to the largest eigenvalue, that more cycles would not lower
CERTIFIED = 1e-11  # residual that a result must reach
MOST_LONG = (1 << 63) - 1


def whole(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, x) for each vector length in a column of double arrays: rows that take part, as whole numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
    taken = np.maximum(lengths, 0)
    starts = np.cumsum(taken) - taken
    wrong = np.repeat(np.arange(len(lengths)), taken)[~np.isfinite(values)]
    good = lengths > 0
    good[wrong] = False
    out = []
    for d in np.unique(lengths[good]).tolist():
        at = np.flatnonzero(good & (lengths == d))
        scaled = np.floor(SCALE * values[starts[at][:, None] + np.arange(d)])
        inside = np.abs(scaled) < 2.0**62
        x = np.where(inside, scaled, 0).astype(np.int64) + OFFSET
        if not inside.all():
            for i, j in zip(*np.nonzero(~inside)):
                c = scaled[i, j]
                x[i, j] = max(-MOST_LONG - 1, min(MOST_LONG, int(c) + OFFSET)) if np.isfinite(c) else np.copysign(1, c) * MOST_LONG
        out.append((at, x))
    return out


@dataclass
class Centre:
    """How many vectors the fit list has, and their sum."""

    n: int
    total: list[int]

    def differences(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: as int64 where that holds it, else as Python numbers."""
        base = np.array([s // self.n for s in self.total], np.int64)
        rest = np.array([s % self.n for s in self.total], object)
        near = x.astype(np.float64) - base.astype(np.float64)
        if near.size and np.abs(near).max() * self.n >= 2.0**61:
            return x.astype(object) * self.n - np.array(self.total, object)
        return (x - base) * np.int64(self.n) - rest.astype(np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.differences(x).astype(np.float64) / float(self.n)

    def deviations(self, x: np.ndarray) -> pa.Array:
        y = self.differences(x)
        rough = (y.astype(np.float64) ** 2).sum(axis=1)
        if y.dtype != object and (not rough.size or rough.max() < 2.0**62):
            return pa.array((y * y).sum(axis=1))
        exact = [sum(int(v) ** 2 for v in row) for row in y]
        return pa.array([v if v <= MOST_LONG else None for v in exact], pa.int64())


def fit_list(vectors: DataFrame) -> DataFrame:
    """(dim, n, body): the distinct x-vectors, packed into blocks of bounded size."""

    def as_keys(batches):
        for batch in batches:
            for _, x in whole(batch.column(0)):
                rows = [r.tobytes() for r in np.ascontiguousarray(x, "<i8")]
                yield pa.RecordBatch.from_arrays([pa.array([x.shape[1]] * len(x), pa.int32()), pa.array(rows, pa.binary())], ["dim", "x"])

    def packed(batches):
        held: dict[int, list[bytes]] = {}

        def block(d: int) -> pa.RecordBatch:
            rows = held.pop(d)
            columns = [pa.array([d], pa.int32()), pa.array([len(rows)], pa.int64()), pa.array([b"".join(rows)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["dim", "n", "body"])

        for batch in batches:
            for d, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(d, []).append(x)
                if len(held[d]) * 8 * d >= BLOCK_BYTES:
                    yield block(d)
                elif len(held) > 64:
                    yield block(max(held, key=lambda k: len(held[k]) * k))
        for d in list(held):
            yield block(d)

    keys = vectors.select(F.col("vector").cast("array<double>").alias("vector")).mapInArrow(as_keys, "dim int, x binary")
    return staged(keys.distinct().mapInArrow(packed, "dim int, n long, body binary"), "op13-fit")


def _summed(blocks: DataFrame, part, width: int) -> np.ndarray:
    """The sum over all blocks of ``part(x)``, an array of ``width`` doubles or longs; tasks add before they send."""

    def add(arrays):
        total = None
        for a in arrays:
            total = a if total is None else total + a
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([total.dtype.str])], ["body", "kind"])

    def multiply(batches):
        def arrays():
            for batch in batches:
                for d, body in zip(batch.column("dim").to_pylist(), batch.column("body").to_pylist()):
                    yield part(np.frombuffer(body, "<i8").reshape(-1, d)).ravel()

        yield from add(arrays())

    def merge(batches):
        yield from add(np.frombuffer(b, k) for batch in batches for b, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))

    sums = blocks.mapInArrow(multiply, "body binary, kind string")
    few = max(1, ceil(sqrt(blocks.rdd.getNumPartitions())))
    rows = sums.repartition(few).mapInArrow(merge, "body binary, kind string").collect()
    arrays = [np.frombuffer(r["body"], r["kind"]) for r in rows]
    if arrays and arrays[0].dtype.kind == "i":
        return np.array([sum(int(a[i]) for a in arrays) for i in range(width)], object)
    return np.sum(arrays, axis=0) if arrays else np.zeros(width)


def centre_of(blocks: DataFrame, d: int) -> Centre:
    """Exact count and sums, added as upper and lower halves so that no long overflows."""
    halves = _summed(blocks, lambda x: np.concatenate([[len(x)], (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]), 2 * d + 1)
    return Centre(int(halves[0]), [(int(h) << 32) + int(low) for h, low in zip(halves[1 : d + 1], halves[d + 1 :])])


def _times(blocks: DataFrame, centre: Centre, q: np.ndarray) -> np.ndarray:
    """V Q, one pass."""

    def part(x: np.ndarray) -> np.ndarray:
        y = centre.centred(x)
        return y.T @ (y @ q)

    return _summed(blocks, part, q.size).reshape(q.shape) / centre.n


def _trace(blocks: DataFrame, centre: Centre) -> float:
    return float(_summed(blocks, lambda x: np.array([(centre.centred(x) ** 2).sum()]), 1)[0]) / centre.n


def _lowest(times, d: int, rng: np.random.Generator) -> float:
    """A bound close to the smallest eigenvalue, from a short Lanczos run with full orthogonalisation."""
    basis = [rng.standard_normal(d)]
    basis[0] /= np.linalg.norm(basis[0])
    alpha, beta = [], []
    for _ in range(min(LANCZOS, d - 1)):
        w = times(basis[-1][:, None])[:, 0]
        alpha.append(float(basis[-1] @ w))
        for _ in range(2):
            w = w - np.array(basis).T @ (np.array(basis) @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(alpha):
            break
        basis.append(w / beta[-1])
    values, s = np.linalg.eigh(np.diag(alpha) + np.diag(beta[: len(alpha) - 1], 1) + np.diag(beta[: len(alpha) - 1], -1))
    return max(0.0, float(values[0]) - beta[-1] * abs(float(s[-1, 0])))


def _filtered(times, q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float) -> np.ndarray:
    """A Chebyshev polynomial of V applied to Q: bounded on [low, high], steep above, scaled to 1 near ``top``."""
    middle, half = (high + low) / 2, (high - low) / 2
    first = half / (top - middle)
    scale = first
    before, now = q, (vq - middle * q) * (scale / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - scale)
        before, now = now, (times(now) - middle * now) * (2 * following / half) - (scale * following) * before
        scale = following
    return now


def _ritz(times, q: np.ndarray):
    vq = times(q)
    small = q.T @ vq
    values, w = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1]
    return values[order], q @ w[:, order], vq @ w[:, order]


def leading(times, d: int, wanted: int, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns; ``times(Q)`` gives V Q."""
    rng = np.random.Generator(np.random.PCG64(seed))
    k = min(d, wanted + GUARD)
    values, q, vq = _ritz(times, np.linalg.qr(rng.standard_normal((d, k)))[0])
    low, last, cycle = None, np.inf, 0
    while True:
        top = max(float(values[0]), 0.0)
        worst = float(np.linalg.norm(vq - q * values, axis=0)[:wanted].max())
        if top == 0.0 or k == d or worst <= ROUNDING * top or (worst <= CERTIFIED * top and worst > last / 4):
            break
        last, cycle = worst, cycle + 1
        if cycle % CYCLES == 0:
            # Too close to what follows: more columns put a distance between them.
            more = rng.standard_normal((d, min(d, 2 * k) - k))
            k = min(d, 2 * k)
            values, q, vq = _ritz(times, np.linalg.qr(np.hstack([q, more]))[0])
            last = np.inf
            continue
        if low is None:
            low = _lowest(times, d, rng)
        high = max(float(values[-1]), low + 1e-6 * top)
        block = _filtered(times, q, vq, low, high, max(top, high * (1 + 1e-9) + 1e-300))
        block = block / np.maximum(np.linalg.norm(block, axis=0), 1e-300)
        values, q, vq = _ritz(times, np.linalg.qr(block)[0])
    return values[:wanted], q[:, :wanted]


@dataclass
class Fit:
    centre: Centre
    values: np.ndarray
    vectors: np.ndarray  # d rows, a column per component
    trace: float
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.vectors / np.sqrt(self.values)


def fit(blocks: DataFrame, d: int, components: int = 16) -> Fit:
    centre = centre_of(blocks, d)
    wanted = min(components, d)
    values, vectors = leading(lambda q: _times(blocks, centre, q), d, wanted)
    has = values > max(float(values[0]), 0.0) * d * 1e-15
    if not values[0] > 0:
        has[:] = False
    out = Fit(centre, values[has], vectors[:, has], _trace(blocks, centre))
    if has.any():
        r = int(has.sum())
        square = _summed(blocks, lambda x: (w := out.project(x)).T @ w, r * r).reshape(r, r) / centre.n
        out.identity_error = float(np.abs(square - np.eye(r)).max())
    return out


def whitened(vectors: DataFrame, components: int = 16) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for columns ``id`` and ``vector``."""
    rows = vectors.select("id", F.col("vector").cast("array<double>").alias("vector"))
    blocks = fit_list(rows)
    dims = sorted(r["dim"] for r in blocks.select("dim").distinct().collect())
    fits = {d: fit(blocks.filter(F.col("dim") == d), d, components) for d in dims}
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def run(batches):
        for batch in batches:
            for at, x in whole(batch.column(1)):
                f = fits[x.shape[1]]
                r = len(f.values)
                if not r:
                    continue
                place = np.repeat(np.arange(len(at)), r)
                number = np.tile(np.arange(r), len(at))
                columns = [
                    batch.column(0).take(pa.array(at[place])),
                    pa.array((number + 1).astype(np.int32)),
                    pa.array(np.full(len(place), f.centre.n, np.int64)),
                    f.centre.deviations(x).take(pa.array(place)),
                    pa.array(f.project(x).ravel()),
                    pa.array((f.values / f.trace)[number]),
                    pa.array(np.full(len(place), f.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
