"""Whitening of vectors along principal components found by spectral divide and conquer.

Vectors are taken as whole numbers x = floor(scale * c) + shift. Three passes over the table gather
exact sums, the covariance (centred before multiplying) and the covariance of the result; each task
hands on sums of the size of the model only. The covariance is split without an eigenvalue solver:
the polar factor U of V - s*I, found by the QR-based dynamically weighted Halley iteration (QDWH),
is +1 on eigenvectors above the shift s and -1 below, so (U + I) / 2 projects on the invariant
subspace above it. V is restricted to the two subspaces and each is split again until they are
single components; parts below the wanted components are left unsplit. The components then travel
to the tasks as a broadcast.

Cases: rows whose vector is null, holds null, NaN or infinite entries, or an entry whose x does not
fit 63 bits are left out; so are vectors of another length than the most frequent (of two, the
longer). Repeated rows count and are returned as often as they occur; null and repeated ids stay.
A component without variance (fewer rows than dimensions, equal vectors) is returned with a null
whitened value and left out of the identity error. A deviation is null beyond a long, and its wide
form beyond 38 digits. Without usable rows, or with vectors of length
zero, the result is empty. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
SLICE_NUMBERS = 1 << 19
LARGEST = 2.0**62
NO_VARIANCE = 1e-12  # an eigenvalue below this share of the largest counts as zero
EPS = np.finfo(float).eps


# -- polar decomposition and the splitting of subspaces --------------------------------


def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal factor of a symmetric matrix by QDWH iterations."""
    n = len(a)
    eye = np.eye(n)
    x = a / np.sqrt(np.abs(a).sum(0).max() * np.abs(a).sum(1).max())
    r = np.linalg.qr(x, mode="r")
    low = max(np.abs(np.diag(r)).min() / np.sqrt(n), EPS)  # of the least singular value
    for _ in range(40):
        square = low * low
        d = np.cbrt(4 * max(1 - square, 0.0) / (square * square))
        root = np.sqrt(1 + d)
        weight_a = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0.0))
        weight_b = (weight_a - 1) ** 2 / 4
        weight_c = weight_a + weight_b - 1
        if weight_c > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(weight_c) * x, eye]))[0]
            step = (weight_a - weight_b / weight_c) / np.sqrt(weight_c) * (q[:n] @ q[n:].T)
        else:
            step = (weight_a - weight_b / weight_c) * np.linalg.solve(eye + weight_c * (x.T @ x), x.T).T
        new = weight_b / weight_c * x + step
        new = (new + new.T) / 2
        low = min(low * (weight_a + weight_b * square) / (1 + weight_c * square), 1.0)
        moved = np.linalg.norm(new - x)
        x = new
        if moved <= np.cbrt(5 * EPS) and 1 - low <= 10 * EPS:
            break
    return x


def _bases(projector: np.ndarray, rank: int, a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the projector's range and of its complement, if they split `a` well."""
    start = np.random.default_rng(rank).standard_normal((len(a), rank))
    for _ in range(4):
        q = np.linalg.qr(projector @ start, mode="complete")[0]
        upper, lower = q[:, :rank], q[:, rank:]
        if np.linalg.norm(lower.T @ a @ upper) <= 100 * EPS * len(a) * np.linalg.norm(a):
            return upper, lower
        start = upper
    return None


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Numbers to split the eigenvalues at: the mean lies within them, others are tried if it is one."""
    diagonal = np.diag(a)
    middle, spread = float(diagonal.mean()), float(np.linalg.norm(a - diagonal.mean() * np.eye(len(a))))
    yield float(np.median(diagonal))
    yield middle
    for k in range(1, 8):
        for sign in (1, -1):
            yield middle + sign * spread / len(a) * k / 8


def components_of(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    size = max(float(np.linalg.norm(a)), np.finfo(float).tiny)
    values, vectors = _split((a + a.T) / 2, np.eye(len(a)), min(wanted, len(a)), size)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]


def _split(a: np.ndarray, basis: np.ndarray, wanted: int, size: float) -> tuple[np.ndarray, np.ndarray]:
    n = len(a)
    centred = a - np.trace(a) / n * np.eye(n)
    if n == 1 or np.linalg.norm(centred) <= 4 * EPS * size:
        return np.diag(a).copy(), basis
    for shift in _shifts(a):
        sign = polar_factor(a - shift * np.eye(n))
        rank = round((np.trace(sign) + n) / 2)
        parts = _bases((sign + np.eye(n)) / 2, rank, a) if 0 < rank < n else None
        if parts is not None:
            break
    else:  # eigenvalues that no shift tells apart
        return np.diag(a).copy(), basis
    upper, lower = parts
    values, vectors = _split(_restricted(a, upper), basis @ upper, wanted, size)
    if rank < wanted:
        more, behind = _split(_restricted(a, lower), basis @ lower, wanted - rank, size)
        values, vectors = np.concatenate([values, more]), np.hstack([vectors, behind])
    return values, vectors


def _restricted(a: np.ndarray, basis: np.ndarray) -> np.ndarray:
    inner = basis.T @ a @ basis
    return (inner + inner.T) / 2


# -- passes over the table -------------------------------------------------------------


def _usable(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and their x (rows by dimensions, whole numbers), one length at a time."""
    column = column.cast(pa.list_(pa.float64()))
    sizes = np.where(column.is_null().to_numpy(zero_copy_only=False), -1,
                     column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    for size in np.unique(sizes[sizes >= 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        numbers = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), size)
        x = np.floor(SCALE * numbers) + SHIFT
        good = (np.abs(x) < LARGEST).all(1)  # not so for NaN and infinity
        if good.any():
            yield rows[good], (np.floor(SCALE * numbers[good])).astype(np.int64) + SHIFT


def _over(vectors: DataFrame, work: Callable, schema: str, dimensions: int) -> DataFrame:
    """`work` on an iterator of (ids, row numbers, x) of slices, of vectors of one length."""
    step = max(1, SLICE_NUMBERS // max(dimensions, 1))

    def run(batches):
        def parts():
            for batch in batches:
                for start in range(0, batch.num_rows, step):
                    part = batch.slice(start, step)
                    for rows, x in _usable(part.column(1)):
                        if x.shape[1] == dimensions:
                            yield part.column(0), rows, x

        yield from work(parts())

    return vectors.mapInArrow(run, schema)


def _selected(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    return vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))


def _exact_sums(vectors: DataFrame) -> DataFrame:
    """Per vector length and place: number of rows (place -1) and exact sum of x (place 0 on)."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}

        def rows():
            size = [s for s, total in sums.items() for _ in total]
            place = [i - 1 for total in sums.values() for i in range(len(total))]
            total = [Decimal(int(t)) for totals in sums.values() for t in totals]
            sums.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(size, pa.int32()), pa.array(place, pa.int32()), pa.array(total, pa.decimal128(38, 0))],
                ["size", "place", "total"])

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for _, x in _usable(batch.slice(start, 256).column(1)):
                    # two halves of 32 bits, so that no sum of a slice leaves 64 bits
                    total = (x >> 32).sum(0).astype(object) * 2**32 + (x & 0xFFFFFFFF).sum(0).astype(object)
                    total = np.concatenate([np.array([len(x)], object), total])
                    sums[x.shape[1]] = sums[x.shape[1]] + total if x.shape[1] in sums else total
                if sum(map(len, sums.values())) > SLICE_NUMBERS:
                    yield rows()
        yield rows()

    parts = vectors.mapInArrow(run, "size int, place int, total decimal(38,0)")
    return parts.groupBy("size", "place").agg(F.sum("total").alias("total"))


def _matrix_sum(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """The sum over tasks of (place, value) as a matrix; no larger than the model."""
    total = np.zeros(int(np.prod(shape)))
    for row in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():
        total[row.place] = row.value
    return total.reshape(shape)


def _places(total: np.ndarray) -> pa.RecordBatch:
    flat = total.ravel()
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["place", "value"])


@dataclass(frozen=True)
class Whitening:
    """A fitted model: whole-number mean and what is left of it, components and their shares."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # dimensions by components
    identity_error: float | None = None

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    def centre(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whole-number centre, its rest as n * centre - sum, and the rest of the mean."""
        nearest = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        rest = [self.n * m - s for m, s in zip(nearest, self.sums, strict=True)]
        return np.array(nearest, np.int64), np.array(rest, object), np.array([r / self.n for r in rest], float)

    def live(self) -> np.ndarray:
        """Which components have variance."""
        if not len(self.values):
            return np.zeros(0, bool)
        return self.values > NO_VARIANCE * max(float(self.values[0]), 0.0)

    def projection(self) -> np.ndarray:
        """Dimensions by components with variance, scaled to unit variance."""
        return self.vectors[:, self.live()] / np.sqrt(self.values[self.live()])


def _covariance(vectors: DataFrame, model: Whitening) -> np.ndarray:
    centre, _, rest = model.centre()

    def gather(parts):
        total = np.zeros((len(centre), len(centre)))
        for _, _, x in parts:
            y = (x - centre) + rest
            total += y.T @ y
        yield _places(total)

    found = _over(vectors, gather, "place long, value double", len(centre))
    return _matrix_sum(found, (len(centre), len(centre))) / model.n


def _identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the whitened rows' covariance minus the identity."""
    (centre, _, rest), projection = model.centre(), model.projection()
    k = projection.shape[1]
    if not k:
        return None

    def gather(parts):
        total = np.zeros((k + 1, k))
        for _, _, x in parts:
            w = ((x - centre) + rest) @ projection
            total[:k] += w.T @ w
            total[k] += w.sum(0)
        yield _places(total)

    found = _matrix_sum(_over(vectors, gather, "place long, value double", len(centre)), (k + 1, k)) / model.n
    return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())


def fit(
    vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding"
) -> Whitening | None:
    """Fit the model on all usable vectors; None if there are none."""
    rows = _selected(vectors, vec_id, vector)
    sums = _exact_sums(rows).checkpoint()
    lengths = sums.filter("place = -1 and size > 0").orderBy(F.desc("total"), F.desc("size")).limit(1).collect()
    if not lengths:
        return None
    size, n = lengths[0].size, int(lengths[0].total)
    ordered = sums.filter((F.col("size") == size) & (F.col("place") >= 0)).orderBy("place").collect()
    model = Whitening(n, tuple(int(row.total) for row in ordered), 0.0, np.zeros(0), np.zeros((size, 0)))
    covariance = _covariance(rows, model)
    values, found = components_of(covariance, components)
    model = replace(model, trace=float(np.trace(covariance)), values=values, vectors=found)
    return replace(model, identity_error=_identity_error(rows, model))


def whiten(
    vectors: DataFrame, model: Whitening, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per vector: vec_id, its deviation from the mean (n*x - S squared and added up, exact),
    and its value on each component (null where that has no variance)."""
    rows = _selected(vectors, vec_id, vector)
    shared = rows.sparkSession.sparkContext.broadcast((model.n, *model.centre(), model.live(), model.projection()))

    def project(parts):
        n, centre, left, rest, live, projection = shared.value
        last = sum(int(r) ** 2 for r in left)
        for ids, places, x in parts:
            z = x - centre
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(places)),
                 pa.array([Decimal(d) if d < 10**38 else None for d in _deviations(z, left, n, last)],
                          pa.decimal128(38, 0)),
                 _whitened(z + rest, live, projection)], ["vec_id", "deviation", "whitened"])

    schema = f"vec_id {dict(rows.dtypes)['vec_id']}, deviation decimal(38,0), whitened array<double>"
    return _over(rows, project, schema, model.dimensions)


def _deviations(z: np.ndarray, left: np.ndarray, n: int, last: int) -> list[int]:
    """Sum of (n*z + left) squared; n and left leave the sums over dimensions, which stay small."""
    if float(np.abs(z).max(initial=0)) ** 2 * z.shape[1] < LARGEST and (
        float(np.abs(z).max(initial=0)) * max(map(abs, left.tolist()), default=0) * z.shape[1] < LARGEST
    ):
        squares, mixed = (z * z).sum(1).tolist(), (z @ left.astype(np.int64)).tolist()
    else:
        wide = z.astype(object)
        squares, mixed = (wide * wide).sum(1).tolist(), (wide @ left).tolist()
    return [n * n * a + 2 * n * b + last for a, b in zip(squares, mixed, strict=True)]


def _whitened(y: np.ndarray, live: np.ndarray, projection: np.ndarray) -> pa.Array:
    values = np.full((len(y), len(live)), np.nan)
    values[:, live] = y @ projection
    flat = pa.array(values.ravel(), from_pandas=True)  # NaN to null
    return pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * len(live)), flat)


def whitened_rows(
    vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per usable vector and component, with the model's figures."""
    model = fit(vectors, components, vec_id, vector)
    if model is None:
        model = Whitening(0, (), 0.0, np.zeros(0), np.zeros((0, 0)))
        found = whiten(vectors.limit(0), model, vec_id, vector)
    else:
        found = whiten(vectors, model, vec_id, vector)
    shares = [max(float(v), 0.0) / model.trace if model.trace else None for v in model.values]
    whole = F.lit(Decimal(2**63))
    return found.select(
        "vec_id", F.lit(model.n).cast("long").alias("n"), F.col("deviation").alias("deviation_wide"),
        F.posexplode("whitened").alias("place", "whitened"),
    ).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), "n",
        F.when(F.col("deviation_wide") < whole, F.col("deviation_wide")).cast("long").alias("deviation"),
        "whitened", _share(shares), F.lit(model.identity_error).cast("double").alias("identity_error"),
        "deviation_wide")


def _share(shares: list[float | None]) -> Column:
    listed = F.array(*[F.lit(s).cast("double") for s in shares]) if shares else F.array(F.lit(None).cast("double"))
    return F.get(listed, F.col("place")).alias("explained")
