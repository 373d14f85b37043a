"""Embedding whitening: principal components by spectral divide and conquer with QDWH polar decompositions.

Components are eigenvectors of the covariance.  A shift between the eigenvalues makes the covariance indefinite; the unitary
factor of its polar decomposition, found by the QR form of the dynamically weighted Halley iteration, is +1 on the eigenvectors
above the shift and -1 on those below, so (factor + 1) / 2 is the projector on the upper invariant subspace.  Its orthonormal
basis and that of the rest split the problem in two, and so on until every subspace has one dimension.  Only subspaces that hold
one of the wanted components are split further.  The decomposition works on one matrix as wide as the vectors are long; all that
grows with the rows is Spark's: distinct vectors, sums, covariances and the projection of every row by broadcast components.

Entries become whole numbers, x = floor(SCALE * entry) + SHIFT.  Sums and second moments are sums of whole numbers around a whole
centre near the mean, corrected by the rest of the mean afterwards, so they are exact, and components are equal however the rows are dealt.

Defined results: rows whose vector is null or holds a null or an entry that is no finite number are left out, as are rows whose
vector has another length than most have (the longer one on a tie), and empty vectors; equal vectors count once in the fit, and
all their rows are projected; entries beyond LARGEST after scaling count as LARGEST; a deviation that is no long is null;
components whose variance is nothing but rounding (below LEAST of the largest) cannot be whitened and give no rows, so a table
with fewer than two different vectors gives none; subspaces of equal variance get some orthonormal basis, the same in all runs;
ids may be null, and further columns are not read.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelline.session import cut

SCALE, SHIFT, LARGEST = 64, 1_000_000, 1 << 51
#: Components that are made, and the variance, against the largest, below which there is none.
COMPONENTS, LEAST = 16, 1e-12
#: Rows whose numbers a task holds at a time; whole numbers below which longs and doubles are exact.
ROWS, LONG, DOUBLE = 2000, 1 << 62, 1 << 53


# --- the decomposition ---------------------------------------------------------------------------------------------------


def polar(a: np.ndarray, steps: int = 30) -> np.ndarray:
    """The orthogonal polar factor of a square matrix, by QR-based dynamically weighted Halley steps."""
    n = len(a)
    x = a / np.linalg.norm(a)
    try:
        low = max(1e-17, 1 / np.linalg.norm(np.linalg.inv(x)))  # not above the smallest singular value
    except np.linalg.LinAlgError:
        low = 1e-17
    for _ in range(steps):
        before = x
        d = np.cbrt(4 * max(0.0, 1 - low * low) / low**4)
        weight = np.sqrt(1 + d) + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low * low) / (low * low * np.sqrt(1 + d))))
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(n)]))
        x = b / c * x + (weight - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        low = min(1.0, low * (weight + b * low * low) / (1 + c * low * low))
        if np.linalg.norm(x - before) < 1e-10 * np.sqrt(n):
            break
    return x


def split(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift; None if the shift does not part them well."""
    n = len(a)
    projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    projector = (projector + projector.T) / 2
    rank = int(round(float(np.trace(projector))))
    if not 0 < rank < n:
        return None
    basis = np.random.default_rng(n).normal(size=(n, rank))
    for _ in range(2):
        basis, _ = np.linalg.qr(projector @ basis)
    whole, _ = np.linalg.qr(basis, mode="complete")
    upper, lower = whole[:, :rank], whole[:, rank:]  # what is orthogonal to an invariant subspace is one too
    if np.linalg.norm(upper.T @ a @ lower) > 1e-12 * np.linalg.norm(a):
        return None
    return upper, lower


def components_of(a: np.ndarray, most: int | None = None, scale: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors, as columns, of a symmetric matrix: all, or the first `most`."""
    n = len(a)
    most = n if most is None else min(most, n)
    a = (a + a.T) / 2
    scale = np.linalg.norm(a) if scale is None else scale
    middle = np.diag(a)
    if n == 1 or np.linalg.norm(a - middle.mean() * np.eye(n)) <= 4e-16 * n * scale:
        order = np.argsort(-middle, kind="stable")[:most]
        return middle[order], np.eye(n)[:, order]
    parts = None
    for shift in _shifts(a):
        if parts := split(a, shift):
            break
    if parts is None:
        # No shift parts the eigenvalues to working precision: they are as good as equal, or a pair that one rotation parts.
        return _rotated(a, most)
    values, vectors = [], []
    for basis in parts:
        if (left := most - sum(map(len, values))) <= 0:
            break
        value, vector = components_of(basis.T @ a @ basis, left, scale)
        values.append(value)
        vectors.append(basis @ vector)
    return np.concatenate(values), np.concatenate(vectors, axis=1)


def _shifts(a: np.ndarray):
    """Shifts to try: the median of the diagonal, then other places between its values and the bounds of the eigenvalues."""
    middle = np.sort(np.diag(a))
    yield float(np.median(middle))
    yield float(middle.mean())
    radius = np.abs(a).sum(axis=1) - np.abs(np.diag(a))
    low, high = float((np.diag(a) - radius).min()), float((np.diag(a) + radius).max())
    for part in (0.5, 0.37, 0.63, 0.21, 0.79, 0.11, 0.89, 0.05, 0.95, 0.02, 0.98):
        yield float(np.quantile(middle, part)) + 1e-3 * (middle[-1] - middle[0])
        yield low + part * (high - low)


def _rotated(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Plane rotations until the matrix is diagonal: for small clusters of eigenvalues that no shift parts."""
    a, v = a.copy(), np.eye(len(a))
    for _ in range(60):
        for p in range(len(a) - 1):
            for q in range(p + 1, len(a)):
                if a[p, q] == 0:
                    continue
                t = 0.5 * np.arctan2(2 * a[p, q], a[q, q] - a[p, p])
                turn = np.array([[np.cos(t), np.sin(t)], [-np.sin(t), np.cos(t)]])
                a[:, [p, q]] = a[:, [p, q]] @ turn
                a[[p, q]] = turn.T @ a[[p, q]]
                v[:, [p, q]] = v[:, [p, q]] @ turn
        if np.linalg.norm(a - np.diag(np.diag(a))) <= 1e-16 * np.linalg.norm(a):
            break
    order = np.argsort(-np.diag(a), kind="stable")[:most]
    return np.diag(a)[order], v[:, order]


# --- what grows with the rows --------------------------------------------------------------------------------------------


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    def bounded(c):
        return F.floor(F.greatest(F.least(c * SCALE, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))) + SHIFT

    good = rows.filter(F.col("embedding").isNotNull() & finite & (F.size("embedding") > 0))
    size = good.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).select("d").first()
    if size is None:
        return good.select("vec_id", F.lit(None).cast("array<bigint>").alias("x"))
    return good.filter(F.size("embedding") == size["d"]).select("vec_id", F.transform(vector, bounded).alias("x"))


def _matrices(batches, column="x"):
    """The vectors of Arrow batches as matrices of whole numbers, with the rows they come from."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            vectors = part.column(column)
            yield part, vectors.flatten().to_numpy().reshape(part.num_rows, -1)


def column_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of the vectors and the sum of each dimension."""

    def of_batches(batches):
        total = n = 0
        for part, x in _matrices(batches):
            n += part.num_rows
            total = total + (x - SHIFT).sum(axis=0).astype(object)  # ROWS of them fit a long, all of a task may not
        if n:
            place = list(range(len(total)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), pa.array([str(int(t)) for t in total]), pa.array([n] * len(place))], names=["place", "part", "n"]
            )

    rows = fit.mapInArrow(of_batches, "place bigint, part string, n bigint").groupBy("place")
    rows = rows.agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).orderBy("place").collect()
    return (rows[0]["n"], [int(r["total"]) + SHIFT * r["n"] for r in rows]) if rows else (0, [])  # a row per dimension


def _second_moments(fit: DataFrame, of_matrix, exact: bool) -> np.ndarray:
    """Sum over all vectors of the products of the columns that `of_matrix` makes of a matrix of vectors."""
    kind = "decimal(38,0)" if exact else "double"

    def of_batches(batches):
        total = None
        for _, x in _matrices(batches):
            z = of_matrix(x)
            found = z.T @ z
            if exact:
                found = found.astype(object)
            total = found if total is None else total + found
        if total is not None:
            row, column = np.triu_indices(len(total))
            values = [str(int(v) if exact else v) for v in total[row, column].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(column), pa.array(values)], names=["i", "j", "part"])

    rows = fit.mapInArrow(of_batches, "i bigint, j bigint, part string").groupBy("i", "j")
    rows = rows.agg(F.sum(F.col("part").cast(kind)).alias("total")).collect()  # a row per pair of dimensions
    d = max(r["j"] for r in rows) + 1
    out = np.zeros((d, d), object)
    for r in rows:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["total"]
    return out


class Whitener(NamedTuple):
    """All that projecting a row needs."""

    n: int
    sums: list[int]
    centre: np.ndarray  # whole numbers near the mean
    rest: np.ndarray  # of the mean
    matrix: np.ndarray  # a column per component, divided by the root of its variance
    explained: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre - self.rest) @ self.matrix

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - sum) ** 2, exact."""
        z = x - self.centre
        off = np.array([s - self.n * int(c) for s, c in zip(self.sums, self.centre)], object)
        largest = self.n * int(np.abs(z).max(initial=0)) + max(abs(int(v)) for v in off)
        if largest**2 * len(off) < LONG:
            return ((self.n * z - off.astype(np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * z.astype(object) - off) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def fitted(fit: DataFrame, most: int = COMPONENTS) -> Whitener | None:
    """The whitener of distinct vectors; None where nothing varies."""
    n, sums = column_sums(fit)
    if n < 2:
        return None
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = np.array([(s - n * int(c)) / n for s, c in zip(sums, centre)])

    def centred(x):
        z = x - centre
        return z.astype(float if int(np.abs(z).max()) ** 2 * ROWS < DOUBLE else object)  # exact either way

    moments = _second_moments(fit, centred, exact=True)
    off = [s - n * int(c) for s, c in zip(sums, centre)]
    exact = [[(n * int(moments[i, j]) - off[i] * off[j]) / (n * n) for j in range(len(off))] for i in range(len(off))]
    covariance = np.array(exact, float)  # whole numbers up to one division
    value, vector = components_of(covariance, most)
    kept = value > LEAST * value[0] if value[0] > 0 else np.zeros(len(value), bool)
    value, vector = value[kept], vector[:, kept]
    if not len(value):
        return None
    return Whitener(n, sums, centre, rest, vector / np.sqrt(value), value / np.trace(covariance))


def identity_error(fit: DataFrame, whitener: Whitener) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, from the vectors themselves."""
    total = _second_moments(fit, whitener.project, exact=False).astype(float)
    return float(np.abs(total / whitener.n - np.eye(len(total))).max())


_WHITENED = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whitened(rows: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """A row per row that takes part and component: the row's coordinate, of variance one over the distinct vectors."""
    taking = usable(rows)
    fit = cut(taking.filter(F.col("x").isNotNull()).select("x").distinct())
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, {_WHITENED}"
    whitener = fitted(fit, most)
    if whitener is None:
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(fit, whitener)
    shared = rows.sparkSession.sparkContext.broadcast(whitener)  # dimensions times components

    def of_batches(batches):
        w = shared.value
        k = w.matrix.shape[1]
        for part, x in _matrices(batches):
            r = part.num_rows
            each = np.repeat(np.arange(r), k)
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), r)),
                pa.array(np.full(r * k, w.n)), pa.array(w.deviations(x), pa.int64()).take(pa.array(each)), pa.array(w.project(x).ravel()),
                pa.array(np.tile(w.explained, r)), pa.array(np.full(r * k, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return taking.mapInArrow(of_batches, schema)
