"""Whitening of embeddings by spectral divide-and-conquer with QDWH polar decompositions.

Vectors become integer vectors x = floor(scale * c) + shift.  Covariance is taken over every distinct x
vector once: sums first (exact integers), then products of centred entries, each a table of one row
for a task before it meets the others.  Only these dims x dims sums reach the driver.

``spectrum`` splits the covariance there: the polar factor of V - s I is the matrix sign, so (I + U) / 2 is
the projector on the components above s and (I - U) / 2 on those below; orthonormal bases of both give two
smaller covariances, which are split on.  Branches without a wanted component are not.  The polar
factor comes from QR-based dynamically weighted Halley steps (six are enough for any condition number
in double precision).  The components are broadcast (16 x dims doubles) and every row is
projected where it lies.

Results: rows whose vector is null or holds null or non-finite entries go.  Vectors of another length are
another table with its own n, sums and components; lengths are few.  Repeated rows count once in the
fit and stay in the result.  An empty vector has no components, so no rows.  A component without
variance (eigenvalue at rounding level) has explained 0 and whitened null, and does not count in
identity_error.  A deviation beyond a long is null.  A vec_id may be null or repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import per_row
from starmart.sources.scratch import stored

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
EPS = np.finfo(float).eps
LONG = 2**63 - 1


# Splitting a symmetric matrix ------------------------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix, by QR-based dynamically weighted Halley steps."""
    n = len(a)
    size = np.linalg.norm(a, 1)
    if size == 0:
        return np.eye(n)
    x = a / size
    # a lower bound of the least singular value: below rounding level the sign is not defined anyway
    low = EPS
    for _ in range(20):
        square = low * low
        gamma = np.cbrt(4 * (1 - square) / square**2)
        root = np.sqrt(1 + gamma)
        h = root + 0.5 * np.sqrt(max(8 - 4 * gamma + 8 * (2 - square) / (square * root), 0.0))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        q = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(n)]))[0]
        moved = (b / c) * x + (h - b / c) / np.sqrt(c) * q[:n] @ q[n:].T
        moved = (moved + moved.T) / 2
        done = np.linalg.norm(moved - x) <= np.cbrt(4 * EPS) * np.linalg.norm(moved) and abs(low - 1) < 10 * EPS
        x, low = moved, min(low * (h + b * square) / (1 + c * square), 1.0)
        if done:
            break
    return x


def split(v: np.ndarray, shift: float, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below ``shift``; None if one is empty or the shift is an eigenvalue."""
    n = len(v)
    above = (np.eye(n) + polar(v - shift * np.eye(n))) / 2
    many = np.trace(above)
    k = int(round(many))
    if not 0 < k < n or abs(many - k) > 1e-6:
        return None
    upper = np.linalg.qr(above @ draw.standard_normal((n, k)))[0]
    upper = np.linalg.qr(above @ upper)[0]
    lower = draw.standard_normal((n, n - k))
    for _ in range(2):
        lower -= above @ lower
        lower -= upper @ (upper.T @ lower)
        lower = np.linalg.qr(lower)[0]
    return upper, lower


def spectrum(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    draw, size = np.random.default_rng(42), np.linalg.norm(v, 2) if len(v) else 0.0
    found: list[tuple[float, np.ndarray]] = []
    # from the largest on: the branch above is on top
    branches = [np.eye(len(v))]
    while branches and len(found) < wanted:
        basis = branches.pop()
        block = basis.T @ v @ basis
        block = (block + block.T) / 2
        k = len(block)
        rest = block - np.diag(np.diag(block))
        if k == 1 or np.linalg.norm(rest) <= 4 * EPS * size:
            found += sorted(((float(block[i, i]), basis[:, i]) for i in range(k)), key=lambda f: -f[0])
            continue
        middle, spread = np.trace(block) / k, np.linalg.norm(block - np.trace(block) / k * np.eye(k)) / np.sqrt(k)
        # the mean lies strictly between the least and the largest; the others serve where it is an eigenvalue
        parts = next((p for step in (0, 0.11, -0.13, 0.29, -0.31, 0.53, -0.57) if (p := split(block, middle + step * spread, draw))), None)
        if parts is None:
            # nothing left to tell apart at rounding level
            found += sorted(((float(block[i, i]), basis[:, i]) for i in range(k)), key=lambda f: -f[0])
            continue
        upper, lower = parts
        branches += [np.linalg.qr(basis @ lower)[0], np.linalg.qr(basis @ upper)[0]]
    found = sorted(found, key=lambda f: -f[0])[:wanted]
    return np.array([e for e, _ in found]), np.array([u for _, u in found]).reshape(len(found), len(v)).T


# The tables -------------------------------------------------------------


def whole_numbers(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the rows that take part."""
    c = F.col(vector).cast("array<double>")
    bad: Column = F.exists(c, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    x = F.transform(c, lambda e: F.floor(e * SCALE).cast("long") + SHIFT)
    return embeddings.where(F.col(vector).isNotNull() & ~bad & (F.size(c) > 0)).select("vec_id", x.alias("x"))


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """A batch cut by vector length; nearly always there is one."""
    lengths = np.asarray(batch.column("x").value_lengths())
    for dims in np.unique(lengths).tolist():
        yield dims, batch.filter(pa.array(lengths == dims))


def fit_sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """n and exact sums of the fit list, by vector length."""
    at = fit.select(F.size("x").alias("dims"), F.posexplode("x").alias("i", "value"))
    sums = at.groupBy("dims", "i").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(20,0)")).alias("s")).collect()
    made: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(sums, key=lambda r: (r.dims, r.i)):
        made.setdefault(r.dims, (r.n, []))[1].append(int(r.s))
    return made


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, from exact integers n * x - S where they fit."""
    s = np.array(sums, dtype=object)
    if n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, sums)) <= LONG:
        return (n * x - s.astype(np.int64)) / n
    mean = np.array([v // n for v in sums], dtype=np.int64)
    left = np.array([(v % n) / n for v in sums])
    return (x - mean) - left


def products(fit: DataFrame, weights: dict[int, tuple[int, list[int], np.ndarray | None]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: sums of products and sums of centred vectors, projected first if a matrix is given.

    A task adds its rows up to one matrix of each length; these are added by a grouped sum of their entries.
    """
    held = fit.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for dims, part in _by_length(batch):
                n, sums, onto = held.value[dims]
                y = centred(_matrix(part, dims), n, sums)
                y = y if onto is None else y @ onto
                before = total.get(dims, (0.0, 0.0))
                total[dims] = (before[0] + y.T @ y, before[1] + y.sum(axis=0))
        for dims, (square, plain) in total.items():
            values = np.concatenate([square.ravel(), plain])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), dims, dtype=np.int32)), pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["dims", "i", "value"])

    parts = fit.select("x").mapInArrow(run, "dims int, i int, value double")
    rows = parts.groupBy("dims", "i").agg(F.sum("value").alias("value")).collect()
    made = {}
    for dims in {r.dims for r in rows}:
        k = dims if weights[dims][2] is None else weights[dims][2].shape[1]
        values = np.zeros(k * k + k)
        for r in rows:
            if r.dims == dims:
                values[r.i] = r.value
        made[dims] = (values[: k * k].reshape(k, k), values[k * k :])
    return made


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row and component."""
    spark: SparkSession = embeddings.sparkSession
    rows = whole_numbers(embeddings)
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    sums = fit_sums(fit)
    square = products(fit, {d: (n, s, None) for d, (n, s) in sums.items()})
    plan: dict[int, tuple[int, list[int], np.ndarray, np.ndarray]] = {}
    for dims, (n, s) in sums.items():
        v, mean = square[dims][0] / n, square[dims][1] / n
        v -= np.outer(mean, mean)  # what rounding left of the centre
        values, vectors = spectrum(v, min(components, dims))
        real = values > dims * EPS * max(np.trace(v), 0.0)
        onto = np.where(real, vectors / np.sqrt(np.where(real, values, 1.0)), 0.0)
        plan[dims] = (n, s, onto, np.where(real, values / (np.trace(v) or 1.0), 0.0))
    held = products(fit, {d: (n, s, onto) for d, (n, s, onto, _) in plan.items()})
    error = 0.0
    for dims, (n, _, onto, explained) in plan.items():
        real = explained > 0
        mean = held[dims][1] / n
        unit = (held[dims][0] / n - np.outer(mean, mean) - np.eye(onto.shape[1]))[np.ix_(real, real)]
        error = max(error, float(np.abs(unit).max(initial=0.0)))
    known = spark.sparkContext.broadcast(plan)
    kind = rows.schema["vec_id"].dataType.simpleString()

    def project(batch: pa.RecordBatch) -> Iterator[dict]:
        for dims, part in _by_length(batch):
            n, s, onto, explained = known.value[dims]
            x = _matrix(part, dims)
            y = centred(x, n, s) @ onto
            k = onto.shape[1]
            absent = np.tile(explained == 0, len(x))
            yield {
                "vec_id": part.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), k))),
                "component": np.tile(np.arange(1, k + 1), len(x)),
                "n": np.full(k * len(x), n),
                "deviation": pa.array([d for d in deviations(x, n, s) for _ in range(k)], pa.int64()),
                "whitened": pa.array(y.ravel(), pa.float64(), mask=absent),
                "explained": np.tile(explained, len(x)),
                "identity_error": np.full(k * len(x), error),
            }

    return per_row(rows, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double", project)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n * x - S)^2 of each row, exact; None beyond a long."""
    most = max(int(np.abs(n * x.min(axis=0).astype(object) - sums).max()), int(np.abs(n * x.max(axis=0).astype(object) - sums).max()))
    if most * most * x.shape[1] <= LONG and n * int(np.abs(x).max()) <= LONG and max(map(abs, sums)) <= LONG:
        apart = n * x - np.array(sums, dtype=np.int64)
        return (apart * apart).sum(axis=1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return [d if d <= LONG else None for d in exact]
