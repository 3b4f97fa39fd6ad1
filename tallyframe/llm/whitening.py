"""Whitening of embeddings onto the leading components of their covariance.

Two passes over the distinct vectors add up sums and then centred products, task by task, so that only numbers of the
vectors' dimension ever meet. The symmetric matrix that comes of it, of the dimension squared whatever the number of rows, is reduced
to tridiagonal form by reflections; counting sign changes of its Sturm sequence brackets each leading eigenvalue, inverse
iteration gives the vectors, and vectors of nearly equal eigenvalues are made orthogonal to each other. A third pass
measures what the projection leaves of the identity, and the last one projects every row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyframe.sources.shared import settle

#: Entries are counted in steps of 1 / SCALE.
SCALE = 256
#: Greatest entry whose steps a double still counts exactly; vectors beyond are as unusable as infinite ones.
GREATEST = 2.0**44
#: The covariance of this many dimensions takes 128 MB on the driver and in each task.
MAX_DIMENSIONS = 4096
_EPS = np.finfo(float).eps


# -- eigenvalues and vectors of one symmetric matrix ---------------------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal, and the orthogonal Q with Q' A Q tridiagonal, by Householder reflections."""
    a = np.array(matrix, float)
    d = len(a)
    q = np.eye(d)
    for k in range(d - 2):
        v = a[k + 1:, k].copy()
        if not np.any(v[1:]):
            continue
        length = np.copysign(np.linalg.norm(v), v[0])
        v[0] += length
        v /= np.linalg.norm(v)
        part = a[k + 1:, k + 1:]
        p = part @ v
        w = p - (v @ p) * v
        part -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] = a[k, k + 1:] = 0
        a[k + 1, k] = a[k, k + 1] = -length
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def count_above(diagonal: np.ndarray, off: np.ndarray, x: float) -> int:
    """How many eigenvalues lie above x: the positive terms of the Sturm sequence at x."""
    floor = _EPS * _EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    q, found = 1.0, 0
    for i, a in enumerate(diagonal):
        q = a - x - (off[i - 1] ** 2 / q if i else 0.0)
        if abs(q) < floor:
            q = -floor
        found += q > 0
    return found


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, wanted: int) -> np.ndarray:
    """The greatest eigenvalues, falling, each bracketed by bisection to a unit in the last place."""
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    slack = 2 * _EPS * max(np.abs(diagonal).max(), reach.max())
    least, most = (diagonal - reach).min() - slack, (diagonal + reach).max() + slack
    values = np.empty(wanted)
    for k in range(wanted):
        low, high = least, values[k - 1] + slack if k else most
        while True:
            middle = low + (high - low) / 2
            if not low < middle < high or high - low <= _EPS * max(abs(low) / 2, _EPS * abs(most)):
                break
            if count_above(diagonal, off, middle) > k:
                low = middle
            else:
                high = middle
        values[k] = low + (high - low) / 2
    return np.minimum.accumulate(values)


def _solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, floor: float) -> np.ndarray:
    """(T - shift) x = right by elimination with row exchanges; a vanishing pivot becomes `floor`."""
    d = len(diagonal)
    main, up, up2 = diagonal - shift, np.append(off, 0.0), np.zeros(d)
    below, x = off.copy(), right.copy()
    for i in range(d - 1):
        if abs(below[i]) > abs(main[i]):
            main[i], below[i] = below[i], main[i]
            up[i], main[i + 1] = main[i + 1], up[i]
            up2[i], up[i + 1] = up[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(main[i]) < floor:
            main[i] = floor
        factor = below[i] / main[i]
        main[i + 1] -= factor * up[i]
        up[i + 1] -= factor * up2[i]
        x[i + 1] -= factor * x[i]
    if abs(main[-1]) < floor:
        main[-1] = floor
    for i in range(d - 1, -1, -1):
        total = x[i]
        if i + 1 < d:
            total -= up[i] * x[i + 1]
        if i + 2 < d:
            total -= up2[i] * x[i + 2]
        x[i] = total / main[i]
    return x


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 6) -> np.ndarray:
    """One unit vector per eigenvalue, as columns; vectors of a cluster are orthogonalised against each other each round."""
    scale = max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0))
    floor = max(_EPS * scale, np.finfo(float).tiny)
    rng = np.random.default_rng(13)
    vectors = np.empty((len(diagonal), len(values)))
    cluster = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * scale:
            cluster = k
        # equal eigenvalues are told apart by a hair, so that each solve has a direction of its own
        shift = value - (k - cluster) * 2 * _EPS * scale
        x = rng.standard_normal(len(diagonal))
        for _ in range(rounds):
            x /= np.abs(x).max()
            x = _solve_shifted(diagonal, off, shift, x, floor)
            x /= np.abs(x).max()
            for _ in range(2):  # twice, as one subtraction leaves rounding behind
                x -= vectors[:, cluster:k] @ (vectors[:, cluster:k].T @ x)
            x /= np.linalg.norm(x)
        vectors[:, k] = x
    return vectors


def leading_components(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as rows; the entry of greatest size of each is positive."""
    wanted = min(wanted, len(matrix))
    diagonal, off, q = tridiagonal(matrix)
    values = leading_eigenvalues(diagonal, off, wanted)
    vectors = (q @ inverse_iteration(diagonal, off, values)).T
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    heads = vectors[np.arange(wanted), np.abs(vectors).argmax(1)]
    return values, vectors * np.where(heads < 0, -1.0, 1.0)[:, None]


# -- passes over the rows --------------------------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Whether a vector has entries and all are finite numbers; false for NULL."""
    entry = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < GREATEST)
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, entry), F.lit(False))


def _steps(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """Rows of whole steps."""
    lists = batch.column(column)
    entries = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * entries).astype(np.int64).reshape(len(lists), -1)


def _packed(steps: np.ndarray) -> list[bytes]:
    """A vector as bytes, equal for equal vectors: the width of its widest entry, then the entries in that width."""
    widest = np.abs(steps).max(1, initial=0)
    made = [b""] * len(steps)
    for width, bound in ((1, 127), (2, 32767), (4, 2**31 - 1), (8, 2**63 - 1)):
        rows = np.flatnonzero((widest <= bound) & (widest >= 0))
        if not len(rows):
            continue
        raw = np.ascontiguousarray(steps[rows].astype(f"<i{width}")).view(np.uint8).reshape(len(rows), -1)
        for row, content in zip(rows.tolist(), raw, strict=True):
            made[row] = bytes([width]) + content.tobytes()
        widest[rows] = -1
    return made


def _unpacked(column: pa.Array, dimensions: int) -> np.ndarray:
    held = column.to_pylist()
    steps = np.empty((len(held), dimensions), np.int64)
    for i, b in enumerate(held):
        steps[i] = np.frombuffer(b, f"<i{b[0]}", offset=1)
    return steps


def _batches(run: Callable[[Iterator[pa.RecordBatch]], Iterator[list]], schema: T.StructType):
    """`run` gives columns; Spark gets record batches."""
    kinds, names = [to_arrow_type(f.dataType) for f in schema], schema.names

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in run(batches):
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return work


def _distinct_steps(vectors: DataFrame) -> DataFrame:
    """Each vector of steps once, packed."""
    schema = T.StructType([T.StructField("packed", T.BinaryType())])

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                yield [_packed(_steps(batch, 0))]

    return vectors.mapInArrow(_batches(pack, schema), schema).distinct()


def _sums(fit: DataFrame, dimensions: int) -> tuple[int, list[int]]:
    """Number of vectors and their exact sum per dimension."""
    schema = T.StructType.fromDDL("dim int, n long, total decimal(38,0)")

    def add(batches):
        n, total = 0, [0] * dimensions
        for batch in batches:
            if batch.num_rows:
                steps = _unpacked(batch.column(0), dimensions)
                low, high = int(steps.min()), int(steps.max())
                safe = max(-low, high) * len(steps) < 2**62
                part = steps.sum(0).tolist() if safe else steps.astype(object).sum(0).tolist()
                total = [a + b for a, b in zip(total, part, strict=True)]
                n += len(steps)
        yield [list(range(dimensions)), [n] * dimensions, [Decimal(t) for t in total]]

    added = fit.mapInArrow(_batches(add, schema), schema).groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    rows = {r["dim"]: r for r in added.collect()}  # one row per dimension
    if not rows:
        return 0, [0] * dimensions
    return rows[0]["n"], [int(rows[i]["total"]) for i in range(dimensions)]


def _centred_products(
    fit: DataFrame, dimensions: int, mean: np.ndarray, project: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the vectors, less their mean and projected if asked: of each entry, and of the product of each two."""
    size = dimensions if project is None else project.shape[1]
    schema = T.StructType.fromDDL("i int, j int, total double")
    i, j = np.triu_indices(size)
    sent = fit.sparkSession.sparkContext.broadcast((mean, project))

    def multiply(batches):
        mean, project = sent.value
        sums, products = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                centred = _unpacked(batch.column(0), dimensions) - mean
                if project is not None:
                    centred = centred @ project
                sums += centred.sum(0)
                products += centred.T @ centred
        yield [i.tolist() + [-1] * size, j.tolist() + list(range(size)), np.concatenate([products[i, j], sums]).tolist()]

    added = fit.mapInArrow(_batches(multiply, schema), schema).groupBy("i", "j").agg(F.sum("total").alias("total"))
    sums, products = np.zeros(size), np.zeros((size, size))
    for r in added.collect():  # a row per two dimensions
        if r["i"] < 0:
            sums[r["j"]] = r["total"]
        else:
            products[r["i"], r["j"]] = products[r["j"], r["i"]] = r["total"]
    return sums, products


@dataclass(frozen=True)
class Whitening:
    """What fitting found. `eigenvalues` fall; those that rounding cannot tell from 0 have a NULL scale."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray = field(repr=False)
    components: np.ndarray = field(repr=False)
    trace: float
    identity_error: float | None

    def scales(self) -> list[float | None]:
        least = max(len(self.sums), 1) * _EPS * self.trace
        return [float(np.sqrt(e)) if e > least else None for e in self.eigenvalues]


def vector_dimensions(df: DataFrame, vector: str) -> int:
    """The commonest length of usable vectors, the greater of equally common ones; 0 for none."""
    held = df.where(usable(F.col(f"`{vector}`"))).groupBy(F.size(f"`{vector}`").alias("d")).count()
    found = held.orderBy(F.desc("count"), F.desc("d")).first()
    return found["d"] if found else 0


def _of(df: DataFrame, vector: str, dimensions: int) -> DataFrame:
    column = F.col(f"`{vector}`")
    return df.where(usable(column) & (F.size(column) == dimensions))


def fit(df: DataFrame, vector: str = "embedding", components: int = 4, dimensions: int | None = None) -> Whitening:
    """Fit on each distinct vector of steps once, so copies of a vector weigh nothing."""
    dimensions = vector_dimensions(df, vector) if dimensions is None else dimensions
    if dimensions > MAX_DIMENSIONS:
        raise ValueError(f"{dimensions} dimensions; a covariance of more than {MAX_DIMENSIONS} does not fit a task")
    if not dimensions:
        return Whitening(0, [], np.empty(0), np.empty((0, 0)), 0.0, None)
    distinct = settle(_distinct_steps(_of(df, vector, dimensions).select(F.col(f"`{vector}`"))), "whitening-fit")
    n, sums = _sums(distinct, dimensions)
    mean = np.array([s / n for s in sums])
    _, products = _centred_products(distinct, dimensions, mean)
    covariance = products / n
    values, vectors = leading_components(covariance, components)
    found = Whitening(n, sums, values, vectors, float(np.trace(covariance)), None)
    scales = found.scales()
    kept = [k for k, s in enumerate(scales) if s is not None]
    if not kept:
        return found
    project = np.stack([vectors[k] / scales[k] for k in kept], 1)
    totals, products = _centred_products(distinct, dimensions, mean, project)
    left = products / n - np.outer(totals / n, totals / n) - np.eye(len(kept))
    return Whitening(n, sums, values, vectors, found.trace, float(np.abs(left).max()))


def _deviations(steps: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S)^2; NULL for one that no long holds."""
    if not len(steps):
        return []
    reach = n * int(np.abs(steps).max()) + max(map(abs, sums))
    if reach * reach * len(sums) < 2**63:
        away = n * steps - np.array(sums, np.int64)
        return (away * away).sum(1).tolist()
    exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in steps.tolist()]
    return [e if e < 2**63 else None for e in exact]


def whiten(df: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`key`, `component` (from 1), `n`, `deviation`, `whitened`, `explained` and `identity_error`, a row per usable row
    of `df` and component.

    Rows whose vector is NULL, empty, of another length than the model's, or holds a NULL, a non-finite or a gigantic
    (2**44) entry are left out. Keys pass through, NULL or repeated; other columns are not read. A component whose
    eigenvalue rounding cannot tell from 0 has a NULL `whitened`; without any variance `explained` is NULL too. An
    empty table gives no rows, and a model of more components than dimensions has as many as dimensions.
    """
    dimensions, wanted = len(model.sums), len(model.eigenvalues)
    schema = T.StructType([
        df.schema[key], *T.StructType.fromDDL(
            "component int, n long, deviation long, whitened double, explained double, identity_error double")])
    sent = df.sparkSession.sparkContext.broadcast(model)

    def project(batches):
        model = sent.value
        mean = np.array([s / model.n for s in model.sums])
        scales = model.scales()
        shares = [e / model.trace if model.trace else None for e in model.eigenvalues.tolist()]
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            steps = _steps(batch, 1)
            onto = (steps - mean) @ model.components.T
            for k, scale in enumerate(scales):
                onto[:, k] = onto[:, k] / scale if scale else np.nan
            missing = np.tile([s is None for s in scales], rows)
            yield [
                batch.column(0).take(pa.array(np.repeat(np.arange(rows), wanted))),
                pa.array(np.tile(np.arange(1, wanted + 1, dtype=np.int32), rows)),
                [model.n] * (rows * wanted),
                [d for d in _deviations(steps, model.n, model.sums) for _ in range(wanted)],
                pa.array(onto.ravel(), pa.float64(), mask=missing),
                shares * rows,
                [model.identity_error] * (rows * wanted),
            ]

    source = _of(df, vector, dimensions) if wanted else df.limit(0)
    return source.select(F.col(f"`{key}`"), F.col(f"`{vector}`")).mapInArrow(_batches(project, schema), schema)
