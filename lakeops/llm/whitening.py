"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Entries become fixed-point numbers; each distinct vector is a row of the fit matrix X, centred by
its exact mean. The bidiagonalisation alternates the products X v and X'u:

    a_j u_j = X v_j - b_(j-1) u_(j-1)          b_j v_(j+1) = X'u_j - a_j v_j

The v are as long as a vector has dimensions and stay on the driver. The u are as long as the
table; none is ever stored or moved: u_j = X w_j, so a task that has w_j has its part of u_j. One
job a step takes both products: each task multiplies its rows by all w, and sends the sums that
make U'p, p'p and X'p. New vectors are reorthogonalised against all before, on both sides. The
singular values and right vectors of the small bidiagonal matrix, turned back by V, are the
deviations and components. Where the Krylov space ends early (repeated eigenvalues) it goes on
from a new direction; where the rows have no further direction, there are fewer components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship, written

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
#: Greatest scaled entry; one beyond it has no long.
HIGHEST = 2.0 ** 62
#: Relative size below which a step found no direction, and error at which a component is settled.
NO_DIRECTION = 1e-11
SETTLED = 1e-13
CHECK_EVERY = 8
SEED = 20


@dataclass(frozen=True)
class Whitening:
    """What a vector is whitened with; ``whole`` and ``rest`` make the exact mean whole + rest / n."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    """The fixed-point vectors of a batch, whose last column holds their bytes."""
    column = batch.column(batch.num_columns - 1)
    if not len(column):
        return np.zeros((0, 1), np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), -1)


def fixed_point(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): each usable vector as the bytes of its fixed-point entries.

    Null vectors and those with null or non-finite entries go, as do entries too large for a long,
    empty vectors, and those that have not as many entries as most (of equally many, the longer).
    """
    ship(embeddings.sparkSession)
    read = embeddings.select(embeddings[vec_id].cast("bigint").alias("vec_id"),
                             embeddings[vector].cast("array<double>").alias("vector")).where("size(vector) > 0")
    sizes = read.groupBy(F.size("vector").alias("size")).count().orderBy(F.col("count").desc(), F.col("size").desc())
    top = sizes.first()
    read = read.where(F.size("vector") == (top["size"] if top else 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            with np.errstate(over="ignore"):
                scaled = values * float(SCALE)
            good = (np.abs(scaled) < HIGHEST).all(axis=1)  # false for nan, which stands for null too
            x = np.floor(scaled[good]).astype("<i8") + SHIFT
            ids = batch.column(0).filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([ids, pa.array([r.tobytes() for r in x], pa.binary())], names=["vec_id", "x"])

    return read.mapInArrow(run, "vec_id bigint, x binary")


def _summed(fit: DataFrame, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``part`` over the rows of all tasks, entry by entry; tasks add up their own first."""
    schema = pa.schema([("at", pa.int32()), ("value", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(_rows(batch))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int32()), pa.array(total, pa.float64())], schema=schema)

    rows = fit.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(rows))
    for at, value in rows:
        out[at] = value
    return out


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and, exactly, the sum of each dimension."""
    schema = pa.schema([("at", pa.int32()), ("value", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _rows(batch)
                # Halves of 32 bits, whose sums over a batch always fit.
                sums = [(int(h) << 32) + int(l) for h, l in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), strict=True)]
                total = sums if total is None else [a + b for a, b in zip(total, sums, strict=True)]
                n += len(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total) + 1), pa.int32()), pa.array([Decimal(v) for v in [n, *total]], pa.decimal128(38, 0))],
                schema=schema)

    rows = fit.mapInArrow(run, "at int, value decimal(38,0)").groupBy("at").agg(F.sum("value").alias("value")).collect()
    found = {r["at"]: int(r["value"]) for r in rows}
    return (found[0], [found[i] for i in range(1, len(found))]) if found else (0, [])


def _against(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The vector without its parts along an orthonormal basis, taken out twice."""
    for _ in range(2):
        vector = vector - basis @ (basis.T @ vector)
    return vector


def bidiagonalise(products: Callable[[np.ndarray, np.ndarray], tuple[float, np.ndarray, np.ndarray]], dimensions: int,
                  wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right vectors in columns) of X, largest first, up to ``wanted`` of them.

    ``products(q, W)`` gives p'p, U'p and X'p for p = X q and U = X W. It stops when the wanted
    ones are settled both before and after a new start from a direction not yet seen, when all
    dimensions are used up, or when X has no further direction.
    """
    rng = np.random.default_rng(SEED)
    v = rng.standard_normal(dimensions)
    v /= np.linalg.norm(v)
    vs, ws, zs = (np.zeros((dimensions, 0)) for _ in range(3))
    entries: list[tuple[int, int, float]] = []  # of U'XV: a on the diagonal, b beside it
    beta, largest, settled_once = 0.0, 0.0, False
    while True:
        q = v - beta * ws[:, -1] if beta else v
        square, along, z = products(q, ws)
        # p without its parts along the earlier u; X'p follows by linearity, as X'u are known.
        q, z = q - ws @ along, z - zs @ along
        alpha = float(np.sqrt(max(0.0, square - along @ along)))
        largest = max(largest, alpha)
        none = alpha <= NO_DIRECTION * largest
        if none and not beta:
            break  # a new direction, and X maps it into what is known: nothing is left in the rows
        done = False
        if beta:
            entries.append((ws.shape[1] - 1, vs.shape[1], beta))
        if none:
            vs, beta = np.column_stack((vs, v)), 0.0
        else:
            entries.append((ws.shape[1], vs.shape[1], alpha))
            vs, ws, zs = (np.column_stack(p) for p in ((vs, v), (ws, q / alpha), (zs, z / alpha)))
            r = _against(z / alpha - alpha * v, vs)
            beta = float(np.linalg.norm(r))
            largest = max(largest, beta)
            if ws.shape[1] >= wanted and ws.shape[1] % CHECK_EVERY == 0:
                left, sigma, _ = np.linalg.svd(_small(entries))
                done = bool((beta * np.abs(left[-1, :wanted]) <= SETTLED * sigma[0]).all())
        if vs.shape[1] == dimensions or done and settled_once:
            break
        if done or beta <= NO_DIRECTION * largest:
            settled_once = settled_once or done
            r, beta = _against(rng.standard_normal(dimensions), vs), 0.0
        v = r / np.linalg.norm(r)
    if not entries:
        return np.zeros(0), np.zeros((dimensions, 0))
    _, sigma, right = np.linalg.svd(_small(entries))
    keep = int((sigma > NO_DIRECTION * sigma[0]).sum())
    return sigma[:min(keep, wanted)], (vs[:, :right.shape[1]] @ right.T)[:, :min(keep, wanted)]


def _small(entries: list[tuple[int, int, float]]) -> np.ndarray:
    """The bidiagonal matrix; a column that ends a Krylov space has no row of its own."""
    small = np.zeros((max(r for r, _, _ in entries) + 1, max(c for _, c, _ in entries) + 1))
    for row, column, value in entries:
        small[row, column] = value
    return small


def fit(points: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``points`` (vec_id, x); None where there are none."""
    rows = written(points.select("x").distinct(), "fit_vectors")
    n, sums = exact_sums(rows)
    if not n:
        return None
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - whole).astype(np.float64) - rest / n

    def products(q: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def part(x: np.ndarray) -> np.ndarray:
            own = centred(x)
            p = own @ q
            return np.concatenate([[p @ p], (own @ w).T @ p, own.T @ p])
        found = _summed(rows, part)
        return float(found[0]), found[1:1 + w.shape[1]], found[1 + w.shape[1]:]

    trace = float(_summed(rows, lambda x: np.array([(centred(x) ** 2).sum()]))[0]) / n
    sigma, vectors = bidiagonalise(products, len(sums), min(components, len(sums))) if trace else (
        np.zeros(0), np.zeros((len(sums), 0)))
    model = Whitening(n, whole, rest, vectors, sigma ** 2 / n, trace)
    return Whitening(n, whole, rest, vectors, model.values, trace, identity_error(rows, model))


def whiten(model: Whitening, x: np.ndarray) -> np.ndarray:
    own = (x - model.whole).astype(np.float64) - model.rest / model.n
    return own @ model.components / np.sqrt(model.values)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(model.values)
    if not k:
        return 0.0

    def part(x: np.ndarray) -> np.ndarray:
        y = whiten(model, x)
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    found = _summed(rows, part) / model.n
    mean = found[:k]
    return float(np.abs(found[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def deviations(model: Whitening, x: np.ndarray) -> list[int]:
    """Exactly the sum over dimensions of (n x - S)^2, as n^2 dd - 2 n d r + rr for d = x - whole."""
    d = x - model.whole
    n, dims = model.n, max(1, x.shape[1])
    highest = int(np.abs(d).max()) if d.size else 0
    wide = highest * max(highest, n) * dims >= 2 ** 63
    d, rest = (d.astype(object), model.rest.astype(object)) if wide else (d, model.rest)
    square, cross, own = (d * d).sum(axis=1), (d * rest).sum(axis=1), sum(int(r) ** 2 for r in model.rest)
    return [n * n * int(a) - 2 * n * int(b) + own for a, b in zip(square, cross, strict=True)]


OUT = "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def apply(points: DataFrame, model: Whitening | None) -> DataFrame:
    """A row for each vector of ``points`` and component, numbered from 1 by falling eigenvalue."""
    if model is None or not len(model.values):
        return points.sparkSession.createDataFrame([], OUT)
    k = len(model.values)
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()),
                        ("deviation", pa.decimal128(38, 0)), ("whitened", pa.float64()), ("explained", pa.float64()),
                        ("identity_error", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            if not count:
                continue
            x = _rows(batch)
            each = pa.array(np.repeat(np.arange(count), k))
            far = pa.array([Decimal(v) if v < 10 ** 38 else None for v in deviations(model, x)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1), count), pa.int32()),
                pa.array(np.full(count * k, model.n), pa.int64()), far.take(each),
                pa.array(whiten(model, x).ravel(), pa.float64()),
                pa.array(np.tile(model.values / model.trace, count), pa.float64()),
                pa.array(np.full(count * k, model.identity_error), pa.float64())], schema=schema)

    return points.mapInArrow(run, OUT)


def whitened(embeddings: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id",
             vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of all usable vectors.

    Vectors that ``fixed_point`` leaves out have no row. A repeated vector counts once in the fit
    and is answered for each of its rows; null ids stay null. A table of equal vectors, or an empty
    one, has no component and gives no rows; fewer directions than ``components`` give fewer.
    ``deviation`` is exact up to 38 digits and null beyond.
    """
    points = fixed_point(embeddings, vec_id, vector)
    return apply(points, fit(points, components))
