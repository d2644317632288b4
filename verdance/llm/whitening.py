"""Embedding whitening through a bidiagonal qd solver.

1. An entry c becomes the integer x = floor(64 c) + 1000000. The fit list has each distinct x
   vector once; its number n and the sums S per dimension are exact.
2. Each task turns blocks of centred rows (n x - S, exact, over n) into a triangle by QR, the
   triangle before stacked on the next block. The tasks' triangles meet FAN at a time until one
   is left: R with R'R = n V.
3. Householder reflections make R / sqrt(n) bidiagonal. dqds finds the squared singular values to
   high relative accuracy; twisted factorisations of the bidiagonal's square give one vector for
   each, orthogonalised where values lie close, and the reflections carry them back.
4. Every row is projected; a pass over the fit list measures the covariance of the result.

Only n, S, triangles and directions reach the driver: their size follows the number of dimensions
(at most DIMENSIONS_MOST, else an error), not the rows.

Defined cases: a vector that is null, empty or holds a null or non-finite entry is dropped;
repeated rows and ids each get their rows; a component whose eigenvalue is zero (to rounding)
gives no row, so neither does a table of equal vectors; an empty table gives an empty one. Vectors
of different lengths are an error. A deviation that no long can hold is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from verdance.llm.common import forget, fresh, stored

STEPS, SHIFT = 64, 1_000_000
COMPONENTS = 16
DIMENSIONS_MOST = 4096
#: Triangles that one task stacks; rows of a QR block.
FAN, BLOCK = 8, 4096
EPS = float(np.finfo(np.float64).eps)
#: Eigenvalues whose relative distance is smaller are made orthogonal by hand.
CLOSE = 1e-3


def usable(embedding: str) -> str:
    """SQL: the vector has entries, all of them finite."""
    return f"size({embedding}) > 0 and not exists({embedding}, c -> c is null or isnan(c) or abs(c) = double('infinity'))"


# --- the small problem: singular values and directions of one triangle ---------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and superdiagonal of U' r V, and the reflections whose product is V."""
    a, n, right = r.astype(np.float64).copy(), r.shape[1], []

    def reflector(x: np.ndarray) -> np.ndarray:
        v = x.copy()
        size = np.linalg.norm(x)
        if size:
            v[0] += np.copysign(size, x[0])
            v /= np.linalg.norm(v)
        return v

    for k in range(n):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            right.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def carried_back(z: np.ndarray, right: list[np.ndarray]) -> np.ndarray:
    """V z for the columns of z."""
    out = z.copy()
    for k in range(len(right) - 1, -1, -1):
        out[k + 1 :] -= 2 * np.outer(right[k], right[k] @ out[k + 1 :])
    return out


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One transform with shift, and the d of every step."""
    d, new_q, new_e, ds = q[0] - shift, [], [], []
    for k in range(len(e)):
        ds.append(d)
        top = d + e[k]
        new_q.append(top)
        if top == 0:
            new_e.append(0.0)
            d = q[k + 1] - shift
        else:
            t = q[k + 1] / top
            new_e.append(e[k] * t)
            d = d * t - shift
    new_q.append(d)
    ds.append(d)
    return new_q, new_e, ds


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling. No subtraction but the
    shifts, each at most the smallest value, so small values keep their digits."""
    out: list[float] = []
    stack = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    small = (10 * EPS) ** 2
    while stack:
        q, e, moved = stack.pop()
        if q[0] < q[-1]:  # the same values with the small end last, where they converge first
            q, e = q[::-1], e[::-1]
        while q:
            if len(q) == 1:
                out.append(moved + max(q[0], 0.0))
                break
            if e[-1] <= small * (moved + q[-1]):
                out.append(moved + max(q.pop(), 0.0))
                e.pop()
                continue
            cut = next((k for k in range(len(e) - 1) if e[k] <= small * moved or e[k] == 0.0), None)
            if cut is not None:
                stack.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            # the smaller value of the last two rows as a shift; where it is too much, a bound
            # that never is: 1 / trace of the inverse, from the d of a transform without shift
            p, s, r = q[-2] + (e[-2] if len(e) > 1 else 0.0), e[-1], q[-1]
            half = (p + r + s) / 2
            shift = (p * r) / (half + max(half * half - p * r, 0.0) ** 0.5) if half else 0.0
            for guess in (shift * (1 - 4 * EPS), shift * 0.5, None):
                if guess is None:
                    _, _, ds = _dqds_step(q, e, 0.0)
                    least = min(ds)
                    guess = 0.0 if least <= 0 else (1 - 1e-10) / sum(1 / d for d in ds)
                new_q, new_e, ds = _dqds_step(q, e, guess)
                if min(ds) >= 0:
                    break
            else:
                guess, (new_q, new_e, ds) = 0.0, _dqds_step(q, e, 0.0)
            q, e, moved = new_q, new_e, moved + guess
    return np.sort(np.array(out))[::-1]


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float) -> tuple[np.ndarray, ...]:
    """Multipliers of the stationary (downward) and progressive (upward) factorisations of
    B'B - value, and gamma, the last pivot of each twist."""
    n = len(diagonal)
    d = diagonal**2
    low = above / diagonal[:-1]
    down, up = np.zeros(n - 1), np.zeros(n - 1)
    s, p = np.zeros(n), np.zeros(n)
    tiny = EPS**2 * max(float(d.max()), np.finfo(float).tiny / EPS**2)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + d[i]
        pivot = pivot if abs(pivot) > tiny else tiny
        down[i] = d[i] * low[i] / pivot
        s[i + 1] = down[i] * low[i] * s[i] - value
    p[n - 1] = d[n - 1] - value
    for i in range(n - 2, -1, -1):
        pivot = d[i] * low[i] ** 2 + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else tiny
        t = d[i] / pivot
        up[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    gamma = s + p + value
    return down, up, gamma


def _vector(down: np.ndarray, up: np.ndarray, at: int) -> np.ndarray:
    z = np.zeros(len(down) + 1)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(at, len(up)):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def directions(triangle: np.ndarray, n: int, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """The largest eigenvalues of V = triangle' triangle / n that are not zero, at most ``most``,
    their unit eigenvectors as columns, and the trace of V."""
    size = triangle.shape[1]
    r = np.vstack([triangle, np.zeros((max(0, size - len(triangle)), size))]) / np.sqrt(n)
    trace = float((r * r).sum())
    if size == 1:
        return (np.array([trace]), np.ones((1, 1)), trace) if trace > 0 else (np.zeros(0), np.zeros((1, 0)), 0.0)
    diagonal, above, right = bidiagonal(r)
    values = dqds(diagonal, above)
    kept = values[: min(most, size)]
    kept = kept[kept > size * size * EPS * EPS * values[0]] if values[0] > 0 else kept[:0]
    floor = EPS * EPS * np.sqrt(values[0]) if len(kept) else 1.0
    diagonal = np.where(np.abs(diagonal) < floor, floor, diagonal)
    found: list[np.ndarray] = []
    group: list[np.ndarray] = []
    for i, value in enumerate(kept):
        if i and kept[i - 1] - value > CLOSE * kept[i - 1]:
            group = []
        down, up, gamma = _twisted(diagonal, above, float(value))
        best, share = None, 0.0
        for at in np.argsort(np.abs(gamma))[: 1 + 2 * len(group)]:
            z = _vector(down, up, int(at))
            for _ in range(2):
                for other in group:
                    z = z - (z @ other) * other
            left = float(np.linalg.norm(z))
            if left > share:
                best, share = z / left, left
            if share > 0.5:
                break
        group.append(best)
        found.append(best)
    z = np.array(found).T if found else np.zeros((size, 0))
    return kept, carried_back(z, right), trace


# --- rows ----------------------------------------------------------------------------------------


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimensions)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: as longs where they fit, else as Python integers."""
    middle = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle, strict=True)]
    near = x.astype(object) - np.array(middle, object) if np.abs(x).max(initial=0) >= 2**61 else x - np.array(middle, np.int64)
    if len(x) and int(np.abs(near).max()) * n >= 2**61:
        return near.astype(object) * n - np.array(rest, object)
    return near * n - np.array(rest, np.int64)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_deviations(x, n, sums) / n).astype(np.float64)


def _triangles(batches: Iterator[pa.RecordBatch], n: int, sums: list[int]) -> Iterator[pa.RecordBatch]:
    dimensions = len(sums)
    r = np.zeros((0, dimensions))
    for batch in batches:
        x = _matrix(batch.column(0), dimensions)
        for i in range(0, len(x), BLOCK):
            r = np.linalg.qr(np.vstack([r, _centred(x[i : i + BLOCK], n, sums)]), mode="r")
    if len(r):
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["place", "triangle"]
        )


def _stacked(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[pa.RecordBatch]:
    """Triangles of one place, which follow each other, made one."""
    now, r = None, np.zeros((0, dimensions))

    def leave():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["place", "triangle"])

    for batch in batches:
        for place, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if place != now:
                if len(r):
                    yield leave()
                now, r = place, np.zeros((0, dimensions))
            r = np.linalg.qr(np.vstack([r, np.frombuffer(held).reshape(-1, dimensions)]), mode="r")
    if len(r):
        yield leave()


def triangle(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred fit list."""
    kinds, dimensions = "place long, triangle binary", len(sums)
    found = first = stored(fit.select("x").mapInArrow(lambda it: _triangles(it, n, sums), kinds), "triangles")
    places = found.agg(F.max("place")).first()[0] + 1
    while places > FAN:
        near = found.withColumn("place", F.expr(f"place div {FAN}")).repartition("place").sortWithinPartitions("place")
        found = near.mapInArrow(lambda it: _stacked(it, dimensions), kinds)
        places = -(-places // FAN)
    rows = sorted(found.collect(), key=lambda r: r["place"])
    forget(first)
    return np.linalg.qr(np.vstack([np.zeros((1, dimensions)), *[np.frombuffer(r["triangle"]).reshape(-1, dimensions) for r in rows]]), mode="r")


def _moments(batches: Iterator[pa.RecordBatch], n: int, sums: list[int], scaled: np.ndarray) -> Iterator[pa.RecordBatch]:
    total, squares = np.zeros(scaled.shape[1]), np.zeros((scaled.shape[1],) * 2)
    for batch in batches:
        w = _centred(_matrix(batch.column(0), len(sums)), n, sums) @ scaled
        total += w.sum(axis=0)
        squares += w.T @ w
    yield pa.RecordBatch.from_arrays([pa.array(range(total.size + squares.size), pa.int32()), pa.array(np.append(total, squares))], names=["place", "value"])


def identity_error(fit: DataFrame, n: int, sums: list[int], scaled: np.ndarray) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    k = scaled.shape[1]
    found = fit.select("x").mapInArrow(lambda it: _moments(it, n, sums, scaled), "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    values = np.zeros(k + k * k)
    for r in found.collect():
        values[r["place"]] = r["value"]
    mean, squares = values[:k] / n, values[k:].reshape(k, k) / n
    return float(np.abs(squares - np.outer(mean, mean) - np.eye(k)).max())


def _projected(batches: Iterator[pa.RecordBatch], n: int, sums: list[int], scaled: np.ndarray, explained: np.ndarray, error: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    k = scaled.shape[1]
    for batch in batches:
        off = _deviations(_matrix(batch.column(1), len(sums)), n, sums)
        whitened = (off / n).astype(np.float64) @ scaled
        if off.dtype == object or (len(off) and int(np.abs(off).max()) >= int((2**62 / len(sums)) ** 0.5)):
            far = [sum(int(v) ** 2 for v in row) for row in off]
            far = pa.array([v if v < 2**63 else None for v in far], pa.int64())
        else:
            far = pa.array((off * off).sum(axis=1))
        at = np.repeat(np.arange(len(off)), k)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(at)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(off))),
                pa.array(np.full(len(at), n)),
                far.take(pa.array(at)),
                pa.array(whitened.ravel()),
                pa.array(np.tile(explained, len(off))),
                pa.array(np.full(len(at), error)),
            ],
            schema=schema,
        )


def whiten(table: DataFrame, key: str = "vec_id", embedding: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): one row for each usable
    row of ``table`` and each of its first components, by falling eigenvalue e from 1.

    whitened: x - S / n on the component, over sqrt(e); deviation: sum of (n x - S)^2; explained:
    e over the trace of the covariance; identity_error: what ``identity_error`` measured.
    """
    entries = F.col(f"`{embedding}`").cast("array<double>")
    rows = (
        table.select(F.col(f"`{key}`").alias(key), entries.alias(fresh([key], "x")))
        .toDF("key", "x")
        .where(usable("x"))
        .withColumn("x", F.expr(f"transform(x, c -> floor({STEPS} * c) + {SHIFT}L)"))
    )
    fit = stored(rows.select("x").distinct(), "fit")
    sizes = fit.agg(F.count("*").alias("n"), F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first()
    n, dimensions = sizes["n"], sizes["high"]
    kind = to_arrow_type(table.schema[key].dataType)
    schema = pa.schema([
        pa.field(key, kind), pa.field("component", pa.int32()), pa.field("n", pa.int64()), pa.field("deviation", pa.int64()),
        pa.field("whitened", pa.float64()), pa.field("explained", pa.float64()), pa.field("identity_error", pa.float64()),
    ])
    kinds = f"`{key}` {table.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not n:
        return table.sparkSession.createDataFrame([], kinds)
    if sizes["low"] != dimensions:
        raise ValueError(f"vectors of {sizes['low']} and of {dimensions} entries")
    if dimensions > DIMENSIONS_MOST:
        raise ValueError(f"{dimensions} dimensions, at most {DIMENSIONS_MOST} are allowed")
    by_place = fit.select(F.posexplode("x").alias("place", "v")).groupBy("place").agg(F.sum(F.col("v").cast("decimal(20, 0)")).alias("s"))
    sums = [int(r["s"]) for r in sorted(by_place.collect(), key=lambda r: r["place"])]
    values, vectors, trace = directions(triangle(fit, n, sums), n, most)
    if not len(values):
        forget(fit)
        return table.sparkSession.createDataFrame([], kinds)
    scaled = vectors / np.sqrt(values)
    error = identity_error(fit, n, sums, scaled)
    forget(fit)
    return rows.mapInArrow(lambda it: _projected(it, n, sums, scaled, values / trace, error, schema), kinds)
