"""Embedding whitening (operator 12): blockwise QR, Householder bidiagonals, dqds, twisted factorisations.

Rows are counted in whole steps (``floor(scale * c)``), so that counts, sums and centred rows
are exact. Four passes over the table, each one map over its partitions:

1. the number of rows and the sum of every dimension;
2. the triangular factor R of the centred rows: every task folds its rows, block by block,
   into one d x d factor, and the factors are folded ``FAN`` at a time until one is left;
3. the covariance of the whitened rows, merged in the same tree, as the measured error;
4. the whitened rows themselves.

Between 2 and 3 the driver holds R alone (d x d numbers whatever the number of rows): R is
brought to an upper bidiagonal B by Householder reflections, dqds finds the squares of
B's singular values to high relative accuracy, and a twisted factorisation of
``B'B - value`` gives each one's vector. Values closer than ``CLUSTER`` share a subspace, whose
basis comes from block inverse iteration. No covariance matrix of the input is ever formed, so
small directions keep their digits.

Defined cases: rows whose vector is null or holds a null or non-finite entry take no part; a
vector shorter than the longest one (an empty one too) counts as ending in zeros; null and
repeated ids and repeated rows are rows of their own; components without variance (all of
them with one row, or equal rows) are not returned, so such tables and empty ones give no rows; entries
beyond 2^46 steps, and a deviation beyond a long, are errors; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import table

SCALE = 64
COMPONENTS = 32
BLOCK = 4096        # rows folded into a factor at a time
FAN = 16            # factors or covariances merged by one task
CLUSTER = 1e-4      # values relatively closer than this share a subspace
NOISE = 1e-11       # singular values below this share of the largest are rounding
EPS = float(np.finfo(np.float64).eps)


# ------------------------------------------------------------------ rows
def takes_part(vector: str) -> Column:
    v = F.col(vector)
    return v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))


def _steps(column: pa.Array, dims: int, scale: float) -> np.ndarray:
    """(rows, dims) whole steps; vectors that end early are filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(flat) and np.abs(flat).max() >= 1 << 46:
        raise ValueError("an entry is too large for exact sums")
    flat = flat.astype(np.int64)
    if (lengths == dims).all():
        return flat.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def _sums(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """One row a task: the number of rows, then the sum of every dimension met."""
    n, sums = 0, np.zeros(0, np.int64)
    for batch in batches:
        lengths = pc.list_value_length(batch.column(0))
        dims = max(pc.max(lengths).as_py() or 0, len(sums))
        n += batch.num_rows
        sums = np.pad(sums, (0, dims - len(sums))) + _steps(batch.column(0), dims, scale).sum(axis=0)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([[n, *sums.tolist()]], pa.list_(pa.int64()))], ["sums"])


@dataclass
class Centre:
    """Number of rows and the sum of every dimension, in steps; ``scale`` steps are one."""
    n: int
    sums: np.ndarray
    scale: float

    def deviations(self, steps: np.ndarray) -> np.ndarray:
        """``n * row - sums``: exact, ``n`` times the centred rows."""
        if len(steps) and self.n * int(np.abs(steps).max()) + int(np.abs(self.sums).max(initial=0)) >= 1 << 62:
            raise ValueError("too many rows for exact deviations")
        return self.n * steps - self.sums

    def centred(self, column: pa.Array) -> np.ndarray:
        return self.deviations(_steps(column, len(self.sums), self.scale)) / self.n


def fit_centre(vectors: DataFrame, scale: float = SCALE) -> Centre:
    """``vectors`` has one array column without nulls."""
    parts = vectors.mapInArrow(lambda b: _sums(b, scale), "sums array<bigint>")
    rows = parts.select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s")).collect()
    found = {r["at"]: r["s"] for r in rows}
    return Centre(found.get(0, 0), np.array([found[i] for i in range(1, len(found))], np.int64), scale)


# ------------------------------------------------------------------ trees of small matrices
_NODE = "part bigint, m binary"


def _node(part: int, m: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([m.astype("<f8").tobytes()], pa.binary())], ["part", "m"])


def tree_merge(parts: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """One matrix from (part, m): ``FAN`` neighbours become one, level by level; None without parts.

    ``merge`` gets flat arrays in the order of the parts. A task holds ``FAN`` matrices, the driver the last."""
    def level(t: pa.Table) -> pa.Table:
        t = t.sort_by("part")
        merged = merge([np.frombuffer(m, "<f8") for m in t.column("m").to_pylist()])
        return pa.Table.from_batches([_node(t.column("part")[0].as_py() // FAN, merged)])

    parts = cut_lineage(parts)
    last = parts.agg(F.max("part")).first()[0]
    while last:
        parts = cut_lineage(parts.groupBy(F.floor(F.col("part") / FAN).alias("_g")).applyInArrow(level, _NODE))
        last //= FAN
    found = parts.collect()
    return np.frombuffer(bytes(found[0]["m"]), "<f8") if found else None


def _part() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def _square(m: np.ndarray) -> np.ndarray:
    return m.reshape(int(round(len(m) ** 0.5)), -1)


def _triangle(rows: np.ndarray) -> np.ndarray:
    """The d x d triangular factor of some rows; zero rows below where there are too few."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))]) if len(r) < rows.shape[1] else r


def triangular_factor(vectors: DataFrame, centre: Centre) -> np.ndarray:
    """R of the QR factorisation of all centred rows."""
    d = len(centre.sums)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, met = np.zeros((d, d)), False
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                r, met = _triangle(np.vstack([r, centre.centred(batch.column(0).slice(at, BLOCK))])), True
        if met:
            yield _node(_part(), r.ravel())

    return _square(tree_merge(vectors.mapInArrow(fold, _NODE), lambda ms: _triangle(np.vstack([_square(m) for m in ms])).ravel()))


# ------------------------------------------------------------------ bidiagonal form
def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(v, beta, alpha): ``x - beta * v * (v.x)`` is ``alpha`` in the first place and zero below."""
    size = np.abs(x).max(initial=0.0)
    if size == 0.0 or not np.any(x[1:]):
        return x, 0.0, float(x[0])
    v = x / size
    alpha = -np.copysign(np.sqrt(v @ v), v[0])
    v[0] -= alpha
    return v, 2.0 / (v @ v), float(alpha * size)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, V): ``r = U B V'`` with B's diagonal ``a`` and superdiagonal ``b``."""
    r, d = r.copy(), len(r)
    v = np.eye(d)
    a, b = np.zeros(d), np.zeros(max(d - 1, 0))
    for k in range(d):
        h, beta, a[k] = _reflector(r[k:, k].copy())
        if beta:
            r[k:, k + 1:] -= np.outer(h, beta * (h @ r[k:, k + 1:]))
        if k < d - 1:
            h, beta, b[k] = _reflector(r[k, k + 1:].copy())
            if beta:
                r[k + 1:, k + 1:] -= np.outer(r[k + 1:, k + 1:] @ h, beta * h)
                v[:, k + 1:] -= np.outer(v[:, k + 1:] @ h, beta * h)
    return a, b, v


# ------------------------------------------------------------------ dqds
def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential quotient-difference transform with a shift: new q and e, and the d's on the way."""
    d = q[0] - shift
    qs, es, ds = [], [], [d]
    for nxt, off in zip(q[1:], e):
        head = d + off
        t = nxt / head
        qs.append(head)
        es.append(off * t)
        d = d * t - shift
        ds.append(d)
    return qs + [d], es, ds


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal (a, b), largest first.

    Every shift is a proven lower bound of the smallest value left: the d's of an unshifted step are
    the reciprocals of the diagonal of the inverse, so one over the sum of their reciprocals is one. So
    no step loses positivity, and values keep their relative accuracy.
    """
    size = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if size == 0.0:
        return np.zeros(len(a))
    found: list[float] = []
    stack = [([float(x) for x in (a / size) ** 2], [float(x) for x in (b / size) ** 2], 0.0)]
    small = EPS * EPS
    while stack:
        q, e, done = stack.pop()
        while True:
            if len(q) == 1:
                found.append(done + q[0])
                break
            if e[-1] <= small * (done + q[-1]) or e[-1] < 1e-290:
                found.append(done + q.pop())
                e.pop()
                continue
            cut = next((i for i in range(len(e) - 2, -1, -1) if e[i] <= small * (done + min(q[i], q[i + 1])) or e[i] < 1e-290), None)
            if cut is not None:
                stack.append((q[:cut + 1], e[:cut], done))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if q[0] < q[-1]:
                # graded the wrong way; the transpose read from its other end has the same values
                q, e = q[::-1], e[::-1]
            q, e, ds = _qd_step(q, e, 0.0)
            shift = (1 - 16 * len(q) * EPS) / sum(1 / d for d in ds) if min(ds) > 0 else 0.0
            if shift > done * EPS:
                qs, es, ds = _qd_step(q, e, shift)
                if min(ds) >= 0:
                    q, e, done = qs, es, done + shift
    return np.sort(np.array(found))[::-1] * size * size


# ------------------------------------------------------------------ twisted factorisations
def _twisted(q: np.ndarray, l: np.ndarray, value: float) -> np.ndarray:
    """The unit vector of ``LDL' - value`` (D = q, unit lower bidiagonal L) where the twist is least."""
    d = len(q)
    tiny = EPS * EPS * max(float(np.abs(q).max()), 1e-300)
    s, p = np.empty(d), np.empty(d)
    low, up = np.empty(max(d - 1, 0)), np.empty(max(d - 1, 0))
    s[0] = -value
    for i in range(d - 1):
        pivot = s[i] + q[i]
        low[i] = q[i] * l[i] / (pivot if abs(pivot) > tiny else tiny)
        s[i + 1] = low[i] * l[i] * s[i] - value
    p[-1] = q[-1] - value
    for i in range(d - 2, -1, -1):
        pivot = q[i] * l[i] * l[i] + p[i + 1]
        t = q[i] / (pivot if abs(pivot) > tiny else tiny)
        up[i] = l[i] * t
        p[i] = p[i + 1] * t - value
    twist = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(d)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -low[i] * z[i + 1]
    for i in range(twist, d - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.sqrt(z @ z)


def bidiagonal_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors (columns) of the bidiagonal for the squares ``values``, falling."""
    floor = EPS * np.sqrt(values[0])
    safe = np.where(np.abs(a) < floor, floor, a)
    q, l = safe * safe, b / safe[:-1]
    out = np.column_stack([_twisted(q, l, float(x)) for x in values])
    at = 0
    while at < len(values):
        end = at + 1
        while end < len(values) and values[end - 1] - values[end] <= CLUSTER * values[end - 1]:
            end += 1
        if end - at > 1:
            out[:, at:end] = _subspace(safe, b, values[at:end], out[:, at:end])
        at = end
    return out


def _subspace(a: np.ndarray, b: np.ndarray, values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Orthonormal vectors of close values: block inverse iteration, then rotation within the block."""
    d = len(a)
    t = np.diag(a * a + np.concatenate([[0.0], b * b])) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    z = start + 1e-3 * np.sin(np.outer(np.arange(1.0, d + 1), np.arange(1.0, len(values) + 1)) ** 2)
    inside = t - values.mean() * (1 + 4.7 * EPS) * np.eye(d)  # off every value by some rounding errors
    for _ in range(4):
        z = np.linalg.qr(np.linalg.solve(inside, z))[0]
    small, turn = np.linalg.eigh(z.T @ t @ z)
    return z @ turn[:, ::-1]


# ------------------------------------------------------------------ model
@dataclass
class Whitening:
    """``values``: variances of the components (squared steps); ``directions``: their unit vectors, as columns."""
    centre: Centre
    values: np.ndarray
    directions: np.ndarray
    trace: float

    @property
    def transform(self) -> np.ndarray:
        return self.directions / np.sqrt(self.values)


def principal_directions(r: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(variances, unit vectors as columns) of the rows behind the factor ``r``; none without variance."""
    a, b, v = bidiagonalise(r / np.sqrt(n))
    values = dqds(a, b)
    keep = values[:components]
    keep = keep[keep > (NOISE * NOISE) * values[0]] if values[0] > 0 else keep[:0]
    if not len(keep):
        return keep, np.zeros((len(r), 0))
    # a cluster is found whole, although its last members may not be wanted
    wide = len(keep)
    while wide < len(values) and values[wide] > 0 and values[wide - 1] - values[wide] <= CLUSTER * values[wide - 1]:
        wide += 1
    vectors = (v @ bidiagonal_vectors(a, b, values[:wide]))[:, :len(keep)]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))])
    return keep, vectors * signs


def fit_whitening(docs: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: float = SCALE) -> Whitening | None:
    """From all rows that take part; None where no component has variance."""
    vectors = docs.where(takes_part(vector)).select(vector)
    centre = fit_centre(vectors, scale)
    if not centre.n or not len(centre.sums):
        return None
    r = triangular_factor(vectors, centre)
    values, directions = principal_directions(r, centre.n, components)
    return Whitening(centre, values, directions, float((r * r).sum() / centre.n)) if len(values) else None


def identity_error(docs: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """Largest entry of (covariance of the whitened rows - identity), measured over all rows."""
    centre, transform, k = model.centre, model.transform, len(model.values)

    def pack(n, mean, m2):
        return np.concatenate([[n], mean, m2.ravel()])

    def merge(ms: list[np.ndarray]) -> np.ndarray:
        n, mean, m2 = 0.0, np.zeros(k), np.zeros((k, k))
        for m in ms:
            gap, total = m[1:k + 1] - mean, n + m[0]
            m2 = m2 + m[k + 1:].reshape(k, k) + np.outer(gap, gap) * (n * m[0] / total)
            mean, n = mean + gap * (m[0] / total), total
        return pack(n, mean, m2)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                w = centre.centred(batch.column(0).slice(at, BLOCK)) @ transform
                mean = w.mean(axis=0)
                block = pack(float(len(w)), mean, (w - mean).T @ (w - mean))
                held = block if held is None else merge([held, block])
        if held is not None:
            yield _node(_part(), held)

    found = tree_merge(docs.where(takes_part(vector)).select(vector).mapInArrow(measure, _NODE), merge)
    return float(np.abs(found[k + 1:].reshape(k, k) / found[0] - np.eye(k)).max())


def whiten(docs: DataFrame, model: Whitening, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """(id, deviation, whitened): of every row that takes part the exact ``sum((n * row - sums)^2)`` in
    squared steps and the array of its components."""
    centre, transform = model.centre, model.transform

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                exact = centre.deviations(_steps(part.column(1), len(centre.sums), centre.scale))
                if int(np.abs(exact).max(initial=0)) ** 2 * exact.shape[1] < 1 << 62:
                    deviation = (exact * exact).sum(axis=1).tolist()
                else:  # a value beyond a long is an error when the column is made
                    deviation = [sum(x * x for x in row) for row in exact.tolist()]
                w = exact / centre.n @ transform
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(deviation, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))], [id, "deviation", "whitened"])

    types = dict(docs.dtypes)
    return docs.where(takes_part(vector)).select(id, vector).mapInArrow(rows, f"`{id}` {types[id]}, deviation bigint, whitened array<double>")


def whitened_components(docs: DataFrame, vector: str = "embedding", id: str = "vec_id",
                        components: int = COMPONENTS, scale: float = SCALE) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): one row per row and component."""
    model = fit_whitening(docs, vector, components, scale)
    if model is None:
        return docs.limit(0).selectExpr(f"`{id}`", "int(0) AS component", "bigint(0) AS n", "bigint(0) AS deviation", "double(0) AS whitened",
                                        "double(0) AS explained", "double(0) AS identity_error")
    error = identity_error(docs, model, vector)
    explained = F.array(*[F.lit(float(x)) for x in model.values / model.trace])
    rows = whiten(docs, model, vector, id).select(id, "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return rows.select(id, (F.col("_at") + 1).alias("component"), F.lit(model.centre.n).cast("bigint").alias("n"), "deviation", "whitened",
                       F.get(explained, F.col("_at")).alias("explained"), F.lit(error).alias("identity_error"))


def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_components(table(spark, sf_dir, "embeddings"))
