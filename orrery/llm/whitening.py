"""Operator 13: embedding whitening by spectrum slicing.

1. Vectors become integers, y = floor(scale * c) (x = y + offset moves no
   centred value, so only y is carried), and the fit list holds each distinct
   vector once: tasks drop their own repeats before the shuffle.
2. Exact sums of the fit list give the mean; a second pass over it adds products
   of centred values, so a covariance costs one d x d matrix per task.
3. The eigenvalues of that matrix are told apart by counting: by Sylvester's law
   of inertia, the LDL' factors of V - s I (Bunch and Kaufman's pivots) have as
   many positive pivots as V has eigenvalues above s.  Bisection by counts
   isolates each leading eigenvalue; Rayleigh quotient iteration, started and
   kept in its interval, converges cubically; counts just below and above what it
   found certify the number.  Eigenvalues closer together than rounding are found
   as one cluster, with orthogonal vectors.
4. Rows are projected in one more pass.  The whitened covariance over the fit
   list is measured, not assumed: its distance from the identity is a column.

The driver holds a d x d matrix, whatever the number of rows (d is at most
MAX_WIDTH).

Defined cases: vectors that are NULL or hold NULL or non-finite entries take no
part; shorter vectors are padded with zeros; entries beyond +-2^56 after scaling
count as that; components whose eigenvalue is not above 1e-12 of the largest
(equal vectors, dependent dimensions) are left out, so a table of one vector has
no rows; a deviation beyond the range of a long is NULL; a NULL vec_id is kept;
repeated rows get equal rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialize

MAX_WIDTH = 1024
#: Rows in a tile of dense numbers.
TILE = 4096
_MOST = 1 << 56
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)
_PIVOT = (1 + math.sqrt(17)) / 8


def valid(df: DataFrame) -> DataFrame:
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False))).select("vec_id", "embedding")


def _integers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """Rows of floor(scale * c), padded with zeros."""
    offsets = column.offsets.to_numpy()
    values = np.clip(np.floor(scale * column.values.to_numpy(zero_copy_only=False).astype(np.float64)), -float(_MOST), float(_MOST)).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    lengths = np.diff(offsets)
    rows = np.repeat(np.arange(len(column)), lengths)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, within] = values[np.repeat(offsets[:-1], lengths) + within]
    return out


def _tiles(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, pa.Array]]:
    for a in range(0, batch.num_rows, TILE):
        yield a, pa.concat_arrays([batch.column(at).slice(a, TILE)])


def _keys(batches, width: int, scale: int) -> Iterator[pa.RecordBatch]:
    """One binary key per distinct vector of a batch: its numbers in the narrowest type that holds them."""
    for batch in batches:
        for _, column in _tiles(batch, 0):
            y = np.unique(_integers(column, width, scale), axis=0)
            size = np.abs(y).max(1, initial=0)
            kind = (size >= 1 << 7).astype(int) + (size >= 1 << 15) + (size >= 1 << 31)
            keys = [bytes([k]) + row.astype(_WIDTHS[k]).tobytes() for k, row in zip(kind.tolist(), y, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], names=["key"])


def _read_keys(batches, width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        keys = batch.column(0).to_pylist()
        for a in range(0, len(keys), TILE):
            part = keys[a : a + TILE]
            out = np.empty((len(part), width), np.int64)
            for i, k in enumerate(part):
                out[i] = np.frombuffer(k, _WIDTHS[k[0]], width, 1)
            yield out


def _sums(batches, width: int) -> Iterator[pa.RecordBatch]:
    n, total = 0, [0] * width
    for y in _read_keys(batches, width):
        n += len(y)
        # two halves, so that no sum of a tile can leave 64 bits
        high, low = (y >> 28).sum(0).tolist(), (y & ((1 << 28) - 1)).sum(0).tolist()
        total = [t + (h << 28) + v for t, h, v in zip(total, high, low, strict=True)]
    numbers = [Decimal(v) for v in (n, *total)]
    yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int32()), pa.array(numbers, pa.decimal128(38, 0))], names=["i", "v"])


def _centred(y: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """y - mean, where mean = whole + rest and whole is an integer: one rounding."""
    return (y - whole).astype(np.float64) - rest


def _products(batches, width: int, whole, rest, project) -> Iterator[pa.RecordBatch]:
    """Sums of z_i z_j (i <= j) over a task, z being centred vectors, or their projections."""
    size = width if project is None else project.shape[1]
    total = np.zeros((size, size))
    for y in _read_keys(batches, width):
        z = _centred(y, whole, rest)
        z = z if project is None else z @ project
        total += z.T @ z
    i, j = np.triu_indices(size)
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"])


def _covariance(keys: DataFrame, width: int, n: int, whole, rest, project=None) -> np.ndarray:
    parts = keys.mapInArrow(lambda it: _products(it, width, whole, rest, project), "i int, j int, v double")
    got = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    size = width if project is None else project.shape[1]
    out = np.zeros((size, size))
    i, j, v = (got.column(c).to_numpy() for c in ("i", "j", "v"))
    out[i, j] = out[j, i] = v / n
    return out


def above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric matrix v lie above shift: the positive pivots of LDL' = v - shift I."""
    m = v - shift * np.eye(len(v))
    found = 0
    while len(m):
        if len(m) > 1:
            column = np.abs(m[1:, 0])
            r = int(column.argmax()) + 1
            most = column[r - 1]
            if abs(m[0, 0]) < _PIVOT * most:
                row = np.abs(m[r])
                row[r] = 0
                if abs(m[0, 0]) * row.max() < _PIVOT * most * most:
                    to = 0 if abs(m[r, r]) >= _PIVOT * row.max() else 1
                    if to != r:
                        m[[to, r]] = m[[r, to]]
                        m[:, [to, r]] = m[:, [r, to]]
                    if to:  # a 2 x 2 pivot has one eigenvalue on each side
                        c = m[2:, :2]
                        m = m[2:, 2:] - c @ np.linalg.solve(m[:2, :2], c.T)
                        found += 1
                        continue
        pivot = m[0, 0]
        found += pivot > 0
        c = m[1:, 0]
        m = m[1:, 1:] - np.outer(c, c / pivot) if pivot else m[1:, 1:]
    return int(found)


@dataclass
class Slices:
    """Counts of eigenvalues above shifts, each made once."""

    v: np.ndarray
    counts: dict[float, int] = field(default_factory=dict)

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = above(self.v, shift)
        return self.counts[shift]

    def interval(self, number: int, narrow: float) -> tuple[float, float]:
        """(low, high) around the eigenvalue of that number (1: the largest): it alone, or all that are within `narrow`."""
        low = max(s for s, c in self.counts.items() if c >= number)
        high = min(s for s, c in self.counts.items() if c < number)
        while high - low > narrow and (self.above(low) != number or self.above(high) != number - 1):
            mid = (low + high) / 2
            if self.above(mid) >= number:
                low = mid
            else:
                high = mid
        return low, high

    def halve(self, low: float, high: float, number: int) -> tuple[float, float]:
        mid = (low + high) / 2
        return (mid, high) if self.above(mid) >= number else (low, mid)


def _solve(v: np.ndarray, shift: float, b: np.ndarray, scale: float) -> np.ndarray:
    """(v - shift I) w = b, with a shift moved by rounding where that is singular."""
    for k in range(4):
        try:
            w = np.linalg.solve(v - (shift + k * 4 * np.finfo(float).eps * scale) * np.eye(len(v)), b)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(w).all():
            return w
    return b


def _rayleigh(v: np.ndarray, low: float, high: float, known: list[np.ndarray], scale: float, seed: int) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from the middle of an interval, orthogonal to the vectors that are known."""
    basis = np.array(known).reshape(len(known), len(v))
    free = lambda w: w - basis.T @ (basis @ w)
    unit = lambda w: w / np.linalg.norm(w)
    w = unit(free(free(np.random.default_rng(seed).standard_normal(len(v)))))
    shift, theta, still = (low + high) / 2, math.inf, 0
    for step in range(60):
        w = unit(free(free(unit(_solve(v, shift, w, scale)))))
        before, theta = theta, float(w @ v @ w)
        still = still + 1 if abs(theta - before) <= 4 * np.finfo(float).eps * scale else 0
        if still == 2:
            break
        # the quotient becomes the shift once it is in the interval
        shift = theta if step and low <= theta <= high else (low + high) / 2
    return theta, w


def leading(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a covariance: at most `most`, those above 1e-12 of the largest."""
    scale = float(np.abs(v).sum(1).max(initial=0))
    if not scale:
        return np.zeros(0), np.zeros((len(v), 0))
    eps = np.finfo(float).eps * scale
    s = Slices(v)
    s.counts |= {-scale: len(v), 1.01 * scale: 0}  # Gershgorin
    top = s.interval(1, 1e-3 * scale)[1]
    most = min(most, s.above(1e-12 * top))
    values, vectors = [], []
    while len(values) < most:
        number = len(values) + 1
        low, high = s.interval(number, 64 * eps)
        members = s.above(low) - (number - 1)  # 1, but for eigenvalues that agree to rounding
        found = []
        while len(found) < members:
            theta, w = _rayleigh(v, low, high, vectors + [x[1] for x in found], scale, number)
            slack = 64 * eps
            inside = low - slack <= theta <= high + slack
            if members == 1:
                certain = inside and s.above(theta - slack) >= number and s.above(theta + slack) <= number - 1
                if not certain and high - low > slack:
                    low, high = s.halve(low, high, number)
                    continue
            found.append((theta, w))
        for theta, w in sorted(found, key=lambda x: -x[0]):
            values.append(theta)
            vectors.append(w * (1 if w[np.abs(w).argmax()] > 0 else -1))
    return np.array(values[:most]), np.array(vectors[:most]).reshape(most, len(v)).T


@dataclass
class Model:
    """n vectors of the fit list, their exact sums (of y), leading eigenvalues and vectors, and how well they whiten."""

    scale: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def mean(self) -> tuple[np.ndarray, np.ndarray]:
        parts = [divmod(t, self.n) for t in self.sums] if self.n else []
        return np.array([p[0] for p in parts], np.int64), np.array([p[1] / self.n for p in parts])

    def project(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit(vectors: DataFrame, components: int = 16, scale: int = 64) -> Model:
    rows = valid(vectors)
    width = rows.agg(F.max(F.size("embedding")).alias("w")).first()["w"] or 0
    if width > MAX_WIDTH:
        raise ValueError(f"vectors of {width} entries; a covariance of at most {MAX_WIDTH} fits")
    keys = materialize(rows.select("embedding").mapInArrow(lambda it: _keys(it, width, scale), "key binary").distinct(), "fit_list")
    sums = keys.mapInArrow(lambda it: _sums(it, width), "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v"))
    by = {r["i"]: int(r["v"]) for r in sums.collect()}
    model = Model(scale, by.get(-1, 0), [by.get(i, 0) for i in range(width)], np.zeros(0), np.zeros((width, 0)), 0.0, 0.0)
    if model.n:
        whole, rest = model.mean()
        v = _covariance(keys, width, model.n, whole, rest)
        model.values, model.vectors = leading(v, components)
        model.trace = float(np.trace(v))
        if len(model.values):
            white = _covariance(keys, width, model.n, whole, rest, model.project())
            model.identity_error = float(np.abs(white - np.eye(len(white))).max())
    return model


def _deviation(y: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n * y - sum)^2, exact."""
    most = n * int(np.abs(y).max(initial=0)) + max(map(abs, sums), default=0)
    if most * most * max(1, y.shape[1]) < 1 << 63:
        d = n * y - np.array(sums, np.int64)
        return pa.array((d * d).sum(1), pa.int64())
    exact = [sum((n * a - t) ** 2 for a, t in zip(row, sums, strict=True)) for row in y.tolist()]
    return pa.array([x if x < 1 << 63 else None for x in exact], pa.int64())


def _whiten(batches, model: Model) -> Iterator[pa.RecordBatch]:
    whole, rest = model.mean()
    project, k = model.project(), len(model.values)
    explained = model.values / model.trace if k else model.values
    for batch in batches:
        for a, column in _tiles(batch, 1):
            y = _integers(column, len(model.sums), model.scale)
            white = _centred(y, whole, rest) @ project
            row = pa.array(np.repeat(np.arange(len(y)), k))
            size = len(y) * k
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, len(y)).take(row),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                    pa.array(np.full(size, model.n, np.int64)),
                    _deviation(y, model.n, model.sums).take(row),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, len(y))),
                    pa.array(np.full(size, model.identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )


def whiten(vectors: DataFrame, model: Model) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per valid vector and component."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return valid(vectors).mapInArrow(lambda it: _whiten(it, model), schema)


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whiten(vectors, fit(vectors))
