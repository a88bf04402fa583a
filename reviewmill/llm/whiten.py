"""Whitening of embeddings onto their leading principal components.

Entries become whole numbers first, so counts, sums and products are exact and do not depend on how rows are dealt
out. The fit list holds each distinct vector once. Every task centres its vectors at the whole part of the mean and sums their products;
sums of tasks are added in two steps, and the fraction of the mean is taken off exactly, which gives each entry of the covariance
correctly rounded. The driver holds that matrix, whose size is the square of the vector length and does not grow with the rows:
Householder reflections make it tridiagonal, bisection on Sturm counts finds the leading eigenvalues, inverse iteration their
vectors, those of close eigenvalues being made orthogonal to each other again in every step. The components are broadcast and each
row is projected where it is. A second pass over the fit list measures how far the whitened covariance is from the identity.

Defined results: rows whose vector is null or holds a null or non-finite entry take no part; shorter vectors count as padded with
zeros; repeated vectors weigh once in the fit and are returned each; rows without an id take part; eigenvalues that are zero to
working precision have no component, so equal vectors or an empty table give none; other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, StructType

from reviewmill.llm.common import unused
from reviewmill.llm.vectors import matrix, usable, whole
from reviewmill.session import keep

SCALE = 64
OFFSET = 1_000_000
#: Largest whole number of a vector entry before the offset, so that doubles hold it exactly.
LARGEST = 2**52
#: Neighbouring eigenvalues closer than this share of the matrix norm form a cluster.
CLOSE = 1e-3
EPS = np.finfo(float).eps


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal and off-diagonal of a symmetric matrix after Householder reflections, and the reflections."""
    a = np.array(a, float)
    d = len(a)
    reflections = []
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        rest = np.abs(x[1:]).max()
        if rest == 0:
            continue
        scale = max(rest, abs(x[0]))
        v = x / scale
        v[0] += math.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        block = a[k + 1 :, k + 1 :]
        p = 2 * (block @ v)
        w = p - (p @ v) * v
        block -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] -= 2 * (v @ x) * v
        a[k, k + 1 :] = a[k + 1 :, k]
        reflections.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def turn_back(vectors: np.ndarray, reflections: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Eigenvectors of the tridiagonal matrix, one a column, as those of the matrix it came from."""
    out = vectors.copy()
    for start, v in reversed(reflections):
        out[start:] -= 2 * np.outer(v, v @ out[start:])
    return out


def smaller(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sturm counts: for each value the number of eigenvalues below it."""
    tiny = np.finfo(float).tiny / EPS * max(1.0, float(np.max(off**2, initial=0)))
    count = np.zeros(len(values), int)
    q = np.ones(len(values))
    squares = np.concatenate([[0.0], off**2])
    for at in range(len(diagonal)):
        q = (diagonal[at] - values) - squares[at] / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until doubles hold no value between its bounds."""
    d = len(diagonal)
    reach = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    margin = EPS * d * max(abs(low), abs(high)) + np.finfo(float).tiny
    below = d - 1 - np.arange(k)  # eigenvalues below the wanted one
    lows, highs = np.full(k, low - margin), np.full(k, high + margin)
    while True:
        middle = lows + (highs - lows) / 2
        if ((middle <= lows) | (middle >= highs)).all():
            return middle
        over = smaller(diagonal, off, middle) > below
        highs, lows = np.where(over, middle, highs), np.where(over, lows, middle)


def _solver(diagonal: np.ndarray, off: np.ndarray, value: float, tiny: float):
    """Solves (T - value) y = b by elimination with row exchanges; zero pivots become ``tiny``."""
    d = len(diagonal)
    main, upper, second = (diagonal - value).tolist(), [*off.tolist(), 0.0], [0.0] * d
    lower = off.tolist()
    steps = []
    for at in range(d - 1):
        if abs(main[at]) >= abs(lower[at]):
            factor = lower[at] / (main[at] or tiny)
            steps.append((False, factor))
            main[at + 1] -= factor * upper[at]
        else:
            factor = main[at] / lower[at]
            steps.append((True, factor))
            main[at], upper_here, next_upper = lower[at], upper[at], upper[at + 1]
            upper[at], main[at + 1] = main[at + 1], upper_here - factor * main[at + 1]
            second[at], upper[at + 1] = next_upper, -factor * next_upper
    main = [x if abs(x) > tiny else math.copysign(tiny, x) for x in main]

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.tolist()
        for at, (swapped, factor) in enumerate(steps):
            if swapped:
                y[at], y[at + 1] = y[at + 1], y[at]
            y[at + 1] -= factor * y[at]
        for at in range(d - 1, -1, -1):
            rest = y[at]
            if at + 1 < d:
                rest -= upper[at] * y[at + 1]
            if at + 2 < d:
                rest -= second[at] * y[at + 2]
            y[at] = rest / main[at]
            if abs(y[at]) > 1e250:  # the direction is what counts
                y = [entry * 1e-250 for entry in y]
        return np.array(y)

    return solve


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix for its falling eigenvalues, one a column."""
    d = len(diagonal)
    reach = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    norm = float((np.abs(diagonal) + reach).max()) or 1.0
    found = np.zeros((d, len(values)))
    cluster, shifted = 0, 0.0
    pick = np.random.default_rng(d)
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLOSE * norm:
            cluster = j
        # Equal eigenvalues get shifts of their own, so that their solutions differ.
        shifted = min(float(value), shifted - 10 * EPS * norm) if j > cluster else float(value)
        solve, others = _solver(diagonal, off, shifted, EPS * norm), found[:, cluster:j]
        y = pick.uniform(-1, 1, d)
        settled = 0
        for _ in range(30):
            largest = np.abs(y).max()
            y = solve(y / largest)
            y /= np.abs(y).max()
            for _ in range(2):
                y -= others @ (others.T @ y)
            y /= np.linalg.norm(y)
            residual = diagonal * y - value * y
            residual[:-1] += off * y[1:]
            residual[1:] += off * y[:-1]
            settled = settled + 1 if np.abs(residual).max() <= 50 * EPS * norm * math.sqrt(d) else 0
            if settled == 2:
                break
        found[:, j] = y
    return found


def leading_components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues above working precision, at most ``k``, and their unit vectors, one a column.

    The sign makes the largest entry positive.
    """
    d = len(covariance)
    if not d or not k:
        return np.zeros(0), np.zeros((d, 0))
    diagonal, off, reflections = tridiagonal(covariance)
    values = leading_values(diagonal, off, min(k, d))
    values = values[values > EPS * d * max(float(values[0]), 0.0)]
    vectors = turn_back(vectors_of(diagonal, off, values), reflections)
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[largest, np.arange(len(values))] < 0, -1.0, 1.0)


@dataclass
class Whitening:
    """What a fit leaves: all of it is bounded by the vector length."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float


def _added(parts: DataFrame, kind: type) -> np.ndarray | None:
    """The sum of one array a task: a few tasks add those of all others, and the driver theirs."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(batch.schema.get_field_index("part")):
                own = np.frombuffer(value.as_py(), kind)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    total = None
    for row in parts.repartition("task").mapInArrow(add, "part binary").collect():
        own = np.frombuffer(row.part, kind)
        total = own if total is None else total + own
    return total


def _part(total: np.ndarray) -> pa.RecordBatch:
    from pyspark import TaskContext

    return pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([total.tobytes()], pa.binary())], names=["task", "part"])


PART = "task long, part binary"


def _products(rows: np.ndarray) -> np.ndarray:
    """Exact sums of products of whole numbers, in blocks whose sums doubles hold exactly."""
    largest = float(np.abs(rows).max(initial=0)) ** 2
    if largest > 2**53:
        raise OverflowError("vector entries lie too far apart to sum their products")
    step = max(1, int(2**53 // max(1.0, largest)))
    total = np.zeros((rows.shape[1], rows.shape[1]), np.int64)
    for start in range(0, len(rows), step):
        part = rows[start : start + step].astype(float)
        total += (part.T @ part).astype(np.int64)
    return total


def fit_whitening(df: DataFrame, vector: str, components: int = 16, scale: float = SCALE, offset: int = OFFSET) -> Whitening:
    """Mean and leading components of the distinct vectors of ``df``."""
    rows = df.where(usable(vector)).select(F.col(vector).alias("v"))

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            x = whole(scale * matrix(lists, width), LARGEST) + offset
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary())], names=["x"])

    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    if not width:
        return Whitening(rows.count(), [], np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0)
    distinct = keep(rows.mapInArrow(scaled, "x binary").distinct(), "fit-list")

    def vectors(batch: pa.RecordBatch) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64).reshape(-1, width)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 1, np.int64)
        for batch in batches:
            x = vectors(batch)
            total += np.concatenate([[len(x)], x.sum(axis=0)])
        yield _part(total)

    n, *sums = (int(x) for x in _added(distinct.mapInArrow(count, PART), np.int64))
    centre = np.array([s // n for s in sums], np.int64)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), np.int64)
        for batch in batches:
            total += _products(vectors(batch) - centre)
            if np.abs(np.diag(total)).max() > 2**62:
                raise OverflowError("vector entries lie too far apart to sum their products")
        yield _part(total)

    gram = _added(distinct.mapInArrow(multiply, PART), np.int64).reshape(width, width).tolist()
    if any(gram[i][i] < 0 or gram[i][i] > 2**62 for i in range(width)):
        raise OverflowError("vector entries lie too far apart to sum their products")
    left = [s - n * int(c) for s, c in zip(sums, centre)]  # the fraction of the mean, times n
    exact = [[n * gram[i][j] - left[i] * left[j] for j in range(width)] for i in range(width)]
    covariance = np.array([[e / (n * n) for e in row] for row in exact])
    values, components_ = leading_components(covariance, components)
    trace = sum(exact[i][i] for i in range(width)) / (n * n)
    fitted = Whitening(n, sums, values, components_, values / trace if trace else values, 0.0)
    if not len(values):
        return fitted
    project = _projection(fitted)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        total = np.zeros((k + 1, k))
        for batch in batches:
            z = project(vectors(batch))
            total += np.vstack([z.T @ z, z.sum(axis=0)])
        yield _part(total)

    measured = _added(distinct.mapInArrow(check, PART), np.float64).reshape(-1, len(values)) / n
    identity = measured[:-1] - np.outer(measured[-1], measured[-1]) - np.eye(len(values))
    fitted.identity_error = float(np.abs(identity).max())
    return fitted


def _projection(fitted: Whitening):
    """From whole-number vectors to whitened ones."""
    centre = np.array([s // fitted.n for s in fitted.sums], np.int64)
    rest = np.array([(s - fitted.n * int(c)) / fitted.n for s, c in zip(fitted.sums, centre)])
    weights = fitted.vectors / np.sqrt(fitted.values)
    return lambda x: ((x - centre) - rest) @ weights


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sums over the dimensions of (n * x - S) squared."""
    far = (float(np.abs(x).max(initial=0)) * n + max(map(abs, map(float, sums)), default=0.0)) < 2**62
    if far:
        apart = n * x - np.array(sums, np.int64)
        if float(np.abs(apart).max(initial=0)) ** 2 * max(1, x.shape[1]) < 2**62:
            return (apart * apart).sum(axis=1).tolist()
    return [sum((n * e - s) ** 2 for e, s in zip(row, sums)) for row in x.tolist()]


def whiten(df: DataFrame, fitted: Whitening, vector: str, scale: float = SCALE, offset: int = OFFSET) -> DataFrame:
    """The rows of ``df`` that take part, without the vector, and a struct column ``white``: ``deviation`` (a whole number of up to
    38 digits) and ``whitened``, an array with one entry a component."""
    others = [c for c in df.columns if c != vector]
    width = len(fitted.sums)
    name = unused(others, "white")
    sent = df.sparkSession.sparkContext.broadcast(fitted)
    kind = StructType().add("deviation", DecimalType(38, 0)).add("whitened", ArrayType(DoubleType()))
    rows = df.where(usable(vector)).select(*(F.col(f"`{c}`") for c in others), F.col(f"`{vector}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        project = _projection(own) if len(own.values) else None
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            x = whole(scale * matrix(lists, width), LARGEST) + offset
            z = project(x) if project else np.zeros((len(x), 0))
            flat = pa.array(z.ravel(), pa.float64())
            arrays = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * z.shape[1], pa.int32()), flat)
            numbers = pa.array(map(Decimal, _deviations(x, own.n, own.sums)), pa.decimal128(38, 0))
            made = pa.StructArray.from_arrays([numbers, arrays], names=["deviation", "whitened"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=[*others, name])

    schema = rows.select(*(F.col(f"`{c}`") for c in others)).schema.add(name, kind)
    return rows.mapInArrow(run, schema)
