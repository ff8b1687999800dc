"""Whitening of embeddings by the leading eigenvectors of their covariance.

Entries become whole numbers, floor(scale * entry); a constant added to them would cancel in all that
follows, as everything is centred first. Sums, then products of centred entries, are exact: tasks
emit one row for each pair of dimensions, Spark adds them up, and the driver holds width ** 2 numbers
(the width is checked). The eigenvectors come from FEAST contour integration, one task for each slice
of the spectrum (``feast``). Two more passes measure the covariance of what was whitened and give the
result, so nothing of the table's size is collected or written in between.

Rows whose vector is null, or holds null or non-finite entries, are left out, as are vectors of
another width than the most frequent one (of equally frequent widths, the larger). Repeated rows
and rows without an id count like any others. A component whose eigenvalue is not above 1e-11 of the
largest has no direction in double precision and is left out, so a table whose vectors are all
equal has none, and gives an empty result like an empty table. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import feast

COMPONENTS, SCALE = 32, 64
WIDEST = 4096  # dimensions: the driver and a broadcast hold 8 * width ** 2 bytes
LARGEST = 2.0**52  # of an entry after scaling
EXACT = 2**53
PAIRS = "i int, j int, value decimal(38,0)"


@dataclass
class Whitening:
    """What rows are projected by: shift + rest / n is the mean; vectors are columns."""

    n: int
    scale: int
    shift: list[int]
    rest: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    def centred(self, whole: np.ndarray) -> np.ndarray:
        return (whole - np.array(self.shift, np.int64)).astype(float) - np.array(self.rest, float) / self.n

    def whiten(self, whole: np.ndarray) -> np.ndarray:
        return self.centred(whole) @ self.vectors / np.sqrt(self.values)

    def deviations(self, whole: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n * entry - total) ** 2, exact."""
        z = whole - np.array(self.shift, np.int64)
        small = int(np.abs(z).max(initial=0)) * max(1, int(np.abs(z).max(initial=0)), self.n) * z.shape[1] < 1 << 62
        z, rest = (z if small else z.astype(object)), np.array(self.rest, np.int64 if small else object)
        own, cross = (z * z).sum(1).tolist(), (z * rest).sum(1).tolist()
        fixed = sum(r * r for r in self.rest)
        return [self.n * self.n * a - 2 * self.n * b + fixed for a, b in zip(own, cross, strict=True)]


def sound(column: str | Column) -> Column:
    """Whether a vector has entries and all of them are finite."""
    vector = F.col(column) if isinstance(column, str) else column
    finite = F.forall(vector, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def _rows(table: DataFrame, key: str, column: str) -> tuple[DataFrame, int]:
    """Rows (key, vector) of the usual width, and that width (0 without any)."""
    rows = table.select(F.col(key).alias("key"), F.col(column).cast("array<double>").alias("vector")).where(sound(column))
    widths = rows.groupBy(F.size("vector").alias("width")).count()
    usual = widths.orderBy(F.desc("count"), F.desc("width")).first()
    if usual is None:
        return rows, 0
    if usual.width > WIDEST:
        raise ValueError(f"vectors of {usual.width} dimensions; at most {WIDEST} are whitened")
    return rows.where(F.size("vector") == usual.width), usual.width


def _whole(batch: pa.RecordBatch, width: int, scale: int) -> np.ndarray:
    entries = np.floor(scale * batch.column("vector").flatten().to_numpy(zero_copy_only=False))
    if np.abs(entries).max(initial=0) >= LARGEST:
        raise ValueError("an entry is too large for exact sums")
    return entries.astype(np.int64).reshape(-1, width)


def _pairs(i, j, values: list[int]) -> pa.RecordBatch:
    arrays = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values, pa.decimal128(38, 0))]
    return pa.RecordBatch.from_arrays(arrays, ["i", "j", "value"])


def _added(pairs: DataFrame) -> list:
    return pairs.groupBy("i", "j").agg(F.sum("value").cast(pairs.schema["value"].dataType).alias("value")).collect()


def _totals(rows: DataFrame, width: int, scale: int) -> tuple[int, list[int]]:
    """The number of rows and the sum of each dimension."""

    def run(batches):
        n, total = 0, [0] * width
        for batch in batches:
            whole = _whole(batch, width, scale)
            n += len(whole)
            kind = np.int64 if np.abs(whole).max(initial=0) < (1 << 62) // max(1, len(whole)) else object
            total = [a + b for a, b in zip(total, whole.sum(0, dtype=kind).tolist(), strict=True)]
        yield _pairs([-1, *range(width)], [0] * (width + 1), [n, *total])

    sums = {r.i: int(r.value) for r in _added(rows.select("vector").mapInArrow(run, PAIRS))}
    return sums[-1], [sums[i] for i in range(width)]


def _covariance(rows: DataFrame, width: int, scale: int, n: int, total: list[int]) -> tuple[np.ndarray, list[int], list[int]]:
    """The covariance, rounded once; entries are centred by whole numbers before they are multiplied."""
    shift, rest = [s // n for s in total], [s % n for s in total]
    above = np.triu_indices(width)

    def run(batches):
        held = np.zeros((width, width), object)
        for batch in batches:
            z = _whole(batch, width, scale) - np.array(shift, np.int64)
            largest = max(1, int(np.abs(z).max(initial=0)))
            step = EXACT // largest**2
            if step == 0:
                held += z.T.astype(object) @ z.astype(object)
            for start in range(0, len(z) if step else 0, max(1, step)):
                part = z[start : start + step].astype(float)
                held += (part.T @ part).astype(np.int64)
        yield _pairs(*above, held[above].tolist())

    out = np.zeros((width, width))
    for r in _added(rows.select("vector").mapInArrow(run, PAIRS)):
        # centred to the rational mean: n * sum(z z') - rest rest' = n ** 2 * covariance
        out[r.i, r.j] = out[r.j, r.i] = (n * int(r.value) - rest[r.i] * rest[r.j]) / (n * n)
    return out, shift, rest


def leading(rows: DataFrame, a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their vectors (in columns), a task for each slice."""
    spark = rows.sparkSession
    parts = feast.slices(a, wanted)
    if not parts:
        return np.zeros(0), np.zeros((len(a), 0))
    matrix = spark.sparkContext.broadcast(a)

    def run(batches):
        for batch in batches:
            for seed, low, high, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values, vectors = feast.solve(matrix.value, feast.Slice(low, high, count), seed)
                arrays = [pa.array(values), pa.array(list(vectors.T), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["value", "vector"])

    frame = spark.createDataFrame([(i, p.low, p.high, p.count) for i, p in enumerate(parts)], "seed int, low double, high double, count int")
    dealt = frame.repartitionByRange(len(parts), "seed")
    found = dealt.mapInArrow(run, "value double, vector array<double>").collect()
    found.sort(key=lambda r: -r.value)
    if len(found) != sum(p.count for p in parts):
        raise ArithmeticError("the slices do not hold as many eigenvalues as inertia counts say")
    kept = [r for r in found if r.value > 1e-11 * found[0].value][:wanted]
    return np.array([r.value for r in kept]), np.array([r.vector for r in kept]).T


def fit(rows: DataFrame, width: int, components: int = COMPONENTS, scale: int = SCALE) -> Whitening:
    """Learns from all rows (key, vector) of one width."""
    n, total = _totals(rows, width, scale)
    a, shift, rest = _covariance(rows, width, scale, n, total)
    values, vectors = leading(rows, a, components)
    trace = np.trace(a)
    return Whitening(n, scale, shift, rest, values, vectors, values / trace if trace > 0 else values)


def identity_error(rows: DataFrame, learned: Whitening) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, as measured."""
    width, k = len(learned.shift), len(learned.values)
    above = np.triu_indices(k)

    def run(batches):
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = learned.whiten(_whole(batch, width, learned.scale))
            total += w.sum(0)
            products += w.T @ w
        i, j = np.concatenate([[-1] * k, above[0]]), np.concatenate([np.arange(k), above[1]])
        arrays = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.concatenate([total, products[above]]))]
        yield pa.RecordBatch.from_arrays(arrays, ["i", "j", "value"])

    sums = {(r.i, r.j): r.value / learned.n for r in _added(rows.select("vector").mapInArrow(run, "i int, j int, value double"))}
    mean = [sums[-1, j] for j in range(k)]  # not 0 by rounding only
    return max((abs(sums[i, j] - mean[i] * mean[j] - (i == j)) for i, j in zip(*above, strict=True)), default=0.0)


def transform(rows: DataFrame, learned: Whitening) -> DataFrame:
    """key, deviation, whitened (an entry for each component) of every row (key, vector)."""
    width, kind = len(learned.shift), rows.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            whole = _whole(batch, width, learned.scale)
            whitened = learned.whiten(whole)
            ends = np.arange(len(whole) + 1, dtype=np.int32) * whitened.shape[1]
            arrays = [batch.column("key"), pa.array(learned.deviations(whole), pa.decimal128(38, 0)),
                      pa.ListArray.from_arrays(ends, pa.array(whitened.ravel()))]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "deviation", "whitened"])

    return rows.mapInArrow(run, f"key {kind}, deviation decimal(38,0), whitened array<double>")


def whiten(table: DataFrame, key: str, column: str, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """key, component (from 1), n, deviation, whitened, explained, identity_error of every sound row.

    ``deviation`` is null where it does not fit a long.
    """
    rows, width = _rows(table, key, column)
    kind = rows.schema["key"].dataType.simpleString()
    names = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    learned = fit(rows, width, components, scale) if width else None
    if learned is None or not len(learned.values):
        return table.sparkSession.createDataFrame([], names)
    error, shares = identity_error(rows, learned), F.array(*map(F.lit, learned.explained.tolist()))
    long = transform(rows, learned).select("key", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return long.select(
        F.col("key").alias(key),
        (F.col("place") + 1).alias("component"),
        F.lit(learned.n).cast("long").alias("n"),
        F.expr("try_cast(deviation AS long)").alias("deviation"),
        "whitened",
        F.element_at(shares, F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
