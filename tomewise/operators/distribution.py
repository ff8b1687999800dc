"""Transforms that reshape a distribution: quantile transform and Yeo-Johnson."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import inverse_normal, number_array
from ..functions.text import flag
from ..sources.workspace import cut
from .quantiles import exact_quantiles

INF = float("inf")
N_QUANTILES = 1000
BOUND = 1e-7
# Fixed value: normal quantile of BOUND less one float spacing, where outputs are clipped
CLIP = 5.199337582605575


# ------------------------------------------------------------- quantile buckets
def decile_edges(df: DataFrame, column: str = "ratings_count") -> list[float]:
    grid = [i / 10 for i in range(11)]
    found = exact_quantiles(df, {column: grid})[column]
    return sorted(set(found)) if found else []


def decile_bucket(column: str, edges: Sequence[float]) -> Column:
    """Label of the right-closed bucket a value is in; the lowest edge belongs to bucket 0."""
    x = F.col(column)
    label = sum((flag(x > e) for e in edges[1:-1]), F.lit(0))
    inside = x.between(edges[0], edges[-1]) if edges else F.lit(False)
    return F.when(inside, label)


def quantile_flags(df: DataFrame, column: str = "ratings_count") -> dict[str, Column]:
    found = exact_quantiles(df, {column: [0.2, 0.8]})[column] or [None, None]
    return {
        "is_highly_rated_count": flag(F.col(column) > F.lit(found[1]).cast("double")),
        "is_niche_book": flag(F.col(column) < F.lit(found[0]).cast("double")),
    }


# ------------------------------------------------------------ quantile transform
@dataclass(frozen=True)
class QuantileTransform:
    """Distinct grid values per column, with the first and last rank share of each."""

    grids: dict[str, tuple[list[float], list[float], list[float]]]

    def uniform(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """Columns as rank shares in [0, 1]. A value between two grid points is
        interpolated; one equal to a repeated grid point gets the middle of its ranks."""
        out = df
        for c in columns or list(self.grids):
            values, first, last = self.grids[c]
            if len(values) == 1:
                v = values[0]
                out = out.withColumn(
                    c, F.when(F.col(c) > v, 1.0).when(F.col(c) < v, 0.0).otherwise(0.0)
                )
                continue
            place, at = f"{c}__place", F.col(f"{c}__place").cast("int")
            out = Bucketizer(
                inputCol=f"{c}__x", outputCol=place, splits=[-INF, *values, INF]
            ).transform(out.withColumn(f"{c}__x", F.col(c).cast("double")))
            v, lo, hi = (number_array(a) for a in (values, first, last))
            x, left = F.col(f"{c}__x"), F.element_at(v, at)
            step = (x - left) / (F.element_at(v, at + 1) - left)
            rising = F.element_at(hi, at) + step * (F.element_at(lo, at + 1) - F.element_at(hi, at))
            middle = (F.element_at(lo, at) + F.element_at(hi, at)) / 2
            # outside the grid, and at its ends, ranks are exactly 0 and 1
            share = (
                F.when(x <= values[0], 0.0)
                .when(x >= values[-1], 1.0)
                .when(x == left, middle)
                .otherwise(rising)
            )
            out = out.withColumn(c, share).drop(place, f"{c}__x")
        return out

    def normal(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """Columns as standard normal scores, clipped near the ends of the grid."""
        columns = list(columns or self.grids)
        # the normal form also snaps values within BOUND of the ends
        snapped = {
            c: F.when(F.col(c) - BOUND < self.grids[c][0][0], self.grids[c][0][0])
            .when(F.col(c) + BOUND > self.grids[c][0][-1], self.grids[c][0][-1])
            .otherwise(F.col(c))
            for c in columns
            if len(self.grids[c][0]) > 1
        }
        shares = self.uniform(df.withColumns(snapped) if snapped else df, columns)
        return shares.withColumns(
            {
                c: F.when(F.col(c) <= BOUND, -CLIP)
                .when(F.col(c) >= 1 - BOUND, CLIP)
                .otherwise(F.greatest(F.least(inverse_normal(F.col(c)), F.lit(CLIP)), F.lit(-CLIP)))
                for c in columns
            }
        )


def fit_quantile_transform(
    df: DataFrame, columns: Sequence[str], n_quantiles: int = N_QUANTILES
) -> QuantileTransform:
    n = min(n_quantiles, max(df.count(), 1))
    shares = [i / (n - 1) for i in range(n)] if n > 1 else [0.0]
    found = exact_quantiles(df, {c: shares for c in columns})
    return QuantileTransform({c: _grid(found[c] or [0.0], shares) for c in columns})


def _grid(
    values: Sequence[float], shares: Sequence[float]
) -> tuple[list[float], list[float], list[float]]:
    # twelve digits: interpolation noise must not split one repeated value into several
    v = np.maximum.accumulate(np.array([float(f"{x:.12g}") for x in values]))
    distinct, start, count = np.unique(v, return_index=True, return_counts=True)
    share = np.array(shares[: len(v)])
    return (
        distinct.tolist(),
        share[start].tolist(),
        share[start + count - 1].tolist(),
    )


# ------------------------------------------------------------------- Yeo-Johnson
def yeo_johnson(x: Column, lam: Column | float) -> Column:
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    rest = 2 - lam
    up = F.when(F.abs(lam) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1, lam) - 1) / lam)
    down = F.when(F.abs(rest) < 1e-12, F.log1p(-x)).otherwise((F.pow(1 - x, rest) - 1) / rest)
    return F.when(x >= 0, up).otherwise(-down)


def yeo_johnson_inverse(z: Column, lam: float) -> Column:
    up = F.expm1(z) if abs(lam) < 1e-12 else F.pow(z * lam + 1, F.lit(1 / lam)) - 1
    if abs(lam - 2) < 1e-12:
        down = -F.expm1(-z)
    else:
        down = 1 - F.pow(1 - z * (2 - lam), F.lit(1 / (2 - lam)))
    return F.when(z >= 0, up).otherwise(down)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(x, n): every distinct value once, written, so that a search reads the rows once only."""
    x = F.col(column).cast("double")
    counts = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x")).groupBy("x")
    return cut(counts.agg(F.count("*").alias("n")), "values")


def log_likelihoods(df: DataFrame, column: str, lambdas: Sequence[float]) -> DataFrame:
    """(lambda, log_likelihood) of every candidate; null where the values do not vary."""
    counts = value_counts(df, column)
    return likelihood_slopes(counts, mean_of(counts), lambdas).select("lambda", "log_likelihood")


def mean_of(counts: DataFrame) -> float | None:
    return counts.agg(F.sum(F.col("x") * F.col("n")) / F.sum("n")).first()[0]


def likelihood_slopes(counts: DataFrame, centre: float | None, lambdas: Sequence[float]) -> DataFrame:
    """(lambda, log_likelihood, slope) of every candidate, all from one pass over counted values.

    Every value meets every candidate inside its task; only one partial sum per candidate leaves
    it. Transformed values are taken relative to that of ``centre``, the mean, which keeps the
    moments of values far from zero accurate.
    """
    n, lam = F.col("n"), F.col("lambda")
    x, at = F.col("x"), F.lit(centre).cast("double")
    z = yeo_johnson(x, lam) - yeo_johnson(at, lam)
    dz = yeo_johnson_slope(x, lam) - yeo_johnson_slope(at, lam)
    pairs = counts.withColumn("lambda", F.explode(number_array(lambdas)))
    sums = pairs.select("lambda", "x", "n", z.alias("z"), dz.alias("dz")).groupBy("lambda").agg(
        F.sum("n").alias("n"),
        F.sum(n * F.col("z")).alias("z"),
        F.sum(n * F.col("dz")).alias("dz"),
        F.sum(n * F.col("z") * F.col("z")).alias("zz"),
        F.sum(n * F.col("z") * F.col("dz")).alias("zdz"),
        F.sum(n * F.signum(x) * F.log1p(F.abs(x))).alias("s"),
        F.count("*").alias("distinct"),
    )
    var = F.col("zz") / n - F.pow(F.col("z") / n, F.lit(2))
    cov = F.col("zdz") / n - F.col("z") * F.col("dz") / (n * n)
    varies = (F.col("distinct") > 1) & (F.col("var") > 0)
    return sums.withColumns({"var": var, "cov": cov}).select(
        "lambda",
        F.when(varies, -n / 2 * F.log("var") + (lam - 1) * F.col("s")).alias("log_likelihood"),
        F.when(varies, F.col("s") - n * F.col("cov") / F.col("var")).alias("slope"),
    )


def yeo_johnson_slope(x: Column, lam: Column) -> Column:
    """Derivative of the transformed value by lambda."""

    def slope(u: Column, power: Column) -> Column:
        z = power * u
        series = u * u * (0.5 + z / 3 + z * z / 8)  # where the quotient would cancel
        exact = (z * F.exp(z) - F.expm1(z)) / (power * power)
        return F.when(F.abs(z) < 1e-4, series).otherwise(exact)

    return F.when(x >= 0, slope(F.log1p(x), lam)).otherwise(slope(F.log1p(-x), 2 - lam))


@dataclass(frozen=True)
class PowerTransform:
    lam: float
    mean: float
    std: float

    def forward(self, x: Column) -> Column:
        return (yeo_johnson(x, self.lam) - self.mean) / (self.std or 1.0)

    def inverse(self, z: Column) -> Column:
        return yeo_johnson_inverse(z * (self.std or 1.0) + self.mean, self.lam)


def fit_power_transform(
    df: DataFrame, column: str, low: float = -4.0, high: float = 6.0, tolerance: float = 1e-9
) -> PowerTransform:
    """Most likely lambda between ``low`` and ``high``, by the slope of the likelihood.

    The rows are read once, for the counts of their values; every later step reads those. A grid brackets
    the greatest likelihood; each step then tries evenly spaced points and the point where the line
    through both ends' slopes is zero, with a neighbour on either side, and keeps the narrowest
    bracket with a change of sign. Values that do not vary leave lambda at 1.
    """
    counts = value_counts(df, column)
    x, n, centre = F.col("x"), F.col("n"), mean_of(counts)
    if centre is None:
        return PowerTransform(1.0, 0.0, 0.0)
    best = _most_likely(counts, centre, low, high, tolerance)
    start = yeo_johnson(F.lit(centre), best)
    z = yeo_johnson(x, best) - start
    row = counts.agg(
        F.sum(n * z) / F.sum(n), F.sum(n * z * z) / F.sum(n), F.first(start), F.count("*")
    ).first()
    spread = math.sqrt(max(row[1] - row[0] ** 2, 0.0)) if row[3] > 1 else 0.0
    return PowerTransform(best, row[2] + row[0], spread)


def _most_likely(counts: DataFrame, centre: float, low: float, high: float, tolerance: float) -> float:
    rows = sorted(likelihood_slopes(counts, centre, np.linspace(low, high, 21).tolist()).dropna().collect())
    if not rows:
        return 1.0
    top = max(range(len(rows)), key=lambda i: rows[i].log_likelihood)
    left, peak, right = rows[max(top - 1, 0)], rows[top], rows[min(top + 1, len(rows) - 1)]
    while right["lambda"] - left["lambda"] > tolerance and left.slope > 0 > right.slope:
        a, b = left["lambda"], right["lambda"]
        zero = a + (b - a) * left.slope / (left.slope - right.slope)
        tried = {*np.linspace(a, b, 10)[1:-1].tolist(), zero, zero - (b - a) / 1000, zero + (b - a) / 1000}
        inside = [t for t in tried if a < t < b]
        if not inside:
            break
        rows = sorted([left, *likelihood_slopes(counts, centre, inside).dropna().collect(), right])
        rising = max(i for i, r in enumerate(rows[:-1]) if r.slope > 0)
        if (rows[rising]["lambda"], rows[rising + 1]["lambda"]) == (a, b):
            break
        left, right = rows[rising], rows[rising + 1]
    if left.slope > 0 >= right.slope:
        share = left.slope / (left.slope - right.slope)
        return float(left["lambda"] + share * (right["lambda"] - left["lambda"]))
    return float(max((left, peak, right), key=lambda r: r.log_likelihood)["lambda"])
