"""Cross-validation of linear models from the sufficient statistics of each fold.

One pass over the rows sums, for each fold, the products of every two of (1, features, label). The
model of a fold is fitted on the total less that fold, and its error on the fold follows from the fold's
own products, so neither the number of folds nor that of models costs another scan.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .evaluation import assign_folds
from .text_vectors import list_arrays, matrix_of, sum_arrays

LINEAR = ("linear", "ridge", "elastic_net")
MAX_FEATURES = 4096  # bounds what the driver holds: folds x (features + 2) squared numbers


@dataclass(frozen=True)
class FoldStatistics:
    """Per fold the products of (1, features - centre, label - centre), summed over its rows."""

    products: np.ndarray  # (folds, features + 2, features + 2)
    centre: np.ndarray  # what was taken off every feature and the label

    def fit(self, fold: int | None, alpha: float, l1_ratio: float, per_row: bool) -> tuple[float, np.ndarray]:
        """(intercept, coefficients), both of centred columns, fitted without one fold.

        The penalty is alpha * (l1_ratio * |w| + (1 - l1_ratio) / 2 * w ** 2) on half the mean
        squared error; with ``per_row`` False it is alpha * w ** 2 on the sum of squared errors.
        """
        total = self.products.sum(axis=0)
        if fold is not None:
            total = total - self.products[fold]
        n = total[0, 0]
        if n <= 0:
            raise ValueError("no rows to fit on outside the fold")
        mean = total[0, 1:] / n
        spread = total[1:, 1:] / n - np.outer(mean, mean)
        gram, cross = spread[:-1, :-1], spread[:-1, -1]
        absolute = alpha * l1_ratio if per_row else 0.0
        squared = alpha * (1 - l1_ratio) if per_row else alpha / n
        if absolute:
            w = coordinate_descent(gram, cross, absolute, squared)
        else:
            # least squares takes the shortest solution where columns depend on each other
            w = np.linalg.lstsq(gram + squared * np.eye(len(gram)), cross, rcond=1e-13)[0]
        return float(mean[-1] - mean[:-1] @ w), w

    def error(self, fold: int, intercept: float, w: np.ndarray) -> tuple[int, float]:
        """Rows of a fold and the sum of their squared errors."""
        turned = np.concatenate([[-intercept], -w, [1.0]])
        own = self.products[fold]
        return round(own[0, 0]), max(float(turned @ own @ turned), 0.0)


def fold_statistics(
    train: DataFrame, label: str, k: int = 5, key: str = "book_id", features: str = "features"
) -> FoldStatistics:
    """Statistics of k folds of a (key, features vector, label) frame. Rows without a label, or with a
    feature that is not finite, are in no fold's sums. A column's values are taken relative to the first
    row's, which keeps the sums of columns far from zero accurate."""
    x = vector_to_array(features)
    finite = F.forall(x, lambda v: ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = train.where(F.col(label).isNotNull() & F.col(features).isNotNull()).where(finite)
    first = sound.select(x.alias("x"), F.col(label).cast("double").alias("y")).first()
    if first is None:
        raise ValueError("no rows to validate on")
    centre = np.array([*first.x, first.y])
    if len(first.x) > MAX_FEATURES:
        raise ValueError(f"{len(first.x)} features are more than {MAX_FEATURES}")

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, len(centre) + 1, len(centre) + 1))
        for batch in batches:
            if batch.num_rows:
                rows = np.hstack([np.ones((batch.num_rows, 1)), matrix_of(batch, "row") - centre])
                folds = batch.column("fold").to_numpy(zero_copy_only=False)
                for fold in np.unique(folds):
                    mine = rows[folds == fold]
                    sums[fold] += mine.T @ mine
        for fold in np.flatnonzero(sums[:, 0, 0]):
            n = len(sums[fold])
            yield pa.RecordBatch.from_arrays(
                [pa.array([fold] * n, pa.int32()), pa.array(range(n), pa.int32()), list_arrays(sums[fold])],
                names=["fold", "i", "v"],
            )

    folded = assign_folds(sound, k, key).select(
        F.col("fold").cast("int").alias("fold"), F.concat(x, F.array(F.col(label).cast("double"))).alias("row")
    )
    parts = folded.mapInArrow(products, "fold int, i int, v array<double>")
    out = np.zeros((k, len(centre) + 1, len(centre) + 1))
    for r in sum_arrays(parts, ["fold", "i"]).toLocalIterator():
        out[r.fold, r.i] = r.v
    return FoldStatistics(out, centre)


def coordinate_descent(
    gram: np.ndarray, cross: np.ndarray, absolute: float, squared: float, tolerance: float = 1e-12
) -> np.ndarray:
    """Coefficients of least w'Gw / 2 - w'c + absolute * |w| + squared / 2 * w ** 2."""
    w, pull = np.zeros(len(cross)), cross.copy()  # pull = cross - gram @ w
    scale = max(float(np.abs(cross).max(initial=0.0)), 1e-300)
    for _ in range(100_000):
        moved = 0.0
        for j in np.flatnonzero(np.diag(gram) > 0):
            at = pull[j] + gram[j, j] * w[j]
            new = np.sign(at) * max(abs(at) - absolute, 0.0) / (gram[j, j] + squared)
            if new != w[j]:
                pull -= gram[j] * (new - w[j])
                moved = max(moved, abs(new - w[j]) * gram[j, j])
                w[j] = new
        if moved <= tolerance * scale:
            break
    return w


def cross_validate_linear(
    spark: SparkSession, statistics: FoldStatistics, models: Mapping[str, tuple[str, Mapping]]
) -> DataFrame:
    """(model, fold, n_rows, rmse): held-out errors of linear models named like the presets,
    ``linear``, ``ridge`` or ``elastic_net``. A fold without rows has no row."""
    rows = []
    for name, (kind, p) in models.items():
        alpha, l1_ratio, per_row = _penalty(kind, p)
        for fold in np.flatnonzero(statistics.products[:, 0, 0]):
            n, sse = statistics.error(fold, *statistics.fit(fold, alpha, l1_ratio, per_row))
            rows.append((name, int(fold), n, float(np.sqrt(sse / n))))
    return spark.createDataFrame(rows, "model string, fold int, n_rows long, rmse double")


def _penalty(kind: str, p: Mapping) -> tuple[float, float, bool]:
    if kind == "linear":
        return 0.0, 0.0, False
    if kind == "ridge":
        return p.get("alpha", 1.0), 0.0, False
    if kind == "elastic_net":
        return p.get("alpha", 0.1), p.get("l1_ratio", 0.5), True
    raise ValueError(f"Not a linear model: {kind}")


def summary(errors: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Folds, and sqrt of the mean and of the deviation of their squared errors."""
    mse = F.col("rmse") * F.col("rmse")
    return errors.groupBy(*by).agg(
        F.count("*").alias("folds"),
        F.sqrt(F.avg(mse)).alias("cv_rmse_mean"),
        F.sqrt(F.stddev_pop(mse)).alias("cv_rmse_std"),
    )
