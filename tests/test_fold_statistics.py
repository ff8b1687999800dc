"""Cross-validation from sufficient statistics against models fitted fold by fold."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from tomewise.operators.fold_statistics import cross_validate_linear, fold_statistics, summary

MODELS = {
    "linear": ("linear", {}),
    "ridge": ("ridge", {"alpha": 2.0}),
    "elastic_net": ("elastic_net", {"alpha": 0.2, "l1_ratio": 0.4}),
}


def frame(spark, x, y):
    rows = [(i, r.tolist(), None if v is None else float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "book_id long, x array<double>, y double").repartition(6)
    return df.select("book_id", array_to_vector("x").alias("features"), "y")


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(203, 6)) * [1, 2, 0.5, 10, 1, 1] + [0, 5, 1e5, 0, 0, 0]
    x[:, 4], x[:, 5] = 3.0, x[:, 0] * 2  # a constant, and a column that depends on another
    return x, x[:, 0] - 0.3 * x[:, 1] + 4 * x[:, 2] + rng.normal(size=203)


def test_errors_equal_models_fitted_fold_by_fold(spark, data):
    x, y = data
    statistics = fold_statistics(frame(spark, x, y), "y")
    got = {(r.model, r.fold): r for r in cross_validate_linear(spark, statistics, MODELS).collect()}
    assert len(got) == 15
    for fold, held in enumerate(np.array_split(np.arange(203), 5)):
        rest = np.setdiff1d(np.arange(203), held)
        mx, my = x[rest].mean(axis=0), y[rest].mean()
        a, b = x[rest] - mx, y[rest] - my
        fits = {
            "linear": np.linalg.lstsq(a, b, rcond=1e-9)[0],
            "ridge": np.linalg.solve(a.T @ a + 2.0 * np.eye(6), a.T @ b),
        }
        for name, w in fits.items():
            rmse = np.sqrt(np.mean((y[held] - my - (x[held] - mx) @ w) ** 2))
            assert got[name, fold].n_rows == len(held)
            assert got[name, fold].rmse == pytest.approx(rmse, rel=1e-6)
        intercept, w = statistics.fit(fold, 0.2, 0.4, True)
        # no direction makes the elastic net's objective smaller
        slope = a.T @ (a @ w - b) / len(rest) + 0.12 * w
        assert np.where(w != 0, np.abs(slope + 0.08 * np.sign(w)), np.maximum(np.abs(slope) - 0.08, 0)) == pytest.approx(
            np.zeros(6), abs=1e-6
        )
        rmse = np.sqrt(np.mean((y[held] - my - (x[held] - mx) @ w) ** 2))
        assert got["elastic_net", fold].rmse == pytest.approx(rmse, rel=1e-6)


def test_summary_and_few_rows(spark, data):
    x, y = data
    few = fold_statistics(frame(spark, x[:3], [1.0, 2.0, 4.0]), "y")
    errors = cross_validate_linear(spark, few, {"ridge": MODELS["ridge"]})
    rows = errors.orderBy("fold").collect()
    assert [(r.fold, r.n_rows) for r in rows] == [(0, 1), (1, 1), (2, 1)]
    mse = np.array([r.rmse for r in rows]) ** 2
    got = summary(errors).first()
    assert (got.folds, got.cv_rmse_mean, got.cv_rmse_std) == pytest.approx((3, mse.mean() ** 0.5, mse.std() ** 0.5))


def test_rows_that_cannot_count_are_left_out(spark, data):
    x, y = data
    odd = np.vstack([x, x[:2]])
    odd[203, 1], odd[204, 0] = np.nan, np.inf
    some = fold_statistics(frame(spark, np.vstack([odd, x[:1]]), [*y, 1.0, 1.0, None]), "y")
    assert some.products[:, 0, 0].sum() == 203
    with pytest.raises(ValueError, match="no rows"):
        fold_statistics(frame(spark, x[:1], [None]), "y")
    with pytest.raises(ValueError, match="Not a linear"):
        cross_validate_linear(spark, some, {"f": ("random_forest", {})})
