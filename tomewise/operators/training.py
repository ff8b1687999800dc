"""Regressors of Spark ML and of ``trees``, chosen by name and fitted on one assembled matrix."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .distribution import PowerTransform, fit_power_transform
from .evaluation import assign_folds, regression_metrics
from .fold_statistics import LINEAR, cross_validate_linear, fold_statistics, summary
from .trees import ExtraTrees, Growth, RandomForest, SecondOrderBoosting, TreeEnsemble

LABEL = "average_rating"
log = logging.getLogger(__name__)

# Model sizes and penalties of the published configurations.
PRESETS: dict[str, tuple[str, dict]] = {
    "xgboost": ("xgboost", {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 10,
                            "subsample": 0.85, "colsample": 0.85, "alpha": 0.1, "l2": 1.0}),
    "gradient_boosting": ("gradient_boosting", {"n_estimators": 100, "learning_rate": 0.1,
                                                "max_depth": 6}),
    "random_forest": ("random_forest", {"n_estimators": 100, "max_depth": 10}),
    "optimized_rf": ("random_forest", {"n_estimators": 300, "max_depth": 20, "min_leaf": 2,
                                       "max_features": "0.8"}),
    "extra_trees": ("extra_trees", {"n_estimators": 200, "max_depth": 20, "min_split": 5}),
    "elastic_net": ("elastic_net", {"alpha": 0.1, "l1_ratio": 0.5}),
    "ridge": ("ridge", {"alpha": 1.0}),
    "linear": ("linear", {}),
}


def label_scale(train: DataFrame, label: str = LABEL) -> tuple[int, float]:
    """Rows and population deviation of the label, which penalties depend on."""
    row = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return row.n, row.s or 1.0


def regressor(
    kind: str,
    scale: tuple[int, float] = (1, 1.0),
    label: str = LABEL,
    seed: int = 42,
    **p,
) -> Estimator | ExtraTrees | RandomForest | SecondOrderBoosting:
    """A regressor for a model name: Spark ML's, or an ensemble of ``trees`` where Spark ML has none, or
    (forests) makes dense sums of all features for the smallest node in every task.

    Penalties are stated as usual for least squares: ridge on the sum of squared errors,
    elastic net on half their mean. Spark works on the label divided by its deviation, which
    scales the squared part of the penalty only; ``scale`` from ``label_scale`` undoes that.
    """
    common = {"featuresCol": "features", "labelCol": label}
    if kind == "xgboost":
        growth = Growth(
            random=False,
            trees=p.get("n_estimators", 100),
            max_depth=p.get("max_depth", 6),
            alpha=p.get("alpha", 0.0),
            l2=p.get("l2", 1.0),
            columns=p.get("colsample", 1.0),
            rows=p.get("subsample", 1.0),
            seed=seed,
        )
        return SecondOrderBoosting(growth, p.get("learning_rate", 0.3), label)
    if kind == "extra_trees":
        growth = Growth(
            random=True,
            trees=p.get("n_estimators", 100),
            max_depth=p.get("max_depth", 20),
            min_split=p.get("min_split", 2),
            min_leaf=p.get("min_leaf", 1),
            seed=seed,
        )
        return ExtraTrees(growth, label)
    if kind == "gradient_boosting":
        return GBTRegressor(
            **common,
            seed=seed,
            maxIter=p.get("n_estimators", 100),
            stepSize=p.get("learning_rate", 0.1),
            maxDepth=p.get("max_depth", 3),
            subsamplingRate=p.get("subsample", 1.0),
            featureSubsetStrategy=p.get("colsample", "all"),
        )
    if kind == "random_forest":
        growth = Growth(
            random=False,
            trees=p.get("n_estimators", 100),
            max_depth=p.get("max_depth", 20),
            min_leaf=p.get("min_leaf", 1),
            bootstrap=True,
            node_features=p.get("max_features", "all"),
            seed=seed,
        )
        return RandomForest(growth, label)
    n_rows, deviation = scale
    if kind == "linear":
        return LinearRegression(**common)
    if kind == "ridge":
        absolute, squared = 0.0, p.get("alpha", 1.0) / max(n_rows, 1)
    elif kind == "elastic_net":
        alpha, share = p.get("alpha", 0.1), p.get("l1_ratio", 0.5)
        absolute, squared = alpha * share, alpha * (1 - share)
    else:
        raise ValueError(f"Unknown model type: {kind}")
    total = absolute + squared * deviation
    return LinearRegression(
        **common,
        regParam=total,
        elasticNetParam=absolute / total if total else 0.0,
        standardization=False,
    )


def preset(name: str, train: DataFrame | None = None, seed: int = 42) -> Estimator:
    """The estimator of a published configuration, at its full size."""
    kind, params = PRESETS[name]
    penalised = kind in ("ridge", "elastic_net")
    scale = label_scale(train) if penalised and train is not None else (1, 1.0)
    return regressor(kind, scale, seed=seed, **params)


def save_model(spark: SparkSession, model: Model | TreeEnsemble, path: str) -> None:
    own = isinstance(model, TreeEnsemble)
    spark.createDataFrame([(own,)], "ensemble boolean").write.mode("overwrite").parquet(f"{path}/kind")
    if own:
        model.save(spark, path)
    else:
        PipelineModel([model]).write().overwrite().save(f"{path}/pipeline")


def load_model(spark: SparkSession, path: str) -> Model | TreeEnsemble:
    if spark.read.parquet(f"{path}/kind").first().ensemble:
        return TreeEnsemble.load(spark, path)
    return PipelineModel.load(f"{path}/pipeline").stages[0]


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(keep..., features) with one vector per row."""
    out = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    return out.select(*keep, "features")


@dataclass
class Trained:
    name: str
    model: Model | TreeEnsemble
    predictions: DataFrame
    metrics: dict[str, float]


def evaluate(name: str, estimator: Estimator, train: DataFrame, test: DataFrame) -> Trained:
    model = estimator.fit(train)
    predictions = model.transform(test)
    metrics = regression_metrics(predictions, LABEL).first().asDict()
    return Trained(name, model, predictions, metrics)


def compare(models: Mapping[str, Estimator], train: DataFrame, test: DataFrame) -> list[Trained]:
    """Every model fitted and evaluated; one whose parameters or columns do not suit the data is
    logged and left out. Other failures, such as a lost cluster, are raised."""
    done = []
    for name, estimator in models.items():
        try:
            done.append(evaluate(name, estimator, train, test))
        except (IllegalArgumentException, AnalysisException, ValueError):
            log.exception("model %s failed", name)
    return done


def best(results: Sequence[Trained]) -> Trained:
    if not results:
        raise ValueError("no model could be trained")
    return max(results, key=lambda t: t.metrics["r2"])  # the first among equals


def results_frame(spark: SparkSession, results: Sequence[Trained]) -> DataFrame:
    rows = [
        (i, t.name, t.metrics["n_rows"], t.metrics["rmse"], t.metrics["mae"], t.metrics["r2"])
        for i, t in enumerate(results)
    ]
    return spark.createDataFrame(
        rows, "position int, model string, n_rows long, rmse double, mae double, r2 double"
    )


def feature_importance(
    spark: SparkSession, model: Model, features: Sequence[str]
) -> DataFrame:
    """(position, feature, importance), highest first; one row per feature."""
    values = model.featureImportances.toArray()
    rows = [(i, f, float(values[i])) for i, f in enumerate(features)]
    frame = spark.createDataFrame(rows, "position int, feature string, importance double")
    return frame.orderBy(F.desc("importance"), "position")


def cross_validate(
    estimator: Estimator, train: DataFrame, k: int = 5, key: str = "book_id"
) -> DataFrame:
    """One row: sqrt of the mean, and sqrt of the deviation, of the folds' squared errors."""
    folded = assign_folds(train, k, key)
    errors = []
    for fold in range(k):
        model = estimator.fit(folded.where(F.col("fold") != fold))
        held = model.transform(folded.where(F.col("fold") == fold))
        errors.append(regression_metrics(held, LABEL).select(F.lit(fold).alias("fold"), "rmse"))
    per_fold = errors[0]
    for e in errors[1:]:
        per_fold = per_fold.union(e)
    mse = F.col("rmse") * F.col("rmse")
    return per_fold.agg(
        F.count("*").alias("folds"),
        F.sqrt(F.avg(mse)).alias("cv_rmse_mean"),
        F.sqrt(F.stddev_pop(mse)).alias("cv_rmse_std"),
    )


def cross_validate_preset(name: str, train: DataFrame, k: int = 5, key: str = "book_id") -> DataFrame:
    """One row as ``cross_validate`` gives; linear models take one scan for all folds."""
    kind, params = PRESETS[name]
    if kind not in LINEAR:
        return cross_validate(preset(name, train), train, k, key)
    statistics = fold_statistics(train, LABEL, k, key)
    return summary(cross_validate_linear(train.sparkSession, statistics, {name: (kind, params)})).drop("model")


def evaluate_on_transformed_target(
    name: str, kind: str, train: DataFrame, test: DataFrame, **params
) -> tuple[Trained, PowerTransform]:
    """Fit on the power-transformed target and evaluate on the original scale. The transform
    is fitted on the training rows only."""
    power = fit_power_transform(train, LABEL)
    shaped = train.withColumn("target", power.forward(F.col(LABEL)))
    scale = label_scale(shaped, "target")
    model = regressor(kind, scale, label="target", **params).fit(shaped)
    back = model.transform(test).withColumn("prediction", power.inverse(F.col("prediction")))
    metrics = regression_metrics(back, LABEL).first().asDict()
    return Trained(name, model, back, metrics), power
