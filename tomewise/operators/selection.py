"""Univariate selection of features by their linear relation to the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_K = 50


def _correlation(x: Column, y: Column) -> Column:
    """Null for constant columns, where ``corr`` itself fails under ANSI rules."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def f_scores(df: DataFrame, features: Sequence[str], target: str = "average_rating") -> DataFrame:
    """(position, feature, r, f_score) per feature, from one aggregate. Constant features
    have no correlation and no score."""
    rated = df.where(F.col(target).isNotNull())
    sums = [F.count("*").alias("n")]
    sums += [_correlation(F.col(c).cast("double"), F.col(target)).alias(f"r{i}") for i, c in enumerate(features)]
    parts = ", ".join(f"{i}, '{c}', r{i}" for i, c in enumerate(features))
    long = rated.agg(*sums).selectExpr(
        "n", f"stack({len(features)}, {parts}) AS (position, feature, r)"
    )
    r2 = F.col("r") * F.col("r")
    score = F.try_divide(r2, 1 - r2) * (F.col("n") - 2)
    return long.select("position", "feature", "r", score.alias("f_score"))


def select_k_best(
    df: DataFrame,
    features: Sequence[str],
    target: str = "average_rating",
    k: int = DEFAULT_K,
) -> DataFrame:
    scores = f_scores(df, features, target).where(
        F.col("f_score").isNotNull() & ~F.isnan("f_score")
    )
    return scores.orderBy(F.desc("f_score"), "position").limit(k)
