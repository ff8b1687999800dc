"""Splits, folds, regression metrics, champions, importances, ablations and verdicts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from .quantiles import values_at_ranks

HASH_FACTOR, HASH_SHIFT, HASH_MODULUS = 48271, 16807, 2147483647


# ------------------------------------------------------------------ splits, folds
def split_bucket(key: str = "book_id", seed: int = 42) -> Column:
    """0..99 from the row key alone, so repartitioning cannot move a row across the split."""
    mixed = F.pmod(F.col(key), F.lit(HASH_MODULUS)) * HASH_FACTOR + seed * HASH_SHIFT
    return F.pmod(F.pmod(mixed, F.lit(HASH_MODULUS)), F.lit(100))


def is_test(test_share: float = 0.2, key: str = "book_id", seed: int = 42) -> Column:
    """Whole percents only; a share that none of the buckets can stand for is refused."""
    if not 1 <= round(100 * test_share) <= 99:
        raise ValueError(f"test_share must be between 0.01 and 0.99, not {test_share}")
    return split_bucket(key, seed) < round(100 * test_share)


def train_test_split(
    df: DataFrame, test_share: float = 0.2, key: str = "book_id", seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    test = is_test(test_share, key, seed)
    return df.where(~test), df.where(test)


def assign_folds(df: DataFrame, k: int = 5, key: str = "book_id") -> DataFrame:
    """Adds ``fold``: k runs of neighbouring keys whose sizes differ by at most one.

    Only the keys at the fold edges are looked up; rows then compare themselves with those.
    """
    n = df.count()
    edges, start = [], 0
    for i in range(k - 1):
        start += n // k + (1 if i < n % k else 0)
        edges.append(start)
    found = values_at_ranks(df.select(key), key, [e for e in edges if e < n]) if n else {}
    fold = sum(((F.col(key) >= v).cast("int") for v in found.values()), F.lit(0))
    return df.withColumn("fold", fold)


# ------------------------------------------------------------------------ metrics
def regression_metrics(
    predictions: DataFrame, label: str = "average_rating", prediction: str = "prediction"
) -> DataFrame:
    """RMSE, MAE and R2 as one row, from one aggregate."""
    error = F.col(label) - F.col(prediction)
    row = predictions.agg(
        F.count("*").alias("n_rows"),
        F.sum(error * error).alias("sse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(label).alias("var"),
    )
    spread = F.col("var") * F.col("n_rows")
    return row.select(
        "n_rows",
        F.sqrt(F.try_divide("sse", "n_rows")).alias("rmse"),
        "mae",
        (1 - F.try_divide(F.col("sse"), spread)).alias("r2"),
    )


def prediction_range_check(
    predictions: DataFrame, prediction: str = "prediction", bounds=lx.PREDICTION_RANGE
) -> DataFrame:
    inside = F.coalesce(F.col(prediction).between(*bounds), F.lit(False))
    return predictions.agg(
        F.count("*").alias("n_rows"),
        F.count_if(~inside).alias("n_outside"),
        F.coalesce(F.bool_and(inside), F.lit(True)).alias("all_inside"),
    )


# ---------------------------------------------------------------------- champions
def champion(results: DataFrame, score: str = "r2", position: str = "position") -> DataFrame:
    """The row with the highest score, the first in position among equals. Rows without a
    score are models that failed."""
    scored = results.where(F.col(score).isNotNull() & ~F.isnan(score))
    return scored.orderBy(F.desc(score), position).limit(1)


# -------------------------------------------------------------------- importances
def importance_by_group(
    importance: DataFrame, groups: Mapping[str, str] = lx.IMPORTANCE_GROUPS
) -> DataFrame:
    """Share of importance per group of feature names. Groups may overlap; what neither the
    semantic nor the lexicon pattern matches is traditional."""
    name, value = F.col("feature"), F.col("importance")
    masks = {g: name.rlike(f"(?i){p}") for g, p in groups.items()}
    rest = ~(name.rlike(f"(?i){groups['semantic']}") | name.rlike(f"(?i){groups['lexicon']}"))
    masks["traditional"] = rest
    sums = [F.sum(value).alias("total")] + [
        F.coalesce(F.sum(F.when(m, value)), F.lit(0.0)).alias(g) for g, m in masks.items()
    ]
    parts = ", ".join(f"'{g}', `{g}`" for g in masks)
    return (
        importance.agg(*sums)
        .selectExpr("total", f"stack({len(masks)}, {parts}) AS (feature_group, importance)")
        .select(
            "feature_group",
            "importance",
            (F.try_divide("importance", "total") * 100).alias("share_pct"),
        )
    )


# ---------------------------------------------------------------------- ablations
def ablation_deltas(
    results: DataFrame, sets: Sequence[str] = ("traditional", "semantic", "full")
) -> DataFrame:
    """Per model: score on each feature set and the gains from one set to the next."""
    base, middle, full = sets
    wide = results.groupBy("model").pivot("feature_set", list(sets)).agg(F.max("r2"))
    total = F.col(full) - F.col(base)
    return wide.select(
        "model",
        *[F.col(s).alias(f"{s}_r2") for s in sets],
        (F.col(middle) - F.col(base)).alias("semantic_improvement"),
        (F.col(full) - F.col(middle)).alias("lexicon_improvement"),
        total.alias("total_improvement"),
        (F.try_divide(total, F.abs(base)) * 100).alias("total_improvement_pct"),
    )


# ----------------------------------------------------------------------- verdicts
def verdict(score: Column, ladder: str) -> Column:
    steps = lx.VERDICTS[ladder]
    rule = F.when(F.lit(False), F.lit(""))
    for above, label in steps[:-1]:
        rule = rule.when(score > above, F.lit(label))
    return F.when(score.isNotNull(), rule.otherwise(F.lit(steps[-1][1])))


def improvement(score: Column, baseline: float = lx.BASELINE_R2) -> dict[str, Column]:
    gain = score - baseline
    return {"improvement": gain, "improvement_pct": gain / baseline * 100}
