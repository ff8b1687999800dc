"""Operations on wide numeric frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cleaning import parse_number

INF = float("inf")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def finite_or_zero(x: Column) -> Column:
    """NaN sorts above every number, so one comparison finds it, infinities and nulls."""
    return F.when(F.abs(x) < INF, x).otherwise(0.0)


def sanitize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as finite doubles: what is no number, null or infinite becomes 0."""
    return df.withColumns({c: finite_or_zero(parse_number(df, c)) for c in columns})


def audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: type, rows, nulls and infinite values, from one aggregate."""
    types = dict(df.dtypes)
    sums = [F.count("*").alias("n_rows")]
    for i, c in enumerate(columns):
        x = F.col(c).try_cast("double")
        sums += [
            F.count_if(F.col(c).isNull()).alias(f"null{i}"),
            F.count_if(F.abs(x) == INF).alias(f"inf{i}"),
        ]
    parts = ", ".join(
        f"'{c}', '{types[c]}', null{i}, inf{i}" for i, c in enumerate(columns)
    )
    return df.agg(*sums).selectExpr(
        "n_rows", f"stack({len(columns)}, {parts}) AS (feature, dtype, n_null, n_inf)"
    )


def dtype_histogram(df: DataFrame) -> dict[str, int]:
    kinds = [t for _, t in df.dtypes]
    return {t: kinds.count(t) for t in sorted(set(kinds))}


def align(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the features, in order; absent ones are 0, extra ones go."""
    have = set(df.columns)
    return df.select(
        *keep, *[F.col(f"`{c}`") if c in have else F.lit(0.0).alias(c) for c in features]
    )


def combine(blocks: Sequence[DataFrame], key: str = "book_id", how: str = "left") -> DataFrame:
    """Feature blocks side by side. ``left`` keeps all rows of the first block with 0 for
    absent ones; ``inner`` keeps the keys every block has."""
    joined = reduce(lambda a, b: a.join(b, key, how), blocks)
    return joined.fillna(0, subset=numeric_columns(joined, exclude=[key]))


def numeric_projection(
    df: DataFrame, target: str = "average_rating", key: str = "book_id"
) -> DataFrame:
    names = numeric_columns(df, exclude=[target, key])
    return df.select(key, *names).fillna(0, subset=names)


def select_by_name(df: DataFrame, key: str = "book_id") -> DataFrame:
    """Columns whose name marks them as a score, flag, quality or complexity."""
    chosen = [
        c
        for c in df.columns
        if c.endswith("_score")
        or c.removeprefix("fmt_").startswith("is_")
        or "quality" in c
        or "complexity" in c
    ]
    numbers = [F.coalesce(parse_number(df, c), F.lit(0.0)).alias(c) for c in chosen]
    return df.select(key, *numbers)
