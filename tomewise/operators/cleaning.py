"""Cleaning, imputing and row filters.

Dataset-wide statistics are fitted first (a few numbers on the driver) and then enter the
row expressions as literals: no join, no unpartitioned window, and the fitted object
works on streams and on later batches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lexicons as lx
from ..functions.text import text
from .quantiles import exact_quantiles, median

NUMERIC_INPUTS = ("average_rating", "num_pages", "ratings_count", "text_reviews_count")
DATE_FORMATS = ("MM/dd/yyyy", "M/d/yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d MMM yyyy", "yyyyMMdd")


# ------------------------------------------------------------------------ filters
def category_filter(
    df: DataFrame, pattern: str = lx.CATEGORY_PATTERN
) -> DataFrame:
    """Keep rows whose shelves (else genres, else title or description) name the category."""
    for name in ("popular_shelves", "genres"):
        if name in df.columns:
            return df.where(F.coalesce(F.lower(_as_text(df, name)).rlike(pattern), F.lit(False)))
    return df.where(
        F.lower(text("title")).rlike(pattern) | F.lower(text("description")).rlike(pattern)
    )


def _as_text(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name)
    return F.to_json(name)


def quality_filter(
    df: DataFrame,
    low: float = 2.0,
    high: float = 5.0,
    min_ratings: int = 15,
    longer_than: int = 30,
) -> DataFrame:
    """Rated inside [low, high], rated often enough, described; null descriptions drop."""
    return df.where(
        F.col("average_rating").between(low, high)
        & (F.col("ratings_count") >= min_ratings)
        & (F.length("description") > longer_than)
    )


def in_rating_range(low: float = 1.0, high: float = 5.0) -> Column:
    return F.col("average_rating").between(low, high)


def rating_range_filter(df: DataFrame, low: float = 1.0, high: float = 5.0) -> DataFrame:
    return df.where(in_rating_range(low, high))


def rating_range_counts(df: DataFrame, low: float = 1.0, high: float = 5.0) -> DataFrame:
    return df.agg(
        F.count("*").alias("rows_before"),
        F.count_if(in_rating_range(low, high)).alias("rows_after"),
    )


def iqr_bounds(df: DataFrame, column: str = "average_rating") -> tuple[float, float] | None:
    found = exact_quantiles(df, {column: [0.25, 0.75]})[column]
    if found is None:
        return None
    q1, q3 = found
    return q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)


def iqr_filter(df: DataFrame, column: str = "average_rating") -> DataFrame:
    bounds = iqr_bounds(df, column)
    return df.where(F.col(column).between(*bounds)) if bounds else df.limit(0)


def has_min_rows(df: DataFrame, n: int = lx.MIN_TRAINING_ROWS) -> DataFrame:
    """One row: were there n rows? Stops reading after n."""
    return df.limit(n).agg((F.count("*") >= n).alias("enough"))


def require_min_rows(df: DataFrame, n: int = lx.MIN_TRAINING_ROWS) -> DataFrame:
    if not has_min_rows(df, n).first().enough:
        raise ValueError(f"training needs at least {n} rows")
    return df


# ----------------------------------------------------------------------- columns
def ensure_columns(
    df: DataFrame, defaults: Mapping[str, tuple[str, object]] = lx.REQUIRED_COLUMNS
) -> DataFrame:
    missing = {c: F.lit(v).cast(t) for c, (t, v) in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def parse_number(df: DataFrame, name: str) -> Column:
    """Number in a column, null where there is none."""
    if isinstance(df.schema[name].dataType, T.StringType):
        low = F.lower(name)
        return F.when(low.rlike(lx.PLAIN_NUMBER), F.trim(low).try_cast("double"))
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def coerce_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_INPUTS) -> DataFrame:
    return df.withColumns({c: parse_number(df, c) for c in columns})


def year_of(column: str) -> Column:
    parsed = [F.try_to_timestamp(F.col(column), F.lit(f)) for f in DATE_FORMATS]
    stamp = F.coalesce(F.col(column).try_cast("timestamp"), *parsed)
    # textual stamps that end in the year, such as "Tue Nov 17 11:37:35 -0800 2015"
    trailing = F.regexp_extract(column, r"^\w{3} \w{3} \d{1,2} [\d:]{8} [+-]\d{4} (\d{4})$", 1)
    return F.coalesce(F.year(stamp), trailing.try_cast("int"))


def text_lengths(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "title_length": F.length(text("title")),
            "description_length": F.length(text("description")),
        }
    )


# --------------------------------------------------------------- fit / transform
@dataclass(frozen=True)
class Cleaning:
    """Fitted numbers of the cleaning step."""

    median_pages: float
    date_column: str | None
    max_year: int
    keep_year: bool = True

    def year(self, columns: Sequence[str]) -> Column:
        """The year of the date column that training used, else the year a row states."""
        given = [year_of(self.date_column)] if self.date_column in columns else []
        if self.keep_year and "publication_year" in columns:
            given.append(F.col("publication_year").cast("int"))
        return F.coalesce(*given, F.lit(lx.DEFAULT_YEAR))

    def transform(self, df: DataFrame) -> DataFrame:
        clean = coerce_numeric(ensure_columns(df))
        clean = text_lengths(
            clean.withColumns(
                {
                    "num_pages": F.coalesce("num_pages", F.lit(self.median_pages)),
                    "ratings_count": F.coalesce("ratings_count", F.lit(0.0)),
                    "text_reviews_count": F.coalesce("text_reviews_count", F.lit(0.0)),
                    "publication_year": self.year(clean.columns),
                }
            )
        )
        return clean.withColumn("rating_density", self.rating_density())

    def to_frame(self, spark: SparkSession) -> DataFrame:
        row = (self.median_pages, self.date_column, self.max_year, self.keep_year)
        return spark.createDataFrame(
            [row], "median_pages double, date_column string, max_year int, keep_year boolean"
        )

    @classmethod
    def from_frame(cls, frame: DataFrame) -> Cleaning:
        return cls(*frame.select("median_pages", "date_column", "max_year", "keep_year").first())

    def rating_density(self) -> Column:
        years = F.lit(self.max_year) - F.col("publication_year") + 1
        return F.col("ratings_count") / F.greatest(years, F.lit(1))


def fit_cleaning(df: DataFrame, year_mode: str = "keep") -> Cleaning:
    """Median pages, the date column the dataset uses and its last year.

    ``year_mode='keep'`` keeps an existing publication year of rows whose date column has no
    value, in training and in scoring; ``'reference'`` sets the default year then, as the
    original rule does.
    """
    full = coerce_numeric(ensure_columns(df))
    keep = year_mode == "keep"
    has_year = "publication_year" in df.columns and keep
    stated = F.col("publication_year").cast("int") if has_year else F.lit(None).cast("int")
    default = F.lit(lx.DEFAULT_YEAR)
    facts = full.agg(
        F.count("publication_date").alias("n_first"),
        F.count("publish_date").alias("n_second"),
        F.max(F.coalesce(year_of("publication_date"), stated, default)).alias("first"),
        F.max(F.coalesce(year_of("publish_date"), stated, default)).alias("second"),
        F.max(F.coalesce(stated, default)).alias("stated"),
    ).first()
    pages = median(full, "num_pages")
    pages = lx.DEFAULT_PAGES if pages is None else pages
    if facts.n_first:
        return Cleaning(pages, "publication_date", facts.first, keep)
    if facts.n_second:
        return Cleaning(pages, "publish_date", facts.second, keep)
    last = facts.stated if has_year and facts.stated is not None else lx.DEFAULT_YEAR
    return Cleaning(pages, None, last, keep)


def preprocess(df: DataFrame, year_mode: str = "keep") -> DataFrame:
    return fit_cleaning(df, year_mode).transform(df)
