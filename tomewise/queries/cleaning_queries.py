"""Queries over cleaning, filters and matrix operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions import numeric, text
from ..operators import cleaning, matrix
from ..sources import tables
from . import sql as q
from .common import clean_books
from .registry import KEY, query, rounded

CATEGORY = lx.CATEGORY_PATTERN


@query(
    "category_filter",
    q.over_books(
        f"SELECT book_id, title FROM books WHERE regexp_matches(lower(popular_shelves), '{CATEGORY}')"
    ),
)
def category_filter(spark, sf):
    return cleaning.category_filter(tables.books(spark, sf)).select(KEY, "title")


@query(
    "category_filter_nested",
    q.over_books(
        f"SELECT book_id, title FROM books WHERE regexp_matches(lower(popular_shelves), '{CATEGORY}')"
    ),
)
def category_filter_nested(spark, sf):
    """The same filter where shelves are a list of records."""
    shelf = F.transform(
        F.split("popular_shelves", ","), lambda s: F.struct(F.lit("1").alias("count"), s.alias("name"))
    )
    nested = tables.books(spark, sf).withColumn("popular_shelves", shelf)
    return cleaning.category_filter(nested).select(KEY, "title")


@query(
    "category_filter_fallback",
    q.over_books(
        f"SELECT book_id, title FROM books WHERE regexp_matches(lower(coalesce(title, '')), "
        f"'{CATEGORY}') OR regexp_matches(lower(coalesce(description, '')), '{CATEGORY}')"
    ),
)
def category_filter_fallback(spark, sf):
    plain = tables.books(spark, sf).drop("popular_shelves")
    return cleaning.category_filter(plain).select(KEY, "title")


@query(
    "ensure_columns",
    q.over_books(
        "SELECT book_id, average_rating, CAST(NULL AS DOUBLE) AS num_pages, "
        "CAST(0 AS DOUBLE) AS ratings_count, CAST(0 AS DOUBLE) AS text_reviews_count, title, "
        "'' AS description, publication_date, CAST(NULL AS VARCHAR) AS publish_date FROM books"
    ),
)
def ensure_columns(spark, sf):
    partial = tables.books(spark, sf).select(KEY, "title", "average_rating", "publication_date")
    return cleaning.ensure_columns(partial).select(KEY, *lx.REQUIRED_COLUMNS)


# Numbers as text, some with blanks, exponents or no number at all.
MESSY = {
    "average_rating": "CASE WHEN book_id % 5 = 0 THEN 'n/a' ELSE CAST(book_id % 5 AS VARCHAR(4)) END",
    "num_pages": "CASE WHEN book_id % 4 = 0 THEN '1e2' WHEN book_id % 4 = 1 THEN 'twelve' "
    "ELSE concat(' ', CAST(book_id % 90 AS VARCHAR(4)), ' ') END",
    "ratings_count": "CASE WHEN book_id % 3 = 0 THEN '' ELSE CAST(book_id AS VARCHAR(12)) END",
    "text_reviews_count": "CASE WHEN book_id % 6 = 0 THEN '-3.5' WHEN book_id % 6 = 1 THEN NULL "
    "ELSE '.25' END",
}


@query(
    "coerce_numeric",
    q.over_books(
        "SELECT book_id, "
        + ", ".join(f"TRY_CAST(trim({e}) AS DOUBLE) AS {c}" for c, e in MESSY.items())
        + " FROM books"
    ),
)
def coerce_numeric(spark, sf):
    messy = tables.books(spark, sf).select(KEY, *[F.expr(e).alias(c) for c, e in MESSY.items()])
    return cleaning.coerce_numeric(messy)


@query(
    "median_impute",
    q.over_clean("SELECT book_id, num_pages, ratings_count, text_reviews_count FROM clean"),
)
def median_impute(spark, sf):
    return clean_books(spark, sf).select(KEY, "num_pages", "ratings_count", "text_reviews_count")


# Dates in several written forms, and some that are none.
DATES = (
    "CASE book_id % 5 WHEN 0 THEN publication_date "
    "WHEN 1 THEN concat('06/15/', substring(publication_date, 1, 4)) "
    "WHEN 2 THEN 'no date' "
    "WHEN 3 THEN concat('Tue Nov 17 11:37:35 -0800 ', substring(publication_date, 1, 4)) "
    "ELSE publication_date END"
)


@query(
    "publication_year",
    q.over_books(
        "SELECT book_id, CAST(CASE WHEN book_id % 5 = 2 THEN 2020 ELSE "
        "coalesce(CAST(substring(publication_date, 1, 4) AS INTEGER), 2020) END AS INTEGER) "
        "AS publication_year FROM books"
    ),
)
def publication_year(spark, sf):
    dated = tables.books(spark, sf).withColumn("publication_date", F.expr(DATES))
    return cleaning.preprocess(dated).select(KEY, "publication_year")


@query(
    "text_lengths",
    q.over_clean("SELECT book_id, title_length, description_length FROM clean"),
)
def text_lengths(spark, sf):
    return cleaning.text_lengths(tables.books(spark, sf)).select(
        KEY, "title_length", "description_length"
    )


@query(
    "rating_density",
    q.over_clean("SELECT book_id, rating_density FROM clean"),
)
def rating_density(spark, sf):
    return clean_books(spark, sf).select(KEY, "rating_density")


def _quality(low, high, ratings, chars) -> str:
    return (
        f"average_rating BETWEEN {low} AND {high} AND ratings_count >= {ratings} "
        f"AND length(description) > {chars}"
    )


@query(
    "quality_filter",
    q.over_clean(
        "SELECT book_id, average_rating, "
        f"({_quality(*lx.QUALITY_FILTERS['strict'])}) AS strict FROM clean "
        f"WHERE {_quality(*lx.QUALITY_FILTERS['loose'])}"
    ),
)
def quality_filter(spark, sf):
    """Rows of the looser filter, marked where they pass the stricter one."""
    low, high, ratings, chars = lx.QUALITY_FILTERS["strict"]
    strict = (
        F.col("average_rating").between(low, high)
        & (F.col("ratings_count") >= ratings)
        & (F.length("description") > chars)
    )
    loose = cleaning.quality_filter(clean_books(spark, sf), *lx.QUALITY_FILTERS["loose"])
    return loose.select(KEY, "average_rating", strict.alias("strict"))


@query(
    "rating_range_counts",
    q.over_books(
        "SELECT count(*) AS rows_before, "
        "count(*) FILTER (WHERE average_rating BETWEEN 2 AND 4.5) AS rows_after FROM books"
    ),
)
def rating_range_counts(spark, sf):
    return cleaning.rating_range_counts(tables.books(spark, sf), 2.0, 4.5)


_IQR = "quantile_cont(description_length, [0.25, 0.75])"


@query(
    "iqr_filter",
    q.over_clean(
        "SELECT book_id, description_length FROM clean, fences WHERE description_length "
        "BETWEEN q[1] - 1.5 * (q[2] - q[1]) AND q[2] + 1.5 * (q[2] - q[1])",
        fences=f"SELECT {_IQR} AS q FROM clean",
    ),
)
def iqr_filter(spark, sf):
    measured = cleaning.text_lengths(tables.books(spark, sf))
    return cleaning.iqr_filter(measured, "description_length").select(KEY, "description_length")


@query("min_rows_gate", q.over_books("SELECT count(*) >= 100 AS enough FROM books"))
def min_rows_gate(spark, sf):
    return cleaning.has_min_rows(tables.books(spark, sf))


# A matrix with values that are missing, no number, or infinite.
DIRTY = {
    "ratio": "CASE WHEN book_id % 7 = 0 THEN CAST('NaN' AS DOUBLE) "
    "WHEN book_id % 7 = 1 THEN CAST('Infinity' AS DOUBLE) "
    "WHEN book_id % 7 = 2 THEN -CAST('Infinity' AS DOUBLE) ELSE average_rating END",
    "pages": "num_pages",
    "label": "CASE WHEN book_id % 3 = 0 THEN 'x' ELSE CAST(book_id % 10 AS VARCHAR(4)) END",
}


def dirty(spark, sf):
    return tables.books(spark, sf).select(KEY, *[F.expr(e).alias(c) for c, e in DIRTY.items()])


def _finite(c: str) -> str:
    x = f"TRY_CAST({c} AS DOUBLE)"
    return f"CASE WHEN {x} IS NULL OR isnan({x}) OR isinf({x}) THEN 0 ELSE {x} END"


_DIRTY_SQL = "SELECT book_id, " + ", ".join(f"{e} AS {c}" for c, e in DIRTY.items()) + " FROM books"


@query(
    "sanitize_matrix",
    q.over_books(
        "SELECT book_id, " + ", ".join(f"CAST({_finite(c)} AS DOUBLE) AS {c}" for c in DIRTY)
        + " FROM dirty",
        dirty=_DIRTY_SQL,
    ),
)
def sanitize_matrix(spark, sf):
    return matrix.sanitize(dirty(spark, sf), list(DIRTY))


@query(
    "matrix_audit",
    q.over_books(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, '{t}' AS dtype, count(*) AS n_rows, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
            f"count(*) FILTER (WHERE isinf(TRY_CAST({c} AS DOUBLE))) AS n_inf FROM dirty"
            for c, t in (("ratio", "double"), ("pages", "double"), ("label", "string"))
        ),
        dirty=_DIRTY_SQL,
    ),
)
def matrix_audit(spark, sf):
    return matrix.audit(dirty(spark, sf), list(DIRTY))


@query(
    "align_columns",
    q.over_clean(
        "SELECT book_id, num_pages, CAST(0 AS DOUBLE) AS unknown_feature, "
        "title_length, CAST(0 AS DOUBLE) AS embedding_63 FROM clean"
    ),
)
def align_columns(spark, sf):
    trained = ["num_pages", "unknown_feature", "title_length", "embedding_63"]
    return matrix.align(clean_books(spark, sf), trained, keep=[KEY])


@query(
    "combine_features",
    q.over_clean(
        f"SELECT c.book_id, {q.r6('ln(1 + num_pages)')} AS log_pages, "
        f"CAST({q.words(q.T)} AS INTEGER) AS title_word_count, "
        "CAST(coalesce(e.label, 0) AS INTEGER) AS label, "
        "CAST(coalesce(len(e.embedding), 0) AS INTEGER) AS width "
        "FROM clean c LEFT JOIN embeddings e ON e.vec_id = c.book_id"
    ),
)
def combine_features(spark, sf):
    """Three blocks side by side; books without a vector get 0 there."""
    clean = clean_books(spark, sf)
    titles = clean.select(KEY, text.title_stats()["title_word_count"].alias("title_word_count"))
    pages = clean.select(KEY, *rounded({"log_pages": numeric.page_bands()["log_pages"]}))
    vectors = tables.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias(KEY), "label", F.size("embedding").alias("width")
    )
    return matrix.combine([pages, titles, vectors])


@query(
    "combine_inner",
    q.over_clean(
        "SELECT c.book_id, c.title_length, CAST(e.label AS INTEGER) AS label "
        "FROM clean c JOIN embeddings e ON e.vec_id = c.book_id"
    ),
)
def combine_inner(spark, sf):
    """Only the books every block has."""
    vectors = tables.table(spark, sf, "embeddings").select(F.col("vec_id").alias(KEY), "label")
    lengths = cleaning.text_lengths(tables.books(spark, sf)).select(KEY, "title_length")
    return matrix.combine([lengths, vectors], how="inner")


@query(
    "numeric_projection",
    q.over_clean(
        "SELECT book_id, num_pages, ratings_count, text_reviews_count, publication_year, "
        "title_length, description_length, rating_density FROM clean"
    ),
)
def numeric_projection(spark, sf):
    return matrix.numeric_projection(clean_books(spark, sf))
