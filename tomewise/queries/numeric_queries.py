"""Queries over numeric and date features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions import numeric, text
from ..operators import distribution
from . import sql as q
from .common import clean_books
from .registry import KEY, as_int, exact, query, rounded
from .sql import D, T


def selected(columns: str) -> str:
    return q.over_clean(f"SELECT book_id, {columns} FROM clean")


@query("book_age_bands", selected(q.named(q.AGE_BANDS, "INTEGER")))
def book_age_bands(spark, sf):
    return clean_books(spark, sf).select(KEY, *as_int(numeric.book_age_bands()))


@query(
    "popularity_features",
    selected(q.named(q.POPULARITY, "double") + ", " + q.named(q.REVIEW_RATIO, "exact")),
)
def popularity_features(spark, sf):
    features = numeric.popularity_features()
    ratio = {"review_ratio": features.pop("review_ratio")}
    return clean_books(spark, sf).select(KEY, *rounded(features), *exact(ratio))


@query(
    "page_bands",
    selected(q.named(q.LOG_PAGES, "double") + ", " + q.named(q.PAGE_FLAGS, "INTEGER")),
)
def page_bands(spark, sf):
    bands = numeric.page_bands()
    log_pages = {"log_pages": bands.pop("log_pages")}
    return clean_books(spark, sf).select(KEY, *rounded(log_pages), *as_int(bands))


@query("rate_features", selected(q.named(q.RATES, "exact")))
def rate_features(spark, sf):
    chars = F.length(text.text("title")), F.length(text.text("description"))
    return clean_books(spark, sf).select(KEY, *exact(numeric.rate_features(*chars)))


@query(
    "engagement",
    selected(
        q.named(
            {
                "rating_engagement": "ratings_count / (text_reviews_count + 1)",
                "review_engagement": "text_reviews_count / (ratings_count + 1)",
            },
            "exact",
        )
    ),
)
def engagement(spark, sf):
    return clean_books(spark, sf).select(KEY, *exact(numeric.engagement()))


_DECILES = "[" + ", ".join(f"{i / 10}" for i in range(11)) + "]"


@query(
    "decile_bucket",
    q.over_clean(
        "SELECT book_id, CAST(len(list_filter(edges[2:-2], lambda e: e < ratings_count)) AS INTEGER) "
        "AS popularity_percentile FROM clean, deciles",
        deciles=f"SELECT list_sort(list_distinct(quantile_cont(ratings_count, {_DECILES}))) AS edges "
        "FROM clean",
    ),
)
def decile_bucket(spark, sf):
    clean = clean_books(spark, sf)
    edges = distribution.decile_edges(clean)
    label = distribution.decile_bucket("ratings_count", edges)
    return clean.select(KEY, label.alias("popularity_percentile"))


@query(
    "quantile_flags",
    selected(
        "CAST(ratings_count > (SELECT quantile_cont(ratings_count, 0.8) FROM clean) AS INTEGER) "
        "AS is_highly_rated_count, "
        "CAST(ratings_count < (SELECT quantile_cont(ratings_count, 0.2) FROM clean) AS INTEGER) "
        "AS is_niche_book"
    ),
)
def quantile_flags(spark, sf):
    clean = clean_books(spark, sf)
    return clean.select(KEY, *as_int(distribution.quantile_flags(clean)))


@query(
    "era_flags",
    selected(
        q.named(
            {
                "years_since_pub": q.AGE,
                "is_golden_age": q.flag("publication_year BETWEEN 1950 AND 1990"),
                "is_digital_age": q.flag("publication_year >= 2000"),
            },
            "INTEGER",
        )
    ),
)
def era_flags(spark, sf):
    return clean_books(spark, sf).select(KEY, *as_int(numeric.era_flags()))


@query(
    "length_quality",
    selected(
        "num_pages / (ratings_count + 1) AS pages_per_rating, "
        "CAST(num_pages BETWEEN 24 AND 48 AS INTEGER) AS optimal_length"
    ),
)
def length_quality(spark, sf):
    quality = numeric.length_quality()
    return clean_books(spark, sf).select(KEY, *[c.alias(n) for n, c in quality.items()])


_LOW = f"lower({D})"
_BALANCE = (
    f"coalesce(CAST({q.present(_LOW, lx.SENTIMENT_POSITIVE)} - "
    f"{q.present(_LOW, lx.SENTIMENT_NEGATIVE)} AS DOUBLE) / nullif({q.words(D)}, 0), 0)"
)


_PRODUCTS = {
    "pages_age_interaction": f"num_pages * {q.AGE}",
    "popularity_age_interaction": f"ratings_count * {q.AGE}",
    "title_desc_length_ratio": f"CAST(length({T}) AS DOUBLE) / (length({D}) + 1)",
    "pages_to_words_ratio": "num_pages / (100 + 1)",
}
_LOG_PRODUCTS = {
    "quality_popularity": f"{q.present(_LOW, lx.QUALITY_WORDS)} * ln(1 + ratings_count)",
    "sentiment_popularity": f"{_BALANCE} * ln(1 + ratings_count)",
}


@query(
    "interactions",
    selected(q.named(_PRODUCTS, "exact") + ", " + q.named(_LOG_PRODUCTS, "double")),
)
def interactions(spark, sf):
    sentiment = text.lexicon_sentiment()["desc_sentiment"]
    features = numeric.interactions(text.quality_word_count(), sentiment)
    logs = {n: features.pop(n) for n in _LOG_PRODUCTS}
    return clean_books(spark, sf).select(KEY, *exact(features), *rounded(logs))
