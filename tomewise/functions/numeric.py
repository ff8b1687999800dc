"""Numeric and date features as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicons as lx
from .text import flag

YEAR, PAGES = "publication_year", "num_pages"
RATINGS, REVIEWS = "ratings_count", "text_reviews_count"


def book_age(reference_year: int = lx.REFERENCE_YEAR) -> Column:
    return F.lit(reference_year) - F.col(YEAR)


def book_age_bands(reference_year: int = lx.REFERENCE_YEAR) -> dict[str, Column]:
    age = book_age(reference_year)
    return {
        "book_age": age,
        "book_age_squared": age * age,
        "is_very_recent": flag(age <= 2),
        "is_recent": flag((age > 2) & (age <= 5)),
        "is_modern": flag((age > 5) & (age <= 15)),
        "is_classic": flag(age > 20),
    }


def popularity_features() -> dict[str, Column]:
    ratings, reviews = F.log1p(RATINGS), F.log1p(REVIEWS)
    return {
        "log_ratings_count": ratings,
        "log_reviews_count": reviews,
        "review_ratio": F.col(REVIEWS) / (F.col(RATINGS) + 1),
        "popularity_score": ratings * reviews,
    }


def page_bands() -> dict[str, Column]:
    p = F.col(PAGES)
    return {
        "log_pages": F.log1p(p),
        "is_picture_book": flag(p <= 32),
        "is_early_reader": flag((p > 32) & (p <= 64)),
        "is_chapter_book": flag((p > 64) & (p <= 200)),
        "is_middle_grade": flag((p > 200) & (p <= 400)),
        "is_long_book": flag(p > 400),
    }


def rate_features(
    title_chars: Column, desc_chars: Column, reference_year: int = lx.REFERENCE_YEAR
) -> dict[str, Column]:
    span = book_age(reference_year) + 1
    return {
        "pages_per_year": F.try_divide(F.col(PAGES), span),
        "ratings_per_year": F.try_divide(F.col(RATINGS), span),
        "title_desc_ratio": title_chars / (desc_chars + 1),
    }


def engagement() -> dict[str, Column]:
    return {
        "rating_engagement": F.col(RATINGS) / (F.col(REVIEWS) + 1),
        "review_engagement": F.col(REVIEWS) / (F.col(RATINGS) + 1),
    }


def era_flags(reference_year: int = lx.REFERENCE_YEAR) -> dict[str, Column]:
    year = F.col(YEAR)
    return {
        "years_since_pub": book_age(reference_year),
        "is_golden_age": flag(year.between(1950, 1990)),
        "is_digital_age": flag(year >= 2000),
    }


def length_quality() -> dict[str, Column]:
    return {
        "pages_per_rating": F.col(PAGES) / (F.col(RATINGS) + 1),
        "optimal_length": flag(F.col(PAGES).between(24, 48)),
    }


def interactions(
    quality_words: Column,
    desc_sentiment: Column | None = None,
    desc_words: Column | None = None,
    reference_year: int = lx.REFERENCE_YEAR,
) -> dict[str, Column]:
    """Products and ratios. Sentiment counts as 0 and the description as 100 words
    where the frame does not carry them."""
    age, popularity = book_age(reference_year), F.log1p(RATINGS)
    desc_sentiment = F.lit(0.0) if desc_sentiment is None else desc_sentiment
    desc_words = F.lit(100) if desc_words is None else desc_words
    return {
        "pages_age_interaction": F.col(PAGES) * age,
        "popularity_age_interaction": F.col(RATINGS) * age,
        "quality_popularity": quality_words * popularity,
        "sentiment_popularity": desc_sentiment * popularity,
        "title_desc_length_ratio": F.col("title_length") / (F.col("description_length") + 1),
        "pages_to_words_ratio": F.col(PAGES) / (desc_words + 1),
    }


def number_array(values: Iterable[float]) -> Column:
    """A constant array of doubles; folded into one literal however long it is."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def inverse_normal(p: Column) -> Column:
    """Standard normal quantile by Wichura's rational approximations (AS 241)."""

    def poly(coefs: tuple[float, ...], x: Column) -> Column:
        out = F.lit(coefs[-1])
        for c in reversed(coefs[:-1]):
            out = out * x + F.lit(c)
        return out

    q = p - 0.5
    centre_r = 0.180625 - q * q
    tail = F.sqrt(-F.log(F.least(p, 1 - p)))
    near, far = tail - 1.6, tail - 5.0
    tail_value = F.when(tail <= 5.0, poly(AS241["C"], near) / poly(AS241["D"], near)).otherwise(
        poly(AS241["E"], far) / poly(AS241["F"], far)
    )
    centre = q * poly(AS241["A"], centre_r) / poly(AS241["B"], centre_r)
    return F.when(F.abs(q) <= 0.425, centre).otherwise(F.signum(q) * tail_value)


# Published coefficients of algorithm AS 241 (PPND16).
AS241 = {
    "A": (
        3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
        1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
        3.3430575583588128105e4, 2.5090809287301226727e3,
    ),
    "B": (
        1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
        2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
        5.2264952788528545610e3,
    ),
    "C": (
        1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
        3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
        2.27238449892691845833e-2, 7.74545014278341407640e-4,
    ),
    "D": (
        1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
        1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
        1.05075007164441684324e-9,
    ),
    "E": (
        6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
        2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
        2.71155556874348757815e-5, 2.01033439929228813265e-7,
    ),
    "F": (
        1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
        7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
        2.04426310338993978564e-15,
    ),
}
