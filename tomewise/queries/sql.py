"""Pieces of the checking SQL (DuckDB dialect)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from ..functions import lexicons as lx
from ..sources.tables import VIEWS

T, D = "coalesce(title, '')", "coalesce(description, '')"
FULL = f"lower(concat({T}, ' ', {D}))"

CLEAN_SQL = """
SELECT book_id, title, description, authors, language_code, popular_shelves, average_rating,
  coalesce(num_pages, (SELECT quantile_cont(num_pages, 0.5) FROM books), 100) AS num_pages,
  coalesce(ratings_count, 0) AS ratings_count,
  coalesce(text_reviews_count, 0) AS text_reviews_count, publication_year,
  CAST(length(coalesce(title, '')) AS INTEGER) AS title_length,
  CAST(length(coalesce(description, '')) AS INTEGER) AS description_length,
  ratings_count / greatest(max(publication_year) OVER () - publication_year + 1, 1)
    AS rating_density
FROM (SELECT *, CAST(coalesce(year(try_cast(publication_date AS DATE)), 2020) AS INTEGER)
    AS publication_year FROM books)
"""


def cte(parts: Mapping[str, str], body: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({s})" for n, s in parts.items()) + " " + body


def over_books(body: str, **more: str) -> str:
    return cte({"books": VIEWS["books"], **more}, body)


def over_clean(body: str, **more: str) -> str:
    return cte({"books": VIEWS["books"], "clean": CLEAN_SQL, **more}, body)


def over_runs(body: str, **more: str) -> str:
    return cte({**{n: VIEWS[n] for n in ("runs", "artifacts", "versions")}, **more}, body)


def r6(e: str, digits: int = 6) -> str:
    return f"round(CAST({e} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE)"


def named(columns: Mapping[str, str], kind: str) -> str:
    """Select list: ``kind`` is 'double' (rounded), 'exact' (same arithmetic on either engine,
    not rounded) or an integer type."""
    if kind == "exact":
        return ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in columns.items())
    if kind == "double":
        return ", ".join(f"{r6(e)} AS {n}" for n, e in columns.items())
    return ", ".join(f"CAST({e} AS {kind}) AS {n}" for n, e in columns.items())


def hits(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


def words(x: str) -> str:
    return hits(x, lx.NOT_WS + "+")


def distinct_words(x: str) -> str:
    split = f"string_split_regex(lower({x}), '{lx.WS}+')"
    return f"len(list_distinct(list_filter({split}, lambda w: w <> '')))"


def matches(x: str, pattern: str) -> str:
    return f"CAST(regexp_matches({x}, '{pattern}') AS INTEGER)"


def any_of(x: str, keywords: Iterable[str]) -> str:
    return matches(f"lower({x})", "|".join(keywords))


def present(lowered: str, keywords: Iterable[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({lowered}, '{k}') AS INTEGER)" for k in keywords) + ")"


def flag(condition: str) -> str:
    return f"CAST(coalesce({condition}, false) AS INTEGER)"


def letters(x: str) -> str:
    return f"length(regexp_replace({x}, '{lx.WS}+', '', 'g'))"


def avg_word(x: str) -> str:
    return f"coalesce(CAST({letters(x)} AS DOUBLE) / nullif({words(x)}, 0), 0)"


TITLE_STATS = {
    "title_word_count": words(T),
    "title_char_count": f"length({T})",
    "title_exclamation": hits(T, "!"),
    "title_question": hits(T, r"\?"),
}
UPPERCASE = {
    "title_uppercase_ratio":
        f"CAST(length(regexp_replace({T}, '{lx.NOT_UPPER}', '', 'g')) AS DOUBLE) / (length({T}) + 1)"
}
TITLE_FLAGS = {
    "title_has_number": matches(T, r"\p{Nd}"),
    "title_has_colon": f"CAST(contains({T}, ':') AS INTEGER)",
    "title_has_series": matches(T, lx.TITLE_SERIES_PATTERN),
    "title_has_age": any_of(T, lx.TITLE_AGE_KEYWORDS),
}
DESC_STATS = {
    "desc_word_count": words(D),
    "desc_char_count": f"length({D})",
    "desc_sentence_count": hits(D, lx.SENTENCE_END),
}
AVG_WORD = {"desc_avg_word_length": avg_word(D)}
DESC_FLAGS = {
    "desc_has_award": any_of(D, lx.AWARD_KEYWORDS),
    "desc_has_reading_level": any_of(D, lx.READING_LEVEL_KEYWORDS),
}
DESC_COUNTS = {
    "desc_positive_words": hits(f"lower({D})", "|".join(lx.DESC_POSITIVE_KEYWORDS)),
    "desc_educational_words": hits(f"lower({D})", "|".join(lx.DESC_EDUCATIONAL_KEYWORDS)),
}
AGE = "(2024 - publication_year)"
AGE_BANDS = {
    "book_age": AGE,
    "book_age_squared": f"{AGE} * {AGE}",
    "is_very_recent": flag(f"{AGE} <= 2"),
    "is_recent": flag(f"{AGE} > 2 AND {AGE} <= 5"),
    "is_modern": flag(f"{AGE} > 5 AND {AGE} <= 15"),
    "is_classic": flag(f"{AGE} > 20"),
}
REVIEW_RATIO = {"review_ratio": "text_reviews_count / (ratings_count + 1)"}
POPULARITY = {
    "log_ratings_count": "ln(1 + ratings_count)",
    "log_reviews_count": "ln(1 + text_reviews_count)",
    "popularity_score": "ln(1 + ratings_count) * ln(1 + text_reviews_count)",
}
LOG_PAGES = {"log_pages": "ln(1 + num_pages)"}
PAGE_FLAGS = {
    "is_picture_book": flag("num_pages <= 32"),
    "is_early_reader": flag("num_pages > 32 AND num_pages <= 64"),
    "is_chapter_book": flag("num_pages > 64 AND num_pages <= 200"),
    "is_middle_grade": flag("num_pages > 200 AND num_pages <= 400"),
    "is_long_book": flag("num_pages > 400"),
}
RATES = {
    "pages_per_year": f"num_pages / nullif({AGE} + 1, 0)",
    "ratings_per_year": f"ratings_count / nullif({AGE} + 1, 0)",
    "title_desc_ratio": f"CAST(length({T}) AS DOUBLE) / (length({D}) + 1)",
}
BASE = {c: c for c in lx.BASE_NUMERIC}
TRADITIONAL = {
    **BASE, **TITLE_STATS, **UPPERCASE, **TITLE_FLAGS, **DESC_STATS, **AVG_WORD, **DESC_FLAGS,
    **DESC_COUNTS, **AGE_BANDS, **POPULARITY, **REVIEW_RATIO, **LOG_PAGES, **PAGE_FLAGS, **RATES,
}

# The traditional features as doubles, one row per book, and the same scaled.
FEATURES_SQL = (
    "SELECT book_id, average_rating, "
    + ", ".join(f"CAST({TRADITIONAL[c]} AS DOUBLE) AS {c}" for c in lx.NUMERIC_FEATURES)
    + " FROM clean"
)
SCALED_SQL = (
    "SELECT book_id, average_rating, "
    + ", ".join(
        f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0) AS {c}"
        for c in lx.NUMERIC_FEATURES
    )
    + " FROM features"
)
