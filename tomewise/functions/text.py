"""Scalar text features as plain column expressions.

Every function returns a ``Column`` or a dict ``name -> Column``, so features
can be put into one ``select`` next to each other, on batch and streaming frames
alike. Missing text counts as the empty string.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicons as lx


def text(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def n_chars(x: Column) -> Column:
    return F.length(x)


def plain_spaces(x: Column) -> Column:
    """Every kind of white space as a plain blank, so that simple patterns do afterwards."""
    return F.translate(x, lx.WS_CHARS, " " * len(lx.WS_CHARS))


def n_words(x: Column) -> Column:
    return F.array_size(words(x))


def words(x: Column) -> Column:
    """White-space separated words; never yields empty strings."""
    return F.array_remove(F.split(plain_spaces(x), " "), "")


def n_distinct_words(x: Column) -> Column:
    return F.size(F.array_distinct(words(F.lower(x))))


def avg_word_length(x: Column) -> Column:
    letters = F.length(F.replace(plain_spaces(x), F.lit(" "), F.lit("")))
    return F.coalesce(F.try_divide(letters.cast("double"), n_words(x)), F.lit(0.0))


def keyword_hits(x: Column, keywords: Iterable[str]) -> Column:
    """Non-overlapping occurrences of any of the keywords (they count repeatedly). Keywords are plain
    strings; only texts that hold one are searched by the pattern, which costs far more."""
    low, keywords = F.lower(x), list(keywords)
    return F.when(contains_any(low, keywords), F.regexp_count(low, F.lit("|".join(keywords)))).otherwise(F.when(low.isNotNull(), F.lit(0)))


def keywords_present(lowered: Column, keywords: Iterable[str]) -> Column:
    """How many different keywords occur as substrings of already lower-cased text."""
    return reduce(
        lambda a, b: a + b, [F.contains(lowered, F.lit(k)).cast("int") for k in keywords]
    )


def contains_any(lowered: Column, keywords: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(k)) for k in keywords])


def has_any(x: Column, keywords: Iterable[str]) -> Column:
    return flag(contains_any(F.lower(x), keywords))


# --------------------------------------------------------------------- features
def title_stats(title: str | Column = "title") -> dict[str, Column]:
    t = text(title)
    return {
        "title_word_count": n_words(t),
        "title_char_count": n_chars(t),
        "title_exclamation": F.regexp_count(t, F.lit("!")),
        "title_question": F.regexp_count(t, F.lit(r"\?")),
        "title_uppercase_ratio": F.length(F.regexp_replace(t, lx.NOT_UPPER, "")) / (n_chars(t) + 1),
    }


def title_flags(title: str | Column = "title") -> dict[str, Column]:
    t = text(title)
    return {
        "title_has_number": flag(t.rlike(r"\p{Nd}")),
        "title_has_colon": flag(F.contains(t, F.lit(":"))),
        "title_has_series": flag(t.rlike(lx.TITLE_SERIES_PATTERN)),
        "title_has_age": has_any(t, lx.TITLE_AGE_KEYWORDS),
    }


def desc_stats(description: str | Column = "description") -> dict[str, Column]:
    d = text(description)
    return {
        "desc_word_count": n_words(d),
        "desc_char_count": n_chars(d),
        "desc_sentence_count": F.regexp_count(d, F.lit(lx.SENTENCE_END)),
        "desc_avg_word_length": avg_word_length(d),
    }


def desc_flags(description: str | Column = "description") -> dict[str, Column]:
    d = text(description)
    return {
        "desc_has_award": has_any(d, lx.AWARD_KEYWORDS),
        "desc_has_reading_level": has_any(d, lx.READING_LEVEL_KEYWORDS),
    }


def desc_keyword_counts(description: str | Column = "description") -> dict[str, Column]:
    d = text(description)
    return {
        "desc_positive_words": keyword_hits(d, lx.DESC_POSITIVE_KEYWORDS),
        "desc_educational_words": keyword_hits(d, lx.DESC_EDUCATIONAL_KEYWORDS),
    }


def readability(x: Column) -> Column:
    """Average word length plus a tenth of the words per sentence piece.

    Pieces are what splitting on sentence ends yields, a trailing empty one included.
    """
    pieces = F.regexp_count(x, F.lit(lx.SENTENCE_END)) + 1
    # no words: the first term is 0 already, and so is the second
    return avg_word_length(x) + n_words(x) / pieces / 10


def sentiment(x: Column) -> Column:
    low = F.lower(x)
    balance = keywords_present(low, lx.SENTIMENT_POSITIVE) - keywords_present(
        low, lx.SENTIMENT_NEGATIVE
    )
    return F.coalesce(F.try_divide(balance.cast("double"), n_words(x)), F.lit(0.0))


def text_readability() -> dict[str, Column]:
    return {
        "title_readability": readability(text("title")),
        "desc_readability": readability(text("description")),
    }


def lexicon_sentiment() -> dict[str, Column]:
    return {
        "title_sentiment": sentiment(text("title")),
        "desc_sentiment": sentiment(text("description")),
    }


def vocabulary_share(x: Column) -> Column:
    return n_distinct_words(x) / (n_words(x) + 1)


def lexical_diversity() -> dict[str, Column]:
    return {
        "title_complexity": n_distinct_words(text("title")),
        "desc_complexity": vocabulary_share(text("description")),
    }


def quality_word_count(description: str | Column = "description") -> Column:
    return keywords_present(F.lower(text(description)), lx.QUALITY_WORDS)


def estimated_age_title(title: str | Column = "title") -> Column:
    """Age named by a title. The first table entry found wins; a title that is only
    a number is taken as the age itself."""
    low = F.lower(text(title))
    rule = F.when(F.lit(False), F.lit(0.0))
    for term, age in lx.TITLE_AGES.items():
        rule = rule.when(F.contains(low, F.lit(term)), F.lit(age))
    number = F.when(low.rlike(lx.PLAIN_NUMBER), F.trim(low).try_cast("double"))
    return F.coalesce(rule.otherwise(number), F.lit(float(lx.DEFAULT_AGE)))


def book_text() -> Column:
    joined = plain_spaces(F.concat(text("title"), F.lit(". "), text("description")))
    plain = F.regexp_replace(F.trim(joined), r"[^\p{L}\p{N}_. ]", " ")
    return F.regexp_replace(plain, " {2,}", " ")


def text_quality(x: Column) -> dict[str, Column]:
    low, length = F.lower(x), n_words(x) + 1
    return {
        "vocab_diversity": n_distinct_words(x) / length,
        "positive_word_density": keywords_present(low, lx.DENSITY_POSITIVE) / length,
        "negative_word_density": keywords_present(low, lx.DENSITY_NEGATIVE) / length,
    }


def estimated_age_text(x: Column) -> Column:
    """Age level named by the book text. The last table entry found wins."""
    low = F.lower(x)
    rule = F.when(F.lit(False), F.lit(0))
    for term, age in reversed(lx.TEXT_AGES.items()):
        rule = rule.when(F.contains(low, F.lit(term)), F.lit(age))
    return rule.otherwise(F.lit(lx.DEFAULT_AGE))


# ------------------------------------------------------------- category lexicons
def full_text() -> Column:
    return F.lower(F.concat(text("title"), F.lit(" "), text("description")))


def quality_lexicon_scores(lowered: Column) -> dict[str, Column]:
    return {
        f"{name}_score": keywords_present(lowered, kws).cast("double")
        for name, kws in lx.QUALITY_LEXICON.items()
    }


def weighted_quality(
    lowered: Column, scores: dict[str, Column] | None = None
) -> dict[str, Column]:
    """Weighted sum of the category scores, which a frame may already carry as columns."""
    scores = scores or quality_lexicon_scores(lowered)
    total = reduce(
        lambda a, b: a + b, [scores[f"{n}_score"] * w for n, w in lx.QUALITY_WEIGHTS.items()]
    )
    return {
        "llm_quality_score": total,
        "normalized_quality_score": total / (F.length(lowered) + 1) * 1000,
    }


def narrative_scores(lowered: Column) -> dict[str, Column]:
    scores = {
        f"{name}_score": keywords_present(lowered, kws).cast("double")
        for name, kws in lx.NARRATIVE_LEXICON.items()
    }
    return {**scores, "narrative_complexity": reduce(lambda a, b: a + b, scores.values())}


def series_flag(title: str | Column = "title") -> Column:
    return flag(F.lower(text(title)).rlike(lx.SERIES_PATTERN))


def format_flags(lowered: Column, prefix: str = "fmt_") -> dict[str, Column]:
    """Format named in the text. The prefix keeps these apart from the page-count
    bands, two of which would otherwise carry the same name."""
    return {
        f"{prefix}is_{name}": flag(contains_any(lowered, kws))
        for name, kws in lx.FORMAT_KEYWORDS.items()
    }


def author_count(authors: str | Column = "authors") -> Column:
    return F.size(F.split(text(authors), ","))
