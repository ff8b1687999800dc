"""Queries over text features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions import text
from ..plans.blocks import lexicon_block
from ..sources import tables
from . import sql as q
from .registry import KEY, as_int, exact, query
from .sql import D, FULL, T


def books(spark: SparkSession, sf: str) -> DataFrame:
    return tables.books(spark, sf)


def selected(columns: str) -> str:
    return q.over_books(f"SELECT book_id, {columns} FROM books")


@query(
    "title_stats",
    selected(q.named(q.TITLE_STATS, "INTEGER") + ", " + q.named(q.UPPERCASE, "exact")),
)
def title_stats(spark, sf):
    stats = text.title_stats()
    ratio = {"title_uppercase_ratio": stats.pop("title_uppercase_ratio")}
    return books(spark, sf).select(KEY, *as_int(stats), *exact(ratio))


@query("title_flags", selected(q.named(q.TITLE_FLAGS, "INTEGER")))
def title_flags(spark, sf):
    return books(spark, sf).select(KEY, *as_int(text.title_flags()))


@query(
    "desc_stats",
    selected(q.named(q.DESC_STATS, "INTEGER") + ", " + q.named(q.AVG_WORD, "exact")),
)
def desc_stats(spark, sf):
    stats = text.desc_stats()
    mean = {"desc_avg_word_length": stats.pop("desc_avg_word_length")}
    return books(spark, sf).select(KEY, *as_int(stats), *exact(mean))


@query("desc_flags", selected(q.named(q.DESC_FLAGS, "INTEGER")))
def desc_flags(spark, sf):
    return books(spark, sf).select(KEY, *as_int(text.desc_flags()))


@query("desc_keyword_counts", selected(q.named(q.DESC_COUNTS, "INTEGER")))
def desc_keyword_counts(spark, sf):
    return books(spark, sf).select(KEY, *as_int(text.desc_keyword_counts()))


def _readability(x: str) -> str:
    pieces = f"len(string_split_regex({x}, '{lx.SENTENCE_END}'))"
    n = q.words(x)
    return f"CASE WHEN {n} = 0 THEN 0 ELSE {q.avg_word(x)} + CAST({n} AS DOUBLE) / {pieces} / 10 END"


@query(
    "readability",
    selected(
        q.named({"title_readability": _readability(T), "desc_readability": _readability(D)}, "exact")
    ),
)
def readability(spark, sf):
    return books(spark, sf).select(KEY, *exact(text.text_readability()))


def _sentiment(x: str) -> str:
    low = f"lower({x})"
    balance = f"{q.present(low, lx.SENTIMENT_POSITIVE)} - {q.present(low, lx.SENTIMENT_NEGATIVE)}"
    return f"coalesce(CAST({balance} AS DOUBLE) / nullif({q.words(x)}, 0), 0)"


@query(
    "lexicon_sentiment",
    selected(q.named({"title_sentiment": _sentiment(T), "desc_sentiment": _sentiment(D)}, "exact")),
)
def lexicon_sentiment(spark, sf):
    return books(spark, sf).select(KEY, *exact(text.lexicon_sentiment()))


@query(
    "lexical_diversity",
    selected(
        q.named(
            {
                "title_complexity": q.distinct_words(T),
                "desc_complexity": f"CAST({q.distinct_words(D)} AS DOUBLE) / ({q.words(D)} + 1)",
            },
            "exact",
        )
    ),
)
def lexical_diversity(spark, sf):
    return books(spark, sf).select(KEY, *exact(text.lexical_diversity()))


@query(
    "quality_words",
    selected(
        f"CAST({q.present(f'lower({D})', lx.QUALITY_WORDS)} AS INTEGER) AS quality_word_count"
    ),
)
def quality_words(spark, sf):
    return books(spark, sf).select(KEY, text.quality_word_count().alias("quality_word_count"))


# Every 50th title is replaced by a bare number, the case the age rule treats as an age.
AGE_TITLE = (
    "CASE WHEN book_id % 50 = 0 THEN CAST(book_id % 17 AS VARCHAR(4)) "
    "WHEN book_id % 7 = 1 THEN concat(title, ' Toddler Baby') "
    "WHEN book_id % 7 = 2 THEN concat(title, ' First Grade chapter book') "
    "ELSE title END"
)
_AGE_RULES = " ".join(f"WHEN contains(t, '{k}') THEN {v}" for k, v in lx.TITLE_AGES.items())


@query(
    "estimated_age_title",
    q.over_books(
        f"SELECT book_id, CAST(CASE {_AGE_RULES} ELSE coalesce(try_cast(t AS DOUBLE), 6) END "
        f"AS DOUBLE) AS estimated_age FROM (SELECT book_id, lower({AGE_TITLE}) AS t FROM books)"
    ),
)
def estimated_age_title(spark, sf):
    titled = books(spark, sf).withColumn("title", F.expr(AGE_TITLE))
    return titled.select(KEY, text.estimated_age_title().alias("estimated_age"))


BOOK_TEXT = (
    f"regexp_replace(regexp_replace(regexp_replace(concat({T}, '. ', {D}), "
    f"'^{lx.WS}+|{lx.WS}+$', '', 'g'), '{lx.NOT_WORD_SPACE_DOT}', ' ', 'g'), '{lx.WS}+', ' ', 'g')"
)


@query("book_text", selected(f"{BOOK_TEXT} AS book_text"))
def book_text(spark, sf):
    return books(spark, sf).select(KEY, text.book_text().alias("book_text"))


_LOW, _N = "lower(x)", f"({q.words('x')} + 1)"
TEXT_QUALITY = {
    "vocab_diversity": f"CAST({q.distinct_words('x')} AS DOUBLE) / {_N}",
    "positive_word_density": f"CAST({q.present(_LOW, lx.DENSITY_POSITIVE)} AS DOUBLE) / {_N}",
    "negative_word_density": f"CAST({q.present(_LOW, lx.DENSITY_NEGATIVE)} AS DOUBLE) / {_N}",
}


@query(
    "text_quality",
    q.over_books(
        f"SELECT book_id, {q.named(TEXT_QUALITY, 'exact')} "
        f"FROM (SELECT book_id, {BOOK_TEXT} AS x FROM books)"
    ),
)
def text_quality(spark, sf):
    joined = books(spark, sf).select(KEY, text.book_text().alias("x"))
    return joined.select(KEY, *exact(text.text_quality(F.col("x"))))


_LEVELS = " ".join(
    f"WHEN contains(x, '{k}') THEN {v}" for k, v in reversed(lx.TEXT_AGES.items())
)
AGE_LEVEL = f"CAST(CASE {_LEVELS} ELSE 6 END AS INTEGER)"


@query(
    "estimated_age_text",
    q.over_books(
        f"SELECT book_id, {AGE_LEVEL} AS estimated_age_level "
        f"FROM (SELECT book_id, lower({BOOK_TEXT}) AS x FROM books)"
    ),
)
def estimated_age_text(spark, sf):
    joined = books(spark, sf).select(KEY, text.book_text().alias("x"))
    return joined.select(KEY, text.estimated_age_text(F.col("x")).alias("estimated_age_level"))


def _scores(lexicon) -> dict[str, str]:
    return {f"{n}_score": q.present("x", kws) for n, kws in lexicon.items()}


def over_full_text(columns: str) -> str:
    return q.over_books(
        f"SELECT book_id, {columns} FROM (SELECT book_id, lower({T}) AS t, {FULL} AS x FROM books)"
    )


QUALITY_TOTAL = " + ".join(
    f"{w} * {q.present('x', lx.QUALITY_LEXICON[n])}" for n, w in lx.QUALITY_WEIGHTS.items()
)
WEIGHTED = {
    "llm_quality_score": QUALITY_TOTAL,
    "normalized_quality_score": f"CAST({QUALITY_TOTAL} AS DOUBLE) / (length(x) + 1) * 1000",
}
NARRATIVE = _scores(lx.NARRATIVE_LEXICON)
NARRATIVE["narrative_complexity"] = " + ".join(NARRATIVE.values())
SERIES = {"is_part_of_series": q.matches("t", lx.SERIES_PATTERN)}
FORMATS = {
    f"fmt_is_{n}": q.matches("x", "|".join(kws)) for n, kws in lx.FORMAT_KEYWORDS.items()
}


def full(spark, sf) -> DataFrame:
    return books(spark, sf).select(KEY, "title", text.full_text().alias("x"))


@query("lexicon_scores", over_full_text(q.named(_scores(lx.QUALITY_LEXICON), "exact")))
def lexicon_scores(spark, sf):
    return full(spark, sf).select(KEY, *exact(text.quality_lexicon_scores(F.col("x"))))


@query("quality_score", over_full_text(q.named(WEIGHTED, "exact")))
def quality_score(spark, sf):
    return full(spark, sf).select(KEY, *exact(text.weighted_quality(F.col("x"))))


@query("narrative_scores", over_full_text(q.named(NARRATIVE, "exact")))
def narrative_scores(spark, sf):
    return full(spark, sf).select(KEY, *exact(text.narrative_scores(F.col("x"))))


@query("series_flag", over_full_text(q.named(SERIES, "INTEGER")))
def series_flag(spark, sf):
    return books(spark, sf).select(KEY, text.series_flag().alias("is_part_of_series"))


@query("format_flags", over_full_text(q.named(FORMATS, "INTEGER")))
def format_flags(spark, sf):
    return full(spark, sf).select(KEY, *as_int(text.format_flags(F.col("x"))))


@query(
    "select_by_name",
    over_full_text(
        q.named(
            {**_scores(lx.QUALITY_LEXICON), **WEIGHTED, **NARRATIVE, **SERIES, **FORMATS}, "exact"
        )
    ),
)
def select_by_name(spark, sf):
    block = lexicon_block(books(spark, sf))
    return block.select(KEY, *exact({c: F.col(c) for c in block.columns if c != KEY}))


@query(
    "author_count",
    selected("CAST(len(string_split(coalesce(authors, ''), ',')) AS INTEGER) AS author_count"),
)
def author_count(spark, sf):
    return books(spark, sf).select(KEY, text.author_count().alias("author_count"))
