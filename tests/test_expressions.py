"""Text and numeric expressions against hand-computed values and plain Python."""

import math
import re
import statistics

import pytest
from pyspark.sql import functions as F

from tomewise.functions import lexicons as lx
from tomewise.functions import numeric, text

TEXTS = [
    "A b. C!",
    "",
    None,
    "one two three\x1cfour",
    "  lead and trail  ",
    "...!!!",
    "É Ünï ŒUVRE ⅣⅠ x",
    "Café déjà-vu, #3: Book 2?",
    "word " * 50,
]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t, t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "book_id long, title string, description string")


def column(df, expr):
    return [r[0] for r in df.orderBy("book_id").select(expr).collect()]


def plain():
    return [t or "" for t in TEXTS]


def test_words_follow_unicode_white_space(texts):
    assert column(texts, text.n_words(text.text("title"))) == [len(t.split()) for t in plain()]
    assert column(texts, text.words(text.text("title"))) == [t.split() for t in plain()]


def test_average_word_length(texts):
    want = [statistics.mean(map(len, t.split())) if t.split() else 0.0 for t in plain()]
    assert column(texts, text.avg_word_length(text.text("title"))) == pytest.approx(want)


def test_distinct_words(texts):
    want = [len(set(t.lower().split())) for t in plain()]
    assert column(texts, text.n_distinct_words(text.text("title"))) == want


def test_uppercase_ratio(texts):
    want = [sum(c.isupper() for c in t) / (len(t) + 1) for t in plain()]
    assert column(texts, text.title_stats()["title_uppercase_ratio"]) == pytest.approx(want)


def test_readability_counts_the_trailing_piece(texts):
    def score(t):
        words = t.split()
        if not words:
            return 0.0
        pieces = re.split(r"[.!?]+", t)
        return statistics.mean(map(len, words)) + len(words) / len(pieces) / 10

    want = [score(t) for t in plain()]
    assert column(texts, text.readability(text.text("title"))) == pytest.approx(want)


def test_book_text_is_cleaned_like_python(texts):
    def clean(t):
        joined = re.sub(r"[^\w\s.]", " ", f"{t}. {t}".strip())
        return re.sub(r"\s+", " ", joined)

    assert column(texts, text.book_text()) == [clean(t) for t in plain()]


def test_keyword_counts_differ_in_kind(spark):
    df = spark.createDataFrame([("fun funny FUN adventure pages",)], "description string")
    assert df.select(text.desc_keyword_counts()["desc_positive_words"]).first()[0] == 4
    low = F.lower("description")
    assert df.select(text.keywords_present(low, ("fun", "adventure"))).first()[0] == 2
    # substring, not word: "age" is in "pages"
    assert df.select(text.desc_flags()["desc_has_reading_level"]).first()[0] == 1


@pytest.mark.parametrize(
    "title, age",
    [
        ("Baby and Toddler", 0.5),
        ("Second grade chapter book", 7.0),
        ("1984", 1984.0),
        ("12abc", 6.0),
        ("1d", 6.0),
        ("", 6.0),
        (None, 6.0),
    ],
)
def test_age_of_title(spark, title, age):
    df = spark.createDataFrame([(title,)], "title string")
    assert df.select(text.estimated_age_title()).first()[0] == age


def test_age_of_text_takes_the_last_entry(spark):
    df = spark.createDataFrame([("a baby young adult elementary",), ("none",)], "t string")
    assert [r[0] for r in df.select(text.estimated_age_text(F.col("t"))).collect()] == [14, 6]


def test_series_pattern_is_case_sensitive_only_for_titles(spark):
    df = spark.createDataFrame([("book 2",), ("Book 2",), ("sunset",)], "title string")
    assert [r[0] for r in df.select(text.title_flags()["title_has_series"]).collect()] == [0, 1, 0]
    assert [r[0] for r in df.select(text.series_flag()).collect()] == [1, 1, 1]


def test_age_bands_leave_a_gap(spark):
    df = spark.createDataFrame([(2024 - a,) for a in (2, 5, 15, 18, 21)], "publication_year int")
    bands = numeric.book_age_bands()
    names = ["is_very_recent", "is_recent", "is_modern", "is_classic"]
    got = [tuple(r) for r in df.select(*[bands[n] for n in names]).collect()]
    assert got == [(1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 0), (0, 0, 0, 1)]


def test_rates_survive_next_years_books(spark):
    df = spark.createDataFrame([(2025, 10.0, 5.0)], "publication_year int, num_pages double, ratings_count double")
    rates = numeric.rate_features(F.lit(1), F.lit(1))
    assert df.select(rates["pages_per_year"]).first()[0] is None


@pytest.mark.parametrize("p", [1e-9, 1e-7, 0.01, 0.075, 0.3, 0.5, 0.9, 0.99999])
def test_inverse_normal(spark, p):
    got = spark.range(1).select(numeric.inverse_normal(F.lit(p))).first()[0]
    assert got == pytest.approx(statistics.NormalDist().inv_cdf(p), rel=1e-12, abs=1e-13)


def test_word_lists_have_their_sizes():
    sizes = [len(v) for v in lx.QUALITY_LEXICON.values()]
    assert sizes == [16, 16, 15, 7, 10]
    assert [len(v) for v in lx.NARRATIVE_LEXICON.values()] == [5, 5, 6, 6, 5]
    assert len(lx.NUMERIC_FEATURES) == 43


def test_stop_words_are_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(lx.ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_white_space_classes_agree():
    for code in range(0x3100):
        c = chr(code)
        assert c.isspace() == (c in lx.WS_CHARS), hex(code)
    assert math.isclose(len(lx.WS_CHARS), 29)


def test_keywords_and_words_need_no_pattern_where_there_is_nothing_to_find(spark):
    """Patterns cost far more than plain searches: flags and word counts take none, keyword counts only
    where a keyword is there. Results are those of the patterns."""
    keys = ("fun", "unfair", "learn")
    texts = ["", " ", "Fun", "funfun", "unfunfair learnlearn", "fu n", " a\tb　c  ", "lear", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    pattern = F.lit("|".join(keys))
    plain = (F.coalesce(F.lower(t).rlike("|".join(keys)), F.lit(False)).cast("int"), F.regexp_count(F.lower(t), pattern),
             F.regexp_count(text.plain_spaces(t), F.lit("[^ ]+")))
    fast = (text.has_any(t, keys), text.keyword_hits(t, keys), text.n_words(t))
    rows = df.select(*[a.eqNullSafe(b) for a, b in zip(plain, fast, strict=True)]).collect()
    assert all(all(r) for r in rows)
    for column in (fast[0], fast[2]):
        shown = str(column).lower()
        assert "rlike" not in shown and "regexp" not in shown
    assert "contains" in str(fast[1]).lower()
