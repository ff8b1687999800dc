"""Word lists, age tables, patterns and model constants.

Results depend on these values, so they are stated plainly and in their natural
order. Nothing in this module computes anything.
"""

# ---------------------------------------------------------------- text classes
# White space and word classes that mean the same in Java, RE2 and Python regexes.
WS = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
NOT_WS = WS.replace("[", "[^", 1)
NOT_WORD_SPACE_DOT = WS.replace("[", r"[^\p{L}\p{N}_.", 1)
# The same white space, character by character.
WS_CHARS = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
            0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ],
    )
)
NOT_UPPER = (
    r"[^\p{Lu}\x{2160}-\x{216f}\x{24b6}-\x{24cf}"
    r"\x{1f130}-\x{1f149}\x{1f150}-\x{1f169}\x{1f170}-\x{1f189}]"
)
TOKEN = r"[\p{L}\p{N}_]{2,}"
SENTENCE_END = r"[.!?]+"
PLAIN_NUMBER = r"^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)? *$"

# ------------------------------------------------------------------- filtering
CATEGORY_KEYWORDS = (
    "children", "kids", "picture-book", "middle-grade", "early-readers", "juvenile", "young-adult",
)
CATEGORY_PATTERN = "|".join(CATEGORY_KEYWORDS)

# --------------------------------------------------------- title / description
TITLE_AGE_KEYWORDS = (
    "baby", "toddler", "preschool", "kindergarten", "grade", "teen", "young",
)
TITLE_SERIES_PATTERN = r"#\p{Nd}+|Book \p{Nd}+|Volume \p{Nd}+"
AWARD_KEYWORDS = (
    "award", "winner", "medal", "prize", "bestseller", "caldecott", "newbery",
)
READING_LEVEL_KEYWORDS = (
    "grade", "age", "years old", "kindergarten", "elementary", "reading level",
)
DESC_POSITIVE_KEYWORDS = (
    "fun", "adventure", "magical", "wonderful", "amazing", "delightful",
)
DESC_EDUCATIONAL_KEYWORDS = (
    "learn", "teach", "educational", "lesson", "moral", "values",
)

# ----------------------------------------------------------- sentiment / quality
SENTIMENT_POSITIVE = (
    "good", "great", "excellent", "wonderful", "amazing",
    "fantastic", "love", "beautiful", "fun", "exciting",
)
SENTIMENT_NEGATIVE = (
    "bad", "terrible", "awful", "boring", "difficult",
    "confusing", "sad", "scary", "inappropriate",
)
QUALITY_WORDS = (
    "award", "bestselling", "acclaimed", "beloved", "classic", "timeless", "wonderful",
)
DENSITY_POSITIVE = (
    "amazing", "wonderful", "fantastic", "delightful", "charming", "magical", "adventure", "fun",
)
DENSITY_NEGATIVE = (
    "boring", "confusing", "difficult", "scary", "inappropriate", "dull",
)

# ------------------------------------------------------------------ age tables
DEFAULT_AGE = 6
TITLE_AGES = {
    "baby": 0.5,
    "toddler": 1.5,
    "preschool": 3.0,
    "kindergarten": 5.0,
    "first grade": 6.0,
    "second grade": 7.0,
    "chapter book": 8.0,
    "middle grade": 10.0,
    "young adult": 14.0,
}
TEXT_AGES = {
    "baby": 1,
    "toddler": 2,
    "preschool": 4,
    "kindergarten": 5,
    "first grade": 6,
    "second grade": 7,
    "elementary": 8,
    "middle grade": 10,
    "young adult": 14,
}

# ------------------------------------------------------------- category lexicons
QUALITY_LEXICON = {
    "high_quality": (
        "award", "winner", "caldecott", "newbery", "bestseller", "classic", "beloved", "acclaimed",
        "timeless", "masterpiece", "wonderful", "delightful", "charming", "magical",
        "captivating", "engaging",
    ),
    "educational_value": (
        "learn", "teach", "educational", "curriculum", "lesson", "skill", "alphabet", "numbers",
        "counting", "reading", "vocabulary", "science", "history", "geography", "moral", "values",
    ),
    "entertainment_value": (
        "fun", "funny", "hilarious", "adventure", "exciting", "thrilling", "mystery", "surprise",
        "humor", "laugh", "giggle", "silly", "playful", "imaginative", "creative",
    ),
    "age_appropriateness": (
        "age appropriate", "suitable for", "perfect for", "ideal for", "recommended for",
        "designed for", "tailored to",
    ),
    "negative_indicators": (
        "boring", "dull", "confusing", "difficult", "inappropriate", "scary", "violent",
        "complex", "advanced", "challenging",
    ),
}
QUALITY_WEIGHTS = {
    "high_quality": 3,
    "educational_value": 2,
    "entertainment_value": 2,
    "age_appropriateness": 1,
    "negative_indicators": -2,
}
NARRATIVE_LEXICON = {
    "character_focus": ("character", "protagonist", "hero", "friend", "family"),
    "plot_elements": ("story", "adventure", "journey", "quest", "mystery"),
    "setting_richness": ("world", "place", "land", "kingdom", "forest", "ocean"),
    "emotional_content": ("feel", "emotion", "happy", "sad", "excited", "worried"),
    "interactive_elements": ("ask", "question", "think", "imagine", "discover"),
}
SERIES_PATTERN = (
    r"book \p{Nd}+|#\p{Nd}+|volume \p{Nd}+|part \p{Nd}+|series|collection|set"
)
FORMAT_KEYWORDS = {
    "picture_book": ("picture book", "illustrated", "board book"),
    "chapter_book": ("chapter book", "early reader", "beginning reader"),
    "graphic_novel": ("graphic", "comic", "manga"),
    "activity_book": ("activity", "coloring", "puzzle", "workbook"),
}

# ------------------------------------------------------------- cleaning defaults
REQUIRED_COLUMNS = {
    "average_rating": ("double", None),
    "num_pages": ("double", None),
    "ratings_count": ("double", 0.0),
    "text_reviews_count": ("double", 0.0),
    "title": ("string", ""),
    "description": ("string", ""),
    "publication_date": ("string", None),
    "publish_date": ("string", None),
}
DEFAULT_PAGES = 100.0
DEFAULT_YEAR = 2020
REFERENCE_YEAR = 2024
# (lowest rating, highest rating, fewest ratings, description longer than)
QUALITY_FILTERS = {"strict": (2.0, 5.0, 15, 30), "loose": (2.0, 5.0, 10, 20)}
MIN_TRAINING_ROWS = 100

# ------------------------------------------------------------- feature manifest
BASE_NUMERIC = (
    "num_pages", "ratings_count", "text_reviews_count", "publication_year",
    "title_length", "description_length", "rating_density",
)
DERIVED_NUMERIC = (
    "title_word_count", "title_char_count", "title_has_number", "title_has_colon",
    "title_has_series", "title_exclamation", "title_question", "title_uppercase_ratio",
    "title_has_age", "desc_word_count", "desc_char_count", "desc_sentence_count",
    "desc_avg_word_length", "desc_has_award", "desc_has_reading_level", "desc_positive_words",
    "desc_educational_words", "book_age", "book_age_squared", "is_very_recent", "is_recent",
    "is_modern", "is_classic", "log_ratings_count", "log_reviews_count", "review_ratio",
    "popularity_score", "log_pages", "is_picture_book", "is_early_reader", "is_chapter_book",
    "is_middle_grade", "is_long_book", "pages_per_year", "ratings_per_year", "title_desc_ratio",
)
NUMERIC_FEATURES = BASE_NUMERIC + DERIVED_NUMERIC
POLY_FEATURES = (
    "log_ratings_count", "log_reviews_count", "log_pages", "book_age", "popularity_score",
)
TITLE_VOCABULARY, DESC_VOCABULARY, MIN_DOC_FREQ = 50, 100, 2
TITLE_COMPONENTS, DESC_COMPONENTS = 10, 20

# ------------------------------------------------------------- model evaluation
BASELINE_R2 = 0.1851
VERDICTS = {
    "best": ((0.28, "outstanding"), (0.25, "excellent"), (0.20, "great"), (None, "progress")),
    "config": (
        (0.25, "outstanding"), (0.20, "excellent"), (0.15, "great"),
        (0.10, "good"), (0.05, "moderate"), (None, "poor"),
    ),
    "transformed": ((0.3, "good"), (0.15, "moderate"), (None, "poor")),
    "delta": ((0.05, "excellent"), (0.02, "good"), (0.0, "modest"), (None, "none")),
}
IMPORTANCE_GROUPS = {
    "semantic_wide": "similar|embedding|semantic|quality|diversity",
    "semantic": "embedding|similar|semantic",
    "lexicon": "score|quality|complexity|is_",
}
GOOD_R2 = 0.25
EXPECTED_FEATURES = 511
PREDICTION_RANGE = (0.5, 5.5)

# ------------------------------------------------------------- scoring requests
SINGLE_REQUEST_DEFAULTS = {
    "authors": "Unknown", "publication_year": 2020, "num_pages": 100,
    "ratings_count": 10, "text_reviews_count": 5, "average_rating": 3.5,
}
SERVICE_REQUEST_DEFAULTS = {"authors": "Unknown", "publication_year": 2023, "num_pages": 100}
FALLBACK_WIDTH = 103
CONFIDENCE_LABELS = {
    "low": (2.5, "Low-rated book predicted"),
    "high": (4.0, "High-rated book predicted"),
    "average": (None, "Average rating predicted"),
}
EXPLANATION = (
    "Based on semantic content analysis, this book is predicted to receive %.2f stars"
)

# ------------------------------------------------------------------ stop words
# The English list that Spark's StopWordsRemover loads by default.
ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split())
