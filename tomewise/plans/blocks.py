"""Feature blocks: fitted once on training rows, then plain transforms."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions import numeric, text
from ..operators import similarity
from ..operators.encoding import fit_label_codes, label_encode
from ..operators.matrix import combine, finite_or_zero, select_by_name
from ..operators.scaling import (
    ColumnScaler,
    VectorScaler,
    fit_column_scaler,
    fit_vector_scaler,
    poly_interactions,
)
from ..operators.text_vectors import (
    TextEmbedder,
    description_source,
    fit_text_embedders,
    title_source,
)
from ..sources.sinks import load_bank, save_bank

KEY, LABEL = "book_id", "average_rating"
OWN_SEMANTIC = (
    "vocab_diversity", "positive_word_density", "negative_word_density", "estimated_age_level",
)


def traditional_features(clean: DataFrame, reference_year: int = lx.REFERENCE_YEAR) -> DataFrame:
    """The numeric features of the traditional block, unscaled, as one projection."""
    title, desc = text.title_stats(), text.desc_stats()
    features = {
        **title,
        **text.title_flags(),
        **desc,
        **text.desc_flags(),
        **text.desc_keyword_counts(),
        **numeric.book_age_bands(reference_year),
        **numeric.popularity_features(),
        **numeric.page_bands(),
        **numeric.rate_features(title["title_char_count"], desc["desc_char_count"], reference_year),
    }
    return clean.withColumns(features)


@dataclass
class TraditionalBlock:
    """Scaled numeric features, text components, encoded language and pairwise products."""

    scaler: ColumnScaler | None = None
    title: TextEmbedder | None = None
    description: TextEmbedder | None = None
    languages: DataFrame | None = None
    title_vocabulary: int = lx.TITLE_VOCABULARY
    desc_vocabulary: int = lx.DESC_VOCABULARY
    title_components: int = lx.TITLE_COMPONENTS
    desc_components: int = lx.DESC_COMPONENTS

    def fit(self, clean: DataFrame) -> TraditionalBlock:
        missing = {"title", "description", *lx.BASE_NUMERIC} - set(clean.columns)
        if missing:
            raise ValueError(f"columns missing: {sorted(missing)}")
        self.scaler = fit_column_scaler(traditional_features(clean), lx.NUMERIC_FEATURES)
        texts = fit_text_embedders(
            clean,
            {
                "title": (title_source(), self.title_vocabulary, self.title_components),
                "description": (description_source(), self.desc_vocabulary, self.desc_components),
            },
        )
        self.title, self.description = texts["title"], texts["description"]
        if "language_code" in clean.columns:
            self.languages = fit_label_codes(clean, "language_code")
        return self

    def features(self) -> list[str]:
        self._require_fit()
        names = list(lx.NUMERIC_FEATURES)
        names += [f"title_svd_{i}" for i in range(len(self.title.svd.components))]
        names += [f"desc_svd_{i}" for i in range(len(self.description.svd.components))]
        if self.languages is not None:
            names.append("language_code_encoded")
        return names + list(poly_interactions())

    def transform(self, clean: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """(book_id, keep..., features...); no shuffle."""
        return self.finish(self.add_text_vectors(clean), keep)

    def add_text_vectors(self, clean: DataFrame) -> DataFrame:
        """Text components and language codes. These take many small plan steps, so they
        come before the wide projections, which every later step would carry along."""
        self._require_fit()
        df = self.title.transform(clean, title_source(), "title_svd")
        df = self.description.transform(df, description_source(), "desc_svd")
        if self.languages is not None:
            if "language_code" not in df.columns:
                df = df.withColumn("language_code", F.lit(None).cast("string"))
            df = label_encode(df, self.languages, "language_code")
        return df

    def finish(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        df = self.scaler.transform(traditional_features(df)).withColumns(poly_interactions())
        parts = {}
        for name, embedder in (("title_svd", self.title), ("desc_svd", self.description)):
            parts.update({f"{name}_{i}": F.col(name)[i] for i in range(len(embedder.svd.components))})
        # language codes are whole and never null, everything else may be neither
        columns = [
            F.col(c) if c == "language_code_encoded" else finite_or_zero(parts.get(c, F.col(f"`{c}`"))).alias(c)
            for c in self.features()
        ]
        return df.select(KEY, *keep, *columns)

    def _require_fit(self) -> None:
        if self.scaler is None:
            raise ValueError("the block must be fitted before it transforms new rows")

    def save(self, spark: SparkSession, path: str) -> None:
        self._require_fit()
        self.scaler.to_frame(spark).write.mode("overwrite").parquet(f"{path}/scaler")
        self.title.save(spark, f"{path}/title")
        self.description.save(spark, f"{path}/description")
        if self.languages is not None:
            self.languages.write.mode("overwrite").parquet(f"{path}/languages")
        parts = spark.createDataFrame([(self.languages is not None,)], "with_languages boolean")
        parts.write.mode("overwrite").parquet(f"{path}/parts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TraditionalBlock:
        known = spark.read.parquet(f"{path}/parts").first().with_languages
        return cls(
            scaler=ColumnScaler.from_frame(spark.read.parquet(f"{path}/scaler")),
            title=TextEmbedder.load(spark, f"{path}/title"),
            description=TextEmbedder.load(spark, f"{path}/description"),
            languages=spark.read.parquet(f"{path}/languages") if known else None,
        )


LEXICON_FEATURES = (
    *[f"{name}_score" for name in (*lx.QUALITY_LEXICON, *lx.NARRATIVE_LEXICON)],
    "narrative_complexity",
    "is_part_of_series",
    *[f"fmt_is_{name}" for name in lx.FORMAT_KEYWORDS],
    "llm_quality_score",
    "normalized_quality_score",
)


def add_lexicon_features(clean: DataFrame) -> DataFrame:
    """Lexicon scores and flags as further columns; expressions only."""
    low = F.col("full_text")
    scores = text.quality_lexicon_scores(low)
    features = {
        **scores,
        **text.narrative_scores(low),
        "is_part_of_series": text.series_flag(),
        **text.format_flags(low),
    }
    scored = clean.withColumn("full_text", text.full_text()).withColumns(features)
    totals = text.weighted_quality(low, {name: F.col(name) for name in scores})
    return scored.withColumns(totals).drop("full_text")


def lexicon_block(clean: DataFrame) -> DataFrame:
    """(book_id, lexicon scores and flags)."""
    return select_by_name(add_lexicon_features(clean.select(KEY, "title", "description")))


NEIGHBOURS = 20


@dataclass
class SemanticBlock:
    """Scaled vectors, neighbour rating aggregates and text quality.

    The bank holds the scaled vectors of the rated training rows, so that queries and bank
    are compared on the same scale and no row meets its own rating.
    """

    scaler: VectorScaler | None = None
    bank: DataFrame | None = None
    mean_rating: float | None = None
    index: similarity.NeighbourIndex | None = None

    def fit(self, clean: DataFrame) -> SemanticBlock:
        """Learns from the rows that have a vector; others get their own features and 0 for what
        neighbours would tell."""
        clean = clean.where(F.col("embedding").isNotNull())
        self.scaler = fit_vector_scaler(clean)
        rated = clean.where(F.col(LABEL).isNotNull())
        scaled = self.scaler.scaled().cast("array<float>").alias("embedding")
        self.bank = rated.select(KEY, scaled, LABEL)
        self.mean_rating = rated.agg(F.avg(LABEL)).first()[0]
        self.index = None
        return self

    def indexed(self) -> similarity.NeighbourIndex:
        """The bank laid out for search: made once, however often rows are scored."""
        if self.index is None:
            self.index = similarity.build_index(self.bank, NEIGHBOURS)
        return self.index

    def scaled(self, clean: DataFrame) -> DataFrame:
        if self.bank is None:
            raise ValueError("the block must be fitted before it transforms new rows")
        return clean.withColumn("embedding", self.scaler.scaled().cast("array<float>"))

    def add_own_features(self, clean: DataFrame) -> DataFrame:
        """The scaled vector and the text quality of each row; expressions only."""
        quality = {
            **text.text_quality(F.col("book_text")),
            "estimated_age_level": text.estimated_age_text(F.col("book_text")),
        }
        with_text = self.scaled(clean).withColumn("book_text", text.book_text())
        return with_text.withColumns(quality).drop("book_text")

    def neighbours(self, scaled: DataFrame) -> DataFrame:
        """(book_id, aggregates...) for rows that carry a scaled vector."""
        queries = scaled.select(KEY, "embedding").where(F.col("embedding").isNotNull())
        found = similarity.search(queries, self.indexed(), NEIGHBOURS)
        return neighbour_aggregates(found, self.mean_rating)

    def transform(self, clean: DataFrame) -> DataFrame:
        """(book_id, embedding, text quality..., aggregates...), one row per input row."""
        own = self.add_own_features(clean).select(KEY, "embedding", *OWN_SEMANTIC)
        return combine([own, self.neighbours(own)], KEY)

    def save(self, spark: SparkSession, path: str) -> None:
        self.scaler.to_frame(spark).write.mode("overwrite").parquet(f"{path}/scaler")
        save_bank(self.bank, f"{path}/bank")
        self.indexed().save(spark, f"{path}/index")
        mean = spark.createDataFrame([(self.mean_rating,)], "mean_rating double")
        mean.write.mode("overwrite").parquet(f"{path}/mean")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SemanticBlock:
        bank = load_bank(spark, f"{path}/bank")
        mean = spark.read.parquet(f"{path}/mean").first().mean_rating
        index = similarity.NeighbourIndex.load(spark, f"{path}/index")
        return cls(VectorScaler.from_frame(spark.read.parquet(f"{path}/scaler")), bank, mean, index)


def neighbour_aggregates(neighbours: DataFrame, mean_rating: float | None) -> DataFrame:
    """All rating aggregates in one group-by over the ranked neighbours."""
    return similarity.aggregate(
        neighbours,
        similarity.rating_stats(),
        similarity.multiscale(mean_rating),
        similarity.rating_distribution(),
    )
