"""Flagship report: per language, ratings next to lexicon quality and neighbour ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import cleaning, similarity


def language_report(books: DataFrame, vectors: DataFrame) -> DataFrame:
    """``books`` are raw records, ``vectors`` has (book_id, embedding)."""
    chosen = cleaning.category_filter(books)
    clean = cleaning.quality_filter(cleaning.preprocess(chosen))
    scored = clean.select(
        "book_id",
        F.coalesce("language_code", F.lit("en")).alias("language_code"),
        "average_rating",
        text.desc_stats()["desc_word_count"].alias("desc_word_count"),
        text.weighted_quality(text.full_text())["llm_quality_score"].alias("llm_quality_score"),
    )
    bank = clean.select("book_id", "average_rating").join(vectors, "book_id")
    found = similarity.knn(bank.select("book_id", "embedding"), bank, k=20)
    near = similarity.aggregate(found, similarity.rating_stats(prefix=""))
    return (
        scored.join(near, "book_id", "left")
        .groupBy("language_code")
        .agg(
            F.count("*").alias("n_books"),
            F.count("mean_similar_rating").alias("n_with_neighbours"),
            F.avg("average_rating").alias("avg_rating"),
            F.avg("desc_word_count").alias("avg_words"),
            F.avg("llm_quality_score").alias("avg_quality_score"),
            F.avg("mean_similar_rating").alias("avg_similar_rating"),
            F.max("max_similarity").alias("top_similarity"),
        )
    )
