"""Frames that many queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import cleaning
from ..plans.blocks import traditional_features
from ..sources import tables


def clean_books(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.preprocess(tables.books(spark, sf))


def feature_frame(spark: SparkSession, sf: str) -> DataFrame:
    return traditional_features(clean_books(spark, sf))


def clean_embedded(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned books, each with its vector where it has one."""
    vectors = tables.table(spark, sf, "embeddings").selectExpr("vec_id AS book_id", "embedding")
    return clean_books(spark, sf).join(vectors, "book_id", "left")


def rated_bank(spark: SparkSession, sf: str) -> DataFrame:
    bank = tables.embedded_books(spark, sf).where("average_rating IS NOT NULL")
    return bank.select("book_id", "embedding", "average_rating")
