"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Each level only looks at rows that an earlier one could not tell apart. The first two levels read
a narrow table written in one scan; the full content is hashed only for rows that share length and
prefix with another row. Equal rows are summed up before any shuffle, and decisions come back by a
join with one row per group, so that a hot group is split like any other skewed join side.

Null text counts as empty, and empty texts are copies of one another. A repeated row counts in
group_size; all rows of a group with the id that stays are kept. Rows without an id count like others,
but lose ties. An id that several texts share is decided on for each text alone. Other columns are
ignored by ``decide`` and passed on by ``deduplicate``. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import cut
from .common import SPACE, text_key, without

PREFIX = 64
KEY = ["n_norm", "head"]


def normalised(text: str = "text") -> Column:
    """The text without any character of [\\x20\\x09-\\x0D]."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), SPACE, "")


def _facts(docs: DataFrame, *more: Column) -> DataFrame:
    norm = normalised()
    return docs.select(
        "doc_id",
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        F.length(norm).alias("n_norm"),
        F.xxhash64(F.substring(norm, 1, PREFIX)).alias("head"),
        norm.alias("norm"),
        *more,
    )


def _prefixes(facts: DataFrame) -> DataFrame:
    """Lengths and prefixes that several rows share."""
    by_length = facts.groupBy("n_norm").count().where("count > 1").select("n_norm")
    by_prefix = facts.join(by_length, "n_norm", "left_semi").groupBy(*KEY).count().where("count > 1").select(*KEY)
    return cut(by_prefix, "dedup-prefixes")


def _refined(docs: DataFrame, by_prefix: DataFrame, *more: Column) -> DataFrame:
    """Rows that share length and prefix with another one, with the size of their group and the id
    that stays (null where the row is alone); ``more`` columns are made next to them."""
    survivors = _facts(docs, *more).join(by_prefix, KEY, "left_semi").drop(*KEY)
    hashed = cut(survivors.withColumn("text_sha256", F.sha2(F.col("norm"), 256)).drop("norm"), "dedup-hashed")
    best = F.max(F.struct("n_chars", (-F.col("doc_id")).alias("minus"))).alias("best")
    groups = hashed.groupBy("text_sha256").agg(F.count("*").alias("group_size"), best)
    groups = groups.select("text_sha256", "group_size", (-F.col("best.minus")).alias("keep_id"))
    return hashed.join(groups.where("group_size > 1"), "text_sha256", "left")


def decide(docs: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of doc_id, text.

    text_sha256 is null for rows that are told apart without a full hash, unless ``digest``.
    """
    early = F.sha2(F.col("norm"), 256) if digest else F.lit(None).cast("string")
    facts = cut(_facts(docs).select("doc_id", "n_chars", *KEY, early.alias("text_sha256")), "dedup-facts")
    by_prefix = _prefixes(facts)
    refined = _refined(docs, by_prefix)
    alone = facts.join(by_prefix, KEY, "left_anti").withColumns(
        {"group_size": F.lit(None).cast("long"), "keep_id": F.lit(None).cast("long")}
    )
    columns = ["doc_id", "text_sha256", "group_size", "keep_id"]
    every = refined.select(*columns).unionByName(alone.select(*columns))
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return every.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = docs.select("doc_id", "text")
    by_prefix = _prefixes(cut(_facts(rows).select(*KEY), "dedup-facts"))
    grouped = _refined(rows, by_prefix, text_key().alias("key")).where("group_size > 1")
    return without(docs, grouped.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))))
