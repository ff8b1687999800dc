"""JSON-lines scan of book records."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

BOOK_SCHEMA = T.StructType([
    T.StructField("book_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("authors", T.StringType()),
    T.StructField("num_pages", T.StringType()),
    T.StructField("ratings_count", T.StringType()),
    T.StructField("text_reviews_count", T.StringType()),
    T.StructField("average_rating", T.StringType()),
    T.StructField("publication_date", T.StringType()),
    T.StructField("publish_date", T.StringType()),
    T.StructField("language_code", T.StringType()),
    T.StructField("popular_shelves", T.ArrayType(T.StructType([
        T.StructField("count", T.StringType()), T.StructField("name", T.StringType()),
    ]))),
    T.StructField("genres", T.StringType()),
])

REVIEW_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("book_id", T.StringType()),
    T.StructField("review_id", T.StringType()),
    T.StructField("rating", T.LongType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("date_added", T.StringType()),
    T.StructField("date_updated", T.StringType()),
    T.StructField("read_at", T.StringType()),
    T.StructField("started_at", T.StringType()),
    T.StructField("n_votes", T.LongType()),
    T.StructField("n_comments", T.LongType()),
])


def scan_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType = BOOK_SCHEMA,
    sample_size: int | None = None,
) -> DataFrame:
    """Read JSON lines and skip malformed ones. ``sample_size`` is a budget of lines in file
    order which malformed lines use up too; None or 0 reads everything.

    Lines are parsed by an expression, so that any set of columns can be asked for, even
    none, which the file reader refuses next to a record of malformed input.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = first_lines(spark, path, sample_size) if sample_size else spark.read.text(path)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.select(F.from_json("value", wide, options).alias("r"))
    sound = F.col("r").isNotNull() & F.col(f"r.{CORRUPT}").isNull()
    return parsed.where(sound).select(*[F.col("r")[f].alias(f) for f in schema.fieldNames()])


def scan_json_any(spark: SparkSession, path: str, sample_size: int | None = None) -> DataFrame:
    """Read JSON lines whose keys are not known beforehand: one column per key that any record has.

    Lines that hold no JSON object, or one with a repeated key, are skipped; ``sample_size`` is as in
    ``scan_json``. The first pass merges the schemas of all records, so a key counts that the last
    record alone has; the second gives every value its type. Objects become structs, at any
    depth. A key whose values have types that do not go together is a VARIANT column, as is one
    with empty objects only, and one with nulls only is text. Keys that differ in case only need
    ``spark.sql.caseSensitive``. Without records there are no columns. The merged schema, one
    entry per key, is what comes to the driver.
    """
    lines = first_lines(spark, path, sample_size) if sample_size else spark.read.text(path)
    parsed = lines.select(F.try_parse_json("value").alias("v"))
    objects = parsed.where(F.try_variant_get("v", "$", "map<string, variant>").isNotNull())
    merged = objects.agg(F.schema_of_variant_agg("v")).first()[0]
    if not merged.startswith("OBJECT<") or merged == "OBJECT<>":
        return objects.select()
    return objects.select(F.try_variant_get("v", "$", column_type(merged)).alias("r")).select("r.*")


# names in backticks are left alone, and a bare name is followed by a colon
_VARIANT_TYPE = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<>|\bOBJECT<|\bVOID\b(?!:)")
_COLUMN_TYPE = {"OBJECT<>": "VARIANT", "OBJECT<": "STRUCT<", "VOID": "STRING"}


def column_type(variant_type: str) -> str:
    """The type of a column that holds what a variant's schema describes."""
    return _VARIANT_TYPE.sub(lambda m: _COLUMN_TYPE.get(m[0], m[0]), variant_type)


def first_lines(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first n lines in order of file path and place in the file.

    Lines are counted per split of a file; what comes before a split follows from a running sum
    over splits, of which there are few. No task takes all n lines, and splits behind the n-th line
    are dropped by a join.
    """
    where = {"file": F.col("_metadata.file_path"), "block": F.col("_metadata.file_block_start")}
    # lines of a split are read in order by one task, so their ids ascend without gaps
    lines = spark.read.text(path).withColumns(where).withColumn("at", F.monotonically_increasing_id())
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    running = F.sum("n").over(Window.orderBy("file", "block")) - F.col("n")
    blocks = blocks.withColumn("before", running).where(F.col("before") < n)
    rank = F.col("before") + F.col("at") - F.col("first")
    return lines.join(blocks.drop("n"), ["file", "block"]).where(rank < n).select("value")


def first_rows(df: DataFrame, n: int | None, key: str) -> DataFrame:
    """First n rows by key (a distributed top-n, not a full sort); None or 0 keeps all."""
    return df.orderBy(key).limit(n) if n else df
