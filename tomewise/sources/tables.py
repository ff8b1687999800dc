"""Views over the driver tables, in the shapes the operators expect.

The SQL bodies run unchanged on Spark and on the oracle engine. ``documents`` has no
titles, ratings or dates: a title is the opening of the text and the description is the whole
text (every sixteenth book has no description and its whole text as title), and the other attributes follow from the row id, with keyword hits and
nulls planted so that every branch of the operators is met.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .workspace import spread

BOOKS_SQL = """
SELECT doc_id AS book_id,
  concat(CASE WHEN doc_id % 16 = 7 THEN text ELSE substring(text, 1, 40) END, CASE doc_id % 6 WHEN 0 THEN ' #3' WHEN 1 THEN ': Book 2'
    WHEN 2 THEN ' for Young Kids!' WHEN 3 THEN '?' WHEN 4 THEN ' Picture Book Set'
    ELSE '' END) AS title,
  CASE WHEN doc_id % 16 = 7 THEN NULL ELSE concat(text, CASE doc_id % 8
    WHEN 0 THEN ' An award winner full of fun and adventure.'
    WHEN 1 THEN ' Learn counting: a lesson for age 5, 5 years old.'
    WHEN 2 THEN ' A boring and scary story.'
    WHEN 3 THEN ' Perfect for kindergarten. A magical journey of family and friends!'
    WHEN 4 THEN ' Graphic comic; funny, fun, funny.' ELSE '' END) END AS description,
  CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CAST(8 + (doc_id * 37) % 600 AS DOUBLE) END AS num_pages,
  CAST((doc_id * 7919) % 5000 AS DOUBLE) AS ratings_count,
  CAST((doc_id * 104729) % 300 AS DOUBLE) AS text_reviews_count,
  CASE WHEN doc_id % 29 = 0 THEN NULL
    ELSE CAST(150 + (doc_id * 613) % 350 AS DOUBLE) / CAST(100 AS DOUBLE) END AS average_rating,
  CASE WHEN doc_id % 13 = 0 THEN NULL
    ELSE concat(CAST(1940 + (doc_id * 17) % 84 AS VARCHAR(4)), '-06-15') END AS publication_date,
  CASE WHEN doc_id % 17 = 0 THEN NULL ELSE lang END AS language_code,
  CASE doc_id % 4 WHEN 0 THEN 'children,picture-book' WHEN 1 THEN 'kids,fiction'
    WHEN 2 THEN 'young-adult' ELSE 'mystery,thriller' END AS popular_shelves,
  CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'A. One' ELSE 'A. One,B. Two' END AS authors
FROM documents
"""

# One row per order taken as one training run of one of five experiments.
RUNS_SQL = """
SELECT o_orderkey AS run_id, o_custkey % 5 AS experiment, o_orderdate AS start_time,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL
    ELSE CAST(o_orderkey % 400 AS DOUBLE) / CAST(1000 AS DOUBLE) END AS best_r2,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL
    ELSE CAST((o_orderkey * 31) % 390 AS DOUBLE) / CAST(1000 AS DOUBLE) END AS test_r2
FROM orders
"""

# Artifacts of a run are its order lines.
ARTIFACTS_SQL = """
SELECT l_orderkey AS run_id, l_linenumber AS position,
  concat(CASE l_linenumber % 3 WHEN 1 THEN 'feature_importance' WHEN 2 THEN 'best_Model'
    ELSE 'model' END, '_', CAST(l_suppkey % 10 AS VARCHAR(4))) AS artifact
FROM lineitem
"""

# Registered versions: one per order, ascending but with gaps, of fifty models.
VERSIONS_SQL = """
SELECT concat('predictor-', CAST(o_custkey % 50 AS VARCHAR(4))) AS model_name,
  o_orderkey AS version, o_orderkey AS run_id,
  CASE WHEN o_orderstatus = 'F' THEN 'Archived' WHEN o_orderkey % 9 = 0 THEN 'Production'
    ELSE 'None' END AS stage
FROM orders
"""

VIEWS = {
    "books": BOOKS_SQL, "runs": RUNS_SQL, "artifacts": ARTIFACTS_SQL, "versions": VERSIONS_SQL,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents"), "doc_id")
    return spark.sql(_over(BOOKS_SQL, "documents"), documents=documents)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_over(RUNS_SQL, "orders"), orders=table(spark, sf_dir, "orders"))


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_over(ARTIFACTS_SQL, "lineitem"), lineitem=table(spark, sf_dir, "lineitem"))


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_over(VERSIONS_SQL, "orders"), orders=table(spark, sf_dir, "orders"))


def embedded_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books that have a vector, with it."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    b = books(spark, sf_dir)
    return b.join(vectors, b.book_id == vectors.vec_id).drop("vec_id")


def _over(sql: str, source: str) -> str:
    return sql.replace(f"FROM {source}", "FROM {" + source + "}")
