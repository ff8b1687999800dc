"""Queries over readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..operators.matrix import align
from ..operators.registry import MetricsLog
from ..sources import catalog, sinks, tables
from ..sources.workspace import new_path
from . import sql as q
from .common import clean_books
from .registry import KEY, query, r6


@query(
    "scan_json",
    q.over_books(
        "SELECT book_id, title, description, CAST(num_pages AS VARCHAR) AS num_pages, "
        "language_code, popular_shelves AS shelf_name FROM books"
    ),
)
def scan_json(spark: SparkSession, sf: str) -> DataFrame:
    """All books written as JSON lines, with a malformed line after every tenth, read back."""
    books = tables.books(spark, sf)
    shelf = F.array(F.struct(F.lit("1").alias("count"), F.col("popular_shelves").alias("name")))
    line = F.to_json(
        F.struct(
            KEY,
            "title",
            "description",
            F.col("num_pages").cast("string").alias("num_pages"),
            "language_code",
            shelf.alias("popular_shelves"),
        )
    )
    bad = F.when(F.col(KEY) % 10 == 0, F.concat(F.lit('{"book_id": '), F.col(KEY), F.lit(", BAD")))
    path = new_path(spark, "books-json")
    books.select(F.explode(F.array_compact(F.array(line, bad))).alias("value")).write.text(path)
    return catalog.scan_json(spark, path).select(
        KEY,
        "title",
        "description",
        "num_pages",
        "language_code",
        F.col("popular_shelves")[0]["name"].alias("shelf_name"),
    )


_PAGES = "CAST(CAST(num_pages AS BIGINT) AS VARCHAR)"


@query(
    "scan_json_any",
    q.over_books(
        f"SELECT book_id, title, CASE WHEN book_id % 5 = 0 THEN 'p' || {_PAGES} ELSE {_PAGES} END AS pages, "
        "average_rating AS average, CAST(ratings_count AS BIGINT) AS ratings, "
        "CASE WHEN book_id % 97 = 96 THEN book_id % 2 = 0 END AS late_key, "
        "CASE WHEN book_id % 3 = 1 THEN popular_shelves END AS deep FROM books"
    ),
)
def scan_json_any(spark: SparkSession, sf: str) -> DataFrame:
    """All books written with nested keys, a key of two types, keys that few records have, and
    malformed lines; read back without a schema."""
    books = tables.books(spark, sf)
    shelf = F.array(F.struct(F.col("popular_shelves").alias("the name")))
    pages = F.col("num_pages").cast("long")
    rating = F.struct(F.col("average_rating").alias("average"), F.col("ratings_count").alias("count"))

    def line(value):
        return F.to_json(
            F.struct(
                KEY,
                "title",
                value.alias("pages"),
                rating.alias("rating"),
                F.when(F.col(KEY) % 97 == 96, F.col(KEY) % 2 == 0).alias("late key"),
                F.when(F.col(KEY) % 3 == 1, F.struct(shelf.alias("shelves"))).alias("VOID"),
            )
        )

    lines = F.when(F.col(KEY) % 5 == 0, line(F.concat(F.lit("p"), pages))).otherwise(line(pages))
    bad = F.when(F.col(KEY) % 10 == 0, F.concat(F.lit('{"book_id": '), F.col(KEY), F.lit(", BAD")))
    path = new_path(spark, "any-json")
    books.select(F.explode(F.array_compact(F.array(lines, bad))).alias("value")).write.text(path)
    return catalog.scan_json_any(spark, path).select(
        KEY,
        "title",
        F.col("pages").cast("string").alias("pages"),
        F.col("rating.average").cast("double").alias("average"),
        F.col("rating.count").cast("long").alias("ratings"),
        F.col("late key").alias("late_key"),
        F.col("VOID")["shelves"][0]["the name"].alias("deep"),
    )


@query(
    "prefix_limit",
    q.over_books("SELECT book_id, title FROM books ORDER BY book_id LIMIT 100"),
)
def prefix_limit(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.first_rows(tables.books(spark, sf).select(KEY, "title"), 100, KEY)


@query(
    "prefix_limit_json",
    q.over_books(
        "SELECT book_id, title FROM (SELECT *, row_number() OVER (ORDER BY book_id % 3, book_id) AS rn "
        "FROM books) WHERE rn <= 150 AND book_id % 7 <> 0"
    ),
)
def prefix_limit_json(spark: SparkSession, sf: str) -> DataFrame:
    """The first 150 lines of three folders, of which malformed ones use up the budget too.

    The files of each folder hold ranges of the key, so that their order is that of the lines.
    """
    books, path = tables.books(spark, sf), new_path(spark, "files-json")
    line = F.to_json(F.struct(KEY, "title"))
    line = F.when(F.col(KEY) % 7 == 0, F.concat(F.lit("BAD "), line)).otherwise(line)
    for i in range(3):
        part = books.where(F.col(KEY) % 3 == i).repartitionByRange(KEY).sortWithinPartitions(KEY)
        part.select(line.alias("value")).write.text(f"{path}/{i}")
    return catalog.scan_json(spark, f"{path}/*", sample_size=150).select(KEY, "title")


BANK = "books JOIN embeddings ON vec_id = book_id"


@query(
    "bank_roundtrip",
    q.over_books(
        "SELECT book_id, average_rating, CAST(len(embedding) AS INTEGER) AS width, "
        + q.r6("list_sum(CAST(embedding AS DOUBLE[]))")
        + f" AS total FROM {BANK} WHERE average_rating IS NOT NULL"
    ),
)
def bank_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "bank")
    sinks.save_bank(tables.embedded_books(spark, sf).where("average_rating IS NOT NULL"), path)
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x)
    return sinks.load_bank(spark, path).select(
        KEY, "average_rating", F.size("embedding").alias("width"), r6(total).alias("total")
    )


@query(
    "feature_manifest",
    q.over_clean(
        " UNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS feature, "
            f"count(*) FILTER (WHERE {c} <> 0) AS n_nonzero FROM clean"
            for i, c in enumerate(lx.BASE_NUMERIC)
        )
    ),
)
def feature_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest written, read back in order, and used to lay out the matrix."""
    path = new_path(spark, "manifest")
    sinks.save_manifest(spark, lx.BASE_NUMERIC, path)
    features = sinks.load_manifest(spark, path)
    matrix = align(clean_books(spark, sf), features)
    counts = matrix.agg(*[F.count_if(F.col(c) != 0).alias(c) for c in features])
    parts = ", ".join(f"{i}, '{c}', {c}" for i, c in enumerate(features))
    return counts.selectExpr(f"stack({len(features)}, {parts}) AS (position, feature, n_nonzero)")


@query(
    "metrics_log",
    q.over_runs(
        "SELECT CAST(run_id AS VARCHAR) AS run_id, 'best_r2' AS key, best_r2 AS value FROM runs "
        "WHERE best_r2 IS NOT NULL UNION ALL "
        "SELECT CAST(run_id AS VARCHAR), 'test_r2', test_r2 FROM runs WHERE test_r2 IS NOT NULL"
    ),
)
def metrics_log(spark: SparkSession, sf: str) -> DataFrame:
    """Both metrics of all runs, each committed by a job that runs twice."""
    runs, log = tables.runs(spark, sf), MetricsLog(spark, new_path(spark, "metrics"))
    for key in ("best_r2", "test_r2", "best_r2", "test_r2"):
        rows = runs.where(F.col(key).isNotNull()).select(
            F.col("run_id").cast("string").alias("run_id"),
            F.lit(key).alias("key"),
            F.col(key).alias("value"),
            F.current_timestamp().alias("ts"),
        )
        log.append(rows, "all", key)
    return log.read().drop("ts")
