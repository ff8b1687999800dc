"""Queries over nearest neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import similarity
from ..plans.blocks import OWN_SEMANTIC, SemanticBlock
from ..plans.flagship import language_report
from ..sources import tables
from ..sources.workspace import new_path
from . import sql as q
from .common import clean_embedded, rated_bank
from .registry import KEY, query, r6
from .text_queries import AGE_LEVEL, BOOK_TEXT, TEXT_QUALITY

BANK_SQL = """
SELECT book_id, CAST(embedding AS DOUBLE[]) AS v, average_rating AS rating
FROM books JOIN embeddings ON vec_id = book_id WHERE average_rating IS NOT NULL
"""


def near_sql(bank: str = "bank", queries: str = "bank", k: int = 20) -> str:
    return f"""
SELECT * FROM (SELECT q.book_id, b.book_id AS neighbour_id, b.rating,
  round(list_cosine_similarity(q.v, b.v), 9) AS similarity,
  CAST(row_number() OVER (PARTITION BY q.book_id
    ORDER BY round(list_cosine_similarity(q.v, b.v), 9) DESC, b.book_id) AS INTEGER) AS rn
  FROM {queries} q JOIN {bank} b ON b.book_id <> q.book_id) WHERE rn <= {k}
"""


def over_near(body: str, **more: str) -> str:
    return q.over_books(body, bank=BANK_SQL, near=near_sql(), **more)


TOPK_SQL = over_near(
    f"SELECT book_id, rn, neighbour_id, {q.r6('similarity')} AS similarity FROM near"
)


def topk(found):
    return found.select(KEY, "rn", "neighbour_id", r6("similarity").alias("similarity"))


def rounded_frame(df):
    return df.select(KEY, *[r6(c).alias(c) for c in df.columns if c != KEY])


@query("knn_topk", TOPK_SQL)
def knn_topk(spark, sf):
    bank = rated_bank(spark, sf)
    return topk(similarity.knn(bank, bank, 20))


@query("knn_pruned", TOPK_SQL)
def knn_pruned(spark, sf):
    """The same join with small blocks: cells are built, and skipped where they cannot matter."""
    bank = rated_bank(spark, sf)
    return topk(similarity.knn(bank, bank, 20, block_rows=256))


@query("knn_indexed", TOPK_SQL)
def knn_indexed(spark, sf):
    """The same join from an index with cells that was saved and loaded again."""
    bank, path = rated_bank(spark, sf), new_path(spark, "index")
    similarity.build_index(bank, 20, block_rows=256).save(spark, path)
    return topk(similarity.search(bank, similarity.NeighbourIndex.load(spark, path), 20))


# Ten neighbouring ids share the whole vector of the first of them, so that similarities tie.
COPIES_SQL = """
SELECT book_id, CAST(e.embedding AS DOUBLE[]) AS v, average_rating AS rating
FROM books JOIN embeddings own ON own.vec_id = book_id
  JOIN embeddings e ON e.vec_id = book_id - book_id % 10 WHERE average_rating IS NOT NULL
"""


# Vectors that cannot be compared: null, with NaN or a null place, longer and shorter ones.
DIRTY = """CASE WHEN book_id % 50 = 1 THEN NULL
  WHEN book_id % 50 = 2 THEN transform(embedding, (x, i) -> IF(i = 3, CAST('NaN' AS FLOAT), x))
  WHEN book_id % 50 = 3 THEN transform(embedding, (x, i) -> IF(i = 5, CAST(NULL AS FLOAT), x))
  WHEN book_id % 50 = 4 THEN concat(embedding, array(CAST(1 AS FLOAT)))
  WHEN book_id % 50 = 5 THEN slice(embedding, 1, 1) ELSE embedding END"""


@query(
    "knn_dirty_vectors",
    q.over_books(
        f"SELECT book_id, rn, neighbour_id, {q.r6('similarity')} AS similarity FROM near",
        bank=f"SELECT * FROM ({BANK_SQL}) WHERE book_id % 50 NOT IN (1, 2, 3, 4, 5)",
        near=near_sql(),
    ),
)
def knn_dirty_vectors(spark, sf):
    """Rows whose vectors cannot be compared are no queries and no neighbours."""
    bank = rated_bank(spark, sf).withColumn("embedding", F.expr(DIRTY))
    return topk(similarity.knn(bank, bank, 20))


@query(
    "unsound_vectors",
    q.over_books(
        "SELECT count(*) AS n_vectors, count(*) FILTER (WHERE book_id % 50 = 1) AS n_null, "
        "count(*) FILTER (WHERE book_id % 50 IN (2, 3)) AS n_not_finite, "
        "count(*) FILTER (WHERE book_id % 50 IN (4, 5)) AS n_other_width "
        f"FROM ({BANK_SQL})"
    ),
)
def unsound_vectors(spark, sf):
    return similarity.unsound(rated_bank(spark, sf).withColumn("embedding", F.expr(DIRTY)))


@query(
    "knn_copies",
    q.over_books(
        f"SELECT book_id, rn, neighbour_id, {q.r6('similarity')} AS similarity FROM near",
        bank=COPIES_SQL,
        near=near_sql(),
    ),
)
def knn_copies(spark, sf):
    """Neighbours where many vectors are equal."""
    bank = rated_bank(spark, sf)
    vectors = tables.table(spark, sf, "embeddings")
    first = vectors.select(F.col("vec_id").alias("first"), F.col("embedding").alias("shared"))
    bank = bank.join(first, bank.book_id - bank.book_id % 10 == F.col("first"))
    bank = bank.select(KEY, F.col("shared").alias("embedding"), "average_rating")
    return topk(similarity.knn(bank, bank, 20))


STATS_SQL = {
    "k20_mean_similar_rating": "avg(rating)",
    "k20_std_similar_rating": "stddev_pop(rating)",
    "k20_median_similar_rating": "median(rating)",
    "k20_max_similarity": "max(similarity)",
    "k20_mean_similarity": "avg(similarity)",
}
MULTI_SQL = {}
for _k in (5, 10, 20):
    _in = f"FILTER (WHERE rn <= {_k})"
    MULTI_SQL[f"weighted_similar_rating_k{_k}"] = (
        f"CASE WHEN sum(similarity) {_in} > 0 "
        f"THEN sum(similarity * rating) {_in} / sum(similarity) {_in} "
        "ELSE (SELECT avg(rating) FROM bank) END"
    )
    MULTI_SQL[f"mean_similarity_k{_k}"] = f"avg(similarity) {_in}"
    MULTI_SQL[f"max_similarity_k{_k}"] = f"max(similarity) {_in}"
_IN10 = "FILTER (WHERE rn <= 10)"
DISTRIBUTION_SQL = {
    "s10_mean_similar_rating": f"avg(rating) {_IN10}",
    "s10_median_similar_rating": f"median(rating) {_IN10}",
    "s10_std_similar_rating": f"stddev_pop(rating) {_IN10}",
    "s10_similar_rating_q25": f"quantile_cont(rating, 0.25) {_IN10}",
    "s10_similar_rating_q75": f"quantile_cont(rating, 0.75) {_IN10}",
    "s10_similar_rating_range": f"max(rating) {_IN10} - min(rating) {_IN10}",
}


def per_query(columns: dict[str, str]) -> str:
    return over_near(f"SELECT book_id, {q.named(columns, 'double')} FROM near GROUP BY book_id")


def neighbours(spark, sf):
    bank = rated_bank(spark, sf)
    return bank, similarity.knn(bank, bank, 20)


@query("knn_rating_stats", per_query(STATS_SQL))
def knn_rating_stats(spark, sf):
    _, found = neighbours(spark, sf)
    return rounded_frame(similarity.aggregate(found, similarity.rating_stats()))


@query(
    "knn_without_ratings",
    per_query({n: e if n.endswith("max_similarity") else "0" for n, e in STATS_SQL.items()}),
)
def knn_without_ratings(spark, sf):
    bank = rated_bank(spark, sf)
    unrated = bank.withColumn("average_rating", F.lit(None).cast("double"))
    found = similarity.knn(bank, unrated, 20)
    return rounded_frame(similarity.aggregate(found, similarity.rating_stats(rated=False)))


@query("knn_multiscale", per_query(MULTI_SQL))
def knn_multiscale(spark, sf):
    bank, found = neighbours(spark, sf)
    mean = bank.agg(F.avg("average_rating")).first()[0]
    return rounded_frame(similarity.aggregate(found, similarity.multiscale(mean)))


@query("knn_rating_distribution", per_query(DISTRIBUTION_SQL))
def knn_rating_distribution(spark, sf):
    _, found = neighbours(spark, sf)
    return rounded_frame(similarity.aggregate(found, similarity.rating_distribution()))


@query(
    "bank_sample",
    q.over_books(
        "SELECT book_id, average_rating FROM books WHERE average_rating IS NOT NULL "
        "ORDER BY ((book_id % 2147483647) * 48271) % 2147483647, book_id LIMIT 1000"
    ),
)
def bank_sample(spark, sf):
    rated = tables.books(spark, sf).where("average_rating IS NOT NULL")
    return similarity.bank_sample(rated.select(KEY, "average_rating"))


SCALED_SQL = """
SELECT book_id, title, description, rating, list(CAST(x AS FLOAT) ORDER BY position) AS v
FROM (SELECT book_id, title, description, rating, position,
    coalesce((x - avg(x) OVER (PARTITION BY position))
      / nullif(stddev_pop(x) OVER (PARTITION BY position), 0), 0) AS x
  FROM (SELECT book_id, title, description, average_rating AS rating,
      unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS position
    FROM books JOIN embeddings ON vec_id = book_id))
GROUP BY book_id, title, description, rating
"""
_AGGREGATES = {**STATS_SQL, **MULTI_SQL, **DISTRIBUTION_SQL}


@query(
    "semantic_block",
    q.over_books(
        f"SELECT book_id, {q.named(TEXT_QUALITY, 'exact')}, "
        f"CAST({AGE_LEVEL.replace('contains(x', 'contains(lower(x)')} AS INTEGER) "
        "AS estimated_age_level, "
        + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _AGGREGATES)
        + f" FROM (SELECT book_id, {BOOK_TEXT} AS x FROM books) LEFT JOIN found USING (book_id)",
        scaled=SCALED_SQL,
        wide="SELECT book_id, rating, CAST(v AS DOUBLE[]) AS v FROM scaled",
        bank="SELECT * FROM wide WHERE rating IS NOT NULL",
        near=near_sql("bank", "wide"),
        found=f"SELECT book_id, {q.named(_AGGREGATES, 'double')} FROM near GROUP BY book_id",
    ),
)
def semantic_block(spark, sf):
    """All semantic features of every book, the vector itself left out; books without a vector have
    no neighbours."""
    clean = clean_embedded(spark, sf)
    block = SemanticBlock().fit(clean).transform(clean).drop("embedding")
    near = [c for c in block.columns if c not in (KEY, *OWN_SEMANTIC)]
    return block.select(KEY, *OWN_SEMANTIC, *[r6(c).alias(c) for c in near])


FLAGSHIP_SQL = q.cte(
    {
        "every": tables.BOOKS_SQL,
        "books": "SELECT * FROM every WHERE regexp_matches(lower(popular_shelves), "
        f"'{q.lx.CATEGORY_PATTERN}')",
        "clean": q.CLEAN_SQL,
        "chosen": "SELECT * FROM clean WHERE average_rating BETWEEN 2 AND 5 "
        "AND ratings_count >= 15 AND length(description) > 30",
        "bank": "SELECT book_id, CAST(embedding AS DOUBLE[]) AS v, average_rating AS rating "
        "FROM chosen JOIN embeddings ON vec_id = book_id",
        "near": near_sql(),
        "found": "SELECT book_id, avg(rating) AS mean_similar_rating, "
        "max(similarity) AS max_similarity FROM near GROUP BY book_id",
        "scored": "SELECT *, "
        + " + ".join(
            f"{w} * {q.present(q.FULL, q.lx.QUALITY_LEXICON[n])}"
            for n, w in q.lx.QUALITY_WEIGHTS.items()
        )
        + f" AS quality, {q.words(q.D)} AS n_words FROM chosen LEFT JOIN found USING (book_id)",
    },
    "SELECT coalesce(language_code, 'en') AS language_code, count(*) AS n_books, "
    "count(mean_similar_rating) AS n_with_neighbours, "
    + q.named(
        {
            "avg_rating": "avg(average_rating)",
            "avg_words": "avg(n_words)",
            "avg_quality_score": "avg(quality)",
            "avg_similar_rating": "avg(mean_similar_rating)",
            "top_similarity": "max(max_similarity)",
        },
        "double",
    )
    + " FROM scored GROUP BY 1",
)


@query("flagship", FLAGSHIP_SQL)
def flagship(spark, sf):
    vectors = tables.table(spark, sf, "embeddings").selectExpr("vec_id AS book_id", "embedding")
    report = language_report(tables.books(spark, sf), vectors)
    plain = ("language_code", "n_books", "n_with_neighbours")
    return report.select(*plain, *[r6(c).alias(c) for c in report.columns if c not in plain])
