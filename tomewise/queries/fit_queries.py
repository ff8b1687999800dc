"""Queries over fitted transforms."""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..functions.numeric import AS241
from ..operators import distribution, scaling, selection, text_vectors
from ..operators.encoding import fit_label_codes, label_encode
from ..plans.blocks import TraditionalBlock
from ..sources import tables
from ..sources.workspace import cut, new_path
from . import sql as q
from .common import clean_books, feature_frame
from .registry import KEY, query, r6
from .sql import D, T

# ------------------------------------------------------------------------ TF-IDF
_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in lx.ENGLISH_STOP_WORDS)


def _terms_sql(x: str) -> str:
    return f"""
SELECT book_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])))
  AS term
FROM (SELECT book_id, list_filter(regexp_extract_all(lower({x}), '{lx.TOKEN}'),
  lambda w: w NOT IN ({_STOP})) AS t FROM books)
"""


def _top_terms_sql(size: int) -> str:
    return (
        "SELECT term, count(*) AS tf, count(DISTINCT book_id) AS df FROM terms GROUP BY term "
        f"HAVING count(DISTINCT book_id) >= 2 ORDER BY tf DESC, term LIMIT {size}"
    )


_N = "(SELECT count(*) FROM books)"
_IDF = f"(ln((1 + {_N}) / CAST(1 + df AS DOUBLE)) + 1)"


@query(
    "tfidf_terms",
    q.over_books(
        f"SELECT term, CAST(df AS BIGINT) AS df, {q.r6(_IDF)} AS idf FROM top",
        terms=_terms_sql(D),
        top=_top_terms_sql(lx.DESC_VOCABULARY),
    ),
)
def tfidf_terms(spark, sf):
    books = tables.books(spark, sf)
    wanted = {"description": (text_vectors.description_source(), lx.DESC_VOCABULARY)}
    fitted = text_vectors.fit_tfidf(books, wanted)["description"]
    rows = list(zip(fitted.vocabulary, fitted.doc_freq, fitted.idf))
    frame = spark.createDataFrame(rows, "term string, df long, idf double")
    return frame.withColumn("idf", r6("idf"))


@query(
    "tfidf_weights",
    q.over_books(
        "SELECT book_id, term, "
        + q.r6("w / sqrt(sum(w * w) OVER (PARTITION BY book_id))")
        + " AS weight FROM weighted",
        terms=_terms_sql(T),
        top=_top_terms_sql(lx.TITLE_VOCABULARY),
        weighted=f"SELECT book_id, term, count(*) * any_value({_IDF}) AS w "
        "FROM terms JOIN top USING (term) GROUP BY book_id, term",
    ),
)
def tfidf_weights(spark, sf):
    books, source = tables.books(spark, sf), text_vectors.title_source()
    fitted = text_vectors.fit_tfidf(books, {"title": (source, lx.TITLE_VOCABULARY)})["title"]
    weights = fitted.transform(books.select(KEY, "title"), source)
    long = weights.select(KEY, F.posexplode("tfidf").alias("i", "w")).where(F.col("w") > 0)
    terms = F.element_at(F.lit(np.array(fitted.vocabulary)), F.col("i") + 1)
    return long.select(KEY, terms.alias("term"), r6("w").alias("weight"))


def gram_facts(df, parts):
    """Per pair of components, the products of their projections over the product of their singular
    values: 1 on the diagonal, 0 beside it."""
    out = None
    for name, s in parts.items():
        n = len(s)
        sums = [
            F.sum(F.col(name)[i] * F.col(name)[j]) / (s[i] * s[j]) for i in range(n) for j in range(n)
        ]
        row = df.agg(F.array(*sums).alias("v")).select(F.lit(name).alias("source"), F.posexplode("v").alias("at", "v"))
        cells = row.select(
            "source", F.expr(f"CAST(at DIV {n} AS INT)").alias("i"), F.expr(f"CAST(at % {n} AS INT)").alias("j"),
            r6("v", 4).alias("share"),
        )
        out = cells if out is None else out.union(cells)
    return out


def gram_sql(widths):
    return " UNION ALL ".join(
        f"SELECT '{name}' AS source, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, "
        f"CAST(i = j AS DOUBLE) AS share FROM range({n}) a(i), range({n}) b(j)"
        for name, n in widths.items()
    )


@query("text_svd", gram_sql({"title_svd": 10, "desc_svd": 20}))
def text_svd(spark, sf):
    """The leading components of titles and descriptions are orthogonal over all books, and as long
    as their singular values."""
    out = tables.books(spark, sf)
    sources = {
        "title_svd": (text_vectors.title_source(), lx.TITLE_VOCABULARY, lx.TITLE_COMPONENTS),
        "desc_svd": (text_vectors.description_source(), lx.DESC_VOCABULARY, lx.DESC_COMPONENTS),
    }
    fitted = text_vectors.fit_text_embedders(out, sources)
    for name, embedder in fitted.items():
        out = embedder.transform(out, sources[name][0], name)
    out = cut(out.select(KEY, *fitted), "text-svd")
    return gram_facts(out, {name: e.svd.singular_values[:n] for (name, e), n in zip(fitted.items(), (10, 20))})


@query("text_embed", gram_sql({"embedding": 16}))
def text_embed(spark, sf):
    """64-wide vectors from the words of title and description; facts of the leading 16 places."""
    books, source = tables.books(spark, sf), text_vectors.book_source()
    embedder = text_vectors.fit_text_embedders(books, {"book": (source, 256, 64)})["book"]
    embedded = cut(embedder.transform(books, source).select(KEY, "embedding"), "text-embed")
    return gram_facts(embedded, {"embedding": embedder.svd.singular_values[:16]})


@query("fit_save_load_transform", q.over_books("SELECT book_id, 0 AS n_different FROM books"))
def fit_save_load_transform(spark, sf):
    """Fitted state written and read back, then applied: per book, how many features differ from the
    direct way."""
    clean = clean_books(spark, sf)
    fitted = TraditionalBlock().fit(clean)
    path = new_path(spark, "traditional")
    fitted.save(spark, path)
    names = fitted.features()
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in names])
    direct = fitted.transform(clean).select(KEY, values.alias("direct"))
    loaded = TraditionalBlock.load(spark, path).transform(clean).select(KEY, values.alias("loaded"))
    apart = F.filter(F.zip_with("direct", "loaded", lambda a, b: ~a.eqNullSafe(b)), lambda x: x)
    return direct.join(loaded, KEY).select(KEY, F.size(apart).alias("n_different"))


# ---------------------------------------------------------------------- encoding
_CODES = (
    "SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code FROM "
    "(SELECT DISTINCT coalesce(language_code, 'en') AS value FROM {source})"
)


def _encoded(source: str) -> str:
    return q.over_books(
        "SELECT b.book_id, CAST(coalesce(code, -1) AS INTEGER) AS language_code_encoded "
        "FROM books b LEFT JOIN codes ON value = coalesce(language_code, 'en')",
        codes=_CODES.format(source=source),
    )


@query("label_encode", _encoded("books"))
def label_encode_seen(spark, sf):
    books = tables.books(spark, sf)
    codes = fit_label_codes(books, "language_code")
    return label_encode(books, codes, "language_code").select(KEY, "language_code_encoded")


@query(
    "label_encode_unseen",
    _encoded("(SELECT * FROM books WHERE language_code IS NULL OR language_code <> 'fr')"),
)
def label_encode_unseen(spark, sf):
    """Codes fitted without one language; its books then get -1."""
    books = tables.books(spark, sf)
    known = books.where("language_code IS NULL OR language_code <> 'fr'")
    codes = fit_label_codes(known, "language_code")
    return label_encode(books, codes, "language_code").select(KEY, "language_code_encoded")


# ----------------------------------------------------------------------- scaling
@query(
    "standard_scale",
    q.over_clean(
        "SELECT book_id, " + q.named({c: c for c in lx.NUMERIC_FEATURES}, "double") + " FROM scaled",
        features=q.FEATURES_SQL,
        scaled=q.SCALED_SQL,
    ),
)
def standard_scale(spark, sf):
    df = feature_frame(spark, sf)
    scaled = scaling.fit_column_scaler(df, lx.NUMERIC_FEATURES).transform(df)
    return scaled.select(KEY, *[r6(c).alias(c) for c in lx.NUMERIC_FEATURES])


@query(
    "poly_interactions",
    q.over_clean(
        "SELECT book_id, "
        + ", ".join(f'{q.r6(f"{a} * {b}")} AS "{a} {b}"' for a, b in combinations(lx.POLY_FEATURES, 2))
        + " FROM scaled",
        features=q.FEATURES_SQL,
        scaled=q.SCALED_SQL,
    ),
)
def poly_interactions(spark, sf):
    df = feature_frame(spark, sf)
    scaled = scaling.fit_column_scaler(df, lx.POLY_FEATURES).transform(df)
    return scaled.select(KEY, *[r6(c).alias(n) for n, c in scaling.poly_interactions().items()])


@query(
    "embedding_scale",
    q.over_books(
        "SELECT book_id, CAST(position AS INTEGER) AS position, "
        + q.r6(
            "coalesce((x - avg(x) OVER (PARTITION BY position)) / "
            "nullif(stddev_pop(x) OVER (PARTITION BY position), 0), 0)",
            5,
        )
        + " AS value FROM (SELECT book_id, unnest(CAST(embedding AS DOUBLE[])) AS x, "
        "generate_subscripts(embedding, 1) - 1 AS position "
        "FROM books JOIN embeddings ON vec_id = book_id)"
    ),
)
def embedding_scale(spark, sf):
    embedded = tables.embedded_books(spark, sf).select(KEY, "embedding")
    scaled = scaling.fit_vector_scaler(embedded).transform(embedded)
    return scaled.select(KEY, F.posexplode("embedding").alias("position", "x")).select(
        KEY, "position", r6("x", 5).alias("value")
    )


# ------------------------------------------------------------ quantile transform
SPREAD = ("num_pages", "ratings_count", "description_length")


def _grid_sql(c: str) -> str:
    """Distinct grid values of a column with their first and last rank share."""
    low, high = "a[CAST(floor(pos) AS BIGINT) + 1]", "a[CAST(ceil(pos) AS BIGINT) + 1]"
    return f"""
SELECT v, min(p) AS lo, max(p) AS hi, lead(v) OVER (ORDER BY v) AS next_v,
  lead(min(p)) OVER (ORDER BY v) AS next_lo
FROM (SELECT p, {low} + ({high} - {low}) * (pos - floor(pos)) AS v
  FROM (SELECT i / CAST(n - 1 AS DOUBLE) AS p, a,
      round(i / CAST(n - 1 AS DOUBLE) * (len(a) - 1), 9) AS pos
    FROM (SELECT a, n, unnest(range(n)) AS i FROM
      (SELECT list_sort(list(CAST({c} AS DOUBLE))) AS a, least(1000, count(*)) AS n FROM clean))))
GROUP BY v"""


def _share_sql(c: str) -> str:
    """Rank share of every distinct value of a column against its own quantile grid."""
    return f"""
SELECT x, CASE WHEN x <= (SELECT min(v) FROM g_{c}) THEN 0
  WHEN x >= (SELECT max(v) FROM g_{c}) THEN 1
  WHEN v = x THEN (lo + hi) / 2
  ELSE hi + (x - v) / (next_v - v) * (next_lo - hi) END AS share
FROM (SELECT DISTINCT CAST({c} AS DOUBLE) AS x FROM clean) ASOF LEFT JOIN g_{c} ON x >= v"""


def _quantile_sql(value: Callable[[str], str]) -> str:
    parts = {}
    for c in SPREAD:
        parts[f"g_{c}"], parts[f"u_{c}"] = _grid_sql(c), _share_sql(c)
    joins = " ".join(f"JOIN u_{c} ON u_{c}.x = clean.{c}" for c in SPREAD)
    columns = ", ".join(f"{q.r6(value(f'u_{c}.share'))} AS {c}" for c in SPREAD)
    return q.over_clean(f"SELECT book_id, {columns} FROM clean {joins}", **parts)


def _normal_sql(p: str) -> str:
    def poly(name: str, x: str) -> str:
        *rest, last = AS241[name]
        out = repr(last)
        for c in reversed(rest):
            out = f"({out} * {x} + {c!r})"
        return out

    centre = f"(0.180625 - ({p} - 0.5) * ({p} - 0.5))"
    tail = f"sqrt(-ln(least({p}, 1 - {p})))"
    near, far = f"({tail} - 1.6)", f"({tail} - 5.0)"
    return f"""CASE WHEN {p} <= 1e-7 THEN -{distribution.CLIP} WHEN {p} >= 1 - 1e-7 THEN {distribution.CLIP}
  WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {poly("A", centre)} / {poly("B", centre)}
  ELSE sign({p} - 0.5) * CASE WHEN {tail} <= 5 THEN {poly("C", near)} / {poly("D", near)}
    ELSE {poly("E", far)} / {poly("F", far)} END END"""


@query("quantile_uniform", _quantile_sql(lambda share: share))
def quantile_uniform(spark, sf):
    clean = clean_books(spark, sf)
    fitted = distribution.fit_quantile_transform(clean, SPREAD)
    return fitted.uniform(clean).select(KEY, *[r6(c).alias(c) for c in SPREAD])


@query("quantile_normal", _quantile_sql(_normal_sql))
def quantile_normal(spark, sf):
    clean = clean_books(spark, sf)
    fitted = distribution.fit_quantile_transform(clean, SPREAD)
    return fitted.normal(clean).select(KEY, *[r6(c).alias(c) for c in SPREAD])


# --------------------------------------------------------------------- selection
@query(
    "select_k_best",
    q.over_clean(
        "SELECT feature, " + q.r6("r * r / (1 - r * r) * (n - 2)", 4) + " AS f_score FROM (SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS feature, corr({c}, average_rating) AS r, count(*) AS n "
            "FROM features WHERE average_rating IS NOT NULL"
            for i, c in enumerate(lx.NUMERIC_FEATURES)
        )
        + ") WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY r * r DESC, position LIMIT 20)",
        features=q.FEATURES_SQL,
    ),
)
def select_k_best(spark, sf):
    best = selection.select_k_best(feature_frame(spark, sf), lx.NUMERIC_FEATURES, k=20)
    return best.select("feature", r6("f_score", 4).alias("f_score"))


# ------------------------------------------------------------------- Yeo-Johnson
LAMBDAS = (-1.0, 0.0, 0.5, 1.0, 2.0, 3.0)


def _yj(x: str, lam: float) -> str:
    if lam == 0:
        return f"ln(1 + {x})"
    return f"(pow({x} + 1, {lam}) - 1) / {lam}"


@query(
    "yeo_johnson_loglik",
    q.over_books(
        " UNION ALL ".join(
            f"SELECT CAST({lam} AS DOUBLE) AS lambda, "
            + q.r6(
                f"-count(*) / 2.0 * ln(var_pop({_yj('average_rating', lam)})) "
                f"+ ({lam} - 1) * sum(ln(1 + average_rating))",
                4,
            )
            + " AS log_likelihood FROM books WHERE average_rating IS NOT NULL"
            for lam in LAMBDAS
        )
    ),
)
def yeo_johnson_loglik(spark, sf):
    found = distribution.log_likelihoods(tables.books(spark, sf), "average_rating", LAMBDAS)
    return found.withColumn("log_likelihood", r6("log_likelihood", 4))


@query(
    "yeo_johnson_roundtrip",
    q.over_books(
        f"SELECT book_id, average_rating, {q.r6('average_rating')} AS restored FROM books "
        "WHERE average_rating IS NOT NULL"
    ),
)
def yeo_johnson_roundtrip(spark, sf):
    rated = tables.books(spark, sf).where("average_rating IS NOT NULL")
    power = distribution.fit_power_transform(rated, "average_rating")
    restored = power.inverse(power.forward(F.col("average_rating")))
    return rated.select(KEY, "average_rating", r6(restored).alias("restored"))
