"""Queries over splits, training, comparison and explanation of models.

A fitted model's numbers are no SQL, but what must hold of them is: optimality of linear models,
predictions for every test row inside the range of the labels, shares that add up.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..operators import evaluation, selection, training
from ..operators.fold_statistics import LINEAR, cross_validate_linear as linear_errors, fold_statistics
from ..operators.matrix import sanitize
from ..plans import advanced, flow
from ..plans.blocks import LABEL
from ..sources import sinks, tables
from ..sources.workspace import cut, new_path
from . import sql as q
from .common import clean_books, feature_frame
from .registry import KEY, query, r6

HASH_SQL = "((book_id % 2147483647) * 48271 + 42 * 16807) % 2147483647 % 100"


@query(
    "train_test_split",
    q.over_books(f"SELECT book_id, ({HASH_SQL}) < 20 AS is_test FROM books"),
)
def train_test_split(spark, sf):
    train, test = evaluation.train_test_split(tables.books(spark, sf).select(KEY))
    return train.withColumn("is_test", F.lit(False)).union(test.withColumn("is_test", F.lit(True)))


@query(
    "fold_assignment",
    q.over_books(
        "SELECT book_id, CAST(ntile(5) OVER (ORDER BY book_id) - 1 AS INTEGER) AS fold FROM books"
    ),
)
def fold_assignment(spark, sf):
    return evaluation.assign_folds(tables.books(spark, sf).select(KEY))


def predicted(spark, sf) -> DataFrame:
    """Cleaned, rated books with a prediction that follows from their pages and year."""
    guess = 3.0 + F.col("num_pages") / 1000 - (F.col("publication_year") - 1980) / 200
    rated = clean_books(spark, sf).where(F.col(LABEL).isNotNull())
    return rated.select(KEY, LABEL, guess.alias("prediction"))


PREDICTED_SQL = (
    "SELECT book_id, average_rating, 3.0 + num_pages / 1000 - (publication_year - 1980) / 200.0 "
    "AS prediction FROM clean WHERE average_rating IS NOT NULL"
)


@query(
    "regression_metrics",
    q.over_clean(
        "SELECT count(*) AS n_rows, "
        + q.named(
            {
                "rmse": "sqrt(avg(pow(average_rating - prediction, 2)))",
                "mae": "avg(abs(average_rating - prediction))",
                "r2": "1 - sum(pow(average_rating - prediction, 2)) "
                "/ (count(*) * var_pop(average_rating))",
            },
            "double",
        )
        + " FROM predicted",
        predicted=PREDICTED_SQL,
    ),
)
def regression_metrics(spark, sf):
    metrics = evaluation.regression_metrics(predicted(spark, sf))
    return metrics.select("n_rows", *[r6(c).alias(c) for c in ("rmse", "mae", "r2")])


@query(
    "prediction_range_check",
    q.over_clean(
        "SELECT count(*) AS n_rows, "
        "count(*) FILTER (WHERE NOT prediction BETWEEN 0.5 AND 3.3) AS n_outside, "
        "bool_and(prediction BETWEEN 0.5 AND 3.3) AS all_inside FROM predicted",
        predicted=PREDICTED_SQL,
    ),
)
def prediction_range_check(spark, sf):
    return evaluation.prediction_range_check(predicted(spark, sf), bounds=(0.5, 3.3))


@query(
    "train_linear",
    q.over_clean(
        "SELECT "
        + q.named(
            {
                "slope": "regr_slope(average_rating, ln(1 + ratings_count))",
                "intercept": "regr_intercept(average_rating, ln(1 + ratings_count))",
            },
            "double",
        )
        + " FROM clean WHERE average_rating IS NOT NULL"
    ),
)
def train_linear(spark, sf):
    rated = clean_books(spark, sf).where(F.col(LABEL).isNotNull())
    rows = rated.select(LABEL, F.log1p("ratings_count").alias("x"))
    model = training.regressor("linear").fit(training.assemble(rows, ["x"], [LABEL]))
    fitted = [(float(model.coefficients[0]), float(model.intercept))]
    frame = spark.createDataFrame(fitted, "slope double, intercept double")
    return frame.select(r6("slope").alias("slope"), r6("intercept").alias("intercept"))


_X = "ln(1 + ratings_count)"
_RIDGE = f"regr_sxy(average_rating, {_X}) / (regr_sxx(average_rating, {_X}) + 50)"


@query(
    "train_ridge_slope",
    q.over_clean(
        "SELECT "
        + q.named({"slope": _RIDGE, "intercept": f"avg(average_rating) - {_RIDGE} * avg({_X})"}, "double")
        + " FROM clean WHERE average_rating IS NOT NULL"
    ),
)
def train_ridge_slope(spark, sf):
    """Ridge on one feature, which has a closed form."""
    rated = clean_books(spark, sf).where(F.col(LABEL).isNotNull())
    rows = training.assemble(
        rated.select(LABEL, F.log1p("ratings_count").alias("x")), ["x"], [LABEL]
    )
    model = training.regressor("ridge", training.label_scale(rows), alpha=50.0).fit(rows)
    fitted = [(float(model.coefficients[0]), float(model.intercept))]
    frame = spark.createDataFrame(fitted, "slope double, intercept double")
    return frame.select(r6("slope").alias("slope"), r6("intercept").alias("intercept"))


# ------------------------------------------------------------------ fitted models
def plain_matrix(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of the scale-free numeric features of all rated books."""
    features = feature_frame(spark, sf).where(evaluation_rows())
    wide = sanitize(features.select(KEY, LABEL, *lx.NUMERIC_FEATURES), lx.NUMERIC_FEATURES)
    rows = cut(training.assemble(wide, lx.NUMERIC_FEATURES, [KEY, LABEL]), "plain")
    return evaluation.train_test_split(rows)


def evaluation_rows():
    return F.col(LABEL).between(1.0, 5.0)


TEST_ROWS = f"average_rating BETWEEN 1 AND 5 AND ({HASH_SQL}) < 20"


def tested_sql(*models: str) -> str:
    """One row per model: every rated test book has a prediction, inside the range of the ratings."""
    return q.over_clean(
        " UNION ALL ".join(
            f"SELECT '{m}' AS model, count(*) AS n_rows, 0 AS n_missing, 0 AS n_outside "
            f"FROM clean WHERE {TEST_ROWS}"
            for m in models
        )
    )


def tested(spark, results, low: float = 1.0, high: float = 5.0) -> DataFrame:
    out = None
    for t in results:
        p = F.col("prediction")
        row = t.predictions.agg(
            F.count("*").alias("n_rows"),
            F.count_if(p.isNull() | F.isnan(p)).cast("int").alias("n_missing"),
            F.count_if(~p.between(low, high)).cast("int").alias("n_outside"),
        ).select(F.lit(t.name).alias("model"), "n_rows", "n_missing", "n_outside")
        out = row if out is None else out.union(row)
    return out


def preset_report(spark, sf, *names: str, low: float = 1.0, high: float = 5.0) -> DataFrame:
    """Presets at full size, fitted on the plain features of all rated training books."""
    train, test = plain_matrix(spark, sf)
    results = training.compare({n: training.preset(n, train) for n in names}, train, test)
    return tested(spark, results, low, high)


OPTIMAL_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, TRUE AS optimal" for c in lx.NUMERIC_FEATURES
)


def optimal(spark, sf, name: str) -> DataFrame:
    """Per feature: does the (sub)gradient of the penalised error vanish at the fitted model?"""
    kind, params = training.PRESETS[name]
    train, _ = plain_matrix(spark, sf)
    # a common scale, so that the optimum is well conditioned
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
    train = scaler.fit(train).transform(train).drop("features").withColumnRenamed("scaled", "features")
    train = cut(train, "scaled")
    scale = training.label_scale(train)
    model = training.regressor(kind, scale, **params).setTol(1e-12).setMaxIter(2000).fit(train)
    error = F.col(LABEL) - F.col("prediction")
    rows = model.transform(train).select(vector_to_array("features").alias("x"), error.alias("e"))
    names = lx.NUMERIC_FEATURES
    pulls = rows.agg(*[F.sum(F.col("x")[i] * F.col("e")).alias(f"p{i}") for i in range(len(names))]).first()
    n, w = scale[0], model.coefficients.toArray()
    out = []
    for i, c in enumerate(names):
        pull = pulls[i] / n
        if kind == "ridge":
            gap = abs(pull - params["alpha"] * w[i] / n)
        else:
            absolute = params["alpha"] * params["l1_ratio"]
            squared = params["alpha"] * (1 - params["l1_ratio"])
            side = absolute * (1 if w[i] > 0 else -1) + squared * w[i]
            gap = abs(pull - side) if w[i] else max(0.0, abs(pull) - absolute)
        out.append((c, bool(gap < 1e-4)))
    return spark.createDataFrame(out, "feature string, optimal boolean")


@query("train_ridge", OPTIMAL_SQL)
def train_ridge(spark, sf):
    return optimal(spark, sf, "ridge")


@query("train_elastic_net", OPTIMAL_SQL)
def train_elastic_net(spark, sf):
    return optimal(spark, sf, "elastic_net")


@query("train_random_forest", tested_sql("random_forest"))
def train_random_forest(spark, sf):
    return preset_report(spark, sf, "random_forest")


@query("train_gbt", tested_sql("gradient_boosting"))
def train_gbt(spark, sf):
    """Boosting sums corrections, so its predictions may leave the range of the labels a little."""
    return preset_report(spark, sf, "gradient_boosting", low=0.0, high=6.0)


@query("train_second_order", tested_sql("xgboost"))
def train_second_order(spark, sf):
    """The full preset with penalised leaves: 300 trees of up to 10 levels."""
    return preset_report(spark, sf, "xgboost", low=0.0, high=6.0)


#: Features of two values, on which a drawn and a quantile split point part the rows alike.
FLAGS = (
    "title_has_colon", "title_question", "is_very_recent", "is_recent", "is_modern",
    "is_picture_book", "is_early_reader", "is_middle_grade",
)


def stump_sql(trees: int, gradient: str, alpha: float, l2: float) -> str:
    """The best split of one node by SQL: the gain of each flag with penalised leaves, the largest of
    them, and how many rows go left and right with which values. Every tree must find it."""
    shrink = lambda x: f"(sign({x}) * greatest(abs({x}) - {alpha}, 0))"
    score = lambda x, h: f"pow({shrink(x)}, 2) / ({h} + {l2})"
    value = lambda x, h: q.r6(f"-{shrink(x)} / ({h} + {l2})")
    return q.over_clean(
        "SELECT tree, feature, nl AS n_left, n - nl AS n_right, "
        f"{value('gl', 'nl')} AS left_value, {value('(g - gl)', '(n - nl)')} AS right_value, {q.r6('gain', 4)} AS gain "
        f"FROM (SELECT *, {score('gl', 'nl')} + {score('(g - gl)', '(n - nl)')} - {score('g', 'n')} AS gain "
        "FROM found WHERE nl > 0 AND nl < n ORDER BY gain DESC, place LIMIT 1), "
        f"(SELECT CAST(unnest(range({trees})) AS INTEGER) AS tree)",
        features=q.FEATURES_SQL,
        rated=f"SELECT * FROM features WHERE average_rating BETWEEN 1 AND 5 AND ({HASH_SQL}) >= 20",
        train=f"SELECT *, {gradient} AS gradient FROM rated",
        found=" UNION ALL ".join(
            f"SELECT {i} AS place, '{c}' AS feature, count(*) AS n, sum(gradient) AS g, "
            f"count(*) FILTER (WHERE {c} <= 0) AS nl, coalesce(sum(gradient) FILTER (WHERE {c} <= 0), 0) AS gl FROM train"
            for i, c in enumerate(FLAGS)
        ),
    )


def stumps(spark, sf, kind: str, **params) -> DataFrame:
    """The root and the two leaves of each tree of one level."""
    features = feature_frame(spark, sf).where(evaluation_rows())
    wide = training.assemble(sanitize(features.select(KEY, LABEL, *FLAGS), FLAGS), FLAGS, [KEY, LABEL])
    train, _ = evaluation.train_test_split(wide)
    model = training.regressor(kind, max_depth=1, **params).fit(train)
    nodes = model.frame(spark)
    root, left, right = (nodes.where(F.col("node") == i).alias(f"n{i}") for i in (1, 2, 3))
    both = root.join(left, "tree").join(right, "tree")
    names = F.array(*map(F.lit, FLAGS))
    return both.select(
        "tree",
        F.element_at(names, F.col("n1.feature") + 1).alias("feature"),
        F.col("n2.cover").cast("long").alias("n_left"),
        F.col("n3.cover").cast("long").alias("n_right"),
        r6("n2.value").alias("left_value"),
        r6("n3.value").alias("right_value"),
        r6("n1.gain", 4).alias("gain"),
    )


@query("second_order_stump", stump_sql(1, "(SELECT avg(average_rating) FROM rated) - average_rating", 3.0, 5.0))
def second_order_stump(spark, sf):
    """One boosted tree of one level: leaf values and gain under both penalties."""
    return stumps(spark, sf, "xgboost", n_estimators=1, alpha=3.0, l2=5.0)


@query("extra_trees_stumps", stump_sql(3, "-average_rating", 0.0, 0.0))
def extra_trees_stumps(spark, sf):
    """Randomised trees of one level: drawn split points part flags in one way only."""
    return stumps(spark, sf, "extra_trees", n_estimators=3)


@query("train_forest_variants", tested_sql("optimized_rf", "extra_trees"))
def train_forest_variants(spark, sf):
    return preset_report(spark, sf, "optimized_rf", "extra_trees")


@query("cross_validate", "SELECT CAST(5 AS BIGINT) AS folds, TRUE AS error_in_range, TRUE AS spread_in_range")
def cross_validate(spark, sf):
    """Errors of five folds: no fold of ratings from 1 to 5 can be off by more than 4."""
    train, _ = plain_matrix(spark, sf)
    row = training.cross_validate(training.preset("random_forest"), train)
    inside = lambda c: F.col(c).between(0.0, 4.0)
    return row.select("folds", inside("cv_rmse_mean").alias("error_in_range"), inside("cv_rmse_std").alias("spread_in_range"))


def _slope(model: str) -> str:
    """The slope on one feature in closed form, from moments of the rows outside the fold."""
    kind, p = training.PRESETS[model]
    if kind == "elastic_net":
        absolute, squared = p["alpha"] * p["l1_ratio"], p["alpha"] * (1 - p["l1_ratio"])
        return f"sign(c) * greatest(abs(c) - {absolute}, 0) / (v + {squared})"
    return f"c / (v + {p.get('alpha', 0.0)} / n)"


@query(
    "cross_validate_linear",
    q.over_books(
        "SELECT model, CAST(f AS INTEGER) AS fold, count(*) AS n_rows, "
        + q.r6("sqrt(avg(pow(y - my - w * (x - mx), 2)))")
        + " AS rmse FROM folded JOIN ("
        + " UNION ALL ".join(
            f"SELECT '{m}' AS model, f, mx, my, {_slope(m)} AS w FROM outside" for m in LINEAR
        )
        + ") ON fold = f GROUP BY model, f",
        folded="SELECT num_pages AS x, average_rating AS y, ntile(5) OVER (ORDER BY book_id) - 1 AS fold "
        "FROM books WHERE num_pages IS NOT NULL AND average_rating IS NOT NULL",
        outside="SELECT f, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS v, covar_pop(y, x) AS c "
        "FROM folded JOIN range(5) folds(f) ON fold <> f GROUP BY f",
    ),
)
def cross_validate_linear(spark, sf):
    """Held-out errors of five folds of every linear preset on one feature, from one pass over the rows."""
    books = tables.books(spark, sf).where("num_pages IS NOT NULL AND average_rating IS NOT NULL")
    rows = training.assemble(books.select(KEY, LABEL, "num_pages"), ["num_pages"], [KEY, LABEL])
    statistics = fold_statistics(rows, LABEL)
    models = {name: training.PRESETS[name] for name in LINEAR}
    return linear_errors(spark, statistics, models).withColumn("rmse", r6("rmse"))


@query("train_transformed_target", tested_sql("random_forest"))
def train_transformed_target(spark, sf):
    train, test = plain_matrix(spark, sf)
    done, _ = training.evaluate_on_transformed_target(
        "random_forest", "random_forest", train, test, **training.PRESETS["random_forest"][1]
    )
    return tested(spark, [done])


@query(
    "feature_importance",
    f"SELECT CAST({len(lx.NUMERIC_FEATURES)} AS BIGINT) AS n_features, CAST(0 AS BIGINT) AS n_negative, "
    "CAST(1 AS DOUBLE) AS total",
)
def feature_importance(spark, sf):
    """Importances of a forest, written as the report file and read back: shares of one whole."""
    train, test = plain_matrix(spark, sf)
    model = training.evaluate("forest", training.preset("random_forest"), train, test).model
    importance = training.feature_importance(spark, model, lx.NUMERIC_FEATURES)
    path = new_path(spark, "importance")
    sinks.write_importance_csv(importance.drop("position"), path)
    written = spark.read.schema("feature string, importance double").csv(path, header=True)
    return written.agg(
        F.count("feature").alias("n_features"),
        F.count_if(F.col("importance") < 0).alias("n_negative"),
        r6(F.sum("importance")).alias("total"),
    )


@query(
    "importance_by_group",
    q.over_clean(
        "SELECT feature_group, "
        + q.named({"importance": "part", "share_pct": "part / total * 100"}, "double")
        + " FROM (SELECT (SELECT sum(importance) FROM scores) AS total, g.* FROM ("
        + " UNION ALL ".join(
            f"SELECT '{g}' AS feature_group, coalesce(sum(importance) FILTER (WHERE {mask}), 0) "
            "AS part FROM scores"
            for g, mask in {
                **{g: f"regexp_matches(feature, '(?i){p}')" for g, p in lx.IMPORTANCE_GROUPS.items()},
                "traditional": " AND ".join(
                    f"NOT regexp_matches(feature, '(?i){lx.IMPORTANCE_GROUPS[g]}')"
                    for g in ("semantic", "lexicon")
                ),
            }.items()
        )
        + ") g)",
        features=q.FEATURES_SQL,
        scores=" UNION ALL ".join(
            f"SELECT '{c}' AS feature, coalesce(pow(corr({c}, average_rating), 2), 0) AS importance "
            "FROM features WHERE average_rating IS NOT NULL"
            for c in lx.NUMERIC_FEATURES
        ),
    ),
)
def importance_by_group(spark, sf):
    """Shares of the squared correlation with the rating, per group of feature names."""
    scores = selection.f_scores(feature_frame(spark, sf), lx.NUMERIC_FEATURES)
    squared = F.coalesce(F.nanvl("r", F.lit(None).cast("double")), F.lit(0.0))
    importance = scores.select("feature", (squared * squared).alias("importance"))
    groups = evaluation.importance_by_group(importance)
    return groups.select(
        "feature_group", r6("importance").alias("importance"), r6("share_pct").alias("share_pct")
    )


# ---------------------------------------------------------------------- full flows
@query(
    "ablation",
    "SELECT 'random_forest' AS model, TRUE AS scored_on_all_sets, TRUE AS gains_add_up",
)
def ablation(spark, sf):
    """Gains of each feature set over the one before, for a forest on all books that pass."""
    prepared = flow.prepare(tables.books(spark, sf))
    models = {"random_forest": training.preset("random_forest")}
    d = evaluation.ablation_deltas(flow.ablation(prepared, models))
    scored = [F.col(f"{s}_r2").isNotNull() & (F.col(f"{s}_r2") <= 1) for s in ("traditional", "semantic", "full")]
    gains = F.col("semantic_improvement") + F.col("lexicon_improvement")
    return d.select(
        "model",
        (scored[0] & scored[1] & scored[2]).alias("scored_on_all_sets"),
        (F.abs(gains - F.col("total_improvement")) < 1e-9).alias("gains_add_up"),
    )


@query(
    "train_and_register",
    q.over_runs(
        "SELECT model_name, version, run_id, CASE WHEN stage = 'Production' THEN 'Archived' ELSE stage "
        "END AS stage, FALSE AS described FROM versions WHERE model_name = 'predictor-7' UNION ALL "
        "SELECT 'predictor-7', coalesce((SELECT max(version) FROM versions WHERE model_name = "
        "'predictor-7'), 0) + 1, 0, 'Production', TRUE"
    ),
)
def train_and_register(spark, sf):
    """Clean, build all blocks, train two models, register the better one; the promoted versions.

    A version is described when its text states the greater R2 of the two.
    """
    versions = tables.versions(spark, sf)
    models = {name: training.preset(name) for name in ("random_forest", "elastic_net")}
    _, metrics, registered = flow.train_and_register(
        tables.books(spark, sf), versions, "predictor-7", models, path=new_path(spark, "run")
    )
    rows = metrics.collect()
    best = max(r.r2 for r in rows) if len(rows) == len(models) else math.nan
    described = F.coalesce(F.col("description") == f"Rating predictor. R2 = {best:.4f}", F.lit(False))
    mine = registered.where("model_name = 'predictor-7'")
    return mine.select("model_name", "version", "run_id", "stage", described.alias("described"))



@query(
    "advanced_block",
    q.over_clean(
        "SELECT book_id, CAST(50 AS INTEGER) AS at_most, TRUE AS finite FROM clean",
    ),
)
def advanced_block(spark, sf):
    """The block fitted and applied to all books: at most 50 features, all of them finite."""
    clean = clean_books(spark, sf)
    block = advanced.AdvancedBlock().fit(clean)
    values = F.array(*[F.col(c) for c in block.chosen])
    finite = F.forall(values, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    width = F.when(F.lit(0 < len(block.chosen) <= 50), F.lit(50)).alias("at_most")
    return block.transform(clean).select(KEY, width, finite.alias("finite"))


def _tested_among(model: str, kept: str) -> str:
    return q.over_books(
        f"SELECT '{model}' AS model, count(*) AS n_rows, 0 AS n_missing, 0 AS n_outside FROM kept "
        f"WHERE ({HASH_SQL}) < 20",
        chosen=f"SELECT * FROM books WHERE regexp_matches(lower(popular_shelves), '{lx.CATEGORY_PATTERN}')",
        kept=kept,
    )


@query(
    "train_advanced",
    _tested_among(
        "random_forest",
        "SELECT * FROM (SELECT *, quantile_cont(average_rating, 0.25) OVER () AS q1, "
        "quantile_cont(average_rating, 0.75) OVER () AS q3 FROM chosen) "
        "WHERE average_rating BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)",
    ),
)
def train_advanced(spark, sf):
    return tested(spark, [advanced.train_advanced(tables.books(spark, sf))])


@query(
    "train_config",
    _tested_among("linear", "SELECT * FROM chosen WHERE average_rating BETWEEN 1 AND 5"),
)
def train_config(spark, sf):
    """A linear model of all traditional features; its predictions are not bounded by the ratings."""
    done, _, _ = advanced.train_configured(tables.books(spark, sf), "linear")
    return tested(spark, [done], -1e6, 1e6)
