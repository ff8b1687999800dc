"""Training, comparison, registration and scoring from end to end."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tomewise.operators import evaluation, runs, scoring, text_vectors, training
from tomewise.operators.registry import MetricsLog, VersionRegistry
from tomewise.plans import flow
from tomewise.plans.blocks import LEXICON_FEATURES, lexicon_block
from tomewise.sources import sinks, tables
from tomewise.streaming.scoring import score_arriving


def test_unknown_model():
    with pytest.raises(ValueError, match="Unknown model type"):
        training.regressor("perceptron")


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(3)
    y, p = rng.normal(size=60), rng.normal(size=60)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "average_rating double, prediction double")
    m = evaluation.regression_metrics(df).first()
    assert m.rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert m.mae == pytest.approx(np.mean(np.abs(y - p)))
    assert m.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


def test_split_is_stable_and_near_its_share(spark):
    df = spark.range(20_000).withColumnRenamed("id", "book_id")
    train, test = evaluation.train_test_split(df)
    assert train.count() + test.count() == 20_000
    assert test.count() == pytest.approx(4000, rel=0.05)
    again = evaluation.train_test_split(df.repartition(11))[1]
    assert test.exceptAll(again).count() == 0


def test_first_wins_ties_and_failures_are_skipped(spark):
    rows = [(0, "a", 0.2), (1, "b", 0.3), (2, "c", 0.3), (3, "d", None), (4, "e", float("nan"))]
    df = spark.createDataFrame(rows, "position int, model string, r2 double")
    assert evaluation.champion(df).first().model == "b"


def test_penalties_are_the_usual_ones(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(100, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(size=100)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "book_id long, a double, b double, c double, average_rating double")
    data = training.assemble(df, ["a", "b", "c"], ["average_rating"])
    scale = training.label_scale(data)
    model = training.regressor("ridge", scale, alpha=10.0).fit(data)
    xc, yc = x - x.mean(axis=0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 10.0 * np.eye(3), xc.T @ yc)
    assert model.coefficients.toArray() == pytest.approx(want, rel=1e-6)

    # elastic net by coordinate descent
    w, absolute, squared = np.zeros(3), 0.3 * 0.4, 0.3 * 0.6
    for _ in range(500):
        for j in range(3):
            rest = yc - xc @ w + xc[:, j] * w[j]
            pull = xc[:, j] @ rest / 100
            w[j] = np.sign(pull) * max(abs(pull) - absolute, 0) / (xc[:, j] @ xc[:, j] / 100 + squared)
    net = training.regressor("elastic_net", scale, alpha=0.3, l1_ratio=0.4).fit(data)
    assert net.coefficients.toArray() == pytest.approx(w, rel=1e-4)


def test_promotion_archives_and_numbers(spark):
    old = spark.createDataFrame(
        [("m", 3, 1, "Production"), ("m", 2, 0, "None"), ("other", 1, 5, "Production")],
        "model_name string, version long, run_id long, stage string",
    )
    new = spark.createDataFrame([("m", 9, 0.3), ("fresh", 8, 0.4)], "model_name string, run_id long, r2 double")
    got = {(r.model_name, r.version): r.stage for r in runs.promote(old, new, F.lit("d")).collect()}
    assert got == {
        ("m", 3): "Archived", ("m", 2): "None", ("m", 4): "Production",
        ("other", 1): "Production", ("fresh", 1): "Production",
    }


def test_version_choice(spark):
    rows = [
        ("a", 1, 1, "None"), ("a", 2, 2, "Production"), ("a", 3, 3, "None"),
        ("b", 1, 4, "None"), ("b", 2, 5, "None"), ("c", 4, 6, "Archived"), ("c", 7, 7, "None"),
    ]
    df = spark.createDataFrame(rows, "model_name string, version long, run_id long, stage string")
    got = {r.model_name: r.version for r in runs.resolve_version(df).collect()}
    assert got == {"a": 2, "b": 1, "c": 7}


def test_runs_without_one_metric_still_count(spark):
    df = spark.createDataFrame([(None, 0.3), (0.1, None)], "best_r2 double, test_r2 double")
    assert [r[0] for r in df.select(runs.run_score()).collect()] == [0.3, 0.1]


def test_request_defaults(spark):
    df = spark.createDataFrame([("t", "d", "", 0)], "title string, description string, authors string, num_pages int")
    row = scoring.request_defaults(df).first()
    assert (row.authors, row.num_pages, row.publication_year) == ("Unknown", 100, 2020)
    assert (row.ratings_count, row.text_reviews_count, row.average_rating) == (10, 5, 3.5)
    vector = df.withColumn("publication_year", F.lit(1999)).select(scoring.fallback_vector()).first()[0]
    assert len(vector) == 103 and vector[:5] == [0.0, 1999.0, 1.0, 1.0, 1.0]


def test_flow_trains_registers_and_scores(spark, sf, tmp_path):
    books = tables.books(spark, sf)
    versions = tables.versions(spark, sf)
    models = {
        "broken": training.regressor("random_forest", n_estimators=2, max_depth=-1 + 2),
        "forest": training.regressor("random_forest", n_estimators=5, max_depth=4),
    }
    models["broken"].setFeaturesCol("no_such_column")
    scorer, metrics, registered = flow.train_and_register(
        books, versions, "predictor-3", models, 7, str(tmp_path)
    )
    assert [r.model for r in metrics.collect()] == ["forest"]
    production = registered.where("model_name = 'predictor-3' AND stage = 'Production'").collect()
    assert len(production) == 1 and production[0].description.startswith("Rating predictor")

    scored = scorer.score(books)
    check = evaluation.prediction_range_check(scored).first()
    assert check.n_rows == books.count() and check.all_inside
    width = 64
    manifest = scorer.features.manifest(width)
    lexicon = lexicon_block(books).columns[1:]
    assert set(lexicon) == set(scorer.features.sets["lexicon"]) == set(LEXICON_FEATURES)
    model_width = len(scorer.model.featureImportances.toArray())
    assert len(manifest) == model_width == len(set(manifest))

    # the run left all that another session needs
    assert sinks.load_manifest(spark, f"{tmp_path}/feature_manifest") == manifest
    logged = {r.key: r.run_id for r in MetricsLog(spark, f"{tmp_path}/metrics").read().collect()}
    committed = VersionRegistry(spark, f"{tmp_path}/registry").versions()
    columns = ["model_name", "version", "run_id", "stage", "description"]
    assert sorted(committed.select(columns).collect(), key=str) == sorted(registered.select(columns).collect(), key=str)
    assert logged == {"forest_r2": "7", "forest_rmse": "7", "forest_mae": "7"}
    assert spark.read.csv(f"{tmp_path}/importance", header=True).count() == model_width
    loaded = flow.Scorer.load(spark, f"{tmp_path}/scorer")
    assert loaded.columns == scorer.columns and loaded.features.sets == scorer.features.sets
    again = {r.book_id: r.prediction for r in loaded.score(books).collect()}
    assert again == pytest.approx({r.book_id: r.prediction for r in scored.collect()})


def test_fitting_ignores_test_rows(spark, sf):
    """Medians and the last year are those of training rows of the category."""
    books = tables.books(spark, sf)
    wild = evaluation.is_test()
    odd = books.withColumns({
        "num_pages": F.when(wild, 90_000.0).otherwise(F.col("num_pages")),
        "publication_date": F.when(wild, "2222-01-01").otherwise(F.col("publication_date")),
    })
    fitted = [flow.prepare(b, with_semantic=False, with_lexicon=False).features.cleaning for b in (books, odd)]
    assert fitted[0] == fitted[1] and fitted[0].max_year < 2100


def test_trees_of_extra_trees_differ(spark):
    rng = np.random.default_rng(5)
    rows = [(Vectors.dense(x), float(x[0] + x[1] ** 2)) for x in rng.normal(size=(200, 6))]
    data = spark.createDataFrame(rows, ["features", training.LABEL])
    forest = training.regressor("extra_trees", n_estimators=5, max_depth=6).fit(data)
    roots = {(n[2], n[3]) for n in forest.nodes if n[1] == 1}
    assert len(roots) == 5


@pytest.mark.parametrize("name", sorted(training.PRESETS))
def test_every_preset_fits(spark, name):
    rng = np.random.default_rng(6)
    rows = [(Vectors.dense(x), float(x[0] > 0) + 2.0) for x in rng.normal(size=(60, 3))]
    data = spark.createDataFrame(rows, ["features", training.LABEL]).coalesce(1).cache()
    model = training.preset(name, data).fit(data)
    row = model.transform(data).agg(F.count("prediction"), F.avg("prediction")).first()
    assert row[0] == 60 and 2.0 <= row[1] <= 3.0


def test_no_label_without_a_prediction(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (4.2,)], "prediction double")
    labels = [r.confidence for r in df.select(scoring.confidence_labels()["confidence"].alias("confidence")).collect()]
    assert labels == [None, None, "High-rated book predicted"]


def test_a_share_without_buckets_is_refused():
    with pytest.raises(ValueError):
        evaluation.is_test(0.004)


def test_no_row_meets_its_own_rating(spark, sf):
    """Test rows are absent from the bank that neighbours are taken from."""
    prepared = flow.prepare(tables.books(spark, sf), with_lexicon=False)
    bank = prepared.features.semantic.bank.select("book_id")
    assert bank.join(prepared.test, "book_id", "left_semi").count() == 0
    assert bank.count() > 0


def test_stream_answers_every_request_once(spark, sf, tmp_path):
    """All blocks are scored, and a batch that is repeated overwrites its own answers."""
    books = tables.books(spark, sf)
    models = {"forest": training.regressor("random_forest", n_estimators=3, max_depth=3)}
    scorer, _, _ = flow.train_and_register(books, tables.versions(spark, sf), "predictor-3", models)
    asked = books.select("book_id", "title", "description", F.lit(1990).alias("publication_year"))
    asked.repartition(2).write.parquet(f"{tmp_path}/in")
    for checkpoint in ("a", "b"):  # the second query starts over with batch 0
        stream = spark.readStream.schema(asked.schema).parquet(f"{tmp_path}/in")
        score_arriving(stream, scorer, f"{tmp_path}/out", f"{tmp_path}/{checkpoint}").awaitTermination()
    answers = spark.read.parquet(f"{tmp_path}/out/batch=*").collect()
    assert len(answers) == len({r.book_id for r in answers}) == books.count()
    assert all(r.confidence and r.explanation.endswith("stars") for r in answers)


def test_text_vectors_have_their_width(spark, sf):
    books, source = tables.books(spark, sf), text_vectors.book_source()
    embedder = text_vectors.fit_text_embedders(books, {"book": (source, 256, 64)})["book"]
    assert len(embedder.transform(books, source).first().embedding) == 64


def test_entry(spark):
    import __spark_entry__ as entry

    report = entry.entry(spark)
    assert report.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
