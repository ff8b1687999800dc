"""Cleaning and matrix operators on small frames with awkward content."""

import numpy as np
import pytest

from tomewise.operators import cleaning, matrix
from tomewise.operators.quantiles import exact_quantiles, values_at_ranks
from tomewise.sources import catalog, sinks
from tomewise.sources.workspace import new_path


def test_json_lines_skip_malformed_and_budget_counts_them(spark, tmp_path):
    path = tmp_path / "books.json"
    path.write_text('{"book_id": 1, "title": "a"}\nBAD\n{"book_id": 2, "title": "b"}\n')
    assert catalog.scan_json(spark, str(path)).count() == 2
    limited = catalog.scan_json(spark, str(path), sample_size=2)
    assert [r.book_id for r in limited.collect()] == [1]


def test_review_records(spark, tmp_path):
    path = tmp_path / "reviews.json"
    path.write_text('{"user_id": "u", "book_id": "7", "rating": 4, "read_at": "", "n_votes": 3}\n')
    row = catalog.scan_json(spark, str(path), catalog.REVIEW_SCHEMA).first()
    assert (row.book_id, row.rating, row.read_at, row.n_comments) == ("7", 4, "", None)


def test_missing_columns_and_defaults(spark):
    df = spark.createDataFrame([("t", "d")], "title string, description string")
    row = cleaning.preprocess(df).first()
    assert (row.num_pages, row.ratings_count, row.publication_year) == (100.0, 0.0, 2020)
    assert (row.title_length, row.rating_density) == (1, 0.0)


def test_imputation_leaves_no_nulls(spark):
    df = spark.createDataFrame(
        [(4.0, 10.0, "a"), (None, None, "b"), (3.0, 30.0, None)],
        "average_rating double, num_pages double, title string",
    )
    got = cleaning.preprocess(df).select("num_pages", "title_length").collect()
    assert sorted(map(tuple, got)) == [(10.0, 1), (20.0, 1), (30.0, 0)]


def test_empty_frame_passes_through(spark):
    df = spark.createDataFrame([], "title string, description string, popular_shelves string")
    assert cleaning.preprocess(cleaning.category_filter(df)).count() == 0
    assert cleaning.iqr_filter(cleaning.preprocess(df), "num_pages").count() == 0


def test_existing_year_is_kept_unless_told_otherwise(spark):
    df = spark.createDataFrame([("t", 1999)], "title string, publication_year int")
    assert cleaning.preprocess(df).first().publication_year == 1999
    assert cleaning.preprocess(df, year_mode="reference").first().publication_year == 2020


@pytest.mark.parametrize(
    "text, year",
    [
        ("2001-05-06", 2001), ("2003", 2003), ("05/06/2004", 2004), ("May 6, 2005", 2005),
        ("Tue Nov 17 11:37:35 -0800 2015", 2015), ("", 2020), ("soon", 2020), (None, 2020),
    ],
)
def test_years(spark, text, year):
    df = spark.createDataFrame([(text,), ("1990-01-01",)], "publish_date string")
    years = [r.publication_year for r in cleaning.preprocess(df).collect()]
    assert sorted(years) == sorted([year, 1990])


def test_numbers_in_text(spark):
    values = ["1e3", " 12 ", "n/a", "", None, "1d", "-.5", "NaN"]
    df = spark.createDataFrame([(v,) for v in values], "num_pages string")
    got = [r[0] for r in cleaning.coerce_numeric(df, ["num_pages"]).collect()]
    assert got == [1000.0, 12.0, None, None, None, None, -0.5, None]


def test_quality_filter_drops_missing_descriptions(spark):
    df = spark.createDataFrame(
        [(3.0, 20.0, "x" * 31), (3.0, 20.0, None), (3.0, 20.0, "x" * 30), (1.0, 20.0, "x" * 31)],
        "average_rating double, ratings_count double, description string",
    )
    assert cleaning.quality_filter(df).count() == 1


def test_too_few_rows(spark):
    with pytest.raises(ValueError, match="at least 100"):
        cleaning.require_min_rows(spark.range(99))
    assert cleaning.require_min_rows(spark.range(100)).count() == 100


def test_quantiles_of_several_columns(spark):
    rng = np.random.default_rng(7)
    mixed = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25), rng.integers(0, 5, 500)])
    flags = rng.integers(0, 2, 5000).astype(float)
    rows = [(float(x), float(f), None, float("nan") if i % 2 else i / 7) for i, (x, f) in enumerate(zip(mixed, flags))]
    df = spark.createDataFrame(rows, "x double, `a flag` double, nothing double, half double").repartition(7)
    probs = [0.0, 0.01, 0.2, 0.25, 0.5, 0.777, 0.99, 1.0]
    got = exact_quantiles(df, {"x": probs, "a flag": [0.5, 0.1], "nothing": [0.5], "half": probs})
    assert got["x"] == pytest.approx(np.quantile(mixed, probs).tolist(), abs=1e-12)
    assert got["a flag"] == np.quantile(flags, [0.5, 0.1]).tolist()
    assert got["nothing"] is None
    assert got["half"] == pytest.approx(np.quantile(np.arange(0, 5000, 2) / 7, probs).tolist(), abs=1e-9)


def test_quantiles_of_nothing_and_of_one(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(empty, {"x": [0.5]})["x"] is None
    one = spark.createDataFrame([(3.5,)], "x double")
    assert exact_quantiles(one, {"x": [0.1, 0.9]})["x"] == [3.5, 3.5]


def test_values_at_ranks(spark):
    df = spark.range(0, 5000, 3).withColumnRenamed("id", "k").repartition(5)
    assert values_at_ranks(df, "k", [0, 10, 1666]) == {0: 0, 10: 30, 1666: 4998}


def test_align_and_combine(spark):
    a = spark.createDataFrame([(1, 1.0, 9.0), (2, 2.0, 9.0)], "book_id long, x double, extra double")
    b = spark.createDataFrame([(1, 5)], "book_id long, y int")
    joined = matrix.combine([a, b]).orderBy("book_id")
    assert [r.y for r in joined.collect()] == [5, 0]
    aligned = matrix.align(joined, ["y", "absent", "x"])
    assert aligned.columns == ["y", "absent", "x"]
    assert [tuple(r) for r in aligned.collect()] == [(5, 0.0, 1.0), (0, 0.0, 2.0)]
    assert matrix.dtype_histogram(joined) == {"bigint": 1, "double": 2, "int": 1}


def test_sanitize(spark):
    df = spark.createDataFrame(
        [(float("nan"), "1"), (float("inf"), "x"), (float("-inf"), None), (2.5, "2")], "a double, b string"
    )
    got = [tuple(r) for r in matrix.sanitize(df, ["a", "b"]).collect()]
    assert got == [(0.0, 1.0), (0.0, 0.0), (0.0, 0.0), (2.5, 2.0)]


def test_metrics_are_appended(spark):
    path = new_path(spark, "metrics")
    sinks.log_metrics(spark, path, "r1", {"r2": 0.2})
    sinks.log_metrics(spark, path, "r2", {"r2": 0.3, "mae": 1})
    assert spark.read.parquet(path).count() == 3


def test_filters_reach_the_scan(spark, sf):
    """Only the needed columns of the source are read."""
    from tomewise.sources import tables

    plan = (
        tables.books(spark, sf).select("book_id", "num_pages")
        ._jdf.queryExecution().executedPlan().toString()
    )
    schema = plan[plan.index("ReadSchema") :].splitlines()[0]
    assert "doc_id" in schema and "text" not in schema


def test_a_stated_year_survives_dated_training(spark):
    dated = spark.createDataFrame([("t", "2001-05-06")], "title string, publication_date string")
    fitted = cleaning.fit_cleaning(dated)
    asked = spark.createDataFrame([("t", 1942), ("t", None)], "title string, publication_year int")
    assert [r.publication_year for r in fitted.transform(asked).collect()] == [1942, 2020]
    strict = cleaning.fit_cleaning(dated, year_mode="reference")
    assert [r.publication_year for r in strict.transform(asked).collect()] == [2020, 2020]


def test_line_budget_goes_by_file_and_place(spark, tmp_path):
    for name, lines in (("b", 50), ("a", 3), ("c", 9)):
        text = "".join(f'{{"book_id": {i}, "title": "{name}"}}\n' for i in range(lines))
        (tmp_path / f"{name}.json").write_text(text.replace('{"book_id": 1,', "BAD", 1))
    got = [(r.title, r.book_id) for r in catalog.scan_json(spark, str(tmp_path), sample_size=7).collect()]
    assert sorted(got) == [("a", 0), ("a", 2), ("b", 0), ("b", 2), ("b", 3)]
    assert catalog.scan_json(spark, str(tmp_path)).count() == 59
