"""Fitted transforms against numpy and by hand."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tomewise.operators import distribution, scaling, selection, text_vectors
from tomewise.operators.encoding import fit_label_codes, label_encode
from tomewise.plans.blocks import SemanticBlock, TraditionalBlock
from tomewise.operators import cleaning
from tomewise.sources import tables
from tomewise.sources.workspace import new_path


def test_scaler_uses_population_deviation_and_zeroes_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, c double")
    fitted = scaling.fit_column_scaler(df, ["a", "c"])
    rows = fitted.transform(df).collect()
    x = np.array([1.0, 2.0, 4.0])
    assert [r.a for r in rows] == pytest.approx(((x - x.mean()) / x.std()).tolist())
    assert [r.c for r in rows] == [0.0, 0.0, 0.0]
    again = scaling.ColumnScaler.from_frame(fitted.to_frame(spark))
    assert again == fitted


def test_vector_scaler(spark):
    x = np.random.default_rng(1).normal(size=(50, 4))
    x[:, 2] = 7
    df = spark.createDataFrame([(r.tolist(),) for r in x], "embedding array<double>")
    got = np.array([r[0] for r in scaling.fit_vector_scaler(df).transform(df).collect()])
    std = x.std(axis=0)
    assert got == pytest.approx((x - x.mean(axis=0)) / np.where(std < 1e-12, 1, std), abs=1e-9)


def test_label_codes(spark):
    df = spark.createDataFrame([("fr",), (None,), ("de",), ("fr",)], "language_code string")
    codes = fit_label_codes(df, "language_code")
    assert sorted(map(tuple, codes.collect())) == [("de", 0), ("en", 1), ("fr", 2)]
    new = spark.createDataFrame([("xx",), (None,)], "language_code string")
    got = label_encode(new, codes, "language_code").collect()
    assert sorted(r.language_code_encoded for r in got) == [-1, 1]


def test_many_label_codes_are_dense_and_sorted(spark):
    df = spark.range(3000).select(F.format_string("k%05d", "id").alias("c")).repartition(6)
    got = fit_label_codes(df, "c", small=10).orderBy("value").collect()
    assert [r.code for r in got] == list(range(3000))


def test_tfidf_by_hand(spark):
    docs = ["red fox red", "red dog", "the fox and the dog", ""]
    df = spark.createDataFrame(list(enumerate(docs)), "book_id long, t string")
    fitted = text_vectors.fit_tfidf(df, {"t": (F.col("t"), 10)})["t"]
    # pairs form after stop words go, and "fox dog" or "red dog" occur in one row only
    assert fitted.vocabulary == ["dog", "fox", "red"]
    assert fitted.doc_freq == [2, 2, 2]
    idf = math.log(5 / 3) + 1
    assert fitted.idf == pytest.approx([idf] * 3)
    rows = fitted.transform(df, F.col("t")).orderBy("book_id").collect()
    assert rows[0].tfidf == pytest.approx([0, 1 / math.sqrt(5), 2 / math.sqrt(5)])
    assert rows[3].tfidf == [0.0, 0.0, 0.0]


def test_vocabulary_is_the_most_frequent_with_ties_in_order(spark):
    df = spark.createDataFrame([(i, "bb aa cc cc") for i in range(3)], "book_id long, t string")
    fitted = text_vectors.fit_tfidf(df, {"t": (F.col("t"), 2)})["t"]
    assert fitted.vocabulary == ["aa", "cc"]


def test_no_terms_raise(spark):
    df = spark.createDataFrame([(1, "the and"), (2, "")], "book_id long, t string")
    with pytest.raises(ValueError):
        text_vectors.fit_tfidf(df, {"t": (F.col("t"), 5)})


def test_svd_matches_numpy(spark):
    x = np.random.default_rng(4).normal(size=(80, 6))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(5)
    fitted = text_vectors.fit_svd(df, {"v": 3})["v"]
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert fitted.singular_values == pytest.approx(s[:3].tolist())
    assert np.abs(np.array(fitted.components)) == pytest.approx(np.abs(vt[:3]), abs=1e-9)
    with pytest.raises(ValueError):
        text_vectors.fit_svd(df, {"v": 9})


def test_svd_of_more_places_than_directions(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 150)) * (rng.random((600, 150)) < 0.1) * np.linspace(3, 0.5, 150)
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(70)
    fitted = text_vectors.fit_svd(df, {"v": 6})["v"]
    values, vectors = np.linalg.eigh(x.T @ x)
    assert fitted.singular_values == pytest.approx(np.sqrt(values[::-1][:6]).tolist(), rel=1e-4)
    projected = x @ np.array(fitted.components).T
    gram = projected.T @ projected
    assert gram == pytest.approx(np.diag(np.array(fitted.singular_values) ** 2), abs=1e-8)
    assert np.abs(np.sum(np.array(fitted.components) * vectors[:, ::-1][:, :6].T, axis=1)) == pytest.approx(
        np.ones(6), abs=1e-3
    )


def test_svd_of_twenty_thousand_places(spark):
    """Rows of few entries among 20,000 places: the driver holds places x directions only."""
    places, rng = 20_000, np.random.default_rng(6)
    left, right = rng.normal(size=(120, 3)), np.zeros((3, places))
    for c in range(3):
        right[c, rng.choice(places, 40, replace=False)] = rng.normal(size=40) * (3 - c)
    x = left @ right
    entries = [
        (i, [int(p) for p in np.flatnonzero(r)], [float(v) for v in r[np.flatnonzero(r)]]) for i, r in enumerate(x)
    ]
    df = spark.createDataFrame(entries, "id long, at array<int>, w array<double>").repartition(4)
    dense = F.transform(F.sequence(F.lit(0), F.lit(places - 1)), lambda p: F.coalesce(F.try_element_at(F.map_from_arrays("at", "w"), p), F.lit(0.0)))
    fitted = text_vectors.fit_svd(df.select(dense.alias("v")), {"v": 3})["v"]
    assert np.shape(fitted.components) == (3, places)
    assert fitted.singular_values == pytest.approx(np.linalg.svd(x, compute_uv=False)[:3].tolist(), rel=1e-9)


def test_svd_of_rows_without_entries_or_vectors(spark):
    rows = [([0.0, 0.0, 0.0],), (None,), ([0.0, 2.0, 0.0],)]
    fitted = text_vectors.fit_svd(spark.createDataFrame(rows, "v array<double>"), {"v": 2})["v"]
    assert fitted.singular_values == pytest.approx([2.0, 0.0])
    assert np.abs(fitted.components[0]) == pytest.approx([0.0, 1.0, 0.0])


def sk_uniform(x, grid, shares):
    """Average of the interpolation from the left and from the right."""
    up = np.interp(x, grid, shares)
    down = -np.interp(-x, -grid[::-1], -shares[::-1])
    out = 0.5 * (up + down)
    out[x == grid[0]], out[x == grid[-1]] = 0.0, 1.0
    return out


def test_quantile_transform(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.integers(0, 20, 150).astype(float), rng.normal(5, 3, 50)])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "book_id long, x double")
    fitted = distribution.fit_quantile_transform(df, ["x"], n_quantiles=60)
    shares = np.linspace(0, 1, 60)
    grid = np.quantile(x, shares)
    new = np.concatenate([x, [-100.0, 100.0]])
    rows = spark.createDataFrame([(i, float(v)) for i, v in enumerate(new)], "book_id long, x double")
    got = [r.x for r in fitted.uniform(rows).orderBy("book_id").collect()]
    want = sk_uniform(x, grid, shares).tolist() + [0.0, 1.0]
    assert got == pytest.approx(want, abs=1e-9)
    normal = [r.x for r in fitted.normal(rows).orderBy("book_id").collect()]
    assert max(normal) == -min(normal) == distribution.CLIP


def test_decile_edges_drop_duplicates(spark):
    df = spark.createDataFrame([(0.0,)] * 50 + [(float(i),) for i in range(50)], "x double")
    edges = distribution.decile_edges(df, "x")
    assert len(edges) < 11 and edges == sorted(set(edges))
    labels = {r[0] for r in df.select(distribution.decile_bucket("x", edges)).collect()}
    assert labels == set(range(len(edges) - 1))


def test_power_transform(spark):
    x = np.random.default_rng(0).gamma(2.0, 1.0, 400) - 0.3
    df = spark.createDataFrame([(float(v),) for v in x], "y double")
    fitted = distribution.fit_power_transform(df, "y")

    def loglik(lam):
        up = np.where(x >= 0, ((np.abs(x) + 1) ** lam - 1) / lam, 0)
        down = np.where(x < 0, -((1 + np.abs(x)) ** (2 - lam) - 1) / (2 - lam), 0)
        return -len(x) / 2 * np.log((up + down).var()) + (lam - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))

    low, high = -1.0, 2.0
    for _ in range(60):
        middle = (low + high) / 2
        rising = loglik(middle + 1e-4) > loglik(middle - 1e-4)
        low, high = (middle, high) if rising else (low, middle)
    assert fitted.lam == pytest.approx((low + high) / 2, abs=1e-6)
    z = df.select(fitted.forward(F.col("y")).alias("z"), "y")
    stats = z.agg(F.avg("z"), F.stddev_pop("z")).first()
    assert tuple(stats) == pytest.approx((0, 1), abs=1e-9)
    back = z.select(fitted.inverse(F.col("z")) - F.col("y")).collect()
    assert max(abs(r[0]) for r in back) < 1e-9


def test_power_transform_of_values_far_from_zero_at_bounds_and_without_spread(spark):
    far = np.random.default_rng(3).normal(5e4, 3.0, 500)
    rows = [(float(v), 2.5, float(np.exp(3 * g)), None) for v, g in zip(far, np.random.default_rng(4).gamma(1, 1, 500))]
    df = spark.createDataFrame(rows, "far double, same double, heavy double, nothing double")
    fitted = distribution.fit_power_transform(df, "far")
    z = df.agg(F.avg(fitted.forward(F.col("far"))), F.stddev_pop(fitted.forward(F.col("far")))).first()
    assert tuple(z) == pytest.approx((0, 1), abs=1e-3)
    assert distribution.fit_power_transform(df, "heavy", low=0.5, high=2.0).lam == 0.5
    assert distribution.fit_power_transform(df, "same") == distribution.PowerTransform(1.0, 2.5, 0.0)
    assert distribution.fit_power_transform(df, "nothing") == distribution.PowerTransform(1.0, 0.0, 0.0)


def test_select_k_best_orders_by_f_and_drops_constants(spark):
    rng = np.random.default_rng(5)
    y = rng.normal(size=200)
    rows = [(float(v), float(v + e), float(n), 1.0) for v, e, n in zip(y, rng.normal(size=200), rng.normal(size=200))]
    df = spark.createDataFrame(rows, "average_rating double, near double, noise double, same double")
    best = selection.select_k_best(df, ["noise", "same", "near"], k=5).collect()
    assert [r.feature for r in best] == ["near", "noise"]
    r = np.corrcoef([q[1] for q in rows], y)[0, 1]
    assert best[0].f_score == pytest.approx(r * r / (1 - r * r) * 198)


def test_unfitted_blocks_refuse(spark):
    df = spark.createDataFrame([("t", "d")], "title string, description string")
    with pytest.raises(ValueError, match="fitted"):
        TraditionalBlock().transform(df)
    with pytest.raises(ValueError, match="fitted"):
        SemanticBlock().transform(df)
    with pytest.raises(ValueError, match="missing"):
        TraditionalBlock().fit(df.select("title"))


def test_saved_block_transforms_alike(spark, sf):
    clean = cleaning.preprocess(tables.books(spark, sf))
    fitted, path = TraditionalBlock().fit(clean), new_path(spark, "block")
    fitted.save(spark, path)
    loaded = TraditionalBlock.load(spark, path)
    names = fitted.features()
    assert len(names) == 43 + 10 + 20 + 1 + 10 and loaded.features() == names
    a = fitted.transform(clean).orderBy("book_id").toPandas()
    b = loaded.transform(clean).orderBy("book_id").toPandas()
    assert np.allclose(a[names], b[names], atol=1e-9)


def test_saved_stop_words_and_absent_languages_come_back(spark, tmp_path):
    rows = [("alpha beta gamma", "delta alpha"), ("beta beta alpha", "delta beta"), ("gamma delta", "alpha")] * 4
    df = spark.createDataFrame(rows, "title string, description string")
    own = text_vectors.fit_tfidf(df, {"t": (text_vectors.title_source(), 5)}, 1, ("beta",))["t"]
    again = text_vectors.TfIdf.from_frame(own.to_frame(spark))
    assert again == own and "beta" not in again.vocabulary


def test_first_terms_match_a_count_of_all_words_and_pairs(spark):
    """Pairs that cannot be among the first terms are not counted; those that can are, level ones too."""
    draw, letters = np.random.default_rng(5), "the ax bo cu du ée ﬁx Straße naïve x _y 7 ½½ ŝoŝo ŝo日 日本 本 new".split()
    texts = [" ".join(draw.choice(letters, draw.integers(0, 9))) + draw.choice(["", ".", " !", "—ax"]) for _ in range(120)]
    df = spark.createDataFrame([(t,) for t in [*texts, "", None]], "t string")
    for size, min_df, stop in ((3, 2, ("the",)), (12, 3, ()), (60, 1, ("the", "new")), (4000, 2, ("the",))):
        rows = text_vectors.terms(df.where("t IS NOT NULL"), F.col("t"), stop).select("terms").collect()
        tf, n = Counter(t for r in rows for t in r.terms), Counter(t for r in rows for t in set(r.terms))
        plain = sorted((-tf[t], t, n[t]) for t in tf if n[t] >= min_df)[:size]
        found = text_vectors.top_terms(df, {"s": (F.col("t"), size)}, stop, min_df)["s"]
        assert found == [(t, -c, k) for c, t, k in plain]


def test_pairs_of_rare_words_are_not_counted(spark, monkeypatch):
    """All words but one are rare: what is counted after the words must not grow with their number."""
    df = spark.createDataFrame([(f"ax bo ax bo w{i}a w{i}b w{i}c",) for i in range(300)], "t string")
    counted, plain = [], text_vectors._counted

    def noted(*a):
        counted.append(plain(*a))
        return counted[-1]

    monkeypatch.setattr(text_vectors, "_counted", noted)
    top = text_vectors.top_terms(df, {"s": (F.col("t"), 2)}, (), 1)["s"]
    assert [t for t, _, _ in top] == ["ax", "ax bo"]
    assert counted[-1].count() == 2


def test_few_places_take_no_power_steps(spark, monkeypatch):
    x = np.random.default_rng(3).normal(size=(300, 256))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(3)
    monkeypatch.setattr(text_vectors, "_power_step", None)
    fitted = text_vectors.fit_svd(df, {"v": 64})["v"]
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert fitted.singular_values == pytest.approx(s[:64].tolist(), rel=1e-9)
    assert np.abs(np.array(fitted.components) @ vt[:64].T).diagonal() == pytest.approx(np.ones(64), abs=1e-6)
