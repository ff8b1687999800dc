"""Trees grown level by level, against brute force over the rows of each node."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor

from tomewise.operators import training, trees
from tomewise.operators.trees import ExtraTrees, Growth, RandomForest, SecondOrderBoosting, TreeEnsemble


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 6))
    x[rng.random(x.shape) < 0.05] = np.nan
    x[:, 5] = 1.0  # nothing to split on
    y = np.nan_to_num(x[:, 0]) + np.where(np.isnan(x[:, 1]), 2, x[:, 1] > 0.3) + 0.1 * rng.normal(size=1500)
    return x, y


@pytest.fixture(scope="module")
def frame(spark, data):
    rows = [(Vectors.dense(a), float(b), i % 2) for i, (a, b) in enumerate(zip(*data, strict=True))]
    return spark.createDataFrame(rows, ["features", "label", "part"]).repartition(4).cache()


def score(g, h, growth):
    return max(abs(g) - growth.alpha, 0) ** 2 / (h + growth.l2)


def checked(nodes, x, g, growth, best_of=None):
    """Every node's cover, value and gain from its rows; ``best_of`` gives the gains it chose among."""
    by_key = {(n[0], n[1]): n for n in nodes}
    for tree in sorted({n[0] for n in nodes}):
        members = {1: np.arange(len(x))}
        for (_, node), (_, _, feature, threshold, missing_left, value, gain, cover) in sorted(
            (k, v) for k, v in by_key.items() if k[0] == tree
        ):
            own = members[node]
            total = g[own].sum()
            assert cover == len(own)
            assert value == pytest.approx(-np.sign(total) * max(abs(total) - growth.alpha, 0) / (len(own) + growth.l2), abs=1e-9)
            if feature < 0:
                assert (tree, 2 * node) not in by_key
                continue
            v = x[own, feature]
            left = np.where(np.isnan(v), missing_left, v <= threshold)
            a, b = own[left], own[~left]
            assert len(a) and len(b)
            assert gain == pytest.approx(score(g[a].sum(), len(a), growth) + score(g[b].sum(), len(b), growth) - score(total, len(own), growth), abs=1e-7)
            if best_of is not None:
                assert gain == pytest.approx(best_of(own), abs=1e-7)
            members[2 * node], members[2 * node + 1] = a, b


def same(nodes):
    return sorted((n[0], n[1], n[2], round(n[3], 9), n[4], round(n[5], 9)) for n in nodes)


EXTRA = Growth(random=True, trees=4, max_depth=6, min_split=5)
BOOST = Growth(random=False, trees=3, max_depth=4, alpha=0.5, l2=2.0, columns=0.7, rows=0.8)


def test_randomised_trees(frame, data):
    x, y = data
    model = ExtraTrees(EXTRA).fit(frame)
    checked(model.nodes, x, -y, EXTRA)
    assert len({n[3] for n in model.nodes if n[1] == 1}) == 4  # thresholds of the roots differ
    assert not any(n[2] == 5 for n in model.nodes) and max(n[1] for n in model.nodes) < 2 << EXTRA.max_depth
    assert min(n[7] for n in model.nodes if n[2] >= 0) >= 5
    got = np.array([r.prediction for r in model.transform(frame).select("prediction").collect()])
    assert len(got) == len(x) and np.isfinite(got).all()


@pytest.mark.parametrize("gather", [0, 200])
def test_trees_do_not_depend_on_where_they_are_finished(frame, gather):
    whole = ExtraTrees(EXTRA).fit(frame).nodes
    assert same(ExtraTrees(replace(EXTRA, gather=gather)).fit(frame.coalesce(1)).nodes) == same(whole)
    whole = SecondOrderBoosting(BOOST, 0.3).fit(frame).nodes
    assert same(SecondOrderBoosting(replace(BOOST, gather=gather), 0.3).fit(frame.coalesce(1)).nodes) == same(whole)


@pytest.mark.parametrize(("gather", "levels"), [(300, None), (0, 4)])
def test_small_nodes_take_one_job_and_the_last_level_none(frame, monkeypatch, gather, levels):
    calls = {"_finished": 0, "_level": 0}
    for name in calls:
        def counted(*args, name=name, own=getattr(trees, name)):
            calls[name] += 1
            return own(*args)

        monkeypatch.setattr(trees, name, counted)
    SecondOrderBoosting(replace(BOOST, trees=1, gather=gather), 0.3).fit(frame)
    assert calls["_finished"] == (1 if gather else 0)
    assert levels is None or calls["_level"] == levels


def test_passes_of_a_bounded_number_of_sums(frame, monkeypatch):
    whole = ExtraTrees(replace(EXTRA, gather=0, max_depth=4, trees=30)).fit(frame).nodes
    monkeypatch.setattr(trees, "CELLS", 1)
    assert same(ExtraTrees(replace(EXTRA, gather=0, max_depth=4, trees=30)).fit(frame).nodes) == same(whole)


def test_second_order_boosting_takes_the_best_quantile_split(frame, data):
    x, y = data
    growth = replace(BOOST, trees=1, columns=1.0, rows=1.0)
    model = SecondOrderBoosting(growth, 0.3).fit(frame)
    assert model.base == pytest.approx(y.mean())
    g = y.mean() - y
    edges = trees.bin_edges(trees.rows_of(frame, "label"), x.shape[1])

    def best_of(own):
        best = 0.0
        for f in range(x.shape[1]):
            v = x[own, f]
            for t in edges[f][np.isfinite(edges[f])]:
                for missing in (False, True):
                    left = np.where(np.isnan(v), missing, v <= t)
                    a, b = own[left], own[~left]
                    if len(a) and len(b):
                        gain = score(g[a].sum(), len(a), growth) + score(g[b].sum(), len(b), growth) - score(g[own].sum(), len(own), growth)
                        best = max(best, gain)
        return best

    checked(model.nodes, x, g, growth, best_of)


def test_boosting_learns_and_keeps_its_margins(spark, frame, data, monkeypatch, tmp_path):
    x, y = data
    monkeypatch.setattr(trees, "MARGIN_EVERY", 4)
    model = SecondOrderBoosting(replace(BOOST, trees=10, max_depth=5), 0.3).fit(frame)
    error = lambda m: ((m.predict(x) - y) ** 2).mean()
    errors = [error(TreeEnsemble([n for n in model.nodes if n[0] < k], model.base, 0.3, 6)) for k in range(11)]
    assert all(b < a for a, b in zip(errors, errors[1:], strict=False)) and errors[-1] < 0.1 * errors[0]
    seen = {t: {n[2] for n in model.nodes if n[0] == t and n[2] >= 0} for t in range(10)}
    assert all(len(s) <= 4 for s in seen.values()) and len(set.union(*seen.values())) == 5  # 0.7 of 6 columns a tree
    model.save(spark, str(tmp_path / "m"))
    again = TreeEnsemble.load(spark, str(tmp_path / "m"))
    assert np.array_equal(again.predict(x), model.predict(x))
    shares = model.featureImportances.toArray()
    assert shares.sum() == pytest.approx(1) and set(np.argsort(-shares)[:2]) == {0, 1} and shares[5] == 0


def test_randomised_trees_are_as_good_as_a_forest(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1600, 5))
    y = x[:, 0] * 2 + np.sin(3 * x[:, 1]) + (x[:, 2] > 0) + 0.3 * rng.normal(size=1600)
    rows = [(Vectors.dense(a), float(b)) for a, b in zip(x, y, strict=True)]
    train, test = (spark.createDataFrame(part, ["features", "label"]).coalesce(2).cache() for part in (rows[:1200], rows[1200:]))
    extra = ExtraTrees(Growth(random=True, trees=40, max_depth=20, min_split=5)).fit(train)
    forest = RandomForestRegressor(numTrees=40, maxDepth=14, featureSubsetStrategy="all", seed=1).fit(train)

    def r2(model):
        got = [(r.label, r.prediction) for r in model.transform(test).select("label", "prediction").collect()]
        a, p = np.array(got).T
        return 1 - ((a - p) ** 2).sum() / ((a - a.mean()) ** 2).sum()

    assert r2(extra) > r2(forest) - 0.02


def test_one_row_and_no_rows(spark):
    frame = spark.createDataFrame([(Vectors.dense([1.0]), 2.0)], ["features", "label"])
    for model in (ExtraTrees(EXTRA), SecondOrderBoosting(BOOST)):
        with pytest.raises(ValueError):
            model.fit(frame.limit(0))
        assert model.fit(frame).predict(np.array([[5.0]])).tolist() == [2.0]


FOREST = Growth(random=False, trees=3, max_depth=5, min_leaf=2, bootstrap=True)


def test_forest_splits_are_the_best_for_the_rows_drawn(frame, data):
    """Covers, values and gains of every node from its rows, each as often as it was drawn."""
    model = RandomForest(FOREST).fit(frame)
    rows = trees.rows_of(frame, "label", key="book_id")
    held = rows.toPandas()
    x, y, row = np.stack(held["x"]), held["label"].to_numpy(), held["row"].to_numpy()
    code = trees.coded(x, trees.forest_edges(rows, x.shape[1], len(x)))
    growth = replace(FOREST, trees=1)
    for tree in range(3):
        times = np.searchsorted(trees.DRAWS, trees.mixed(growth.seed + 2, tree, row), side="right")
        assert 0.9 < times.mean() < 1.1 and times.max() >= 3 and (times == 0).mean() == pytest.approx(np.exp(-1), abs=0.05)
        drawn = np.repeat(np.arange(len(x)), times)
        g = (model.base - y)[drawn]

        def best_of(own, drawn=drawn, g=g):
            best, c = 0.0, code[drawn[own]]
            for f in range(x.shape[1]):
                for edge in range(trees.FOREST_BINS - 1):
                    for missing in (False, True):
                        left = np.where(c[:, f] == trees.FOREST_BINS, missing, c[:, f] <= edge)
                        a, b = own[left], own[~left]
                        if min(len(a), len(b)) >= 2:
                            best = max(best, score(g[a].sum(), len(a), growth) + score(g[b].sum(), len(b), growth) - score(g[own].sum(), len(own), growth))
            return best

        checked([(0, *n[1:]) for n in model.nodes if n[0] == tree], x[drawn], g, growth, best_of)


def test_forest_does_not_depend_on_where_it_is_finished(frame):
    some = replace(FOREST, node_features="0.5")
    whole = RandomForest(some).fit(frame)
    assert same(RandomForest(replace(some, gather=150)).fit(frame.coalesce(1)).nodes) == same(whole.nodes)
    assert same(RandomForest(replace(some, gather=0)).fit(frame).nodes) == same(whole.nodes)
    assert np.isfinite(whole.predict(np.zeros((1, 6)))).all()


def test_named_forest_takes_one_job_for_small_nodes(spark, frame, monkeypatch):
    """Spark's forest made dense sums of every feature for each of some 1,000 nodes a tree in every task."""
    calls = []
    monkeypatch.setattr(trees, "_finished", lambda *a, own=trees._finished: calls.append(1) or own(*a))
    forest = training.regressor("random_forest", label="label", n_estimators=20, max_depth=10).fit(frame)
    assert calls == [1] and {n[0] for n in forest.nodes} == set(range(20))
    with pytest.raises(AnalysisException):
        training.regressor("random_forest", label="label").setFeaturesCol("none").fit(frame)


def test_rows_of_equal_features_are_drawn_apart(spark):
    rows = [(i, Vectors.dense([1.0]), 2.0) for i in range(100)]
    frame = spark.createDataFrame(rows, ["book_id", "features", "label"])
    assert trees.rows_of(frame, "label", key="book_id").select("row").distinct().count() == 100
    assert RandomForest(FOREST).fit(frame).predict(np.array([[5.0]])).tolist() == [2.0]
    with pytest.raises(ValueError):
        RandomForest(FOREST).fit(frame.limit(0))


def test_split_points_and_numbers_of_features():
    assert trees.split_points(np.array([1.0, 2.0, 4.0]), np.array([5, 1, 1]), 32) == [1.5, 3.0]
    points = trees.split_points(np.arange(1000.0), np.array([9000, *[1] * 999]), 32)
    assert len(points) == 31 and points[:2] == [0.5, 1.5]  # behind the frequent value, as early as may be
    even = trees.split_points(np.arange(320.0), np.ones(320, int), 32)
    assert even == [9.5 + 10 * k for k in range(31)]
    got = {s: trees.features_of_node(s, 43) for s in ("all", "0.8", "sqrt", "log2", "onethird", "7", "1.0")}
    assert got == {"all": 43, "0.8": 35, "sqrt": 7, "log2": 6, "onethird": 15, "7": 7, "1.0": 43}
    with pytest.raises(ValueError):
        trees.features_of_node("some", 43)


def test_forest_is_as_good_as_spark_s(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2400, 8))
    y = x[:, 0] * 2 + np.sin(3 * x[:, 1]) + (x[:, 2] > 0) + 0.3 * rng.normal(size=2400)
    rows = [(Vectors.dense(a), float(b)) for a, b in zip(x, y, strict=True)]
    train, test = (spark.createDataFrame(part, ["features", "label"]).coalesce(2).cache() for part in (rows[:1800], rows[1800:]))
    own = RandomForest(Growth(random=False, trees=30, max_depth=10, bootstrap=True)).fit(train)
    spark_s = RandomForestRegressor(numTrees=30, maxDepth=10, featureSubsetStrategy="all", seed=1).fit(train)

    def r2(model):
        a, p = np.array([(r.label, r.prediction) for r in model.transform(test).select("label", "prediction").collect()]).T
        return 1 - ((a - p) ** 2).sum() / ((a - a.mean()) ** 2).sum()

    assert r2(own) == pytest.approx(r2(spark_s), abs=0.02)


def test_boosted_trees_of_a_small_table_take_no_job_each(frame, monkeypatch):
    """Each tree took two jobs or more, which was most of the time of 300 trees."""
    calls = []
    for name in ("_level", "_finished"):
        monkeypatch.setattr(trees, name, lambda *a, own=getattr(trees, name), **k: calls.append(1) or own(*a, **k))
    model = SecondOrderBoosting(BOOST, 0.3).fit(frame)
    assert not calls and {n[0] for n in model.nodes} == set(range(BOOST.trees))


def test_nodes_are_looked_up_in_bounded_groups(spark, frame, data, monkeypatch, tmp_path):
    """The driver held a tuple for each node of all trees, which follow the rows in number."""
    x, _ = data
    forest = RandomForest(FOREST).fit(frame)
    whole, want = sorted(forest.nodes), forest.predict(x)
    assert not forest._nodes and np.allclose(forest.predict(x), TreeEnsemble(whole, forest.base, forest.scale, 6).predict(x))
    shares = forest.featureImportances
    monkeypatch.setattr(trees, "GROUP", 1)
    assert all(len(set(g["tree"].tolist())) == 1 for g in forest.groups())
    vectors = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["i", "features"])
    got = [r.prediction for r in forest.transform(vectors).orderBy("i").collect()]
    assert np.allclose(got, want, atol=1e-12) and forest.featureImportances == shares
    forest.save(spark, str(tmp_path / "forest"))
    assert sorted(TreeEnsemble.load(spark, str(tmp_path / "forest")).nodes) == whole


def test_ties_do_not_follow_the_order_of_sums():
    edges, rng = np.array([[0.5], [0.5]]), np.random.default_rng(1)
    left = rng.random(40) < 0.5
    code = np.stack([left, ~left]).astype(np.uint8)  # both features part the rows alike, the other way round
    g, growth = rng.normal(size=40), replace(BOOST, trees=1, columns=1.0, rows=1.0, max_depth=1)
    for _ in range(20):
        order = rng.permutation(40)
        root, ones = trees.Open(np.array([0]), np.array([1])), np.ones(40)
        made = trees.finish_binned(np.ascontiguousarray(code[:, order]), g[order], ones, np.zeros(40, int), root, edges, growth)
        assert made["feature"][0] == 0
