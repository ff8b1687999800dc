"""Nearest neighbours against brute force."""

import tracemalloc
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tomewise.operators import similarity


def frame(spark, vectors, ratings=None, start=0):
    rows = [
        (start + i, [float(x) for x in v], None if ratings is None else float(ratings[i]))
        for i, v in enumerate(vectors)
    ]
    return spark.createDataFrame(rows, "book_id long, embedding array<float>, average_rating double")


def brute(q_ids, q, b_ids, b, k, keep_self):
    def unit(x):
        n = np.linalg.norm(x, axis=1, keepdims=True)
        return x / np.where(n == 0, 1, n)

    sims = np.rint(unit(q) @ unit(b).T * 1e9).astype(np.int64)
    out = {}
    for i, qid in enumerate(q_ids):
        ranked = sorted(
            (-int(sims[i, j]), int(b_ids[j])) for j in range(len(b_ids)) if keep_self or b_ids[j] != qid
        )
        out[qid] = [(n, -s) for s, n in ranked[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.book_id, r.rn)):
        out.setdefault(r.book_id, []).append((r.neighbour_id, round(r.similarity * 1e9)))
    return out


def clustered(n, d=8, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d)) * 4
    x = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, d)) * 0.3
    x[:: max(n // 3, 1)] = 0.0  # zero vectors
    return np.float32(x).astype(float)


@pytest.mark.parametrize("block_rows", [10_000, 40])
@pytest.mark.parametrize("keep_self", [False, True])
def test_equals_brute_force(spark, block_rows, keep_self):
    x = clustered(300)
    ids = np.arange(300)
    bank = frame(spark, x, np.linspace(1, 5, 300))
    got = found(similarity.knn(bank, bank, 7, keep_self, block_rows))
    assert got == brute(ids, x, ids, x, 7, keep_self)


@pytest.mark.parametrize("block_rows", [10_000, 30])
def test_a_third_of_the_rows_are_copies(spark, block_rows):
    x = clustered(240)
    x[::3] = x[1]
    ids = np.arange(240)
    bank = frame(spark, x, np.linspace(1, 5, 240))
    got = found(similarity.knn(bank, bank, 5, block_rows=block_rows))
    assert got == brute(ids, x, ids, x, 5, False)


def test_other_queries_than_bank_and_few_neighbours(spark):
    q, b = clustered(20, seed=5), clustered(4, seed=6)
    got = found(
        similarity.knn(frame(spark, q, start=100), frame(spark, b, [1, 2, 3, 4]), 10)
    )
    assert got == brute(np.arange(100, 120), q, np.arange(4), b, 10, False)
    assert all(len(v) == 4 for v in got.values())


def laid_out(x, n_cells, m):
    """Unit vectors with cells around the first of them, and the bounds of the cells."""
    b = similarity._unit(x, is_query=False)
    d = similarity._distance(b, b[:n_cells])
    own, reach, near = d.argmin(axis=1), np.full(n_cells, -np.inf), np.full((n_cells, m), np.inf)
    for c in range(n_cells):
        nearest = np.sort(d[own == c, c])
        reach[c], near[c, : min(m, len(nearest))] = nearest[-1], nearest[:m]
    return b, own, b[:n_cells], reach, near


def test_a_task_skips_cells_by_its_running_kth_neighbour():
    x = np.random.default_rng(1).normal(size=(3000, 3))
    b, own, pivots, reach, near = laid_out(x, 60, 40)
    q = similarity._unit(x[:100], is_query=True)
    rows, keys, products = similarity._running_top(q, b, own, pivots, reach, near, 40)
    sims = np.rint(q @ b.T * 1e9).astype(np.int64) * len(b) + np.arange(len(b) - 1, -1, -1)
    for i in range(100):
        assert sorted(keys[rows == i]) == sorted(sims[i])[-40:]
    d = similarity._distance(q, pivots)
    visited = d - reach <= similarity._limit(similarity._bounds(d, near, 40))[:, None]
    assert products < 0.95 * (visited @ np.bincount(own, minlength=60)).sum() < 0.5 * len(q) * len(b)


def test_a_query_gives_at_most_k_rows_a_task_and_its_vector_to_each_column_once(spark):
    x = clustered(900, seed=4)
    bank = frame(spark, x, np.linspace(1, 5, 900))
    index = similarity.build_index(bank, 3, block_rows=30)
    assert len(index.pivots) > 20
    asked = bank.select(F.col("book_id").alias("rep"), "embedding").dropDuplicates(["embedding"])
    columns = similarity._Chain(index.pivots, index.sizes, similarity.GRID_ROWS * 30)
    visits = list(similarity._visit(index.pivots, index.reach, index.near, 4, columns)(asked.toArrow().to_batches()))
    tasks = {r: len(c) for b in visits for r, c in zip(b["rep"].to_pylist(), b["columns"].to_pylist(), strict=True)}
    given = {r.rep: r["count"] for r in similarity._block_top(asked, index).groupBy("rep").count().collect()}
    assert given.keys() == tasks.keys()
    assert all(n <= 4 * tasks[rep] for rep, n in given.items())
    assert max(tasks.values()) <= columns.n and sum(tasks.values()) < 0.7 * columns.n * len(tasks)


def test_small_blocks_do_not_send_vectors_more_often(spark):
    x = clustered(900, seed=4)
    bank = frame(spark, x, np.linspace(1, 5, 900))
    index = similarity.build_index(bank, 3, block_rows=30)
    asked = bank.select(F.col("book_id").alias("rep"), "embedding").dropDuplicates(["embedding"])
    given = similarity._block_top(asked, index).groupBy("rep").count().collect()
    assert len(index.pivots) > 20 and all(r["count"] <= 4 for r in given)  # one column, so one task a query


def test_a_task_holds_a_bounded_number_of_similarities():
    x = np.random.default_rng(1).normal(size=(16_384, 4))
    b, own, pivots, reach, near = laid_out(x, 2, 21)
    tracemalloc.start()
    similarity._running_top(similarity._unit(x[:512], is_query=True), b, own, pivots, reach, near, 21)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # all 512 x 16,384 similarities at a time would be 67 MB, and several copies of that


def test_pieces_of_a_chain_are_even_however_full_a_cell_is(spark):
    pivots = similarity._unit(clustered(40, seed=2)[1:6], is_query=False)
    sizes = {0: 10, 1: 5000, 3: 7, 4: 900}  # one cell is empty
    chain = similarity._Chain(pivots, sizes, 500)
    rows = [(c, 10_000 * c + i) for c, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "cell int, id long").withColumn("piece", chain.piece("cell", "id"))
    counts = {r.piece: r["count"] for r in df.groupBy("piece").count().collect()}
    assert set(counts) <= set(range(chain.n)) and max(counts.values()) < 650
    outside = df.where(~F.array_contains(chain.pieces("cell"), F.col("piece")))
    assert outside.count() == 0


def test_empty_bank(spark):
    q = frame(spark, clustered(5))
    assert similarity.knn(q, q.limit(0), 3).count() == 0


def test_aggregates(spark):
    rows = [(1, i + 1, 10 + i, s, r) for i, (s, r) in enumerate([(0.9, 4.0), (0.5, 2.0), (0.1, 3.0)])]
    rows += [(2, 1, 10, -0.5, 4.0)]
    near = spark.createDataFrame(
        rows, "book_id long, rn int, neighbour_id long, similarity double, rating double"
    )
    groups = similarity.rating_stats(), similarity.multiscale(3.3, (2,)), similarity.rating_distribution(2)
    one, two = similarity.aggregate(near, *groups).orderBy("book_id").collect()
    assert one.k20_mean_similar_rating == 3.0
    assert one.k20_std_similar_rating == pytest.approx(np.std([4, 2, 3]))
    assert one.weighted_similar_rating_k2 == pytest.approx((0.9 * 4 + 0.5 * 2) / 1.4)
    assert (one.s10_similar_rating_q25, one.s10_similar_rating_range) == (2.5, 2.0)
    # similarities that do not sum to more than 0 leave the overall mean
    assert two.weighted_similar_rating_k2 == 3.3


def test_sample_is_stable(spark):
    bank = spark.range(5000).withColumnRenamed("id", "book_id")
    a = {r.book_id for r in similarity.bank_sample(bank, 100).collect()}
    b = {r.book_id for r in similarity.bank_sample(bank.repartition(9), 100).collect()}
    assert a == b and len(a) == 100


@pytest.mark.parametrize("block_rows", [10_000, 40])
def test_a_saved_index_answers_like_the_bank_and_is_not_written_again(spark, tmp_path, block_rows):
    x = clustered(300)
    bank = frame(spark, x, np.linspace(1, 5, 300))
    similarity.build_index(bank, 7, block_rows).save(spark, str(tmp_path / "index"))
    index = similarity.NeighbourIndex.load(spark, str(tmp_path / "index"))
    assert (index.pivots is None) == (block_rows > 300)
    queries = bank.where("book_id < 9").select("book_id", "embedding")
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    got = found(similarity.search(queries, index, 7))
    fresh = [p for p in set(shared.iterdir()) - before if p.is_dir()]
    assert {p.name.rsplit("-", 1)[0] for p in fresh} <= {"asked", "visits"}  # nothing of the bank
    assert all(spark.read.parquet(str(p)).select("rep").distinct().count() <= 9 for p in fresh)
    assert got == brute(np.arange(9), x[:9], np.arange(300), x, 7, False)
    with pytest.raises(ValueError):
        similarity.search(queries, index, 8)


def test_the_usual_width_decides(spark):
    x = clustered(30)
    bank = frame(spark, x, np.linspace(1, 5, 30))
    short = frame(spark, [[1.0]], [3.0], start=100)
    got = found(similarity.knn(bank, bank.union(short), 3))
    assert got == brute(np.arange(30), x, np.arange(30), x, 3, False)
    counts = similarity.unsound(bank.union(short)).first()
    assert (counts.n_vectors, counts.n_other_width) == (31, 1)
    other = frame(spark, x[:, :3], start=200).withColumn("average_rating", F.lit(2.0))
    third = frame(spark, x[:, :5], start=300).withColumn("average_rating", F.lit(2.0))
    with pytest.raises(ValueError, match="most frequent width"):
        similarity.knn(bank, bank.union(other).union(third), 3)
