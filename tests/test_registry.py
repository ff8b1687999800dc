"""Commits: one number for one writer, repeated keys, and what readers see."""

from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from tomewise.operators.registry import MetricsLog, VersionRegistry
from tomewise.sources.commit_log import CommitLog, TooManyConflicts
from tomewise.sources.workspace import new_path

NEW = "model_name string, run_id long, r2 double"


def said():
    return F.format_string("R2 = %.2f", "r2")


def test_concurrent_promotions_give_two_versions_and_one_in_production(spark):
    path = new_path(spark, "registry")
    first = spark.createDataFrame([("a", 1, 10, "Production"), ("b", 4, 11, "None")], "model_name string, version int, run_id int, stage string")
    VersionRegistry(spark, path).register(first)
    start = Barrier(2)

    def promote(run):
        start.wait()
        VersionRegistry(spark, path).promote(spark.createDataFrame([("a", run, 0.3)], NEW), said())

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(promote, [20, 21]))
    registry = VersionRegistry(spark, path)
    rows = {(r.model_name, r.version): r for r in registry.versions().collect()}
    assert sorted(rows) == [("a", 1), ("a", 2), ("a", 3), ("b", 4)]
    assert [rows["a", v].stage for v in (1, 2, 3)] == ["Archived", "Archived", "Production"]
    assert {rows["a", 2].run_id, rows["a", 3].run_id} == {20, 21}
    # an archived version keeps its description
    assert rows["a", 2].description == rows["a", 3].description == "R2 = 0.30"
    assert rows["b", 4].stage == "None"
    assert [e.version for e in registry.log.entries()] == [1, 2, 3]


def test_a_repeated_promotion_is_seen_once_and_untouched_rows_are_not_written(spark):
    registry = VersionRegistry(spark, new_path(spark, "registry"))
    new = spark.createDataFrame([("a", 5, 0.5)], NEW)
    assert registry.versions().count() == 0
    assert [registry.promote(new, said(), "job 7"), registry.promote(new, said(), "job 7")] == [1, 1]
    assert [(r.version, r.stage) for r in registry.versions().collect()] == [(1, "Production")]
    registry.promote(spark.createDataFrame([("b", 6, 0.5)], NEW), said())
    assert registry.log.read().where("commit_version = 2").count() == 1


def test_repeated_metrics_are_seen_once(spark):
    log = MetricsLog(spark, new_path(spark, "metrics"))
    rows = spark.createDataFrame([("r1", "r2", 0.3), ("r1", "mae", None)], "run_id string, key string, value double")
    rows = rows.withColumn("ts", F.current_timestamp())
    for batch in ("0", "0", "1"):
        log.append(rows, "r1", batch)
    assert log.read().count() == 4


def test_unfinished_writers_leave_nothing_that_counts(spark):
    log = CommitLog(spark, new_path(spark, "log"), "x long")
    log.append(spark.range(3).select(F.col("id").alias("x")))
    spark.range(9).select(F.col("id").alias("x")).write.parquet(f"{log.path}/data/lost")
    assert log.read().count() == 3
    assert not log._put_if_absent(f"{log.path}/log/{1:012d}.json", "{}")
    with pytest.raises(TooManyConflicts):
        log.append(spark.range(1).select(F.col("id").alias("x")), attempts=0)
