"""Model versions and run metrics that survive concurrent writers and repeated jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.commit_log import CommitLog
from .runs import promote

VERSION_COLUMNS = "model_name string, version long, run_id long, stage string, description string"
METRIC_COLUMNS = "run_id string, key string, value double, ts timestamp"


class VersionRegistry:
    """Registered versions of models: the latest committed row of each (model_name, version) counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.log = CommitLog(spark, path, VERSION_COLUMNS)

    def versions(self) -> DataFrame:
        """Every version in its present stage."""
        return _latest(self.log.read())

    def register(self, versions: DataFrame, key: str | None = None) -> int:
        """Commit versions as they are, with a null description where there is none."""
        if "description" not in versions.columns:
            versions = versions.withColumn("description", F.lit(None).cast("string"))
        return self.log.append(_typed(versions), key)

    def promote(self, new_runs: DataFrame, description: Column, key: str | None = None) -> int:
        """Commit each (model_name, run_id, r2) row as its model's next version, in Production, and
        archive what was there. Only rows that change are written. Of concurrent promotions of a
        model the later one sees the earlier: both get a version, and one is in Production."""

        def change(committed: DataFrame) -> DataFrame:
            before = _latest(committed)
            # only models that get a new version can change
            touched = before.join(new_runs.select("model_name").distinct(), "model_name", "left_semi")
            after = promote(touched, new_runs, description)
            same = touched.select("model_name", "version", F.col("stage").alias("old"), F.col("description").alias("kept"))
            merged = after.join(same, ["model_name", "version"], "left")
            moved = merged.where(~F.col("stage").eqNullSafe(F.col("old")))
            return _typed(moved.withColumn("description", F.coalesce("description", "kept")))

        return self.log.commit(change, key)


def _latest(committed: DataFrame) -> DataFrame:
    state = F.struct("run_id", "stage", "description")
    last = F.max_by(state, "commit_version").alias("last")
    return committed.groupBy("model_name", "version").agg(last).select("model_name", "version", "last.*")


def _typed(rows: DataFrame) -> DataFrame:
    return rows.select(
        "model_name",
        F.col("version").cast("long").alias("version"),
        F.col("run_id").cast("long").alias("run_id"),
        "stage",
        "description",
    )


class MetricsLog:
    """Run metrics, committed in batches. A batch that a repeated job commits again adds nothing."""

    def __init__(self, spark: SparkSession, path: str):
        self.log = CommitLog(spark, path, METRIC_COLUMNS)

    def append(self, metrics: DataFrame, run_id: str, batch: str) -> int:
        """Commit the (run_id, key, value, ts) rows of one batch of a run."""
        return self.log.append(metrics, f"{run_id}/{batch}")

    def read(self) -> DataFrame:
        return self.log.read().drop("commit_version")
