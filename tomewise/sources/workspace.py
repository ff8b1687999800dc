"""Shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"
#: Whether Spark deletes the shuffle files of a query as soon as it ends, not when its objects are collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPLIT_BYTES = 128 * 1024 * 1024  # a full-size file split


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting (tests) gets a folder of its own.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tomewise-")
    spark.conf.set(SETTING, folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df, name: str):
    """Write a frame that several later steps read, and go on from the written table.

    Nothing reads the shuffle files of the write again, so they go with it.
    """
    path, conf = new_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df, key: str):
    """Rows hashed out over all cores where the input is too small to be split that far.

    A table in a few small files would otherwise be worked on by a few tasks. Tables of at
    least one full-size split per core are left as they lie: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    stored = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores, key) if stored < cores * SPLIT_BYTES else df
