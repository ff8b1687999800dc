"""What written steps leave on disk."""

import random
import time
from pathlib import Path

from pyspark.sql import functions as F

from tomewise.llm import jaccard_join
from tomewise.sources import workspace


def shuffle_bytes(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return sum(p.stat().st_size for d in folders for p in Path(str(d)).rglob("shuffle_*.data"))


def test_shuffle_files_go_when_a_step_is_written(spark):
    before = shuffle_bytes(spark)
    rows = spark.range(200_000).select("id", F.xxhash64("id").alias("x")).repartition(8, "x")
    assert workspace.cut(rows, "shuffled").count() == 200_000
    for _ in range(50):  # files are deleted in the background
        if shuffle_bytes(spark) < before + 500_000:
            break
        time.sleep(0.2)
    assert shuffle_bytes(spark) < before + 500_000
    assert spark.conf.get(workspace.CLEANUP) == spark.newSession().conf.get(workspace.CLEANUP)


def test_written_steps_of_the_near_copy_join_are_small(spark, monkeypatch):
    draw = random.Random(5)
    texts = [" ".join(f"w{draw.randrange(5000)}" for _ in range(400)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts + texts[:20])), "doc_id long, text string")
    written = []

    def kept(df, name):
        out = workspace.cut(df, name)
        written.extend(p.stat().st_size for f in out.inputFiles() for p in [Path(f.removeprefix("file://"))])
        return out

    monkeypatch.setattr(jaccard_join, "cut", kept)
    found = {r.doc_id: r.component_id for r in jaccard_join.join(docs).collect()}
    assert found == {i: i % 300 for i in range(320)}
    assert sum(written) < 0.25 * sum(map(len, texts))
