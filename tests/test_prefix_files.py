from pathlib import Path

from tomewise.queries.source_queries import prefix_limit_json


def test_lines_are_written_by_many_tasks(spark, sf):
    coalesce, shared = "spark.sql.adaptive.coalescePartitions.enabled", Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("files-json-*"))
    spark.conf.set(coalesce, "false")
    try:
        got = [r.book_id for r in prefix_limit_json(spark, sf).collect()]
    finally:
        spark.conf.unset(coalesce)
    (path,) = set(shared.glob("files-json-*")) - before
    assert all(len(list((path / str(i)).glob("part-*"))) > 1 for i in range(3))
    assert got and all(k % 7 for k in got)
