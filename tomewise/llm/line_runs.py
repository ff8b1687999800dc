"""Line dedup over levelled sorted runs of line hashes.

A run is a bucketed, sorted table of the line hashes that a batch of documents brought in first. A
new batch is merge-anti-joined with the runs of all levels: fresh hashes form a run of level 0,
known ones only add to a table of further sightings. ``fanout`` runs of one level are merged into
one run of the next, so that a batch meets few runs. Runs and batches share bucket number and
order, so a merge moves the batch alone, already summed up per hash within each task.

A line's key is the line without [\\x20\\x09-\\x0D] at both ends and with A-Z lower-cased; keys under
``min_chars`` code points are never dropped. Every row counts as one document. Null or empty text
is one empty line. Rows without an id count as documents, and lose a shared line unless no document
with an id holds it. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import new_path
from .common import LOWER, SPACE, UPPER, chunks

RUN_SCHEMA = "line binary, n_docs long, last_doc long"
RESULT = "doc_id long, n_lines long, n_dropped long, kept_text string, kept_sha256 string"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def numbered_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, row, pos, line (hash of the key) of every line that may be dropped."""
    text = F.coalesce("text", F.lit(""))
    lines = docs.select("doc_id", F.xxhash64(text).alias("row"), F.posexplode(F.split(text, "\n")).alias("pos", "raw"))
    keyed = lines.select("doc_id", "row", "pos", line_key(F.col("raw")).alias("key"))
    long_ones = keyed.where(F.length("key") >= min_chars)
    return long_ones.select("doc_id", "row", "pos", F.unhex(F.md5("key")).alias("line"))


class LineRuns:
    """Index of line hashes that grows batch by batch."""

    def __init__(self, spark: SparkSession, min_chars: int = 20, fanout: int = 3, buckets: int | None = None):
        self.spark, self.min_chars, self.fanout = spark, min_chars, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = new_path(spark, "line-runs")
        self.levels: list[list[str]] = [[]]
        self.sightings: list[str] = []

    def _write(self, frame: DataFrame, kind: str) -> str:
        """A bucketed and sorted table in the shared folder."""
        name = f"lines_{kind}_{uuid.uuid4().hex}"
        laid = frame.repartition(self.buckets, "line").sortWithinPartitions("line")
        laid.write.bucketBy(self.buckets, "line").sortBy("line").option("path", f"{self.folder}/{name}").saveAsTable(name)
        return name

    def _tables(self, names: list[str]) -> list[DataFrame]:
        return [self.spark.table(n) for n in names]

    def runs(self) -> list[DataFrame]:
        return self._tables([n for level in self.levels for n in level])

    def add(self, docs: DataFrame) -> None:
        """Takes in a batch of documents that no earlier batch held."""
        keys = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), line_key)
        keys = F.array_distinct(F.filter(keys, lambda k: F.length(k) >= self.min_chars))
        held = docs.select(F.col("doc_id").alias("last_doc"), F.explode(keys).alias("key"))
        held = held.select(F.unhex(F.md5("key")).alias("line"), F.lit(1).alias("n_docs"), "last_doc")
        seen = self._write(_summed(held), "batch")
        batch, known = self.spark.table(seen), self.runs()
        fresh = reduce(lambda b, run: b.join(run, "line", "left_anti"), known, batch)
        again = [batch.join(run, "line", "left_semi") for run in known]
        self.levels[0].append(self._write(fresh, "run") if known else seen)
        if again:
            self.sightings.append(self._write(reduce(DataFrame.unionByName, again), "again"))
        self._compact()

    def _compact(self) -> None:
        for i, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                merged = self._write(reduce(DataFrame.unionByName, self._tables(level)), f"level{i + 1}")
                self.levels[i] = []
                if i + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[i + 1].append(merged)

    def shared(self, min_docs: int = 3) -> DataFrame:
        """line, last_doc of the hashes that at least ``min_docs`` documents hold."""
        # a union of bucketed tables must not pass for one that is laid out by line (Spark 4.1 sums
        # its parts one by one then), so the key is an expression here
        every = [t.withColumn("line", F.substring("line", 1, 16)) for t in self.runs() + self._tables(self.sightings)]
        if not every:
            return self.spark.createDataFrame([], RUN_SCHEMA).select("line", "last_doc")
        return _summed(reduce(DataFrame.unionByName, every)).where(F.col("n_docs") >= min_docs).select("line", "last_doc")


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("line").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))


def drop_shared_lines(docs: DataFrame, index: LineRuns, min_docs: int = 3) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text, kept_sha256 of every row of ``docs``."""
    lines = numbered_lines(docs, index.min_chars)
    hits = lines.join(index.shared(min_docs), "line").where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
    drops = hits.groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r")).agg(F.collect_set("pos").alias("drops"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    at = rows.doc_id.eqNullSafe(drops.d) & (F.xxhash64(rows.text) == drops.r)
    return rows.join(drops, at, "left").select("doc_id", "text", "drops").mapInArrow(_without, RESULT)


def dedup_lines(docs: DataFrame, batches: int = 4, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Drops shared lines everywhere but in the largest doc_id that holds them.

    The documents go through the index in ``batches`` parts, as they would when they arrive so.
    """
    index = LineRuns(docs.sparkSession, min_chars)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for i in range(batches):
        index.add(docs.where(part == i))
    return drop_shared_lines(docs, index, min_docs)


def _without(batches):
    for batch in chunks(batches, limit=1 << 20):
        out = []
        for doc_id, text, drops in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            lines, gone = text.split("\n"), set(drops or ())
            kept = "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text
            sha = hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest()
            out.append((doc_id, len(lines), len(gone), kept, sha))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        columns = list(zip(*out, strict=True)) or [[]] * 5
        names = [x.split()[0] for x in RESULT.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
