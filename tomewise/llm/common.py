"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six characters that separate words: [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def fold(doc_id: str | Column = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo the folds; an absent id counts as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % folds


def text_key(text: str = "text") -> Column:
    """A 64-bit hash of the text, by which rows of one id are told apart; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` but for those whose id and text ``dropped`` (doc_id, key) names."""
    gone = dropped.select(F.col("doc_id").alias("_gone_id"), F.col("key").alias("_gone_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (text_key() == F.col("_gone_key"))
    return docs.join(gone, same, "left_anti")


def worker_state() -> dict:
    """What a Python worker keeps between its tasks (functions travel with the job, so their
    modules' own variables start anew in each task)."""
    return vars(sys.modules.setdefault("training_data_worker_state", types.ModuleType("training_data_worker_state")))


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of at most ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(size.astype(np.int64)), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(text).to_pylist()]


def lower_words(text: str) -> list[bytes]:
    """Words between characters of SPACE, with A-Z lower-cased, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def indexed(docs: list[list[bytes]]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words in order of appearance, the index of each occurrence, and where documents end."""
    place: dict[bytes, int] = {}
    size = sum(map(len, docs))
    flat = np.fromiter((place.setdefault(w, len(place)) for d in docs for w in d), np.int64, size)
    return list(place), flat, np.cumsum([len(d) for d in docs], dtype=np.int64)


def sums_by_document(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of the values of each document, 0 for one without any."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[np.concatenate([[0], ends[:-1]]).astype(np.int64)]
