"""Language identification by compression.

For each language a raw-content zstandard dictionary is made of training texts; a text belongs to
the language whose dictionary compresses it smallest. The whole text is compressed. A prediction is
``certain`` when the runner-up is larger by at least ``margin`` of the best size; others are
rejected by callers that want certainty only.

Null texts and texts without a letter are ``und`` with score 0. Ties go to the language that sorts
first. Rows without a language teach nothing; without any language every text is ``und``. An empty
table gives an empty result; repeated rows are predicted alike; other columns are ignored.
"""

from __future__ import annotations

import math

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import chunks, documents, fold

SAMPLE_DOCS = 400  # training texts of each language at most
SAMPLE_CHARS = 2_000  # taken from each of them, so that long texts do not fill a dictionary
DICTIONARY = 112 << 10  # bytes of each dictionary
LETTER = regex.compile(r"\p{L}")
RESULT = "doc_id long, lang_pred string, score double, certain boolean"


def fit(training: DataFrame, sample_docs: int = SAMPLE_DOCS, size: int = DICTIONARY) -> dict[str, bytes]:
    """Dictionary per language, from a bounded sample of lang, text in order of a text hash.

    Texts that begin alike count once, so that copies do not fill a dictionary.
    """
    rows = training.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    ranked = rows.select("lang", "h").distinct().withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    chosen = rows.join(F.broadcast(ranked.where(F.col("k") <= sample_docs)), ["lang", "h"])
    sample = chosen.groupBy("lang", "k").agg(F.min("text").alias("text")).collect()
    out: dict[str, bytes] = {}
    for lang, _, text in sorted(sample, key=lambda r: (r.lang, r.k)):
        if len(out.setdefault(lang, b"")) < size:
            out[lang] += text.encode() + b"\n"
    return {k: v[-size:] for k, v in out.items() if len(v) >= 8}


def predict(docs: DataFrame, dictionaries: dict[str, bytes], level: int = 3, margin: float = 0.02) -> DataFrame:
    """RESULT for every row of doc_id, text."""
    shipped = docs.sparkSession.sparkContext.broadcast(sorted(dictionaries.items()))

    def run(batches):
        coders = []
        for lang, content in shipped.value:
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=level)
            coders.append((lang, zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=False)))
        for batch in chunks(batches):
            out = [_one(t, coders, margin) for t in batch.column("text").to_pylist()]
            langs, scores, certain = map(list, zip(*out, strict=True))
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(langs), pa.array(scores), pa.array(certain)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "certain"])

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def _one(text: str | None, coders, margin: float) -> tuple[str, float, bool]:
    if not text or not coders or not LETTER.search(text):
        return "und", 0.0, False
    data = text.encode()
    sizes = [(len(c.compress(data)), lang) for lang, c in coders]
    best = min(sizes)
    # sizes are code lengths: a tempered posterior over the languages
    score = 1 / sum(math.exp(-min(50.0, (s - best[0]) * math.log(2))) for s, _ in sizes)
    second = min((s for s, lang in sizes if lang != best[1]), default=math.inf)
    return best[1], score, second >= best[0] * (1 + margin)


def identify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from four folds of ``documents`` and predicts all of it."""
    docs = documents(spark, sf_dir)
    learned = fit(docs.where(fold() != 0).select("lang", "text"))
    return predict(docs, learned).withColumn("held_out", fold() == 0)
