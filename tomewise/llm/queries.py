"""The queries of the training-data operators and the SQL they are checked against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import new_path
from . import byte_bpe, exact_dedup, grammar_store, jaccard_join, language_id, lexical_search, line_runs, packing, ppm
from . import quality_rules, token_counts, toxicity, whitening
from .common import documents, labels, fold


def op1_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.decide(documents(spark, sf).select("doc_id", "text"), digest=True)


def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_runs.dedup_lines(documents(spark, sf).select("doc_id", "text")).drop("kept_text")


def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf), labels(spark, sf))


def op4_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(documents(spark, sf).select("doc_id", "text"), path)


def op5_ppm_score(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text", (fold() == 1).alias("held_out"))
    return ppm.score(docs, *ppm.train(docs.where("NOT held_out")))


def op6_token_store(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "token-store")
    grammar_store.write(documents(spark, sf), path, public_tokenizers.path("word_bpe_49k.json"))
    return grammar_store.read(spark, path)


def op7_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode_and_decode(documents(spark, sf), path, public_tokenizers.PATTERN)


def op8_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.join(documents(spark, sf))


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    scored = toxicity.score(documents(spark, sf), toxicity.learned(spark, sf))
    held_out, predicted = (fold() == 0).alias("held_out"), (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out, "score", predicted)


def op10_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.identify(spark, sf)


def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf}/embeddings.parquet"), "vec_id", "embedding")


def op12_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


def op13_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count(documents(spark, sf), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_line_dedup, op3_quality_rules, op4_best_fit_packing,
        op5_ppm_score, op6_token_store, op7_byte_bpe, op8_jaccard_join, op9_toxicity, op10_language_id,
        op11_whitening, op12_lexical_search, op13_token_counts,
    )
}

BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLES = {
    "op1_exact_dedup": f"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars,
    translate(coalesce(text, ''), {BLANKS}, '') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id) AS kept,
  sha256(norm) AS text_sha256
FROM n""",
    "op2_line_dedup": f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split),
keyed AS (SELECT doc_id, pos, line, translate(trim(line, {BLANKS}),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM lines),
shared AS (SELECT line_key, max(doc_id) AS last_doc FROM keyed WHERE length(line_key) >= 20
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.*, s.last_doc IS NOT NULL AND k.doc_id <> s.last_doc AS gone
  FROM keyed k LEFT JOIN shared s USING (line_key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op12_lexical_search": """
WITH cut AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
size AS (SELECT count(*) AS n, sum(len(terms))::BIGINT AS total FROM cut WHERE len(terms) > 0),
counted AS (SELECT doc_id, n_terms, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n_terms, unnest(terms) AS term FROM cut)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weighed AS (SELECT term, floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counted, size GROUP BY term),
worth AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n_terms * n) // total))) AS gain
  FROM counted JOIN weighed USING (term), size),
scored AS (SELECT item_id, doc_id, sum(times * gain)::BIGINT AS score FROM asked JOIN worth USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20""",
}
