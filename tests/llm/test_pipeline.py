"""The pipeline, stage by stage, against plain Python over a small table."""

import collections

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tomewise.llm import common, quality_rules, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    """Rows of documents, and of every stage's result, as written and read again."""
    docs, out = common.documents(spark, sf), []
    out.append(docs.collect())
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def texts(rows):
    return {r.doc_id: r.text or "" for r in rows}


def test_stages_and_columns(steps):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "quality_rules", "exact_dedup", "jaccard_join", "best_fit_packing"]
    for rows in steps[:-1]:
        assert list(rows[0].asDict()) == COLUMNS
    for before, after in zip(steps[:4], steps[1:5], strict=True):
        whole = {r.doc_id: r for r in before}
        assert all(whole[r.doc_id] == r for r in after) and len(after) < len(before)


def test_toxic_and_poor_documents_go(spark, sf, steps):
    marks = common.labels(spark, sf)
    learned = toxicity.learned(spark, sf)
    scores = dict(zip(texts(steps[0]), learned.scores(list(texts(steps[0]).values())), strict=True))
    assert set(texts(steps[1])) == {d for d, s in scores.items() if s < 0.5}
    docs = spark.createDataFrame(steps[1], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in quality_rules.judge(docs, marks).collect() if r.kept}
    assert set(texts(steps[2])) == kept


def test_one_of_equal_documents_stays(steps):
    groups = {}
    for d, text in texts(steps[2]).items():
        groups.setdefault("".join(c for c in text if c not in " \t\n\x0b\x0c\r"), []).append((-len(text), d))
    assert set(texts(steps[3])) == {min(g)[1] for g in groups.values()}


def test_one_of_near_copies_stays(steps):
    sets = {}
    for d, text in texts(steps[3]).items():
        w = text.encode().lower().split()
        k = cp.NEAR_WORDS
        sets[d] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    root = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= cp.NEAR_PERCENT * max(1, len(sets[a] | sets[b])):
                x, y = sorted((root[a], root[b]))
                root = {d: x if r == y else r for d, r in root.items()}
    assert set(texts(steps[4])) == {d for d, r in root.items() if d == r}


def test_all_tokens_are_packed(spark, sf, steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts(steps[4]).items()}
    packed = {}
    for r in steps[5]:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.length
    assert packed == sizes
    again = cp.run(spark, sf).select("doc_id", "piece", "length", "ids_crc32").collect()
    assert sorted(again) == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in steps[5])


def test_odd_rows_pass_through_all_stages(spark, sf, tmp_path):
    """Repeated ids with other texts, no ids, nulls, clashing columns, and an empty table."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").limit(40).withColumn("key", F.lit(1)).withColumn("kept", F.lit("x"))
    good = rows.where("length(text) > 400").first().text
    odd = [(9001, good), (9001, good), (9002, good), (9002, good[:300] + " with an end of its own"), (None, good), (None, None), (900, None), (901, "")]
    frame = spark.createDataFrame([(d, t, None, None, None, 1, "x") for d, t in odd], rows.schema)
    for name, docs in (("odd", rows.unionByName(frame)), ("none", rows.limit(0))):
        for step, (stage, function) in enumerate(cp.STAGES):
            before = docs
            path = str(tmp_path / f"{name}-{stage}")
            function(spark, docs, sf).write.parquet(path)
            docs = spark.read.parquet(path)
            if step < 4:
                assert docs.columns == before.columns and docs.exceptAll(before).count() == 0
        held = collections.Counter(r.doc_id for r in docs.where("piece = 0").collect())
        assert docs.count() == 0 if name == "none" else held[9001] <= 2
        if name == "odd":
            assert held[9002] == 1  # the text that no other row has, whatever became of its copy of row 1
            assert held[900] == held[901] == 0  # empty texts are poor
