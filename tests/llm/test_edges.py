"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import base64
import collections
import math
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tomewise.llm import (
    byte_bpe,
    exact_dedup,
    feast,
    grammar_store,
    jaccard_join,
    language_id,
    lexical_search,
    line_runs,
    packing,
    ppm,
    quality_rules,
    token_counts,
    tokens,
    toxicity,
    whitening,
)
from tomewise.llm.graph import components

LONG = "word " * 60_000
ROWS = [
    (1, "A b\tc"), (2, "Abc"), (3, None), (4, ""), (5, "  \n "), (6, "!!! 123"), (6, "!!! 123"), (7, LONG),
    (8, LONG), (9, "one two three"), (10, "One  two\nthree"), (None, "Abc"), (None, None), (11, "z" * 5000),
]
CLASHING = ("kept", "score", "rank", "length", "node", "unit", "words", "bucket", "n_words", "set")


@pytest.fixture(scope="module")
def odd(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string")
    for name in CLASHING:
        frame = frame.withColumn(name, F.lit(name))
    return frame.withColumn("lang", F.lit(None).cast("string"))


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def by_id(frame):
    return {r.doc_id: r for r in frame.collect() if r.doc_id is not None}


def test_exact(odd, none):
    got = by_id(exact_dedup.decide(odd, digest=True))
    assert [(got[d].keep_id, got[d].group_size, got[d].kept) for d in (1, 2)] == [(1, 3, True), (1, 3, False)]  # and (None, "Abc")
    assert got[4].keep_id == 5 and got[5].group_size == 4  # null, empty and blank texts; the longest stays
    assert got[6].group_size == 2 and got[6].kept
    assert got[7].keep_id == got[8].keep_id == 7
    stays = exact_dedup.deduplicate(odd)
    assert stays.columns == odd.columns
    assert {4, 3, 8} & {r.doc_id for r in stays.collect()} == set()
    assert exact_dedup.decide(none).count() == exact_dedup.deduplicate(none).count() == 0


def test_lines(spark, none):
    line = "a line that is long enough"
    docs = spark.createDataFrame(
        [(1, f"{line}\nx"), (2, f"  {line.upper()} \ny\n{line}"), (3, line), (4, None), (4, None), (5, "")],
        "doc_id long, text string",
    ).withColumn("line", F.lit(1))
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in line_runs.dedup_lines(docs).collect()}
    assert got == {1: (2, 1, "x"), 2: (3, 2, "y"), 3: (1, 0, line), 4: (1, 0, ""), 5: (1, 0, "")}
    assert line_runs.dedup_lines(none).count() == 0


def test_runs_are_compacted_and_disjoint(spark):
    index = line_runs.LineRuns(spark, fanout=2, buckets=2)
    for day in range(5):
        lines = "\n".join(f"line number {i} of this small test" for i in range(day, day + 3))
        index.add(spark.createDataFrame([(day, lines)], "doc_id long, text string"))
    assert [len(level) for level in index.levels] == [1, 0, 1]
    runs = [r.line for run in index.runs() for r in run.collect()]
    assert len(runs) == len(set(runs)) == 7
    assert sorted(r.last_doc for r in index.shared(3).collect()) == [2, 3, 4]


def test_quality(odd, none, no_labels):
    got = by_id(quality_rules.judge(odd, no_labels))
    assert got[3].n_words == 0 and got[3].base_failed and not got[3].kept
    assert got[7].n_words == got[7].n_repeat_words == 60_000
    assert quality_rules.judge(none, no_labels).count() == 0
    assert quality_rules.keep_good(odd, no_labels).columns == odd.columns


def test_decision_list_covers_a_planted_rule():
    rng = np.random.default_rng(1)
    values = rng.random((600, len(quality_rules.FEATURES)))
    bad = (values[:, 2] > 0.7) & (values[:, 5] < 0.5)
    rules = quality_rules.learn(values, bad).rules
    hit = np.any([r.mask(values) for r in rules], axis=0)
    assert (hit == bad).mean() > 0.97
    assert quality_rules.learn(values, rng.random(600) < 0.1).rules == ()


def test_packing(odd, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack(odd, path).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert sorted(r.length for r in got if r.doc_id in (3, 4)) == [1, 1]
    long = sorted((r.piece, r.start, r.length) for r in got if r.doc_id == 7)
    assert all(n == 1024 for _, _, n in long[1:]) and long[0][2] <= 1024
    assert packing.pack(none, path).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece(seed):
    rng = np.random.default_rng(seed)
    sizes, counts = np.unique(np.minimum(1024, rng.geometric(1 / (50 + 200 * seed), 3000)), return_counts=True)
    runs = packing.plan(dict(zip(sizes.tolist(), counts.tolist(), strict=True)))
    held = {}
    for run in runs:
        assert run.room == 1024 - sum(x * k for x, k in run.lengths.items()) >= 0
        for x, k in run.lengths.items():
            held[x] = held.get(x, 0) + run.n * k
    assert held == dict(zip(sizes.tolist(), counts.tolist(), strict=True))
    assert sum(r.n for r in runs) <= 1.02 * np.ceil((sizes * counts).sum() / 1024) + 1


def test_ppm(spark, odd, none):
    docs = odd.withColumn("held_out", F.lit(False))
    got = by_id(ppm.score(docs, *ppm.train(docs)))
    assert got[3].n_tokens == got[4].n_tokens == got[5].n_tokens == 1
    assert got[3].score == got[4].score < 0 and got[7].score == got[8].score
    untrained = by_id(ppm.score(docs, *ppm.train(docs.limit(0))))
    assert untrained[9].n_known == 0 and untrained[9].score == pytest.approx(-15 * np.log10(256))
    pruned = by_id(ppm.score(docs, *ppm.train(docs, head_words=2, max_grams=10)))
    assert pruned[9].base_score == pytest.approx(got[9].base_score)
    assert ppm.score(none.withColumn("held_out", F.lit(True)), *ppm.train(none)).count() == 0


def test_token_store(spark, odd, none, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    grammar_store.write(odd, str(tmp_path / "a"), path)
    got = grammar_store.read(spark, str(tmp_path / "a")).collect()
    assert len(got) == len(ROWS)
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False)) and starts[0][0] == 0
    grammar_store.write(none, str(tmp_path / "b"), path)
    assert grammar_store.read(spark, str(tmp_path / "b")).count() == 0


def test_grammar_expands_to_its_ids():
    rng = np.random.default_rng(2)
    for ids in (np.zeros(0), np.zeros(999), np.tile([1, 2, 1, 2, 3], 500), rng.integers(0, 49_408, 4000), rng.zipf(1.3, 20_000) % 500):
        ids = ids.astype(np.uint32)
        left, right, lengths, body = grammar_store.repair(ids)
        ends = np.array([0, len(ids) // 3, len(ids)])
        shard = grammar_store.Shard(np.array([5, 6]), np.array([True, True]), ends, left, right, lengths, body)
        again = grammar_store.Shard.from_bytes(shard.to_bytes())
        assert (again.expand(again.body) == ids).all()
        if len(ids):
            assert (again.document(1) == ids[ends[1] :]).all() and (again.document(0) == ids[: ends[1]]).all()


def test_byte_bpe(odd, none):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    assert byte_bpe.encode_and_decode(none, path, public_tokenizers.PATTERN).count() == 0
    got = by_id(byte_bpe.encode_and_decode(odd, path, public_tokenizers.PATTERN))
    assert got[3].n_tokens == got[4].n_tokens == 0
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    duck = byte_bpe.DuckBpe(path, public_tokenizers.PATTERN)
    texts = ["a" * 3000, "ab" * 700 + "aab" * 300, "x  y\n\n z \t", "日本語" * 90, "it's <|endoftext|> — ok", " ", "zqxj" * 200]
    made = duck.encode(texts)
    for text, ids, back in zip(texts, made, duck.decode(made), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == coder.encode_ordinary(text) and back == text.encode()


def test_byte_bpe_decodes_from_ids_alone(spark, odd, none):
    args = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode(odd, *args)
    assert byte_bpe.decode(byte_bpe.encode(none, *args), *args).count() == 0
    back = by_id(byte_bpe.decode(encoded, *args))
    assert {r.doc_id: r.text or "" for r in odd.collect() if r.doc_id} == {i: r.text for i, r in back.items() if i}
    with open(args[0], "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("own", pat_str=args[1], mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(5)
    lists = [rng.integers(0, len(ranks) - 1, n).tolist() for n in (1, 7, 4000)]  # ids that no text gives
    odd_lists = [[], None, [1, None], [1, 10**7], [-1]]
    rows = list(enumerate(lists + odd_lists))
    got = by_id(byte_bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), *args))
    for i, ids in enumerate(lists):
        assert bytes(got[i].bytes) == coder.decode_bytes(ids)
        assert got[i].text == coder.decode_bytes(ids).decode("utf-8", "replace")
    assert (bytes(got[3].bytes), got[3].text) == (b"", "")
    assert all(got[i].bytes is None and got[i].text is None for i in range(4, 8))


def test_grammar_goes_on_while_a_pair_pays():
    rng = np.random.default_rng(8)
    phrases = [rng.integers(0, 49_408, 6) for _ in range(900)]  # rare symbols, more than a thousand
    ids = np.concatenate([phrases[i] for i in rng.permutation(np.repeat(np.arange(900), 7))]).astype(np.uint32)
    left, right, lengths, body = grammar_store.repair(ids)
    assert len(left) < grammar_store.MAX_RULES and len(body) < 1.1 * 900 * 7
    pairs, counts = np.unique(body[:-1].astype(np.int64) << 16 | body[1:], return_counts=True)
    assert counts.max() < grammar_store.LEAST
    shard = grammar_store.Shard(np.array([1]), np.array([True]), np.array([0, len(ids)]), left, right, lengths, body)
    assert (shard.expand(body) == ids).all()


def test_jaccard(odd, none):
    got = jaccard_join.join(odd).collect()
    assert len(got) == len(ROWS)
    ids = {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id}
    assert ids[3] == (0, 3) and ids[5] == (0, 5) and ids[6] == (1, 6) and ids[8] == (1, 7) and ids[10] == (1, 9)
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert jaccard_join.join(none).count() == 0
    assert jaccard_join.keep_one(odd).columns == odd.columns


def test_large_clusters_are_cut_into_tiles_without_losing_links(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(5000)])
    docs = []
    for family in range(6):
        base = rng.choice(words, 150 + 20 * family)
        for _ in range(25):
            one = base.copy()
            one[rng.integers(0, len(one), 2)] = rng.choice(words, 2)
            docs.append((len(docs), " ".join(one[: len(one) - int(rng.integers(0, 20))])))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    whole = {r.doc_id: r.component_id for r in jaccard_join.join(frame).collect()}
    monkeypatch.setattr(jaccard_join.units, "__defaults__", (2_000,))
    assert {r.doc_id: r.component_id for r in jaccard_join.join(frame).collect()} == whole
    sets = jaccard_join.shingle_sets([t.encode().split() for _, t in docs], 4)
    root = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 100 * shared >= 85 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    assert whole == dict(enumerate(root))


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_share_a_slab(percent):
    rng = np.random.default_rng(4)
    for n in (6, 9, 14, 40, 300):
        for _ in range(40):
            a = rng.integers(0, 2**63, n).astype(np.uint64)
            extra = rng.integers(0, 2**63, n).astype(np.uint64)
            gone = int(rng.integers(0, n // 4 + 1))
            b = np.concatenate([a[gone:], extra[: int(rng.integers(0, n // 4 + 1))]])
            shared = len(a) - gone
            if len(b) and set(a) != set(b) and 100 * shared >= percent * (len(a) + len(b) - shared):
                one, two = jaccard_join.slab_keys([np.sort(a), np.sort(b)], percent)
                assert set(one.tolist()) & set(two.tolist())


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (5, 5), (None, 4), (3, 7)] + [(i, i + 1) for i in range(20, 60)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 8: 8, 9: 8, **{i: 20 for i in range(20, 61)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ppm_rare_grams_count_at_every_order(spark):
    rare = spark.createDataFrame([(i, f"{'common words here ' * 30} жук{chr(0x430 + i)}") for i in range(20)], "doc_id long, text string")
    docs = rare.withColumn("held_out", F.col("doc_id") == 19)
    training = docs.where("NOT held_out")
    whole, small = (by_id(ppm.score(docs, *ppm.train(training, max_grams=n))) for n in (10**6, 10))
    assert all(small[d].score == pytest.approx(r.score, rel=1e-9) for d, r in whole.items())


def test_toxicity(spark, odd, none, no_labels):
    nothing = toxicity.fit(odd, no_labels)
    assert all(r.score < 0.01 for r in toxicity.score(odd, nothing).collect())
    docs = spark.createDataFrame([(i, f"plain text {i}" + " you idiot" * (i % 3 == 0)) for i in range(300)], "doc_id long, text string")
    marks = docs.selectExpr("doc_id", "CAST(doc_id % 3 = 0 AS int) AS toxic")
    learned = toxicity.fit(docs, marks)
    got = by_id(toxicity.score(docs, learned))
    assert all((r.score >= 0.5) == (d % 3 == 0) for d, r in got.items())
    kept = toxicity.keep_clean(odd.unionByName(odd.limit(1).withColumn("text", F.lit("Idiot!"))), learned)
    assert kept.columns == odd.columns and kept.count() == len(ROWS)
    assert toxicity.score(none, learned).count() == toxicity.keep_clean(none, learned).count() == 0


def test_toxicity_patterns_vote_beside_a_group_of_copies(spark):
    copies = [(i, " ".join(f"w{j}" for j in range(2000)), 1) for i in range(20)]
    shouts = [(100 + i, f"you idiot{' !!!' * (i % 2)} number {i}", 1) for i in range(40)]
    clean = [(200 + i, f"plain text {i}" + " idiot ! ! !" * (i < 4), 0) for i in range(200)]
    docs = spark.createDataFrame(copies + shouts + clean, "doc_id long, text string, toxic int")
    learned = toxicity.fit(docs.drop("toxic"), docs.drop("text"))
    assert {b"\x00shout", b"idiot"} <= set(learned.weights) and b"w7" not in learned.weights


def test_language(spark, odd, none):
    assert {r.lang_pred for r in language_id.predict(odd, {}).collect()} == {"und"}
    learned = {"x": b"alpha beta gamma delta " * 40, "y": b"uno dos tres cuatro cinco " * 40}
    got = by_id(language_id.predict(odd, learned))
    assert all((got[d].lang_pred, got[d].score) == ("und", 0.0) for d in (3, 4, 5, 6))
    assert got[7].lang_pred in learned and 0 <= got[7].score <= 1
    pair = spark.createDataFrame([(1, "gamma delta alpha beta"), (2, "cinco uno tres dos")], "doc_id long, text string")
    assert [r.lang_pred for r in language_id.predict(pair, learned).orderBy("doc_id").collect()] == ["x", "y"]
    assert language_id.predict(none, learned).count() == 0
    assert language_id.fit(none) == {}


def test_language_dictionary_holds_copies_once(spark):
    texts = ["the same text again"] * 50 + [f"another text {i}" for i in range(9)]
    docs = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    held = language_id.fit(docs, sample_docs=10)["en"].decode().splitlines()
    assert sorted(held) == sorted(set(texts))


def test_token_counts(odd, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = token_counts.count(odd, path).collect()
    assert len(got) == len(ROWS)
    ids = by_id(token_counts.count(odd, path, limit=1))
    assert (ids[3].n_bytes, ids[3].n_tokens, ids[3].over_limit) == (ids[4].n_bytes, ids[4].n_tokens, ids[4].over_limit) == (0, 0, False)
    assert ids[7].n_bytes == len(LONG) and ids[7].n_tokens == ids[8].n_tokens and ids[7].over_limit
    assert {r.n_tokens for r in got if r.doc_id == 6} == {ids[6].n_tokens}
    assert token_counts.count(none, path).count() == 0


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_long_texts_are_split_where_counts_add_up(file):
    import sentencepiece

    path = public_tokenizers.path(file)
    texts = ["a b  c\n d\n\ne <|endoftext|> f<|endoftext|>g <|startoftext|>" * 700, "x" * 40_000, "日本 語 " * 6000, " \n " * 9000,
             "don't we'll 12 34,5 " * 2000, "a\x1c b\x85 c　 d\ne é " * 3000, "", " ", "short one"]
    if file.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        want = [len(model.encode(t)) for t in texts]
    else:
        want = [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) for t in texts]
    count, splits = token_counts.counter(path)
    assert splits == (file == "byte_bpe_50k.json")
    assert token_counts.lengths(texts, count, splits).tolist() == want
    assert all("".join(token_counts.units(t)) == t for t in texts)
    assert max(map(len, token_counts.units(texts[0]))) < token_counts.UNIT + 100
    calls = list(token_counts.calls(["x" * n for n in (5, 900, 3, 3, 3)], 9))
    assert [sum(map(len, c)) for c in calls] == [5, 900, 9]


def brute_search(docs, items, top):
    terms = {d: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower()) for d, t in docs}
    n, total = sum(1 for w in terms.values() if w), sum(map(len, terms.values()))
    df = collections.Counter(t for w in terms.values() for t in set(w))
    out = []
    for item, text in items:
        scores = []
        for d, w in terms.items():
            m, score = 75 + 25 * len(w) * n // max(total, 1), 0
            for t in re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower()):
                if tf := w.count(t):
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, d))
        out += [(item, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def found(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=str)


def test_search_equals_brute_force(spark, sf, duck):
    docs = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    items = [*duck.execute("SELECT item_id, text FROM benchmark").fetchall(), (90, None), (91, ""), (92, "nosuchword"), (93, "THE the of, the")]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute_search(docs, items, 5)
    # small trees and small blocks of items, and one of each
    assert found(lexical_search.search(*frames, top=5, block_terms=300, tree=16)) == want
    assert found(lexical_search.search(*frames, top=5)) == want


def test_search_edges(spark, odd, none):
    items = spark.createDataFrame([(1, "One three!"), (1, "One three!"), (2, None), (3, "abc"), (None, "WORD")], "item_id int, text string")
    items = items.withColumn("score", F.lit("x"))
    got = lexical_search.search(odd, items)
    assert got.schema["item_id"].dataType.simpleString() == "int"
    by_item = collections.defaultdict(list)
    for r in got.collect():
        by_item[r.item_id].append((r["rank"], r.doc_id, r.score))
    assert [x[:2] for x in sorted(by_item[1])] == [(1, 9), (1, 9), (2, 10), (2, 10)]
    assert [x[:2] for x in sorted(by_item[3])] == [(1, 2), (2, None)]  # equal scores, no id last
    assert [x[:2] for x in sorted(by_item[None])] == [(1, 7), (2, 8)] and 2 not in by_item
    assert lexical_search.search(none, items).count() == lexical_search.search(odd, items.limit(0)).count() == 0


def test_ball_trees_bound_and_prune():
    rng = np.random.default_rng(5)
    width, n = 400, 900
    sizes = rng.integers(1, 30, n)
    topic = np.arange(n) % 8 * 50
    columns = np.concatenate([np.sort(rng.choice(50, s, False)) + t for s, t in zip(sizes, topic, strict=True)])
    rows = lexical_search.Sparse(columns, rng.integers(1, 10**6, len(columns)), np.cumsum(sizes))
    dense = np.zeros((n, width), np.int64)
    dense[np.repeat(np.arange(n), sizes), columns] = rows.values
    worth = np.where(rng.random((40, width)) < 0.03, rng.integers(1, 9000, (40, width)), 0)
    for groups in (1, 64, 4096):
        tree = lexical_search.BallTree(rows, width, 8, groups)
        assert sorted(tree.order.tolist()) == list(range(n))
        exact, bounds = dense[tree.order] @ worth.T, tree.bounds(worth.astype(float))
        for node, (a, b) in enumerate(zip(tree.first, tree.last, strict=True)):
            if node in tree.children:
                assert a == b
            else:
                assert 0 < b - a <= 8 and (exact[a:b].max(0) <= bounds[:, node]).all()
                assert (tree.leaf_scores(node, worth[3]) == exact[a:b, 3]).all()
        below = {node: [*range(a, b)] for node, (a, b) in enumerate(zip(tree.first, tree.last, strict=True))}
        for node, (left, right) in sorted(tree.children.items(), reverse=True):
            below[node] = below[left] + below[right]
            assert (exact[below[node]].max(0) <= bounds[:, node]).all()
    tree = lexical_search.BallTree(rows, width, 8)
    best = [lexical_search.Best(5) for _ in worth]
    scored = lexical_search.search_tree(tree, worth, best, np.ones(n, bool), tree.order)
    leaves = len(tree.first) - len(tree.children)
    assert scored < 0.3 * leaves * len(worth)  # what best-first leaves out, on texts of eight topics
    for own, scores in zip(best, (dense @ worth.T).T, strict=True):
        order = np.lexsort((np.arange(n), -scores))
        order = order[scores[order] > 0][:5]
        assert own.ids.tolist() == order.tolist() and own.scores.tolist() == scores[order].tolist()


def test_search_prunes_most_leaves_of_natural_texts(duck):
    sf = "/root/testdata/sf0.1"
    items = duck.execute(f"SELECT text FROM '{sf}/benchmark.parquet'").fetchall()
    docs = [t for (t,) in duck.execute(f"SELECT text FROM '{sf}/documents.parquet' WHERE doc_id < 4000").fetchall()]
    counts, terms = [collections.Counter(lexical_search.terms_of(t)) for (t,) in items], {}
    block = lexical_search.Items([], terms, [{terms.setdefault(t, len(terms)): n for t, n in c.items()} for c in counts])
    block.ids.extend(range(len(items)))
    lists = [lexical_search.terms_of(t or "") for t in docs]
    held = [collections.Counter(i for i in map(terms.get, w) if i is not None) for w in lists]
    lists, held = zip(*((w, h) for w, h in zip(lists, held, strict=True) if h), strict=True)
    df = np.bincount([i for h in held for i in h], minlength=len(terms))
    weights = np.floor(1000 * np.log((2 * len(lists) + 2) / (2 * df + 1))).astype(np.int64)
    sizes = np.array([len(h) for h in held])
    values = lexical_search._values(np.array([v for h in held for v in h.values()]), sizes, [len(w) for w in lists], len(lists), sum(map(len, lists)))
    tree = lexical_search.BallTree(lexical_search.Sparse(np.array([i for h in held for i in h]), values, np.cumsum(sizes)), len(terms))
    worth, best = block.matrix() * weights, [lexical_search.Best(20) for _ in items]
    scored = lexical_search.search_tree(tree, worth, best, np.ones(len(sizes), bool), tree.order)
    assert scored < 0.35 * len(items) * (len(tree.first) - len(tree.children))


def test_whitening_edges(spark):
    rng = np.random.default_rng(6)
    good = rng.normal(size=(50, 3))
    rows = [(i, v) for i, v in enumerate(good.tolist())]
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [1.0, float("inf"), 2.0]), (104, []),
           (105, [1.0]), (None, good[0].tolist()), (0, good[0].tolist())]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("n", F.lit("x")).withColumn("i", F.lit(1))
    got = whitening.whiten(frame, "vec_id", "embedding").collect()
    assert len(got) == 3 * 52 and {r.n for r in got} == {52} and {r.component for r in got} == {1, 2, 3}
    assert max(r.identity_error for r in got) < 1e-9
    first = [r.whitened for r in got if r.vec_id in (0, None) and r.component == 1]
    assert len(first) == 3 and len(set(first)) == 1  # repeated vectors are whitened alike
    assert sum(r.explained for r in got if r.vec_id == 1) == pytest.approx(1)
    for some in (frame.limit(0), frame.where("vec_id >= 100"), spark.createDataFrame([(1, [2.0, 3.0])] * 4, "vec_id long, embedding array<double>")):
        left = whitening.whiten(some, "vec_id", "embedding")
        assert left.count() == 0 and left.columns[:2] == ["vec_id", "component"]  # nothing, one vector, equal vectors


def test_whitening_sums_are_exact(spark):
    rng = np.random.default_rng(7)
    whole = np.concatenate([rng.integers(-(2**40), 2**40, (9, 2)), rng.integers(-5, 5, (9, 2))], 1)
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(whole.astype(float).tolist())], "key long, vector array<double>")
    n, total = whitening._totals(rows, 4, 1)
    assert (n, total) == (9, whole.sum(0).tolist())
    a, shift, rest = whitening._covariance(rows, 4, 1, n, total)
    ints = [[int(x) * n - t for x, t in zip(row, total, strict=True)] for row in whole]
    assert a.tolist() == [[sum(r[i] * r[j] for r in ints) / n**3 for j in range(4)] for i in range(4)]
    learned = whitening.Whitening(n, 1, shift, rest, np.ones(4), np.eye(4), np.ones(4))
    assert learned.deviations(whole) == [sum(x * x for x in r) for r in ints]


def symmetric(values):
    q = np.linalg.qr(np.random.default_rng(8).standard_normal((len(values), len(values))))[0]
    return (q * np.array(values)) @ q.T


@pytest.mark.parametrize("values", [
    np.arange(1, 65), [7.0] * 40, np.repeat([5.0, 4, 3, 2, 1], 20), 10.0 ** -np.linspace(0, 9, 80), [3.0], [1e6, 1, 1, 1, 2, 2, 1e-3],
    [1] * 9 + [0] * 50,
])
def test_contour_integration_finds_all_eigenpairs(values):
    a = symmetric(values)
    true = np.sort(np.asarray(values, float))[::-1]
    form = feast.tridiagonal(a)
    marks = np.unique((true[1:] + true[:-1])[np.diff(true) != 0] / 2)
    assert feast.above(form, marks).tolist() == [int((true > m).sum()) for m in marks]
    parts = feast.slices(a, 32)
    pairs = [feast.solve(a, p, i) for i, p in enumerate(parts)]
    found, vectors = np.concatenate([v for v, _ in pairs]), np.concatenate([x for _, x in pairs], 1)
    assert len(found) >= min(32, int((true > 1e-11 * true[0]).sum()))
    assert np.allclose(found, true[: len(found)], rtol=0, atol=1e-13 * true[0] * len(true))
    assert np.abs(a @ vectors - vectors * found).max() < 1e-13 * true[0] * len(true)
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-9


SHARED_IDS = [
    (1, "same words in this text"), (2, "same words in this text"), (2, "quite another text of five words"),
    (None, "same words in this text"), (None, "a text without an id and without copies"), (2, None), (7, None),
]


@pytest.fixture(scope="module")
def shared_ids(spark):
    frame = spark.createDataFrame(SHARED_IDS, "doc_id long, text string")
    for name in (*CLASHING, "key", "keep_id", "group_size", "n_norm"):
        frame = frame.withColumn(name, F.lit(name))
    return frame


def kept(frame, like):
    assert frame.columns == like.columns
    return collections.Counter((r.doc_id, r.text) for r in frame.collect())


def test_stages_decide_on_rows_not_on_ids(spark, shared_ids):
    first, other = SHARED_IDS[0][1], SHARED_IDS[2][1]
    left = kept(exact_dedup.deduplicate(shared_ids), shared_ids)
    assert left == collections.Counter([(1, first), (2, other), SHARED_IDS[4], (2, None)])
    left = kept(jaccard_join.keep_one(shared_ids), shared_ids)
    assert left == collections.Counter([(1, first), (2, other), (None, first), SHARED_IDS[4], (2, None), (7, None)])
    long = "ten or more plain words make a text that is good enough to be kept here"
    rows = spark.createDataFrame([(5, "poor"), (5, long), (None, "a b"), (None, long), (6, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int")
    assert kept(quality_rules.keep_good(rows, marks), rows) == collections.Counter([(5, long), (None, long)])


@pytest.mark.parametrize("file, kind", [("byte_bpe_50k.json", "bytes"), ("word_bpe_49k.json", "words")])
def test_special_strings_in_texts_are_special_ids(file, kind):
    path = public_tokenizers.path(file)
    texts = ["a <|endoftext|> b", "<|endoftext|><|startoftext|>", "<|ENDOFTEXT|> x", "<| endoftext |>", "x <|StartOfText|>", "plain  <|", "", "a b"]
    want = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    got = tokens.encoder(path, kind).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    assert {49407, 50256} & set(want[0]) and not {49407, 50256} & set(want[-1])


@pytest.mark.parametrize("table", ["sf0.01", "sf0.1"])
def test_large_pieces_are_packed_by_configurations(spark, table):
    docs = spark.read.parquet(f"/root/testdata/{table}/documents.parquet")
    pieces = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    large = {x: n for x, n in counts.items() if packing.CAPACITY // packing.SMALL < x < packing.CAPACITY}
    made = packing.configured(large)
    held = collections.Counter()
    for run in made:
        held.update({x: run.n * k for x, k in run.lengths.items()})
    assert held == large  # no sequence is taken apart, and none of them is left to best fit
    whole = packing.plan(counts)
    of = lambda runs: sum(r.n for r in runs if any(x in large for x in r.lengths))
    assert of(whole) == of(made)
    assert sum(r.n for r in whole) <= 1.003 * math.ceil(sum(x * n for x, n in counts.items()) / packing.CAPACITY)


def test_groups_are_rounded_up():
    rng = np.random.default_rng(9)
    left = dict(zip(*(x.tolist() for x in np.unique(rng.integers(129, 1024, 500), return_counts=True)), strict=True))
    rounded = packing.rounded_up(left, 10)
    assert len(rounded) <= 10 and sum(rounded.values()) == 500
    actual = sorted((x for x, n in left.items() for _ in range(n)), reverse=True)
    planned = sorted((x for x, n in rounded.items() for _ in range(n)), reverse=True)
    assert all(a <= b for a, b in zip(actual, planned, strict=True)) and max(actual) == max(planned)
