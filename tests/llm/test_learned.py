"""Language identification and the toxicity label model against plain versions of both."""

import math
from collections import defaultdict

import numpy as np
import pytest
import xxhash
import zstandard

from tomewise.llm import language_id, toxicity


def signed(text):
    h = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return h - (1 << 64) if h >= 1 << 63 else h


@pytest.mark.parametrize("docs, size", [(400, 112 << 10), (5, 3000)])
def test_languages_by_plain_compression(spark, duck, docs, size):
    rows = duck.sql("SELECT doc_id, text, lang FROM documents").fetchall()
    extra = [(-1, None, "en"), (-2, "", None), (-3, "12 34 ...", "en"), (-4, rows[0][1], None)]
    frame = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string").repartition(5)
    learned = language_id.fit(frame.select("lang", "text"), docs, size)

    heads = defaultdict(set)
    for _, text, lang in rows + extra:
        if lang is not None and text is not None:
            heads[lang].add(text[: language_id.SAMPLE_CHARS])
    want = {}
    for lang, texts in heads.items():
        content = b""
        for text in sorted(texts, key=signed)[:docs]:
            if len(content) < size:
                content += text.encode() + b"\n"
        want[lang] = content[-size:]
    assert learned == {k: v for k, v in want.items() if len(v) >= 8}

    coders = {}
    for lang, content in learned.items():
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=3)
        coders[lang] = zstandard.ZstdCompressor(level=3, dict_data=words, write_content_size=False)
    got = {r.doc_id: r for r in language_id.predict(frame, learned).collect()}
    assert len(got) == len(rows) + len(extra)
    for doc_id, text, _ in rows + extra:
        r = got[doc_id]
        if not text or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score, r.certain) == ("und", 0.0, False)
            continue
        sizes = {lang: len(c.compress(text.encode())) for lang, c in coders.items()}
        best = min(sorted(sizes), key=sizes.get)
        assert r.lang_pred == best
        assert r.score == pytest.approx(1 / sum(2.0 ** (sizes[best] - s) for s in sizes.values()), rel=1e-9)
        others = [s for lang, s in sizes.items() if lang != best]
        assert r.certain == (min(others, default=math.inf) >= sizes[best] * 1.02)


def plain_label_model(votes, rounds=30):
    n, m = len(votes), len(votes[0])
    p = [0.85 if any(v[: m - 1]) else 0.05 for v in votes]
    weight = [1.0] * m
    for turn in range(rounds):
        prior = min(max(sum(p) / n, 1e-4), 1 - 1e-4)
        toxic = [(sum(p[i] * votes[i][j] for i in range(n)) + 0.1) / (sum(p) + 0.2) for j in range(m)]
        clean = [(sum((1 - p[i]) * votes[i][j] for i in range(n)) + 0.1) / (n - sum(p) + 0.2) for j in range(m)]
        if turn == rounds // 2:
            rest = [[votes[i][j] - p[i] * toxic[j] - (1 - p[i]) * clean[j] for j in range(m)] for i in range(n)]
            length = [math.sqrt(sum(r[j] ** 2 for r in rest)) + 1e-9 for j in range(m)]
            for a in range(m):
                near = [sum(r[a] * r[b] for r in rest) / length[a] / length[b] > 0.5 for b in range(m)]
                weight[a] = 1 / max(1, sum(near))
        for i in range(n):
            odds = math.log(prior / (1 - prior))
            for j in range(m):
                ratio = toxic[j] / clean[j] if votes[i][j] else (1 - toxic[j]) / (1 - clean[j])
                odds += weight[j] * math.log(ratio)
            p[i] = 1 / (1 + math.exp(-min(max(odds, -40), 40)))
    return p


def noisy_votes():
    """Classes, and votes: three noisy voters, a copy of one, a label, and the silence of all."""
    rng = np.random.default_rng(8)
    truth = rng.random(120) < 0.3
    fires = lambda hit, miss: (rng.random(120) < np.where(truth, hit, miss)).astype(float)
    votes = np.stack([fires(0.8, 0.05), fires(0.7, 0.1), fires(0.6, 0.02)], axis=1)
    votes = np.hstack([votes, votes[:, :1], fires(0.95, 0.03)[:, None]])  # a copy of a voter, and the label
    votes = np.hstack([votes, 1 - votes.any(axis=1, keepdims=True)])
    return truth, votes


def test_label_model_by_plain_loops():
    _, votes = noisy_votes()
    assert toxicity.label_model(votes) == pytest.approx(np.array(plain_label_model(votes.tolist())), abs=1e-9)


@pytest.mark.xfail(strict=True, reason="the vote of silence follows from the others and outweighs them where voters err often")
def test_label_model_is_no_worse_than_the_label_alone():
    truth, votes = noisy_votes()
    assert np.mean((toxicity.label_model(votes) > 0.5) == truth) >= np.mean((votes[:, 4] > 0.5) == truth)


def test_linear_classifier_is_optimal_and_scores_are_sums_of_its_weights(spark):
    rng = np.random.default_rng(9)
    x = (rng.random((300, 7)) < 0.3).astype(np.float32)
    target = 1 / (1 + np.exp(-(x @ rng.normal(size=7) * 2 - 1)))
    w, b = toxicity._linear(x, target)
    left = 1 / (1 + np.exp(-(x @ w + b))) - target
    assert np.abs(x.T @ left + 0.1 * w).max() < 1e-4 and abs(left.sum()) < 1e-4

    names = [b"vile", b"rott*", b"\x00caps", b"\x00shout", b"fine", b"\x00mask", b"vi\xc3\xa4"]
    weights = dict(zip(names, w.tolist()))
    cases = {
        "": [],
        "A VILE, rotten thing": [b"vile", b"rott*", b"\x00caps"],
        "fine fine (fine)": [b"fine"],
        "no! no! no!": [b"\x00shout"],
        "f**k viä": [b"\x00mask", b"vi\xc3\xa4"],
    }
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*cases, None])], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(frame, toxicity.Classifier(weights, b)).collect()}
    for i, have in enumerate([*cases.values(), []]):
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(b + sum(weights[f] for f in have)))), rel=1e-9)
