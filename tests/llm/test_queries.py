"""Every query over whole small tables, against SQL or a plain Python version."""

import base64
import collections
import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tomewise.llm import grammar_store, ppm
from tomewise.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def rows(spark, sf, name):
    return {r.doc_id: r for r in QUERIES[name](spark, sf).collect()}


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


def words(text):
    return text.encode().lower().split()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_its_sql(spark, sf, duck, name):
    got = QUERIES[name](spark, sf)
    want = duck.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    assert set(names) == set(got.columns)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_quality_base(spark, sf, texts):
    got = rows(spark, sf, "op3_quality_rules")
    space = set(" \t\n\x0b\x0c\r")
    assert set(got) == set(texts)
    for doc_id, text in texts.items():
        w = [x for x in "".join(" " if c in space else c for c in text).split(" ") if x]
        at = collections.defaultdict(list)
        for i in range(len(w) - 4):
            at[tuple(w[i : i + 5])].append(i)
        repeated = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(5)}
        lines = [x for x in text.split("\n") if any(c not in space for c in x)]
        r = got[doc_id]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
        assert r.base_failed == failed and not (failed and r.kept)


def test_quality_follows_labels(spark, duck):
    got = rows(spark, "/root/testdata/sf0.01", "op3_quality_rules")
    marks = duck.execute("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    good = [got[d].kept for d, q in marks if q == 1 and not got[d].base_failed]
    bad = [got[d].kept for d, q in marks if q == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_packing(spark, sf, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for d, t in texts.items()}
    held, sequences = collections.Counter(), collections.defaultdict(list)
    for r in QUERIES["op4_best_fit_packing"](spark, sf).collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length <= 1024
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        assert (r.piece == 0) == (r.start == 0) and (r.piece == 0 or r.length == 1024)
        held[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert held == {d: len(x) for d, x in ids.items()}
    for parts in sequences.values():
        parts.sort()
        ends = np.cumsum([n for _, n in parts])
        assert [o for o, _ in parts] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert len(sequences) <= 1.02 * math.ceil(sum(held.values()) / 1024)


def slow_ppm(counts, text):
    """PPM by dictionaries: escapes of method D with exclusion."""
    total, k = 0.0, ppm.ORDER
    coded = ppm.STOP * k + b" ".join([*words(text), ppm.STOP])
    for i in range(k, len(coded)):
        hidden = set()
        for order in range(k, -1, -1):
            seen = counts.get(coded[i - order : i])
            if seen is None:
                continue
            left = {s: n for s, n in seen.items() if s not in hidden}
            n = sum(left.values())
            if coded[i] in left:
                total += math.log10((2 * left[coded[i]] - 1) / (2 * n))
                break
            if left:
                total += math.log10(len(left) / (2 * n))
            hidden |= set(seen)
        else:
            total -= math.log10(max(1, 256 - len(hidden)))
    return total


def test_ppm(spark, sf, texts):
    got = rows(spark, sf, "op5_ppm_score")
    known, trie = collections.Counter(), {}
    for d, text in texts.items():
        if fold(d) == 1:
            continue
        known.update([*words(text), b""])
        coded = ppm.STOP * ppm.ORDER + b" ".join([*words(text), ppm.STOP])
        for i in range(ppm.ORDER, len(coded)):
            for order in range(ppm.ORDER + 1):
                trie.setdefault(coded[i - order : i], collections.Counter())[coded[i]] += 1
    n, kinds = sum(known.values()), len(known)
    for d, text in texts.items():
        tokens, r = [*words(text), b""], got[d]
        assert r.held_out == (fold(d) == 1) and r.train_tokens == n and r.n_tokens == len(tokens)
        assert r.n_known == sum(known[w] > 0 for w in tokens)
        assert r.base_score == pytest.approx(sum(math.log10((known[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in tokens))
        if d % 5 == 0:
            assert r.score == pytest.approx(slow_ppm(trie, text), rel=1e-6)


def test_token_store(spark, sf, texts, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    got, before = rows(spark, sf, "op6_token_store"), 0
    ids = {d: [*tokenizer.encode(texts[d], add_special_tokens=False).ids, 1] for d in sorted(texts)}
    for d, x in ids.items():
        want = (before, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == want
        before += len(x)
    grammar_store.write(spark.read.parquet(f"{sf}/documents.parquet"), str(tmp_path / "s"), path, shard_ids=20_000)
    some = {r.doc_id: r.ids for r in grammar_store.read_documents(spark, str(tmp_path / "s"), [0, 7, 199]).collect()}
    assert some == {d: ids[d] for d in (0, 7, 199)}


def test_byte_bpe(spark, sf, texts):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows(spark, sf, "op7_byte_bpe")
    for d, text in texts.items():
        ids = coder.encode_ordinary(text)
        assert got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def brute_components(texts, k, percent):
    sets = {}
    for d, text in texts.items():
        w = words(text)
        sets[d] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def test_jaccard_join(spark, sf, texts):
    got = rows(spark, sf, "op8_jaccard_join")
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == brute_components(texts, 4, 85)


def test_toxicity_on_held_out_rows(spark, duck):
    sf = "/root/testdata/sf0.1"
    got = rows(spark, sf, "op9_toxicity")
    marks = duck.execute(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall()
    held = [(got[d].predicted, y) for d, y in marks if fold(d) == 0]
    assert all(got[d].held_out == (fold(d) == 0) for d, _ in marks)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())
    toxic, clean = [p for p, y in held if y], [p for p, y in held if not y]
    assert np.mean(toxic) > 0.75 and np.mean(clean) < 0.02


def test_language_on_held_out_rows(spark, duck):
    sf = "/root/testdata/sf0.01"
    got = rows(spark, sf, "op10_language_id")
    lang = dict(duck.execute(f"SELECT doc_id, lang FROM '{sf}/documents.parquet'").fetchall())
    assert set(got) == set(lang)
    assert np.mean([r.lang_pred == lang[d] for d, r in got.items() if r.held_out]) > 0.93


def test_whitening(spark, sf, duck):
    got = QUERIES["op11_whitening"](spark, sf).collect()
    vectors = dict(duck.execute("SELECT vec_id, embedding FROM embeddings").fetchall())
    ids = sorted(vectors)
    x = np.floor(64 * np.array([vectors[i] for i in ids], float)) + 1_000_000
    n, total = len(x), x.sum(0)
    centred = x - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:32], axes[:, ::-1][:, :32]
    want = centred @ axes / np.sqrt(values)
    cells = {(r.vec_id, r.component): r for r in got}
    assert len(cells) == len(got) == 32 * n
    mine = np.array([[cells[i, c].whitened for c in range(1, 33)] for i in ids])
    assert np.abs(np.abs(mine) - np.abs(want)).max() < 1e-9
    assert np.abs(np.abs((mine * want).sum(0)) - n).max() < 1e-6  # one sign for all rows
    shares = [cells[ids[0], c].explained for c in range(1, 33)]
    assert np.allclose(shares, values / np.trace(centred.T @ centred / n), rtol=1e-10)
    assert {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total, strict=True)) for row in x]
    assert [cells[i, 1].deviation for i in ids] == exact


def test_token_counts(spark, sf, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = rows(spark, sf, "op13_token_counts")
    assert set(got) == set(texts)
    for d, text in texts.items():
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (got[d].n_bytes, got[d].n_tokens, got[d].over_limit) == (len(text.encode()), n, n > 1024)
