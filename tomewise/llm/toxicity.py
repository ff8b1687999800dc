"""Toxicity by weak supervision.

Many voters look at a text: each entry of a lexicon of words and word beginnings, found in the
labelled rows, votes toxic where it occurs; patterns of shouting and masking vote toxic; the absence
of all of them votes clean; and an annotator's label is one more voter. A generative model estimates
by expectation maximisation how often each voter fires on either class; voters that still move
together given the class are correlated and share one vote. A linear classifier is trained on the
posterior labels and scores whole texts.

Voters and models see a bounded sample of labelled rows (``sample``, by order of an id hash); the
scoring pass reads every text. Null and empty texts get the score of a text without any feature.
Rows without a label or id teach nothing; without both classes, every score is the share of the class
(0 without rows). An empty table gives an empty result; repeated rows score alike; other columns are
ignored by ``score`` and passed on by ``keep_clean``.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import cut
from .common import chunks, documents, fold, indexed, labels, lower_words, texts

SAMPLE = 12_000  # labelled rows that are learned from at most
BEGINNINGS = (4, 5, 6)  # bytes of a word that make a feature of their own
LEAST = 4  # toxic rows that a feature occurs in
PRECISION = 0.6  # share of toxic rows among those with a lexicon entry
FEATURES = 800  # voters, and others of high lift up to this number
MARKS = b".,;:!?\"'()[]{}|#$%&*<>~_-"
PATTERNS = {
    b"\x00shout": re.compile(r"!.*!.*!", re.DOTALL),
    b"\x00caps": re.compile(r"\b[A-Z]{4,}\b"),
    b"\x00mask": re.compile(r"[A-Za-z]\*+[A-Za-z]"),
}
RESULT = "doc_id long, score double"


def word_features(word: bytes) -> list[bytes]:
    """The word without punctuation around it, and its beginnings (marked by a star)."""
    word = word.strip(MARKS)
    return [word, *(word[:n] + b"*" for n in BEGINNINGS if len(word) > n)] if word else []


def pattern_features(text: str) -> list[bytes]:
    return [name for name, pattern in PATTERNS.items() if pattern.search(text)]


@dataclass
class Classifier:
    weights: dict[bytes, float]
    bias: float

    def scores(self, batch_texts: list[str]) -> list[float]:
        docs = [lower_words(t) for t in batch_texts]
        kinds, flat, ends = indexed(docs)
        hits: dict[int, list[bytes]] = {}
        for i, w in enumerate(kinds):
            found = [f for f in word_features(w) if f in self.weights]
            if found:
                hits[i] = found
        hit = np.zeros(len(kinds), bool)
        hit[list(hits)] = True
        patterns = any(name in self.weights for name in PATTERNS)
        out, start = [], 0
        for end, text in zip(ends.tolist(), batch_texts, strict=True):
            part = flat[start:end]
            have = {f for i in set(part[hit[part]].tolist()) for f in hits[i]}
            if patterns:
                have.update(f for f in pattern_features(text) if f in self.weights)
            logit = self.bias + sum(self.weights[f] for f in sorted(have))
            out.append(float(1 / (1 + np.exp(-np.clip(logit, -50, 50)))))
            start = end
        return out


def label_model(votes: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior of the toxic class for each row of 0/1 votes.

    The first guess is the share of voters that fire. Each round estimates every voter's rate on
    either class, then the posterior; at half time, voters with correlated residuals are grouped,
    and each of a group of k weighs 1/k.
    """
    n, m = votes.shape
    posterior = np.clip(votes[:, : m - 1].any(axis=1) * 0.8 + 0.05, 0, 1)
    weight = np.ones(m)
    for turn in range(rounds):
        prior = np.clip(posterior.mean(), 1e-4, 1 - 1e-4)
        toxic = (posterior @ votes + 0.1) / (posterior.sum() + 0.2)
        clean = ((1 - posterior) @ votes + 0.1) / (n - posterior.sum() + 0.2)
        if turn == rounds // 2:
            rest = votes - np.outer(posterior, toxic) - np.outer(1 - posterior, clean)
            scale = np.sqrt((rest**2).sum(axis=0)) + 1e-9
            weight = 1 / np.maximum(1, ((rest.T @ rest) / np.outer(scale, scale) > 0.5).sum(axis=0))
        on, off = np.log(toxic / clean), np.log((1 - toxic) / (1 - clean))
        logit = np.log(prior / (1 - prior)) + votes @ (weight * on) + (1 - votes) @ (weight * off)
        posterior = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
    return posterior


def _linear(x: np.ndarray, target: np.ndarray, rounds: int = 10, penalty: float = 0.1) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic regression on soft labels by Newton steps; the bias goes unpenalised."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None].astype(x.dtype)).T @ x
        w = w - np.linalg.solve(curve + np.diag(ridge), x.T @ (p - target) + ridge * w)
    return w[:-1], float(w[-1])


def constant(share: float) -> Classifier:
    share = float(np.clip(share, 1e-6, 1 - 1e-6))
    return Classifier({}, float(np.log(share / (1 - share))))


def train(x: np.ndarray, toxic: np.ndarray, features: list[bytes], voters: np.ndarray) -> Classifier:
    """From the 0/1 features and the labels of each row, and which features vote."""
    votes = x[:, voters].astype(float)
    silent = 1 - votes.any(axis=1, keepdims=True)
    posterior = label_model(np.hstack([votes, toxic[:, None], silent]))
    w, b = _linear(x, posterior)
    return Classifier(dict(zip(features, w.tolist(), strict=True)), b)


def text_features(text: str) -> set[bytes]:
    found = {f for w in set(lower_words(text)) for f in word_features(w)}
    return found.union(pattern_features(text))


def _feature_counts(batches):
    """f, toxic, n: in how many toxic rows and in how many rows each feature occurs."""
    toxic, every = Counter(), Counter()

    def counted():
        pairs = (pa.array(toxic[f] for f in every), pa.array(every.values()))
        return pa.RecordBatch.from_arrays([pa.array(every, pa.binary()), *(p.cast(pa.int64()) for p in pairs)], ["f", "toxic", "n"])

    for batch in chunks(batches, limit=1 << 20):
        for text, y in zip(texts(batch), batch.column("toxic").to_pylist(), strict=True):
            found = text_features(text)
            every.update(found)
            if y:
                toxic.update(found)
        if len(every) > 300_000:
            yield counted()
            toxic, every = Counter(), Counter()
    if every:
        yield counted()


def fit(docs: DataFrame, marked: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Trains on at most ``sample`` rows of doc_id, text joined with doc_id, toxic.

    Features are counted by Spark, each distinct text once (as toxic if half its rows are). The driver
    gets all lexicon entries and patterns, which vote; up to FEATURES in all, others with the highest
    share of toxic texts; and, for each row, which of them it has.
    """
    marked = marked.where("toxic IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "toxic")
    taken = marked.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample)
    chosen = cut(docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").select("text", "toxic"), "toxicity-sample")
    rows, toxic = chosen.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not rows or toxic in (0, rows):
        return constant(toxic / rows if rows else 0.0)
    distinct = chosen.groupBy("text").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    counts = distinct.mapInArrow(_feature_counts, "f binary, toxic long, n long").groupBy("f")
    pattern, often = F.col("f").isin([F.lit(p) for p in PATTERNS]), F.col("toxic") >= LEAST
    counts = cut(counts.agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).where(pattern | often), "toxicity-features")
    votes = pattern | (F.col("toxic") / F.col("n") >= PRECISION)
    voters = [bytes(r.f) for r in counts.where(votes).orderBy("f").collect()]
    if not voters:
        return constant(toxic / rows)
    lift = (F.col("toxic") / (F.col("n") + 2)).desc()
    others = counts.where(~votes).orderBy(lift, "f").limit(max(0, FEATURES - len(voters))).collect()
    features = voters + [bytes(r.f) for r in others]
    place = {f: i for i, f in enumerate(features)}

    def run(batches):
        for batch in chunks(batches):
            have = [sorted(place[f] for f in text_features(t) if f in place) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(have, pa.list_(pa.int32())), batch.column("toxic").cast(pa.int32())], ["f", "y"])

    held = sorted((r.f, r.y) for r in chosen.mapInArrow(run, "f array<int>, y int").collect())
    x = np.zeros((len(held), len(features)), np.float32)
    for i, (have, _) in enumerate(held):
        x[i, have] = 1
    return train(x, np.array([y for _, y in held], float), features, np.arange(len(voters)))


def score(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id, score of every row of doc_id, text."""
    shipped = docs.sparkSession.sparkContext.broadcast((classifier.weights, classifier.bias))

    def run(batches):
        learned = Classifier(*shipped.value)
        for batch in chunks(batches):
            arrays = [batch.column("doc_id").cast(pa.int64()), pa.array(learned.scores(texts(batch)))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def keep_clean(docs: DataFrame, classifier: Classifier, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    shipped = docs.sparkSession.sparkContext.broadcast((classifier.weights, classifier.bias))

    def run(batches):
        learned = Classifier(*shipped.value)
        for batch in chunks(batches):
            yield batch.filter(pa.array(np.array(learned.scores(texts(batch))) < threshold))

    return docs.mapInArrow(run, docs.schema)


def learned(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> Classifier:
    """Trained on the labels of four folds of the documents."""
    docs = documents(spark, sf_dir) if docs is None else docs
    return fit(docs, labels(spark, sf_dir).where(fold() != 0))
