"""Quality rules: a decision list learned from labelled statistics, as Spark conditions.

Statistics of every text are column expressions. A learner on the driver grows and prunes threshold
conjunctions by sequential covering on the statistics (never the texts) of a bounded sample of
labelled rows, and emits an ordered CASE expression that runs inside Spark. Nothing here is a
Python function on executors.

Null text has no words. Rows without a label are not learned from; a document whose labels disagree
counts as each of them. Without both kinds of label there are no rules and only the base decides.
An empty table gives an empty result; repeated rows are scored alike; other columns are ignored by
``judge`` and passed on by ``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import cut
from .common import SPACE, text_key, without

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Shares that rules may test; all follow from counts of one text.
FEATURES = ("n_words", "word_size", "symbol_share", "digit_share", "upper_share", "stop_share",
            "line_words", "dup_line_share", "repeat_share", "word_variety")
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SAMPLE = 20_000  # labelled rows that the learner sees at most


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts and FEATURES of every row of doc_id, text."""
    text, blank = F.col("t"), F.lit(" ")
    flat = F.translate(text, SPACE, " " * len(SPACE))
    words = F.filter(F.split(flat, " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(F.translate(x, SPACE, " " * len(SPACE))) != "")
    n = F.size("words")
    starts = F.sequence(F.lit(1), n - (WINDOW - 1))
    window = lambda i: F.xxhash64(*[F.element_at("words", (i + k).cast("int")) for k in range(WINDOW)])
    windows = F.when(n >= WINDOW, F.transform(starts, window)).otherwise(F.array().cast("array<bigint>"))

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    rows = rows.select("doc_id", "t", words.alias("words"), lines.alias("lines"))
    rows = rows.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        _without(text, SPACE).cast("long").alias("word_chars"),
        (F.length(text) - _without(text, SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        (F.length(text) - _without(text, "0123456789")).alias("n_digits"),
        (F.length(text) - _without(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("n_upper"),
        (F.length(text) - _without(text, ".!?")).alias("n_stops"),
        F.size("lines").alias("n_lines"),
        F.size(F.array_distinct("words")).alias("n_kinds"),
        windows.alias("windows"),
    )
    # positions of windows that occur twice or more, found by sorting (hash, position)
    repeated = F.when(
        F.size("windows") > F.size(F.array_distinct("windows")),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    rows = rows.withColumn("ordered", repeated).drop("windows")
    here = lambda i: F.element_at("ordered", (i + 1).cast("int")).h
    twin = F.filter("ordered", lambda x, i: ((i > 0) & (x.h == here(F.greatest(i - 1, F.lit(0)))))
                    | ((i + 1 < F.size("ordered")) & (x.h == here(F.least(i + 1, F.size("ordered") - 1)))))
    rows = rows.withColumn("places", F.sort_array(F.transform(twin, lambda x: x.i))).drop("ordered")
    after = lambda i: F.try_element_at("places", (i + 2).cast("int"))
    gaps = F.transform("places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(after(i) - p, F.lit(WINDOW))))
    covered = F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, x: a + x), F.lit(0))
    rows = rows.withColumn("n_repeat_words", covered.cast("long")).drop("places")
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return rows.select(
        "doc_id", *BASE,
        share("word_chars", "n_words").alias("word_size"),
        share("n_symbols", "n_words").alias("symbol_share"),
        share("n_digits", "word_chars").alias("digit_share"),
        share("n_upper", "word_chars").alias("upper_share"),
        share("n_stops", "n_words").alias("stop_share"),
        share("n_words", "n_lines").alias("line_words"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_kinds", "n_words").alias("word_variety"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, is_upper_bound, threshold) that marks low quality."""

    tests: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        every = [F.col(f) <= t if upper else F.col(f) > t for f, upper, t in self.tests]
        out = every[0]
        for test in every[1:]:
            out = out & test
        return out

    def mask(self, values: np.ndarray) -> np.ndarray:
        hit = np.ones(len(values), bool)
        for f, upper, t in self.tests:
            x = values[:, FEATURES.index(f)]
            hit &= x <= t if upper else x > t
        return hit


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...]

    def column(self) -> Column:
        """True for documents that no rule marks."""
        out = None
        for rule in self.rules:
            out = F.when(rule.column(), False) if out is None else out.when(rule.column(), False)
        return F.lit(True) if out is None else out.otherwise(True)


def learn(values: np.ndarray, bad: np.ndarray, precision: float = 0.9, max_rules: int = 20) -> DecisionList:
    """Sequential covering: rules are grown on two thirds of the rows by information gain, pruned on
    the rest, and taken while their precision on the rows to prune by holds."""
    grow = np.arange(len(bad)) % 3 != 0
    left, rules = np.ones(len(bad), bool), []
    while len(rules) < max_rules and (left & grow & bad).sum() >= 5:
        tests = _grow(values[left & grow], bad[left & grow])
        rule = _prune(tests, values[left & ~grow], bad[left & ~grow])
        if rule is None:
            break
        hit = rule.mask(values) & left
        held = hit & ~grow
        if held.sum() < 2 or bad[held].mean() < precision or bad[hit].mean() < precision:
            break
        rules.append(rule)
        left &= ~hit
    return DecisionList(tuple(rules))


def _grow(values: np.ndarray, bad: np.ndarray) -> list[tuple[str, bool, float]]:
    tests, inside = [], np.ones(len(bad), bool)
    while bad[inside].mean() < 1 and len(tests) < 6:
        base, best = np.log2(bad[inside].mean()), (1e-9, None)
        for j, name in enumerate(FEATURES):
            order = np.argsort(values[inside, j], kind="stable")
            x, y = values[inside, j][order], bad[inside][order]
            ends = np.flatnonzero(x[1:] > x[:-1]) + 1
            if not len(ends):
                continue
            below, pos = ends, np.cumsum(y)[ends - 1]
            for upper, p, n in ((True, pos, below), (False, y.sum() - pos, len(y) - below)):
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / n) - base), 0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (name, upper, float((x[ends[k] - 1] + x[ends[k]]) / 2)))
        if best[1] is None:
            break
        tests.append(best[1])
        inside &= Rule((best[1],)).mask(values)
    return tests


def _prune(tests, values: np.ndarray, bad: np.ndarray) -> Rule | None:
    """The prefix of the tests with the largest (p - n) / (p + n) on rows not grown on."""
    best = (-1.0, None)
    for k in range(1, len(tests) + 1):
        rule = Rule(tuple(tests[:k]))
        y = bad[rule.mask(values)]
        worth = (2 * y.sum() - len(y)) / len(y) if len(y) else -1.0
        if worth > best[0]:
            best = (worth, rule)
    return best[1]


def fit(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DecisionList:
    """Learns from the statistics of at most ``sample`` labelled rows, taken in order of an id hash.

    Rows that the base already rejects teach nothing and are left out.
    """
    marked = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "quality")
    rows = stats.where(~base_failed()).join(marked, "doc_id").select("quality", F.xxhash64("doc_id").alias("h"), *FEATURES)
    taken = rows.orderBy("h", "quality", *FEATURES).limit(sample).collect()
    if not taken:
        return DecisionList(())
    values = np.array([[float(r[f]) for f in FEATURES] for r in taken])
    bad = np.array([r.quality == 0 for r in taken])
    return learn(values, bad) if 0 < bad.sum() < len(bad) else DecisionList(())


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed and kept for every row of ``docs``."""
    stats = cut(statistics(docs.select("doc_id", "text")), "quality-statistics")
    verdict = fit(stats, labels).column()
    failed = base_failed()
    return stats.select("doc_id", *BASE, failed.alias("base_failed"), (~failed & verdict).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is kept; a row without an id follows its own text."""
    rows = docs.select(F.struct("doc_id", text_key().alias("key")).alias("doc_id"), "text")
    stats = statistics(rows)
    stats = cut(stats.select("doc_id.*", *stats.columns[1:]), "quality-statistics")
    verdict = ~base_failed() & fit(stats, labels).column()
    return without(docs, stats.where(~verdict).select("doc_id", "key"))
