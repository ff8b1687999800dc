"""Language-model scores by prediction by partial matching (PPM) over bytes.

A text counts as its words (A-Z lower-cased), each followed by a blank, and an end. A trie holds, for
contexts of up to ORDER bytes, how often each byte followed. A byte that a context has not seen
escapes to the next shorter one (method D: the first sighting of a kind counts half for escapes),
and bytes that the longer context knows are excluded there; the last resort is an even share among
bytes that no context knows. ``score`` is the log10 probability of all bytes and the end.

Word counts and trie counts come from all training texts: summed in each task, then by Spark. The
trie stays in Spark: its grams are dealt out by the SHARED bytes before the predicted one, so that
each task holds all there is to know of its longer contexts; shorter ones are shipped to all tasks.
What is common enough for a bounded table (words; at most ``max_grams`` grams with their scores) is
looked up in memory, all other words and grams by a shuffle join. These bounds change no result.

Null and empty texts are the end alone. Rows without an id are trained on and scored. Without
training rows, every byte is an even share. An empty table gives an empty result; repeated rows
count each time; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import cut
from .common import chunks, indexed, lower_words, sums_by_document, texts, worker_state

ORDER = 5
SYMBOLS = 256
STOP = b"\n"  # the end of a text, and what stands before its start
BLOCK = 1 << 18  # bytes worked on at a time
HEAD_WORDS = 100_000
MAX_GRAMS = 1_500_000  # that are looked up in memory
SHARED = 3  # bytes of context that say which task holds a gram; there are at most 256 ** SHARED shorter grams
TASK_GRAMS = 400_000  # grams of a task on average
ROWS = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
    "tail array<binary>, far array<long>"
)


def word_counts(training: DataFrame) -> DataFrame:
    """word (binary), n over all rows of ``text``; the empty word stands for the ends of texts."""

    def run(batches):
        counts: Counter = Counter()
        for batch in chunks(batches):
            for text in texts(batch):
                counts.update(lower_words(text))
            counts[b""] += batch.num_rows
            if len(counts) > 150_000:
                yield _counts(counts)
                counts = Counter()
        if counts:
            yield _counts(counts)

    return training.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counts(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "n"])


def coded(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all documents, each after ORDER bytes of padding, and where documents end."""
    rows = [STOP * ORDER + b" ".join([*words, STOP]) for words in docs]
    return np.frombuffer(b"".join(rows), np.uint8), np.cumsum([len(r) for r in rows], dtype=np.int64)


def grams(flat: np.ndarray, ends: np.ndarray):
    """(place, gram) in blocks, where a gram is a byte (lowest) after the ORDER bytes before it."""
    real = np.ones(len(flat), bool)
    for k in range(ORDER):
        real[np.concatenate([[0], ends[:-1]]) + k] = False
    for start in range(0, len(flat), BLOCK):
        stop = min(start + BLOCK, len(flat))
        place = np.arange(start, stop)[real[start:stop]]
        wide = np.concatenate([np.zeros(max(0, ORDER - start), np.uint8), flat[max(0, start - ORDER) : stop]])
        gram = np.zeros(stop - start, np.uint64)
        for k in range(ORDER + 1):
            gram = gram << np.uint64(8) | wide[k : k + stop - start]
        yield place, gram[real[start:stop]]


def gram_counts(training: DataFrame) -> DataFrame:
    """gram, n over all rows of ``text``."""

    def run(batches):
        kinds, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in chunks(batches, limit=1 << 20):
            parts = [np.unique(g, return_counts=True) for _, g in grams(*coded([lower_words(t) for t in texts(batch)]))]
            kinds, at = np.unique(np.concatenate([kinds, *(k for k, _ in parts)]), return_inverse=True)
            n = np.bincount(at, np.concatenate([n, *(c for _, c in parts)]), minlength=len(kinds)).astype(np.int64)
            if len(kinds) > 1_000_000:
                yield from _gram_batches(kinds, n)
                kinds, n = kinds[:0], n[:0]
        yield from _gram_batches(kinds, n)

    return training.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _gram_batches(kinds: np.ndarray, n: np.ndarray):
    for i in range(0, len(kinds), 100_000):
        arrays = [pa.array(kinds[i : i + 100_000].astype(np.int64)), pa.array(n[i : i + 100_000])]
        yield pa.RecordBatch.from_arrays(arrays, ["gram", "n"])


def _at(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    i = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return i, table[i] == keys


@dataclass
class Level:
    """One context length: sorted grams with counts, sorted contexts with what escapes need."""

    grams: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    kinds: np.ndarray
    shadow: np.ndarray  # counts, in the next shorter context, of the bytes this context knows


@dataclass
class Trie:
    levels: list[Level]

    @classmethod
    def build(cls, grams: np.ndarray, counts: np.ndarray, top: int = ORDER, below: Sequence[Level] = ()) -> Trie:
        """From the grams of contexts of ``top`` bytes; shorter contexts are sums over their last bytes.

        The shortest ones may be given in ``below``, where the grams are not all there are.
        """
        levels, eight = list(below), np.uint64(8)
        for order in range(len(levels), top + 1):
            kinds, at = np.unique(grams & np.uint64((1 << 8 * (order + 1)) - 1), return_inverse=True)
            n = np.bincount(at, counts, minlength=len(kinds)) if len(kinds) else np.zeros(0)
            contexts, of = np.unique(kinds >> eight, return_inverse=True)
            size = len(contexts)
            shadow = np.zeros(size)
            if order:
                shorter = levels[-1]
                i, _ = _at(shorter.grams, kinds & np.uint64((1 << 8 * order) - 1))
                shadow = np.bincount(of, shorter.counts[i] if len(i) else None, minlength=size)
            levels.append(Level(kinds, n, contexts, np.bincount(of, n, minlength=size), np.bincount(of, minlength=size), shadow))
        return cls(levels)

    def code(self, context: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """log10 probability of each byte after its context."""
        out, left = np.zeros(len(byte)), np.arange(len(byte))
        hidden, known = np.zeros(len(byte)), np.zeros(len(byte))  # excluded counts and kinds
        for order in range(ORDER, -1, -1):
            level = self.levels[order]
            here = context[left] & np.uint64((1 << 8 * order) - 1)
            i, seen = _at(level.contexts, here)
            g, found = _at(level.grams, here << np.uint64(8) | byte[left])
            total = np.where(seen, level.total[i] - hidden[left] if len(level.total) else 0.0, 0.0)
            kinds = np.where(seen, level.kinds[i] - known[left] if len(level.kinds) else 0.0, 0.0)
            both = np.maximum(2 * total, 1.0)
            mine = 2 * level.counts[g] - 1 if len(level.counts) else 0.0
            share = np.where(found, mine, np.where(kinds > 0, kinds, both)) / both
            out[left] += np.log10(share)
            hidden[left] = np.where(seen, level.shadow[i] if len(level.shadow) else 0.0, 0.0)
            known[left] = np.where(seen, level.kinds[i] if len(level.kinds) else 0.0, 0.0)
            left = left[~found]
        out[left] -= np.log10(np.maximum(SYMBOLS - known[left], 1.0))
        return out


class Codes:
    """log10 probabilities of the grams that are looked up in memory, by a hash table.

    Two grams that meet in a slot leave it to the later one; the other is found by bisection.
    """

    def __init__(self, kinds: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(10, int(2 * len(kinds) + 1).bit_length()))
        self.keys = np.full(1 << (64 - int(self.shift)), np.iinfo(np.uint64).max, np.uint64)
        self.values = np.zeros(len(self.keys), np.float32)
        slot = self._slot(kinds)
        self.keys[slot] = kinds
        won = self.keys[slot] == kinds
        self.values[slot[won]] = values[won]
        order = np.argsort(kinds[~won])
        self.others, self.other_values = kinds[~won][order], values[~won][order]

    def _slot(self, kinds: np.ndarray) -> np.ndarray:
        return ((kinds * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes of grams (0 where unknown), and which places are unknown."""
        slot = self._slot(kinds)
        out, other = self.values[slot].astype(float), np.flatnonzero(self.keys[slot] != kinds)
        i, there = _at(self.others, kinds[other])
        out[other] = np.where(there, self.other_values[i] if len(self.others) else 0.0, 0.0)
        return out, other[~there]

    def documents(self, docs: list[list[bytes]]) -> tuple[np.ndarray, pa.ListArray]:
        """Of each document, the sum of known codes and its grams without one."""
        flat, ends = coded(docs)
        code, places, far = np.zeros(len(flat)), [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for place, gram in grams(flat, ends):
            code[place], unknown = self(gram)
            places.append(place[unknown])
            far.append(gram[unknown])
        offsets = np.searchsorted(np.concatenate(places), np.concatenate([[0], ends])).astype(np.int32)
        return sums_by_document(code, ends), pa.ListArray.from_arrays(offsets, np.concatenate(far).astype(np.int64))


@dataclass
class Model:
    grams: np.ndarray  # common ones, the commonest last
    codes: np.ndarray  # their log10 probabilities
    short: list[Level]  # contexts of less than SHARED bytes
    head: dict[bytes, int]  # counts of common words
    name: str  # that a worker knows it by
    tokens: int  # training tokens
    kinds: int  # distinct training tokens

    def parts(self) -> tuple:
        """Plain values, for a broadcast that needs no class of this package."""
        return self.grams, self.codes, [], self.head, self.name, self.tokens, self.kinds

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.kinds + 1)))


def _least(table: DataFrame, bound: int) -> int:
    """The smallest power of two such that at most ``bound`` rows have a count of it or more."""
    rows = table.groupBy(F.floor(F.log2("n")).cast("int").alias("class")).count().collect()
    least, total = 0, 0
    for r in sorted(rows, key=lambda r: -r["class"]):
        total += r["count"]
        if total > bound:
            least = r["class"] + 1
            break
    return 2**least


def gram_codes(counted: DataFrame, short: list[Level], wanted: DataFrame) -> DataFrame:
    """gram, code: the log10 probabilities of the distinct grams of ``wanted``, by all that are counted.

    They are rounded to single precision, so that sums of them do not depend on their order.
    """
    spark = counted.sparkSession
    shipped = spark.sparkContext.broadcast([tuple(vars(level).values()) for level in short])

    def run(batches):
        held = [(b.column("gram").to_numpy(), b.column("n").to_numpy(), b.column("asked").to_numpy(zero_copy_only=False)) for b in batches]
        if not held:
            return
        gram, n, asked = (np.concatenate(x) for x in zip(*held, strict=True))
        gram, asked = gram.astype(np.uint64), asked.astype(bool)
        trie = Trie.build(gram[~asked], n[~asked].astype(float), below=[Level(*x) for x in shipped.value])
        gram = gram[asked]
        for i in range(0, len(gram), 100_000):
            part = gram[i : i + 100_000]
            code = trie.code(part >> np.uint64(8), part & np.uint64(255)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), pa.array(code.astype(float))], ["gram", "code"])

    tasks = max(spark.sparkContext.defaultParallelism, (counted.count() + wanted.count()) // TASK_GRAMS + 1)
    both = counted.select("gram", "n", F.lit(False).alias("asked"))
    both = both.union(wanted.select("gram", F.lit(0).cast("long"), F.lit(True)))
    context = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * SHARED) - 1))
    return both.repartition(tasks, context).mapInArrow(run, "gram long, code double")


def train(training: DataFrame, head_words: int = HEAD_WORDS, max_grams: int = MAX_GRAMS) -> tuple[Model, DataFrame, DataFrame]:
    """The model, and the tables of all word counts and of all gram counts."""
    words = cut(word_counts(training), "ppm-words")
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("kinds")).first()
    counted = cut(gram_counts(training), "ppm-grams")
    low = F.col("gram").bitwiseAND(F.lit((1 << 8 * SHARED) - 1))
    ends = counted.groupBy(low.alias("gram")).agg(F.sum("n").alias("n")).toArrow()
    short = Trie.build(ends["gram"].to_numpy().astype(np.uint64), ends["n"].to_numpy().astype(float), SHARED - 1).levels
    kept = counted.where(F.col("n") >= _least(counted, max_grams))
    top = gram_codes(counted, short, kept).join(kept, "gram").toArrow()
    order = np.lexsort((top["gram"].to_numpy(), top["n"].to_numpy()))
    kinds, codes = top["gram"].to_numpy()[order].astype(np.uint64), top["code"].to_numpy()[order]
    common = words.where(F.col("n") >= _least(words, head_words)).toArrow()
    head = dict(zip(common["word"].to_pylist(), common["n"].to_pylist(), strict=True))
    return Model(kinds, codes, short, head, uuid.uuid4().hex, size.tokens, size.kinds), words, counted


def score(docs: DataFrame, model: Model, words: DataFrame, counted: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of rows of doc_id, text, held_out."""
    shipped = docs.sparkSession.sparkContext.broadcast(model.parts())

    def run(batches):
        m, part, row = Model(*shipped.value), TaskContext.get().partitionId() << 40, 0
        state = worker_state()  # one table for all tasks of a worker
        if (state.get("ppm") or ("",))[0] != m.name:
            state["ppm"] = None
            state["ppm"] = (m.name, Codes(m.grams, m.codes))
        codes = state["ppm"][1]
        for batch in chunks(batches, limit=1 << 20):
            docs = [lower_words(t) for t in texts(batch)]
            total, far = codes.documents(docs)
            kinds, flat, ends = indexed([[*words, b""] for words in docs])
            counts = np.array([m.head.get(w, -1) for w in kinds])
            common = counts >= 0
            base = np.where(common, m.base(np.maximum(counts, 0)), 0.0)
            n = len(batch)
            starts = np.concatenate([[0], ends[:-1]])
            rare = [[kinds[j] for j in flat[a:b][~common[flat[a:b]]]] for a, b in zip(starts, ends, strict=True)]
            columns = [pa.array(part + row + np.arange(n)), batch.column("doc_id").cast(pa.int64()), batch.column("held_out"),
                       pa.array(np.diff(ends, prepend=0)), pa.array(sums_by_document(common[flat].astype(np.int64), ends)),
                       pa.array(sums_by_document(base[flat], ends)), pa.array(total),
                       pa.array(rare, pa.list_(pa.binary())), far]
            row += n
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in ROWS.split(", ")])

    rows = cut(docs.select("doc_id", "text", "held_out").mapInArrow(run, ROWS), "ppm-rows")
    rare = rows.select("row", F.explode("tail").alias("word")).join(words, "word", "left")
    unseen = F.lit(model.tokens + 0.5 * (model.kinds + 1))
    cost = F.log10((F.coalesce("n", F.lit(0)) + 0.5) / unseen)
    rare = rare.select("row", cost.alias("base"), F.col("n").isNotNull().cast("long").alias("known"), F.lit(0.0).alias("code"))
    far = rows.select("row", F.explode("far").alias("gram"))
    codes = gram_codes(counted, model.short, cut(far.select("gram").distinct(), "ppm-far"))
    far = far.join(codes, "gram").select("row", F.lit(0.0), F.lit(0).cast("long"), "code")
    more = rare.union(far).groupBy("row").agg(*[F.sum(c).alias(f"more_{c}") for c in ("base", "known", "code")])
    both = rows.drop("tail", "far").join(more, "row", "left")
    with_more = lambda c, to: F.col(c) + F.coalesce(f"more_{to}", F.lit(0))
    return both.select(
        "doc_id", "held_out", "n_tokens",
        with_more("n_known", "known").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        with_more("base", "base").alias("base_score"),
        with_more("score", "code").alias("score"),
    )
