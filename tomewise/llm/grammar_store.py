"""Token ids in binary shards, compressed by a Re-Pair grammar for each shard.

Documents are ranged by id over Spark's partitions and encoded there; consecutive documents form
shards. Within a shard, frequent pairs of symbols are repeatedly replaced by nonterminals. A shard
stores its rules, the expansion length of each rule, the compressed body and where documents begin,
so that any document can be decoded alone: cumulated expansion lengths of the body tell which
symbols cover it. Spark writes the shards (one binary value each) and commits them, so a lost
executor only repeats its own tasks.

Null and empty texts are one end id. Repeated rows are stored like any others, in order of text
hash; rows without an id come first. An empty table gives no shards and an empty result; other
columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import chunks, texts
from .tokens import encoder

END = 1
FIRST_RULE = 49_408  # ids below are tokens
MAX_RULES = 65_536 - FIRST_RULE  # so that a symbol takes two bytes
SHARD_IDS = 1 << 20  # a shard ends with the document that reaches it
LEAST = 5  # occurrences from which a rule, four symbols of the file, pays
NEAR_MOST = 3  # a round takes pairs at least one part in so many as frequent as the most frequent one
ROUND_RULES = 4096  # the most frequent of them, so that counts stay true
HEAD = "<4s4Q"
MAGIC = b"RPG1"
SHARDS = "part int, seq int, n_ids long, shard binary"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


@dataclass
class Shard:
    doc_ids: np.ndarray  # int64; `known` marks ids that are not null
    known: np.ndarray
    starts: np.ndarray  # n + 1
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray  # of each rule's expansion
    body: np.ndarray

    def to_bytes(self) -> bytes:
        counts = (len(self.doc_ids), len(self.left), len(self.body), int(self.starts[-1]))
        arrays = ((self.doc_ids, "<i8"), (self.known, "u1"), (self.starts, "<u8"), (self.left, "<u2"),
                  (self.right, "<u2"), (self.lengths, "<u4"), (self.body, "<u2"))
        return struct.pack(HEAD, MAGIC, *counts) + b"".join(a.astype(t).tobytes() for a, t in arrays)

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        magic, docs, rules, body, _ = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a shard")
        out, at = [], struct.calcsize(HEAD)
        for n, kind in ((docs, "<i8"), (docs, "u1"), (docs + 1, "<u8"), (rules, "<u2"), (rules, "<u2"),
                        (rules, "<u4"), (body, "<u2")):
            out.append(np.frombuffer(data, kind, n, at))
            at += out[-1].nbytes
        return cls(*out)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Token ids of symbols. Expansion lengths say where each part of a nonterminal goes, so that
        a step touches what is not yet expanded only."""
        symbols = symbols.astype(np.int64)
        size = np.concatenate([np.ones(FIRST_RULE, np.int64), self.lengths])
        ends = np.cumsum(size[symbols])
        out, place = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32), ends - size[symbols]
        while len(symbols):
            rule = symbols >= FIRST_RULE
            out[place[~rule]] = symbols[~rule]
            index, place = symbols[rule] - FIRST_RULE, place[rule]
            left = self.left[index].astype(np.int64)
            symbols = np.concatenate([left, self.right[index]])
            place = np.concatenate([place, place + size[left]])
        return out

    def document(self, i: int) -> np.ndarray:
        """Ids of document ``i`` of the shard, expanding only what covers it."""
        size = np.ones(len(self.body), np.int64)
        rule = self.body >= FIRST_RULE
        size[rule] = self.lengths[self.body[rule] - FIRST_RULE]
        ends = np.cumsum(size)
        a, b = int(self.starts[i]), int(self.starts[i + 1])
        first, last = np.searchsorted(ends, a, side="right"), np.searchsorted(ends, b, side="left")
        skipped = int(ends[first] - size[first])
        return self.expand(self.body[first : last + 1])[a - skipped : b - skipped]


def _frequent(body: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Left and right symbols of the round's pairs, in ascending order; all adjacent pairs are counted."""
    codes = body[:-1].astype(np.uint32)
    codes <<= 16
    codes |= body[1:]
    codes.sort()
    often = codes[LEAST - 1 :][codes[LEAST - 1 :] == codes[: 1 - LEAST]]
    if not len(often):
        return often, often
    ends = np.flatnonzero(np.concatenate([often[1:] != often[:-1], [True]]))
    counts = np.diff(ends, prepend=-1) + LEAST - 1
    at = np.flatnonzero(NEAR_MOST * counts >= counts.max())
    if len(at) > most:
        at = np.sort(at[np.argpartition(-counts[at], most - 1)[:most]])
    pairs = often[ends[at]]
    return pairs >> 16, pairs & 0xFFFF


def repair(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """left, right, lengths of the rules and the body that expand to ``ids`` (below FIRST_RULE).

    A round counts all adjacent pairs, makes rules of the most frequent ones and replaces them from
    left to right; rules of earlier rounds are symbols of later ones. It goes on while a pair pays for
    a rule and two bytes can name one.
    """
    body, left, right = ids.astype(np.uint16), [], []
    lengths = np.ones(1 << 16, np.int64)
    while len(body) > LEAST and len(left) < MAX_RULES:
        a, b = _frequent(body, min(ROUND_RULES, MAX_RULES - len(left)))
        if not len(a):
            break
        rules = (FIRST_RULE + len(left) + np.arange(len(a))).astype(np.uint16)
        lengths[rules] = lengths[a] + lengths[b]
        left += a.tolist()
        right += b.tolist()
        # the rule of a pair: a dense table over the round's left and right symbols
        row, col = np.zeros(1 << 16, np.uint16), np.zeros(1 << 16, np.uint16)
        for place, symbols in ((row, np.unique(a)), (col, np.unique(b))):
            place[symbols] = np.arange(1, len(symbols) + 1)
        table = np.zeros((int(row.max()) + 1, int(col.max()) + 1), np.uint16)
        table[row[a], col[b]] = rules
        at = np.flatnonzero((row[body[:-1]] > 0) & (col[body[1:]] > 0))
        found = table[row[body[at]], col[body[at + 1]]]
        at, found = at[found > 0], found[found > 0]
        # of overlapping places, every second one from the left is taken
        fresh, index = np.concatenate([[True], np.diff(at) > 1]), np.arange(len(at))
        taken = (index - np.maximum.accumulate(np.where(fresh, index, 0))) % 2 == 0
        body[at[taken]] = found[taken]
        kept = np.ones(len(body), bool)
        kept[at[taken] + 1] = False
        body = body[kept]
    rules = len(left)
    return np.array(left, np.int64), np.array(right, np.int64), lengths[FIRST_RULE : FIRST_RULE + rules], body


def _shard(doc_ids: list, ids: list[bytes]) -> bytes:
    flat = np.frombuffer(b"".join(ids), "<u4")
    starts = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])])
    known = np.array([d is not None for d in doc_ids])
    return Shard(np.array([d or 0 for d in doc_ids]), known, starts, *repair(flat)).to_bytes()


def write(docs: DataFrame, path: str, tokenizer: str, end: int = END, shard_ids: int = SHARD_IDS) -> None:
    """Writes the shards of doc_id, text in ascending order of doc_id."""
    tail = int(end).to_bytes(4, "little")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        tokens, part, seq = encoder(tokenizer, "words"), TaskContext.get().partitionId(), 0
        doc_ids, ids, size = [], [], 0
        for batch in chunks(batches):
            for doc_id, x in zip(batch.column("doc_id").to_pylist(), tokens.encode(texts(batch)), strict=True):
                doc_ids.append(doc_id)
                ids.append(x + tail)
                size += len(ids[-1]) // 4
                if size >= shard_ids:
                    yield _row(part, seq, size, _shard(doc_ids, ids))
                    doc_ids, ids, size, seq = [], [], 0, seq + 1
        if ids:
            yield _row(part, seq, size, _shard(doc_ids, ids))

    ranged = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id")
    ordered = ranged.sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(run, SHARDS).write.parquet(path)


def _row(part: int, seq: int, size: int, shard: bytes) -> pa.RecordBatch:
    arrays = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([size]), pa.array([shard])]
    return pa.RecordBatch.from_arrays(arrays, ["part", "seq", "n_ids", "shard"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """DOCS of every stored document."""
    shards = spark.read.schema(SHARDS).parquet(path)

    def run(batches):
        for batch in batches:
            for part, seq, data in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "shard")), strict=True):
                shard = Shard.from_bytes(data)
                ids = shard.expand(shard.body).astype("<u4").tobytes()
                starts = shard.starts.astype(np.int64)
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts, starts[1:], strict=False)]
                n = len(crc)
                arrays = [pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()),
                          pa.array(shard.doc_ids, mask=shard.known == 0), pa.array(starts[:-1]),
                          pa.array(np.diff(starts)), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "seq", "doc_id", "own", "n_tokens", "ids_crc32"])

    found = shards.select("part", "seq", "shard").mapInArrow(
        run, "part int, seq int, doc_id long, own long, n_tokens long, ids_crc32 long"
    )
    # ids before a shard: those of earlier partitions (a row for each), and of its own partition
    sizes = shards.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    sizes = sizes.select("part", "seq", inside.alias("inside")).join(parts, "part")
    placed = found.join(sizes, ["part", "seq"])
    start = F.col("before") + F.col("inside") + F.col("own")
    return placed.select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id, ids of the given documents, each decoded alone."""
    wanted = set(doc_ids)

    def run(batches):
        for batch in batches:
            for data in batch.column("shard").to_pylist():
                shard = Shard.from_bytes(data)
                hits = [i for i, d in enumerate(shard.doc_ids.tolist()) if shard.known[i] and d in wanted]
                ids = [shard.document(i).tolist() for i in hits]
                arrays = [pa.array(shard.doc_ids[hits], pa.int64()), pa.array(ids, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids"])

    shards = spark.read.schema(SHARDS).parquet(path)
    return shards.select("shard").mapInArrow(run, "doc_id long, ids array<long>")
