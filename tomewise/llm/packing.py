"""Best-fit packing of token sequences by linear grouping.

Documents are cut into pieces of at most ``capacity`` tokens. All that packing depends on is how
many pieces there are of each length, a table of at most ``capacity`` rows that the driver holds.
Large lengths are rounded up within groups of equal cardinality; configurations of the few rounded
sizes are optimised by column generation and used a whole number of times; actual lengths are put
in place of the rounded ones, longer ones where earlier slots left room; what rounding the numbers
down leaves over is grouped anew, until all large pieces are in configurations. Small lengths go
into the tightest gap that takes them. The plan is kept as runs of equal sequences, so its size does
not depend on the number of pieces, and executors look up each piece's place by its rank within its
length.

Null and empty texts are one end token. Repeated rows are packed like any others. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import cut
from .common import chunks, texts
from .tokens import encoder

CAPACITY, END = 1024, 2
GROUPS = 48  # rounded sizes
SMALL = 8  # lengths up to capacity / SMALL are small
CLOSE = 2000  # see configurations
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"
RANK_BITS = 48  # of a key that holds length and rank


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """PIECES of every row of doc_id, text; the first piece of a long document is the shorter one."""
    tail = int(end).to_bytes(4, "little")

    def run(batches):
        tokens = encoder(path, "bytes")
        for batch in chunks(batches):
            out = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokens.encode(texts(batch)), strict=True):
                ids += tail
                n = len(ids) // 4
                cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    out.append((doc_id, i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = [x.split()[0] for x in PIECES.split(", ")]
            arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


@dataclass
class Run:
    """``n`` equal sequences: lengths with their multiplicity, and the room left in each."""

    n: int
    lengths: dict[int, int]
    room: int

    def split(self, n: int) -> Run:
        """Takes ``n`` sequences off."""
        self.n -= n
        return Run(n, dict(self.lengths), self.room)

    def put(self, length: int, times: int) -> None:
        self.lengths[length] = self.lengths.get(length, 0) + times
        self.room -= length * times


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], float]]:
    """Configurations (how often each size is in a sequence) and how often each is used, from the
    optimum of the relaxed problem. They are generated by a knapsack over the prices of the sizes,
    until none is worth adding or the sequences are full but for one part in CLOSE."""
    n, size = len(sizes), np.array(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    used = np.array(demand, float) / np.diag(basis)
    least = (size * np.array(demand)).sum() / capacity
    for _ in range(40 * n):
        if used.sum() <= least * (1 + 1 / CLOSE):
            break
        price = np.linalg.solve(basis.T, np.ones(n))
        best, via = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for room in range(min(sizes), capacity + 1):
            fits = size <= room
            value = np.where(fits, best[room - np.minimum(size, room)] + price, -1.0)
            k = int(np.argmax(value))
            best[room], via[room] = (value[k], k) if value[k] > best[room - 1] + 1e-12 else (best[room - 1], -1)
        if best[capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(n), capacity
        while room > 0:
            k = via[room]
            if k < 0:
                room -= 1
                continue
            column[k] += 1
            room -= sizes[k]
        rate = np.linalg.solve(basis, column)
        ratio = np.where(rate > 1e-9, used / np.maximum(rate, 1e-9), np.inf)
        out = int(np.argmin(ratio))
        used = used - ratio[out] * rate
        used[out] = ratio[out]
        basis[:, out] = column
    return [([int(x) for x in basis[:, j].round()], float(used[j])) for j in range(n) if used[j] > 1e-9]


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Run]:
    """Runs of sequences that hold exactly ``counts`` pieces of each length."""
    small = dict(counts)
    full = [Run(small.pop(capacity), {capacity: 1}, 0)] if small.get(capacity) else []
    large = {x: small.pop(x) for x in list(small) if x > capacity // SMALL and small[x]}
    return _best_fit(full + configured(large, capacity, groups), small, capacity)


def configured(left: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Run]:
    """Runs that hold all large pieces, each out of a configuration.

    Configurations are used as often as the relaxed optimum says, rounded down; what is left over is
    grouped and optimised anew. Where nothing is left after rounding down, those used at least half a
    time, or else the most used one, are taken once.
    """
    out: list[Run] = []
    left = dict(left)
    while total := sum(left.values()):
        rounded = rounded_up(left, min(groups, total))
        sizes = sorted(rounded, reverse=True)
        found = configurations(sizes, [rounded[x] for x in sizes], capacity)
        whole = [(p, int(used + 1e-9)) for p, used in found if used >= 1 - 1e-9]
        if not whole:
            most = max(used for _, used in found)
            whole = [(p, 1) for p, used in found if used >= min(0.5, most)]
        for pattern, n in sorted(whole, reverse=True):
            slots = [x for x, times in zip(sizes, pattern, strict=True) for _ in range(times)]
            out += substituted(slots, n, left, capacity)
    return out


def rounded_up(left: dict[int, int], groups: int) -> dict[int, int]:
    """How many pieces have each length once those of a group are as long as its longest."""
    lengths = sorted((x for x, n in left.items() if n), reverse=True)
    ends = np.cumsum([left[x] for x in lengths])
    total, out = int(ends[-1]), defaultdict(int)
    edges = [total * g // groups for g in range(groups + 1)]
    for a, b in zip(edges, edges[1:], strict=False):
        out[lengths[int(np.searchsorted(ends, a, side="right"))]] += b - a
    return {x: n for x, n in out.items() if n}


def substituted(slots: list[int], n: int, left: dict[int, int], capacity: int) -> list[Run]:
    """``n`` sequences of a configuration with actual pieces, which are taken from ``left``.

    A slot takes the longest piece that leaves the later slots their room: of its own group, or a
    longer one where actual pieces have left room that rounding had set aside; a large piece that
    fits into what is left at the end is added. So what is left over is never more than what was
    planned for, piece by piece."""
    out: list[Run] = []
    while n > 0:
        lengths = sorted((x for x, have in left.items() if have), reverse=True)
        taken: dict[int, int] = defaultdict(int)
        room, later = capacity, sum(slots)
        for slot in (*slots, *[0] * (SMALL + 1)):
            later -= slot
            fits = next((x for x in lengths if x <= room - later and left[x] > taken[x]), None)
            if fits is not None:
                taken[fits] += 1
                room -= fits
        if not taken:
            break
        times = min(n, *(left[x] // k for x, k in taken.items()))
        for x, k in taken.items():
            left[x] -= times * k
        out.append(Run(times, dict(taken), room))
        n -= times
    return out


def _best_fit(runs: list[Run], left: dict[int, int], capacity: int) -> list[Run]:
    rooms: dict[int, list[Run]] = defaultdict(list)
    for run in runs:
        rooms[run.room].append(run)
    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            room = min((r for r, have in rooms.items() if r >= length and have), default=None)
            run = rooms[room].pop() if room is not None else Run(count, {}, capacity)
            times = run.room // length
            if count < times:
                n, times = 1, count
            else:
                n = min(run.n, count // times)
            part = run.split(n)
            part.put(length, times)
            if run.n and run.lengths:
                rooms[run.room].append(run)
            rooms[part.room].append(part)
            count -= n * times
    return [run for have in rooms.values() for run in have]


def places(runs: list[Run]) -> dict[str, np.ndarray]:
    """By key (length, first rank), sorted: first sequence, pieces in each sequence, offset of the first."""
    rank, rows, sequence = defaultdict(int), [], 0
    for run in runs:
        offset = 0
        for length, times in sorted(run.lengths.items(), reverse=True):
            rows.append((length << RANK_BITS | rank[length], sequence, times, offset))
            rank[length] += run.n * times
            offset += length * times
        sequence += run.n
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return dict(zip(("key", "sequence", "times", "offset"), table.T, strict=True))


def ranked(items: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Pieces with a rank (from 0) among those of their length, and the count of each length.

    Ranks are counted within (length, bucket), so that a frequent length is many groups.
    """
    spark = items.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    items = items.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sizes = cut(items.groupBy("length", "bucket").count(), "packing-sizes")
    counts = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    before = F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count")
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    out = items.withColumn("own", within).join(sizes.withColumn("before", before), ["length", "bucket"])
    return out.withColumn("rank", F.col("before") + F.col("own")), counts


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """PLACED for every piece of every row of doc_id, text."""
    items, counts = ranked(cut(pieces(docs, path, capacity, end), "packing-pieces"))
    table = docs.sparkSession.sparkContext.broadcast(places(plan(counts, capacity)))
    names = [x.split()[0] for x in PIECES.split(", ")]

    def run(batches):
        t = table.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            i = np.searchsorted(t["key"], length << RANK_BITS | rank, side="right") - 1
            nth = (length << RANK_BITS | rank) - t["key"][i]
            sequence = t["sequence"][i] + nth // t["times"][i]
            offset = t["offset"][i] + nth % t["times"][i] * length
            arrays = [batch.column(c) for c in names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "sequence_id", "offset"])

    return items.select(*names, "rank").mapInArrow(run, PLACED)
