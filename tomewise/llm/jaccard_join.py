"""N-gram Jaccard join with count-vector R-trees.

A document is its set of distinct word shingles. Equal sets are one node. Two sets of Jaccard
similarity ``percent`` or more differ in few shingles, so of more hash slabs than that, some hold
the very same shingles in both: slabs deal documents out to Spark partitions without losing a pair
(sizes are banded, since similar sets are of similar size; shingles that are common in a sample are
left out where enough others remain, which loses no pair either). Documents that share a slab form
clusters, and every link lies within one.

A task joins the documents of a cluster by an R-tree: shingles are hashed into groups, the counts
of the groups are a point, and a box of points bounds the overlap with a document by the sum of the
smaller counts. Surviving pairs are verified on the full sets. Pairs that verified links connect
already are skipped, so that a group of near copies costs little more than one link a document. A
cluster too large for a task is cut into tiles by size band and hash, and each pair of tiles that
can hold links is a task of its own.

Null and empty texts, and texts without words, have an empty set and link with nothing. With fewer
words than a shingle, the whole sequence is the one shingle. Rows without an id are returned with a
null component and link with nothing. Repeated rows are nodes of one component. An empty table
gives an empty result; other columns are ignored by ``join`` and passed on by ``keep_one``. Sets are
told apart by 64-bit sums of shingle hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import cut
from .common import chunks, indexed, lower_words, text_key, texts, without
from .graph import components

SLOTS, SLOT_SHIFT = 1 << 24, np.uint64(40)  # of shingle hashes, by their first 24 bits
SAMPLE, SHARED = 8_000, 3  # documents looked at for common shingles, and how many share one
TILE = 8 << 20  # bytes of shingle hashes in a tile
LEAF = 16  # points of a leaf, and leaves of a box
FACTS = "doc_id long, key long, n long, node long"
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def shingle_sets(docs: list[list[bytes]], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    kinds, flat, ends = indexed(docs)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in kinds], np.uint64)[flat]
    rolled = np.zeros(max(0, len(flat) - words + 1), np.uint64)
    for k in range(words):
        rolled = mixed(rolled * M1 + hashes[k : k + len(rolled)])
    out, start = [], 0
    for end in ends.tolist():
        if end - start >= words:
            out.append(np.unique(rolled[start : end - words + 1]))
        elif end > start:
            whole = b" ".join(docs[len(out)])
            out.append(np.array([xxhash.xxh3_64_intdigest(whole, seed=words)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        start = end
    return out


def bands(percent: int, largest: int) -> list[int]:
    """First sizes of the size bands: a set's partners are in its own band or a neighbouring one."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, 100 * (out[-1] - 1) // percent + 1))
    return out


def differences(percent: int, size: int) -> int:
    """Most shingles in which linked sets differ, if the smaller one has at most ``size``."""
    return (size + 100 * size // percent) * (100 - percent) // (100 + percent)


def slab_keys(sets: list[np.ndarray], percent: int, common: np.ndarray | None = None) -> list[np.ndarray]:
    """Keys of each set such that linked, unequal sets have one in common.

    There are 1 + s more slabs than differences, so linked sets agree on 1 + s slabs at least, and
    also if only some of all shingles are looked at. First, slabs hold the shingles that are not
    ``common``; every set gives the keys of those that are not empty. If one of two linked sets has
    at most s empty ones, some slab they agree on is not empty. Sets with more of them give keys of
    slabs of all their shingles as well, where the same holds; with more than s empty ones there,
    also those of empty slabs.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return [np.zeros(0, np.uint64) for _ in sets]
    edges = np.array(bands(percent, int(sizes.max())))
    band = np.searchsorted(edges, sizes, side="right") - 1
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    rare = np.ones(len(flat), bool) if common is None else ~common[(flat >> SLOT_SHIFT).astype(np.int64)]
    spread, value = mixed(flat + M1), mixed(flat + M2)
    low, high = (value & np.uint64(0xFFFFFFFF)).astype(float), (value >> np.uint64(32)).astype(float)
    found: list[list[np.ndarray]] = [[] for _ in sets]
    for down in (0, 1):  # a set meets partners as the smaller one in its own band, else in the one below
        group = band - down
        tops = edges[np.minimum(np.maximum(group, 0) + 1, len(edges) - 1)] - 1
        most = np.array([differences(percent, int(t)) for t in tops])
        slack = 2 + most // 8
        slabs = np.where((group >= 0) & (most > 0) & (sizes > 0), most + 1 + slack, 0)
        first, total = np.cumsum(slabs) - slabs, int(slabs.sum())
        use = slabs[owner] > 0
        wide = np.maximum(slabs[owner], 1).astype(np.uint64)
        at = first[owner] + ((spread >> np.uint64(20)) % wide).astype(np.int64)
        whose = np.repeat(np.arange(len(sets)), slabs)
        place = (np.arange(total) - first[whose]).astype(np.uint64)
        again = np.ones(len(sets), bool)
        for layer, chosen in enumerate((use & rare, use)):
            sums = [np.bincount(at[chosen], w[chosen], minlength=total).astype(np.uint64) for w in (low, high)]
            held = np.bincount(at[chosen], minlength=total)
            tag = mixed((group[whose].astype(np.uint64) * np.uint64(2) + np.uint64(layer)) << np.uint64(32) | place)
            keys = mixed(mixed(sums[0] + tag) + sums[1] * M1)
            few = np.bincount(whose[held == 0], minlength=len(sets)) > slack
            kept = (held > 0) & again[whose]
            if layer:
                kept |= (few & again)[whose]
            ends = np.cumsum(np.bincount(whose[kept], minlength=len(sets)))[:-1]
            for i, some in enumerate(np.split(keys[kept], ends)):
                found[i].append(some)
            again = few
            if common is None and not layer:
                again = few & (slabs > 0)
    return [np.concatenate(k) for k in found]


def common_shingles(docs: DataFrame, words: int, sample: int = SAMPLE) -> np.ndarray:
    """Which slots of shingle hashes several documents of a sample share (SLOTS booleans).

    The sample (``sample`` rows, by order of an id hash) only makes keys more selective: no choice of
    common shingles can lose a link.
    """
    taken = docs.select("doc_id").where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.join(F.broadcast(taken.distinct()), "doc_id", "left_semi").select("text")

    def run(batches):
        for batch in chunks(batches):
            slots = [np.unique((s >> SLOT_SHIFT).astype(np.int64)) for s in shingle_sets([lower_words(t) for t in texts(batch)], words)]
            kinds, n = np.unique(np.concatenate(slots), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(n.astype(np.int64))], ["slot", "n"])

    counts = rows.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    out = np.zeros(SLOTS, bool)
    out[counts.where(F.col("n") >= SHARED).select("slot").toArrow()["slot"].to_numpy()] = True
    return out


def _facts(docs: DataFrame, words: int) -> DataFrame:
    """FACTS of every row."""

    def run(batches):
        for batch in chunks(batches, limit=2 << 20):
            sets = shingle_sets([lower_words(t) for t in texts(batch)], words)
            nodes = np.array([int(mixed(s).sum(dtype=np.uint64)) for s in sets], np.uint64).astype(np.int64)
            columns = [batch.column("doc_id").cast(pa.int64()), batch.column("key"), pa.array([len(s) for s in sets], pa.int64()),
                       pa.array(nodes, mask=np.array([not len(s) for s in sets]))]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in FACTS.split(", ")])

    return docs.select("doc_id", "text", text_key().alias("key")).mapInArrow(run, FACTS)


def _slabs(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """key, node of every slab of the sets of rows with an id; those of a set are given once in a task.

    They take about as much room as the texts, so they are never written: they go straight to their shuffle.
    """
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, words))

    def run(batches):
        seen: set[int] = set()
        for batch in chunks(batches, limit=2 << 20):
            sets = shingle_sets([lower_words(t) for t in texts(batch)], words)
            fresh, nodes = [], []
            for s in sets:
                node = int(mixed(s).sum(dtype=np.uint64))
                if len(s) and node not in seen:
                    seen.add(node)
                    fresh.append(s)
                    nodes.append(node)
            keys = slab_keys(fresh, percent, common.value)
            owner = np.repeat(np.array(nodes, np.uint64).astype(np.int64), [len(k) for k in keys])
            flat = np.concatenate([*keys, np.zeros(0, np.uint64)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(owner)], ["key", "node"])

    return docs.where("doc_id IS NOT NULL").select("text").mapInArrow(run, "key long, node long")


def _stars(batches):
    """An edge from the first node of each key to its other nodes, from rows sorted by key and node."""
    key, hub, seen = None, None, set()
    for batch in batches:
        keys, nodes = batch.column("key").to_numpy(), batch.column("node").to_numpy()
        if not len(keys):
            continue
        fresh = np.concatenate([[keys[0] != key], keys[1:] != keys[:-1]])
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), -1))
        hubs = np.where(first < 0, nodes[0] if hub is None else hub, nodes[first])
        key, hub = keys[-1], hubs[-1]
        other = hubs != nodes
        pairs = set(zip(hubs[other].tolist(), nodes[other].tolist(), strict=True)) - seen
        seen |= pairs
        if len(seen) > 500_000:
            seen = set()
        a, b = zip(*pairs, strict=True) if pairs else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _bytes(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([s.tobytes() for s in sets], pa.binary())


def _with_sets(rows: DataFrame, words: int) -> DataFrame:
    """Adds the shingle hashes of each text to unit, node; rows whose text is another set go."""

    def run(batches):
        for batch in chunks(batches, limit=2 << 20):
            sets = shingle_sets([lower_words(t) for t in texts(batch)], words)
            nodes = np.array([int(mixed(s).sum(dtype=np.uint64)) for s in sets], np.uint64).astype(np.int64)
            out = pa.RecordBatch.from_arrays([batch.column("units"), batch.column("node"), _bytes(sets)], ["units", "node", "set"])
            yield out.filter(pa.array(nodes == batch.column("node").to_numpy()))

    return rows.select("units", "node", "text").mapInArrow(run, "units array<long>, node long, set binary")


class CountTree:
    """An R-tree, packed level by level, over the group counts of sets."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent, self.sizes = percent, np.array([len(s) for s in sets])
        middle = float(np.median(self.sizes))
        self.groups = 1 << int(np.clip(np.ceil(np.log2(max(middle / 4, 1))), 4, 9))
        shift = np.uint64(64 - self.groups.bit_length() + 1)
        self.points = np.stack([np.bincount((s >> shift).astype(np.int64), minlength=self.groups) for s in sets])
        # neighbours on a leaf are close in size, then in the coordinate that varies most
        widest = int(np.argmax(self.points.var(axis=0)))
        slab = np.argsort(np.argsort(self.sizes, kind="stable")) // (LEAF * LEAF)
        self.order = np.lexsort((self.points[:, widest], slab))
        tops, sizes = self.points[self.order], self.sizes[self.order]
        self.levels = []  # from leaves to the root: largest counts, smallest and largest size of each box
        low = high = sizes
        while len(tops) > 1:
            cuts = np.arange(0, len(tops), LEAF)
            tops = np.maximum.reduceat(tops, cuts)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((tops, low, high))

    def needed(self, a: int, b: np.ndarray) -> np.ndarray:
        """Shared shingles that sets of sizes a and b need to be linked."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def near(self, i: int) -> np.ndarray:
        """Sets whose bound of the overlap with set ``i`` is high enough."""
        point, size = self.points[i], int(self.sizes[i])
        boxes = np.arange(len(self.levels[-1][0])) if self.levels else np.zeros(1, np.int64)
        for tops, low, high in reversed(self.levels):
            bound = np.minimum(tops[boxes], point).sum(axis=1)
            fits = (100 * high[boxes] >= self.percent * size) & (self.percent * low[boxes] <= 100 * size)
            smallest = np.maximum(low[boxes], -(-self.percent * size // 100))
            boxes = boxes[fits & (bound >= self.needed(size, smallest))]
            boxes = (boxes[:, None] * LEAF + np.arange(LEAF)).ravel()
            below = len(self.points) if tops is self.levels[0][0] else len(self.levels[self._level(tops) - 1][0])
            boxes = boxes[boxes < below]
        found = self.order[boxes]
        bound = np.minimum(self.points[found], point).sum(axis=1)
        return found[bound >= self.needed(size, self.sizes[found])]

    def _level(self, tops: np.ndarray) -> int:
        return next(k for k, level in enumerate(self.levels) if level[0] is tops)


def links(nodes: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Verified links that connect all that the links of the sets connect."""
    if len(nodes) < 2:
        return []
    tree, label, out = CountTree(sets, percent), np.arange(len(nodes)), []
    members = {i: [i] for i in range(len(nodes))}
    for i in range(len(nodes)):
        if len(members) == 1:
            break
        for j in tree.near(i).tolist():
            if label[i] == label[j]:
                continue
            small, large = (sets[i], sets[j]) if len(sets[i]) <= len(sets[j]) else (sets[j], sets[i])
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            shared = int((large[at] == small).sum())
            if 100 * shared >= percent * (len(small) + len(large) - shared):
                out.append((nodes[i], nodes[j]))
                keep, gone = sorted((int(label[i]), int(label[j])), key=lambda x: -len(members[x]))
                label[members[gone]] = keep
                members[keep] += members.pop(gone)
    return out


def _linked(percent: int):
    def run(batches):
        unit, nodes, sets = None, [], []
        for batch in batches:
            out = []
            for u, node, data in zip(*(batch.column(c).to_pylist() for c in ("unit", "node", "set")), strict=True):
                if u != unit:
                    out += links(nodes, sets, percent)
                    unit, nodes, sets = u, [], []
                if not nodes or nodes[-1] != node:  # rows are sorted by unit and node
                    nodes.append(node)
                    sets.append(np.frombuffer(data, np.uint64))
            yield _edges(out)
        yield _edges(links(nodes, sets, percent))

    return run


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def units(members: DataFrame, percent: int, tile: int = TILE) -> DataFrame:
    """Adds ``units``, the tasks that each member of a cluster takes part in.

    A cluster of at most ``tile`` bytes is one unit. In a larger one, the members of each size band
    are salted into tiles, and each two tiles of one band or of neighbouring bands are a unit.
    """
    step = np.log(100 / percent)
    # never narrower than the similarity allows: partners are at most one band apart
    band = F.floor(F.log("n") / F.lit(step * 1.0000001)).cast("long")
    members = members.withColumn("band", band)
    sizes = cut(members.groupBy("cluster", "band").agg(F.sum(F.col("n") * 8).alias("bytes")), "join-tiles")
    whole = sizes.groupBy("cluster").agg(F.sum("bytes").alias("whole"))
    tiles = F.ceil(F.col("bytes") / tile)
    sizes = sizes.select("cluster", "band", tiles.alias("tiles"))
    near = lambda by, name: sizes.select("cluster", (F.col("band") + by).alias("band"), F.col("tiles").alias(name))
    own = near(0, "here").join(near(-1, "above"), ["cluster", "band"], "left").join(near(1, "below"), ["cluster", "band"], "left")
    own = own.join(whole, "cluster")
    salt = F.pmod(F.xxhash64("node"), F.col("here"))
    upto = lambda name: F.when(F.coalesce(name, F.lit(0)) > 0, F.sequence(F.lit(0), F.col(name).cast("int") - 1)).otherwise(F.array().cast("array<int>"))  # noqa: E731, E501
    unit = lambda b, i, c, j: F.xxhash64("cluster", b, i.cast("long"), c, j.cast("long"))
    band, salt = F.col("band"), F.col("salt")
    split = F.concat(
        F.transform(upto("here"), lambda j: unit(band, F.least(salt, j), band, F.greatest(salt, j))),
        F.transform(upto("above"), lambda j: unit(band, salt, band + 1, j)),
        F.transform(upto("below"), lambda j: unit(band - 1, j, band, salt)),
    )
    members = members.join(own, ["cluster", "band"]).withColumn("salt", F.pmod(F.xxhash64("node"), F.col("here")))
    return members.withColumn("units", F.when(F.col("whole") <= tile, F.array("cluster")).otherwise(split))


def join(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of doc_id, text."""
    return classes(docs, words, percent).drop("key")


def classes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, key of the text, n_shingles, component_id of every row of doc_id, text."""
    docs = docs.select("doc_id", "text")
    facts = cut(_facts(docs, words), "join-facts")
    dealt = _slabs(docs, words, percent).repartition("key").sortWithinPartitions("key", "node")
    clusters = components(cut(dealt.mapInArrow(_stars, "a long, b long").distinct(), "join-stars"))
    clusters = cut(clusters.withColumnRenamed("root", "cluster"), "join-clusters")
    nodes = facts.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node")
    nodes = nodes.agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"))
    nodes = cut(nodes, "join-nodes")
    members = units(cut(nodes.join(clusters, "node"), "join-members"), percent)
    texts_of = docs.join(members.select("doc_id", "node", "units"), "doc_id")
    dealt = _with_sets(texts_of, words).select(F.explode("units").alias("unit"), "node", "set")
    dealt = dealt.repartition("unit").sortWithinPartitions("unit", "node")
    found = components(cut(dealt.mapInArrow(_linked(percent), "a long, b long"), "join-links"))
    roots = nodes.join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "doc_id")
    roots = cut(roots, "join-roots")
    least = roots.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of = roots.join(least, "root").select("node", "component_id")
    own = facts.select("doc_id", "key", F.col("n").alias("n_shingles"), "node").join(of, "node", "left")
    return own.select("doc_id", "key", "n_shingles", _class(F.col("component_id")).alias("component_id"))


def _class(component: Column) -> Column:
    return F.when(F.col("doc_id").isNotNull(), F.coalesce(component, F.col("doc_id")))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their text's component; rows without an id stay."""
    return without(docs, classes(docs, words, percent).where("doc_id <> component_id"))
