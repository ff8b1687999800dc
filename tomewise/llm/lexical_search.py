"""Ranked lexical search: exact inner products by best-first search of sparse ball trees.

A first pass cuts every document into terms and keeps its length and the counts of those terms
that some item asks for (no other term can add to a score); Spark sums up the statistics. In the
second pass, each task gathers documents into blocks and builds a ball tree over each: a document is
the sparse vector of its term values, a node holds the centroid of its documents and their radius in
each group of terms. For an item with term weights u, no document below a node can score more than
u.centroid plus the sum over the groups of |u in the group| * radius; radii and bounds are rounded up
by more than floating point can lose. (Texts share few terms, so a ball over all terms
prunes next to nothing; balls of few terms do.) Nodes are visited best-first and left out only when
their bound is below the lowest score among the best found so far; documents of a leaf are scored
in integers. Windows merge the best of all tasks. Items are worked on in blocks of a bounded
vocabulary, so what is shipped of them does not grow with the number of items.

Null and empty texts have no terms: they count for nothing and are never found, and an item
without a known term finds nothing. Equal scores are ordered by doc_id, rows without an id last; every
one of repeated rows is counted and ranked, and each of repeated items gets a list of its own. Empty
tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import cut
from .common import chunks, texts

TOP = 20
BLOCK, LEAF = 4096, 16  # documents of a tree, and of a leaf at most
GROUPS = 4096  # of columns, each with a radius of its own
TERMS, CELLS = 16_384, 4 << 20  # of a block of items: terms, and items * terms
FACTS = "doc_id long, n_terms long, terms array<int>, counts array<int>"
FOUND = "place int, doc_id long, score long"

#: Every byte outside [0-9A-Za-z\x80-\xFF] separates terms; A-Z is lower-cased.
SEPARATED = bytes(b + 32 * (65 <= b <= 90) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(SEPARATED).split()


@dataclass
class Items:
    """A block of items: their ids, the terms of all, and each one's (term, count) pairs."""

    ids: list
    terms: dict[bytes, int]
    counts: list[dict[int, int]]

    def full(self, terms: int, cells: int) -> bool:
        return len(self.terms) >= terms or len(self.terms) * len(self.ids) >= cells

    def matrix(self) -> np.ndarray:
        out = np.zeros((len(self.ids), len(self.terms)), np.int64)
        for i, counts in enumerate(self.counts):
            out[i, list(counts)] = list(counts.values())
        return out


def item_blocks(items: DataFrame, terms: int = TERMS, cells: int = CELLS) -> Iterator[Items]:
    """The rows of item_id, text in blocks that end with the item that reaches a bound."""
    block = Items([], {}, [])
    for row in items.select("item_id", "text").toLocalIterator():
        found = Counter(terms_of(row.text or ""))
        block.ids.append(row.item_id)
        block.counts.append({block.terms.setdefault(t, len(block.terms)): n for t, n in found.items()})
        if block.full(terms, cells):
            yield block
            block = Items([], {}, [])
    if block.ids:
        yield block


def facts(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """FACTS of every row of doc_id, text: all its terms are counted, the given ones are listed."""

    def run(batches):
        place = terms.get
        for batch in chunks(batches):
            n, found = [], []
            for text in texts(batch):
                words = terms_of(text)
                n.append(len(words))
                listed = Counter(map(place, words))
                listed.pop(None, None)
                found.append(listed)
            lists = [pa.array([list(x) for x in found], pa.list_(pa.int32())),
                     pa.array([list(x.values()) for x in found], pa.list_(pa.int32()))]
            arrays = [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_terms", "terms", "counts"])

    return docs.select("doc_id", "text").mapInArrow(run, FACTS)


def term_weights(found: DataFrame, terms: int) -> tuple[np.ndarray, int, int]:
    """The weight of each listed term, and how many documents and terms there are."""
    size = found.where("n_terms > 0").agg(F.count("*").alias("n"), F.sum("n_terms").alias("total")).first()
    df = np.zeros(terms, np.int64)
    for row in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[row.term] = row["count"]
    weights = [math.floor(1000 * math.log((2 * size.n + 2) / (2 * d + 1))) for d in df.tolist()]
    return np.array(weights, np.int64), size.n, size.total or 0


@dataclass
class Sparse:
    """Rows of (column, value): the entries of row i are those from ends[i - 1] to ends[i]."""

    columns: np.ndarray
    values: np.ndarray
    ends: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)

    def rows(self, order: np.ndarray) -> Sparse:
        sizes = self.sizes[order]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.ends[order] - sizes - (ends - sizes), sizes)
        return Sparse(self.columns[at], self.values[at], ends)


class BallTree:
    """A binary tree over sparse rows of positive numbers; rows are put in the order of its leaves.

    A node has its centroid and, for each group of columns, the radius around it: the largest
    distance of a row in the columns of that group, rounded up.
    """

    def __init__(self, rows: Sparse, width: int, leaf: int = LEAF, groups: int = GROUPS):
        #: More than the rounding of a sum of ``width`` products can take away, relative to its terms.
        self.slack = 8 * (width + 8) * 2.0**-53
        self.groups = min(groups, width)
        live, node = np.arange(len(rows.ends)), np.zeros(len(rows.ends), np.int64)
        leaves, self.children, levels, total = np.zeros(len(live), np.int64), {}, [], 0
        while len(live):
            some, sizes = rows.rows(live), np.bincount(node)
            m, names = len(sizes), total + np.arange(len(sizes))
            total += m
            centre, far, radii = self._balls(some, node, m, width)
            levels.append((centre, radii))
            split = sizes > leaf
            leaves[live] = names[node]
            child = total + 2 * (np.cumsum(split) - 1)
            self.children.update({int(names[i]): (int(child[i]), int(child[i]) + 1) for i in np.flatnonzero(split)})
            right = self._right(some, node, sizes, far, width)
            keep = split[node]
            live, node = live[keep], (child[node] - total + right)[keep]
        self.order = np.argsort(leaves, kind="stable")
        self.rows = rows.rows(self.order)
        placed = leaves[self.order]
        self.first = np.searchsorted(placed, np.arange(total)).tolist()
        self.last = np.searchsorted(placed, np.arange(total), side="right").tolist()
        self.centroids, self.radii = (np.concatenate(x) for x in zip(*levels, strict=True))

    def _balls(self, rows: Sparse, node: np.ndarray, m: int, width: int) -> tuple[np.ndarray, ...]:
        """Centroids of the nodes, squared distances of rows to theirs, and radii by column group."""
        x, n, g = rows.values.astype(float), len(node), self.groups
        of, sizes = np.repeat(np.arange(n), rows.sizes), np.bincount(node, minlength=m)
        centre = np.bincount(node[of] * width + rows.columns, x, m * width).reshape(m, width)
        centre /= sizes[:, None]
        square = np.zeros((m, -(-width // g) * g))
        square[:, :width] = centre * centre
        square = square.reshape(m, -1, g).sum(1).ravel()
        own, cross = x * x, 2 * x * centre[node[of], rows.columns]
        far = np.bincount(of, own - cross, n) + square.reshape(m, g).sum(1)[node]
        # (row, group) pairs without an entry are as far as the centroid is from 0 there
        pair, where = np.unique(of * g + rows.columns % g, return_inverse=True)
        at = node[pair // g] * g + pair % g
        own = np.bincount(where, own)
        near = np.maximum(own - np.bincount(where, cross) + square[at], 0) + self.slack * (own + square[at])
        radii = np.where(np.bincount(at, minlength=m * g) < np.repeat(sizes, g), square * (1 + self.slack), 0)
        np.maximum.at(radii, at, near)
        return centre, far, np.sqrt(radii).reshape(m, g) * (1 + self.slack)

    def _right(self, rows: Sparse, node: np.ndarray, sizes: np.ndarray, far: np.ndarray, width: int) -> np.ndarray:
        """Which rows go to the right child: those nearer to the second of two pivots, the row
        farthest from the centroid and the one farthest from that. Each side gets an eighth at least."""
        x, m = rows.values.astype(float), len(sizes)
        of = np.repeat(np.arange(len(node)), rows.sizes)
        norms = np.bincount(of, x * x, len(node))

        def distance(chosen: np.ndarray) -> np.ndarray:
            at = rows.rows(chosen)
            points = np.zeros((m, width))
            points[np.repeat(np.arange(m), at.sizes), at.columns] = at.values
            return norms + norms[chosen][node] - 2 * np.bincount(of, x * points[node[of], rows.columns], len(node))

        last = np.cumsum(sizes) - 1
        first = distance(np.lexsort((far, node))[last])
        lean = first - distance(np.lexsort((first, node))[last])
        order = np.lexsort((lean, node))
        place = np.empty(len(node), np.int64)
        place[order] = np.arange(len(node)) - (np.cumsum(sizes) - sizes)[node[order]]
        left = np.bincount(node, lean <= 0, m).astype(np.int64)
        left = np.where((left < sizes // 8) | (left > sizes - sizes // 8) | (left == 0) | (left == sizes), sizes // 2, left)
        return (place >= left[node]).astype(np.int64)

    def bounds(self, worth: np.ndarray) -> np.ndarray:
        """For each row of column weights and each node, a number no score below the node exceeds."""
        wide = np.zeros((len(worth), -(-worth.shape[1] // self.groups) * self.groups))
        wide[:, : worth.shape[1]] = worth * worth
        norms = np.sqrt(wide.reshape(len(worth), -1, self.groups).sum(1))
        return (worth @ self.centroids.T + norms @ self.radii.T) * (1 + self.slack)

    def leaf_scores(self, node: int, worth: np.ndarray) -> np.ndarray:
        """Exact scores of a leaf's rows for the worth of each column."""
        a, b = self.first[node], self.last[node]
        lo = int(self.rows.ends[a - 1]) if a else 0
        hi = int(self.rows.ends[b - 1])
        starts = np.concatenate([[0], self.rows.ends[a : b - 1] - lo])
        return np.add.reduceat(self.rows.values[lo:hi] * worth[self.rows.columns[lo:hi]], starts)


class Best:
    """The best ``top`` (score, known, doc_id) of one item."""

    def __init__(self, top: int, least: int = 1):
        self.top, self.scores = top, np.zeros(0, np.int64)
        self.known, self.ids = np.zeros(0, bool), np.zeros(0, np.int64)
        self.least = least  # scores below cannot enter; equal ones may, by their id

    def add(self, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        enter = scores >= self.least
        if not enter.any():
            return
        scores, known = np.concatenate([self.scores, scores[enter]]), np.concatenate([self.known, known[enter]])
        ids = np.concatenate([self.ids, ids[enter]])
        order = np.lexsort((ids, ~known, -scores))[: self.top]
        self.scores, self.known, self.ids = scores[order], known[order], ids[order]
        if len(order) == self.top:
            self.least = max(self.least, int(self.scores[-1]))


def search_tree(tree: BallTree, worth: np.ndarray, best: list[Best], known: np.ndarray, ids: np.ndarray) -> int:
    """Adds the rows of a tree to the best of every item; the number of leaves that were scored."""
    bounds, scored = tree.bounds(worth.astype(float)), 0
    for i, own in enumerate(best):
        bound, open_ = bounds[i], [(-bounds[i, 0], 0)]
        while open_ and -open_[0][0] >= own.least:
            _, node = heapq.heappop(open_)
            if node in tree.children:
                for child in tree.children[node]:
                    if bound[child] >= own.least:
                        heapq.heappush(open_, (-bound[child], child))
            else:
                at = slice(tree.first[node], tree.last[node])
                own.add(tree.leaf_scores(node, worth[i]), known[at], ids[at])
                scored += 1
    return scored


def _values(counts: np.ndarray, sizes: np.ndarray, n_terms: list[int], n: int, total: int) -> np.ndarray:
    m = np.repeat(np.array([75 + 25 * x * n // total for x in n_terms], np.int64), sizes)
    return 1_000_000_000 * counts // (1000 * counts + 12 * m)


class Search:
    """The best rows of FACTS for a block of items."""

    def __init__(self, block: Items, weights: np.ndarray, n: int, total: int, top: int, tree: int):
        self.block, self.weights, self.n, self.total, self.top, self.tree = block, weights, n, total, top, tree

    def local(self, found: DataFrame, least: dict[int, int]) -> DataFrame:
        """FOUND: the best of each task, among rows that score ``least`` or more."""
        block, weights, n, total, top, size = self.block, self.weights, self.n, self.total, self.top, self.tree

        def run(batches):
            worth = block.matrix() * weights
            best = [Best(top, least.get(i, 1)) for i in range(len(block.ids))]
            held: list[pa.RecordBatch] = []

            def grow() -> None:
                rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                lists, counts = rows.column("terms"), rows.column("counts")
                columns, counts = (c.flatten().to_numpy().astype(np.int64) for c in (lists, counts))
                sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                values = _values(counts, sizes, rows.column("n_terms").to_pylist(), n, total)
                made = BallTree(Sparse(columns, values, np.cumsum(sizes)), len(weights))
                ids = rows.column("doc_id")
                known = ids.is_valid().to_numpy(zero_copy_only=False)[made.order]
                search_tree(made, worth, best, known, ids.fill_null(0).to_numpy()[made.order])
                held.clear()

            for batch in batches:
                start = 0
                while start < batch.num_rows:
                    part = batch.slice(start, size - sum(b.num_rows for b in held))
                    held.append(part)
                    start += part.num_rows
                    if sum(b.num_rows for b in held) == size:
                        grow()
            if held:
                grow()
            for i, own in enumerate(best):
                if len(own.ids):
                    ids = pa.array(own.ids, mask=~own.known)
                    arrays = [pa.array([i] * len(own.ids), pa.int32()), ids, pa.array(own.scores)]
                    yield pa.RecordBatch.from_arrays(arrays, ["place", "doc_id", "score"])

        return found.where(F.size("terms") > 0).mapInArrow(run, FOUND)

    def ranked(self, found: DataFrame) -> DataFrame:
        """place, rank, doc_id, score of the best rows of all tasks.

        The lowest of the best scores among some rows (those of one tree, out of one written file) is
        where every task starts: it saves work, and no row that scores less can be among the best of all.
        """
        files = sorted(found.inputFiles())[:1]
        some = found.sparkSession.read.schema(found.schema).parquet(*files) if files else found
        some = self.local(some.where(F.size("terms") > 0).limit(self.tree), {})
        first = some.groupBy("place").agg(F.count("*").alias("n"), F.min("score").alias("least"))
        least = {r.place: r.least for r in first.collect() if r.n == self.top}
        order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        every = self.local(found, least).withColumn("rank", F.row_number().over(order))
        return every.where(F.col("rank") <= self.top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = TERMS, tree: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the best ``top`` rows of doc_id, text for each row of item_id, text."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    parts = []
    for block in item_blocks(items, block_terms):
        if not block.terms:
            continue
        found = cut(facts(docs, block.terms), "search-facts")
        weights, n, total = term_weights(found, len(block.terms))
        ranked = Search(block, weights, n, total, top, tree).ranked(found)
        ids = spark.createDataFrame(list(enumerate(block.ids)), f"place int, item_id {kind}")
        parts.append(ranked.join(F.broadcast(ids), "place").select("item_id", "rank", "doc_id", "score"))
    empty = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, parts) if parts else empty
