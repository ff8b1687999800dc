"""Tree ensembles grown level by level: random forests, extremely randomised trees and second-order boosting.

All open nodes of a level are worked on at once, whatever their number of trees. Tasks sum up
gradients and hessians by (node, feature, bin); blocks of nodes are added up and searched for the best
split where Spark has brought them together, so that one row for each node comes to the driver. Bins
are the sides of one random split point for randomised trees (drawn between the least and the
greatest value in the node, which a pass of their own finds), and quantiles of the feature for boosting;
missing values are a bin that goes to the better side. Levels with many nodes take several passes, so
a task holds a bounded number of sums.

Nodes of at most ``gather`` rows are finished in one job at the end: their rows are dealt out by node, and the
same sums, draws and choices are made where they lie. A table of a bounded size (``WHOLE``) is handed to all tasks
instead: each grows whole trees from it, and boosted trees, which need one another, are grown by one task. The
nodes of a forest are as many as its rows times its trees: they are written, packed by tree, and read back for a
bounded number of trees at a time. Random numbers depend on (seed, tree, node,
feature) and (seed, tree, row) only, so trees do not depend on partitions or on that bound.

A forest draws its rows with replacement: a row counts in a tree as often as a Poisson number of mean 1
says, which weighs its g and h.

With g = -label and h = 1 the leaf value -g / (h + l2) is the mean and the gain is the fall of the
squared error; boosting takes g = prediction - label and shrinks by both penalties.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import cut

CELLS = 16 << 20  # (node, feature, bin) sums of a pass
FINISH_CELLS = 1 << 18  # of them where nodes are finished
PAIRS = 1 << 16  # (row, tree) pairs worked on at a time
TALLIED = 1 << 21  # values of pairs that are added up at a time
BLOCK = 64  # nodes that are added up together
BINS = 64  # quantile bins of a feature
FOREST_BINS = 32  # of them in a forest, as Spark ML has
SPLIT_ROWS = 50_000  # rows that a forest's split points are taken from (Spark ML: 10,000)
GATHER = 16_384  # rows of a node that is finished in one task
WHOLE = 64 << 20  # bytes of a table that is handed to each task (codes, or numbers where split points are drawn)
GROUP = 1 << 20  # nodes of the trees that are looked up together
MARGIN_EVERY = 25  # trees after which boosted predictions are written next to the rows
NODES = "tree int, node long, feature int, threshold double, missing_left boolean, value double, gain double, cover double"
NAMES = [c.split()[0] for c in NODES.split(", ")]
DTYPES = [np.int32, np.int64, np.int32, np.float64, np.bool_, np.float64, np.float64, np.float64]
PACKED = "tree int, n long, body binary"
KINDS = [pa.int32(), pa.int64(), pa.int32(), pa.float64(), pa.bool_(), pa.float64(), pa.float64(), pa.float64()]


@dataclass(frozen=True)
class Growth:
    """How trees are grown. ``random``: one drawn split point a feature, else quantile bins."""

    random: bool
    trees: int
    max_depth: int
    min_split: float = 2.0
    min_leaf: float = 1.0
    alpha: float = 0.0  # L1 penalty of a leaf's gradient
    l2: float = 0.0
    columns: float = 1.0  # share of the features that a tree sees
    rows: float = 1.0  # share of the rows that a tree sees
    bootstrap: bool = False  # rows are drawn with replacement for each tree
    node_features: str = "all"  # features drawn for each node: all, sqrt, log2, onethird, a share or a number
    seed: int = 42
    first: int = 0  # number of the first tree
    gather: int = GATHER


def mixed(*parts) -> np.ndarray:
    """Uniform numbers in (0, 1) that depend on the given whole numbers."""
    with np.errstate(over="ignore"):
        out = np.uint64(0)
        for p in parts:
            out = out + np.asarray(p).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
            out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            out = out ^ (out >> np.uint64(31))
    return ((out >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def shrunk(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def leaf(g, h, growth: Growth):
    return -shrunk(g, growth.alpha) / (h + growth.l2)


def _score(g, h, growth: Growth):
    if not growth.alpha:
        return g * g / np.maximum(h + growth.l2, 1e-300)
    return shrunk(g, growth.alpha) ** 2 / np.maximum(h + growth.l2, 1e-300)


#: Below these numbers a uniform one stands for 0, 1, 2, ... draws of a row.
DRAWS = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 18)]))


def features_of_node(strategy: str, width: int) -> int:
    """How many features a node may be split on, by the strategies that Spark ML names."""
    named = {"all": width, "auto": -(-width // 3), "onethird": -(-width // 3), "sqrt": np.ceil(np.sqrt(width)), "log2": np.ceil(np.log2(width))}
    if strategy not in named:
        whole = strategy.isdigit()
        if not (whole and int(strategy) > 0) and not 0 < float(strategy) <= 1:
            raise ValueError(f"Unknown number of features: {strategy}")
        named[strategy] = int(strategy) if whole else np.ceil(float(strategy) * width)
    return int(min(max(named[strategy], 1), width))


@dataclass
class Open:
    """Nodes that may be split: positions 0 .. n - 1 stand for (tree, node)."""

    tree: np.ndarray
    node: np.ndarray

    def part(self, a: int, b: int) -> Open:
        return Open(self.tree[a:b], self.node[a:b])


# ------------------------------------------------------------------ sums and splits of a level
def ranges(x: np.ndarray, row: np.ndarray, place: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each feature in each place, for (row, place) pairs."""
    low, high = np.full((n, x.shape[1]), np.inf), np.full((n, x.shape[1]), -np.inf)
    order = np.argsort(place, kind="stable")
    for a in range(0, len(order), PAIRS):
        some = order[a : a + PAIRS]
        here, starts = np.unique(place[some], return_index=True)
        values = x[row[some]]
        low[here] = np.fmin(low[here], np.fmin.reduceat(values, starts))
        high[here] = np.fmax(high[here], np.fmax.reduceat(values, starts))
    return low, high


def drawn(low: np.ndarray, high: np.ndarray, nodes: Open, seed: int) -> np.ndarray:
    """A split point between low and high for each node and feature (nan without any)."""
    u = mixed(seed, nodes.tree[:, None], nodes.node[:, None], np.arange(low.shape[1])[None, :])
    with np.errstate(invalid="ignore"):
        return np.where(high > low, np.minimum(low + u * (high - low), np.nextafter(high, -np.inf)), np.nan)


def coded(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The bin of every value: how many edges of its feature are smaller; the last one if it is missing."""
    code = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(x.shape[1])], 1)
    return np.where(np.isnan(x), edges.shape[1] + 1, code).astype(np.uint8 if edges.shape[1] < 255 else np.int64)


def sums(x, row, place, n: int, g, h, points: np.ndarray, random: bool, times: np.ndarray | None = None) -> np.ndarray:
    """[2, n, features, bins] sums of g and h, a pair counted ``times``; the last bin holds missing values."""
    width, bins = x.shape[1], (3 if random else points.shape[1] + 2)
    out = np.zeros((2, n * width * bins))
    code = None if random else coded(x, points)
    order, step = np.argsort(place, kind="stable"), max(1, TALLIED // width)
    for a in range(0, len(order), step):
        some = order[a : a + step]
        r, p = row[some], place[some]
        values = x[r] if random else code[r]
        codes = np.where(np.isnan(values), bins - 1, values > points[p]) if random else values
        many = 1.0 if times is None else times[some]
        tally(out, p, codes, (g[r] * many, h[r] * many), bins)
    return out.reshape(2, n, width, bins)


def tally(out: np.ndarray, place: np.ndarray, codes: np.ndarray, weights: tuple, bins: int) -> None:
    """Adds the weights of pairs ordered by place to the cells [place, feature, bin] that their codes name."""
    width, low = codes.shape[1], int(place[0]) if len(place) else 0
    cell = np.add(codes, np.arange(width) * bins, dtype=np.int64)
    cell += ((place - low) * (width * bins))[:, None]
    size = (int(place[-1]) - low + 1) * width * bins if len(place) else 0
    for k, weight in enumerate(weights):
        out[k, low * width * bins :][:size] += np.bincount(cell.ravel(), np.repeat(weight, width), size)


def choose(found: np.ndarray, points: np.ndarray, nodes: Open, growth: Growth) -> dict[str, np.ndarray]:
    """The best split of each node, and its sums. Feature -1: none is worth it. Among splits whose gains differ by
    rounding only, the first one is taken, in whatever order the rows were added up."""
    g, h = found
    total_g, total_h = g[:, 0].sum(1), h[:, 0].sum(1)
    left_g, left_h = g[:, :, :-1].cumsum(2)[:, :, :-1], h[:, :, :-1].cumsum(2)[:, :, :-1]
    allowed = np.ones(g.shape[1], bool)[None, :] & ~np.isnan(points if growth.random else np.zeros((1, g.shape[1])))
    if growth.columns < 1:
        # the columns with the lowest numbers, drawn once for each tree
        drawn_ = mixed(growth.seed + 1, nodes.tree[:, None], np.arange(g.shape[1])[None, :])
        rank = drawn_.argsort(1).argsort(1)
        allowed = allowed & (rank < max(1, round(growth.columns * g.shape[1])))
    if (some := features_of_node(growth.node_features, g.shape[1])) < g.shape[1]:
        drawn_ = mixed(growth.seed + 3, nodes.tree[:, None], nodes.node[:, None], np.arange(g.shape[1])[None, :])
        allowed = allowed & (drawn_.argsort(1).argsort(1) < some)
    best = {"gain": np.full(len(total_g), -np.inf)}
    rounding = 1e-12 * np.maximum(_score(total_g, total_h, growth), 1e-12)
    for missing_left in (False, True) if h[:, :, -1].any() else (False,):
        lg, lh = (left_g + g[:, :, -1:], left_h + h[:, :, -1:]) if missing_left else (left_g, left_h)
        rg, rh = total_g[:, None, None] - lg, total_h[:, None, None] - lh
        gain = _score(lg, lh, growth) + _score(rg, rh, growth) - _score(total_g, total_h, growth)[:, None, None]
        ok = (lh >= growth.min_leaf) & (rh >= growth.min_leaf) & allowed[:, :, None]
        flat = np.where(ok, gain, -np.inf).reshape(len(gain), -1)
        at = (flat >= (flat.max(1) - rounding)[:, None]).argmax(1)
        top = flat[np.arange(len(at)), at]
        better = top > best["gain"] + rounding
        feature, cut_ = np.divmod(at, gain.shape[2])
        new = {"gain": top, "feature": feature, "bin": cut_, "missing_left": np.full(len(at), missing_left)}
        pick = (np.arange(len(at)), feature, cut_)
        new |= {"lg": lg[pick], "lh": lh[pick]}
        best = {k: np.where(better, v, best.get(k, v)) for k, v in new.items()}
    worth = (best["gain"] > 1e-9 * np.maximum(_score(total_g, total_h, growth), 1e-12)) & (total_h >= growth.min_split)
    best["feature"] = np.where(worth, best["feature"], -1)
    at = (np.arange(len(total_g)), best["feature"]) if growth.random else (best["feature"], best["bin"])
    best["threshold"] = np.where(worth, points[at], 0.0)
    return best | {"g": total_g, "h": total_h}


def _node_columns(nodes: Open, best: dict[str, np.ndarray], growth: Growth, closed: bool = False) -> dict[str, np.ndarray]:
    """Columns of NODES."""
    feature = np.full(len(nodes.tree), -1) if closed else best["feature"]
    split = feature >= 0
    columns = (nodes.tree, nodes.node, feature, np.where(split, best["threshold"], 0.0), best["missing_left"] & split,
               leaf(best["g"], best["h"], growth), np.where(split, best["gain"], 0.0), best["h"])
    return {name: np.asarray(c, kind) for name, c, kind in zip(NAMES, columns, DTYPES, strict=True)}


def _node_rows(nodes: Open, best: dict[str, np.ndarray], growth: Growth, closed: bool = False) -> list[tuple]:
    """Rows of NODES."""
    return _tuples(_node_columns(nodes, best, growth, closed))


def _tuples(columns: dict[str, np.ndarray]) -> list[tuple]:
    return list(zip(*(columns[name].tolist() for name in NAMES), strict=True))


def _joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}


def _children(nodes: Open, best: dict[str, np.ndarray]) -> tuple[Open, np.ndarray, np.ndarray]:
    """Open children in pairs (left, right), with their sums of g and h."""
    split = best["feature"] >= 0
    node = np.stack([2 * nodes.node[split], 2 * nodes.node[split] + 1], 1).ravel()
    pair = lambda whole, left: np.stack([left[split], (whole - left)[split]], 1).ravel()
    return Open(np.repeat(nodes.tree[split], 2), node), pair(best["g"], best["lg"]), pair(best["h"], best["lh"])


def _none_worth(n: int, g: np.ndarray, h: np.ndarray) -> dict[str, np.ndarray]:
    """What ``choose`` gives for nodes that are not split."""
    zeros = {name: np.zeros(n) for name in ("threshold", "gain", "lg", "lh")}
    return zeros | {"g": g, "h": h, "feature": np.full(n, -1), "bin": np.zeros(n, np.int64), "missing_left": np.zeros(n, bool)}


def _able(g: np.ndarray, h: np.ndarray, row: np.ndarray, place: np.ndarray, nodes: Open, growth: Growth) -> tuple:
    """What is known of all nodes, the places of those that may be split, and (row, place among them) of their rows."""
    n = len(nodes.tree)
    best = _none_worth(n, np.bincount(place, g[row], n), np.bincount(place, h[row], n))
    may = (best["h"] >= max(growth.min_split, 2 * growth.min_leaf)) & (nodes.node < 1 << growth.max_depth)
    inside = may[place]
    return best, np.flatnonzero(may), row[inside], (np.cumsum(may) - 1)[place[inside]]


def finish(x, g, h, place: np.ndarray, nodes: Open, growth: Growth) -> dict[str, np.ndarray]:
    """All nodes below ``nodes``, and they themselves, from the rows that they hold."""
    out, row = [], np.arange(len(x))
    while len(nodes.tree):
        best, able, row, place = _able(g, h, row, place, nodes, growth)
        if n := len(able):
            some = Open(nodes.tree[able], nodes.node[able])
            points = drawn(*ranges(x, row, place, n), some, growth.seed)
            made = choose(sums(x, row, place, n, g, h, points, True), points, some, growth)
            for name in best:
                best[name][able] = made[name]
            out.append(_node_columns(nodes, best, growth))
            feature = made["feature"][place]
            keep = feature >= 0
            row, place, feature = row[keep], place[keep], feature[keep]
            value, threshold = x[row, feature], made["threshold"][place]
            left = np.where(np.isnan(value), made["missing_left"][place], value <= threshold)
            place = (2 * (np.cumsum(made["feature"] >= 0) - 1))[place] + ~left
        else:
            out.append(_node_columns(nodes, best, growth))
        nodes = _children(nodes, best)[0]
    return _joined(out)


def finish_binned(code, g, h, place: np.ndarray, nodes: Open, edges: np.ndarray, growth: Growth) -> dict[str, np.ndarray]:
    """What ``finish`` gives, and the bin that each node is split at, from bins ``code`` [features, rows]. Sums are made
    for a bounded number of nodes at a time, and not for nodes that cannot be split."""
    out, row, (width, bins) = [], np.arange(code.shape[1]), (len(code), edges.shape[1] + 2)
    step = max(1, FINISH_CELLS // (width * bins))
    ones = bool((h == 1).all())
    while len(nodes.tree):
        best, able, row, place = _able(g, h, row, place, nodes, growth)
        order = np.argsort(place, kind="stable")
        row, place = row[order], place[order]
        starts = np.searchsorted(place, np.arange(0, len(able) + step, step))
        for k, a in enumerate(range(0, len(able), step)):
            some, here = able[a : a + step], slice(starts[k], starts[k + 1])
            r = row[here]
            found = tallied(code, r, place[here] - a, len(some), g[r], None if ones else h[r], bins)
            made = choose(found, edges, Open(nodes.tree[some], nodes.node[some]), growth)
            for name in best:
                best[name][some] = made[name]
        out.append(_node_columns(nodes, best, growth) | {"bin": best["bin"]})
        place = able[place]
        keep = best["feature"][place] >= 0
        row, place = row[keep], place[keep]
        bin_ = code[best["feature"][place], row]
        left = np.where(bin_ == bins - 1, best["missing_left"][place], bin_ <= best["bin"][place])
        place = (2 * (np.cumsum(best["feature"] >= 0) - 1))[place] + ~left
        nodes = _children(nodes, best)[0]
    return _joined(out)


def tallied(code: np.ndarray, row: np.ndarray, place: np.ndarray, n: int, g, h, bins: int) -> np.ndarray:
    """[2, n, features, bins] sums of g and h of (row, place) pairs; h of None counts them."""
    out, first = np.empty((2, n, len(code), bins)), place * bins
    for f, own in enumerate(code):
        cell = first + own[row]
        out[0, :, f] = np.bincount(cell, g, n * bins).reshape(n, bins)
        out[1, :, f] = np.bincount(cell, h, n * bins).reshape(n, bins)
    return out


# ------------------------------------------------------------------ the model
def descended(flat: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The sum of the leaf values that each row reaches, over all trees."""
    out = np.zeros(len(x))
    if not flat:
        return out
    step = max(1, (2 << 20) // len(flat["roots"]))
    for a in range(0, len(x), step):
        part = x[a : a + step]
        out[a : a + step] = flat["value"][landed(flat, part)].sum(0)
    return out


def landed(flat: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """[trees, rows]: the place of the last node that each row reaches."""
    at, row = np.repeat(flat["roots"][:, None], len(x), 1), np.arange(len(x))[None, :]
    while True:
        feature = flat["feature"][at]
        if (feature < 0).all():
            return at
        value = x[row, np.maximum(feature, 0)]
        left = np.where(np.isnan(value), flat["missing_left"][at], value <= flat["threshold"][at])
        at = np.where(feature < 0, at, flat["left"][at] + ~left)


def _bytes(values: np.ndarray) -> bytes:
    """Bytes of numbers, all first ones before all second ones: like ones stand together and compress."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _numbers(data: bytes, kind, n: int, at: int) -> np.ndarray:
    """What ``_bytes`` was given."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T).view(kind).reshape(n)


def _pressed(arrays: list[np.ndarray]) -> bytes:
    return zlib.compress(b"".join(map(_bytes, arrays)), 1)


def _opened(body: bytes, kinds: list, sizes: list[int]) -> list[np.ndarray]:
    data, at, out = zlib.decompress(body), 0, []
    for kind, n in zip(kinds, sizes, strict=True):
        out.append(_numbers(data, kind, n, at))
        at += out[-1].nbytes
    return out


def pack(columns: dict[str, np.ndarray]) -> bytes:
    """The columns of NODES of one tree, by node, but for its number."""
    order = np.argsort(columns["node"])
    return _pressed([np.asarray(columns[c], d)[order] for c, d in zip(NAMES[1:], DTYPES[1:], strict=True)])


def unpacked(tree: int, n: int, body: bytes) -> dict[str, np.ndarray]:
    """What ``pack`` has packed."""
    columns = _opened(body, DTYPES[1:], [n] * (len(NAMES) - 1))
    return {"tree": np.full(n, tree, DTYPES[0])} | dict(zip(NAMES[1:], columns, strict=True))


def lookup(columns: dict[str, np.ndarray]) -> tuple[int, int, int, bytes]:
    """What ``descended`` needs of whole trees, pressed: it is copied to the disk of every executor."""
    split = columns["feature"] >= 0
    roots = np.flatnonzero(columns["node"] == 1)
    body = _pressed([columns["feature"], roots, columns["threshold"][split], columns["missing_left"][split], columns["value"][~split]])
    return len(split), len(roots), int(split.sum()), body


def looked_up(n: int, trees: int, splits: int, body: bytes) -> dict[str, np.ndarray]:
    """The columns that ``descended`` reads. Children stand in the order of their parents."""
    feature, roots, threshold, missing_left, value = _opened(body, [np.int32, np.int64, float, bool, float], [n, trees, splits, splits, n - splits])
    split = feature >= 0
    out = {"feature": feature, "roots": roots, "threshold": np.zeros(n), "missing_left": np.zeros(n, bool), "value": np.zeros(n), "left": np.zeros(n, np.int32)}
    out["threshold"][split], out["missing_left"][split], out["value"][~split] = threshold, missing_left, value
    rank = np.cumsum(split) - split
    tree = np.repeat(np.arange(trees), np.diff(np.append(roots, n)))
    out["left"][split] = (roots[tree] + 1 + 2 * (rank - rank[roots[tree]]))[split]
    return out


def _packed_batch(trees: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*trees, strict=True))
    kinds = (pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["tree", "n", "body"])


def packed(nodes: DataFrame) -> DataFrame:
    """PACKED from NODES: one row for each tree, written."""

    def run(batches):
        held: list[dict[str, np.ndarray]] = []
        for batch in batches:
            columns = {name: c.to_numpy(zero_copy_only=False) for name, c in zip(NAMES, batch.columns, strict=True)}
            ends = [0, *(np.flatnonzero(np.diff(columns["tree"])) + 1).tolist(), batch.num_rows]
            for a, b in zip(ends, ends[1:], strict=False):
                if b > a:
                    if held and held[-1]["tree"][0] != columns["tree"][a]:
                        yield _packed_batch([_tree(held)])
                        held = []
                    held.append({name: c[a:b] for name, c in columns.items()})
        if held:
            yield _packed_batch([_tree(held)])

    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = nodes.select(*NAMES).repartition(parts, "tree").sortWithinPartitions("tree", "node")
    return cut(dealt.mapInArrow(run, PACKED), "trees")


def _tree(parts: list[dict[str, np.ndarray]]) -> tuple[int, int, bytes]:
    columns = _joined(parts)
    return int(columns["tree"][0]), len(columns["tree"]), pack(columns)


def _linked(columns: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Columns ordered by (tree, node), with the places of left children (right ones follow them) and of roots."""
    key = columns["tree"].astype(np.int64) << 40 | columns["node"]
    child = (columns["tree"].astype(np.int64) << 40) | (2 * columns["node"])
    left = np.where(columns["feature"] >= 0, np.searchsorted(key, child), 0)
    return columns | {"left": left.astype(np.int32), "roots": np.flatnonzero(columns["node"] == 1)}


class TreeEnsemble:
    """Trees as one table of NODES; the prediction is base + scale * the sum of the leaf values.

    ``nodes`` are given as rows, or ``trees`` as a written table of PACKED, which is never held as a whole.
    """

    def __init__(self, nodes: list[tuple] | None, base: float, scale: float, width: int, features_col: str = "features", trees: DataFrame | None = None):
        self._nodes, self.trees = nodes, trees
        self.base, self.scale, self.width, self.features_col = base, scale, width, features_col
        self._flat: dict | None = None

    @property
    def nodes(self) -> list[tuple]:
        """All rows of NODES."""
        if self.trees is None:
            return self._nodes
        return [row for group in self.groups() for row in _tuples(group)]

    def groups(self) -> Iterator[dict[str, np.ndarray]]:
        """Columns of NODES, ordered by (tree, node), of a bounded number of trees at a time."""
        if self.trees is None:
            if self._nodes:
                yield {name: np.array(c, d) for name, c, d in zip(NAMES, zip(*sorted(self._nodes), strict=True), DTYPES, strict=True)}
            return
        held: list[dict[str, np.ndarray]] = []
        for r in self.trees.toLocalIterator():
            if held and sum(len(t["tree"]) for t in held) + r.n > GROUP:
                yield _joined(sorted(held, key=lambda t: t["tree"][0]))
                held = []
            held.append(unpacked(r.tree, r.n, r.body))
        if held:
            yield _joined(sorted(held, key=lambda t: t["tree"][0]))

    def flat(self) -> dict[str, np.ndarray]:
        """All columns ordered by (tree, node), with the places of children and roots."""
        if self._flat is None:
            groups = list(self.groups())
            if len(groups) > 1:
                whole = _joined(groups)
                order = np.lexsort((whole["node"], whole["tree"]))
                groups = [{name: c[order] for name, c in whole.items()}]
            self._flat = _linked(groups[0]) if groups else {}
        return self._flat

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.base + self.scale * descended(self.flat(), x)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction``."""
        base, scale = self.base, self.scale
        shared = [df.sparkSession.sparkContext.broadcast(lookup(group)) for group in self.groups()]

        @F.pandas_udf("double")
        def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            kept = looked_up(*shared[0].value) if len(shared) == 1 else None
            for vectors in batches:
                x = np.stack(vectors.to_numpy()) if len(vectors) else np.zeros((0, 0))
                total = np.zeros(len(x))
                for group in shared if len(x) else ():  # one at a time
                    total += descended(kept or looked_up(*group.value), x)
                yield pd.Series(base + scale * total)

        return df.withColumn("prediction", predicted(vector_to_array(self.features_col)))

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802  (the name that Spark's models use)
        """Shares of the gains of all splits, each tree counting alike."""
        shares: dict[int, np.ndarray] = {}
        for t in self.groups():
            ends = np.append(np.flatnonzero(np.diff(t["tree"], prepend=-1)), len(t["tree"]))
            for a, b in zip(ends, ends[1:], strict=False):
                here = np.arange(a, b)[t["feature"][a:b] >= 0]
                gains = np.bincount(t["feature"][here], t["gain"][here], self.width)
                shares[int(t["tree"][a])] = gains / gains.sum() if gains.sum() > 0 else 0 * gains
        out = sum((shares[t] for t in sorted(shares)), np.zeros(self.width))
        return Vectors.dense(out / out.sum() if out.sum() > 0 else out)

    def frame(self, spark: SparkSession) -> DataFrame:
        if self.trees is None:
            return spark.createDataFrame(self._nodes, NODES)

        def run(batches):
            for batch in batches:
                for tree, n, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    columns = unpacked(tree, n, body)
                    yield pa.RecordBatch.from_arrays([pa.array(columns[c], k) for c, k in zip(NAMES, KINDS, strict=True)], NAMES)

        return self.trees.mapInArrow(run, NODES)

    def save(self, spark: SparkSession, path: str) -> None:
        self.frame(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        about = spark.createDataFrame([(self.base, self.scale, self.width, self.features_col)], "base double, scale double, width int, features_col string")
        about.write.mode("overwrite").parquet(f"{path}/ensemble")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreeEnsemble:
        about = spark.read.parquet(f"{path}/ensemble").first()
        return cls(None, *about, trees=packed(spark.read.parquet(f"{path}/nodes")))


# ------------------------------------------------------------------ growing on Spark
ROWS = "x array<double>, label double, margin double, row long"


def rows_of(df: DataFrame, label: str, features: str = "features", key: str | None = None) -> DataFrame:
    """ROWS with a label, written once; ``row`` tells rows apart where trees see a share of them, by the
    ``key`` too if the rows have it."""
    x, keys = vector_to_array(features).alias("x"), [key] if key in df.columns else []
    rows = df.where(F.col(label).isNotNull()).select(x, F.col(label).cast("double").alias("label"), *keys)
    row = F.xxhash64("x", "label", *keys).alias("row")
    return cut(rows.select("x", "label", F.lit(0.0).alias("margin"), row), "tree-rows")


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    label = batch.column("label").to_numpy()
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float)
    return x.reshape(len(label), -1), label, batch.column("margin").to_numpy(), batch.column("row").to_numpy()


def _pairs(flat: dict, opened: dict[int, int], x: np.ndarray, row: np.ndarray, growth: Growth) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """(row, place, times) of the rows that lie in open nodes, which ``opened`` gives by tree << 40 | node.
    Times is how often a row was drawn, if rows are drawn with replacement."""
    keys = np.array(sorted(opened), np.int64)
    places = np.array([opened[k] for k in keys.tolist()], np.int64)
    at = landed(flat, x)
    key = flat["tree"][at].astype(np.int64) << 40 | flat["node"][at]
    found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    hit = keys[found] == key
    drawn_ = times = None
    if growth.rows < 1 or growth.bootstrap:
        drawn_ = mixed(growth.seed + 2, flat["tree"][flat["roots"]][:, None], row[None, :])
        hit &= drawn_ < growth.rows if not growth.bootstrap else drawn_ >= DRAWS[0]
    tree, r = np.nonzero(hit)
    if growth.bootstrap:
        times = np.searchsorted(DRAWS, drawn_[tree, r], side="right").astype(float)
    return r, places[found[tree, r]], times


def _gradient(growth: Growth, model: dict, scale: float, base: float):
    """g and h of rows: -label (of a forest less the base) and 1, or what is left after the boosted trees
    since the last margin."""
    if growth.random or growth.bootstrap:
        return lambda x, label, margin: (base - label, np.ones(len(label)))
    return lambda x, label, margin: (base + margin + scale * descended(model, x) - label, np.ones(len(label)))


def _summed(rows: DataFrame, n: int, shape: tuple, add, fold, emit: str, result) -> list:
    """What ``result(first, whole)`` yields for the sums over all tasks of [n, *shape] arrays, in blocks of
    nodes. ``add(batch)`` gives the array of a batch, ``fold`` merges two."""
    parts = min(-(-n // BLOCK), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def local(batches):
        whole = None
        for batch in batches:
            if batch.num_rows:
                made = add(batch)
                whole = made if whole is None else fold(whole, made)
        if whole is not None:
            for a in range(0, n, BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([a]), pa.array([whole[:, a : a + BLOCK].tobytes()])], ["first", "body"])

    def merged(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for first, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one = np.frombuffer(body).reshape(2, -1, *shape)
                held[first] = fold(held[first], one) if first in held else one
        for first, whole in held.items():
            yield from result(first, whole)

    return rows.mapInArrow(local, "first long, body binary").repartition(parts, "first").mapInArrow(merged, emit).collect()


BEST = "place long, feature int, bin int, missing_left boolean, gain double, threshold double, g double, h double, lg double, lh double"


def _level(rows: DataFrame, nodes: Open, flat: dict, gradient, edges: np.ndarray | None, growth: Growth, width: int) -> dict[str, np.ndarray]:
    """The best split of each open node, in passes of a bounded number of sums."""
    bins = 3 if growth.random else edges.shape[1] + 2
    step = max(BLOCK, CELLS // (width * bins) // BLOCK * BLOCK)
    out = []
    for a in range(0, len(nodes.tree), step):
        some = nodes.part(a, a + step)
        n = len(some.tree)
        opened = dict(zip((some.tree.astype(np.int64) << 40 | some.node).tolist(), range(n), strict=True))

        def located(batch, opened=opened):
            x, label, margin, row = _read(batch)
            return x, label, margin, *_pairs(flat, opened, x, row, growth)

        points = edges
        if growth.random:
            def least(batch, n=n, located=located):
                x, _, _, r, place, _ = located(batch)
                low, high = ranges(x, r, place, n)
                return np.stack([low, -high])

            def bound(first, whole):
                places = np.arange(first, first + whole.shape[1])
                arrays = [pa.array(places), *(pa.array([v.tobytes() for v in part]) for part in (whole[0], -whole[1]))]
                yield pa.RecordBatch.from_arrays(arrays, ["place", "low", "high"])

            found = _summed(rows, n, (width,), least, np.minimum, "place long, low binary, high binary", bound)
            low, high = np.full((n, width), np.inf), np.full((n, width), -np.inf)
            for r in found:
                low[r.place], high[r.place] = np.frombuffer(r.low), np.frombuffer(r.high)
            points = drawn(low, high, some, growth.seed)
        shared = rows.sparkSession.sparkContext.broadcast(points)

        def added(batch, n=n, located=located, shared=shared):
            x, label, margin, r, place, times = located(batch)
            return sums(x, r, place, n, *gradient(x, label, margin), shared.value, growth.random, times)

        def chosen(first, whole, some=some, shared=shared):
            stop = first + whole.shape[1]
            own = shared.value[first:stop] if growth.random else shared.value
            best = choose(whole, own, some.part(first, stop), growth)
            arrays = [pa.array(np.arange(first, stop)), pa.array(best["feature"].astype(np.int32)), pa.array(best["bin"].astype(np.int32)),
                      *(pa.array(best[k]) for k in ("missing_left", "gain", "threshold", "g", "h", "lg", "lh"))]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in BEST.split(", ")])

        found = _summed(rows, n, (width, bins), added, np.add, BEST, chosen)
        out += [(r.place + a, r) for r in found]
    names = [c.split()[0] for c in BEST.split(", ")[1:]]
    out.sort(key=lambda pair: pair[0])
    return {name: np.array([r[name] for _, r in out]) for name in names}


def _table(rows: DataFrame, edges: np.ndarray | None, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values [rows, features], or their bins [features, rows], and label and hash of all rows, ordered by hash."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, label, _, row = _read(batch)
                x = x if edges is None else coded(x, edges)
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x, label, row)], ["x", "label", "row"])

    kind = np.float64 if edges is None else np.uint8 if edges.shape[1] < 255 else np.int64
    found = rows.mapInArrow(run, "x binary, label binary, row binary").collect()
    x, label, row = (np.frombuffer(b"".join(r[i] for r in found), k) for i, k in enumerate((kind, np.float64, np.int64)))
    del found
    order = np.lexsort((label, row))
    x = x.reshape(len(row), width)[order]
    return x if edges is None else np.ascontiguousarray(x.T), label[order], row[order]


def _sampled(growth: Growth, tree: int, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows a tree sees, and how often."""
    if growth.rows >= 1 and not growth.bootstrap:
        return np.arange(len(row)), np.ones(len(row))
    drawn_ = mixed(growth.seed + 2, tree, row)
    times = np.searchsorted(DRAWS, drawn_, side="right") if growth.bootstrap else drawn_ < growth.rows
    taken = np.flatnonzero(times)
    return taken, times[taken].astype(float)


def _grown_whole(rows: DataFrame, nodes: Open, edges: np.ndarray | None, growth: Growth, width: int, base: float) -> DataFrame:
    """PACKED of the trees whose roots are given, each grown by one task from all rows."""
    x, label, row = _table(rows, edges, width)
    shared = rows.sparkSession.sparkContext.broadcast((x, base - label, row, edges))

    def run(batches):
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                x, g, row, edges = shared.value
                taken, times = _sampled(growth, tree, row)
                root, place = Open(np.array([tree]), np.array([1])), np.zeros(len(taken), np.int64)
                whole = len(taken) == len(row)
                if edges is None:
                    made = finish(x if whole else x[taken], g[taken] * times, times, place, root, growth)
                else:
                    made = finish_binned(x if whole else x[:, taken], g[taken] * times, times, place, root, edges, growth)
                yield _packed_batch([(tree, len(made["node"]), pack(made))])

    spark = rows.sparkSession
    tasks = min(len(nodes.tree), 4 * spark.sparkContext.defaultParallelism)
    first = int(nodes.tree[0])
    return spark.range(first, first + len(nodes.tree), 1, tasks).mapInArrow(run, PACKED)


def boosted(code: np.ndarray, label: np.ndarray, row: np.ndarray, edges: np.ndarray, growth: Growth, rate: float, base: float) -> Iterator[dict[str, np.ndarray]]:
    """The columns of NODES of each boosted tree, from the bins of all rows."""
    margin, last = np.full(len(label), base), edges.shape[1] + 1
    for tree in range(growth.first, growth.first + growth.trees):
        taken, times = _sampled(growth, tree, row)
        some = code if len(taken) == len(row) else code[:, taken]
        root, place = Open(np.array([tree]), np.array([1])), np.zeros(len(taken), np.int64)
        made = finish_binned(some, (margin - label)[taken], times, place, root, edges, growth)
        linked = _linked(made)  # levels follow one another, so nodes are in order
        at, left_rows = np.zeros(len(label), np.int64), np.arange(len(label))
        while len(left_rows):
            left_rows = left_rows[made["feature"][at[left_rows]] >= 0]
            here = at[left_rows]
            bin_ = code[made["feature"][here], left_rows]
            left = np.where(bin_ == last, made["missing_left"][here], bin_ <= made["bin"][here])
            at[left_rows] = linked["left"][here] + ~left
        margin += rate * made["value"][at]
        yield made


def _boosted_whole(rows: DataFrame, edges: np.ndarray, growth: Growth, width: int, rate: float, base: float) -> DataFrame:
    """PACKED of boosted trees, grown by one task from all rows: each tree needs all that came before it."""
    shared = rows.sparkSession.sparkContext.broadcast((*_table(rows, edges, width), edges))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                for made in boosted(*shared.value, growth, rate, base):
                    yield _packed_batch([(int(made["tree"][0]), len(made["node"]), pack(made))])

    return rows.sparkSession.range(0, 1, 1, 1).mapInArrow(run, PACKED)


def fits_whole(n_rows: float, width: int, growth: Growth) -> bool:
    """Whether the table is small enough to be handed to each task; less than the usual ``gather`` asks for none of it."""
    return growth.gather >= GATHER and n_rows * width * (8 if growth.random else 1) <= WHOLE


def _finished(rows: DataFrame, nodes: Open, flat: dict, gradient, edges: np.ndarray | None, growth: Growth, whole: tuple[int, float] | None = None) -> DataFrame:
    """All nodes below ``nodes``, each of which holds a bounded number of rows that are dealt to one task, or, if the
    table is handed to all tasks, the trees of these roots (``whole``: its width and the base)."""
    if whole is not None:
        return _grown_whole(rows, nodes, edges, growth, *whole)
    opened = dict(zip((nodes.tree.astype(np.int64) << 40 | nodes.node).tolist(), range(len(nodes.tree)), strict=True))
    shared = rows.sparkSession.sparkContext.broadcast((nodes.tree, nodes.node, edges))

    def dealt(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, label, margin, row = _read(batch)
            r, place, times = _pairs(flat, opened, x, row, growth)
            g, h = gradient(x, label, margin)
            code = None if growth.random else coded(x, shared.value[2])
            for a in range(0, len(r), PAIRS):
                some = r[a : a + PAIRS]
                if growth.random:
                    ends = np.arange(len(some) + 1, dtype=np.int32) * x.shape[1]
                    values = pa.ListArray.from_arrays(ends, pa.array(x[some].ravel()))
                else:
                    ends = np.arange(len(some) + 1, dtype=np.int32) * (code.shape[1] * code.itemsize)
                    values = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(ends), pa.py_buffer(code[some].tobytes())])
                many = 1.0 if times is None else times[a : a + PAIRS]
                arrays = [pa.array(place[a : a + PAIRS]), values, pa.array(g[some] * many), pa.array(h[some] * many)]
                yield pa.RecordBatch.from_arrays(arrays, ["place", "x", "g", "h"])

    def grown(batches):
        tree, node, edges = shared.value

        def run(held):
            place, g, h = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("place", "g", "h"))
            here, own = np.unique(place, return_inverse=True)
            opened = Open(tree[here], node[here])
            if growth.random:
                x = np.concatenate([b.column("x").flatten().to_numpy(zero_copy_only=False) for b in held]).reshape(len(place), -1)
                made = finish(x, g, h, own, opened, growth)
            else:
                kind = np.uint8 if edges.shape[1] < 255 else np.int64
                code = np.frombuffer(b"".join(v for b in held for v in b.column("x").to_pylist()), kind).reshape(len(place), -1)
                made = finish_binned(np.ascontiguousarray(code.T), g, h, own, opened, edges, growth)
            arrays = [pa.array(made[c], kind) for c, kind in zip(NAMES, KINDS, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, NAMES)

        held, size = [], 0
        for batch in batches:
            place, start = batch.column("place").to_numpy(), 0
            for edge in (np.flatnonzero(np.diff(place)) + 1).tolist():
                if size + edge - start >= PAIRS:  # whole nodes only
                    yield run([*held, batch.slice(start, edge - start)])
                    held, size, start = [], 0, edge
            if batch.num_rows > start:
                if held and size >= PAIRS and held[-1].column("place")[-1] != batch.column("place")[start]:
                    yield run(held)
                    held, size = [], 0
                held.append(batch.slice(start))
                size += batch.num_rows - start
        if held:
            yield run(held)

    parts = min(len(nodes.tree), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    kind = "array<double>" if growth.random else "binary"
    spread = rows.mapInArrow(dealt, f"place long, x {kind}, g double, h double")
    spread = spread.repartition(parts, "place").sortWithinPartitions("place")
    return spread.mapInArrow(grown, NODES)


def grow(rows: DataFrame, growth: Growth, edges: np.ndarray | None, width: int, n_rows: float, base: float = 0.0, before: list[tuple] = (), scale: float = 1.0, whole: bool = False) -> tuple[list[tuple], DataFrame | None]:
    """NODES of new trees: those of many rows, and a table of those below nodes of few rows, if there are any.
    ``before``: boosted trees that the margin of the rows does not hold yet. ``whole``: the rows are handed to all tasks,
    and the table is PACKED."""
    gradient = _gradient(growth, TreeEnsemble(list(before), base, scale, width).flat(), scale, base)
    trees = np.arange(growth.first, growth.first + growth.trees)
    nodes, held = Open(trees, np.ones(len(trees), np.int64)), np.full(len(trees), n_rows * growth.rows)
    done: list[tuple] = []
    few = Open(trees[:0], nodes.node[:0])  # nodes of few rows, all finished in one job at the end

    def led(*some: Open) -> dict[str, np.ndarray]:
        """What has been grown so far, with open nodes as leaves: rows are led to them."""
        stubs = [(t, n, -1, 0.0, False, 0.0, 0.0, 0.0) for o in some for t, n in zip(o.tree.tolist(), o.node.tolist(), strict=True)]
        return TreeEnsemble(done + stubs, 0.0, 1.0, width).flat()

    while len(nodes.tree):
        small = (held <= growth.gather) | whole
        few = Open(np.append(few.tree, nodes.tree[small]), np.append(few.node, nodes.node[small]))
        nodes, held = Open(nodes.tree[~small], nodes.node[~small]), held[~small]
        if not len(nodes.tree):
            break
        flat = led(nodes, few)
        best = _level(rows, nodes, flat, gradient, edges, growth, width)
        best["feature"] = np.where(nodes.node >= 1 << growth.max_depth, -1, best["feature"])
        done += _node_rows(nodes, best, growth)
        nodes, g, held = _children(nodes, best)
        last = nodes.node >= 1 << growth.max_depth
        if last.any():  # what they are follows from the sums of their parents
            none = {"missing_left": np.zeros(last.sum(), bool), "g": g[last], "h": held[last]}
            none |= {name: np.zeros(last.sum()) for name in ("threshold", "gain")}
            done += _node_rows(Open(nodes.tree[last], nodes.node[last]), none, growth, closed=True)
            nodes, held = Open(nodes.tree[~last], nodes.node[~last]), held[~last]
    if len(few.tree):
        return done, _finished(rows, few, led(few), gradient, edges, growth, (width, base) if whole else None)
    return done, None


def grow_forest(rows: DataFrame, growth: Growth, edges: np.ndarray | None, width: int, n_rows: float, base: float = 0.0) -> DataFrame:
    """PACKED of all trees of a forest, written."""
    whole = fits_whole(n_rows, width, growth)
    done, rest = grow(rows, growth, edges, width, n_rows, base, whole=whole)
    if whole:
        return cut(rest, "trees")
    upper = rows.sparkSession.createDataFrame(done, NODES)
    return packed(upper if rest is None else upper.unionAll(rest))


def bin_edges(rows: DataFrame, width: int, bins: int = BINS) -> np.ndarray:
    """[width, bins] split points of each feature: its least value and quantiles, padded by infinity."""
    shares = [k / bins for k in range(1, bins)]
    value = lambda i: F.when(~F.isnan(F.col("x")[i]), F.col("x")[i])
    found = rows.agg(
        *[F.percentile_approx(value(i), shares, F.lit(100 * bins)) for i in range(width)],
        *[F.min(value(i)) for i in range(width)],  # so that a rare lowest value can be split off
    ).first()
    out = np.full((width, bins), np.inf)
    for i in range(width):
        own = np.unique([*(found[i] or []), *([] if found[width + i] is None else [found[width + i]])])
        out[i, : len(own)] = own
    return out


def split_points(values: np.ndarray, counts: np.ndarray, bins: int) -> list[float]:
    """Points between neighbouring values that deal them out to ``bins`` bins as Spark ML does: all of them
    if there are few, else one at each even share of the rows, or, behind a frequent value, as early as may be."""
    if len(values) <= bins:
        return ((values[:-1] + values[1:]) / 2).tolist()
    stride, out = counts.sum() / bins, []
    target, before = stride, 0
    for at, now in enumerate(counts.cumsum().tolist()):
        if at and abs(before - target) < abs(now - target):
            out.append(float((values[at - 1] + values[at]) / 2))
            target += stride
        before = now
    return out


def forest_edges(rows: DataFrame, width: int, n_rows: int, bins: int = FOREST_BINS, seed: int = 42) -> np.ndarray:
    """[width, bins - 1] split points of each feature, padded by infinity. They follow from a bounded number of
    rows, drawn by their hash; trees are grown from all rows."""
    share = min(1.0, SPLIT_ROWS / max(n_rows, 1))
    parts = min(width, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def turned(batches):
        for batch in batches:
            if batch.num_rows:
                x, _, _, row = _read(batch)
                x = x[mixed(seed + 4, row) < share]
                bodies = [x[:, f].tobytes() for f in range(width)]
                yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(bodies, pa.binary())], ["feature", "body"])

    def found(batches):
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for f, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(f, []).append(body)
        for f, bodies in held.items():
            x = np.frombuffer(b"".join(bodies))
            points = np.array(split_points(*np.unique(x[~np.isnan(x)], return_counts=True), bins))
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([points.tobytes()], pa.binary())], ["feature", "body"])

    kind, out = "feature int, body binary", np.full((width, bins - 1), np.inf)
    for r in rows.mapInArrow(turned, kind).repartition(parts, "feature").mapInArrow(found, kind).collect():
        points = np.frombuffer(r.body)
        out[r.feature, : len(points)] = points
    return out


@dataclass(frozen=True)
class ExtraTrees:
    """Extremely randomised trees: each split point is drawn at random, the best of them is taken."""

    growth: Growth
    label: str = "label"

    def fit(self, df: DataFrame) -> TreeEnsemble:
        rows = rows_of(df, self.label)
        first = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).first()
        if not first.n:
            raise ValueError("no rows to learn from")
        made = grow_forest(rows, self.growth, None, first.width, first.n)
        return TreeEnsemble(None, 0.0, 1 / self.growth.trees, first.width, trees=made)


@dataclass
class RandomForest:
    """Bagged trees: every tree sees rows drawn with replacement, and each node the best quantile split of
    the features that it may use."""

    growth: Growth
    label: str = "label"
    features_col: str = "features"
    key: str = "book_id"

    def setFeaturesCol(self, name: str) -> RandomForest:  # noqa: N802  (the name that Spark's estimators use)
        self.features_col = name
        return self

    def fit(self, df: DataFrame) -> TreeEnsemble:
        rows = rows_of(df, self.label, self.features_col, self.key)
        first = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width"), F.avg("label").alias("base")).first()
        if not first.n:
            raise ValueError("no rows to learn from")
        edges = forest_edges(rows, first.width, first.n, seed=self.growth.seed)
        made = grow_forest(rows, self.growth, edges, first.width, first.n, first.base)
        return TreeEnsemble(None, first.base, 1 / self.growth.trees, first.width, self.features_col, made)


@dataclass(frozen=True)
class SecondOrderBoosting:
    """Boosted trees of gradient and hessian sums with penalised leaves."""

    growth: Growth
    rate: float = 0.1
    label: str = "label"

    def fit(self, df: DataFrame) -> TreeEnsemble:
        rows = rows_of(df, self.label)
        first = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width"), F.avg("label").alias("base")).first()
        if not first.n:
            raise ValueError("no rows to learn from")
        edges = bin_edges(rows, first.width)
        if fits_whole(first.n, first.width, self.growth):
            made = cut(_boosted_whole(rows, edges, self.growth, first.width, self.rate, first.base), "trees")
            return TreeEnsemble(None, first.base, self.rate, first.width, trees=made)
        done: list[tuple] = []
        fresh: list[tuple] = []
        for tree in range(self.growth.trees):
            if len({n[0] for n in fresh}) == MARGIN_EVERY:
                rows, fresh = _with_margin(rows, fresh, self.rate, first.width), []
            one = replace(self.growth, trees=1, first=tree)
            made, rest = grow(rows, one, edges, first.width, first.n, first.base, fresh, self.rate)
            made += [tuple(r) for r in rest.collect()] if rest is not None else []
            fresh += made
            done += made
        return TreeEnsemble(done, first.base, self.rate, first.width)


def _with_margin(rows: DataFrame, fresh: list[tuple], scale: float, width: int) -> DataFrame:
    flat = TreeEnsemble(fresh, 0.0, scale, width).flat()

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, _, margin, _ = _read(batch)
                more = pa.array(margin + scale * descended(flat, x))
                yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("label"), more, batch.column("row")], batch.schema.names)

    return cut(rows.mapInArrow(run, ROWS), "tree-margins")
