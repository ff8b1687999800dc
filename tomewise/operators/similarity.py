"""Exact cosine top-k neighbours and rating aggregates over them.

The join never forms a cross join and never sends pairs through a shuffle:

1. Equal vectors are folded on both sides. A bank vector keeps its ``k + 1`` lowest ids
   (ties go to the lower id, so no other copy can be a neighbour); a query vector is
   looked up once and the answer is joined back to its copies.
2. Bank vectors are assigned to the nearest of a few pivots. A query's distance to the
   pivots bounds its k-th neighbour from above and each cell's vectors from below, so
   cells that cannot hold a neighbour are skipped. This is exact: no candidate is dropped.
3. Bank and queries are laid along one chain of neighbouring cells and cut into pieces of about
   equally many rows, whatever the cells hold: columns of the bank and blocks of queries. A task is
   one place of this grid. It has those cells of its column that its queries may need, walks them
   from the nearest on, keeps each query's top-k, and skips a cell for every query whose k-th
   neighbour so far is nearer than the cell can be. A query's vector goes to each column once, and
   a task gives back the numbers of k vectors a query. A window with a rank limit merges these, and
   the ids that share a vector are joined to the k that are left. How often a vector is sent depends
   on the rows of a piece, which ``block_rows`` does not make smaller than ``SIDE_ROWS``.

A bank that fits in one block (its distinct vectors are counted first) is broadcast instead,
and the queries stay where they are.

For unit vectors, cosine = 1 - distance^2 / 2, which carries the bounds over. Two extra
coordinates keep zero vectors at cosine 0 with everything.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import number_array
from ..sources.workspace import cut, spread
from .text_vectors import matrix_of

BLOCK_ROWS = 16_384
CHUNK_ROWS = 1024
GRID_ROWS = 2  # blocks of bank rows in a column of the grid
SIDE_ROWS = 4 * BLOCK_ROWS  # rows of a column, at least, and of a block of queries, at most
AT_ONCE = 512, 4096  # queries and bank rows whose similarities a task holds at a time
MAX_PIVOTS = 512
USUAL_SHARE = 0.5  # of sound vectors must be of the usual width
DIGITS = 9  # similarities are compared after rounding, so that ties break by id
STEP = 10**DIGITS
SLACK = 2 / STEP
BOUND_CELLS = 8


def knn(
    queries: DataFrame,
    bank: DataFrame,
    k: int = 20,
    keep_self: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(book_id, rn, neighbour_id, similarity, rating) with rn = 1..k by falling similarity.

    ``queries`` has (book_id, embedding), ``bank`` also average_rating. Unless ``keep_self``,
    a query is not its own neighbour; self is recognised by id. Vectors that cannot be compared
    (null, with a null or non-finite coordinate, or not of the bank's usual width) are no queries and
    no neighbours; ``unsound`` counts them.
    """
    return search(queries, build_index(bank, k, block_rows), k, keep_self)


def search(queries: DataFrame, index: NeighbourIndex, k: int = 20, keep_self: bool = False) -> DataFrame:
    """What ``knn`` gives, from an index that was built or loaded. Writes and shuffles queries and
    candidates only, nothing of the bank's size but the blocks that queries visit."""
    m = k if keep_self else k + 1
    if m > index.m:
        raise ValueError(f"the index keeps {index.m} copies of a vector; {m} are asked for")
    if not index.n_bank:
        return _empty(queries)
    queries = queries.where(_finite() & (F.size("embedding") == index.width))
    asked = cut(
        queries.groupBy("embedding").agg(F.min("book_id").alias("rep"), F.count("*").alias("n")),
        "asked",
    )
    sizes = asked.agg(F.count("*").alias("vectors"), F.sum("n").alias("rows")).first()
    if not sizes.vectors:
        return _empty(queries)

    local = _block_top(asked, index)
    # m vectors hold at least m ids, and each of theirs comes before those of a vector that is left out
    nearest = Window.partitionBy("rep").orderBy(F.desc("r"), "low_id", "vid")
    local = local.withColumn("at", F.row_number().over(nearest)).where(F.col("at") <= m)
    members = index.vectors.select("vid", "members")
    flat = local.select("rep", "r", "vid").join(members, "vid").select("rep", "r", F.inline("members"))
    copies = sizes.vectors < sizes.rows
    if not keep_self and not copies:
        flat = flat.where(F.col("neighbour_id") != F.col("rep"))
    order = Window.partitionBy("rep").orderBy(F.desc("r"), "neighbour_id")
    ranked = flat.withColumn("rn", F.row_number().over(order)).where(
        F.col("rn") <= (m if copies else k)
    )
    if copies:
        ranked = _spread(ranked, asked, queries, k, keep_self)
    return ranked.select(
        F.col("rep").alias("book_id"),
        "rn",
        "neighbour_id",
        (F.col("r") / F.lit(float(STEP))).alias("similarity"),
        "rating",
    )


def _finite() -> Column:
    """A vector with coordinates, all of them numbers below infinity."""
    numbers = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(numbers & (F.size("embedding") > 0), F.lit(False))


def usual_width(vectors: DataFrame, share: float = USUAL_SHARE) -> int | None:
    """The most frequent width of sound vectors (of equally frequent ones the larger), None without
    any. A table in which less than ``share`` of them have it mixes vectors of several sources, whose
    similarities would mean nothing: an error, not an empty answer."""
    widths = vectors.where(_finite()).groupBy(F.size("embedding").alias("width")).agg(F.count("*").alias("n"))
    found = widths.agg(F.max(F.struct("n", "width")).alias("most"), F.sum("n").alias("n")).first()
    if found.most is None:
        return None
    if found.most.n < share * found.n:
        raise ValueError(f"only {found.most.n} of {found.n} sound vectors have the most frequent width, {found.most.width}")
    return found.most.width


def unsound(vectors: DataFrame) -> DataFrame:
    """One row: vectors, and how many of them are null, hold no number somewhere or differ from the
    usual width."""
    sound = F.coalesce(_finite(), F.lit(False))
    width = F.lit(usual_width(vectors, 0.0))
    return vectors.agg(
        F.count("*").alias("n_vectors"),
        F.count_if(F.col("embedding").isNull()).alias("n_null"),
        F.count_if(F.col("embedding").isNotNull() & ~sound).alias("n_not_finite"),
        F.count_if(sound & (F.size("embedding") != width)).alias("n_other_width"),
    )


def _empty(queries: DataFrame) -> DataFrame:
    return queries.limit(0).select(
        "book_id",
        F.lit(0).alias("rn"),
        F.col("book_id").alias("neighbour_id"),
        F.lit(0.0).alias("similarity"),
        F.lit(0.0).alias("rating"),
    )


def _fold_bank(bank: DataFrame, m: int) -> DataFrame:
    """One row per distinct vector, with its m lowest ids. The rank limit is applied before
    the shuffle as well, so a vector with very many copies sends few rows per task."""
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("book_id"))
    lowest = bank.select("embedding", "book_id", "average_rating").withColumn("rn", rank)
    member = F.struct(
        F.col("book_id").alias("neighbour_id"), F.col("average_rating").alias("rating")
    )
    return (
        lowest.where(F.col("rn") <= m)
        .groupBy("embedding")
        .agg(F.min("book_id").alias("low_id"), F.collect_list(member).alias("members"))
        .withColumn("vid", F.monotonically_increasing_id())  # ids may repeat
    )


def _spread(
    ranked: DataFrame, asked: DataFrame, queries: DataFrame, k: int, keep_self: bool
) -> DataFrame:
    """Answers for one row per vector, brought to all rows with that vector."""
    entry = F.struct("rn", "r", "neighbour_id", "rating")
    answers = ranked.groupBy("rep").agg(F.sort_array(F.collect_list(entry)).alias("found"))
    answers = asked.join(answers, "rep").select("embedding", "found")
    # one answer row per vector: a vector with very many copies is split on the query side
    rows = queries.select("book_id", "embedding").join(answers, "embedding")
    found = F.col("found")
    if not keep_self:
        found = F.filter(found, lambda x: x.neighbour_id != F.col("book_id"))
    entries = rows.select("book_id", F.posexplode(F.slice(found, 1, k)).alias("at", "x"))
    return entries.select(
        F.col("book_id").alias("rep"),
        (F.col("at") + 1).alias("rn"),
        "x.r",
        "x.neighbour_id",
        "x.rating",
    )


# ------------------------------------------------------------------ blocked product
def _unit(x: np.ndarray, is_query: bool) -> np.ndarray:
    """Rows at length 1, with two more coordinates that only zero vectors use."""
    norm = np.linalg.norm(x, axis=1)
    zero = norm == 0
    out = np.zeros((len(x), x.shape[1] + 2))
    out[:, :-2] = x / np.where(zero, 1.0, norm)[:, None]
    out[zero, -1 if is_query else -2] = 1.0
    return out


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.clip(2.0 - 2.0 * (a @ b.T), 0.0, None))


@dataclass
class NeighbourIndex:
    """A bank of vectors laid out for search: folded, and where one block does not hold it dealt to
    cells around pivots, with the bounds that tell which cells a query need not visit."""

    vectors: DataFrame  # embedding, low_id, members, vid; with pivots also cell, distance
    m: int  # lowest ids kept of equal vectors
    width: int
    n_bank: int
    block_rows: int
    pivots: np.ndarray | None = None
    reach: np.ndarray | None = None
    near: np.ndarray | None = None
    sizes: dict[int, int] | None = None

    def save(self, spark: SparkSession, path: str) -> None:
        self.vectors.write.mode("overwrite").parquet(f"{path}/vectors")
        facts = [(self.m, self.width, self.n_bank, self.block_rows)]
        facts = spark.createDataFrame(facts, "m int, width int, n_bank long, block_rows long")
        facts.write.mode("overwrite").parquet(f"{path}/facts")
        cells = [] if self.pivots is None else [
            (c, p.tolist(), float(self.reach[c]), self.near[c].tolist(), self.sizes.get(c, 0))
            for c, p in enumerate(self.pivots)
        ]
        cells = spark.createDataFrame(cells, "cell int, pivot array<double>, reach double, near array<double>, n long")
        cells.write.mode("overwrite").parquet(f"{path}/cells")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> NeighbourIndex:
        facts = spark.read.parquet(f"{path}/facts").first()
        out = cls(spark.read.parquet(f"{path}/vectors"), facts.m, facts.width, facts.n_bank, facts.block_rows)
        if cells := sorted(spark.read.parquet(f"{path}/cells").collect(), key=lambda r: r.cell):
            out.pivots, out.near = (np.array([r[c] for r in cells]) for c in ("pivot", "near"))
            out.reach, out.sizes = np.array([r.reach for r in cells]), {r.cell: r.n for r in cells if r.n}
        return out


def build_index(bank: DataFrame, k: int = 20, block_rows: int = BLOCK_ROWS) -> NeighbourIndex:
    """The index of (book_id, embedding, average_rating), written to the shared folder once."""
    m, width = k + 1, usual_width(bank)
    sound = bank.where(_finite() & (F.size("embedding") == F.lit(width or 0)))
    banked = cut(_fold_bank(sound, m), "bank")
    n_bank = banked.count()
    if n_bank <= block_rows:
        return NeighbourIndex(banked, m, width or 0, n_bank, block_rows)
    n_cells = min(MAX_PIVOTS, -(-n_bank // block_rows))
    chosen = banked.orderBy(F.xxhash64("low_id"), "low_id").limit(n_cells).collect()
    pivots = _unit(np.array([r.embedding for r in chosen], dtype=float), is_query=False)
    cells = cut(banked.mapInArrow(_assign(pivots), _CELL_SCHEMA), "cells")
    return NeighbourIndex(cells, m, width, n_bank, block_rows, pivots, *_cell_bounds(cells, n_cells, m))


def _block_top(asked: DataFrame, index: NeighbourIndex) -> DataFrame:
    """(rep, vid, low_id, r) per block: the local top m of every query that visits it."""
    spark, m, block_rows = asked.sparkSession, index.m, index.block_rows
    if index.pivots is None:
        # one block holds the whole bank: send it to the queries
        bank = spark.sparkContext.broadcast(index.vectors.select("embedding", "low_id", "vid").toArrow())
        asking = spread(asked.select("rep", "embedding"), "rep")
        return asking.mapInArrow(_against(bank, m), _TOP_SCHEMA)

    pivots, reach = index.pivots, index.reach
    columns = _Chain(pivots, index.sizes, max(GRID_ROWS * block_rows, SIDE_ROWS))
    visits = cut(asked.mapInArrow(_visit(pivots, reach, index.near, m, columns), _VISIT_SCHEMA), "visits")
    homes = {r.home: r["count"] for r in visits.groupBy("home").count().collect()}
    share = -(-sum(homes.values()) // spark.sparkContext.defaultParallelism)
    blocks = _Chain(pivots, homes, min(max(share, CHUNK_ROWS), SIDE_ROWS))
    visits = visits.withColumn("block", blocks.piece("home", "rep"))

    query_side = visits.select("block", F.explode("columns").alias("column"), "rep", "embedding")
    # (asking block, cell) pairs without vectors; a cell's pieces are separate keys, so none is larger than a column
    wanted = visits.select(F.col("block").alias("asking"), F.explode("cells").alias("cell")).distinct()
    wanted = wanted.withColumn("column", F.explode(columns.pieces("cell")))
    bank_side = index.vectors.withColumn("column", columns.piece("cell", "low_id"))
    bank_side = bank_side.join(wanted, ["cell", "column"])
    bank_side = bank_side.select("asking", "column", "cell", "low_id", "vid", "embedding")
    # every task is of bounded size, so tasks need not be merged after the shuffle
    parts = min(blocks.n * columns.n, 20_000)
    return (
        query_side.repartition(parts, "block", "column")
        .groupBy("block", "column")
        .cogroup(bank_side.repartition(parts, "asking", "column").groupBy("asking", "column"))
        .applyInArrow(_walk(pivots, reach, index.near, m), _TOP_SCHEMA)
    )


class _Chain:
    """Cells in a row, each next to a near one, cut into pieces of about ``size`` rows."""

    def __init__(self, pivots: np.ndarray, rows: dict[int, int], size: int):
        self.size = size
        self.rows = np.array([rows.get(c, 0) for c in range(len(pivots))], np.int64)
        order, left = [0], np.ones(len(pivots), bool)
        left[0] = False
        while left.any():
            rest = np.flatnonzero(left)
            order.append(int(rest[(pivots[rest] @ pivots[order[-1]]).argmax()]))
            left[order[-1]] = False
        self.starts = np.zeros(len(pivots), np.int64)
        self.starts[order] = np.concatenate([[0], np.cumsum(self.rows[order])[:-1]])
        self.first = self.starts // size
        self.last = (self.starts + np.maximum(self.rows, 1) - 1) // size
        self.n = max(-(-int(self.rows.sum()) // size), 1)

    def piece(self, cell: str, key: str) -> Column:
        """The piece of a row: its place is drawn by hash among the places of its cell."""
        start, n = (F.element_at(number_array(x.tolist()), F.col(cell) + 1).cast("long") for x in (self.starts, self.rows))
        return F.floor((start + F.pmod(F.xxhash64(key), F.greatest(n, F.lit(1)))) / self.size).cast("int")

    def pieces(self, cell: str) -> Column:
        ends = (F.element_at(number_array(x.tolist()), F.col(cell) + 1).cast("int") for x in (self.first, self.last))
        return F.sequence(*ends)


_MEMBERS = "array<struct<neighbour_id: long, rating: double>>"
_CELL_SCHEMA = (
    f"embedding array<float>, low_id long, members {_MEMBERS}, vid long, cell int, distance double"
)
_VISIT_SCHEMA = "rep long, embedding array<float>, home int, cells array<int>, columns array<int>"
_TOP_SCHEMA = "rep long, vid long, low_id long, r long"


def _assign(pivots: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = _distance(_unit(matrix_of(batch, "embedding"), is_query=False), pivots)
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("embedding"),
                    batch.column("low_id"),
                    batch.column("members"),
                    batch.column("vid"),
                    pa.array(cell.astype(np.int32)),
                    pa.array(d[np.arange(len(cell)), cell]),
                ],
                names=["embedding", "low_id", "members", "vid", "cell", "distance"],
            )

    return assign


def _cell_bounds(
    cells: DataFrame, n_cells: int, m: int
) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
    """Per cell: radius, m smallest distances to the pivot (both small), and rows."""
    reach, sizes = np.full(n_cells, -np.inf), {}
    for r in cells.groupBy("cell").agg(F.max("distance").alias("far"), F.count("*").alias("n")).collect():
        reach[r.cell], sizes[r.cell] = r.far, r.n
    order = Window.partitionBy("cell").orderBy("distance")
    nearest = cells.select("cell", "distance").withColumn("rn", F.row_number().over(order))
    near = np.full((n_cells, m), np.inf)
    for r in nearest.where(F.col("rn") <= m).collect():
        near[r.cell, r.rn - 1] = r.distance
    return reach, near, sizes


def _bounds(d: np.ndarray, near: np.ndarray, m: int) -> np.ndarray:
    """Per query a cosine that its m-th neighbour reaches: the nearest cells' vectors next to
    their pivots lie within the sum of both distances."""
    close = np.argsort(d, axis=1)[:, :BOUND_CELLS]
    upper = np.take_along_axis(d, close, axis=1)[:, :, None] + near[close]
    worst = np.sort(upper.reshape(len(d), -1), axis=1)[:, m - 1]
    return 1.0 - worst**2 / 2.0


def _limit(cosine: np.ndarray) -> np.ndarray:
    """The distance beyond which nothing is as similar, with room for rounding."""
    return np.sqrt(np.clip(2.0 - 2.0 * (cosine - SLACK), 0.0, None)) + 1e-7


def _visit(pivots: np.ndarray, reach: np.ndarray, near: np.ndarray, m: int, columns: _Chain):
    first, last, rows = columns.first, columns.last, columns.rows

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = _distance(_unit(matrix_of(batch, "embedding"), is_query=True), pivots)
            needed = (d - reach[None, :] <= _limit(_bounds(d, near, m))[:, None]) & (rows > 0)
            cells = [np.flatnonzero(x) for x in needed]
            found = [sorted({p for c in x for p in range(first[c], last[c] + 1)}) for x in cells]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rep"),
                    batch.column("embedding"),
                    pa.array(d.argmin(axis=1).astype(np.int32)),
                    pa.array([x.tolist() for x in cells], pa.list_(pa.int32())),
                    pa.array(found, pa.list_(pa.int32())),
                ],
                names=["rep", "embedding", "home", "cells", "columns"],
            )

    return visit


_TOP_ARROW = pa.schema([(name, pa.int64()) for name in ("rep", "vid", "low_id", "r")])


def _prepared(bank: pa.Table) -> tuple[np.ndarray, pa.Table]:
    """Unit vectors and ids of bank rows, lowest id first."""
    bank = bank.sort_by("low_id").combine_chunks()
    return _unit(_table_matrix(bank), is_query=False), bank.select(["vid", "low_id"])


def _answer(query: pa.Table, ids: pa.Table, rows: np.ndarray, keys: np.ndarray) -> pa.Table:
    """The rows of _TOP_SCHEMA that query rows and ``_merged`` keys stand for."""
    n = ids.num_rows
    found = ids.take(pa.array(n - 1 - keys % n))
    rep = query.column("rep").combine_chunks().take(pa.array(rows))
    return pa.table([rep, found.column("vid"), found.column("low_id"), pa.array(keys // n)], schema=_TOP_ARROW)


def _best(query: pa.Table, block: tuple[np.ndarray, pa.Table], m: int) -> pa.Table:
    """The m nearest rows of the block for every query row."""
    b, ids = block
    q = _unit(_table_matrix(query), is_query=True)
    places, rows, keys = np.arange(len(b)), [], []
    for at in range(0, len(q), AT_ONCE[0]):
        part = q[at : at + AT_ONCE[0]]
        best, floor = np.full((len(part), m), NONE), np.full(len(part), -np.inf)
        _merged(best, floor, part, np.arange(len(part)), b, places, len(b))
        row, place = np.nonzero(best > NONE)
        rows.append(row + at)
        keys.append(best[row, place])
    return _answer(query, ids, np.concatenate(rows), np.concatenate(keys))


def _walk(pivots: np.ndarray, reach: np.ndarray, near: np.ndarray, m: int):
    def walk(query: pa.Table, bank: pa.Table) -> pa.Table:
        if not query.num_rows or not bank.num_rows:
            return _TOP_ARROW.empty_table()
        bank = bank.sort_by("low_id").combine_chunks()
        b, ids = _unit(_table_matrix(bank), is_query=False), bank.select(["vid", "low_id"])
        q = _unit(_table_matrix(query), is_query=True)
        rows, keys, _ = _running_top(q, b, bank.column("cell").to_numpy(), pivots, reach, near, m)
        return _answer(query, ids, rows, keys)

    return walk


NONE = np.iinfo(np.int64).min


def _merged(
    best: np.ndarray, floor: np.ndarray, part: np.ndarray, open_: np.ndarray, b: np.ndarray, places: np.ndarray, n: int
) -> None:
    """Brings the rows ``b``, which stand at ``places`` among n, into the running top of the open
    queries. A row is one number: the rounded similarity, then the lower place first, so that the choice
    is exact on ties. Only rows that reach a query's floor are looked at, and a bounded number of
    similarities is held at a time."""
    m, at, size = best.shape[1], 0, AT_ONCE[0]
    asked = part if len(open_) == len(part) else part[open_]
    while at < len(b):
        r = asked @ b[at : at + size].T
        row, column = np.nonzero(r >= floor[open_, None] - SLACK)
        if len(row):
            keys = np.rint(r[row, column] * STEP).astype(np.int64) * n + (n - 1 - places[at + column])
            hit, first, count = np.unique(row, return_index=True, return_counts=True)
            fresh = np.full((len(hit), m + count.max()), NONE)
            fresh[:, :m] = best[open_[hit]]
            fresh[np.repeat(np.arange(len(hit)), count), m + np.arange(len(row)) - np.repeat(first, count)] = keys
            kept = np.partition(fresh, fresh.shape[1] - m, axis=1)[:, -m:]
            best[open_[hit]] = kept
            worst = kept.min(axis=1)
            full = open_[hit[worst > NONE]]
            floor[full] = np.maximum(floor[full], worst[worst > NONE] // n / STEP)
        at, size = at + size, AT_ONCE[1]


def _running_top(
    q: np.ndarray, b: np.ndarray, cell: np.ndarray, pivots: np.ndarray, reach: np.ndarray, near: np.ndarray, m: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """Query rows, and for each of their top m in ``b`` its number (see ``_merged``). Last, the products
    that it took."""
    n, products = len(b), 0
    order = np.argsort(cell, kind="stable")
    b = b[order]
    present, starts = np.unique(cell[order], return_index=True)
    ends = np.append(starts[1:], n)
    rows, keys = [], []
    for at in range(0, len(q), AT_ONCE[0]):
        part = q[at : at + AT_ONCE[0]]
        d = _distance(part, pivots)
        floor = _bounds(d, near, m)
        lowest = d[:, present] - reach[present]
        best = np.full((len(part), m), NONE)
        for i in np.argsort(lowest.min(axis=0), kind="stable"):
            open_ = np.flatnonzero(lowest[:, i] <= _limit(floor))
            if not len(open_):
                continue
            own = slice(starts[i], ends[i])
            products += len(open_) * (ends[i] - starts[i])
            _merged(best, floor, part, open_, b[own], order[own], n)
        row, place = np.nonzero(best > NONE)
        rows.append(row + at)
        keys.append(best[row, place])
    return np.concatenate(rows), np.concatenate(keys), products


def _against(bank: Broadcast, m: int):
    def against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            if batch.num_rows:
                block = block or _prepared(bank.value)
                yield from _best(pa.Table.from_batches([batch]), block, m).to_batches()

    return against


def _table_matrix(table: pa.Table) -> np.ndarray:
    return matrix_of(table.select(["embedding"]).combine_chunks().to_batches()[0], "embedding")


# ------------------------------------------------------------- neighbour aggregates
# Each function gives aggregate columns over ranked neighbour rows, so that any mix of them
# takes one group-by; the rows come partitioned by query, so it needs no shuffle.
def rating_stats(prefix: str = "k20_", rated: bool = True) -> list[Column]:
    """Rating mean, deviation and median, and similarities, over all neighbours. Without
    ratings everything but the highest similarity is 0."""
    stats = {
        "mean_similar_rating": F.avg("rating"),
        "std_similar_rating": F.stddev_pop("rating"),
        "median_similar_rating": F.median("rating"),
        "max_similarity": F.max("similarity"),
        "mean_similarity": F.avg("similarity"),
    }
    if not rated:
        stats = {n: c if n == "max_similarity" else F.lit(0.0) for n, c in stats.items()}
    return [c.alias(prefix + n) for n, c in stats.items()]


def multiscale(mean_rating: float | None, scales: tuple[int, ...] = (5, 10, 20)) -> list[Column]:
    """Similarity-weighted rating, mean and highest similarity for several k at once. Where
    the similarities do not sum to more than 0 the overall mean rating stands in."""
    sums: list[Column] = []
    for k in scales:
        similarity = F.when(F.col("rn") <= k, F.col("similarity"))
        weight, weighted = F.sum(similarity), F.sum(similarity * F.col("rating"))
        sums += [
            F.when(weight > 0, weighted / weight)
            .otherwise(F.lit(mean_rating).cast("double"))
            .alias(f"weighted_similar_rating_k{k}"),
            F.avg(similarity).alias(f"mean_similarity_k{k}"),
            F.max(similarity).alias(f"max_similarity_k{k}"),
        ]
    return sums


def rating_distribution(k: int = 10, prefix: str = "s10_") -> list[Column]:
    rating = F.when(F.col("rn") <= k, F.col("rating"))
    quartiles = F.percentile(rating, F.lit([0.25, 0.75]))
    stats = {
        "mean_similar_rating": F.avg(rating),
        "median_similar_rating": F.median(rating),
        "std_similar_rating": F.stddev_pop(rating),
        "similar_rating_q25": quartiles[0],
        "similar_rating_q75": quartiles[1],
        "similar_rating_range": F.max(rating) - F.min(rating),
    }
    return [c.alias(prefix + n) for n, c in stats.items()]


def aggregate(neighbours: DataFrame, *groups: list[Column]) -> DataFrame:
    return neighbours.groupBy("book_id").agg(*[c for group in groups for c in group])


# ------------------------------------------------------------------------- sampling
@dataclass(frozen=True)
class SampleHash:
    """Multiplicative hash of an id; the same arithmetic on every engine."""

    factor: int = 48271
    modulus: int = 2147483647

    def __call__(self, key: str) -> Column:
        return F.pmod(F.pmod(F.col(key), F.lit(self.modulus)) * self.factor, F.lit(self.modulus))


def bank_sample(bank: DataFrame, n: int = 1000, key: str = "book_id") -> DataFrame:
    """n rows without replacement, the same on every run: the n lowest id hashes."""
    return bank.orderBy(SampleHash()(key), key).limit(n)
