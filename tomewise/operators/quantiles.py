"""Exact, linearly interpolated quantiles of any number of columns, in one distributed way.

Equal values of a column are counted first. The counted values are then dealt out in order of (column,
value); as each of them is one row, the parts are even, however often a value occurs. The totals of the
parts tell which part holds a wanted rank, and only those parts are ordered.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import cut


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]]
) -> dict[str, list[float] | None]:
    """Quantiles per column, None for a column without values. Nulls and NaN are ignored."""
    names = list(wanted)
    cells = [
        F.struct(F.lit(i).alias("c"), F.col(f"`{name}`").cast("double").alias("x"))
        for i, name in enumerate(names)
    ]
    values = df.select(F.inline(F.array(*cells))).where(F.col("x").isNotNull() & ~F.isnan("x"))
    parts = _ordered_parts(values)
    sizes, targets = _totals(parts), {}
    for i, name in enumerate(names):
        n = sum(size for (c, _), size in sizes.items() if c == i)
        if n:
            targets[i] = {f(p * (n - 1)) for p in wanted[name] for f in (math.floor, math.ceil)}
    found = _lookup(parts, sizes, targets)

    def value(i: int, p: float, n: int) -> float:
        at = p * (n - 1)
        low, high = found[i, math.floor(at)], found[i, math.ceil(at)]
        return low + (high - low) * (at - math.floor(at))

    out: dict[str, list[float] | None] = {}
    for i, name in enumerate(names):
        n = sum(size for (c, _), size in sizes.items() if c == i)
        out[name] = [value(i, p, n) for p in wanted[name]] if n else None
    return out


def values_at_ranks(df: DataFrame, c: str, ranks: Iterable[int]) -> dict[int, object]:
    """The values at the given 0-based ranks of a column without nulls, in the column's own type."""
    parts = _ordered_parts(df.select(F.lit(0).alias("c"), F.col(c).alias("x")))
    found = _lookup(parts, _totals(parts), {0: set(ranks)})
    return {rank: value for (_, rank), value in found.items()}


def _ordered_parts(values: DataFrame) -> DataFrame:
    """(c, x, n, part): every value of a column once, in parts that follow one another. They are
    written, as the bounds between parts are drawn anew with each evaluation."""
    counts = values.groupBy("c", "x").agg(F.count("*").alias("n"))
    return cut(counts.repartitionByRange("c", "x").withColumn("part", F.spark_partition_id()), "counts")


def _totals(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Rows per (column, part): at most one entry per part and one more per column."""
    rows = parts.groupBy("c", "part").agg(F.sum("n").alias("n")).collect()
    return {(r.c, r.part): r.n for r in sorted(rows)}


def _lookup(
    parts: DataFrame, sizes: Mapping[tuple[int, int], int], targets: Mapping[int, Iterable[int]]
) -> dict[tuple[int, int], object]:
    wanted, below = [], dict.fromkeys(targets, 0)
    for (c, part), n in sizes.items():
        if c in targets:
            start = below[c]
            wanted += [(c, part, start, r) for r in set(targets[c]) if start <= r < start + n]
            below[c] += n
    if not wanted:
        return {}
    # one row per rank that the caller names
    target = F.broadcast(
        parts.sparkSession.createDataFrame(wanted, "c int, part int, below long, rank long")
    )
    upto = F.sum("n").over(Window.partitionBy("c", "part").orderBy("x"))
    ranked = parts.join(target.select("c", "part").distinct(), ["c", "part"], "left_semi").withColumn("upto", upto)
    place = F.col("rank") - F.col("below")
    hit = ranked.join(target, ["c", "part"]).where(
        (place < F.col("upto")) & (place >= F.col("upto") - F.col("n"))
    )
    return {(r.c, r["rank"]): r.x for r in hit.select("c", "rank", "x").collect()}


def median(df: DataFrame, column: str) -> float | None:
    found = exact_quantiles(df, {column: [0.5]})[column]
    return None if found is None else found[0]
