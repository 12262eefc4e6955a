"""Equal-frequency splits of an ordering column.

A window over one key runs in one task, so a key holding a third of the rows
would make one task sort a third of the table.  Ordered operators therefore
work on (key, split) groups and hand a small per-split summary from one split
to the next.  The edges are quantiles of the whole ordering, so no (key, split)
group can hold much more than 1/n of the rows whatever the key.  The number of
splits follows from the number of rows alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

ROWS_PER_SPLIT = 2_000_000
BEFORE_ALL = -(1 << 53)


def micros(column: Column | str) -> Column:
    """Microseconds since the epoch for zoned and zone-less timestamps alike."""
    column = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(column.cast("timestamp"))


@dataclass(frozen=True)
class Extent:
    """Row count and bounds of one ordering column."""

    rows: int
    low: float | None
    high: float | None


def _stack(sides: Sequence[tuple[DataFrame, Column]]) -> DataFrame:
    parts = [
        df.select(F.lit(number).alias("side"), order.alias("v"))
        for number, (df, order) in enumerate(sides)
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionAll(part)
    return union


def extents(*sides: tuple[DataFrame, Column]) -> list[Extent]:
    """Extents of several ordering columns in one job; a few numbers come back."""
    found = {
        row["side"]: Extent(row["rows"], row["low"], row["high"])
        for row in _stack(sides)
        .groupBy("side")
        .agg(F.count("v").alias("rows"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()
    }
    return [found.get(number, Extent(0, None, None)) for number in range(len(sides))]


def split_count(rows: int, rows_per_split: int | None, at_least: int = 1) -> int:
    wanted = math.ceil(rows / (rows_per_split or ROWS_PER_SPLIT))
    return max(at_least, wanted, 1)


def quantile_edges(count: int, *sides: tuple[DataFrame, Column]) -> tuple[list[float], bool]:
    """Edges of ``count`` equal-frequency splits per side, merged.

    Also tells whether one single value fills a whole split: such a value
    cannot be divided by its order, so callers collapse equal values first.
    """
    if count <= 1:
        return [], False
    steps = [i / count for i in range(1, count)]
    found = (
        _stack(sides)
        .groupBy("side")
        .agg(F.percentile_approx("v", steps, 5 * count).alias("edges"), F.count("v").alias("n"))
        .collect()
    )
    chosen: set[float] = set()
    tied = False
    for row in found:
        edges = list(row["edges"] or ())
        tied = tied or (len(set(edges)) < len(edges) and row["n"] >= count)
        chosen.update(edges)
    return sorted(chosen), tied


def with_split(df: DataFrame, order: str, edges: Sequence[float], out: str) -> DataFrame:
    """Add the split number of ``order``; equal values always share a split."""
    if not edges:
        return df.withColumn(out, F.lit(0))
    raw = f"{out}_raw"
    bucketizer = Bucketizer(
        splits=[-math.inf, *map(float, edges), math.inf],
        inputCol=f"{out}_in",
        outputCol=raw,
        handleInvalid="keep",
    )
    wide = df.withColumn(f"{out}_in", F.col(order).cast("double"))
    placed = bucketizer.transform(wide)
    return placed.withColumn(out, F.col(raw).cast("int")).drop(raw, f"{out}_in")


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    split: str,
    order: Sequence[Column | str],
    value: Column,
    out: str,
) -> DataFrame:
    """Inclusive running sum per key in ``order``, where ``split`` follows ``order``.

    Sums per (key, split) are taken first and summed over the splits, which is
    at most one row per split and key; each split then adds its own offset.
    """
    item, offset = f"{out}_item", f"{out}_offset"
    group = [*keys, split]
    valued = df.withColumn(item, value)
    earlier = (
        Window.partitionBy(*(f"{k}__t" for k in keys))
        .orderBy(f"{split}__t")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = (
        valued.groupBy(*(F.col(k).alias(f"{k}__t") for k in group))
        .agg(F.sum(item).alias(offset))
        .withColumn(offset, F.coalesce(F.sum(offset).over(earlier), F.lit(0)))
    )
    inside = (
        Window.partitionBy(*group)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = valued.withColumn(out, F.sum(item).over(inside)).drop(item)
    same = [F.col(k).eqNullSafe(F.col(f"{k}__t")) for k in group]
    return (
        local.join(totals, same, "left")
        .withColumn(out, F.col(out) + F.col(offset))
        .drop(offset, *(f"{k}__t" for k in group))
    )


def ordered_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    value: Column,
    out: str,
    rows_per_split: int | None = None,
) -> DataFrame:
    """Running sum per key in ``order``, by one plan at every size.

    Rows are range-partitioned by the whole of ``order``, so strings are split by
    all their bytes and equal first columns by the columns after them; only rows
    that agree on all of ``order`` share a split.  The rows are written with
    their splits, so a lost executor can't see other splits.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    count = split_count(df.count(), rows_per_split, cores)
    split = f"{out}_split"
    dealt = df.repartitionByRange(count, *order).withColumn(split, F.spark_partition_id())
    return running_total(cut_lineage(dealt), keys, split, order, value, out).drop(split)


def row_index(df: DataFrame, column: str, out: str, rows_per_split: int | None = None) -> DataFrame:
    """0-based position of each row in ascending order of a distinct column."""
    numbered = ordered_total(df, [], [column], F.lit(1), out, rows_per_split)
    return numbered.withColumn(out, (F.col(out) - 1).cast("int"))
