"""Prefix sums of an ordering that no single task sees whole.

Rows are range-partitioned by keys and order together and written with the
number of their split.  Inside a split a window adds them up; a split's last
key hands its sums to the splits that go on with it, one row per split, so a key
that holds any share of the rows is never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

ROWS_PER_SPLIT = 500_000
CHUNK = 4096


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    sums: Mapping[str, Column],
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """All columns and, under each name of ``sums``, the sum so far in its key, the row itself included.

    Rows that agree on all keys and the whole order get their numbers in any
    sequence.  NULL keys are one key; NULL values count as nothing.
    """
    split = "prefix_split"
    items = {name: f"{name}_item" for name in sums}
    written = cut_lineage(df.withColumns({items[n]: F.coalesce(c, F.lit(0)) for n, c in sums.items()}))
    cores = written.sparkSession.sparkContext.defaultParallelism
    splits = max(cores, -(-written.count() // rows_per_split))
    dealt = written.repartitionByRange(splits, *keys, *order).withColumn(split, F.spark_partition_id())
    dealt = cut_lineage(dealt)
    inside = Window.partitionBy(split, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumns({n: F.sum(i).over(inside) for n, i in items.items()}).drop(*items.values())

    key = F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), F.lit(0).alias("any"))
    ends = cut_lineage(dealt.groupBy(split).agg(F.min(key).alias("first_key"), F.max(key).alias("last_key")))
    last = dealt.join(ends, split).where(key.eqNullSafe(F.col("last_key"))).groupBy(split, "first_key", "last_key")
    handed = last.agg(*(F.sum(i).alias(i) for i in items.values()))
    # a split's first key goes on from the earlier splits that end with it
    given = handed.select(F.col("last_key").alias("key"), split, *items.values(), F.lit(False).alias("asks"))
    asked = handed.select(
        F.col("first_key").alias("key"), split, *(F.lit(0).alias(i) for i in items.values()), F.lit(True).alias("asks")
    )
    so_far = Window.partitionBy("key").orderBy(split, F.desc("asks")).rowsBetween(Window.unboundedPreceding, 0)
    carried = given.unionAll(asked).withColumns({i: F.sum(i).over(so_far) for i in items.values()}).where("asks")
    carried = cut_lineage(carried.select(split, F.col("key").alias("carried_key"), *items.values()))
    goes_on = key.eqNullSafe(F.col("carried_key"))
    total = {n: F.col(n) + F.when(goes_on, F.col(i)).otherwise(0) for n, i in items.items()}
    return local.join(carried, split, "left").withColumns(total).drop(split, "carried_key", *items.values())


def chunk_offsets(totals: DataFrame, chunk: str, sums: Sequence[str]) -> DataFrame:
    """(chunk, sums of all chunks before it) from one row per chunk, by blocks of chunks."""
    blocked = totals.withColumn("block", F.expr(f"{chunk} div {CHUNK}"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocked.groupBy("block").agg(*(F.sum(s).alias(f"{s}_block") for s in sums))
    blocks = blocks.withColumns({f"{s}_block": F.coalesce(F.sum(f"{s}_block").over(before), F.lit(0)) for s in sums})
    inside = Window.partitionBy("block").orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    local = blocked.withColumns({s: F.coalesce(F.sum(s).over(inside), F.lit(0)) for s in sums})
    return local.join(blocks, "block").select(chunk, *((F.col(s) + F.col(f"{s}_block")).alias(s) for s in sums))
