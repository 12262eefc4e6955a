"""Comparing rows that share a bucket without a task per bucket or all pairs of it.

Buckets are dealt to groups of bounded size.  A bucket with more rows than a
block is cut into blocks, and each pair of blocks is its own unit of work; every
two rows of a bucket meet in exactly one unit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 2048
GROUP_ROWS = 40_000


def dealt_pairs(rows: DataFrame, key: str, row_id: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add (block, low, high) and a unit's rows together: rows of one (key, low, high) meet.

    ``rows`` has a column ``bucket_rows``, the number of rows of the key.
    """
    blocks = F.ceil(F.col("bucket_rows") / block_rows).cast("int")
    placed = rows.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64(row_id, F.lit(7)), F.col("blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return placed.withColumn("other", other).select(
        *rows.columns,
        "block",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
    ).drop("bucket_rows")


def dealt_tasks(rows: DataFrame, key: str, row_id: str, group_rows: int = GROUP_ROWS, **size: int) -> DataFrame:
    """The rows of ``dealt_pairs`` with their ``unit``, and the ``task`` that units are dealt to.

    Tasks follow from the rows after dealing, which go once to every block of
    their bucket, so that a crowded bucket makes more tasks and not larger ones.
    """
    dealt = dealt_pairs(rows, key, row_id, **size).withColumn("unit", F.xxhash64(key, "low", "high"))
    tasks = max(1, -(-dealt.count() // group_rows))
    return dealt.withColumn("task", F.pmod("unit", F.lit(tasks)).cast("int"))


def unit_pairs(unit: np.ndarray, block: np.ndarray, mixed: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places within equal ``unit`` numbers (sorted), in bounded pieces.

    Where ``mixed``, the unit joins two blocks and only pairs across them count.
    """
    size = len(unit)
    if not size:
        return
    last = np.searchsorted(unit, unit, "right")
    at = np.arange(size)
    shift = 1
    while True:
        at = at[at + shift < last[at]]
        if not len(at):
            return
        other = at + shift
        wanted = ~mixed[at] | (block[at] != block[other])
        yield at[wanted], other[wanted]
        shift += 1
