"""Connected components of links too many for one machine.

Links shrink by union within each task, which leaves at most one link per
member and task, and by rounds of large and small stars: every node links its
larger neighbours, then its smaller ones, to the least node near it.  The
rounds end when each member has one link, to a node that is no member.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import merge_labels
from tidemark.session import cut_lineage


def star_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) for the members of components of the links (a, b); root is the least node."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = merge_labels(np.arange(len(nodes)), places[: len(a)], places[len(a) :])
    member = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[member], nodes[parent[member]]


def _contract(batches):
    member, root = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        a = np.concatenate([member, batch.column(0).to_numpy(zero_copy_only=False)])
        b = np.concatenate([root, batch.column(1).to_numpy(zero_copy_only=False)])
        member, root = star_edges(a, b)
    yield pa.RecordBatch.from_arrays([pa.array(member, pa.int64()), pa.array(root, pa.int64())], names=["a", "b"])


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every linked node that isn't the least of its component.

    Nodes are whole numbers without NULL; links may repeat and point either way.
    """
    pairs = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    pairs = pairs.where("a <> b").mapInArrow(_contract, "a long, b long")
    while True:
        pairs = cut_lineage(pairs)
        members = pairs.agg(F.count(F.lit(1)), F.count_distinct("a")).first()
        if members[0] == members[1] and pairs.select("b").distinct().join(
            pairs.select(F.col("a").alias("b")), "b", "left_semi"
        ).isEmpty():
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = cut_lineage(large.where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        moved = large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = moved.unionAll(least.select("a", F.col("least").alias("b")))
        pairs = small.distinct().mapInArrow(_contract, "a long, b long")
