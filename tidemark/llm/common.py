"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tidemark.session import cut_lineage

FOLDS = 5
ARROW_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Hand Python workers batches of bounded bytes, so that very long texts don't add up."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(doc_id: str) -> Column:
    """Whether crc32 of the id as text is divisible by five; false for a NULL id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def with_text_column(
    df: DataFrame, out: str, kind: DataType, make: Callable[[], Callable[[list[str]], pa.Array]], text: str = "text"
) -> DataFrame:
    """All columns plus ``out``, which ``make()``'s function gives for a list of whole texts.

    ``make`` runs once for each task.
    """
    bounded_batches(df.sparkSession)
    wide = df.select(*(F.col(f"`{c}`") for c in df.columns), text_or_empty(f"`{text}`").alias(free_name(df, "whole")))
    places = [f"c{i}" for i in range(len(wide.columns))]
    fields = [StructField(p, f.dataType) for p, f in zip(places, wide.schema, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            if batch.num_rows:
                *kept, texts = batch.columns
                yield pa.RecordBatch.from_arrays([*kept, function(texts.to_pylist())], names=places)

    schema = StructType([*fields[:-1], StructField(places[-1], kind)])
    return wide.mapInArrow(run, schema).toDF(*df.columns, out)


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, bound: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """At most ``bound`` labelled training documents: (doc_id, text, label).

    The sample is the ``bound`` smallest id hashes among labelled ids outside
    the held-out fold, so it doesn't depend on partitions.  Labels other than
    0 and 1 and NULL ids are left out; an id labelled twice keeps the larger
    label.  Only ids and labels are broadcast, ``bound`` rows at most.
    """
    chosen = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    texts = documents.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")


def in_tasks(df: DataFrame, key: str, groups: int, per_task: int) -> DataFrame:
    """The rows by ``key``, in so many partitions that each has about ``per_task`` of its ``groups`` at most.

    Where the session's own number of shuffle partitions is enough, Spark deals
    the rows as usual; tables that outgrow it get partitions by their size.
    """
    wanted = -(-groups // per_task)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(wanted, key) if wanted > usual else df


def sized(df: DataFrame, rows_per_group: int) -> tuple[DataFrame, int]:
    """The written rows, and how many groups of about ``rows_per_group`` they make."""
    written = cut_lineage(df)
    return written, max(1, -(-written.count() // rows_per_group))


def merge_labels(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union the pairs (a, b) in a forest whose roots are the smallest members; fully compressed."""
    while len(a):
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(up := parent[parent], parent):
            parent = up
    return parent


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the frame doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def host_of(url: Column) -> Column:
    """Lower-case host of an address without port and user; empty if there is none."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(rest, r"^.*@", ""), r":\d*$", ""))
