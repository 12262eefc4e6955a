"""Writers: warehouse tables, offline appends, saved datasets, staging and logs."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.materialize import batch_folder, new_writer, write_online
from tidemark.operators.splits import extents, micros
from tidemark.session import fresh_path


def sink_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "overwrite"
) -> None:
    """Replace a warehouse table; every partition writes over its own connection."""
    df.write.jdbc(url, table, mode=mode, properties=dict(properties))


def cast_like(df: DataFrame, existing: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType for f in existing.schema}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) for c in df.columns])


def sink_offline_append(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Append rows whose columns equal the stored ones, in the same order."""
    existing = df.sparkSession.read.format(file_format).load(path)
    if existing.columns != df.columns:
        raise ValueError(f"columns {df.columns} are not the stored ones {existing.columns}")
    cast_like(df, existing).write.format(file_format).mode("append").save(path)


def sink_offline_reorder(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Append after putting the columns in stored order; the sets must be equal."""
    existing = df.sparkSession.read.format(file_format).load(path)
    missing = sorted(set(existing.columns) - set(df.columns))
    extra = sorted(set(df.columns) - set(existing.columns))
    if missing or extra:
        raise ValueError(f"columns missing: {missing}; columns not expected: {extra}")
    sink_offline_append(df.select(*existing.columns), path, file_format)


def sink_view_output(
    df: DataFrame,
    offline_path: str | None = None,
    online_path: str | None = None,
    keys: Sequence[str] = (),
    ts: str | None = None,
    created: str | None = None,
    push: str | None = None,
) -> None:
    """Write a view's rows to its offline history, its online table, or both.

    Each push has folders of its own.  ``push`` names them, so that a push that
    is tried again under its name leaves one copy; unnamed pushes are all apart.
    """
    name = push or new_writer("push")
    if offline_path:
        df.write.mode("overwrite").parquet(batch_folder(offline_path, name, 0))
    if online_path:
        write_online(df, online_path, keys, ts, created, batch=0, writer=name)


def push_source(df: DataFrame, views: Sequence[Mapping], to: str = "online", push: str | None = None) -> None:
    """Push rows to every view fed by a push source.

    ``push`` names the push, as in :func:`sink_view_output`.

    Each view is a mapping of the arguments of :func:`sink_view_output`;
    ``to`` is ``online``, ``offline`` or ``online_and_offline``.
    """
    if to not in ("online", "offline", "online_and_offline"):
        raise ValueError(f"unknown push target {to!r}")
    if not views:
        raise ValueError("no view reads this push source")
    for view in views:
        target = dict(view)
        if to == "online":
            target["offline_path"] = None
        elif to == "offline":
            target["online_path"] = None
        sink_view_output(df, push=push, **target)


def persist_dataset(
    df: DataFrame, name: str, ts: str, *, path: str | None = None, allow_overwrite: bool = False
) -> dict:
    """Save a retrieval as a named table; returns its name, rows and event time bounds."""
    writer = df.write.mode("overwrite" if allow_overwrite else "errorifexists")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    saved = df.sparkSession.table(name)
    (extent,) = extents((saved, micros(ts)))
    return {"name": name, "rows": extent.rows, "min_us": extent.low, "max_us": extent.high}


def persist_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def export_staging(df: DataFrame, base: str | None = None) -> list[str]:
    """Write to a folder of its own and list the files written."""
    spark: SparkSession = df.sparkSession
    target = fresh_path(spark, "staging") if base is None else f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(target)
    return sorted(spark.read.parquet(target).inputFiles())


def sink_feature_logs(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append logged features, laid out by the chosen columns.

    Rows are rebalanced by those columns before the write: each folder gets few
    files, and adaptive execution still cuts a crowded folder into several.
    """
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.partitionBy(*partition_by).mode("append").parquet(path)
