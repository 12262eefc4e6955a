"""Materialization into latest-per-key tables and batch lookups against them."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.asof import pit_join_multi
from tidemark.operators.commits import next_interval as next_interval
from tidemark.operators.joins import union_all_sources
from tidemark.operators.quality import validate_schema
from tidemark.operators.windows import dedup_latest, extreme_per_key, latest_per_key, view_rows
from tidemark.spec import ViewSpec

BATCH, WRITER, COMMITTED = "push_batch", "push_writer", "push_committed"


def materialize(
    df: DataFrame,
    view: ViewSpec,
    start: Column,
    end: Column,
    *,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    predicate: str | None = None,
    expected: Mapping | None = None,
    pull_latest: bool = False,
) -> DataFrame:
    """Rows of ``[start, end]`` through transform, filter, newest per key and schema check."""
    if pull_latest:
        df = latest_per_key(df, view, start, end)
    else:
        df = view_rows(df, view, start, end)
    if transform is not None:
        df = transform(df)
    if predicate:
        df = df.filter(predicate)
    if view.keys:
        df = dedup_latest(df, view.keys, view.ts, view.created)
    if expected:
        validate_schema(df, expected)
    return df


def materialize_on_demand(
    sources: Sequence[tuple[DataFrame, ViewSpec]],
    start: Column,
    end: Column,
    transform: Callable[[DataFrame], DataFrame],
    *,
    full_names: bool = True,
) -> DataFrame:
    """On-demand view stored ahead of time: newest source rows give the spine, then PIT."""
    spines = []
    for df, view in sources:
        newest = latest_per_key(df, view, start, end)
        keys = [F.col(k).alias(s) for k, s in zip(view.keys, view.spine_keys())]
        spines.append(newest.select(*keys, F.col(view.ts).alias("entity_ts")))
    spine = union_all_sources(spines)
    return transform(pit_join_multi(spine, sources, "entity_ts", full_names=full_names))


def materialize_chained(
    views: Mapping[str, tuple[Sequence[str], Callable[..., DataFrame]]], name: str
) -> DataFrame:
    """One lazy plan for a view over views: each function gets its inputs' frames."""
    done: dict[str, DataFrame] = {}
    walking: list[str] = []

    def build(current: str) -> DataFrame:
        if current in walking:
            raise ValueError(f"views form a cycle: {' -> '.join([*walking, current])}")
        if current not in done:
            walking.append(current)
            inputs, function = views[current]
            done[current] = function(*[build(i) for i in inputs])
            walking.pop()
        return done[current]

    return build(name)


def upsert_latest(
    stored: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    ts: str,
    created: str | None = None,
) -> DataFrame:
    """Stored table after an upsert: a key moves only to a strictly newer event time."""
    fresh = dedup_latest(incoming, keys, ts, created).withColumn("__kept", F.lit(0))
    old = stored.withColumn("__kept", F.lit(1))
    both = old.unionByName(fresh)
    return extreme_per_key(both, keys, [ts, "__kept"], newest=True).drop("__kept")


def write_online(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    ts: str,
    created: str | None = None,
    batch: int | None = None,
    writer: str | None = None,
) -> None:
    """Add one batch's newest rows to the online table at ``path``.

    A write costs only its own rows; :func:`read_online` applies the upsert
    rule over all batches.  Each writer (a stream, a run) has folders of its own,
    so writers never replace each other's batches.  A writer that repeats a batch
    number replaces that batch, so a retried micro-batch leaves no second copy.
    Without a number the write is a batch of a new writer.
    """
    if batch is None:
        writer, batch = writer or new_writer("push"), 0
    newest = dedup_latest(df, keys, ts, created).withColumn(COMMITTED, F.lit(time.time_ns() // 1000))
    newest.write.mode("overwrite").parquet(batch_folder(path, writer or "main", batch))


def batch_folder(path: str, writer: str, batch: int) -> str:
    """Where one writer's batch goes; no other writer or batch has this folder."""
    return f"{path}/{WRITER}={writer}/{BATCH}={batch}"


def new_writer(kind: str) -> str:
    """A name that no other writer has."""
    return f"{kind}-{uuid.uuid4().hex}"


def read_online(spark: SparkSession, path: str, keys: Sequence[str], ts: str) -> DataFrame:
    """Newest row per key over all batches; at equal event times the earlier write stays."""
    rows = spark.read.parquet(path).withColumn(COMMITTED, -F.col(COMMITTED))
    rows = rows.withColumn(BATCH, -F.col(BATCH).cast("long"))
    order = [ts, COMMITTED, BATCH, WRITER]
    return extreme_per_key(rows, keys, order, newest=True).drop(COMMITTED, BATCH, WRITER)


def compact_online(
    spark: SparkSession, path: str, target: str, keys: Sequence[str], ts: str
) -> None:
    """Rewrite the table as a single batch at ``target``, once reads merge too many."""
    write_online(read_online(spark, path, keys, ts), target, keys, ts, batch=0)


def online_lookup(requests: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each request row with its key's stored row; repeated keys are read once."""
    return requests.join(latest, list(keys), "left")


def lookup_status(
    requests: DataFrame, latest: DataFrame, keys: Sequence[str], ts: str, ttl: int, now: Column
) -> DataFrame:
    """Lookup with NOT_FOUND, OUTSIDE_MAX_AGE (value kept) or PRESENT per request row."""
    stored = latest.withColumn("__hit", F.lit(True))
    stale = F.col(ts) < now - F.make_dt_interval(secs=F.lit(ttl)) if ttl else F.lit(False)
    status = (
        F.when(F.col("__hit").isNull(), "NOT_FOUND")
        .when(stale, "OUTSIDE_MAX_AGE")
        .otherwise("PRESENT")
    )
    return online_lookup(requests, stored, keys).withColumn("status", status).drop("__hit")


def list_append_update(
    stored: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    column: str,
    prepend: bool = False,
    order: Sequence[str] = (),
) -> DataFrame:
    """Add values to a stored list; a key on one side only keeps that side.

    Several updates of a key are added one after the other, in the order of the
    ``order`` columns and then of the lists themselves.
    """
    gathered = F.array_sort(F.collect_list(F.struct(*order, F.col(column).alias("__list"))))
    renamed = updates.where(F.col(column).isNotNull()).groupBy(*keys).agg(
        F.flatten(F.transform(gathered, lambda x: x["__list"])).alias("__added")
    )
    both = stored.join(renamed, list(keys), "full")
    kind = stored.schema[column].dataType
    empty = F.array().cast(kind)
    old, new = F.coalesce(F.col(column), empty), F.coalesce(F.col("__added"), empty)
    parts = (new, old) if prepend else (old, new)
    return both.withColumn(column, F.concat(*parts)).select(*stored.columns)


def response_to_columns(
    looked_up: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    ts: str,
    include_timestamps: bool = False,
) -> DataFrame:
    """Lookup rows as feature columns, each with its ``__ts`` when asked."""
    columns = [F.col(k) for k in keys]
    for feature in features:
        columns.append(F.col(feature))
        if include_timestamps:
            columns.append(F.col(ts).alias(f"{feature}__ts"))
    return looked_up.select(*columns)


def to_eav(df: DataFrame, keys: Sequence[str], features: Sequence[str], times: Sequence[str]):
    """One row per key and feature, the value as text."""
    texts = [F.col(f).cast("string").alias(f) for f in features]
    narrow = df.select(*keys, *times, *texts)
    return narrow.unpivot([*keys, *times], list(features), "feature_name", "value")


def eav_pivot(
    eav: DataFrame, keys: Sequence[str], times: Sequence[str], kinds: Mapping[str, str]
) -> DataFrame:
    """Wide rows from entity, feature, value rows; ``kinds`` names the features to build."""
    wide = (
        eav.groupBy(*keys, *times)
        .pivot("feature_name", list(kinds))
        .agg(F.first("value", ignorenulls=True))
    )
    return wide.withColumns({f: F.col(f).cast(kind) for f, kind in kinds.items()})
