"""Newest / oldest row per key, as aggregates rather than windows.

``max_by`` keeps one candidate per key and partition before the shuffle, so a
hot key costs one row per map task instead of one sorted partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.spec import ViewSpec


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return False
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type)
    return True


def tie_break(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Columns giving a full order over rows that agree on time."""
    fields = {f.name: f.dataType for f in df.schema}
    return [F.col(n) if _orderable(fields[n]) else F.to_json(F.col(n)) for n in names]


def extreme_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], newest: bool
) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    ranking = F.struct(*[F.col(c) for c in order], *tie_break(df, [c for c in rest if c not in order]))
    pick = F.max_by if newest else F.min_by
    payload = F.struct(*[F.col(c) for c in rest])
    picked = df.groupBy(*keys).agg(pick(payload, ranking).alias("_picked"))
    if not keys:
        picked = picked.filter(F.col("_picked").isNotNull())
    return picked.select(*[F.col(k) for k in keys], "_picked.*").select(*df.columns)


def dedup_latest(
    df: DataFrame, keys: Sequence[str], ts: str, created: str | None = None
) -> DataFrame:
    """Newest row per key by event time, then created time."""
    return extreme_per_key(df, keys, [ts, created] if created else [ts], newest=True)


def first_per_key(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Earliest row per key; ties go to the smallest remaining columns."""
    return extreme_per_key(df, keys, [ts], newest=False)


def under_view_names(df: DataFrame, view: ViewSpec) -> DataFrame:
    """The rows with the view's column names; rows that have them already stay as they are."""
    renames = {old: new for old, new in view.renames.items() if old in df.columns}
    return df.drop(*[new for new in renames.values() if new not in renames]).withColumnsRenamed(renames)


def view_rows(
    df: DataFrame, view: ViewSpec, start: Column | None, end: Column
) -> DataFrame:
    """A view's rows of ``[start, end]`` under the view's names; no start means no lower bound.

    Where the source is laid out by a partition column, that column gets the same
    bounds, so the folders outside them are not read.
    """
    df = under_view_names(df, view)

    def bounded(column: Column, low: Column | None, high: Column) -> Column:
        return column <= high if low is None else column.between(low, high)

    if view.partition:
        days = [None if at is None else F.date_format(at, view.partition_pattern) for at in (start, end)]
        df = df.filter(bounded(F.col(view.partition).cast("string"), *days))
    return df.filter(bounded(F.col(view.ts), start, end))


def latest_per_key(df: DataFrame, view: ViewSpec, start: Column, end: Column) -> DataFrame:
    """Newest row per key of a view inside ``[start, end]``.

    Without keys the result is the one newest row under a constant dummy key.
    """
    times = [view.ts, view.created] if view.created else [view.ts]
    pruned = view_rows(df, view, start, end).select(*view.keys, *view.features, *times)
    if view.keys:
        return dedup_latest(pruned, view.keys, view.ts, view.created)
    newest = [F.col(c).desc() for c in times]
    ranked = pruned.orderBy(*newest, *[c.desc() for c in tie_break(pruned, view.features)])
    return ranked.limit(1).select(F.lit("").alias("__dummy_id"), "*")
