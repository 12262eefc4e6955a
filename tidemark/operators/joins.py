"""Key joins, unions and registry differences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.windows import latest_per_key
from tidemark.spec import ViewSpec

ENTITY_TS = "entity_event_timestamp"


def prefixed(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """``view__column`` names for everything but the keys."""
    return df.select(*[F.col(c) if c in keys else F.col(c).alias(f"{name}__{c}") for c in df.columns])


def remap_keys(df: DataFrame, key_map: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(key_map))


def join_views(
    views: Sequence[tuple[str, DataFrame]], keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join upstream views on their keys, columns prefixed by view name."""
    frames = [prefixed(df, name, keys) for name, df in views]
    return reduce(lambda a, b: a.join(b, list(keys), how), frames)


def join_entity_left(
    spine: DataFrame, features: DataFrame, keys: Sequence[str], spine_ts: str
) -> DataFrame:
    """Every spine row with its features; the spine time is renamed out of the way."""
    return spine.withColumnRenamed(spine_ts, ENTITY_TS).join(features, list(keys), "left")


def join_aggregated(spine: DataFrame, aggregated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Aggregates joined by key alone.

    There is no time bound here, so a training frame built this way sees
    values from after its event time; use the point-in-time joins otherwise.
    """
    return spine.join(aggregated, list(keys), "left")


def attach_target(
    features: DataFrame, target: DataFrame, keys: Sequence[str], ts: str
) -> DataFrame:
    return features.join(target, [*keys, ts], "left")


def outer_join_windows(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Several window sizes side by side, one row per key and time found in any."""
    return reduce(lambda a, b: a.join(b, list(on), "full"), frames)


def cross_join_dummy(
    spine: DataFrame, view_df: DataFrame, view: ViewSpec, start: Column, end: Column
) -> DataFrame:
    """Attach an entityless view to every spine row under the constant dummy key.

    The view has one current row, so it is read as a scalar subquery: no join
    of any kind is planned.
    """
    newest = latest_per_key(view_df, view, start, end)
    value = newest.select(F.struct(*view.features, view.ts).alias("row")).scalar()
    held = spine.withColumn("__dummy_id", F.lit("")).withColumn("__row", value)
    return held.select("*", *[F.col(f"__row.{c}").alias(c) for c in (*view.features, view.ts)]).drop(
        "__row"
    )


def semi_requested(df: DataFrame, requested: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only rows whose key was requested, each once however often it was asked for."""
    return df.join(requested.select(*keys), list(keys), "left_semi")


def union_distinct_keys(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION DISTINCT of key frames; keys a frame lacks are NULL."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return union.distinct()


def union_all_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All source rows together, exact duplicates dropped."""
    return reduce(lambda a, b: a.unionByName(b), frames).dropDuplicates()


def diff_objects(
    current: DataFrame, desired: DataFrame, name: str, properties: Sequence[str]
) -> DataFrame:
    """Compare two registries by object name.

    ``tag`` tells what happens to the object (add, delete, keep), and
    ``transition`` whether a kept object changes; ``changed`` lists the
    differing properties.  Objects without a name are left out.
    """
    named = (F.col(name).isNotNull()) & (F.col(name) != "")
    old = current.filter(named).select(
        F.col(name).alias("name"), F.struct(*properties).alias("old")
    )
    new = desired.filter(named).select(
        F.col(name).alias("name"), F.struct(*properties).alias("new")
    )
    both = old.join(new, "name", "full")
    differing = F.array_compact(
        F.array(
            *[
                F.when(~F.col(f"old.{p}").eqNullSafe(F.col(f"new.{p}")), F.lit(p))
                for p in properties
            ]
        )
    )
    gone, fresh = F.col("new").isNull(), F.col("old").isNull()
    changed = F.when(~gone & ~fresh, F.array_join(differing, ",")).otherwise("")
    return both.select(
        "name",
        F.when(fresh, "add").when(gone, "delete").otherwise("keep").alias("tag"),
        F.when(fresh, "CREATE")
        .when(gone, "DELETE")
        .when(changed != "", "UPDATE")
        .otherwise("UNCHANGED")
        .alias("transition"),
        changed.alias("changed"),
    )
