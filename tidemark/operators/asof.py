"""Point-in-time joins: for each spine row the newest feature row not after it.

Plan: spine and feature rows are unioned, grouped by key and scanned once in
time order, carrying the last feature row forward.  Every spine row gives
exactly one output row, no pair of rows is ever built, and the TTL is tested on
the newest candidate only (an older candidate can never pass when the newest
one does not).

A crowded key, one with more rows than a task should sort, is cut by time into
splits of equal size.  What a split needs from earlier ones is one carried row,
taken from a partially aggregated summary of (key, split).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.splits import (
    BEFORE_ALL,
    ROWS_PER_SPLIT,
    Extent,
    extents,
    micros,
    quantile_edges,
    split_count,
    with_split,
)
from tidemark.operators.windows import tie_break, view_rows
from tidemark.session import cut_lineage
from tidemark.spec import ViewSpec

SECOND = 1_000_000
SPREAD = 1 << 52


def pit_join(
    spine: DataFrame,
    view_df: DataFrame,
    view: ViewSpec,
    spine_ts: str,
    *,
    full_names: bool = False,
    feature_ts_as: str | None = None,
    rows_per_split: int | None = None,
    window_seconds: int | None = None,
) -> DataFrame:
    """As-of join of one view onto the spine; unmatched spine rows keep NULL features.

    ``window_seconds`` groups by fixed time windows, inside which crowded keys are still split.
    ``feature_ts_as`` also returns the matched event time under that name.
    """
    return _attach(
        spine,
        spine,
        [(view_df, view)],
        spine_ts,
        _extent(spine, spine_ts),
        full_names=full_names,
        feature_ts_as=feature_ts_as,
        rows_per_split=rows_per_split,
        window_seconds=window_seconds,
    )


def pit_join_multi(
    spine: DataFrame,
    views: Sequence[tuple[DataFrame, ViewSpec]],
    spine_ts: str,
    *,
    full_names: bool = True,
    rows_per_split: int | None = None,
) -> DataFrame:
    """One retrieval over several views, each with its own keys, TTL and alias.

    Views with the same spine keys share one scan, so the spine is shuffled
    once per set of keys and not once per view.
    """
    groups: dict[tuple[str, ...], list[tuple[DataFrame, ViewSpec]]] = {}
    for view_df, view in views:
        groups.setdefault(tuple(view.spine_keys()), []).append((view_df, view))
    joined, extent = spine, _extent(spine, spine_ts)
    for members in groups.values():
        joined = _attach(
            joined,
            spine,
            members,
            spine_ts,
            extent,
            full_names=full_names,
            rows_per_split=rows_per_split,
        )
    features = [v.output_name(f, full_names) for _, v in views for f in v.features]
    return joined.select(*spine.columns, *features)


def _extent(spine: DataFrame, spine_ts: str) -> Extent:
    return extents((spine, micros(spine_ts)))[0]


def _timed(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("__us", F.coalesce(micros(ts), F.lit(BEFORE_ALL)))


def _attach(
    spine: DataFrame,
    base: DataFrame,
    members: Sequence[tuple[DataFrame, ViewSpec]],
    spine_ts: str,
    extent: Extent,
    *,
    full_names: bool,
    feature_ts_as: str | None = None,
    rows_per_split: int | None = None,
    window_seconds: int | None = None,
) -> DataFrame:
    """Join views that share their spine keys; ``base`` has the same rows as ``spine``.

    The sizes are measured on ``base``, which is the spine before other views
    were joined to it and costs no join to read.
    """
    keys = members[0][1].spine_keys()
    named = [{f: view.output_name(f, full_names) for f in view.features} for _, view in members]
    outputs = [o for names in named for o in names.values()]
    clash = {o for o in outputs if o in spine.columns or outputs.count(o) > 1}
    if clash:
        raise ValueError(f"feature names collide: {sorted(clash)}")

    sides = [_feature_side(_bounded(df, view, extent), view, keys) for df, view in members]
    by_size, split, tied = _splits(_timed(base, spine_ts), sides, keys, rows_per_split)
    place = _in_windows(by_size, window_seconds) if window_seconds else by_size
    split = split or bool(window_seconds)
    left = _timed(spine, spine_ts)
    if tied:
        joined = _join_collapsed(left, sides, keys, place)
    else:
        joined = _scan(left, sides, keys, place, split)

    picked = []
    for i, ((_, view), names) in enumerate(zip(members, named)):
        feat = f"__feat{i}"
        alive = F.col(feat).isNotNull()
        if view.ttl:
            alive = alive & (F.col("__us") - F.col(f"{feat}.us") <= view.ttl * SECOND)
        picked += [F.when(alive, F.col(f"{feat}.row.{f}")).alias(o) for f, o in names.items()]
        if feature_ts_as:
            picked.append(F.when(alive, F.col(f"{feat}.row.{view.ts}")).alias(feature_ts_as))
    return joined.select(*[F.col(c) for c in spine.columns], *picked)


def _feature_side(view_df: DataFrame, view: ViewSpec, spine_keys: Sequence[str]) -> DataFrame:
    """Rows as (keys, __us, __feat); rows with a NULL key or time can never match."""
    payload = list(dict.fromkeys([*view.features, view.ts]))
    created = micros(view.created) if view.created else F.lit(None).cast("long")
    usable = F.col(view.ts).isNotNull()
    for key in view.keys:
        usable = usable & F.col(key).isNotNull()
    return view_df.filter(usable).select(
        *[F.col(k).alias(s) for k, s in zip(view.keys, spine_keys)],
        micros(view.ts).alias("__us"),
        F.struct(
            micros(view.ts).alias("us"),
            created.alias("created"),
            F.struct(*tie_break(view_df, view.features)).alias("tie"),
            F.struct(*payload).alias("row"),
        ).alias("__feat"),
    )


def _bounded(view_df: DataFrame, view: ViewSpec, spine: Extent) -> DataFrame:
    """Literal time bounds from the spine, in the column's own type so the scan can use them."""
    named = {new: old for old, new in view.renames.items() if old in view_df.columns}
    kind = view_df.schema[named.get(view.ts, view.ts)].dataType
    if not isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        raise TypeError(f"event time {view.ts!r} of view {view.name!r} is {kind.simpleString()}")

    def at(us: int) -> Column:
        return F.timestamp_micros(F.lit(us)).cast(kind)

    if spine.low is None:
        return view_rows(view_df, view, None, F.lit(None).cast(kind))
    start = at(spine.low - view.ttl * SECOND) if view.ttl else None
    return view_rows(view_df, view, start, at(spine.high))


def _splits(
    left: DataFrame, sides: Sequence[DataFrame], keys: Sequence[str], rows_per_split: int | None
) -> tuple[Callable[[DataFrame], DataFrame], bool, bool]:
    """How rows are split: a function adding ``__split``, whether it splits, and if ties fill one.

    Keys within one split's size stay whole.  There are at most
    rows / rows_per_split crowded keys; their list is a written table, which Spark
    broadcasts only where its size is within the session's limit.  Spine rows
    with a NULL key match nothing and are spread by hash.
    """
    limit = rows_per_split or ROWS_PER_SPLIT
    sides = [df.select(*keys, "__us") for df in (left, *sides)]
    if not keys:
        rows = sum(side.count() for side in sides)
        count = split_count(rows, limit, left.sparkSession.sparkContext.defaultParallelism)
        edges, tied = quantile_edges(count, *[(side, F.col("__us")) for side in sides])
        return lambda df: with_split(df, "__us", edges, "__split"), bool(edges), tied

    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    scattered = F.when(~known, -1 - F.pmod(F.xxhash64(F.to_json("__spine")), F.lit(SPREAD)))

    def whole(df: DataFrame) -> DataFrame:
        return df.withColumn("__split", scattered.otherwise(0))

    # no key has more rows than all keys together; only larger tables are counted by key
    if reduce(DataFrame.unionAll, [side.select("__us") for side in sides]).count() <= limit:
        return whole, False, False
    sizes = reduce(DataFrame.unionAll, sides).filter(known).groupBy(*keys).agg(F.count("*").alias("__n"))
    many = F.col("__n") > limit
    crowded = cut_lineage(sizes.filter(many).select(*[F.col(k).alias(f"{k}__c") for k in keys]))
    if crowded.isEmpty():
        return whole, False, False
    crowded = crowded.withColumn("__crowded", F.lit(True))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"{k}__c") for k in keys])

    def marked(df: DataFrame) -> DataFrame:
        return df.join(crowded, same, "left").drop(*[f"{k}__c" for k in keys])

    hot = [marked(side).filter("__crowded") for side in sides]
    count = split_count(sum(side.count() for side in hot), limit)
    edges, tied = quantile_edges(count, *[(side, F.col("__us")) for side in hot])

    def place(df: DataFrame) -> DataFrame:
        placed = with_split(marked(df), "__us", edges, "__at")
        split = scattered.when(F.col("__crowded"), F.col("__at")).otherwise(0)
        return placed.withColumn("__split", split).drop("__crowded", "__at")

    return place, True, tied


def _in_windows(
    place: Callable[[DataFrame], DataFrame], seconds: int
) -> Callable[[DataFrame], DataFrame]:
    """Splits ordered by the fixed window first and then by the split ``place`` gives."""
    window = F.floor(F.col("__us") / (seconds * SECOND))

    def placed(df: DataFrame) -> DataFrame:
        return place(df).withColumn("__split", F.struct(window.alias("at"), F.col("__split").alias("part")))

    return placed


def _newest(column: str) -> Column:
    feat = F.col(column)
    return F.max_by(feat, F.struct(feat["us"], feat["created"], feat["tie"]))


def _scan(
    left: DataFrame,
    sides: Sequence[DataFrame],
    keys: Sequence[str],
    place: Callable[[DataFrame], DataFrame],
    split: bool,
) -> DataFrame:
    """Spine rows with the newest row of each feature side as ``__feat0``, ``__feat1`` ..."""
    feats = [f"__feat{i}" for i in range(len(sides))]
    kinds = [side.schema["__feat"].dataType for side in sides]
    empty = {f: F.lit(None).cast(kind) for f, kind in zip(feats, kinds)}
    payload = F.struct(*[c for c in left.columns if c != "__us"])
    shape = [*keys, "__split", "__us", "__side", "__spine", *feats]

    spine = left.select(*keys, "__us", F.lit(1).alias("__side"), payload.alias("__spine"))
    spine = place(spine.withColumns(empty)).select(*shape)
    none = F.lit(None).cast(spine.schema["__spine"].dataType)

    def as_feature(df: DataFrame) -> DataFrame:
        return df.withColumns({"__side": F.lit(0), "__spine": none})

    stored = []
    for own, side in zip(feats, sides):
        held = {f: F.col("__feat") if f == own else empty[f] for f in feats}
        stored.append(place(as_feature(side.withColumns(held))).select(*shape))
    rows = reduce(DataFrame.unionAll, [spine, *stored])
    if split:
        rows = rows.unionAll(as_feature(_carried(rows, keys, feats)).select(*shape))
    ties = [F.col(f"{f}.{part}") for f in feats for part in ("created", "tie")]
    walk = (
        Window.partitionBy(*keys, "__split")
        .orderBy("__us", "__side", *ties)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    newest = {f: F.last(f, ignorenulls=True).over(walk) for f in feats}
    return rows.withColumns(newest).filter("__side = 1").select("__spine.*", "__us", *feats)


def _carried(rows: DataFrame, keys: Sequence[str], feats: Sequence[str]) -> DataFrame:
    """For each (key, split) with spine rows: the newest feature rows of earlier splits."""
    for key in keys:
        rows = rows.filter(F.col(key).isNotNull())
    by_split = rows.groupBy(*keys, "__split").agg(
        *[_newest(f).alias(f) for f in feats], F.max("__side").alias("__asked")
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    )
    handed = by_split.withColumns({f: F.last(f, ignorenulls=True).over(earlier) for f in feats})
    times = F.array_compact(F.array(*[F.col(f"{f}.us") for f in feats]))
    held = handed.filter("__asked = 1").withColumn("__us", F.array_max(times))
    return held.filter(F.col("__us").isNotNull())


def _join_collapsed(left, sides, keys, place) -> DataFrame:
    """For tables where one instant fills whole splits: scan distinct (key, time) only."""
    asked = left.select(*keys, "__us").distinct()
    newest = [s.groupBy(*keys, "__us").agg(_newest("__feat").alias("__feat")) for s in sides]
    feats = [f"__feat{i}" for i in range(len(sides))]
    found = _scan(asked.withColumn("__at", F.col("__us")), newest, keys, place, split=True).select(
        *[F.col(k).alias(f"{k}__f") for k in keys], F.col("__at").alias("__us__f"), *feats
    )
    same = [F.col(c).eqNullSafe(F.col(f"{c}__f")) for c in (*keys, "__us")]
    return left.join(found, same, "left").drop(*[f"{c}__f" for c in (*keys, "__us")])


def broadcast_asof(
    spine: DataFrame,
    view_df: DataFrame,
    view: ViewSpec,
    spine_ts: str,
    *,
    max_bytes: int = 100 * 1024 * 1024,
    max_versions: int = 512,
    full_names: bool = False,
) -> DataFrame:
    """As-of join that leaves the spine unshuffled when the feature side is small.

    Each feature row is turned into the interval until its successor, so a
    spine row meets exactly one interval.  The measured size and the largest
    number of versions per key must both be within bounds; otherwise the
    general plan of :func:`pit_join` runs, which needs no bound.
    """
    spine_keys = view.spine_keys()
    bounded = _bounded(view_df, view, _extent(spine, spine_ts))
    features = _feature_side(bounded, view, spine_keys)
    if not _fits(features, spine_keys, max_bytes, max_versions):
        return pit_join(spine, view_df, view, spine_ts, full_names=full_names)
    versions = features.groupBy(*spine_keys, "__us").agg(_newest("__feat").alias("__feat"))
    until = F.lead("__us").over(Window.partitionBy(*spine_keys).orderBy("__us"))
    intervals = versions.select(
        *[F.col(k).alias(f"{k}__f") for k in spine_keys],
        F.col("__us").alias("__from"),
        until.alias("__until"),
        "__feat",
    )
    at = micros(spine_ts)
    condition = (F.col("__from") <= at) & (F.col("__until").isNull() | (at < F.col("__until")))
    for key in spine_keys:
        condition = condition & (F.col(key) == F.col(f"{key}__f"))
    joined = spine.join(F.broadcast(intervals), condition, "left")
    alive = F.col("__from").isNotNull()
    if view.ttl:
        alive = alive & (at - F.col("__from") <= view.ttl * SECOND)
    return joined.select(
        *[F.col(c) for c in spine.columns],
        *[
            F.when(alive, F.col(f"__feat.row.{f}")).alias(view.output_name(f, full_names))
            for f in view.features
        ],
    )


def _fits(features: DataFrame, keys: Sequence[str], max_bytes: int, max_versions: int) -> bool:
    """Measured size, keys included, against the bounds; a first count reads no payload."""
    if features.count() > max_bytes // 16:
        return False
    per_key = features.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b")
    )
    size = per_key.agg(F.max("n").alias("versions"), F.sum("b").alias("bytes")).first()
    return (size["bytes"] or 0) <= max_bytes and (size["versions"] or 0) <= max_versions


def windowed_asof(
    spine: DataFrame, view_df: DataFrame, view: ViewSpec, spine_ts: str, window_seconds: int, **kw
) -> DataFrame:
    """As-of join grouped by fixed time windows, exact across window borders."""
    return pit_join(spine, view_df, view, spine_ts, window_seconds=window_seconds, **kw)


def default_start(views: Sequence[ViewSpec], end: Column) -> Column:
    """``end`` minus the largest TTL, or minus 30 days when no view has one."""
    longest = max((v.ttl for v in views), default=0) or 30 * 24 * 3600
    return end - F.make_dt_interval(secs=F.lit(longest))


def non_entity_spine(
    views: Sequence[tuple[DataFrame, ViewSpec]],
    start: Column | None,
    end: Column,
    *,
    keep_ts: bool = False,
    ts_name: str = "entity_ts",
) -> DataFrame:
    """Spine built from the views themselves: distinct keys seen in ``[start, end]``.

    The as-of time is ``end``; with ``keep_ts`` it is every distinct event time.
    """
    start = default_start([v for _, v in views], end) if start is None else start
    parts = []
    for view_df, view in views:
        seen = view_rows(view_df, view, start, end)
        keys = [F.col(k).alias(s) for k, s in zip(view.keys, view.spine_keys())]
        stamp = F.col(view.ts) if keep_ts else end
        parts.append(seen.select(*keys, stamp.alias(ts_name)).distinct())
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    return union.distinct()


def non_entity_retrieval(
    views: Sequence[tuple[DataFrame, ViewSpec]],
    start: Column | None,
    end: Column,
    *,
    keep_ts: bool = False,
    full_names: bool = True,
) -> DataFrame:
    spine = cut_lineage(non_entity_spine(views, start, end, keep_ts=keep_ts))
    return pit_join_multi(spine, views, "entity_ts", full_names=full_names)
