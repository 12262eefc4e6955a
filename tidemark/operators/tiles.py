"""Tiled time windows: partial aggregates per hop, merged into windows.

Raw rows are reduced to one partial row per (key, hop) with map-side
combination; everything after that works on partials, so a hot key costs at
most as many rows as there are hops.  Trailing windows are put together from
running aggregates of blocks, with rows only where a window's content changes.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.aggregate import windowed_agg
from tidemark.operators.joins import outer_join_windows
from tidemark.session import cut_lineage
from tidemark.spec import Aggregation

HOP, END = "hop_ms", "end_ms"
PARTIALS = ("count", "sum", "sum_sq", "min", "max")
MERGEABLE = {"count", "sum", "min", "max", "avg", "mean", "std", "stddev", "var", "variance"}


def hop_start(ts: Column, hop: int) -> Column:
    """Start of the hop holding ``ts``, in epoch milliseconds."""
    width = hop * 1000
    return F.floor(F.unix_millis(ts.cast("timestamp")) / width) * width


def partial_columns(columns: Sequence[str]) -> list[Column]:
    """Aggregates that give the partials of ``columns``."""
    aggs = []
    for c in columns:
        value = F.col(c).cast("double")
        aggs += [
            F.count(c).alias(f"{c}__count"),
            F.sum(value).alias(f"{c}__sum"),
            F.sum(value * value).alias(f"{c}__sum_sq"),
            F.min(value).alias(f"{c}__min"),
            F.max(value).alias(f"{c}__max"),
        ]
    return aggs


def hop_partials(
    df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], hop: int
) -> DataFrame:
    """Count, sum, sum of squares, min and max of each column per (keys, hop)."""
    return df.groupBy(*keys, hop_start(F.col(ts), hop).alias(HOP)).agg(*partial_columns(columns))


def merge_partials(column: str) -> dict[str, Column]:
    """Aggregates that merge the partials of ``column``."""
    pick = {"min": F.min, "max": F.max}
    return {p: pick.get(p, F.sum)(f"{column}__{p}") for p in PARTIALS}


def from_partials(function: str, parts: dict[str, Column]) -> Column:
    """Final value of an aggregate; NULL where no rows fall in the window."""
    n, total = parts["count"], parts["sum"]
    if function == "count":
        return F.coalesce(n, F.lit(0))
    if function in ("sum", "min", "max"):
        return F.when(n > 0, parts[function])
    if function in ("avg", "mean"):
        return F.when(n > 0, total / n)
    if function in ("var", "variance", "std", "stddev"):
        spread = F.greatest(parts["sum_sq"] - total * total / n, F.lit(0.0))
        variance = F.when(n > 1, spread / (n - 1))
        return F.sqrt(variance) if function.startswith("std") else variance
    raise ValueError(f"{function!r} has no partial form")


def merge_tiles(tiles: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Add up partials of the same (keys, hop) from several batches."""
    aggs = [
        a.alias(f"{c}__{p}") for c in columns for p, a in merge_partials(c).items()
    ]
    return tiles.groupBy(*keys, HOP).agg(*aggs)


def _columns(aggs: Sequence[Aggregation]) -> list[str]:
    return list(dict.fromkeys(a.column for a in aggs))


def _check(aggs: Sequence[Aggregation], hop: int) -> None:
    for agg in aggs:
        if not agg.window or agg.window % hop:
            raise ValueError(f"window {agg.window} is not a multiple of the hop {hop}")


def needed_partials(aggs: Sequence[Aggregation]) -> list[str]:
    """``column__part`` of the partials that the aggregates are made from."""
    more = {"count": (), "min": ("min",), "max": ("max",), "sum": ("sum",), "avg": ("sum",), "mean": ("sum",)}
    found = []
    for a in aggs:
        for part in ("count", *more.get(a.function, ("sum", "sum_sq"))):
            found.append(f"{a.column}__{part}")
    return list(dict.fromkeys(found))


def window_states(
    tiles: DataFrame,
    keys: Sequence[str],
    names: Sequence[str],
    hop: int,
    windows: Sequence[int],
    changes: bool = False,
) -> DataFrame:
    """Merged partials ``names`` of every window at its ends: ``END`` and ``column__part__seconds``.

    Ends are the tiles' ends or, with ``changes``, also the ends at which a tile
    leaves one of the windows, so all places where the content of a window changes.

    Time is cut into blocks as long as the window.  A window touches two blocks
    at most, so its content is what follows its start in one block and what comes
    up to its end in the next: a running aggregate back from a block's end and one
    on from a block's beginning.  No tile is added twice, nothing is subtracted,
    minima and maxima work like sums, and a task's group is one block of one key.
    """
    step = hop * 1000
    offsets = [step, *(w * 1000 + step for w in windows if changes)]
    points = []
    for w in windows:
        width = F.lit(w * 1000).cast("long")
        for offset in offsets:
            end = F.col(HOP) + offset
            for at, back, own in ((end - step, False, offset == step), (end - width, True, False)):
                points.append(
                    F.struct(
                        F.lit(w).alias("window"),
                        at.cast("long").alias("at"),
                        F.floor(at / width).cast("long").alias("block"),
                        F.lit(back).alias("back"),
                        end.cast("long").alias(END),
                        F.lit(own).alias("own"),
                    )
                )
    placed = tiles.select(*keys, *names, F.explode(F.array(*points)).alias("p")).select(
        *keys, "p.*", *(F.when(F.col("p.own"), F.col(n)).alias(n) for n in names)
    )
    group = [*keys, "window", "block"]
    on = Window.partitionBy(*group).orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy(*group).orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, 0)
    merges = {n: {"min": F.min, "max": F.max}.get(n.rpartition("__")[2], F.sum)(n) for n in names}
    running = {n: F.when(F.col("back"), a.over(back)).otherwise(a.over(on)) for n, a in merges.items()}
    states = placed.select(*keys, "window", "back", END, *(c.alias(n) for n, c in running.items()))

    # an end that several tiles ask for has the same state each time
    sides = []
    for w in windows:
        for n in names:
            for is_back in (False, True):
                here = (F.col("window") == w) & (F.col("back") == is_back)
                sides.append(F.max(F.when(here, F.col(n))).alias(f"{n}__{w}__{is_back}"))
    both = states.groupBy(*keys, END).agg(*sides)
    merged = []
    for w in windows:
        whole = F.col(END) % (w * 1000) == 0  # the window is one block, which the way back holds in full
        for n in names:
            ahead, behind = F.when(~whole, F.col(f"{n}__{w}__False")), F.col(f"{n}__{w}__True")
            merged.append(_joined(n, ahead, behind).alias(f"{n}__{w}"))
    return both.select(*keys, END, *merged)


def _joined(name: str, a: Column, b: Column) -> Column:
    """Two partials as one; sums and counts of nothing are 0."""
    part = name.rpartition("__")[2]
    if part in ("min", "max"):
        return (F.least if part == "min" else F.greatest)(a, b)
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


def held_until_next(
    rows: DataFrame, keys: Sequence[str], at: str, step: int, first: int, last: int, empty: Mapping[str, object]
) -> DataFrame:
    """Rows of changes repeated at every step up to the next change, from ``first`` to ``last``.

    Before a key's first row the columns of ``empty`` have its values.
    """
    order = Window.partitionBy(*keys).orderBy(at)
    start = F.when(F.lag(at).over(order).isNull(), F.lit(first)).otherwise(F.col(at))
    until = F.coalesce(F.lead(at).over(order) - step, F.lit(last))
    ranged = rows.withColumns({"__from": start.cast("long"), "__until": until.cast("long")})
    every = ranged.where("__from <= __until").withColumn(
        "__at", F.explode(F.sequence("__from", "__until", F.lit(step).cast("long")))
    )
    begun = F.col("__at") >= F.col(at)
    values = {c: F.when(begun, F.col(c)).otherwise(F.lit(v)) for c, v in empty.items()}
    return every.withColumns(values).withColumn(at, F.col("__at")).drop("__from", "__until", "__at")


def _bounds(tiles: DataFrame) -> tuple[int, int] | None:
    """First and last hop of all tiles."""
    low, high = tiles.agg(F.min(HOP), F.max(HOP)).first()
    return None if low is None else (low, high)


def cumulative_tiles(
    df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], hop: int, dense: bool = True
) -> DataFrame:
    """Running count, sum and sum of squares by hop.

    ``dense`` gives every key a row on each hop from the table's first to its
    last; otherwise there is a row where a key has rows, which says the same.
    """
    tiles = hop_partials(df, keys, ts, columns, hop)
    names = [f"{c}__{p}" for c in columns for p in ("count", "sum", "sum_sq")]
    upto = Window.partitionBy(*keys).orderBy(HOP).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def summed(rows: DataFrame) -> DataFrame:
        return rows.select(*keys, HOP, *(F.coalesce(F.sum(n).over(upto), F.lit(0)).alias(n) for n in names))

    if not dense:
        made = summed(tiles)
    else:
        tiles = cut_lineage(tiles)
        bounds = _bounds(tiles)
        made = summed(tiles)
        if bounds:
            made = held_until_next(made, keys, HOP, hop * 1000, *bounds, dict.fromkeys(names, 0))
    return made.withColumn("tile_end_ms", F.col(HOP) + hop * 1000)


def _results(states: DataFrame, keys: Sequence[str], aggs: Sequence[Aggregation]) -> DataFrame:
    """Final values of merged partials."""
    results = []
    for a in aggs:
        own = [f"{a.column}__{p}" for p in PARTIALS]
        parts = {p: F.col(f"{n}__{a.window}") if f"{n}__{a.window}" in states.columns else F.lit(None) for p, n in zip(PARTIALS, own, strict=True)}
        results.append(from_partials(a.function, parts).alias(a.alias))
    return states.select(*keys, F.col(END).alias("window_end_ms"), *results)


def _windows(aggs: Sequence[Aggregation]) -> list[int]:
    return sorted({a.window for a in aggs})


def range_frame(
    tiles: DataFrame, keys: Sequence[str], hop: int, aggs: Sequence[Aggregation]
) -> DataFrame:
    """Trailing windows ending at each tile, from the tiles inside the window."""
    _check(aggs, hop)
    return _results(window_states(tiles, keys, needed_partials(aggs), hop, _windows(aggs)), keys, aggs)


def window_changes(
    tiles: DataFrame, keys: Sequence[str], hop: int, aggs: Sequence[Aggregation]
) -> DataFrame:
    """Trailing windows at every end where the content of one of them changes.

    A window keeps its values until the key's next row; a key's last row tells
    that its windows are empty again.
    """
    _check(aggs, hop)
    states = window_states(tiles, keys, needed_partials(aggs), hop, _windows(aggs), changes=True)
    return _results(states, keys, aggs)


def windowed_from_tiles(
    df: DataFrame, keys: Sequence[str], ts: str, aggs: Sequence[Aggregation], hop: int, dense: bool = True
) -> DataFrame:
    """Windows of every key, ending at each hop from the table's first to its last.

    Without ``dense`` a key has rows only where a window's content changes.
    """
    _check(aggs, hop)
    columns, step = _columns(aggs), hop * 1000
    tiles = cut_lineage(hop_partials(df, keys, ts, columns, hop))
    states = window_states(tiles, keys, needed_partials(aggs), hop, _windows(aggs), changes=True)
    bounds = _bounds(tiles)
    if bounds:
        first, last = (h + step for h in bounds)
        states = states.where(F.col(END) <= last)
        if dense:
            empty = {c: 0 if c.split("__")[-2] not in ("min", "max") else None for c in states.columns if c not in (*keys, END)}
            states = held_until_next(states, keys, END, step, first, last, empty)
    return _results(states, keys, aggs)


def tiled_latest(
    df: DataFrame, keys: Sequence[str], ts: str, aggs: Sequence[Aggregation], hop: int
) -> DataFrame:
    """The window ending at the table's last hop, one row for every key ever seen."""
    _check(aggs, hop)
    tiles = hop_partials(df, keys, ts, _columns(aggs), hop)
    last = tiles.agg(F.max(HOP)).scalar()
    held = tiles.withColumn("__last", last)
    results = []
    for agg in aggs:
        inside = F.col(HOP) > F.col("__last") - agg.window * 1000
        pick = {"min": F.min, "max": F.max}
        parts = {
            p: pick.get(p, F.sum)(F.when(inside, F.col(f"{agg.column}__{p}"))) for p in PARTIALS
        }
        results.append(from_partials(agg.function, parts).alias(agg.alias))
    return held.groupBy(*keys).agg(*results)


def sliding_agg(
    df: DataFrame, keys: Sequence[str], ts: str, aggs: Sequence[Aggregation]
) -> DataFrame:
    """Sliding windows holding at least one row, by window end.

    When the slide divides the window, rows become hop partials first and only
    the partials are copied into the windows that cover them; other slides and
    functions without partials use Spark's own sliding window.
    """
    window, slide = aggs[0].window, aggs[0].hop
    if any((a.window, a.hop) != (window, slide) for a in aggs):
        raise ValueError("one call handles one window and slide")
    if window % slide or not {a.function for a in aggs} <= MERGEABLE:
        return windowed_agg(df, keys, ts, aggs)
    columns = _columns(aggs)
    tiles = hop_partials(df, keys, ts, columns, slide)
    width = slide * 1000
    ends = F.sequence(F.col(HOP) + width, F.col(HOP) + window * 1000, F.lit(width).cast("long"))
    copies = tiles.withColumn("__end", F.explode(ends))
    merged = copies.groupBy(*keys, "__end").agg(
        *[a.alias(f"{c}__{p}") for c in columns for p, a in merge_partials(c).items()]
    )
    kind = df.schema[ts].dataType
    return merged.select(
        *keys,
        F.timestamp_millis("__end").cast(kind).alias("window_end"),
        *[
            from_partials(a.function, {p: F.col(f"{a.column}__{p}") for p in PARTIALS}).alias(a.alias)
            for a in aggs
        ],
    )


def tumbling_agg(
    df: DataFrame, keys: Sequence[str], ts: str, aggs: Sequence[Aggregation]
) -> DataFrame:
    """Tumbling windows of any sizes side by side by window end; NULL where a size has no window there.

    Rows become partials at the greatest common divisor of the sizes, once; each
    partial then goes once to its window of every size.  Functions without
    partials are counted apart, by Spark's own windows.
    """
    apart = [a for a in aggs if a.function not in MERGEABLE]
    merged = [a for a in aggs if a.function in MERGEABLE]
    frames = [windowed_agg(df, keys, ts, [a for a in apart if a.window == w]) for w in _windows(apart)]
    if merged:
        frames.append(_tumbled(df, keys, ts, merged))
    joined = frames[0] if len(frames) == 1 else outer_join_windows(frames, [*keys, "window_end"])
    return joined.select(*keys, "window_end", *[a.alias for a in aggs])


def _tumbled(df: DataFrame, keys: Sequence[str], ts: str, aggs: Sequence[Aggregation]) -> DataFrame:
    sizes, columns = _windows(aggs), _columns(aggs)
    partials = hop_partials(df, keys, ts, columns, math.gcd(*sizes))
    windows = []
    for size in sizes:
        width = F.lit(size * 1000).cast("long")
        end = ((F.floor(F.col(HOP) / width) + 1) * width).cast("long")
        windows.append(F.struct(F.lit(size).alias("size"), end.alias(END)))
    copies = partials.select("*", F.inline(F.array(*windows)))
    results = []
    for size in sizes:
        results.append(F.max(F.col("size") == size).alias(f"has__{size}"))
        for c in columns:
            for part in PARTIALS:
                value = F.when(F.col("size") == size, F.col(f"{c}__{part}"))
                merge = {"min": F.min, "max": F.max}.get(part, F.sum)
                results.append(merge(value).alias(f"{c}__{part}__{size}"))
    rolled = copies.groupBy(*keys, END).agg(*results)
    kind = {f.name: f.dataType for f in df.schema}
    final = []
    for a in aggs:
        value = from_partials(a.function, {p: F.col(f"{a.column}__{p}__{a.window}") for p in PARTIALS})
        if a.function in ("sum", "min", "max"):
            value = value.cast(_result_type(a.function, kind[a.column]))
        final.append(F.when(F.col(f"has__{a.window}"), value).alias(a.alias))
    return rolled.select(*keys, F.timestamp_millis(END).cast(kind[ts]).alias("window_end"), *final)


def _result_type(function: str, kind: T.DataType) -> T.DataType:
    """Sums of whole numbers are long and extremes keep their type; the rest is double."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType() if function == "sum" else kind
    if isinstance(kind, T.FloatType) and function != "sum":
        return kind
    return T.DoubleType()
