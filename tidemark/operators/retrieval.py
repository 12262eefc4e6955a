"""Retrieval by ``view:feature`` reference: training frames and batch lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from tidemark.operators.asof import pit_join_multi
from tidemark.operators.joins import prefixed
from tidemark.operators.materialize import lookup_status
from tidemark.operators.transform import OnDemandView, needed_features, odfv_dependencies
from tidemark.operators.windows import under_view_names
from tidemark.spec import ViewSpec

EVENT_TIMESTAMP = "event_timestamp"
TIMES = (T.TimestampType, T.TimestampNTZType)


def infer_timestamp(df: DataFrame) -> str:
    """``event_timestamp`` if there is one, else the only timestamp column."""
    if EVENT_TIMESTAMP in df.columns:
        return EVENT_TIMESTAMP
    found = [f.name for f in df.schema if isinstance(f.dataType, TIMES)]
    if len(found) != 1:
        raise ValueError(f"cannot tell the event time among {found}; name it")
    return found[0]


def infer_view(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    *,
    ts: str | None = None,
    created: str | None = None,
    ttl: int = 0,
) -> ViewSpec:
    """View over all columns that are not keys, times or named with double underscores."""
    if ts is None:
        ts = infer_timestamp(df.drop(created) if created else df)
    roles = {*keys, ts, created}
    features = [
        c for c in df.columns if c not in roles and not (c.startswith("__") or c.endswith("__"))
    ]
    return ViewSpec(name, list(keys), features, ts, created, ttl)


def grouped_refs(refs: Sequence[str], known: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """Features asked of each view, in order; an unknown view or feature is an error."""
    groups: dict[str, list[str]] = {}
    for ref in refs:
        view, _, feature = ref.partition(":")
        if view not in known or feature not in known[view]:
            raise ValueError(f"no feature {ref!r}")
        asked = groups.setdefault(view, [])
        if feature not in asked:
            asked.append(feature)
    return groups


def output_names(refs: Sequence[str], taken: Sequence[str], full: bool) -> dict[str, str]:
    """Final name of each ``view__feature`` column, refused where two would be the same."""
    names = [(ref.replace(":", "__", 1), ref.partition(":")[2]) for ref in refs]
    final = [long if full else short for long, short in names] + list(taken)
    clash = sorted({n for n in final if final.count(n) > 1})
    if clash:
        raise ValueError(f"feature names collide: {clash}")
    return {long: long if full else short for long, short in names}


def historical_features(
    spine: DataFrame,
    views: Mapping[str, tuple[DataFrame, ViewSpec]],
    refs: Sequence[str],
    spine_ts: str | None = None,
    *,
    on_demand: Sequence[OnDemandView] = (),
    full_names: bool = False,
) -> DataFrame:
    """Spine rows with the requested features as of each row's time.

    On-demand features bring in the stored features they read, which are
    dropped again unless asked for.
    """
    rename = output_names(refs, spine.columns, full_names)
    spine_ts = spine_ts or infer_timestamp(spine)
    stored, _ = needed_features(refs, on_demand)
    groups = grouped_refs(stored, {n: v.features for n, (_, v) in views.items()})
    members = [(views[n][0], replace(views[n][1], name=n, features=asked)) for n, asked in groups.items()]
    joined = pit_join_multi(spine, members, spine_ts, full_names=True)
    made = odfv_dependencies(joined, refs, on_demand, spine.columns)
    return made.withColumnsRenamed(rename)


def online_features(
    requests: DataFrame,
    tables: Mapping[str, tuple[DataFrame, ViewSpec]],
    refs: Sequence[str],
    now: Column,
    *,
    on_demand: Sequence[OnDemandView] = (),
    full_names: bool = False,
) -> DataFrame:
    """Request rows with the stored features, and ``view__status`` for each view read.

    ``tables`` holds the latest row per key of each view.
    """
    rename = output_names(refs, requests.columns, full_names)
    stored, _ = needed_features(refs, on_demand)
    groups = grouped_refs(stored, {n: v.features for n, (_, v) in tables.items()})
    found = requests
    for name, asked in groups.items():
        df, view = tables[name]
        keys = view.spine_keys()
        latest = under_view_names(df, view).withColumnsRenamed(dict(zip(view.keys, keys))).select(*keys, *asked, view.ts)
        latest = prefixed(latest, name, keys)
        ts = f"{name}__{view.ts}"
        found = lookup_status(found, latest, keys, ts, view.ttl, now)
        found = found.withColumnRenamed("status", f"{name}__status").drop(ts)
    keep = [*requests.columns, *[f"{n}__status" for n in groups]]
    return odfv_dependencies(found, refs, on_demand, keep).withColumnsRenamed(rename)
