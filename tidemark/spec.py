"""Descriptions of feature views and aggregations; plain data, no planning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class ViewSpec:
    """Column roles of a feature view.

    ``ttl`` is in seconds, 0 means no lower bound.  ``key_map`` renames view
    keys to the spine's names, so one view can be joined twice under two
    different keys.  ``renames`` maps columns of the source to the names that
    every other field uses.  ``partition`` is a column by which the source's
    folders are laid out, holding the event time under ``partition_pattern``,
    whose texts must sort like the times; reads bound it along with the time.
    """

    name: str
    keys: Sequence[str]
    features: Sequence[str]
    ts: str
    created: str | None = None
    ttl: int = 0
    key_map: Mapping[str, str] = field(default_factory=dict)
    renames: Mapping[str, str] = field(default_factory=dict)
    partition: str | None = None
    partition_pattern: str = "yyyy-MM-dd"

    def spine_keys(self) -> list[str]:
        return [self.key_map.get(k, k) for k in self.keys]

    def output_name(self, feature: str, full_names: bool) -> str:
        return f"{self.name}__{feature}" if full_names else feature

    def under(self, name: str, key_map: Mapping[str, str]) -> ViewSpec:
        return replace(self, name=name, key_map=dict(key_map))


@dataclass(frozen=True)
class Aggregation:
    """One aggregate; the window and slide are seconds, slide defaults to the window."""

    column: str
    function: str
    window: int | None = None
    slide: int | None = None

    @property
    def hop(self) -> int | None:
        return self.slide or self.window

    @property
    def alias(self) -> str:
        base = f"{self.function}_{self.column}"
        return f"{base}_{self.window}s" if self.window else base
