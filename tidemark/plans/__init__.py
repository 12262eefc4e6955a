"""Registered queries, one module per group of operators."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "retrieval",
    "sources",
    "columns",
    "aggregates",
    "search",
    "serving",
    "transforms",
    "streams",
    "quality",
    "models",
    "lineage",
)


def load_all() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
