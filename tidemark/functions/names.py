"""Names and dataset identities as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Schemes that name the same kind of store.
SCHEME_ALIASES = {"postgresql": "postgres", "s3a": "s3"}

# Parts of an address.
SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def sanitize_name(name: Column) -> Column:
    """Lower-case name of letters, digits, dots and single inner hyphens."""
    hyphenated = F.regexp_replace(F.lower(name), r"[ _]", "-")
    clean = F.regexp_replace(hyphenated, r"[^a-z0-9\-.]", "")
    trimmed = F.trim(F.regexp_replace(clean, r"-+", "-"), F.lit("-"))
    return F.when(trimmed == "", "unnamed").otherwise(trimmed)


def job_name(tool: Column, name: Column, context: Column | None = None) -> Column:
    parts = [sanitize_name(tool)]
    if context is not None:
        parts.append(F.when(context != "", sanitize_name(context)))
    return F.concat_ws("/", *parts, sanitize_name(name))


def _strip(text: Column) -> Column:
    return F.trim(text, F.lit("/"))


def normalize_dataset_uri(uri: Column) -> Column:
    """(namespace, name): the scheme, and the rest without its outer slashes."""
    scheme = F.lower(F.regexp_extract(uri, SCHEME, 1))
    rest = _strip(F.concat(F.regexp_extract(uri, AUTHORITY, 1), F.regexp_extract(uri, PATH, 1)))
    local = uri.startswith("/")
    return F.struct(
        F.when(local | (scheme == ""), "file").otherwise(scheme).alias("namespace"),
        F.when(local, F.ltrim(uri, F.lit("/")))
        .when(rest == "", "unknown")
        .otherwise(rest)
        .alias("name"),
    )


def dataset_identity(uri: Column) -> Column:
    """(scheme://host:port, path) with ``jdbc:`` removed and scheme aliases resolved."""
    clean = F.regexp_replace(F.trim(uri), r"^jdbc:", "")
    scheme = F.lower(F.regexp_extract(clean, SCHEME, 1))
    alias = F.when(scheme == "", "unknown")
    for old, new in SCHEME_ALIASES.items():
        alias = alias.when(scheme == old, new)
    authority = F.regexp_extract(clean, AUTHORITY, 1)
    server = F.regexp_replace(authority, r"^.*@", "")
    host = F.lower(F.regexp_extract(server, r"^([^:]*)", 1))
    port = F.regexp_extract(server, r":0*([1-9][0-9]*)$", 1)
    path = F.ltrim(F.regexp_extract(clean, PATH, 1), F.lit("/"))
    namespace = F.concat(
        alias.otherwise(scheme),
        F.lit("://"),
        F.when(host == "", "localhost").otherwise(host),
        F.when(port == "", "").otherwise(F.concat(F.lit(":"), port)),
    )
    return F.struct(
        namespace.alias("namespace"), F.when(path == "", authority).otherwise(path).alias("name")
    )


def table_of_query(sql: Column) -> Column:
    """First table named after FROM; empty when there is none."""
    return F.regexp_extract(sql, r"(?i)\bFROM\s+(\w+)", 1)


def entity_id(keys: Mapping[str, Column]) -> Column:
    """One id for an entity: sha256 of its key names and values, in order of the names.

    NULL values are told from empty ones, and no value can pass for two.
    """
    parts = []
    for name in sorted(keys):
        value = keys[name].cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.concat(F.lit(f"{name}="), F.coalesce(sized, F.lit("-"))))
    return F.sha2(F.concat_ws("|", *parts), 256)
