"""Schema, JSON and expectation checks over whole tables, one aggregate per suite."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type pairs that count as the same.
COMPATIBLE = ({"int", "bigint"}, {"float", "double"}, {"timestamp", "timestamp_ntz"})


def types_agree(expected: T.DataType, actual: T.DataType) -> bool:
    """Same type, or one of int/long, float/double, map/struct, element by element."""
    if expected == actual:
        return True
    if isinstance(expected, T.ArrayType) and isinstance(actual, T.ArrayType):
        return types_agree(expected.elementType, actual.elementType)
    nested = (T.MapType, T.StructType)
    if isinstance(expected, nested) and isinstance(actual, nested):
        return type(expected) is not type(actual) or isinstance(expected, T.StructType)
    names = {expected.simpleString(), actual.simpleString()}
    return any(names <= group for group in COMPATIBLE)


def schema_report(df: DataFrame, expected: Mapping[str, T.DataType]) -> dict[str, str]:
    """``missing``, ``mismatch`` or ``ok`` for each expected column."""
    actual = {f.name: f.dataType for f in df.schema}
    return {
        name: "missing"
        if name not in actual
        else ("ok" if types_agree(kind, actual[name]) else "mismatch")
        for name, kind in expected.items()
    }


def validate_schema(df: DataFrame, expected: Mapping[str, T.DataType]) -> DataFrame:
    """Missing columns are an error, other types a warning."""
    report = schema_report(df, expected)
    missing = [n for n, state in report.items() if state == "missing"]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    for name in (n for n, state in report.items() if state == "mismatch"):
        warnings.warn(f"column {name} is {df.schema[name].dataType}, not {expected[name]}")
    return df


def bad_json(column: str) -> Column:
    """Present but not well-formed JSON."""
    return F.col(column).isNotNull() & F.try_parse_json(column).isNull()


def json_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, filled values and malformed values for each JSON column, over all rows."""
    entries = [
        F.struct(
            F.lit(c).alias("name"),
            F.count(F.lit(1)).alias("rows"),
            F.count(c).alias("present"),
            F.count_if(bad_json(c)).alias("malformed"),
        )
        for c in columns
    ]
    return df.agg(F.array(*entries).alias("r")).select(F.inline("r"))


def validate_json(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for row in json_report(df, columns).collect():
        if row["malformed"]:
            raise ValueError(f"column {row['name']} holds {row['malformed']} malformed values")
    return df


@dataclass(frozen=True)
class Expectation:
    """One check; ``kind`` is in_set, between, max_between, min_between, not_null or exists."""

    kind: str
    column: str
    values: Sequence[Any] = ()
    low: Any = None
    high: Any = None
    mostly: float = 1.0


def _within(value: Column, check: Expectation) -> Column:
    inside = F.lit(True)
    if check.low is not None:
        inside = inside & (value >= check.low)
    if check.high is not None:
        inside = inside & (value <= check.high)
    return inside


def _entry(df: DataFrame, check: Expectation) -> Column:
    number, absent = F.lit(None).cast("double"), check.column not in df.columns
    rows = F.count(F.lit(1))
    missing = unexpected = F.lit(0).cast("long")
    observed = number
    if check.kind == "exists" or absent:
        success = F.max(F.lit(not absent))
    elif check.kind in ("max_between", "min_between"):
        pick = F.max if check.kind == "max_between" else F.min
        observed = pick(check.column).cast("double")
        success = F.coalesce(_within(pick(check.column), check), F.lit(True))
        missing = rows - F.count(check.column)
    else:
        value = F.col(check.column)
        missing = rows - F.count(check.column)
        if check.kind == "in_set":
            good = value.isin(list(check.values))
        elif check.kind == "between":
            good = _within(value, check)
        elif check.kind == "not_null":
            good = value.isNotNull()
        else:
            raise ValueError(f"unknown expectation {check.kind!r}")
        judged = F.lit(True) if check.kind == "not_null" else value.isNotNull()
        unexpected = F.count_if(judged & ~good)
        total = F.count_if(judged)
        success = F.when(total == 0, True).otherwise((total - unexpected) / total >= check.mostly)
    return F.struct(
        F.lit(check.kind).alias("kind"),
        F.lit(check.column).alias("column_name"),
        success.alias("success"),
        rows.alias("rows"),
        missing.alias("missing"),
        (100.0 * missing / rows).alias("missing_percent"),
        unexpected.alias("unexpected"),
        (100.0 * unexpected / rows).alias("unexpected_percent"),
        observed.alias("observed"),
    )


def expectations(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """One report row per check; the whole suite is a single pass over the table."""
    entries = F.array(*[_entry(df, check) for check in suite])
    return df.agg(entries.alias("report")).select(F.inline("report"))


def learn_suite(reference: DataFrame, numeric: Sequence[str], slack: float = 0.0) -> list[Expectation]:
    """Bounds seen in a saved dataset, as checks for another; a few numbers are read back."""
    seen = reference.agg(
        *[F.min(c).cast("double").alias(f"lo_{c}") for c in numeric],
        *[F.max(c).cast("double").alias(f"hi_{c}") for c in numeric],
    ).first()
    suite = []
    for column in numeric:
        low, high = seen[f"lo_{column}"], seen[f"hi_{column}"]
        if low is None:
            continue
        margin = slack * (high - low)
        suite.append(Expectation("between", column, low=low - margin, high=high + margin))
        suite.append(Expectation("max_between", column, high=high + margin))
        suite.append(Expectation("min_between", column, low=low - margin))
    return suite


def profile_reference(
    reference: DataFrame, df: DataFrame, numeric: Sequence[str], slack: float = 0.0
) -> DataFrame:
    return expectations(df, learn_suite(reference, numeric, slack))


def quality_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, NULLs and a constant flag per column.

    A column is constant when its smallest and largest values agree, so no
    distinct count is needed.
    """
    entries = [
        F.struct(
            F.lit(c).alias("name"),
            F.count(F.lit(1)).alias("rows"),
            (F.count(F.lit(1)) - F.count(c)).alias("nulls"),
            F.min(c).eqNullSafe(F.max(c)).alias("constant"),
        )
        for c in columns
    ]
    return df.agg(F.array(*entries).alias("r")).select(F.inline("r"))


def training_checks(
    df: DataFrame, critical: Sequence[str], numeric: Mapping[str, str]
) -> tuple[DataFrame, DataFrame]:
    """The frame made fit for training, and the report of what was found in it."""
    report = quality_counts(df, [*critical, *[c for c in numeric if c not in critical]])
    fixed = df.fillna(0, list(critical))
    return fixed.withColumns({c: F.col(c).try_cast(kind) for c, kind in numeric.items()}), report


def feature_metadata(
    df: DataFrame, features: Sequence[str], ts: str, status: Column | None = None
) -> DataFrame:
    """``__timestamp`` and ``__status`` beside each feature; NOT_FOUND values become NULL."""
    found = F.lit("PRESENT") if status is None else status
    columns = {}
    for feature in features:
        state = F.when(F.col(feature).isNull(), "NOT_FOUND").otherwise(found)
        columns[f"{feature}__timestamp"] = F.col(ts)
        columns[f"{feature}__status"] = state
    masked = {
        f: F.when(F.col(f"{f}__status") != "NOT_FOUND", F.col(f)) for f in features
    }
    return df.withColumns(columns).withColumns(masked)


def log_schema(
    keys: Mapping[str, T.DataType], views: Mapping[str, Mapping[str, T.DataType]]
) -> T.StructType:
    """Columns of a feature log: keys, each feature with its time and status, request data."""
    fields = [T.StructField(k, kind) for k, kind in keys.items()]
    for view, features in views.items():
        for feature, kind in features.items():
            name = f"{view}__{feature}"
            fields.append(T.StructField(name, kind))
            fields.append(T.StructField(f"{name}__timestamp", T.TimestampType()))
            fields.append(T.StructField(f"{name}__status", T.IntegerType()))
    fields.append(T.StructField("__log_timestamp", T.TimestampType()))
    fields.append(T.StructField("__log_date", T.DateType()))
    fields.append(T.StructField("__request_id", T.StringType()))
    return T.StructType(fields)
