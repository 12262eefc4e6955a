"""Column clean-up, scaling, encoding and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.splits import ordered_total
from tidemark.operators.windows import first_per_key
from tidemark.session import cut_lineage

# Columns recorded about a date moved under the EU policy, and the monitoring
# tools that may be named there, the usual one first.
EU_COLUMNS = ("eu_date_reasoning_hash", "eu_llm_trace_id", "eu_llm_monitoring_tool")
EU_TOOLS = ("langsmith", "arize")


# -- projection -----------------------------------------------------------------------------


def select_aliased(df: DataFrame, fields: Sequence[str], mapping: Mapping[str, str]) -> DataFrame:
    """Project ``fields``; a field with a mapping is returned under its feature name."""
    dotted = [f for f in fields if "." in f and f not in mapping]
    if dotted:
        raise ValueError(f"columns with dots need a field mapping: {dotted}")
    return df.select(*[F.col(f"`{f}`").alias(mapping.get(f, f)) for f in fields])


def rename_forward(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


# -- filters --------------------------------------------------------------------------------


def filter_time_range(
    df: DataFrame, ts: str, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """Inclusive on both ends; either end may be open."""
    if start is not None:
        df = df.filter(F.col(ts) >= start)
    if end is not None:
        df = df.filter(F.col(ts) <= end)
    return df


def filter_date_partition(
    df: DataFrame, ts: str, partition: str, pattern: str, start: Column, end: Column
) -> DataFrame:
    """Time range plus the same range on the date partition column, which prunes files."""
    bounds = F.date_format(start, pattern), F.date_format(end, pattern)
    return filter_time_range(df, ts, start, end).filter(F.col(partition).between(*bounds))


def filter_ttl_asof(df: DataFrame, ts: str, entity_ts: str, ttl: int, keep_null=False) -> DataFrame:
    """Rows not after the entity time and at most ``ttl`` seconds before it (0: no bound)."""
    alive = F.col(ts) <= F.col(entity_ts)
    if ttl:
        alive = alive & (F.col(ts) >= F.col(entity_ts) - F.make_dt_interval(secs=F.lit(ttl)))
    if keep_null:
        alive = alive | F.col(ts).isNull()
    return df.filter(alive)


def filter_ttl_now(df: DataFrame, ts: str, as_of: Column, ttl: int) -> DataFrame:
    """Rows still alive at the given ``as_of`` time."""
    return df.filter(F.col(ts) >= as_of - F.make_dt_interval(secs=F.lit(ttl))) if ttl else df


# -- values ---------------------------------------------------------------------------------


def drop_duplicates_key(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    return first_per_key(df, keys, ts)


def cast_numeric(df: DataFrame, columns: Sequence[str], to: str = "double") -> DataFrame:
    """Coerce to a number; what cannot be read becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in columns})


def to_utc(df: DataFrame, ts: str, zone: str = "UTC") -> DataFrame:
    return df.withColumn(ts, F.to_utc_timestamp(F.col(ts).cast("timestamp"), zone))


def fill_null_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0, list(columns))


def fill_null_median(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Fill each column's NULLs with its median; ``exact=False`` allows 1 % rank error."""
    if exact:
        values = exact_medians(df, columns)
    else:
        values = df.agg(*[F.percentile_approx(c, 0.5, 100).alias(c) for c in columns]).first()
        values = values.asDict()
    known = {c: v for c, v in values.items() if v is not None}
    return df.fillna(known) if known else df


#: So many distinct values of a bracket are looked at in the driver; larger brackets are narrowed first.
MEDIAN_VALUES = 20_000


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians of all columns at once, by narrowing brackets; nothing is sorted or gathered.

    A pass counts the values under each column's bracket and finds two
    approximate ranks around its median, which hold a fiftieth of the bracket's
    rows; brackets narrow until each has few distinct values, which are counted
    by one grouped pass.  A column without values has none.
    """
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    wide = [F.struct(F.count(c).alias("n"), F.percentile_approx(c, [0.49, 0.51], 2000).alias("p")).alias(c) for c in columns]
    seen = doubles.agg(*wide).first() if columns else {}
    rows = {c: seen[c]["n"] for c in columns}
    medians: dict[str, float | None] = {c: None for c in columns if not rows[c]}
    brackets = {c: tuple(seen[c]["p"]) for c in columns if rows[c]}
    under: dict[str, int] = {}
    while True:
        medians |= {c: low for c, (low, high) in brackets.items() if low == high}
        brackets = {c: b for c, b in brackets.items() if c not in medians}
        if not brackets:
            return medians
        found = doubles.agg(*[_narrowed(c, *b).alias(c) for c, b in brackets.items()]).first()
        wider = {c: b for c, b in brackets.items() if found[c]["values"] > MEDIAN_VALUES}
        under = {c: found[c]["under"] for c in brackets}
        closer = {c: _around(found[c], rows[c]) for c in wider}
        for c in [c for c, b in wider.items() if closer[c] == b]:  # ties at both ends hold many values between them
            medians[c] = _ranked_median(doubles, c, rows[c], under[c], *brackets.pop(c))
            del wider[c], closer[c]
        if not wider:
            return medians | _counted_medians(doubles, brackets, rows, under)
        brackets |= closer


def _narrowed(column: str, low: float, high: float) -> Column:
    """Rows under a bracket, and within it rows, about how many values, and ranks two hundredths apart."""
    inside = F.when(F.col(column).between(low, high), F.col(column))
    return F.struct(
        F.count_if(F.col(column) < low).alias("under"),
        F.count(inside).alias("rows"),
        F.approx_count_distinct(inside, 0.05).alias("values"),
        F.percentile_approx(inside, [i / 100 for i in range(101)], 5000).alias("p"),
    )


def _around(found: Row, rows: int) -> tuple[float, float]:
    """The ranks of a bracket that surely hold its median, from the hundredths of its rows."""
    first, second = (rows - 1) // 2 - found["under"], rows // 2 - found["under"]
    low = max(0, 100 * first // found["rows"] - 1)
    high = min(100, -(-100 * (second + 1) // found["rows"]) + 1)
    return found["p"][low], found["p"][high]


def _ranked_median(df: DataFrame, column: str, rows: int, under: int, low: float, high: float) -> float:
    """Median of ``rows`` values, ``under`` of which lie under the bracket, whose values are ranked split by split."""
    counts = df.filter(F.col(column).between(low, high)).groupBy(column).agg(F.count("*").alias("weight"))
    ranked = ordered_total(counts, [], [column], F.col("weight"), "upto")
    first, second = (rows - 1) // 2 - under, rows // 2 - under
    found = ranked.agg(
        F.min(F.when(F.col("upto") > first, F.col(column))).alias("a"),
        F.min(F.when(F.col("upto") > second, F.col(column))).alias("b"),
    ).first()
    return (found["a"] + found["b"]) / 2


def _counted_medians(
    df: DataFrame, brackets: Mapping[str, tuple[float, float]], rows: Mapping[str, int], under: Mapping[str, int]
) -> dict[str, float]:
    """Medians from the counts of each bracket's few distinct values."""
    if not brackets:
        return {}
    values = F.array(
        *[F.struct(F.lit(c).alias("name"), F.when(F.col(c).between(*b), F.col(c)).alias("v")) for c, b in brackets.items()]
    )
    each = df.select(F.inline(values)).where("v is not null")
    counts: dict[str, list] = {c: [] for c in brackets}
    for row in each.groupBy("name", "v").agg(F.count("*").alias("n")).collect():
        counts[row["name"]].append((row["v"], row["n"]))
    out = {}
    for c, found in counts.items():
        held = np.array(sorted(found))
        upto = np.cumsum(held[:, 1])
        middle = [(rows[c] - 1) // 2 - under[c], rows[c] // 2 - under[c]]
        out[c] = float(held[np.searchsorted(upto, middle, "right"), 0].mean())
    return out


def fill_by_type(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing features after a join: lists become empty lists, scalars stay NULL."""
    kinds = {f.name: f.dataType for f in df.schema}
    empty = {
        c: F.coalesce(F.col(c), F.array().cast(kinds[c]))
        for c in columns
        if isinstance(kinds[c], T.ArrayType)
    }
    return df.withColumns(empty) if empty else df


def minmax_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale to [0, 1]; a constant column becomes 0.0 and NULL stays NULL.

    The bounds come from one aggregate, read back as a scalar subquery.
    """
    bounds = df.agg(
        F.struct(
            *[F.min(c).cast("double").alias(f"min_{i}") for i, c in enumerate(columns)],
            *[F.max(c).cast("double").alias(f"max_{i}") for i, c in enumerate(columns)],
        ).alias("bounds")
    )
    held = df.withColumn("__bounds", bounds.scalar())
    scaled = {}
    for i, c in enumerate(columns):
        low, high = F.col(f"__bounds.min_{i}"), F.col(f"__bounds.max_{i}")
        scaled[c] = F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(
            F.when(high > low, (F.col(c) - low) / (high - low)).otherwise(0.0)
        )
    return held.withColumns(scaled).select(*df.columns)


def ratio(numerator: Column, denominator: Column) -> Column:
    """``a / b`` with a zero ``b`` read as 1 and infinite results as 0."""
    value = numerator / F.when(denominator == 0, F.lit(1.0)).otherwise(denominator)
    return F.when(F.abs(value) == F.lit(float("inf")), 0.0).otherwise(value)


def ratio_features(df: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    return df.withColumns(
        {
            name: ratio(F.col(a).cast("double"), F.col(b).cast("double"))
            for name, (a, b) in ratios.items()
        }
    )


def label_encode(df: DataFrame, columns: Sequence[str], null_label: str = "nan") -> DataFrame:
    """Replace strings by their rank among the sorted distinct values.

    The values of all columns are found in one pass and ranked together, column
    by column.
    """
    if not columns:
        return df
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit(null_label)) for c in columns}
    each = F.array(*[F.struct(F.lit(i).alias("__at"), t.alias("__label")) for i, t in enumerate(texts.values())])
    labels = cut_lineage(df.select(F.inline(each)).distinct())
    codes = cut_lineage(ordered_total(labels, ["__at"], ["__label"], F.lit(1), "__code"))
    for i, (column, text) in enumerate(texts.items()):
        own = codes.filter(F.col("__at") == i).select("__label", (F.col("__code") - 1).cast("int").alias("__code"))
        encoded = df.withColumn("__text", text).join(own, F.col("__text") == F.col("__label"))
        df = encoded.withColumn(column, F.col("__code")).select(*df.columns)
    return df


def reasoning_hash(
    trace_id: Column, old: Column, new: Column, policy: Column, agent: Column
) -> Column:
    """SHA-256 linking a changed date to the trace that explains it; the trace must be named."""
    material = F.concat_ws("|", trace_id, old, new, policy, agent)
    blank = trace_id.isNull() | (F.trim(trace_id) == "")
    return F.when(blank, F.raise_error(F.lit("a trace id is required"))).otherwise(
        F.sha2(material, 256)
    )


def eu_record(
    policy: Column, trace_id: Column, tool: Column, old: Column, new: Column, agent: Column
) -> Column:
    """What a row under the EU policy keeps about its moved date; NULL under any other policy."""
    named = F.lower(tool)
    values = (
        reasoning_hash(trace_id, old, new, policy, agent),
        trace_id,
        F.when(named.isin(*EU_TOOLS), named).otherwise(EU_TOOLS[0]),
    )
    record = F.struct(*[value.alias(name) for name, value in zip(EU_COLUMNS, values)])
    return F.when(F.upper(policy) == "EU", record)


def shift_event_time(
    df: DataFrame,
    ts: str,
    hours: float,
    *,
    allowed: bool,
    policy: str = "",
    trace_id: str = "",
    tool: str = "langsmith",
    agent: str = "",
) -> DataFrame:
    """Move the event time when the policy decision allows it, and record why.

    The record's columns are NULL unless the policy is the EU's, whatever its case.
    """
    if not allowed:
        raise PermissionError(f"policy {policy!r} denies moving the event time by {hours} hours")
    moved = df.withColumn(ts, F.col(ts) + F.make_dt_interval(secs=F.lit(hours * 3600)))
    old = df.agg(F.min(ts).cast("string")).scalar()
    new = moved.agg(F.concat(F.min(ts).cast("string"), F.lit("+00:00"))).scalar()
    record = eu_record(F.lit(policy), F.lit(trace_id), F.lit(tool), old, new, F.lit(agent))
    return moved.withColumn("__eu", record).select(*moved.columns, "__eu.*")


def cast_complex_to_json(df: DataFrame, target: T.StructType) -> DataFrame:
    """Structs, maps and lists become JSON text where the target column is a string."""
    nested = (T.StructType, T.MapType, T.ArrayType)
    kinds = {f.name: f.dataType for f in df.schema}
    to_text = {
        f.name: F.to_json(f.name)
        for f in target
        if isinstance(f.dataType, T.StringType) and isinstance(kinds.get(f.name), nested)
    }
    return df.withColumns(to_text) if to_text else df


# Feature type names and the Spark types they are stored as.
FEATURE_TYPES: dict[str, T.DataType] = {
    "BYTES": T.BinaryType(),
    "PDF_BYTES": T.BinaryType(),
    "IMAGE_BYTES": T.BinaryType(),
    "STRING": T.StringType(),
    "INT32": T.IntegerType(),
    "INT64": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "BOOL": T.BooleanType(),
    "UNIX_TIMESTAMP": T.TimestampType(),
    "MAP": T.MapType(T.StringType(), T.StringType()),
    "JSON": T.StringType(),
}


def feature_type(name: str) -> T.DataType:
    """Spark type of a feature type name; ``_LIST`` and ``_SET`` give arrays."""
    for suffix in ("_LIST", "_SET"):
        if name.endswith(suffix):
            base = name.removesuffix(suffix)
            if suffix == "_SET" and base == "MAP":
                raise ValueError("a set of maps is not a feature type")
            return T.ArrayType(feature_type(base))
    if name not in FEATURE_TYPES:
        raise ValueError(f"{name} is not a feature type")
    return FEATURE_TYPES[name]


def feature_type_name(data_type: T.DataType) -> str:
    """Feature type name for a Spark column type, as found when a source is read."""
    if isinstance(data_type, T.ArrayType):
        return f"{feature_type_name(data_type.elementType)}_LIST"
    if isinstance(data_type, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
        raise ValueError("interval columns are not feature types")
    if isinstance(data_type, T.DecimalType):
        return "DOUBLE"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "UNIX_TIMESTAMP"
    if isinstance(data_type, (T.ShortType, T.ByteType)):
        return "INT32"
    if isinstance(data_type, T.StructType):
        return "STRUCT"
    for name, known in FEATURE_TYPES.items():
        if type(known) is type(data_type):
            return name
    return "NULL"


def convert_feature_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns to their declared feature types, lists element-wise; sets lose repeats."""
    casts = {}
    for column, name in types.items():
        if column in df.columns:
            target = feature_type(name)
            value = F.col(column).try_cast(target)
            casts[column] = F.array_distinct(value) if name.endswith("_SET") else value
    return df.withColumns(casts) if casts else df
