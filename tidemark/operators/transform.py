"""User transformations and on-demand views."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def transform_spark(df: DataFrame, function: Callable[..., DataFrame], *others: DataFrame):
    return function(df, *others)


def transform_spark_sql(function: Callable[..., str], *frames: DataFrame) -> DataFrame:
    """``function`` gets one name per frame and returns the query over those names."""
    named = {f"input_{i}": frame for i, frame in enumerate(frames)}
    text = function(*[f"{{{name}}}" for name in named])
    return frames[0].sparkSession.sql(text, **named)


def transform_pandas(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str
) -> DataFrame:
    """Stateless pandas function over Arrow batches."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(run, schema)


def transform_python(
    df: DataFrame, function: Callable[[dict[str, list]], dict[str, list]], schema: T.StructType
) -> DataFrame:
    """Function from a dict of column lists to another, over Arrow batches."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = function(batch.to_pydict())
            yield pa.RecordBatch.from_pydict({n: made[n] for n in arrow.names}, arrow)

    return df.mapInArrow(run, schema)


def transform_singleton(
    df: DataFrame, function: Callable[[dict], dict], schema: T.StructType
) -> DataFrame:
    """Function from one row as a dict to another, applied row by row inside Arrow batches."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [function(row) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return df.mapInArrow(run, schema)


def transform_on_write(
    df: DataFrame,
    function: Callable[[pd.DataFrame], pd.DataFrame],
    outputs: T.StructType,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Transform before a write, keeping the inputs the function does not replace.

    A batch whose row count stays keeps its rows in step.  Where the count
    changes, inputs are merged by ``keys``, which must not repeat in the batch.
    """
    made = outputs.fieldNames()
    kept = [f for f in df.schema if f.name not in made]

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        result = function(batch.copy())
        if len(result) == len(batch):
            columns = {n: result[n].to_numpy() for n in made}
            return pd.DataFrame({**columns, **{f.name: batch[f.name].to_numpy() for f in kept}})
        if not keys:
            raise ValueError("the row count changed; give the join keys")
        if batch.duplicated(list(keys)).any():
            raise ValueError("the row count changed and the join keys repeat")
        inputs = batch[[*keys, *(f.name for f in kept if f.name not in keys)]]
        return result.merge(inputs, on=list(keys), how="left")[[*made, *(f.name for f in kept)]]

    return transform_pandas(df, run, T.StructType([*outputs.fields, *kept]))


#: Kinds of on-demand views: a SQL expression for each output, or one function for all of them.
MODES = ("sql", "pandas", "python", "singleton")


@dataclass(frozen=True)
class OnDemandView:
    """Features computed at read time.

    ``inputs`` maps a view to the features needed from it, ``request`` names
    request-time columns.  In the mode ``sql`` ``outputs`` gives each feature as an
    expression.  In the others it gives each feature's type, and ``function`` makes
    them: from a pandas frame (``pandas``), from a dictionary of lists
    (``python``), or from one row as a dictionary (``singleton``).  A function finds
    its inputs as ``feature`` and as ``view__feature``, and returns as many rows.
    """

    name: str
    inputs: Mapping[str, Sequence[str]]
    outputs: Mapping[str, str]
    request: Sequence[str] = ()
    mode: str = "sql"
    function: Callable | None = None

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"mode {self.mode!r} is not one of {MODES}")
        if (self.function is None) != (self.mode == "sql"):
            raise ValueError(f"view {self.name!r}: a function goes with the modes {MODES[1:]} and with no other")

    def found_in(self, present: Collection[str]) -> dict[str, str]:
        """The name of each input, short and full, to the column that holds it."""
        names = {c: c for c in self.request}
        for source, features in self.inputs.items():
            for feature in features:
                full = f"{source}__{feature}"
                held = full if full in present else feature
                names[full] = held
                names[feature] = feature if feature in present else held
        return names

    def check(self, present: Collection[str]) -> None:
        missing = [c for c in self.request if c not in present]
        if missing:
            raise ValueError(f"request columns missing: {missing}")


def odfv_read(df: DataFrame, view: OnDemandView, full_names: bool = False) -> DataFrame:
    """Add a view's features; inputs can be named ``feature`` or ``view__feature``."""
    names = {o: f"{view.name}__{o}" if full_names else o for o in view.outputs}
    if view.mode != "sql":
        made = odfv_functions(df, [view])
        return made.withColumnsRenamed({f"{view.name}__{o}": n for o, n in names.items()})
    present = set(df.columns)
    view.check(present)
    alias = {n: F.col(held) for n, held in view.found_in(present).items() if n not in present and held in present}
    ready = df.withColumns(alias) if alias else df
    made = [F.expr(e).alias(names[o]) for o, e in view.outputs.items()]
    return ready.select(*df.columns, *made)


def odfv_functions(df: DataFrame, views: Sequence[OnDemandView]) -> DataFrame:
    """Add the features of function views as ``view__feature``, in the given order, in one Arrow stage.

    A later view reads what an earlier one made.  Values are cast to the declared
    types; a function that leaves out an output or changes the number of rows fails.
    """
    made = T.StructType()
    for view in views:
        view.check(df.columns)
        for output, kind in view.outputs.items():
            made = made.add(f"{view.name}__{output}", T.StructType.fromDDL(f"x {kind}")["x"].dataType)
    kinds = {f.name: f.type for f in to_arrow_schema(made)}
    whole = T.StructType([*df.schema.fields, *made.fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            for view in views:
                given = {n: columns[held] for n, held in view.found_in(columns).items()}
                result = _called(view, given, batch.num_rows)
                for output in view.outputs:
                    name = f"{view.name}__{output}"
                    columns[name] = _typed(view, output, result, kinds[name], batch.num_rows)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return df.mapInArrow(run, whole)


def _called(view: OnDemandView, given: dict[str, pa.Array], rows: int) -> Mapping:
    """What the view's function makes of a batch: a frame, or lists by output."""
    if view.mode == "pandas":
        return view.function(pd.DataFrame({n: a.to_pandas() for n, a in given.items()}, index=range(rows)))
    lists = {n: a.to_pylist() for n, a in given.items()}
    if view.mode == "python":
        return view.function(lists)
    each = [view.function({n: v[i] for n, v in lists.items()}) for i in range(rows)]
    missing = [o for o in view.outputs if any(o not in r for r in each)]
    return {o: [r[o] for r in each] for o in view.outputs if o not in missing}


def _typed(view: OnDemandView, output: str, result: Mapping, kind: pa.DataType, rows: int) -> pa.Array:
    if output not in result:
        raise ValueError(f"view {view.name!r} made no {output!r}")
    values = result[output]
    if len(values) != rows:
        raise ValueError(f"view {view.name!r} made {len(values)} rows of {output!r} from {rows}")
    made = pa.array(values, from_pandas=view.mode == "pandas") if rows else pa.array([], kind)
    if isinstance(made, pa.ChunkedArray):
        made = made.combine_chunks()
    return made.cast(kind)


def needed_features(
    requested: Sequence[str], views: Sequence[OnDemandView]
) -> tuple[list[str], list[OnDemandView]]:
    """Stored ``view:feature`` references behind a request, and the views to compute.

    An on-demand feature pulls in the inputs of its view, which may be
    on-demand themselves; views come back in an order that can be computed.
    """
    by_name = {v.name: v for v in views}
    stored: list[str] = []
    used: list[OnDemandView] = []

    def add(reference: str) -> None:
        name, feature = reference.split(":", 1)
        if name not in by_name:
            if reference not in stored:
                stored.append(reference)
            return
        view = by_name[name]
        for source, features in view.inputs.items():
            for needed in features:
                add(f"{source}:{needed}")
        if view not in used:
            used.append(view)

    for reference in requested:
        add(reference)
    return stored, used


def odfv_dependencies(
    retrieved: DataFrame,
    requested: Sequence[str],
    views: Sequence[OnDemandView],
    keep: Sequence[str],
) -> DataFrame:
    """Compute the on-demand features asked for and drop inputs nobody asked for.

    ``retrieved`` holds the stored features as ``view__feature``.  Views come in
    the order of their dependencies; neighbours with functions share a stage.
    """
    _, used = needed_features(requested, views)
    for functions, group in groupby(used, lambda v: v.mode != "sql"):
        if functions:
            retrieved = odfv_functions(retrieved, list(group))
            continue
        for view in group:
            retrieved = odfv_read(retrieved, view, full_names=True)
    asked = [r.replace(":", "__", 1) for r in requested]
    return retrieved.select(*keep, *asked)
