"""Splits, training and batch scoring on Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.aggregate import class_weight
from tidemark.operators.splits import ordered_total
from tidemark.session import cut_lineage

#: Bins of a feature, those of Spark's trees.
BINS = 32


def stratified_split(
    df: DataFrame, id_col: str, label: str, test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Mark the rounded ``test_size`` share of each label as test rows.

    Rows are ordered by a seeded hash of their id, which is uniform and so splits
    any label evenly, however many rows the label has.
    """
    digest = F.sha2(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))), 256)
    hashed = df.withColumn("__hash", digest)
    placed = ordered_total(hashed, [label], ["__hash", id_col], F.lit(1), "__place")
    sizes = df.groupBy(F.col(label).alias("__label")).agg(F.count("*").alias("__size"))
    joined = placed.join(sizes, F.col(label).eqNullSafe(F.col("__label")))
    quota = F.floor(F.col("__size") * test_size + 0.5)
    return joined.withColumn("is_test", F.col("__place") <= quota).select(*df.columns, "is_test")


def train_classifier(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    *,
    depth: int = 6,
    rounds: int = 200,
    learning_rate: float = 0.1,
    seed: int = 42,
) -> PipelineModel:
    """Boosted trees with positives weighted by the negative to positive ratio.

    Trees only see the bin of a numeric feature, so rows that agree on the label and on
    every bin are trained on as one row with their number as weight: all rows count,
    and a round takes time by the cells that occur, not by the rows.  Bins are part of
    the model.
    """
    weight = class_weight(train, label).first()["weight"]
    kinds = {f.name: f.dataType for f in train.schema}
    numeric = [c for c in features if isinstance(kinds[c], T.NumericType)]
    inputs = [f"__bin_{c}" if c in numeric else c for c in features]
    binned = train
    stages: list[Transformer] = []
    if numeric:
        edges = _bin_edges(train, numeric)
        bins = Bucketizer(
            splitsArray=[edges[c] for c in numeric],
            inputCols=numeric,
            outputCols=[f"__bin_{c}" for c in numeric],
            handleInvalid="keep",  # NaN has a bin of its own, the last
        )
        stages, binned = [bins], bins.transform(train)
    weighted = binned.groupBy(label, *dict.fromkeys(inputs)).agg(F.count("*").alias("__rows"))
    weighted = cut_lineage(weighted.withColumn("__weight", F.when(F.col(label) == 1, weight).otherwise(1.0) * F.col("__rows")))
    assembler = VectorAssembler(inputCols=inputs, outputCol="__x", handleInvalid="keep")
    trees = GBTClassifier(
        featuresCol="__x",
        labelCol=label,
        weightCol="__weight",
        maxDepth=depth,
        maxIter=rounds,
        stepSize=learning_rate,
        seed=seed,
    )
    fitted = Pipeline(stages=[assembler, trees]).fit(weighted)
    return PipelineModel([*stages, *fitted.stages])


def _bin_edges(df: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    """Edges of each column's bins: its values where they are few, else quantiles of all rows.

    One bin is left for NaN; NULL is refused in training, as before binning.
    """
    whole = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns}
    steps = [i / (BINS - 1) for i in range(1, BINS - 1)]
    found = df.agg(
        *(F.approx_count_distinct(whole[c]).alias(f"n_{i}") for i, c in enumerate(columns)),
        *(F.percentile_approx(whole[c], steps).alias(f"q_{i}") for i, c in enumerate(columns)),
    ).first()
    edges = {}
    for i, c in enumerate(columns):
        values = found[f"q_{i}"] or []
        if found[f"n_{i}"] <= 2 * BINS:  # few values, so all of them come back
            own = [r[0] for r in df.select(whole[c].alias("v")).where("v is not null").distinct().collect()]
            values = sorted(own)[1:] if len(own) < BINS else values
        inner = sorted({float(v) for v in values if abs(v) != float("inf")})
        edges[c] = [float("-inf"), *(inner or [0.0]), float("inf")]
    return edges


def probability(model: Transformer, df: DataFrame, out: str = "probability_1") -> DataFrame:
    """Probability of class 1 next to the rows scored."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(out))


def encode_features(
    df: DataFrame, numeric: Sequence[str], categories: Mapping[str, Mapping[str, int]]
) -> DataFrame:
    """Model inputs: missing numbers are 0, categories go by a fixed map, unknown ones are 0."""
    encoded = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric}
    for column, codes in categories.items():
        value = F.lit(0.0)
        for name, code in codes.items():
            value = F.when(F.col(column) == name, float(code)).otherwise(value)
        encoded[column] = value
    return df.withColumns(encoded)


def batch_predict(
    requests: DataFrame,
    latest: DataFrame,
    keys: Sequence[str],
    model: Transformer | Column,
    numeric: Sequence[str],
    categories: Mapping[str, Mapping[str, int]],
    threshold: float = 0.5,
) -> DataFrame:
    """Score requested keys on their stored features.

    ``model`` is a fitted classifier or an expression over the encoded columns.
    The prediction uses the full probability; the one returned has four places.
    """
    stored = requests.join(latest.select(*keys, *numeric, *categories), list(keys), "left")
    inputs = encode_features(stored, numeric, categories)
    if isinstance(model, Column):
        scored = inputs.withColumn("__p", model)
    else:
        scored = probability(model, inputs, "__p")
    return scored.select(
        *requests.columns,
        F.round("__p", 4).alias("probability"),
        F.when(F.col("__p") >= threshold, 1).otherwise(0).alias("prediction"),
    )


def ordinal_encode(
    df: DataFrame, categories: Sequence[str], numeric: Sequence[str]
) -> PipelineModel:
    """Fitted pipeline: categories to ordinals in name order, numbers passed through."""
    indexer = StringIndexer(
        inputCols=list(categories),
        outputCols=[f"{c}_index" for c in categories],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )
    assembler = VectorAssembler(
        inputCols=[*[f"{c}_index" for c in categories], *numeric], outputCol="features"
    )
    return Pipeline(stages=[indexer, assembler]).fit(df)
