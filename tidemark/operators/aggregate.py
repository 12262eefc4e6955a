"""Grouped, windowed and metric aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.splits import micros, ordered_total
from tidemark.operators.windows import tie_break
from tidemark.session import cut_lineage
from tidemark.spec import Aggregation

# Aggregate names that differ from the function they mean.
FUNCTION_NAMES = {"mean": "avg", "std": "stddev_samp", "stddev": "stddev_samp",
                  "var": "var_samp", "variance": "var_samp", "nunique": "count_distinct"}


def aggregate_column(agg: Aggregation) -> Column:
    name = FUNCTION_NAMES.get(agg.function, agg.function)
    function = getattr(F, name, None)
    if function is None:
        raise ValueError(f"unknown aggregate {agg.function!r}")
    return function(agg.column)


def group_agg(df: DataFrame, keys: Sequence[str], aggs: Sequence[Aggregation]) -> DataFrame:
    """Aggregates per key, named ``function_column``; without keys one row for the table."""
    return df.groupBy(*keys).agg(*[aggregate_column(a).alias(a.alias) for a in aggs])


def windowed_agg(
    df: DataFrame, keys: Sequence[str], ts: str, aggs: Sequence[Aggregation]
) -> DataFrame:
    """One window size and slide with Spark's own time windows, by window end."""
    size, slide = aggs[0].window, aggs[0].hop
    window = F.window(ts, f"{size} seconds", f"{slide} seconds").alias("w")
    counted = df.groupBy(*keys, window).agg(*[aggregate_column(a).alias(a.alias) for a in aggs])
    return counted.select(
        *keys, F.col("w.end").alias("window_end"), *[a.alias for a in aggs]
    )


def odfv_aggregate(
    df: DataFrame, keys: Sequence[str], aggs: Sequence[Aggregation]
) -> DataFrame:
    """Aggregation of retrieved rows at read time, where time windows make no sense."""
    if any(a.window for a in aggs):
        raise ValueError("time windows cannot be aggregated at read time")
    return group_agg(df, keys, aggs)


def min_max_spine(spine: DataFrame, ts: str) -> DataFrame:
    return spine.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: Column,
    out: str,
    *,
    tie: Sequence[str] = (),
    rows_per_split: int | None = None,
) -> DataFrame:
    """Cumulative sum per key in time order, with splits carrying their totals on.

    Rows of one instant follow ``tie``, or all their columns where none is named.
    """
    order = [F.col("__us"), *(tie or tie_break(df, df.columns))]
    timed = df.withColumn("__us", micros(ts))
    return ordered_total(timed, keys, order, value, out, rows_per_split).drop("__us")


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive, to two places; 1.0 when there are no positives."""
    positives = F.count_if(F.col(label) == 1)
    negatives = F.count_if(F.col(label) == 0)
    weight = F.when(positives > 0, F.round(negatives / positives, 2)).otherwise(1.0)
    return df.agg(negatives.alias("neg"), positives.alias("pos"), weight.alias("weight"))


def confusion(label: str, predicted: str) -> dict[str, Column]:
    actual, said = F.col(label) == 1, F.col(predicted) == 1
    return {
        "tp": F.count_if(actual & said),
        "fp": F.count_if(~actual & said),
        "fn": F.count_if(actual & ~said),
        "tn": F.count_if(~actual & ~said),
    }


def precision_recall(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """Zero where the denominator is zero."""

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)

    return {
        "precision": share(tp, tp + fp),
        "recall": share(tp, tp + fn),
        "f1": share(2 * tp, 2 * tp + fp + fn),
    }


def roc_auc(df: DataFrame, label: str, score: str, rows_per_split: int | None = None) -> DataFrame:
    """Exact area under the ROC curve, ties counted half.

    Rows collapse to one per distinct score; the negatives below a score come
    from a running total over score splits, so no task sees the whole curve.
    """
    scores = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    ranked = ordered_total(cut_lineage(scores), [], ["score"], F.col("neg"), "neg_upto", rows_per_split)
    wins = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.agg((wins / F.when(pairs > 0, pairs)).alias("roc_auc"))


def eval_metrics(
    df: DataFrame, label: str, score: str, threshold: float = 0.5, rows_per_split: int | None = None
) -> DataFrame:
    """roc_auc, f1, precision and recall in one row."""
    judged = df.select(
        F.col(label).alias("actual"), (F.col(score) >= threshold).cast("int").alias("said")
    )
    counts = judged.agg(*[c.alias(n) for n, c in confusion("actual", "said").items()])
    rates = precision_recall(F.col("tp"), F.col("fp"), F.col("fn"))
    return counts.select(
        roc_auc(df, label, score, rows_per_split).scalar().alias("roc_auc"),
        rates["f1"].alias("f1"),
        rates["precision"].alias("precision"),
        rates["recall"].alias("recall"),
    )


def class_report(df: DataFrame, label: str, predicted: str, classes: Sequence) -> DataFrame:
    """Share, precision and recall of each class, in one pass."""
    rows = F.count(F.lit(1))
    entries = []
    for value in classes:
        actual, said = F.col(label) == value, F.col(predicted) == value
        tp, fp = F.count_if(actual & said), F.count_if(~actual & said)
        fn = F.count_if(actual & ~said)
        rates = precision_recall(tp, fp, fn)
        entries.append(
            F.struct(
                F.lit(value).alias("label"),
                (tp + fn).alias("support"),
                ((tp + fn) / rows).alias("share"),
                (rows / (len(classes) * (tp + fn))).alias("weight"),
                *[c.alias(n) for n, c in rates.items()],
            )
        )
    return df.agg(F.array(*entries).alias("r")).select(F.inline("r"))


def registry_counts(objects: DataFrame, kind: str) -> DataFrame:
    return objects.groupBy(kind).agg(F.count(F.lit(1)).alias("objects"))


def tag_popularity(objects: DataFrame, tags: str, top: int) -> DataFrame:
    """Most used tags of a map column, name breaking ties."""
    pairs = objects.select(F.explode(tags).alias("tag", "value"))
    used = pairs.groupBy("tag", "value").agg(F.count(F.lit(1)).alias("uses"))
    return used.orderBy(F.desc("uses"), "tag", "value").limit(top)


