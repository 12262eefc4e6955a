"""Column profiles by day, kept as sketches that merge, so a new day rereads no old one.

A day's profile of a column is one row: counts, least and greatest value, a sketch
of distinct values (HyperLogLog) and one of quantiles (KLL).  Any range of days is
the merge of its rows: counts and extremes are exact, distinct counts and ranks
within the bounds below, however many days are merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import Expectation

#: Sizes of the sketches, and bounds that their errors keep: relative for distinct counts, a share of the rows for ranks.
DISTINCT_LG, RANK_K = 14, 1000
DISTINCT_ERROR, RANK_ERROR = 0.03, 0.01
DAY = "profile_day"


def _profile(column: str, numeric: bool) -> Column:
    value = F.col(f"`{column}`")
    number = value.cast("double") if numeric else F.lit(None).cast("double")
    return F.struct(
        F.lit(column).alias("name"),
        F.count(F.lit(1)).alias("rows"),
        F.count(value).alias("present"),
        F.min(number).alias("low"),
        F.max(number).alias("high"),
        F.hll_sketch_agg(value.cast("string"), DISTINCT_LG).alias("distinct_sketch"),
        F.kll_sketch_agg_double(number, RANK_K).alias("rank_sketch"),
    )


class ProfileStore:
    """Profiles of the columns of one table, in one folder for each day."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, df: DataFrame, day: Column, columns: Sequence[str]) -> None:
        """Profile the days that ``df`` holds; only their folders are written, whatever was in them is replaced."""
        kinds = {f.name: f.dataType for f in df.schema}
        entries = [_profile(c, isinstance(kinds[c], T.NumericType)) for c in columns]
        days = df.groupBy(F.date_format(day, "yyyy-MM-dd").alias(DAY)).agg(F.array(*entries).alias("p"))
        rows = days.where(F.col(DAY).isNotNull()).select(F.inline("p"), DAY)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(DAY).parquet(self.path)

    def days(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def merged(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """One row per column over the days from ``first`` to ``last`` (``yyyy-MM-dd``); other folders aren't opened."""
        rows = self.days().withColumn(DAY, F.col(DAY).cast("string"))
        if first is not None:
            rows = rows.filter(F.col(DAY) >= first)
        if last is not None:
            rows = rows.filter(F.col(DAY) <= last)
        held = F.when(F.kll_sketch_get_n_double("rank_sketch") > 0, F.col("rank_sketch"))
        return rows.groupBy("name").agg(
            F.sum("rows").alias("rows"),
            F.sum("present").alias("present"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
            F.kll_merge_agg_double(held, RANK_K).alias("rank_sketch"),
        )

    def counts(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Rows, NULLs, about how many values, and whether all rows have one value, per column."""
        values = F.hll_sketch_estimate("distinct_sketch")
        nulls = F.col("rows") - F.col("present")
        constant = (F.col("present") == 0) | (nulls == 0) & (values <= 1)
        return self.merged(first, last).select(
            "name", "rows", nulls.alias("nulls"), values.alias("distinct"), constant.alias("constant")
        )

    def quantiles(
        self, ranks: Sequence[float], first: str | None = None, last: str | None = None
    ) -> dict[str, list[float] | None]:
        """Values at the given ranks of each numeric column, within ``RANK_ERROR`` of the rows."""
        values = F.kll_sketch_get_quantile_double("rank_sketch", F.array(*[F.lit(float(r)) for r in ranks]))
        any_rows = F.coalesce(F.kll_sketch_get_n_double("rank_sketch"), F.lit(0)) > 0
        rows = self.merged(first, last).select("name", F.when(any_rows, values).alias("values"))
        return {r["name"]: r["values"] and list(r["values"]) for r in rows.collect()}  # a row per column

    def fill_null_median(self, df: DataFrame, columns: Sequence[str], first: str | None = None, last: str | None = None) -> DataFrame:
        """Fill NULLs with the medians of the profiled days, without reading those days' rows."""
        found = self.quantiles([0.5], first, last)
        known = {c: found[c][0] for c in columns if found.get(c)}
        return df.fillna(known) if known else df

    def learn_suite(
        self, columns: Sequence[str], slack: float = 0.0, first: str | None = None, last: str | None = None
    ) -> list[Expectation]:
        """Bounds seen on the profiled days, as checks for other rows."""
        seen = {r["name"]: r for r in self.merged(first, last).select("name", "low", "high").collect()}
        suite = []
        for column in columns:
            low, high = (seen[column]["low"], seen[column]["high"]) if column in seen else (None, None)
            if low is None:
                continue
            margin = slack * (high - low)
            suite.append(Expectation("between", column, low=low - margin, high=high + margin))
            suite.append(Expectation("max_between", column, high=high + margin))
            suite.append(Expectation("min_between", column, low=low - margin))
        return suite
