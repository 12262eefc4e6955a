import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregate, clean
from tidemark.operators.splits import (
    ordered_total,
    quantile_edges,
    row_index,
    running_total,
    split_count,
    with_split,
)


def test_equal_values_share_a_split(spark):
    df = spark.range(1000).select((F.col("id") % 50).alias("v"))
    edges, tied = quantile_edges(10, (df, F.col("v")))
    placed = with_split(df, "v", edges, "s")
    assert not tied
    assert placed.groupBy("v").agg(F.countDistinct("s").alias("n")).filter("n > 1").count() == 0
    assert placed.groupBy("s").count().agg(F.max("count")).first()[0] <= 200


def test_a_value_filling_a_split_is_reported(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 5).otherwise(F.col("id")).alias("v"))
    assert quantile_edges(20, (df, F.col("v")))[1]
    assert not quantile_edges(2, (spark.range(1000), F.col("id")))[1]


@pytest.mark.parametrize("count", [1, 3, 16])
def test_running_total_over_a_hot_key(spark, count):
    rng = random.Random(count)
    rows = [(i, None if i % 7 == 0 else ("hot" if rng.random() < 0.7 else "x"), i * 3 % 11) for i in range(500)]
    df = spark.createDataFrame(rows, "i long, k string, v long")
    edges, _ = quantile_edges(count, (df, F.col("i")))
    placed = with_split(df, "i", edges, "s")
    got = running_total(placed, ["k"], "s", ["i"], F.col("v"), "total")
    want, sums = {}, {}
    for i, k, v in rows:
        sums[k] = sums.get(k, 0) + v
        want[i] = sums[k]
    assert {r.i: r.total for r in got.collect()} == want


@pytest.mark.parametrize("rows_per_split", [None, 20])
def test_row_index_of_strings(spark, rows_per_split):
    words = ["".join(p) for p in itertools.product("aäz€𝄞", repeat=3)] + ["", "a", "Name#1"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: r.n for r in row_index(df, "w", "n", rows_per_split).collect()}
    assert got == {w: n for n, w in enumerate(sorted(words, key=lambda w: w.encode()))}


def test_row_index_with_a_long_shared_prefix(spark):
    df = spark.range(300).select(F.format_string("Customer#%06d", "id").alias("w"))
    got = {r.w: r.n for r in row_index(df, "w", "n", 50).collect()}
    assert got == {f"Customer#{i:06d}": i for i in range(300)}


def test_row_index_of_addresses(spark):
    df = spark.range(3000).select(F.format_string("http%s://host/%06d", F.when(F.col("id") % 2 == 0, "s").otherwise(""), "id").alias("w"))
    numbered = ordered_total(df, [], ["w"], F.lit(1), "n", 100)
    ordered = sorted(r.w for r in df.collect())
    assert {r.w: r.n - 1 for r in numbered.collect()} == {w: n for n, w in enumerate(ordered)}
    dealt = df.repartitionByRange(30, "w").groupBy(F.spark_partition_id()).count()
    assert dealt.agg(F.max("count")).first()[0] <= 300


def test_half_of_the_rows_at_one_instant(spark):
    df = spark.range(2000).select(
        "id", F.timestamp_seconds(F.when(F.col("id") < 1000, 500).otherwise(F.col("id"))).alias("ts")
    )
    got = aggregate.running_sum(df, [], "ts", F.col("id"), "t", rows_per_split=100)
    assert {r.id: r.t for r in got.collect()} == {i: i * (i + 1) // 2 for i in range(2000)}


def test_running_sum_by_time(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    one = aggregate.running_sum(events, ["event_type"], "ts", F.col("event_id"), "t")
    many = aggregate.running_sum(
        events, ["event_type"], "ts", F.col("event_id"), "t", rows_per_split=50
    )
    a = {r.event_id: r.t for r in one.collect()}
    assert a == {r.event_id: r.t for r in many.collect()} and len(a) == events.count()


def test_split_count():
    assert split_count(0, None) == 1
    assert split_count(100, 10) == 10
    assert split_count(10**12, 2_000_000) == 500_000


@pytest.mark.parametrize("kind", ["even", "odd", "ties", "skewed"])
def test_bracketed_median(spark, kind):
    rng = random.Random(kind)
    values = [rng.uniform(0, 1000) for _ in range(2001 if kind == "odd" else 2000)]
    if kind == "ties":
        values = [float(round(v / 250)) for v in values]
    if kind == "skewed":
        values = [0.0 if v < 400 else v for v in values]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 50, "v double")
    ordered = sorted(values)
    n = len(ordered)
    want = (ordered[(n - 1) // 2] + ordered[n // 2]) / 2
    assert clean.exact_medians(df, ["v"])["v"] == want


@pytest.mark.parametrize("rows_per_split", [None, 10])
def test_auc_with_ties(spark, rows_per_split):
    rng = random.Random(1)
    rows = [(rng.randrange(2), rng.randrange(40) / 40) for _ in range(300)]
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    wins = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
    df = spark.createDataFrame(rows, "y int, s double")
    got = aggregate.roc_auc(df, "y", "s", rows_per_split).first()[0]
    assert got == pytest.approx(wins / (len(pos) * len(neg)))
