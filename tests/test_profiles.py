"""Profiles of days merged, against the whole table."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import profiles
from tidemark.operators.profiles import DAY, DISTINCT_ERROR, RANK_ERROR, ProfileStore
from tidemark.session import fresh_path

BASE = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    made = []
    for i in range(6000):
        day = 0 if rnd.random() < 0.4 else rnd.randrange(10)  # one day has almost half
        value = None if rnd.random() < 0.1 else rnd.gauss(day, 3)
        made.append((BASE + dt.timedelta(days=day, hours=i % 24), value, rnd.randrange(4000), "x", None, rnd.choice(["a", "b", None])))
    return made


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp, v double, n long, one string, none double, s string")


COLUMNS = ["v", "n", "one", "none", "s"]


@pytest.fixture(scope="module")
def store(spark, frame):
    """Days come one after the other, one of them twice."""
    made = ProfileStore(spark, fresh_path(spark, "profiles"))
    for day in (*range(10), 3):
        made.add(frame.where(F.datediff("ts", F.lit(BASE)) == day), F.col("ts"), COLUMNS)
    return made


def test_merged_days_equal_the_whole(store, rows):
    found = {r.name: r for r in store.merged().collect()}
    for at, name in enumerate(COLUMNS, 1):
        values = [r[at] for r in rows if r[at] is not None]
        assert (found[name].rows, found[name].present) == (len(rows), len(values))
        if name in ("v", "n"):
            assert (found[name].low, found[name].high) == (min(values), max(values))
    counts = {r.name: r for r in store.counts().collect()}
    assert [counts[c].constant for c in COLUMNS] == [False, False, True, True, False]
    for at, name in enumerate(COLUMNS, 1):
        distinct = len({r[at] for r in rows if r[at] is not None})
        assert abs(counts[name].distinct - distinct) <= DISTINCT_ERROR * distinct
        assert counts[name].nulls == sum(r[at] is None for r in rows)


def test_quantiles_keep_their_bound(store, rows):
    ranks = [0.01, 0.25, 0.5, 0.75, 0.99]
    found = store.quantiles(ranks)
    assert found["none"] is None and found["one"] is None
    for at, name in ((1, "v"), (2, "n")):
        values = sorted(r[at] for r in rows if r[at] is not None)
        for rank, value in zip(ranks, found[name], strict=True):
            low, high = sum(v < value for v in values), sum(v <= value for v in values)
            assert low / len(values) - RANK_ERROR <= rank <= high / len(values) + RANK_ERROR


def test_a_range_of_days_opens_its_folders_only(store, rows):
    part = store.merged("2024-01-03", "2024-01-05")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert DAY in plan.split("PartitionFilters: [")[1].split("]")[0]
    inside = [r for r in rows if 2 <= (r[0] - BASE).days <= 4]
    assert {r.name: r.rows for r in part.collect()} == dict.fromkeys(COLUMNS, len(inside))
    assert store.merged("2030-01-01").count() == 0


def test_a_new_day_writes_its_folder_only(spark, frame, store):
    before = {f: None for f in store.days().inputFiles()}
    store.add(frame.limit(7).withColumn("ts", F.lit(BASE + dt.timedelta(days=40))), F.col("ts"), COLUMNS)
    after = set(store.days().inputFiles())
    assert set(before) < after and all(f"{DAY}=2024-02-10" in f for f in after - set(before))
    assert store.merged("2024-02-10").where("name = 'n'").first().rows == 7


def test_fills_and_suites_from_stored_days(spark, store, rows):
    df = spark.createDataFrame([(None, None), (1.0, 2.0)], "v double, none double")
    filled = store.fill_null_median(df, ["v", "none"], "2024-01-01", "2024-01-10").collect()
    values = sorted(r[1] for r in rows if r[1] is not None)
    mid = len(values) / 2
    assert abs(sum(v < filled[0].v for v in values) - mid) <= RANK_ERROR * len(values) + 1
    assert filled[0].none is None and tuple(filled[1]) == (1.0, 2.0)
    suite = store.learn_suite(["v", "none", "nowhere"], 0.5, last="2024-01-31")
    assert [(c.kind, c.column) for c in suite] == [("between", "v"), ("max_between", "v"), ("min_between", "v")]
    margin = 0.5 * (values[-1] - values[0])
    assert (suite[0].low, suite[0].high) == (values[0] - margin, values[-1] + margin)
    assert profiles.RANK_K >= 1000
