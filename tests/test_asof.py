"""Point-in-time joins against a row-by-row search."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, materialize, windows
from tidemark.spec import ViewSpec

BASE = dt.datetime(2024, 1, 1)
SPINE = "id long, k string, at timestamp_ntz"
FEATURES = "k string, ts timestamp_ntz, created timestamp_ntz, v long"


def brute(spine, features, ttl, use_key=True):
    found = []
    for row in spine:
        best = None
        for key, ts, created, value in features:
            if row[2] is None or ts is None or (use_key and (key is None or key != row[1])):
                continue
            if ts > row[2] or (ttl and ts < row[2] - dt.timedelta(seconds=ttl)):
                continue
            rank = (ts, created or dt.datetime.min, value)
            if best is None or rank > best[0]:
                best = (rank, value)
        found.append((*row, best[1] if best else None))
    return sorted(found, key=repr)


def make(seed, hot):
    """Random rows, a third of them or more on one key, with ties, NULLs and exact matches."""
    rng = random.Random(seed)

    def key():
        return "hot" if rng.random() < hot else rng.choice(["a", "b", "c", "only-spine", None])

    def at(span):
        return BASE + dt.timedelta(minutes=rng.randrange(span))

    spine = [(i, key(), at(400) if rng.random() > 0.02 else None) for i in range(150)]
    features = []
    for number in range(300):
        k = key()
        if k == "only-spine":
            k = "a"
        ts = at(400) if rng.random() > 0.02 else None
        created = at(9) if rng.random() > 0.1 else None
        features.append((k, ts, created, number))
        if rng.random() < 0.2:
            features.append((k, ts, at(9), number + 1000))
    return spine, features


VIEW = ViewSpec("view", ["k"], ["v"], "ts", "created", ttl=3600)


@pytest.mark.parametrize("ttl", [0, 60, 3600])
@pytest.mark.parametrize("rows_per_split", [None, 40, 7])
def test_matches_brute_force(spark, ttl, rows_per_split):
    spine, features = make(ttl + (rows_per_split or 1), 0.5)
    view = ViewSpec("view", ["k"], ["v"], "ts", "created", ttl=ttl)
    got = asof.pit_join(
        spark.createDataFrame(spine, SPINE),
        spark.createDataFrame(features, FEATURES),
        view,
        "at",
        rows_per_split=rows_per_split,
    )
    assert sorted(map(tuple, got.collect()), key=repr) == brute(spine, features, ttl)


@pytest.mark.parametrize("minutes", [5, 60, 100_000])
def test_fixed_windows_lose_nothing_at_their_borders(spark, minutes):
    spine, features = make(3, 0.4)
    view = ViewSpec("view", ["k"], ["v"], "ts", "created")
    got = asof.windowed_asof(
        spark.createDataFrame(spine, SPINE),
        spark.createDataFrame(features, FEATURES),
        view,
        "at",
        window_seconds=minutes * 60,
    )
    assert sorted(map(tuple, got.collect()), key=repr) == brute(spine, features, 0)


@pytest.mark.parametrize("rows_per_split", [None, 25])
def test_without_keys(spark, rows_per_split):
    spine, features = make(4, 0.4)
    view = ViewSpec("view", [], ["v"], "ts", "created", ttl=600)
    got = asof.pit_join(
        spark.createDataFrame(spine, SPINE),
        spark.createDataFrame(features, FEATURES),
        view,
        "at",
        rows_per_split=rows_per_split,
    )
    assert sorted(map(tuple, got.collect()), key=repr) == brute(spine, features, 600, use_key=False)


@pytest.mark.parametrize("max_versions", [512, 3])
def test_broadcast_form_and_its_fallback(spark, max_versions):
    spine, features = make(5, 0.4)
    got = asof.broadcast_asof(
        spark.createDataFrame(spine, SPINE),
        spark.createDataFrame(features, FEATURES),
        VIEW,
        "at",
        max_versions=max_versions,
    )
    assert sorted(map(tuple, got.collect()), key=repr) == brute(spine, features, 3600)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (max_versions == 512)


def test_one_instant_holding_most_rows_is_collapsed(spark):
    same = BASE + dt.timedelta(hours=2)
    spine = [(i, "hot", same) for i in range(200)] + [(900, "a", same), (901, None, same)]
    features = [("hot", same, BASE + dt.timedelta(seconds=i), i) for i in range(200)]
    features += [("a", BASE, None, 7)]
    view = ViewSpec("view", ["k"], ["v"], "ts", "created")
    got = asof.pit_join(
        spark.createDataFrame(spine, SPINE),
        spark.createDataFrame(features, FEATURES),
        view,
        "at",
        rows_per_split=20,
    )
    assert sorted(map(tuple, got.collect()), key=repr) == brute(spine, features, 0)
    assert {r.v for r in got.filter("k = 'hot'").collect()} == {199}


def test_ttl_bounds_are_inclusive(spark):
    at = BASE + dt.timedelta(days=1)
    spine = [(1, "a", at), (2, "b", at), (3, "c", at)]
    features = [
        ("a", at - dt.timedelta(seconds=3600), None, 1),
        ("b", at - dt.timedelta(seconds=3601), None, 2),
        ("c", at, None, 3),
    ]
    got = asof.pit_join(
        spark.createDataFrame(spine, SPINE), spark.createDataFrame(features, FEATURES), VIEW, "at"
    )
    assert {r.id: r.v for r in got.collect()} == {1: 1, 2: None, 3: 3}


def test_composite_keys_do_not_run_together(spark):
    spine = spark.createDataFrame(
        [("1", "23", BASE), ("12", "3", BASE)], "a string, b string, at timestamp_ntz"
    )
    features = spark.createDataFrame(
        [("1", "23", BASE, 1), ("12", "3", BASE, 2)], "a string, b string, ts timestamp_ntz, v long"
    )
    view = ViewSpec("view", ["a", "b"], ["v"], "ts")
    got = asof.pit_join(spine, features, view, "at")
    assert {(r.a, r.b): r.v for r in got.collect()} == {("1", "23"): 1, ("12", "3"): 2}


def test_same_view_under_two_keys(spark):
    spine = spark.createDataFrame([(1, "x", "y", BASE)], "id long, a string, b string, at timestamp")
    features = spark.createDataFrame([("x", BASE, 1), ("y", BASE, 2)], "k string, ts timestamp, v long")
    view = ViewSpec("v", ["k"], ["v"], "ts")
    got = asof.pit_join_multi(
        spine,
        [(features, view.under("from", {"k": "a"})), (features, view.under("to", {"k": "b"}))],
        "at",
    ).first()
    assert (got["from__v"], got["to__v"]) == (1, 2)


@pytest.mark.parametrize("rows_per_split", [None, 30])
def test_views_sharing_keys_share_one_shuffle(spark, rows_per_split):
    spine, first = make(11, 0.5)
    _, second = make(12, 0.2)
    left = spark.createDataFrame(spine, SPINE)
    views = [
        (spark.createDataFrame(first, FEATURES), ViewSpec("a", ["k"], ["v"], "ts", "created", ttl=900)),
        (spark.createDataFrame(second, FEATURES), ViewSpec("b", ["k"], ["v"], "ts", "created")),
        (spark.createDataFrame(first, FEATURES), ViewSpec("c", [], ["v"], "ts", "created", ttl=60)),
    ]
    got = asof.pit_join_multi(left, views, "at", rows_per_split=rows_per_split)
    assert got.columns == ["id", "k", "at", "a__v", "b__v", "c__v"]
    found = {r.id: (r.a__v, r.b__v, r.c__v) for r in got.collect()}
    a, b, c = (
        {r[0]: r[3] for r in brute(spine, rows, ttl, keyed)}
        for rows, ttl, keyed in ((first, 900, True), (second, 0, True), (first, 60, False))
    )
    assert found == {i: (a[i], b[i], c[i]) for i in a}
    if rows_per_split is None:
        plan = asof.pit_join_multi(left, views[:2], "at")._jdf.queryExecution().executedPlan()
        assert plan.toString().count("Exchange") == 1


def test_map_features_and_matched_time(spark):
    spine = spark.createDataFrame([(1, BASE)], "k long, at timestamp_ntz")
    features = spark.createDataFrame(
        [(1, BASE - dt.timedelta(hours=1), {"a": "b"})], "k long, ts timestamp_ntz, m map<string,string>"
    )
    view = ViewSpec("v", ["k"], ["m"], "ts")
    got = asof.pit_join(spine, features, view, "at", feature_ts_as="seen").first()
    assert got["m"] == {"a": "b"} and got["seen"] == BASE - dt.timedelta(hours=1)


def test_names_that_collide_are_refused(spark):
    spine = spark.createDataFrame([(1, "a", BASE)], "v long, k string, at timestamp_ntz")
    features = spark.createDataFrame([("a", BASE, None, 1)], FEATURES)
    with pytest.raises(ValueError):
        asof.pit_join(spine, features, VIEW, "at")


def test_no_spine(spark):
    rows = [("a", BASE, 1), ("b", BASE - dt.timedelta(days=40), 2), (None, BASE, 3)]
    features = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v long")
    end = F.lit(BASE + dt.timedelta(days=1)).cast("timestamp_ntz")
    view = ViewSpec("v", ["k"], ["v"], "ts")
    got = asof.non_entity_retrieval([(features, view)], None, end)
    assert {(r.k, r.v__v) for r in got.collect()} == {("a", 1), (None, None)}
    kept = asof.non_entity_retrieval([(features, view)], F.lit(BASE), end, keep_ts=True)
    assert {(r.k, r.entity_ts) for r in kept.collect()} == {("a", BASE), (None, BASE)}


def test_empty_sides(spark):
    spine = spark.createDataFrame([], SPINE)
    features = spark.createDataFrame([("a", BASE, None, 1)], FEATURES)
    assert asof.pit_join(spine, features, VIEW, "at").count() == 0
    one = spark.createDataFrame([(1, "a", BASE)], SPINE)
    got = asof.pit_join(one, features.limit(0), VIEW, "at").collect()
    assert [r.v for r in got] == [None]


def test_time_bounds_reach_the_scan(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    spine = events.filter("event_type = 'purchase' and ts < '2024-01-03'").select(
        "user_id", F.col("ts").alias("at")
    )
    view = ViewSpec("v", ["user_id"], ["value"], "ts", ttl=3600)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    got = asof.pit_join(spine, events.filter("event_type = 'click'"), view, "at")
    plan = got._jdf.queryExecution().executedPlan().toString().split("\n")
    scans = [line for line in plan if "ReadSchema" in line]
    assert scans and not any("props" in line for line in scans)
    click = [line for line in scans if "click" in line]
    assert click and all("GreaterThanOrEqual(ts" in line for line in click)
    assert all("LessThanOrEqual(ts" in line for line in click)


@pytest.fixture(scope="module")
def by_day(spark, tmp_path_factory):
    """30 days of one row a day and key, the source's names being other than the view's."""
    path = str(tmp_path_factory.mktemp("by_day") / "t")
    days = spark.range(60).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("key"),
        F.expr("TIMESTAMP_NTZ '2024-01-01 12:00:00' + make_dt_interval(id div 2)").alias("at"),
        F.col("id").alias("raw"),
    )
    days.withColumn("day", F.date_format("at", "yyyy-MM-dd")).write.partitionBy("day").parquet(path)
    renames = {"key": "k", "at": "ts", "raw": "v"}
    return path, ViewSpec("x", ["k"], ["v"], "ts", ttl=3 * 86400, renames=renames, partition="day")


def partition_filters(df):
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [line for line in plan.splitlines() if "PartitionFilters" in line and "day" in line]


def test_renamed_view_laid_out_by_day(spark, by_day):
    path, view = by_day
    source = spark.read.parquet(path)
    rows = [(1, "a", BASE + dt.timedelta(days=20)), (2, "b", BASE + dt.timedelta(days=40)), (3, None, BASE)]
    spine = spark.createDataFrame(rows, SPINE)
    got = asof.pit_join(spine, source, view, "at")
    assert {r.id: r.v for r in got.collect()} == {1: 38, 2: None, 3: None}
    assert partition_filters(got)
    wide = asof.broadcast_asof(spine, source, view, "at")
    assert {r.id: r.v for r in wide.collect()} == {1: 38, 2: None, 3: None}
    assert asof.pit_join(spine.limit(0), source, view, "at").collect() == []


def test_newest_rows_of_a_view_laid_out_by_day(spark, by_day):
    path, view = by_day
    source = spark.read.parquet(path)
    start, end = (F.lit(f"2024-01-{day}").cast("timestamp_ntz") for day in ("03", "11"))
    newest = windows.latest_per_key(source, view, start, end)
    assert {r.k: r.v for r in newest.collect()} == {"a": 18, "b": 19}
    assert partition_filters(newest)
    stored = materialize.materialize(source, view, start, end)
    assert {r.k: r.v for r in stored.collect()} == {"a": 18, "b": 19}
    assert partition_filters(stored)
    spine = asof.non_entity_spine([(source, view)], start, end)
    assert spine.count() == 2 and partition_filters(spine)
