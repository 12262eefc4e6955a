import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregate, tiles
from tidemark.spec import Aggregation

BASE = dt.datetime(2024, 1, 1)
HOUR = 3600
ALL = ("count", "sum", "avg", "min", "max", "std", "var")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    return [
        (rng.choice("ab") if rng.random() < 0.9 else None, BASE + dt.timedelta(minutes=rng.randrange(900)), rng.uniform(-5, 5))
        for _ in range(120)
    ]


def expected(values):
    n = len(values)
    return {
        "count": n,
        "sum": sum(values) if n else None,
        "avg": sum(values) / n if n else None,
        "min": min(values, default=None),
        "max": max(values, default=None),
        "std": statistics.stdev(values) if n > 1 else None,
        "var": statistics.variance(values) if n > 1 else None,
    }


def same(got, want):
    for name, value in want.items():
        found = got[name]
        assert found == (pytest.approx(value, abs=1e-9) if value is not None else None), name


def test_windows_from_tiles(spark, rows):
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    aggs = [Aggregation("v", f, 4 * HOUR) for f in ALL]
    found = tiles.windowed_from_tiles(df, ["k"], "ts", aggs, HOUR).collect()
    hops = {int(ts.replace(tzinfo=dt.timezone.utc).timestamp()) // HOUR for _, ts, _ in rows}
    assert len(found) == len({k for k, _, _ in rows}) * (max(hops) - min(hops) + 1)
    for r in found:
        end = dt.datetime.fromtimestamp(r.window_end_ms / 1000, dt.timezone.utc).replace(tzinfo=None)
        inside = [v for k, ts, v in rows if k == r.k and end - dt.timedelta(hours=4) <= ts < end]
        same({f: r[f"{f}_v_{4 * HOUR}s"] for f in ALL}, expected(inside))


def test_tiled_latest_has_every_key(spark, rows):
    late = [*rows, ("idle", BASE - dt.timedelta(days=2), 1.0)]
    df = spark.createDataFrame(late, "k string, ts timestamp, v double")
    aggs = [Aggregation("v", f, 2 * HOUR) for f in ("count", "sum", "min")]
    found = {r.k: r for r in tiles.tiled_latest(df, ["k"], "ts", aggs, HOUR).collect()}
    assert found["idle"]["count_v_7200s"] == 0 and found["idle"]["min_v_7200s"] is None
    last = max(ts for _, ts, _ in rows).replace(minute=0) + dt.timedelta(hours=1)
    inside = [v for k, ts, v in rows if k == "a" and last - dt.timedelta(hours=2) <= ts < last]
    assert found["a"]["count_v_7200s"] == len(inside)


def test_window_must_be_a_multiple_of_the_hop(spark, rows):
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    with pytest.raises(ValueError):
        tiles.windowed_from_tiles(df, ["k"], "ts", [Aggregation("v", "sum", 5400)], HOUR)


@pytest.mark.parametrize("window, slide", [(4 * HOUR, HOUR), (5400, HOUR)])
def test_sliding_equals_the_built_in_window(spark, rows, window, slide):
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    aggs = [Aggregation("v", f, window, slide) for f in ALL]
    got = tiles.sliding_agg(df, ["k"], "ts", aggs)
    want = aggregate.windowed_agg(df, ["k"], "ts", aggs)
    key = lambda r: (repr(r.k), r.window_end)
    a, b = sorted(got.collect(), key=key), sorted(want.collect(), key=key)
    assert [key(r) for r in a] == [key(r) for r in b]
    for x, y in zip(a, b):
        same(x.asDict(), {k: v for k, v in y.asDict().items() if isinstance(v, float)})


def test_partials_of_parts_merge(spark, rows):
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    whole = tiles.hop_partials(df, ["k"], "ts", ["v"], HOUR)
    parts = [tiles.hop_partials(df.filter(c), ["k"], "ts", ["v"], HOUR) for c in ("v < 0", "v >= 0")]
    merged = tiles.merge_tiles(parts[0].unionAll(parts[1]), ["k"], ["v"])
    digest = lambda t: sorted((repr(r.k), r.hop_ms, r["v__count"], round(r["v__sum"], 9), r["v__max"]) for r in t.collect())
    assert digest(whole) == digest(merged)


def test_read_time_aggregation_has_no_windows(spark):
    with pytest.raises(ValueError):
        aggregate.odfv_aggregate(spark.range(3), [], [Aggregation("id", "sum", 60)])
    with pytest.raises(ValueError):
        aggregate.group_agg(spark.range(3), [], [Aggregation("id", "no_such")])


def test_no_positives(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.9)], "y int, s double")
    row = aggregate.eval_metrics(df, "y", "s").first()
    assert (row.roc_auc, row.f1, row.precision, row.recall) == (None, 0.0, 0.0, 0.0)
    assert aggregate.class_weight(df, "y").first().weight == 1.0
    assert aggregate.registry_counts(df.withColumn("k", F.lit("a")), "k").first().objects == 2


@pytest.mark.parametrize("hop", [HOUR, 2 * HOUR])
def test_rows_only_where_a_window_changes(spark, rows, hop):
    """Two window sizes at once; between a key's rows, and after its last one, nothing changes."""
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    aggs = [Aggregation("v", f, w * HOUR) for f in ALL for w in (2, 4)]
    found = tiles.window_changes(tiles.hop_partials(df, ["k"], "ts", ["v"], hop), ["k"], hop, aggs).collect()
    stamps = [(k, int(ts.replace(tzinfo=dt.timezone.utc).timestamp()), v) for k, ts, v in rows]
    for key in {k for k, _, _ in rows}:
        own = {r.window_end_ms // 1000: r for r in found if r.k == key}
        hops = {s // hop * hop for k, s, _ in stamps if k == key}
        assert set(own) == {h + hop + w for h in hops for w in (0, 2 * HOUR, 4 * HOUR)}
        for end, r in own.items():
            for w in (2, 4):
                inside = [v for k, s, v in stamps if k == key and end - w * HOUR <= s < end]
                same({f: r[f"{f}_v_{w * HOUR}s"] for f in ALL}, expected(inside))
        assert own[max(own)][f"count_v_{4 * HOUR}s"] == 0


def test_sparse_and_dense_tiles_say_the_same(spark, rows):
    late = [*rows, ("idle", BASE + dt.timedelta(hours=5), 1.0)]
    df = spark.createDataFrame(late, "k string, ts timestamp, v double")
    aggs = [Aggregation("v", f, 3 * HOUR) for f in ("count", "sum", "max")]
    for make, at, empty in (
        (lambda dense: tiles.windowed_from_tiles(df, ["k"], "ts", aggs, HOUR, dense), "window_end_ms", (0, None, None)),
        (lambda dense: tiles.cumulative_tiles(df, ["k"], "ts", ["v"], HOUR, dense).drop("tile_end_ms"), "hop_ms", (0, 0, 0)),
    ):
        sparse = {(r["k"], r[at]): tuple(r)[2:] for r in make(False).collect()}
        dense = sorted(((repr(r["k"]), r["k"], r[at], tuple(r)[2:]) for r in make(True).collect()))
        held = {}
        for _, k, end, values in dense:
            held[k] = sparse.get((k, end), held.get(k, empty))
            assert values == held[k], (k, end)
        assert len(dense) == len({k for k, _, _ in late}) * len({d[2] for d in dense}) > len(sparse)
    none = df.limit(0)
    assert tiles.windowed_from_tiles(none, ["k"], "ts", aggs, HOUR).count() == 0
    assert tiles.cumulative_tiles(none, ["k"], "ts", ["v"], HOUR).count() == 0


def test_windows_take_one_shuffle_of_keys_and_blocks(spark, rows):
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double")
    made = tiles.range_frame(tiles.hop_partials(df, ["k"], "ts", ["v"], HOUR), ["k"], HOUR, [Aggregation("v", "max", 4 * HOUR)])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "block" in plan and "Join" not in plan


def test_tumbling_sizes_in_one_scan(spark, rows):
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double").withColumn("n", F.lit(2).cast("int"))
    aggs = [Aggregation("v", f, w * HOUR) for f in ALL for w in (2, 3)] + [Aggregation("n", f, 3 * HOUR) for f in ("sum", "max")]
    made = tiles.tumbling_agg(df, ["k"], "ts", aggs)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Join" not in plan
    assert dict(made.dtypes)["sum_n_10800s"] == "bigint" and dict(made.dtypes)["max_n_10800s"] == "int"
    parts = [aggregate.windowed_agg(df, ["k"], "ts", [a for a in aggs if a.window == w * HOUR]) for w in (2, 3)]
    want = {}
    for part in parts:
        for r in part.collect():
            want.setdefault((r.k, r.window_end), {}).update(r.asDict())
    got = {(r.k, r.window_end): r.asDict() for r in made.collect()}
    assert set(got) == set(want)
    for key, values in got.items():
        same(values, {c: want[key].get(c) for c in values if c not in ("k", "window_end")})
    mixed = tiles.tumbling_agg(df, ["k"], "ts", [Aggregation("v", "nunique", 2 * HOUR), Aggregation("v", "sum", 3 * HOUR)])
    assert {(r.k, r.window_end) for r in mixed.collect()} == set(want)
