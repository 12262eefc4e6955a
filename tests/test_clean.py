import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import clean, joins, windows
from tidemark.spec import ViewSpec


def test_minmax_constant_null_and_all_null(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, None), (3.0, 5.0, None), (None, None, None)], "a double, b double, c double"
    )
    rows = [tuple(r) for r in clean.minmax_scale(df, ["a", "b", "c"]).collect()]
    assert rows == [(0.0, 0.0, None), (1.0, 0.0, None), (None, None, None)]


def test_cast_numeric_bad_text(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("",), (None,)], "a string")
    assert [r.a for r in clean.cast_numeric(df, ["a"]).collect()] == [1.5, None, None, None]


def test_ratio_zero_and_infinity(spark):
    df = spark.createDataFrame([(6.0, 0.0), (6.0, 2.0), (float("inf"), 3.0), (None, 1.0)], "a double, b double")
    got = clean.ratio_features(df, {"r": ("a", "b")})
    assert [r.r for r in got.collect()] == [6.0, 3.0, 0.0, None]


def test_label_encode_keeps_nulls_as_a_class(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("z",)], "c string")
    got = sorted(r.c for r in clean.label_encode(df, ["c"]).collect())
    assert got == [0, 1, 2, 3]


def test_median_fill_leaves_an_empty_column(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (2.0, None)], "a double, b double")
    assert [tuple(r) for r in clean.fill_null_median(df, ["a", "b"]).collect()] == [
        (1.0, None),
        (1.5, None),
        (2.0, None),
    ]
    approx = clean.fill_null_median(df, ["a"], exact=False).collect()
    assert approx[1].a in (1.0, 2.0)


def test_reasoning_hash(spark):
    df = spark.createDataFrame([("t", "o", "n", "EU", "a")], "t string, o string, n string, p string, a string")
    cols = [F.col(c) for c in df.columns]
    want = hashlib.sha256(b"t|o|n|EU|a").hexdigest()
    assert df.select(clean.reasoning_hash(*cols)).first()[0] == want
    blank = df.withColumn("t", F.lit("  "))
    with pytest.raises(Exception, match="trace id"):
        blank.select(clean.reasoning_hash(*cols)).collect()


def test_eu_record_only_under_the_eu_policy(spark):
    rows = [("eu", "trace", "Arize"), ("US", "trace", "arize"), ("US", " ", "arize"), ("EU", "t", "other"), (None, "t", "arize")]
    df = spark.createDataFrame(rows, "p string, t string, m string")
    record = clean.eu_record(F.col("p"), F.col("t"), F.col("m"), F.lit("o"), F.lit("n"), F.lit("a"))
    got = [r.r for r in df.select(record.alias("r")).collect()]
    assert got[1] is None and got[2] is None and got[4] is None
    assert got[0].eu_llm_monitoring_tool == "arize" and got[0].eu_llm_trace_id == "trace"
    assert got[0].eu_date_reasoning_hash == hashlib.sha256(b"trace|o|n|eu|a").hexdigest()
    assert got[3].eu_llm_monitoring_tool == "langsmith"
    with pytest.raises(Exception, match="trace id"):
        df.limit(1).withColumn("t", F.lit(" ")).select(record).collect()


def test_shifted_time_keeps_its_record(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS ts")
    free = clean.shift_event_time(df, "ts", 1, allowed=True, policy="US").first()
    assert free.ts.hour == 1 and free.eu_llm_trace_id is None
    with pytest.raises(Exception, match="trace id"):
        clean.shift_event_time(df, "ts", 1, allowed=True, policy="EU").collect()
    with pytest.raises(PermissionError):
        clean.shift_event_time(df, "ts", 1, allowed=False)


def test_convert_types(spark):
    df = spark.createDataFrame([("5", ["1", "x", "1"], "t")], "a string, b array<string>, c string")
    got = clean.convert_feature_types(df, {"a": "INT64", "c": "BOOL", "missing": "INT64"}).first()
    assert got.a == 5 and got.c is True
    ints = spark.createDataFrame([([1, 2, 1],)], "s array<int>")
    assert clean.convert_feature_types(ints, {"s": "INT64_SET"}).first().s == [1, 2]
    with pytest.raises(ValueError):
        clean.feature_type("MAP_SET")


@pytest.mark.parametrize(
    "kind, name",
    [
        (T.ShortType(), "INT32"),
        (T.DecimalType(10, 2), "DOUBLE"),
        (T.DateType(), "UNIX_TIMESTAMP"),
        (T.TimestampNTZType(), "UNIX_TIMESTAMP"),
        (T.ArrayType(T.FloatType()), "FLOAT_LIST"),
        (T.BinaryType(), "BYTES"),
        (T.StringType(), "STRING"),
        (T.NullType(), "NULL"),
    ],
)
def test_type_names(kind, name):
    assert clean.feature_type_name(kind) == name


def test_interval_type_is_refused():
    with pytest.raises(ValueError):
        clean.feature_type_name(T.DayTimeIntervalType())


def test_dotted_names_need_a_mapping(spark):
    df = spark.createDataFrame([(1,)], "`a.b` long")
    assert clean.select_aliased(df, ["a.b"], {"a.b": "ab"}).columns == ["ab"]
    with pytest.raises(ValueError):
        clean.select_aliased(df, ["a.b"], {})


def test_ttl_filters(spark):
    at = dt.datetime(2024, 1, 2)
    rows = [(at, at), (at - dt.timedelta(hours=1), at), (at - dt.timedelta(hours=2), at), (None, at)]
    df = spark.createDataFrame(rows, "ts timestamp, entity timestamp")
    assert clean.filter_ttl_asof(df, "ts", "entity", 3600).count() == 2
    assert clean.filter_ttl_asof(df, "ts", "entity", 3600, keep_null=True).count() == 3
    assert clean.filter_ttl_asof(df, "ts", "entity", 0).count() == 3
    assert clean.filter_ttl_now(df, "ts", F.lit(at), 3600).count() == 2


def test_latest_per_key_ties_and_dummy_key(spark):
    a, b = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [("x", a, a, 1), ("x", b, a, 2), ("x", b, b, 3), (None, a, a, 4)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, created timestamp, v long")
    view = ViewSpec("v", ["k"], ["v"], "ts", "created")
    got = windows.latest_per_key(df, view, F.lit(a), F.lit(b))
    assert {(r.k, r.v) for r in got.collect()} == {("x", 3), (None, 4)}
    whole = ViewSpec("v", [], ["v"], "ts", "created")
    assert [tuple(r)[:2] for r in windows.latest_per_key(df, whole, F.lit(a), F.lit(b)).collect()] == [("", 3)]


def test_newest_row_is_a_partial_aggregate(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    plan = windows.dedup_latest(events, ["user_id"], "ts")._jdf.queryExecution().executedPlan()
    assert "partial_max_by" in plan.toString() and "Window" not in plan.toString()


def test_diff_ignores_unnamed(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1), (None, 2)], "n string, p long")
    new = spark.createDataFrame([("a", 1), ("c", 1), ("", 2)], "n string, p long")
    got = {r["name"]: r.transition for r in joins.diff_objects(old, new, "n", ["p"]).collect()}
    assert got == {"a": "UNCHANGED", "b": "DELETE", "c": "CREATE"}


def test_dummy_join_plans_no_join(spark):
    spine = spark.range(5)
    daily = spark.createDataFrame([(dt.datetime(2024, 1, d), d) for d in (1, 2, 3)], "ts timestamp, v long")
    view = ViewSpec("v", [], ["v"], "ts")
    ends = F.lit(dt.datetime(2024, 1, 1)), F.lit(dt.datetime(2024, 1, 2))
    got = joins.cross_join_dummy(spine, daily, view, *ends)
    assert {r.v for r in got.collect()} == {2} and got.count() == 5
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
