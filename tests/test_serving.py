import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import materialize as mat
from tidemark.operators import quality, retrieval, tiles
from tidemark.operators import transform as tr
from tidemark.session import cut_lineage, fresh_path, shared_dir
from tidemark.sources import readers, sinks
from tidemark.spec import ViewSpec
from tidemark.streaming import ingest

A, B, C = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
ROWS = "k string, ts timestamp, v long"


def test_upsert_moves_only_forward(spark):
    old = spark.createDataFrame([("same", B, 1), ("older", B, 1), ("newer", A, 1), ("kept", A, 1)], ROWS)
    new = spark.createDataFrame(
        [("same", B, 2), ("older", A, 2), ("newer", B, 2), ("newer", C, 3), ("fresh", A, 2)], ROWS
    )
    got = {r.k: r.v for r in mat.upsert_latest(old, new, ["k"], "ts").collect()}
    assert got == {"same": 1, "older": 1, "newer": 3, "kept": 1, "fresh": 2}


def test_online_batches_follow_the_same_rule(spark):
    path = fresh_path(spark, "online")
    first = spark.createDataFrame([("same", B, 1), ("older", B, 1), ("newer", A, 1)], ROWS)
    second = spark.createDataFrame([("same", B, 2), ("older", A, 2), ("newer", C, 3)], ROWS)
    mat.write_online(first, path, ["k"], "ts")
    mat.write_online(second, path, ["k"], "ts")
    mat.write_online(second, path, ["k"], "ts", batch=1)
    got = {r.k: r.v for r in mat.read_online(spark, path, ["k"], "ts").collect()}
    assert got == {"same": 1, "older": 1, "newer": 3}
    target = fresh_path(spark, "compact")
    mat.compact_online(spark, path, target, ["k"], "ts")
    assert {r.k: r.v for r in mat.read_online(spark, target, ["k"], "ts").collect()} == got


def test_next_interval():
    assert mat.next_interval([(A, B), (A, A)], None, C) == (B, C)
    assert mat.next_interval([], 3600, C) == (C - dt.timedelta(hours=1), C)
    assert mat.next_interval([], 0, C) == (C - dt.timedelta(weeks=52), C)
    with pytest.raises(ValueError):
        mat.next_interval([], None, C)


def test_chained_views_with_a_cycle(spark):
    views = {"a": (["b"], lambda b: b), "b": (["a"], lambda a: a)}
    with pytest.raises(ValueError, match="cycle"):
        mat.materialize_chained(views, "a")


def test_materialize_checks_columns(spark):
    df = spark.createDataFrame([("x", A, 1)], ROWS)
    view = ViewSpec("v", ["k"], ["v"], "ts")
    with pytest.raises(ValueError, match="missing"):
        mat.materialize(df, view, F.lit(A), F.lit(B), expected={"w": T.LongType()})
    got = mat.materialize(df, view, F.lit(A), F.lit(B), pull_latest=True)
    assert got.count() == 1


def test_status(spark):
    stored = spark.createDataFrame([("old", A, 1), ("edge", B, 2), ("none", C, None)], ROWS)
    asked = spark.createDataFrame([("old",), ("edge",), ("gone",), ("none",), ("old",)], "k string")
    now = F.lit(C)
    day = 24 * 3600
    got = mat.lookup_status(asked, stored, ["k"], "ts", day, now)
    found = [(r.k, r.v, r.status) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(
        [
            ("old", 1, "OUTSIDE_MAX_AGE"),
            ("old", 1, "OUTSIDE_MAX_AGE"),
            ("edge", 2, "PRESENT"),
            ("gone", None, "NOT_FOUND"),
            ("none", None, "PRESENT"),
        ],
        key=repr,
    )
    forever = mat.lookup_status(asked, stored, ["k"], "ts", 0, now)
    assert forever.filter("status = 'OUTSIDE_MAX_AGE'").count() == 0


def test_lists(spark):
    stored = spark.createDataFrame([("a", [1]), ("b", [2])], "k string, xs array<long>")
    more = spark.createDataFrame([("a", [9, 1]), ("c", [3])], "k string, xs array<long>")
    end = {r.k: r.xs for r in mat.list_append_update(stored, more, ["k"], "xs").collect()}
    front = {r.k: r.xs for r in mat.list_append_update(stored, more, ["k"], "xs", True).collect()}
    assert end == {"a": [1, 9, 1], "b": [2], "c": [3]} and front["a"] == [9, 1, 1]


# -- transforms -------------------------------------------------------------------------------


def test_on_write_with_other_row_count(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    outputs = T.StructType().add("k", "string").add("part", "long")

    def twice(frame):
        both = frame[["k"]].assign(part=1)
        return both.loc[both.index.repeat(2)]

    got = tr.transform_on_write(df, twice, outputs, ["k"])
    assert sorted(map(tuple, got.collect())) == [("a", 1, 1)] * 2 + [("b", 1, 2)] * 2
    with pytest.raises(Exception, match="row count"):
        tr.transform_on_write(df, twice, outputs).collect()


def test_on_demand_dependencies():
    a = tr.OnDemandView("a", {"stored": ["x", "y"]}, {"s": "x + y"})
    b = tr.OnDemandView("b", {"a": ["s"], "other": ["z"]}, {"t": "a__s + z"})
    stored, used = tr.needed_features(["b:t", "stored:x"], [a, b])
    assert stored == ["stored:x", "stored:y", "other:z"] and [v.name for v in used] == ["a", "b"]


def test_on_demand_short_and_full_names(spark):
    view = tr.OnDemandView("a", {"s": ["x"]}, {"y": "x + s__x"}, request=["r"])
    full = spark.createDataFrame([(1, 2)], "s__x long, r long")
    assert tr.odfv_read(full, view).first().asDict() == {"s__x": 1, "r": 2, "y": 2}
    short = spark.createDataFrame([(1, 2)], "x long, r long")
    assert tr.odfv_read(short, view, True).first().asDict() == {"x": 1, "r": 2, "a__y": 2}
    with pytest.raises(ValueError):
        tr.odfv_read(full.drop("r"), view)


# -- sources and sinks ------------------------------------------------------------------------


def test_exactly_one_source(spark):
    with pytest.raises(ValueError):
        readers.scan_source(spark)
    with pytest.raises(ValueError):
        readers.scan_source(spark, table="a", query="b")
    with pytest.raises(ValueError):
        readers.scan_source(spark, path="a")
    assert readers.scan_source(spark, query="select 1 as x").first().x == 1
    with pytest.raises(ValueError):
        readers.scan_files(spark, "p", "xml")
    with pytest.raises(ValueError):
        readers.scan_table_format(spark, "p", "paimon")


def test_table_formats_without_their_package(spark):
    for name in readers.TABLE_FORMATS:
        try:
            readers.scan_table_format(spark, "/nowhere", name).schema
        except Exception as error:
            assert name in str(error).lower() or "path" in str(error).lower()


def test_avro_messages(spark):
    try:
        spark.read.format("avro").load("/nowhere")
    except Exception as error:
        if "path" not in str(error).lower() or "spark-avro" in str(error).lower() or "AVRO" in str(error):
            pytest.skip("the avro package is not on the class path")
    from pyspark.sql.avro.functions import to_avro

    schema = '{"type":"record","name":"r","fields":[{"name":"a","type":["long","null"]}]}'
    df = spark.range(3).select(to_avro(F.struct(F.col("id").alias("a")), schema).alias("value"))
    assert sorted(r.a for r in readers.decode_avro(df, schema).collect()) == [0, 1, 2]


def test_append_checks_columns(spark):
    path = fresh_path(spark, "append")
    spark.createDataFrame([(1, "a")], "x long, y string").write.parquet(path)
    with pytest.raises(ValueError):
        sinks.sink_offline_append(spark.createDataFrame([("b", 2)], "y string, x long"), path)
    sinks.sink_offline_reorder(spark.createDataFrame([(7, 2)], "y int, x int"), path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "7")]
    with pytest.raises(ValueError, match="missing.*y"):
        sinks.sink_offline_reorder(spark.createDataFrame([(1,)], "x long"), path)


def test_saved_dataset_is_not_replaced(spark):
    df = spark.createDataFrame([("a", A, 1), ("b", C, 1)], ROWS)
    path = fresh_path(spark, "saved")
    info = sinks.persist_dataset(df, "saved_once", "ts", path=path)
    assert info["rows"] == 2 and info["max_us"] - info["min_us"] == 2 * 24 * 3600 * 1_000_000
    with pytest.raises(Exception, match="already exists"):
        sinks.persist_dataset(df, "saved_once", "ts", path=path)
    sinks.persist_dataset(df.limit(1), "saved_once", "ts", path=path, allow_overwrite=True)
    assert spark.table("saved_once").count() == 1
    spark.sql("DROP TABLE saved_once")


def test_jdbc_writer_arguments(spark, monkeypatch):
    seen = {}
    df = spark.range(1)
    kind = type(df.write)
    monkeypatch.setattr(kind, "jdbc", lambda self, *a, **k: seen.update(args=a, **k))
    sinks.sink_jdbc(df, "jdbc:postgresql://h/db", "t", {"user": "u"})
    assert seen == {"args": ("jdbc:postgresql://h/db", "t"), "mode": "overwrite", "properties": {"user": "u"}}


def test_documents(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("héllo\nworld")
    (tmp_path / "sub" / "b.md").write_text("# b")
    (tmp_path / "c.bin").write_text("no")
    got = {r.filename: (r.content, r.size) for r in readers.scan_documents(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": ("héllo\nworld", 11), "b.md": ("# b", 3)}


def test_introspection(spark):
    rows = [("1", "1.5", "2024-01-01 10:00", "x", " ", "+3"), ("", "2e3", "01/02/2024", "1", None, "1_000")]
    df = spark.createDataFrame(rows, "i string, f string, t string, s string, n string, u string")
    got = {r["name"]: r["type"] for r in readers.introspect_schema(df).collect()}
    assert got == {
        "i": "INTEGER",
        "f": "FLOAT",
        "t": "TIMESTAMP",
        "s": "STRING",
        "n": "STRING",
        "u": "INTEGER",
    }
    own = readers.introspect_schema(spark.range(1).withColumn("d", F.lit(1.0)))
    assert {r["name"]: r["type"] for r in own.collect()} == {"id": "INTEGER", "d": "FLOAT"}


def test_push_targets(spark):
    df = spark.createDataFrame([("a", A, 1)], ROWS)
    path = fresh_path(spark, "push")
    view = {"offline_path": f"{path}/off", "online_path": f"{path}/on", "keys": ["k"], "ts": "ts"}
    sinks.push_source(df, [view], "offline")
    with pytest.raises(Exception):
        mat.read_online(spark, f"{path}/on", ["k"], "ts")
    sinks.push_source(df, [view], "online")
    assert mat.read_online(spark, f"{path}/on", ["k"], "ts").count() == 1
    assert spark.read.parquet(f"{path}/off").count() == 1
    with pytest.raises(ValueError):
        sinks.push_source(df, [view], "nowhere")
    with pytest.raises(ValueError):
        sinks.push_source(df, [])


def test_shared_folder_is_the_checkpoint_folder(spark):
    assert shared_dir(spark) == shared_dir(spark)
    assert shared_dir(spark) in fresh_path(spark, "x")
    df = cut_lineage(spark.range(10).withColumn("x", F.col("id") * 2))
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()


# -- quality ----------------------------------------------------------------------------------


def test_type_rules():
    agree = quality.types_agree
    assert agree(T.IntegerType(), T.LongType()) and agree(T.FloatType(), T.DoubleType())
    assert agree(T.MapType(T.StringType(), T.StringType()), T.StructType().add("a", "string"))
    assert agree(T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType()))
    assert not agree(T.StringType(), T.LongType())
    assert not agree(T.IntegerType(), T.DoubleType())


def test_schema_warning(spark):
    with pytest.warns(UserWarning, match="id"):
        quality.validate_schema(spark.range(1), {"id": T.StringType()})


def test_bad_json_is_found(spark):
    df = spark.createDataFrame([('{"a": 1}',), (None,), ("null",), ("{a",)], "j string")
    row = quality.json_report(df, ["j"]).first()
    assert (row.rows, row.present, row.malformed) == (4, 3, 1)
    with pytest.raises(ValueError):
        quality.validate_json(df, ["j"])


def test_expectations_with_mostly(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "x string")
    check = lambda **k: quality.expectations(df, [quality.Expectation("in_set", "x", **k)]).first()
    assert not check(values=["a", "b"]).success
    row = check(values=["a", "b"], mostly=0.66)
    assert row.success and (row.missing, row.unexpected) == (1, 1)
    with pytest.raises(ValueError):
        quality.expectations(df, [quality.Expectation("odd", "x")])


def test_feature_log_columns():
    schema = quality.log_schema({"k": T.LongType()}, {"v": {"f": T.DoubleType()}})
    assert schema.fieldNames() == [
        "k",
        "v__f",
        "v__f__timestamp",
        "v__f__status",
        "__log_timestamp",
        "__log_date",
        "__request_id",
    ]


# -- streams ----------------------------------------------------------------------------------


def test_replayed_batch_leaves_one_copy(spark):
    path = fresh_path(spark, "replay")
    df = spark.createDataFrame([("a", A, 1), ("a", B, 2), ("b", A, 3)], ROWS)
    write = ingest.microbatch_latest(["k"], "ts", online_path=f"{path}/on", offline_path=f"{path}/off")
    write(df, 0)
    write(df, 0)
    assert spark.read.parquet(f"{path}/off").count() == 2
    rows = mat.read_online(spark, f"{path}/on", ["k"], "ts").collect()
    assert {r.k: r.v for r in rows} == {"a": 2, "b": 3} and rows[0].created is not None
    tiles_path = fresh_path(spark, "replay-tiles")
    add = ingest.write_tiles(tiles_path, ["k"], "ts", ["v"], 3600)
    add(df, 0)
    add(df, 0)
    add(df, 1)
    merged = ingest.read_tiles(spark, tiles_path, ["k"], ["v"])
    assert merged.agg(F.sum("v__count")).first()[0] == 6


def test_streams_on_one_path_keep_apart(spark):
    """Both streams number their batches from 0; a restart goes on under the same name."""
    path, schema = fresh_path(spark, "apart"), spark.createDataFrame([], ROWS).schema
    names = set()
    for key in ("a", "b"):
        source, checkpoint = fresh_path(spark, "apart-source"), fresh_path(spark, "apart-checkpoint")
        for value in (1, 2):
            spark.createDataFrame([(key, A, value)], ROWS).write.mode("append").parquet(source)
            stream = ingest.file_stream(spark, source, schema)
            write = ingest.microbatch_latest(["k"], "ts", offline_path=f"{path}/off")
            names.add(str(ingest.stream_ingest(stream, write, checkpoint=checkpoint).id))
    stored = spark.read.parquet(f"{path}/off")
    assert sorted((r.k, r.v) for r in stored.collect()) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    assert {r[0] for r in stored.select(mat.WRITER).distinct().collect()} == names and len(names) == 2


def test_tile_states_after_replay_and_restart(spark):
    path, checkpoint, source = (fresh_path(spark, n) for n in ("states", "states-checkpoint", "states-source"))
    schema = spark.createDataFrame([], ROWS).schema
    batches = []

    def write(batch, number):
        """Each batch is written twice, as after a failure before its commit."""
        batches.append(number)
        for _ in range(2):
            ingest.write_updates(path)(batch, number)

    for rows in ([("a", A, 1), ("b", A, 5)], [("a", A, 2)], [("a", B, 3)]):
        spark.createDataFrame(rows, ROWS).write.mode("append").parquet(source)
        states = ingest.tile_states(ingest.file_stream(spark, source, schema), ["k"], "ts", ["v"], 3600, "400 days")
        ingest.stream_ingest(states, write, checkpoint=checkpoint)
    found = ingest.read_tile_states(spark, path, ["k"], ["v"])
    whole = tiles.hop_partials(spark.read.parquet(source), ["k"], "ts", ["v"], 3600)
    digest = lambda df: sorted(tuple(r) for r in df.select(*whole.columns).collect())
    assert digest(found) == digest(whole) and sorted(set(batches)) == batches


def test_a_push_tried_again_leaves_one_copy(spark):
    df = spark.createDataFrame([("a", A, 1)], ROWS)
    path = fresh_path(spark, "again")
    view = {"offline_path": f"{path}/off", "online_path": f"{path}/on", "keys": ["k"], "ts": "ts"}
    for push in ("one", "one", "two", None):
        sinks.push_source(df, [view], "online_and_offline", push=push)
    assert spark.read.parquet(f"{path}/off").count() == 3
    assert mat.read_online(spark, f"{path}/on", ["k"], "ts").count() == 1


def test_views_keep_their_mapping_in_retrieval(spark):
    from tidemark.plans.serving import historical_mapped

    made = historical_mapped(spark, "/root/testdata/sf0.001")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_one_window_per_stream(spark):
    from tidemark.spec import Aggregation

    aggs = [Aggregation("v", "sum", 60), Aggregation("v", "sum", 120)]
    with pytest.raises(ValueError):
        ingest.stream_windows(spark.createDataFrame([("a", A, 1)], ROWS), ["k"], "ts", aggs, "1 hour")


def test_processing_time_trigger(spark):
    source, path = fresh_path(spark, "source"), fresh_path(spark, "sink")
    df = spark.createDataFrame([("a", A, 1)], ROWS)
    df.write.parquet(source)
    stream = ingest.file_stream(spark, source, df.schema)
    write = ingest.microbatch_latest(["k"], "ts", online_path=path)
    query = ingest.stream_ingest(stream, write, every="1 second", timeout=8)
    assert not query.isActive
    assert mat.read_online(spark, path, ["k"], "ts").count() == 1


def test_json_messages(spark):
    df = spark.createDataFrame([(b'{"a": 1, "b": "x"}',), (b"broken",)], "value binary")
    got = [tuple(r) for r in readers.decode_json(df, "a long, b string").collect()]
    assert got == [(1, "x"), (None, None)]


def test_request_columns(spark):
    with pytest.raises(ValueError):
        readers.require_request_columns(spark.range(1), ["amount"])


# -- retrieval by reference -------------------------------------------------------------------


def test_inferred_roles(spark):
    df = spark.createDataFrame([("a", A, B, 1, 2)], "k string, ts timestamp, made timestamp, v long, `__x` long")
    with pytest.raises(ValueError):
        retrieval.infer_view(df, "v", ["k"])
    view = retrieval.infer_view(df, "v", ["k"], created="made")
    assert (view.ts, list(view.features)) == ("ts", ["v"])


def test_references(spark):
    spine = spark.createDataFrame([("a", C)], "k string, at timestamp")
    df = spark.createDataFrame([("a", A, 1)], ROWS)
    views = {n: (df, ViewSpec(n, ["k"], ["v"], "ts")) for n in ("x", "y")}
    got = retrieval.historical_features(spine, views, ["x:v"]).first()
    assert got.asDict() == {"k": "a", "at": C, "v": 1}
    with pytest.raises(ValueError, match="collide"):
        retrieval.historical_features(spine, views, ["x:v", "y:v"])
    both = retrieval.historical_features(spine, views, ["y:v", "x:v"], full_names=True)
    assert both.columns == ["k", "at", "y__v", "x__v"]
    with pytest.raises(ValueError, match="collide"):
        retrieval.historical_features(spine, views, ["x:v", "x:v"], full_names=True)
    named = spine.withColumn("event_timestamp", F.lit(A) - F.expr("INTERVAL 1 DAY"))
    assert retrieval.historical_features(named, views, ["x:v"]).first().v is None
    with pytest.raises(ValueError, match="no feature"):
        retrieval.historical_features(spine, views, ["x:w"])
    odd = tr.OnDemandView("z", {"x": ["v"]}, {"w": "x__v + r"}, request=["r"])
    with pytest.raises(ValueError, match="request"):
        retrieval.historical_features(spine, views, ["z:w"], on_demand=[odd])
    asked = spine.drop("at").withColumn("r", F.lit(5))
    online = retrieval.online_features(asked, views, ["z:w"], F.lit(C), on_demand=[odd]).first()
    assert online.asDict() == {"k": "a", "r": 5, "x__status": "PRESENT", "w": 6}


def test_writers_of_one_table_keep_apart(spark, tmp_path):
    path = str(tmp_path / "online")
    rows = lambda data: spark.createDataFrame(data, "k string, ts long, v int")
    mat.write_online(rows([("a", 1, 1), ("b", 1, 1)]), path, ["k"], "ts")
    mat.write_online(rows([("c", 1, 1)]), path, ["k"], "ts", batch=0, writer="stream")
    mat.write_online(rows([("d", 1, 1)]), path, ["k"], "ts", batch=0, writer="other")
    mat.write_online(rows([("c", 1, 2)]), path, ["k"], "ts", batch=0, writer="stream")
    got = {r.k: r.v for r in mat.read_online(spark, path, ["k"], "ts").collect()}
    assert got == {"a": 1, "b": 1, "c": 2, "d": 1}


def test_list_updates_of_one_key_are_gathered(spark):
    stored = spark.createDataFrame([("a", [1])], "k string, xs array<int>")
    more = spark.createDataFrame([("a", 2, [3]), ("a", 1, [2]), ("b", 1, [9])], "k string, at int, xs array<int>")
    got = mat.list_append_update(stored, more, ["k"], "xs", order=["at"]).collect()
    assert sorted((r.k, r.xs) for r in got) == [("a", [1, 2, 3]), ("b", [9])]


def test_transform_on_write_keeps_rows_with_one_key(spark):
    df = spark.createDataFrame([(1, i) for i in range(50)], "k int, v int")
    outputs = T.StructType().add("k", "integer").add("w", "integer")
    made = tr.transform_on_write(df, lambda b: b.assign(w=b.v * 2)[["k", "w"]], outputs, ["k"])
    assert sorted((r.v, r.w) for r in made.collect()) == [(i, 2 * i) for i in range(50)]


# -- on-demand functions ----------------------------------------------------------------------


def test_functions_run_in_one_stage_in_order(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 4.0)], "id long, v__x double")
    views = [
        tr.OnDemandView("b", {"a": ["y"]}, {"z": "long"}, mode="singleton", function=lambda r: {"z": None if r["y"] is None else int(r["y"])}),
        tr.OnDemandView("a", {"v": ["x"]}, {"y": "double"}, mode="pandas", function=lambda f: f[["x"]].rename(columns={"x": "y"}) * 10),
        tr.OnDemandView("c", {"b": ["z"], "a": ["y"]}, {"l": "array<int>"}, mode="python", function=lambda d: {"l": [[1]] * len(d["z"])}),
    ]
    made = tr.odfv_dependencies(df, ["c:l", "b:z"], views, ["id"])
    assert made.columns == ["id", "c__l", "b__z"]
    assert sorted(tuple(r) for r in made.collect()) == [(1, [1], 20), (2, [1], None), (3, [1], 40)]
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert tr.odfv_dependencies(df.limit(0), ["c:l"], views, ["id"]).count() == 0
    short = tr.odfv_read(df.withColumnRenamed("v__x", "x"), views[1])
    assert short.columns == ["id", "x", "y"] and short.dtypes[-1] == ("y", "double")


@pytest.mark.parametrize(
    ("mode", "function"),
    [
        ("pandas", lambda f: f.head(1).rename(columns={"x": "y"})),
        ("python", lambda d: {"other": d["x"]}),
        ("singleton", lambda r: {}),
    ],
)
def test_functions_that_break_their_promise_fail(spark, mode, function):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double").coalesce(1)
    view = tr.OnDemandView("o", {"v": ["x"]}, {"y": "double"}, mode=mode, function=function)
    with pytest.raises(Exception, match="view 'o' made"):
        tr.odfv_read(df, view).collect()


def test_modes_and_functions_belong_together():
    with pytest.raises(ValueError):
        tr.OnDemandView("o", {}, {"y": "1"}, mode="pandas")
    with pytest.raises(ValueError):
        tr.OnDemandView("o", {}, {"y": "1"}, function=len)
    with pytest.raises(ValueError):
        tr.OnDemandView("o", {}, {"y": "1"}, mode="rust", function=len)
