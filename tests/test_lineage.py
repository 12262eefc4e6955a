import hashlib
import json
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.operators import lineage as ln
from tidemark.operators import ml

URIS = [
    "s3://bucket/path/data.parquet",
    "s3a://Bucket/path/",
    "postgresql://host:5432/db/table",
    "jdbc:postgresql://user:pw@Host:5432/db.tbl",
    "/local/path/data.csv",
    "relative/path.csv",
    "file:///tmp/x",
    "hdfs://nn/a?b=c#d",
    "http://h",
    "",
    "//host/path",
    "mailto:someone",
]


def strings(spark, values):
    return spark.createDataFrame([(v,) for v in values], "u string")


def test_dataset_uris(spark):
    got = {
        r.u: (r.d.namespace, r.d.name)
        for r in strings(spark, URIS).select("u", names.normalize_dataset_uri(F.col("u")).alias("d")).collect()
    }
    for uri in URIS:
        if uri.startswith("/"):
            want = ("file", uri.lstrip("/"))
        else:
            p = urlparse(uri)
            want = (p.scheme or "file", (p.netloc + p.path).strip("/") or "unknown")
        assert got[uri] == want, uri


def test_identities(spark):
    got = {
        r.u: (r.d.namespace, r.d.name)
        for r in strings(spark, URIS).select("u", names.dataset_identity(F.col("u")).alias("d")).collect()
    }
    alias = {"postgresql": "postgres", "s3a": "s3", "": "unknown"}
    for uri in URIS:
        p = urlparse(uri.strip().removeprefix("jdbc:"))
        space = f"{alias.get(p.scheme, p.scheme)}://{p.hostname or 'localhost'}"
        want = (space + (f":{p.port}" if p.port else ""), p.path.lstrip("/") or p.netloc)
        assert got[uri] == want, uri


def test_names(spark):
    raw = ["My Training Run_v2", "experiment@#$123", "__a--b__", "***", "", "v1.0"]
    got = [r[0] for r in strings(spark, raw).select(names.sanitize_name(F.col("u"))).collect()]
    assert got == ["my-training-run-v2", "experiment123", "a-b", "unnamed", "unnamed", "v1.0"]
    row = strings(spark, ["Run 1"]).select(
        names.job_name(F.lit("mlflow"), F.col("u"), F.lit("Exp_2")).alias("a"),
        names.job_name(F.lit("ray"), F.col("u")).alias("b"),
    )
    assert tuple(row.first()) == ("mlflow/exp-2/run-1", "ray/run-1")
    sql = strings(spark, ["select * FROM  my_table where 1", "no table"])
    assert [r[0] for r in sql.select(names.table_of_query(F.col("u"))).collect()] == ["my_table", ""]


def chain(payloads):
    prev, rows = ln.GENESIS, []
    for seq, payload in enumerate(payloads):
        digest = hashlib.sha256(f"{prev}|{payload}".encode()).hexdigest()
        rows.append(["log", seq, payload, prev, digest])
        prev = digest
    return rows


def verify(spark, rows):
    df = spark.createDataFrame(rows, "log string, seq long, payload string, prev_hash string, entry_hash string")
    got = ln.audit_chain_verify(df, "log", "seq").orderBy("seq").collect()
    return [(r.hash_ok, r.link_ok) for r in got]


def test_sound_chain(spark):
    rows = chain([json.dumps({"a": i}, separators=(",", ":")) for i in range(20)])
    assert verify(spark, rows) == [(True, True)] * 20


def test_broken_chains(spark):
    rows = chain("abcde")
    rows[2][2] = "edited"
    assert verify(spark, rows) == [(True, True)] * 2 + [(False, True)] + [(True, True)] * 2
    rows = chain("abcde")
    del rows[2]
    assert verify(spark, rows) == [(True, True), (True, True), (True, False), (True, True)]
    rows = chain("ab")
    rows[0][3] = "f" * 64
    assert verify(spark, rows)[0] == (False, False)


EDGES = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "d"), ("d", "e"), ("e", "f"), ("x", "a"), ("a", "b")]


@pytest.mark.parametrize("depth", [0, 1, 2, 10])
def test_graph_levels(spark, depth):
    edges = spark.createDataFrame(EDGES, "src string, dst string")
    start = spark.createDataFrame([("a",)], "node string")
    got = {tuple(r) for r in ln.lineage_graph_depth(edges, start, depth).collect()}
    level, want, frontier, seen = 0, set(), {"a"}, {"a"}
    while frontier and level <= depth:
        step = {(s, d) for s, d in EDGES if s in frontier}
        want |= {(level, s, d) for s, d in step}
        frontier = {d for _, d in step} - seen
        seen |= frontier
        level += 1
    assert got == want


def test_pipelines_follow_both_directions(spark):
    edges = spark.createDataFrame(
        [("job:p:1", "ds"), ("ds", "job:c:1"), ("job:c:1", "ds2"), ("job:z:1", "other")], "src string, dst string"
    )
    jobs = spark.createDataFrame(
        [("job:p:1", "p"), ("job:c:1", "c"), ("job:z:1", "z")], "node string, namespace string"
    )
    assert [r[0] for r in ln.dataset_pipelines(edges, jobs, "ds2").collect()] == ["c", "p"]


def test_triples_of_an_event(spark):
    event = {
        "run": {"runId": "r1"},
        "job": {"name": "j"},
        "eventTime": "2024-01-01T00:00:00Z",
        "inputs": [{"name": "in"}],
        "outputs": [{"name": 'o"ut'}],
    }
    df = spark.createDataFrame([(json.dumps(event),)], "e string")
    triples = ln.prov_triples(ln.parse_events(df, "e"))
    got = {tuple(r) for r in triples.collect()}
    assert ("urn:uuid:r1", "rdf:type", "prov:Activity") in got
    assert ("urn:uuid:r1", "prov:used", "urn:dataset:r1:0") in got
    assert ("urn:uuid:r1", "trust:namespace", "openlineage") in got
    assert len(got) == 4 + 3 + 5
    lines = {r.line for r in ln.turtle_lines(triples).collect()}
    assert "<urn:uuid:r1> rdf:type prov:Activity ." in lines
    assert '<urn:artifact:r1:0> rdfs:label "o\\"ut" .' in lines


def test_search_scores(spark):
    rows = [
        ("driver_stats", "hourly", {"team": "a"}),
        ("other", "the driver table", {}),
        ("third", "", {"owner": "driver team"}),
        ("rdeivr", "", None),
        ("unrelated", "", {}),
    ]
    df = spark.createDataFrame(rows, "name string, description string, tags map<string,string>")
    got = {r["name"]: (r.match_score, r.matched_tags) for r in ln.registry_search(df, "DRIVER").collect()}
    assert got["driver_stats"][0] == 100 and got["other"][0] == 80
    assert got["third"] == (60, {"owner": "driver team"}) and got["rdeivr"][0] == 100.0
    assert "unrelated" not in got
    assert ln.registry_search(df, "").count() == 5


def test_source_fallback_names(spark):
    df = spark.createDataFrame(
        [(("n", "t", "p"),), (("", "t", "p"),), (("", "", "p"),), (("", "", ""),)],
        "s struct<name:string,table:string,path:string>",
    )
    got = [r[0] for r in df.select(ln.source_name(F.col("s"))).collect()]
    assert got[:3] == ["n", "table:t", "path:p"] and got[3].startswith("unnamed_source_")


def test_warehouse_types(spark):
    pairs = {
        "VARCHAR(255)": "String",
        "number(9,0)": "Int32",
        "NUMBER(18)": "Int64",
        "NUMBER(38,0)": "Float64",
        "NUMBER(10, 2)": "Float64",
        "NUMBER": "Int64",
        "DECIMAL(18,0)": "Int64",
        "array<int64>": "Array(Int64)",
        "ARRAY<STRUCT<a INT>>": "Array(String)",
        " Bool ": "Bool",
        "TIME": "UnixTimestamp",
        "": "String",
    }
    df = strings(spark, list(pairs))
    got = {r.u: r.t for r in df.select("u", ln.warehouse_feature_type(F.col("u")).alias("t")).collect()}
    assert got == pairs


def test_manifest_filters(spark):
    node = {"resource_type": "model", "name": "m", "tags": ["x"], "columns": {"c": {"data_type": None}}}
    nodes = {
        "model.p.m": node,
        "model.p.n": {**node, "name": "n", "tags": []},
        "test.p.t": node,
        "model.p.s": {**node, "resource_type": "seed"},
    }
    df = spark.createDataFrame([(json.dumps({"nodes": nodes}),)], "j string")
    assert {r.model for r in ln.dbt_columns(df, "j").collect()} == {"m", "n"}
    assert {r.model for r in ln.dbt_columns(df, "j", tag="x").collect()} == {"m"}
    assert [r.data_type for r in ln.dbt_columns(df, "j", names=["n"]).collect()] == ["STRING"]


def test_stratified_split_shares(spark):
    df = spark.range(3000).withColumn("y", F.when(F.col("id") < 2500, 0).when(F.col("id") < 2999, 1))
    got = ml.stratified_split(df, "id", "y").groupBy("y", "is_test").count().collect()
    counts = {(r.y, r.is_test): r["count"] for r in got}
    assert counts == {(0, True): 500, (0, False): 2000, (1, True): 100, (1, False): 399, (None, False): 1}
    first = ml.stratified_split(df, "id", "y").filter("is_test").collect()
    again = ml.stratified_split(df.repartition(7), "id", "y").filter("is_test").collect()
    assert sorted(first) == sorted(again)
    other = ml.stratified_split(df, "id", "y", seed=1).filter("is_test").collect()
    assert sorted(first) != sorted(other)


def test_training_learns_and_predicts(spark):
    df = spark.range(400).select(
        "id", (F.col("id") % 20).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b")
    )
    df = df.withColumn("y", (F.col("a") > 14).cast("int"))
    model = ml.train_classifier(df, ["a", "b"], "y", depth=3, rounds=5)
    got = ml.batch_predict(df.select("id"), df, ["id"], model, ["a", "b"], {})
    wrong = got.join(df, "id").filter("prediction <> y").count()
    assert wrong == 0
    missing = ml.batch_predict(df.select((F.col("id") + 1000).alias("id")), df, ["id"], model, ["a", "b"], {})
    assert missing.filter("prediction = 1").count() == 0


def test_unknown_category_is_zero(spark):
    df = spark.createDataFrame([("One", None), ("??", 2.0), (None, 1.0)], "c string, n double")
    got = ml.encode_features(df, ["n"], {"c": {"Zero": 0, "One": 1}}).collect()
    assert [tuple(r) for r in got] == [(1.0, 0.0), (0.0, 2.0), (0.0, 1.0)]


CASES = {
    "select a from t": ["t"],
    "SELECT a FROM t, u x, v AS y WHERE b > 1": ["t", "u", "v"],
    "select 'from a' from b -- from c\n join d on 1=1": ["b", "d"],
    "select 1 /* from x */ from y": ["y"],
    "select 'it''s from x' from y": ["y"],
    'select * from "a b"."c""d" join `e f` using (k)': ['a b.c"d', "e f"],
    "select * from a.b.c c, (select * from d join e on d.x = e.x) s left join f on true, g": ["a.b.c", "d", "e", "f", "g"],
    "with t as (select * from r) select * from T join u on 1 = 1": ["r", "u"],
    "with t (x, y) as (select * from r), v as materialized (select p, q from t) select * from v": ["r"],
    "with recursive t as (select 1 union all select n + 1 from t) select * from t, w": ["w"],
    "select extract(year from d), trim(both 'x' from y), substring(z from 2) from t": ["t"],
    "select * from a where x is distinct from b.y and exists (select 1 from c)": ["a", "c"],
    "select * from generate_series(1, 3) g, t": ["t"],
    "select * from (a join b on a.i = b.i) join (c) on true": ["a", "b", "c"],
    "select f(x, y), z from t group by x, y order by p, q": ["t"],
    "select * from t union select * from u intersect select a, b from v": ["t", "u", "v"],
    "select * from t, t": ["t"],
    "select * from only t, lateral (select * from u) x": ["t", "u"],
    "insert into x select * from y": ["y"],
    "select a, b as (c) from t": ["t"],
    "select 1": [],
    "": [],
    "select 'unclosed from x": [],
    "/* unclosed from x": [],
    "select (select from) from (((": [],
    ")))) from t": ["t"],
    "select * from été, t$1": ["été", "t$1"],
}


def test_tables_of_queries(spark):
    from tidemark.functions.queries import datasets_of_query, tables_of_query

    rows = [*CASES.items(), (None, None)]
    df = spark.createDataFrame(rows, "sql string, want array<string>")
    for r in df.withColumn("got", tables_of_query(F.col("sql"))).collect():
        assert r.got == r.want, r.sql
    long = spark.createDataFrame([("select '" + "x''" * 200_000 + "' from t /* " + "y" * 500_000 + " */, u",)], "sql string")
    assert long.select(tables_of_query(F.col("sql"))).first()[0] == ["t", "u"]
    one = spark.createDataFrame([("select * from a join b.c on 1 = 1",)], "sql string")
    named = one.select(F.inline(datasets_of_query(F.lit("ns"), F.lit("db"), F.col("sql")))).collect()
    assert [tuple(r) for r in named] == [("ns", "db.a"), ("ns", "b.c")]


def test_entity_ids_tell_values_apart(spark):
    rows = [("a", "b"), ("a|b", ""), ("a", None), ("a", ""), (None, "a")]
    df = spark.createDataFrame(rows, "x string, y string")
    ids = df.select(names.entity_id({"x": F.col("x"), "y": F.col("y")}), names.entity_id({"y": F.col("y"), "x": F.col("x")})).collect()
    assert all(a == b for a, b in ids) and len({a for a, _ in ids}) == len(rows)


def test_a_hot_view_is_joined_in_parts(spark, monkeypatch):
    rows = [("feature", f"f{i}", "featureView", "hot") for i in range(40)] + [("entity", f"e{i}", "featureView", "hot") for i in range(7)]
    rows += [("dataSource", f"s{i}", "featureView", "hot") for i in range(9)] + [("entity", "e0", "featureView", "cold")]
    rows += [("featureView", "hot", "featureService", f"v{i}") for i in range(30)] + [("featureView", "cold", "featureService", "v0")]
    rows += [("featureView", "alone", "featureService", "v9"), ("dataSource", "s0", "featureView", "unserved")]
    direct = spark.createDataFrame(rows, "src_type string, src string, dst_type string, dst string")
    feeds = [(t, s) for t, s, k, v in rows if k == "featureView" and v == "hot"]
    want = {(t, s, "featureService", f"v{i}") for t, s in feeds for i in range(30)} | {("entity", "e0", "featureService", "v0")}
    want |= {("entity", f"e{i}", "dataSource", f"s{j}") for i in range(7) for j in range(9)}
    for part in (5, 10_000):
        monkeypatch.setattr(ln, "PART_EDGES", part)
        found = [tuple(r) for r in ln.lineage_edges_indirect(direct).collect()]
        assert len(found) == len(want) and set(found) == want


def test_levels_of_a_graph_with_circles(spark):
    pairs = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 4), (4, 5), (6, 1)]
    edges = spark.createDataFrame(pairs, "src long, dst long")
    start = spark.createDataFrame([(1,)], "node long")
    found = {(r.level, r.src, r.dst) for r in ln.lineage_graph_depth(edges, start, 9).collect()}
    assert found == {(0, 1, 2), (1, 2, 3), (2, 3, 1), (2, 3, 4), (3, 4, 4), (3, 4, 5), }
    assert ln.lineage_graph_depth(edges, start, 0).count() == 1


def test_queries_are_read_by_every_core(spark, small):
    from tidemark.plans.transforms import order_queries

    orders = order_queries(spark, small)
    assert orders.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert orders.select("o_orderkey", "sql").distinct().count() == spark.read.parquet(f"{small}/orders.parquet").count()


def test_training_reads_cells_and_counts_every_row(spark, monkeypatch):
    from pyspark.ml.classification import GBTClassifier

    df = spark.range(4000).select(
        "id", (F.col("id") % 20).alias("a"), ((F.col("id") * 7 % 1000) / 10).alias("b")
    )
    df = df.withColumn("y", ((F.col("a") > 14) & (F.col("b") >= 0)).cast("int"))
    seen, fit = [], GBTClassifier._fit

    def kept(self, rows):
        seen.append(rows.agg(F.count("*").alias("cells"), F.sum("__rows").alias("rows")).first())
        return fit(self, rows)

    monkeypatch.setattr(GBTClassifier, "_fit", kept)
    model = ml.train_classifier(df, ["a", "b"], "y", depth=3, rounds=3)
    assert seen[0].rows == 4000 and seen[0].cells <= 20 * 32 * 2
    assert ml.probability(model, df).filter((F.col("probability_1") >= 0.5).cast("int") != F.col("y")).count() == 0


def test_tasks_follow_from_edges_and_pairs(spark, monkeypatch):
    views = spark.range(40).select(
        F.concat(F.lit("v"), "id").alias("name"), F.lit("batch").alias("kind"), F.array(F.concat(F.lit("e"), F.col("id") % 3)).alias("entities"),
        F.array(F.lit("f")).alias("features"), F.struct(F.lit("s").alias("name"), F.lit("").alias("table"), F.lit("").alias("path")).alias("batch_source"),
        F.lit("").alias("stream_source"), F.array().cast("array<string>").alias("input_views"), F.array().cast("array<string>").alias("request_sources"),
    )
    services = spark.range(200).select(F.concat(F.lit("x"), F.col("id") % 7).alias("service"), F.concat(F.lit("v"), F.col("id") % 40).alias("view"))
    direct = sorted(map(tuple, ln.lineage_edges_direct(views, services).collect()))
    indirect = sorted(map(tuple, ln.lineage_edges_indirect(ln.lineage_edges_direct(views, services)).collect()))
    assert len(direct) == len(set(direct)) and len(indirect) == len(set(indirect)) == 5 * 7 + 3
    monkeypatch.setattr(ln, "EDGES_PER_TASK", 20)
    monkeypatch.setattr(ln, "PAIRS_PER_TASK", 50)
    edges = ln.lineage_edges_direct(views, services)
    assert edges.rdd.getNumPartitions() >= 320 // 20
    assert sorted(map(tuple, edges.collect())) == direct
    assert sorted(map(tuple, ln.lineage_edges_indirect(edges).collect())) == indirect


def test_long_queries_take_time_by_their_length(spark):
    from time import monotonic

    from tidemark.functions.queries import tables_of_query

    names = [f"t{i}" for i in range(20_000)]
    deep = "select * from " + "(" * 20_000 + "u" + ")" * 20_000
    texts = spark.createDataFrame([("select * from " + ", ".join(names),), (deep,)], "sql string").coalesce(1)
    began = monotonic()
    assert [r[0] for r in texts.select(tables_of_query(F.col("sql"))).collect()] == [names, ["u"]]
    assert monotonic() - began < 15


def test_queries_of_orders_hold_their_keys(spark, tmp_path):
    from tidemark.plans.transforms import order_queries

    rows = [(7, 12, "O", "1-URGENT"), (-8, 3, "F", "4-NOT SPECIFIED"), (None, 1, "P", "5-LOW"), (9, 1, None, "5-LOW")]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    found = {r.o_orderkey: r.sql for r in order_queries(spark, str(tmp_path)).collect()}
    assert found[None] is None and found[9] is None
    for key, cust, status, priority in ((7, "12", "o", "1_urgent"), (-8, "3", "f", "4_not_specified")):
        marked = str(key).replace("-", "_")
        assert found[key].startswith(f"WITH recent_{marked} (a, b) AS (SELECT x, 'from \"lost\" --' FROM raw.orders_{cust} /*")
        assert f"days_{status})\n" in found[key] and f"lake.parts_{priority} p" in found[key] and "{" not in found[key]
        assert found[key].endswith(f"customers_{cust})\n    UNION ALL SELECT a, b FROM RECENT_{marked}")
