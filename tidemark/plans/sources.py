"""Readers and writers, each run as a round trip over a supplied table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators.materialize import read_online
from tidemark.plans.catalog import query
from tidemark.session import fresh_path, table
from tidemark.sources import readers, sinks

CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
ORDERS = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders"


def orders(spark, root):
    return table(spark, root, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )


@query("scan_csv", CUSTOMER)
def scan_csv(spark, root):
    path = fresh_path(spark, "customer-csv")
    customer = table(spark, root, "customer")
    customer.write.option("header", "true").csv(path)
    return readers.scan_csv(spark, path, customer.schema)


@query("scan_files", CUSTOMER)
def scan_files(spark, root):
    path = fresh_path(spark, "customer-json")
    customer = table(spark, root, "customer")
    customer.write.json(path)
    return readers.scan_files(spark, path, "json", customer.schema).select(*customer.columns)


@query("scan_table", CUSTOMER)
def scan_table(spark, root):
    table(spark, root, "customer").createOrReplaceTempView("scanned_customer")
    return readers.scan_table(spark, "scanned_customer")


@query(
    "scan_query",
    "SELECT c_mktsegment, count(*) AS n, max(c_acctbal) AS top FROM customer GROUP BY c_mktsegment",
)
def scan_query(spark, root):
    sql = "SELECT c_mktsegment, count(*) AS n, max(c_acctbal) AS top FROM {c} GROUP BY c_mktsegment"
    return readers.scan_query(spark, sql, c=table(spark, root, "customer"))


@query(
    "scan_documents",
    """
SELECT 'lang=' || lang AS folder, sum(length(text) + 1)::BIGINT AS chars,
       true AS all_text_files FROM documents GROUP BY lang
""",
)
def scan_documents(spark, root):
    path = fresh_path(spark, "documents")
    source = table(spark, root, "documents").select("lang", "text")
    source.write.partitionBy("lang").text(path)
    found = readers.scan_documents(spark, path)
    parts = F.split("source", "/")
    return found.groupBy(F.element_at(parts, -2).alias("folder")).agg(
        F.sum("size").cast("long").alias("chars"),
        F.bool_and(F.col("filename").endswith(".txt")).alias("all_text_files"),
    )


@query("scan_kafka_json", "SELECT event_id, user_id, ts, event_type, value FROM events")
def scan_kafka_json(spark, root):
    events = table(spark, root, "events").select("event_id", "user_id", "ts", "event_type", "value")
    options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    message = F.to_json(F.struct(*events.columns), options).cast("binary")
    return readers.decode_json(events.select(message.alias("value")), events.schema)


LATEST_CLICK = """
SELECT user_id, max_by(event_id, ts) AS event_id, max(ts) AS ts, max_by(value, ts) AS value
FROM events GROUP BY user_id
"""


@query("push_source", LATEST_CLICK)
def push_source(spark, root):
    path = fresh_path(spark, "push")
    rows = table(spark, root, "events").select("user_id", "event_id", "ts", "value")
    view = {
        "offline_path": f"{path}/offline",
        "online_path": f"{path}/online",
        "keys": ["user_id"],
        "ts": "ts",
    }
    early = rows.filter(F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'"))
    late = rows.filter(F.col("ts") >= F.expr("TIMESTAMP_NTZ '2024-01-10 00:00:00'"))
    for batch in (late, early):
        sinks.push_source(batch, [view], "online_and_offline")
    return read_online(spark, f"{path}/online", ["user_id"], "ts")


@query(
    "request_source",
    "SELECT o_orderkey, o_totalprice, o_totalprice * 0.1 AS deposit FROM orders",
)
def request_source(spark, root):
    spine = orders(spark, root).select("o_orderkey", "o_totalprice")
    checked = readers.require_request_columns(spine, ["o_totalprice"])
    return checked.withColumn("deposit", F.col("o_totalprice") * 0.1)


def stored_orders(spark, root):
    """Orders up to 1998 stored as the offline history, and the later ones to add."""
    path = fresh_path(spark, "orders")
    rows = orders(spark, root)
    cut = F.expr("TIMESTAMP_NTZ '1998-01-01 00:00:00'")
    rows.filter(F.col("o_orderdate") < cut).write.parquet(path)
    return path, rows.filter(F.col("o_orderdate") >= cut)


@query("sink_offline_append", ORDERS)
def sink_offline_append(spark, root):
    path, later = stored_orders(spark, root)
    text = later.withColumn("o_custkey", F.col("o_custkey").cast("string"))
    sinks.sink_offline_append(text, path)
    return spark.read.parquet(path)


@query("sink_offline_reorder", ORDERS)
def sink_offline_reorder(spark, root):
    path, later = stored_orders(spark, root)
    sinks.sink_offline_reorder(later.select(*reversed(later.columns)), path)
    return spark.read.parquet(path)


@query(
    "sink_view_output",
    """
SELECT o_custkey, max(o_orderdate) AS o_orderdate,
       max_by(o_orderkey, struct_pack(a := o_orderdate, b := o_orderkey)) AS o_orderkey
FROM orders GROUP BY o_custkey
""",
)
def sink_view_output(spark, root):
    path = fresh_path(spark, "view")
    rows = orders(spark, root).select("o_custkey", "o_orderkey", "o_orderdate")
    sinks.sink_view_output(
        rows, f"{path}/offline", f"{path}/online", ["o_custkey"], "o_orderdate"
    )
    return read_online(spark, f"{path}/online", ["o_custkey"], "o_orderdate")


@query("push_again", ORDERS)
def push_again(spark, root):
    """A push that is tried again under its name, beside one of another name, leaves one copy of each."""
    path = fresh_path(spark, "pushes")
    rows = orders(spark, root)
    late = F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ '1998-01-01 00:00:00'")
    for name, part in (("early", ~late), ("late", late), ("early", ~late)):
        sinks.sink_view_output(rows.filter(part), path, push=name)
    return spark.read.parquet(path).select(*rows.columns)


@query("persist_dataset", ORDERS)
def persist_dataset(spark, root):
    name = f"saved_{uuid.uuid4().hex}"
    path = fresh_path(spark, "saved")
    sinks.persist_dataset(orders(spark, root), name, "o_orderdate", path=path)
    return readers.scan_table(spark, name)


@query("export_staging", ORDERS)
def export_staging(spark, root):
    return spark.read.parquet(*sinks.export_staging(orders(spark, root)))


@query(
    "sink_feature_logs",
    """
SELECT user_id, value AS activity__value, 1 AS activity__value__status,
       strftime(ts, '%Y-%m-%d') AS log_date FROM events
""",
)
def sink_feature_logs(spark, root):
    path = fresh_path(spark, "logs")
    logs = table(spark, root, "events").select(
        "user_id",
        F.col("value").alias("activity__value"),
        F.lit(1).alias("activity__value__status"),
        F.date_format("ts", "yyyy-MM-dd").alias("log_date"),
    )
    sinks.sink_feature_logs(logs, path, ["log_date"])
    return spark.read.schema(logs.schema).parquet(path).select(*logs.columns)


@query(
    "introspect_schema",
    """
SELECT * FROM (VALUES ('event_id', 'INTEGER'), ('ts', 'TIMESTAMP'), ('user_id', 'INTEGER'),
  ('event_type', 'STRING'), ('value', 'FLOAT'), ('props', 'STRING')) t(name, type)
""",
)
def introspect_schema(spark, root):
    events = table(spark, root, "events")
    return readers.introspect_schema(events.select(*[F.col(c).cast("string") for c in events.columns]))
