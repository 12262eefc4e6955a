"""Projection, filters, clean-up, scaling and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import clean
from tidemark.plans.catalog import query
from tidemark.plans.retrieval import DAY, stamp
from tidemark.session import fresh_path, table


@query(
    "select_aliased", "SELECT event_id, ts AS event_timestamp, value AS amount FROM events"
)
def select_aliased(spark, root):
    mapping = {"ts": "event_timestamp", "value": "amount"}
    return clean.select_aliased(table(spark, root, "events"), ["event_id", "ts", "value"], mapping)


@query(
    "rename_forward",
    "SELECT c_custkey AS customer_id, c_name, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer",
)
def rename_forward(spark, root):
    mapping = {"c_custkey": "customer_id", "c_acctbal": "balance"}
    return clean.rename_forward(table(spark, root, "customer"), mapping)


RANGE = "ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12 12:00:00'"


@query("filter_time_range", f"SELECT event_id, ts, value FROM events WHERE {RANGE}")
def filter_time_range(spark, root):
    events = table(spark, root, "events").select("event_id", "ts", "value")
    return clean.filter_time_range(
        events, "ts", stamp("2024-01-05 00:00:00"), stamp("2024-01-12 12:00:00")
    )


@query("filter_date_partition", f"SELECT event_id, ts, value FROM events WHERE {RANGE}")
def filter_date_partition(spark, root):
    path = fresh_path(spark, "by-day")
    events = table(spark, root, "events").select("event_id", "ts", "value")
    stored = events.withColumn("day", F.date_format("ts", "yyyyMMdd"))
    stored.hint("rebalance", "day").write.partitionBy("day").parquet(path)
    back = spark.read.schema(stored.schema).parquet(path)
    start, end = stamp("2024-01-05 00:00:00"), stamp("2024-01-12 12:00:00")
    return clean.filter_date_partition(back, "ts", "day", "yyyyMMdd", start, end).drop("day")


@query(
    "filter_expr",
    "SELECT event_id, event_type, value FROM events WHERE value > 25 AND event_type IN ('click', 'view')",
)
def filter_expr(spark, root):
    events = table(spark, root, "events").select("event_id", "event_type", "value")
    return events.filter("value > 25 AND event_type IN ('click', 'view')")


@query(
    "filter_ttl_asof",
    """
SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_orderdate FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE l.l_shipdate <= o.o_orderdate AND l.l_shipdate >= o.o_orderdate - INTERVAL 90 DAY
""",
)
def filter_ttl_asof(spark, root):
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, root, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    joined = lines.join(orders, "l_orderkey")
    return clean.filter_ttl_asof(joined, "l_shipdate", "o_orderdate", 90 * DAY)


@query(
    "filter_ttl_now",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-25' - INTERVAL 3 DAY",
)
def filter_ttl_now(spark, root):
    events = table(spark, root, "events").select("event_id", "ts")
    return clean.filter_ttl_now(events, "ts", stamp("2024-01-25 00:00:00"), 3 * DAY)


FIRST_SQL = """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
  FROM events) WHERE rn = 1
"""


@query("drop_duplicates_key", FIRST_SQL)
def drop_duplicates_key(spark, root):
    events = table(spark, root, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return clean.drop_duplicates_key(events, ["user_id", "event_type"], "ts")


@query(
    "cast_numeric",
    """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       TRY_CAST(event_type AS DOUBLE) AS kind FROM events
""",
)
def cast_numeric(spark, root):
    events = table(spark, root, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias("kind")
    )
    return clean.cast_numeric(events, ["k", "kind"])


@query(
    "to_utc",
    """
SELECT event_id, (ts AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC' AS ts FROM events
""",
)
def to_utc(spark, root):
    events = table(spark, root, "events").select("event_id", "ts")
    moved = clean.to_utc(events, "ts", "America/Los_Angeles")
    return moved.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


GAPPY = """
gappy AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS quantity,
  CASE WHEN l_linestatus <> 'F' THEN l_extendedprice END AS price FROM lineitem)"""


def gappy(spark, root):
    return table(spark, root, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_linestatus") != "F", F.col("l_extendedprice")).alias("price"),
    )


@query(
    "fill_null_median",
    f"""
WITH {GAPPY}, m AS (SELECT median(quantity) AS mq, median(price) AS mp FROM gappy)
SELECT l_orderkey, l_linenumber, coalesce(quantity, (SELECT mq FROM m)) AS quantity,
       coalesce(price, (SELECT mp FROM m)) AS price FROM gappy
""",
)
def fill_null_median(spark, root):
    return clean.fill_null_median(gappy(spark, root), ["quantity", "price"])


@query(
    "fill_null_zero",
    f"""
WITH {GAPPY} SELECT l_orderkey, l_linenumber, coalesce(quantity, 0) AS quantity,
                    coalesce(price, 0) AS price FROM gappy
""",
)
def fill_null_zero(spark, root):
    return clean.fill_null_zero(gappy(spark, root), ["quantity", "price"])


@query(
    "fill_by_type",
    """
SELECT d.doc_id, coalesce(len(e.embedding), 0) AS width, e.label
FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id
""",
)
def fill_by_type(spark, root):
    documents = table(spark, root, "documents").select("doc_id")
    vectors = table(spark, root, "embeddings").withColumnRenamed("vec_id", "doc_id")
    joined = documents.join(vectors, "doc_id", "left")
    filled = clean.fill_by_type(joined, ["embedding", "label"])
    return filled.select("doc_id", F.size("embedding").cast("long").alias("width"), "label")


@query(
    "minmax_scale",
    """
WITH s AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, min(c_nationkey) AS nlo,
                  max(c_nationkey) AS nhi FROM customer)
SELECT c_custkey, (c_acctbal - lo) / (hi - lo) AS c_acctbal,
       (c_nationkey - nlo) / (nhi - nlo) AS c_nationkey, 0.0::DOUBLE AS constant
FROM customer, s
""",
)
def minmax_scale(spark, root):
    customer = table(spark, root, "customer").select(
        "c_custkey", "c_acctbal", "c_nationkey", F.lit(7.0).alias("constant")
    )
    return clean.minmax_scale(customer, ["c_acctbal", "c_nationkey", "constant"])


@query(
    "ratio_features",
    """
SELECT l_orderkey, l_linenumber,
       l_extendedprice / CASE WHEN l_quantity = 0 THEN 1 ELSE l_quantity END AS unit_price,
       l_extendedprice / CASE WHEN l_discount = 0 THEN 1 ELSE l_discount END AS per_discount
FROM lineitem
""",
)
def ratio_features(spark, root):
    lines = table(spark, root, "lineitem")
    ratios = {
        "unit_price": ("l_extendedprice", "l_quantity"),
        "per_discount": ("l_extendedprice", "l_discount"),
    }
    made = clean.ratio_features(lines, ratios)
    return made.select("l_orderkey", "l_linenumber", "unit_price", "per_discount")


@query(
    "label_encode",
    """
SELECT o_orderkey, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::INTEGER AS o_orderpriority,
       (dense_rank() OVER (ORDER BY o_orderstatus) - 1)::INTEGER AS o_orderstatus FROM orders
""",
)
def label_encode(spark, root):
    orders = table(spark, root, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return clean.label_encode(orders, ["o_orderpriority", "o_orderstatus"])


@query(
    "shift_event_time",
    """
WITH b AS (SELECT min(ts) AS old, min(ts) + INTERVAL 36 HOUR AS new FROM events)
SELECT event_id, ts + INTERVAL 36 HOUR AS ts,
       sha256(concat_ws('|', 'trace-7', old::VARCHAR, new::VARCHAR || '+00:00', 'EU', 'agent-1'))
         AS eu_date_reasoning_hash,
       'trace-7' AS eu_llm_trace_id, 'langsmith' AS eu_llm_monitoring_tool
FROM events, b
""",
)
def shift_event_time(spark, root):
    events = table(spark, root, "events").select("event_id", "ts")
    return clean.shift_event_time(
        events, "ts", 36, allowed=True, policy="EU", trace_id="trace-7", agent="agent-1"
    )


@query(
    "reasoning_hash",
    """
SELECT event_id, sha256(concat_ws('|', 'trace-' || event_id, strftime(ts, '%Y-%m-%d %H:%M:%S'),
         strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S'), 'EU', 'agent-' || user_id)) AS hash
FROM events
""",
)
def reasoning_hash(spark, root):
    pattern = "yyyy-MM-dd HH:mm:ss"
    return table(spark, root, "events").select(
        "event_id",
        clean.reasoning_hash(
            F.concat(F.lit("trace-"), "event_id"),
            F.date_format("ts", pattern),
            F.date_format(F.col("ts") + F.expr("INTERVAL 1 DAY"), pattern),
            F.lit("EU"),
            F.concat(F.lit("agent-"), "user_id"),
        ).alias("hash"),
    )


@query(
    "cast_complex_to_json",
    """
SELECT o_orderkey, '{"status":"' || o_orderstatus || '","priority":"' || o_orderpriority || '"}'
         AS detail, '[' || o_custkey || ',' || o_orderkey || ']' AS ids FROM orders
""",
)
def cast_complex_to_json(spark, root):
    nested = table(spark, root, "orders").select(
        "o_orderkey",
        F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).alias(
            "detail"
        ),
        F.array("o_custkey", "o_orderkey").alias("ids"),
    )
    target = T.StructType().add("o_orderkey", "long").add("detail", "string").add("ids", "string")
    return clean.cast_complex_to_json(nested, target)


@query(
    "convert_feature_types",
    """
SELECT vec_id::VARCHAR AS vec_id, label::BIGINT AS label, len(embedding) AS width,
       list_sum(list_transform(embedding, lambda x: trunc(x * 100)::BIGINT))::BIGINT AS cents,
       len(list_distinct(list_transform(embedding, lambda x: trunc(x * 10)::INTEGER))) AS levels
FROM embeddings
""",
)
def convert_feature_types(spark, root):
    vectors = table(spark, root, "embeddings").select(
        "vec_id",
        "label",
        F.transform("embedding", lambda x: x * F.lit(100).cast("float")).alias("cents"),
        F.transform("embedding", lambda x: x * F.lit(10).cast("float")).alias("levels"),
    )
    types = {"vec_id": "STRING", "label": "INT64", "cents": "INT64_LIST", "levels": "INT32_SET"}
    typed = clean.convert_feature_types(vectors, types)
    return typed.select(
        "vec_id",
        "label",
        F.size("cents").cast("long").alias("width"),
        F.aggregate("cents", F.lit(0).cast("long"), lambda a, x: a + x).alias("cents"),
        F.size("levels").cast("long").alias("levels"),
    )
