"""Point-in-time joins, plain joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import asof, joins
from tidemark.plans.catalog import query
from tidemark.session import fresh_path, table
from tidemark.spec import ViewSpec

DAY = 24 * 3600


def purchases(spark, root):
    events = table(spark, root, "events").filter("event_type = 'purchase'")
    return events.select("event_id", "user_id", F.col("ts").alias("entity_ts"))


def activity(spark, root):
    events = table(spark, root, "events").filter("event_type <> 'purchase'")
    return events.select("user_id", "ts", "event_type", "value")


ACTIVITY = ViewSpec("activity", ["user_id"], ["event_type", "value"], "ts", ttl=7 * DAY)

PIT_SQL = """
WITH spine AS (
  SELECT event_id, user_id, ts AS entity_ts FROM events WHERE event_type = 'purchase'),
feat AS (SELECT user_id, ts, event_type, value FROM events WHERE event_type <> 'purchase'),
ranked AS (
  SELECT s.event_id, f.event_type, f.value,
         row_number() OVER (PARTITION BY s.event_id ORDER BY f.ts DESC) AS rn
  FROM spine s JOIN feat f ON f.user_id = s.user_id AND f.ts <= s.entity_ts
       AND f.ts >= s.entity_ts - INTERVAL 7 DAY)
SELECT s.event_id, s.user_id, s.entity_ts, r.event_type, r.value
FROM spine s LEFT JOIN ranked r ON r.event_id = s.event_id AND r.rn = 1
"""


@query("pit_join", PIT_SQL)
def pit_join(spark, root):
    return asof.pit_join(purchases(spark, root), activity(spark, root), ACTIVITY, "entity_ts")


@query("broadcast_asof", PIT_SQL)
def broadcast_asof(spark, root):
    return asof.broadcast_asof(purchases(spark, root), activity(spark, root), ACTIVITY, "entity_ts")


@query("windowed_asof", PIT_SQL)
def windowed_asof(spark, root):
    return asof.windowed_asof(
        purchases(spark, root), activity(spark, root), ACTIVITY, "entity_ts", window_seconds=DAY
    )


@query(
    "pit_join_renamed",
    PIT_SQL.replace("r.event_type, r.value\n", "r.event_type AS kind, r.value AS amount\n"),
)
def pit_join_renamed(spark, root):
    """A source laid out by day, whose columns bear other names than the view's features."""
    path = fresh_path(spark, "by_day")
    daily = activity(spark, root).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    daily.repartition("day").write.partitionBy("day").parquet(path)
    view = ViewSpec(
        "activity",
        ["user_id"],
        ["kind", "amount"],
        "at",
        ttl=7 * DAY,
        renames={"event_type": "kind", "value": "amount", "ts": "at"},
        partition="day",
    )
    return asof.pit_join(purchases(spark, root), spark.read.parquet(path), view, "entity_ts")


def of_type(spark, root, kind, *columns):
    events = table(spark, root, "events").filter(F.col("event_type") == kind)
    return events.select("user_id", "ts", *columns)


CLICKS = ViewSpec("clicks", ["user_id"], ["value"], "ts", ttl=3 * DAY)
ERRORS = ViewSpec("errors", ["user_id"], ["value", "props"], "ts")


def asof_sql(kind: str, columns: str, ttl: str = "") -> str:
    """Newest ``kind`` event per spine row of ``spine(event_id, user_id, entity_ts)``."""
    bound = f" AND f.ts >= s.entity_ts - INTERVAL {ttl}" if ttl else ""
    return f"""
      SELECT s.event_id, {columns}, row_number() OVER (PARTITION BY s.event_id ORDER BY f.ts DESC) AS rn
      FROM spine s JOIN events f ON f.event_type = '{kind}' AND f.user_id = s.user_id
           AND f.ts <= s.entity_ts{bound}"""


@query(
    "pit_join_multi",
    f"""
WITH spine AS (SELECT event_id, user_id, ts AS entity_ts FROM events WHERE event_type = 'purchase'),
c AS ({asof_sql("click", "f.value", "3 DAY")}),
e AS ({asof_sql("error", "f.value, f.props")})
SELECT s.event_id, s.user_id, s.entity_ts, c.value AS clicks__value,
       e.value AS errors__value, e.props AS errors__props
FROM spine s LEFT JOIN c ON c.event_id = s.event_id AND c.rn = 1
LEFT JOIN e ON e.event_id = s.event_id AND e.rn = 1
""",
)
def pit_join_multi(spark, root):
    views = [
        (of_type(spark, root, "click", "value"), CLICKS),
        (of_type(spark, root, "error", "value", "props"), ERRORS),
    ]
    return asof.pit_join_multi(purchases(spark, root), views, "entity_ts")


@query(
    "pit_join_backfill",
    """
WITH spine AS (SELECT event_id, user_id, ts AS entity_ts FROM events WHERE event_type = 'purchase'),
src AS (SELECT * FROM events WHERE event_type <> 'purchase'),
feat AS (
  SELECT user_id, ts, ts + INTERVAL 1 MINUTE AS created, event_type, value FROM src
  UNION ALL
  SELECT user_id, ts, ts + to_minutes(event_id % 5), event_type, value * 2 FROM src),
ranked AS (
  SELECT s.event_id, f.event_type, f.value, row_number() OVER (PARTITION BY s.event_id
         ORDER BY f.ts DESC, f.created DESC, f.event_type DESC, f.value DESC) AS rn
  FROM spine s JOIN feat f ON f.user_id = s.user_id AND f.ts <= s.entity_ts
       AND f.ts >= s.entity_ts - INTERVAL 7 DAY)
SELECT s.event_id, s.user_id, s.entity_ts, r.event_type, r.value
FROM spine s LEFT JOIN ranked r ON r.event_id = s.event_id AND r.rn = 1
""",
)
def pit_join_backfill(spark, root):
    source = table(spark, root, "events").filter("event_type <> 'purchase'")
    first = source.withColumn("created", F.col("ts") + F.expr("INTERVAL 1 MINUTE"))
    again = source.withColumn(
        "created", F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") % 5).cast("int"))
    ).withColumn("value", F.col("value") * 2)
    view = ViewSpec("activity", ["user_id"], ["event_type", "value"], "ts", "created", 7 * DAY)
    return asof.pit_join(purchases(spark, root), first.unionByName(again), view, "entity_ts")


DAILY_SQL = """
daily AS (SELECT l_shipdate AS day, sum(l_quantity) AS day_quantity, count(*) AS day_lines
          FROM lineitem GROUP BY 1)"""


def daily_series(spark, root):
    return (
        table(spark, root, "lineitem")
        .groupBy(F.col("l_shipdate").alias("day"))
        .agg(F.sum("l_quantity").alias("day_quantity"), F.count("*").alias("day_lines"))
    )


@query(
    "pit_join_no_key",
    f"""
WITH {DAILY_SQL}
SELECT o.o_orderkey, o.o_orderdate,
       CASE WHEN d.day >= o.o_orderdate - INTERVAL 1 DAY THEN d.day_quantity END AS day_quantity,
       CASE WHEN d.day >= o.o_orderdate - INTERVAL 1 DAY THEN d.day_lines END AS day_lines
FROM orders o ASOF LEFT JOIN daily d ON o.o_orderdate >= d.day
""",
)
def pit_join_no_key(spark, root):
    spine = table(spark, root, "orders").select("o_orderkey", "o_orderdate")
    view = ViewSpec("daily", [], ["day_quantity", "day_lines"], "day", ttl=DAY)
    return asof.pit_join(spine, daily_series(spark, root), view, "o_orderdate")


END = "2024-01-20 00:00:00"


def stamp(text: str):
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def non_entity_views(spark, root):
    return [
        (of_type(spark, root, "click", "value"), CLICKS),
        (
            of_type(spark, root, "view", "value"),
            ViewSpec("views", ["user_id"], ["value"], "ts", ttl=2 * DAY),
        ),
    ]


@query(
    "non_entity_retrieval",
    f"""
WITH seen AS (
  SELECT DISTINCT user_id, TIMESTAMP '{END}' AS entity_ts FROM events
  WHERE event_type IN ('click', 'view')
    AND ts BETWEEN TIMESTAMP '{END}' - INTERVAL 3 DAY AND TIMESTAMP '{END}'),
c AS (SELECT user_id, max_by(value, ts) AS v FROM events WHERE event_type = 'click'
      AND ts BETWEEN TIMESTAMP '{END}' - INTERVAL 3 DAY AND TIMESTAMP '{END}' GROUP BY 1),
w AS (SELECT user_id, max_by(value, ts) AS v FROM events WHERE event_type = 'view'
      AND ts BETWEEN TIMESTAMP '{END}' - INTERVAL 2 DAY AND TIMESTAMP '{END}' GROUP BY 1)
SELECT s.user_id, s.entity_ts, c.v AS clicks__value, w.v AS views__value
FROM seen s LEFT JOIN c USING (user_id) LEFT JOIN w USING (user_id)
""",
)
def non_entity_retrieval(spark, root):
    return asof.non_entity_retrieval(non_entity_views(spark, root), None, stamp(END))


@query(
    "non_entity_keep_ts",
    f"""
WITH spine AS (
  SELECT DISTINCT user_id, ts AS entity_ts, user_id || '@' || ts AS event_id FROM events
  WHERE event_type IN ('click', 'view')
    AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '{END}'),
c AS ({asof_sql("click", "f.value", "3 DAY")}),
w AS ({asof_sql("view", "f.value", "2 DAY")})
SELECT s.user_id, s.entity_ts, c.value AS clicks__value, w.value AS views__value
FROM spine s LEFT JOIN c ON c.event_id = s.event_id AND c.rn = 1
LEFT JOIN w ON w.event_id = s.event_id AND w.rn = 1
""",
)
def non_entity_keep_ts(spark, root):
    views = non_entity_views(spark, root)
    start = stamp("2024-01-05 00:00:00")
    return asof.non_entity_retrieval(views, start, stamp(END), keep_ts=True)


@query(
    "join_views",
    """
SELECT c.c_custkey, c.c_mktsegment AS profile__c_mktsegment, c.c_acctbal AS profile__c_acctbal,
       o.n_orders AS orders__n_orders, o.max_total AS orders__max_total
FROM customer c JOIN (SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS max_total
                      FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey
""",
)
def join_views(spark, root):
    profile = table(spark, root, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    per_customer = (
        table(spark, root, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("n_orders"), F.max("o_totalprice").alias("max_total"))
    )
    return joins.join_views([("profile", profile), ("orders", per_customer)], ["c_custkey"])


@query(
    "join_entity_left",
    """
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate AS entity_event_timestamp,
       c.c_name, c.c_mktsegment, c.c_acctbal
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
""",
)
def join_entity_left(spark, root):
    spine = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    features = table(spark, root, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_acctbal"
    )
    return joins.join_entity_left(spine, features, ["o_custkey"], "o_orderdate")


@query(
    "join_aggregated",
    """
SELECT o.o_orderkey, o.o_orderdate, a.sum_quantity, a.n_lines
FROM orders o LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS sum_quantity, count(*) AS n_lines
                         FROM lineitem GROUP BY 1) a ON a.l_orderkey = o.o_orderkey
""",
)
def join_aggregated(spark, root):
    spine = table(spark, root, "orders").select("o_orderkey", "o_orderdate")
    totals = (
        table(spark, root, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum("l_quantity").alias("sum_quantity"), F.count("*").alias("n_lines"))
    )
    return joins.join_aggregated(spine, totals, ["o_orderkey"])


@query(
    "attach_target",
    """
SELECT e.user_id, e.ts, e.event_id, e.value, t.bought
FROM events e LEFT JOIN (SELECT user_id, ts, 1 AS bought FROM events
                         WHERE event_type = 'purchase') t USING (user_id, ts)
""",
)
def attach_target(spark, root):
    events = table(spark, root, "events")
    target = events.filter("event_type = 'purchase'").select(
        "user_id", "ts", F.lit(1).alias("bought")
    )
    features = events.select("user_id", "ts", "event_id", "value")
    return joins.attach_target(features, target, ["user_id"], "ts")


@query(
    "outer_join_windows",
    """
WITH h AS (SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start,
                  count(*) AS n_6h FROM events GROUP BY ALL),
d AS (SELECT user_id, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start,
             count(*) AS n_24h FROM events GROUP BY ALL)
SELECT user_id, window_start, n_6h, n_24h FROM h FULL JOIN d USING (user_id, window_start)
""",
)
def outer_join_windows(spark, root):
    events = table(spark, root, "events")

    def counted(length, name):
        grouped = events.groupBy("user_id", F.window("ts", length).alias("w"))
        counts = grouped.agg(F.count("*").alias(name))
        return counts.select("user_id", F.col("w.start").alias("window_start"), name)

    frames = [counted("6 hours", "n_6h"), counted("1 day", "n_24h")]
    return joins.outer_join_windows(frames, ["user_id", "window_start"])


@query(
    "cross_join_dummy",
    f"""
WITH {DAILY_SQL},
newest AS (SELECT * FROM daily WHERE day <= TIMESTAMP '1998-01-01' ORDER BY day DESC LIMIT 1)
SELECT c.c_custkey, '' AS __dummy_id, n.day_quantity, n.day_lines, n.day
FROM customer c LEFT JOIN newest n ON true
""",
)
def cross_join_dummy(spark, root):
    spine = table(spark, root, "customer").select("c_custkey")
    view = ViewSpec("daily", [], ["day_quantity", "day_lines"], "day")
    start, end = stamp("1970-01-01 00:00:00"), stamp("1998-01-01 00:00:00")
    return joins.cross_join_dummy(spine, daily_series(spark, root), view, start, end)


@query(
    "semi_requested",
    """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""",
)
def semi_requested(spark, root):
    asked = table(spark, root, "customer").filter("c_mktsegment = 'BUILDING'")
    asked = asked.select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.semi_requested(orders, asked, ["o_custkey"])


@query(
    "diff_objects",
    """
WITH cur AS (SELECT 'part-' || p_partkey AS name, p_brand, p_type, p_size FROM part WHERE p_size <= 40),
des AS (SELECT 'part-' || p_partkey AS name,
               CASE WHEN p_type = 'ECONOMY' THEN 'Brand#0' ELSE p_brand END AS p_brand,
               p_type, CASE WHEN p_size > 35 THEN p_size + 1 ELSE p_size END AS p_size
        FROM part WHERE p_size >= 10),
j AS (SELECT coalesce(c.name, d.name) AS name, c.name IS NULL AS fresh, d.name IS NULL AS gone,
             CASE WHEN c.name IS NULL OR d.name IS NULL THEN '' ELSE concat_ws(',',
               CASE WHEN c.p_brand IS DISTINCT FROM d.p_brand THEN 'p_brand' END,
               CASE WHEN c.p_type IS DISTINCT FROM d.p_type THEN 'p_type' END,
               CASE WHEN c.p_size IS DISTINCT FROM d.p_size THEN 'p_size' END) END AS changed
      FROM cur c FULL JOIN des d ON c.name = d.name)
SELECT name, CASE WHEN fresh THEN 'add' WHEN gone THEN 'delete' ELSE 'keep' END AS tag,
       CASE WHEN fresh THEN 'CREATE' WHEN gone THEN 'DELETE' WHEN changed <> '' THEN 'UPDATE'
            ELSE 'UNCHANGED' END AS transition, changed
FROM j
""",
)
def diff_objects(spark, root):
    part = table(spark, root, "part").withColumn("name", F.concat(F.lit("part-"), "p_partkey"))
    desired = (
        part.filter("p_size >= 10")
        .withColumn("p_brand", F.expr("if(p_type = 'ECONOMY', 'Brand#0', p_brand)"))
        .withColumn("p_size", F.expr("if(p_size > 35, p_size + 1, p_size)"))
    )
    current = part.filter("p_size <= 40")
    return joins.diff_objects(current, desired, "name", ["p_brand", "p_type", "p_size"])


@query(
    "union_distinct_keys",
    """
SELECT DISTINCT user_id, event_type FROM events
UNION SELECT o_custkey, NULL FROM orders
""",
)
def union_distinct_keys(spark, root):
    events = table(spark, root, "events").select("user_id", "event_type")
    orders = table(spark, root, "orders").select(F.col("o_custkey").alias("user_id"))
    return joins.union_distinct_keys([events, orders])


@query(
    "union_all_sources",
    """
SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'click'
UNION SELECT event_id, user_id, ts, value FROM events WHERE value > 50
""",
)
def union_all_sources(spark, root):
    events = table(spark, root, "events")
    columns = ["event_id", "user_id", "ts", "value"]
    clicks = events.filter("event_type = 'click'").select(*columns)
    large = events.filter("value > 50").select(*columns)
    return joins.union_all_sources([clicks, large])


@query(
    "join_key_remap",
    """
WITH home AS (SELECT n_nationkey, n_name, n_regionkey FROM nation),
spine AS (SELECT l_orderkey, l_linenumber, l_suppkey, o_custkey FROM lineitem
          JOIN orders ON o_orderkey = l_orderkey)
SELECT s.l_orderkey, s.l_linenumber, c.c_nationkey AS buyer_nation, p.s_nationkey AS seller_nation,
       b.n_name AS buyer__n_name, b.n_regionkey AS buyer__n_regionkey,
       v.n_name AS seller__n_name, v.n_regionkey AS seller__n_regionkey
FROM spine s JOIN customer c ON c.c_custkey = s.o_custkey JOIN supplier p ON p.s_suppkey = s.l_suppkey
LEFT JOIN home b ON b.n_nationkey = c.c_nationkey LEFT JOIN home v ON v.n_nationkey = p.s_nationkey
""",
)
def join_key_remap(spark, root):
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    orders = table(spark, root, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    buyers = table(spark, root, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("buyer_nation")
    )
    sellers = table(spark, root, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("seller_nation")
    )
    spine = lines.join(orders, "l_orderkey").join(buyers, "o_custkey").join(sellers, "l_suppkey")
    spine = spine.select("l_orderkey", "l_linenumber", "buyer_nation", "seller_nation")
    nation = table(spark, root, "nation").select("n_nationkey", "n_name", "n_regionkey")
    for alias in ("buyer", "seller"):
        key = f"{alias}_nation"
        home = joins.prefixed(joins.remap_keys(nation, {"n_nationkey": key}), alias, [key])
        spine = spine.join(home, key, "left")
    return spine.select(
        "l_orderkey",
        "l_linenumber",
        "buyer_nation",
        "seller_nation",
        *[c for c in spine.columns if "__" in c],
    )


@query(
    "full_feature_names",
    PIT_SQL.replace("r.event_type, r.value", "r.event_type AS activity__event_type, r.value AS activity__value"),
)
def full_feature_names(spark, root):
    spine = purchases(spark, root)
    return asof.pit_join(spine, activity(spark, root), ACTIVITY, "entity_ts", full_names=True)
