"""Materialization, upserts and batch lookups."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import materialize as mat
from tidemark.operators.commits import IntervalLog, incremental_run
from tidemark.operators.online import OnlineTable
from tidemark.operators.retrieval import historical_features, infer_view, online_features
from tidemark.operators.transform import OnDemandView
from tidemark.plans.catalog import query
from tidemark.plans.retrieval import DAY, stamp
from tidemark.session import fresh_path, table
from tidemark.spec import ViewSpec

START, END = "2024-01-05 00:00:00", "2024-01-25 00:00:00"
BETWEEN = f"ts BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"
ACTIVITY = ViewSpec("activity", ["user_id"], ["event_type", "value"], "ts")


def activity(spark, root):
    return table(spark, root, "events").select("user_id", "event_type", "value", "ts")


def latest(spark, root):
    """Newest event of each user who bought something, the stored side of the lookups."""
    bought = activity(spark, root).filter("event_type = 'purchase'")
    return mat.materialize(bought, ACTIVITY, stamp("2024-01-01 00:00:00"), stamp(END))


LATEST = f"""
latest AS (SELECT user_id, max_by(value, ts) AS value, max(ts) AS ts FROM events
           WHERE event_type = 'purchase' AND ts <= TIMESTAMP '{END}' GROUP BY user_id)"""


@query(
    "materialize",
    f"""
SELECT user_id, max_by(event_type, ts) AS event_type, max_by(value * 2, ts) AS value, max(ts) AS ts
FROM events WHERE {BETWEEN} AND value * 2 > 10 GROUP BY user_id
""",
)
def materialize(spark, root):
    return mat.materialize(
        activity(spark, root),
        ACTIVITY,
        stamp(START),
        stamp(END),
        transform=lambda df: df.withColumn("value", F.col("value") * 2),
        predicate="value > 10",
    )


@query(
    "materialize_incremental",
    """
SELECT user_id, max_by(event_type, ts) AS event_type, max_by(value, ts) AS value, max(ts) AS ts
FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-28' GROUP BY user_id
""",
)
def materialize_incremental(spark, root):
    path = fresh_path(spark, "incremental")
    done = []
    for now in (datetime(2024, 1, 15), datetime(2024, 1, 20), datetime(2024, 1, 28)):
        start, end = mat.next_interval(done, 7 * DAY, now)
        rows = mat.materialize(activity(spark, root), ACTIVITY, stamp(start), stamp(end))
        mat.write_online(rows, path, ["user_id"], "ts", batch=len(done))
        done.append((start, end))
    return mat.read_online(spark, path, ["user_id"], "ts")


@query(
    "incremental_log",
    """
SELECT user_id, max_by(event_type, ts) AS event_type, max_by(value, ts) AS value, max(ts) AS ts
FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-28' GROUP BY user_id
""",
)
def incremental_log(spark, root):
    """Runs of two writers take turns over one log; one fails after its write and is started again."""
    path, log = fresh_path(spark, "logged"), IntervalLog(spark, fresh_path(spark, "intervals"))

    def rows(start, end):
        return mat.materialize(activity(spark, root), ACTIVITY, stamp(start), stamp(end))

    def write(df, batch):
        mat.write_online(df, path, ["user_id"], "ts", batch=batch, writer="incremental")

    incremental_run(log, "a-1", 7 * DAY, datetime(2024, 1, 15), rows, write)
    lost = log.claim("b-1", 7 * DAY, datetime(2024, 1, 20))
    write(rows(lost.start, lost.end), lost.number)
    incremental_run(log, "a-2", 7 * DAY, datetime(2024, 1, 28), rows, write)
    for run in ("b-1", "a-1"):
        incremental_run(log, run, 7 * DAY, datetime(2024, 1, 30), rows, write)
    return mat.read_online(spark, path, ["user_id"], "ts")


@query(
    "materialize_on_demand",
    f"""
WITH c AS (SELECT user_id, max_by(value, ts) AS v, max(ts) AS ts FROM events
           WHERE event_type = 'click' AND {BETWEEN} GROUP BY user_id),
w AS (SELECT user_id, max_by(value, ts) AS v, max(ts) AS ts FROM events
      WHERE event_type = 'view' AND {BETWEEN} GROUP BY user_id),
spine AS (SELECT user_id, ts FROM c UNION SELECT user_id, ts FROM w),
f AS (SELECT s.user_id, s.ts,
        (SELECT max_by(value, e.ts) FROM events e WHERE event_type = 'click' AND e.user_id = s.user_id
           AND e.ts <= s.ts) AS clicks,
        (SELECT max_by(value, e.ts) FROM events e WHERE event_type = 'view' AND e.user_id = s.user_id
           AND e.ts <= s.ts) AS views
      FROM spine s)
SELECT user_id, ts AS entity_ts, clicks + views AS both_values FROM f
""",
)
def materialize_on_demand(spark, root):
    def kind(name):
        events = table(spark, root, "events").filter(F.col("event_type") == name)
        return events.select("user_id", "ts", "value")

    sources = [
        (kind("click"), ViewSpec("clicks", ["user_id"], ["value"], "ts")),
        (kind("view"), ViewSpec("views", ["user_id"], ["value"], "ts")),
    ]

    def add(df):
        both = F.col("clicks__value") + F.col("views__value")
        return df.select("user_id", "entity_ts", both.alias("both_values"))

    return mat.materialize_on_demand(sources, stamp(START), stamp(END), add)


@query(
    "materialize_chained",
    """
WITH spend AS (SELECT o_custkey, max(o_totalprice) AS top, count(*) AS n FROM orders GROUP BY 1),
seg AS (SELECT c_mktsegment, max(top) AS top, sum(n)::BIGINT AS n FROM customer
        JOIN spend ON o_custkey = c_custkey GROUP BY 1)
SELECT c_custkey, s.top / g.top AS share_of_top FROM customer c
JOIN spend s ON s.o_custkey = c.c_custkey JOIN seg g ON g.c_mktsegment = c.c_mktsegment
""",
)
def materialize_chained(spark, root):
    customer = table(spark, root, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, root, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")

    def spend():
        return orders.groupBy("c_custkey").agg(
            F.max("o_totalprice").alias("top"), F.count("*").alias("n")
        )

    def segments(spent):
        joined = customer.join(spent, "c_custkey")
        return joined.groupBy("c_mktsegment").agg(F.max("top").alias("segment_top"))

    def shares(spent, segment):
        joined = customer.join(spent, "c_custkey").join(segment, "c_mktsegment")
        return joined.select("c_custkey", (F.col("top") / F.col("segment_top")).alias("share_of_top"))

    views = {
        "spend": ([], spend),
        "segments": (["spend"], segments),
        "shares": (["spend", "segments"], shares),
    }
    return mat.materialize_chained(views, "shares")


@query(
    "upsert_latest",
    """
SELECT user_id, max_by(value, ts) AS value, max(ts) AS ts FROM (
  SELECT user_id, ts, value FROM events WHERE event_type <> 'click'
  UNION ALL
  SELECT user_id, ts, value FROM events WHERE event_type = 'click') GROUP BY user_id
""",
)
def upsert_latest(spark, root):
    rows = activity(spark, root)
    old = rows.filter("event_type <> 'click'")
    new = rows.filter("event_type = 'click'").select("user_id", "value", "ts")
    stored = mat.dedup_latest(old.select("user_id", "value", "ts"), ["user_id"], "ts")
    return mat.upsert_latest(stored, new, ["user_id"], "ts")


@query(
    "online_lookup",
    f"WITH {LATEST} SELECT e.event_id, e.user_id, l.value, l.ts FROM events e LEFT JOIN latest l USING (user_id)",
)
def online_lookup(spark, root):
    requests = table(spark, root, "events").select("event_id", "user_id")
    stored = latest(spark, root).select("user_id", "value", "ts")
    found = mat.online_lookup(requests, stored, ["user_id"])
    return found.select("event_id", "user_id", "value", "ts")


def bucketed(spark, root):
    """Purchases as pushes by weekday, one of them again, and the last ones merged into their buckets."""
    stored = OnlineTable(spark, fresh_path(spark, "bucketed"), ["user_id"], "ts", buckets=16)
    rows = activity(spark, root).filter("event_type = 'purchase'").filter(F.col("ts") <= stamp(END))
    rows = rows.select("user_id", "value", "ts")
    late = F.col("ts") > stamp("2024-01-20 00:00:00")
    for day in (1, 2, 2, 3, 4, 5, 6, 7):
        stored.append(rows.filter(~late & (F.dayofweek("ts") == day)), push=f"day-{day}")
    stored.upsert(rows.filter(late))
    return stored


@query(
    "online_buckets",
    f"""
WITH {LATEST} SELECT o.o_orderkey, o.o_custkey AS user_id, l.value, l.ts
FROM orders o LEFT JOIN latest l ON l.user_id = o.o_custkey
""",
)
def online_buckets(spark, root):
    """Lookups in a table of key-hash folders."""
    requests = table(spark, root, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    found = bucketed(spark, root).lookup(requests)
    return found.select("o_orderkey", "user_id", "value", "ts")


@query(
    "requested_buckets",
    f"""
WITH {LATEST} SELECT user_id, value, ts FROM latest
WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""",
)
def requested_buckets(spark, root):
    """Rows of the requested keys, after all buckets were compacted."""
    stored = bucketed(spark, root)
    stored.compact()
    wanted = table(spark, root, "customer").filter("c_mktsegment = 'BUILDING'")
    return stored.requested(wanted.select(F.col("c_custkey").alias("user_id")))


@query(
    "lookup_status",
    f"""
WITH {LATEST}
SELECT o.o_orderkey, o.o_custkey AS user_id, l.value, CASE WHEN l.ts IS NULL THEN 'NOT_FOUND'
  WHEN l.ts < TIMESTAMP '{END}' - INTERVAL 2 DAY THEN 'OUTSIDE_MAX_AGE' ELSE 'PRESENT' END AS status
FROM orders o LEFT JOIN latest l ON l.user_id = o.o_custkey
""",
)
def lookup_status(spark, root):
    requests = table(spark, root, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    stored = latest(spark, root).select("user_id", "value", "ts")
    found = mat.lookup_status(requests, stored, ["user_id"], "ts", 2 * DAY, stamp(END))
    return found.select("o_orderkey", "user_id", "value", "status")


@query(
    "list_append_update",
    """
WITH a AS (SELECT user_id, min(value) AS lo, max(value) AS hi FROM events
           WHERE event_type = 'click' GROUP BY 1),
b AS (SELECT user_id, min(value) AS lo, max(value) AS hi FROM events
      WHERE event_type = 'view' GROUP BY 1)
SELECT coalesce(a.user_id, b.user_id) AS user_id,
  concat_ws(',', a.lo::VARCHAR, a.hi::VARCHAR, b.lo::VARCHAR, b.hi::VARCHAR) AS appended,
  concat_ws(',', b.lo::VARCHAR, b.hi::VARCHAR, a.lo::VARCHAR, a.hi::VARCHAR) AS prepended
FROM a FULL JOIN b ON a.user_id = b.user_id
""",
)
def list_append_update(spark, root):
    def bounds(kind):
        rows = activity(spark, root).filter(F.col("event_type") == kind).groupBy("user_id")
        return rows.agg(F.array(F.min("value"), F.max("value")).alias("vals"))

    def text(df, name):
        return df.select("user_id", F.array_join(F.col("vals").cast("array<string>"), ",").alias(name))

    stored, added = bounds("click"), bounds("view")
    after = text(mat.list_append_update(stored, added, ["user_id"], "vals"), "appended")
    before = text(mat.list_append_update(stored, added, ["user_id"], "vals", True), "prepended")
    return after.join(before, "user_id")


@query(
    "response_to_columns",
    f"""
WITH {LATEST}
SELECT c.c_custkey AS user_id, l.value, l.ts AS value__ts
FROM customer c LEFT JOIN latest l ON l.user_id = c.c_custkey
""",
)
def response_to_columns(spark, root):
    requests = table(spark, root, "customer").select(F.col("c_custkey").alias("user_id"))
    found = mat.online_lookup(requests, latest(spark, root), ["user_id"])
    return mat.response_to_columns(found, ["user_id"], ["value"], "ts", True)


@query("eav_pivot", "SELECT c_custkey, c_acctbal, c_mktsegment, c_nationkey FROM customer")
def eav_pivot(spark, root):
    kinds = {"c_acctbal": "double", "c_mktsegment": "string", "c_nationkey": "int"}
    eav = mat.to_eav(table(spark, root, "customer"), ["c_custkey"], list(kinds), [])
    return mat.eav_pivot(eav, ["c_custkey"], [], kinds)


SUM = OnDemandView("mix", {"clicks": ["value"], "views": ["value"]}, {"total": "clicks__value + views__value"})


def kind_views(spark, root):
    """Clicks and views as two stored views over the same users."""

    def rows(kind):
        events = table(spark, root, "events").filter(F.col("event_type") == kind)
        return events.select("user_id", "ts", "value", "props")

    return {
        name: (rows(kind), infer_view(rows(kind), name, ["user_id"], ttl=10 * DAY))
        for name, kind in (("clicks", "click"), ("views", "view"))
    }


def newest_sql(kind: str) -> str:
    return f"""(SELECT max_by(f.value, f.ts) FROM events f WHERE f.event_type = '{kind}'
      AND f.user_id = s.user_id AND f.ts <= s.entity_ts AND f.ts >= s.entity_ts - INTERVAL 10 DAY)"""


@query(
    "historical_features",
    f"""
WITH spine AS (SELECT event_id, user_id, ts AS entity_ts FROM events WHERE event_type = 'purchase'),
f AS (SELECT s.*, {newest_sql("click")} AS c, {newest_sql("view")} AS v FROM spine s)
SELECT event_id, user_id, entity_ts, c + v AS mix__total, c AS clicks__value FROM f
""",
)
def historical_features_query(spark, root):
    events = table(spark, root, "events").filter("event_type = 'purchase'")
    spine = events.select("event_id", "user_id", F.col("ts").alias("entity_ts"))
    refs = ["mix:total", "clicks:value"]
    views = kind_views(spark, root)
    return historical_features(spine, views, refs, on_demand=[SUM], full_names=True)


MAPPED_SQL = f"""
WITH spine AS (SELECT event_id, user_id, ts AS entity_ts FROM events WHERE event_type = 'purchase')
SELECT event_id, user_id, entity_ts, {newest_sql("click")} AS clicks__amount FROM spine s
"""


def mapped_view(spark, root):
    """Clicks stored under other names and laid out by day, and the view that maps them."""
    path = fresh_path(spark, "mapped")
    clicks = table(spark, root, "events").filter("event_type = 'click'")
    stored = clicks.select(
        F.col("user_id").alias("uid"), F.col("ts").alias("at"), F.col("value").alias("raw"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )
    stored.repartition("day").write.partitionBy("day").parquet(path)
    names = {"uid": "user_id", "at": "ts", "raw": "amount"}
    view = ViewSpec("any", ["user_id"], ["amount"], "ts", ttl=10 * DAY, renames=names, partition="day")
    return spark.read.parquet(path), view


@query("historical_mapped", MAPPED_SQL)
def historical_mapped(spark, root):
    """A view under another name, with mapped columns, over folders by day."""
    spine = table(spark, root, "events").filter("event_type = 'purchase'")
    spine = spine.select("event_id", "user_id", F.col("ts").alias("entity_ts"))
    return historical_features(spine, {"clicks": mapped_view(spark, root)}, ["clicks:amount"], full_names=True)


@query(
    "online_mapped",
    """
WITH c AS (SELECT user_id, max_by(value, ts) AS amount, max(ts) AS ts FROM events WHERE event_type = 'click' GROUP BY 1)
SELECT o_orderkey, o_custkey AS user_id, amount,
  CASE WHEN c.ts IS NULL THEN 'NOT_FOUND' WHEN c.ts < TIMESTAMP '2024-01-31' - INTERVAL 10 DAY
    THEN 'OUTSIDE_MAX_AGE' ELSE 'PRESENT' END AS clicks__status
FROM orders LEFT JOIN c ON c.user_id = o_custkey
""",
)
def online_mapped(spark, root):
    """The stored side keeps the source's names; the view maps them."""
    df, view = mapped_view(spark, root)
    requests = table(spark, root, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    tables = {"clicks": (mat.dedup_latest(df.drop("day"), ["uid"], "at"), view)}
    return online_features(requests, tables, ["clicks:amount"], stamp("2024-01-31 00:00:00"))


@query(
    "online_features",
    f"""
WITH c AS (SELECT user_id, max_by(value, ts) AS value, max(ts) AS ts FROM events
           WHERE event_type = 'click' GROUP BY 1),
v AS (SELECT user_id, max_by(value, ts) AS value, max(ts) AS ts FROM events
      WHERE event_type = 'view' GROUP BY 1)
SELECT o_orderkey, o_custkey AS user_id, c.value + v.value AS total,
  CASE WHEN c.ts IS NULL THEN 'NOT_FOUND' WHEN c.ts < TIMESTAMP '2024-02-08' - INTERVAL 10 DAY
    THEN 'OUTSIDE_MAX_AGE' ELSE 'PRESENT' END AS clicks__status,
  CASE WHEN v.ts IS NULL THEN 'NOT_FOUND' WHEN v.ts < TIMESTAMP '2024-02-08' - INTERVAL 10 DAY
    THEN 'OUTSIDE_MAX_AGE' ELSE 'PRESENT' END AS views__status
FROM orders LEFT JOIN c ON c.user_id = o_custkey LEFT JOIN v ON v.user_id = o_custkey
""",
)
def online_features_query(spark, root):
    requests = table(spark, root, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    stored = {
        name: (mat.dedup_latest(df, ["user_id"], "ts"), view)
        for name, (df, view) in kind_views(spark, root).items()
    }
    now = stamp("2024-02-08 00:00:00")
    return online_features(requests, stored, ["mix:total"], now, on_demand=[SUM])


def _total(frame):
    return pd.DataFrame({"total": frame["clicks__value"] + frame["views__value"]})


def _halves(lists):
    return {"half": [None if t is None else t / 2 for t in lists["total"]], "rows": [1] * len(lists["total"])}


def _verdict(row):
    return {"verdict": "none" if row["half"] is None else "high" if row["half"] > row["bar"] else "low"}


#: A chain of one function of each kind, and an expression over the last.
CHAIN = [
    OnDemandView("sums", {"clicks": ["value"], "views": ["value"]}, {"total": "double"}, mode="pandas", function=_total),
    OnDemandView("halves", {"sums": ["total"]}, {"half": "double", "rows": "int"}, mode="python", function=_halves),
    OnDemandView("judged", {"halves": ["half"]}, {"verdict": "string"}, ["bar"], mode="singleton", function=_verdict),
    OnDemandView("shout", {"judged": ["verdict"]}, {"loud": "upper(judged__verdict)"}),
]
CHAIN_REFS = ["sums:total", "halves:half", "halves:rows", "judged:verdict", "shout:loud"]
CHAIN_SQL = """c + v AS sums__total, (c + v) / 2 AS halves__half, 1 AS halves__rows,
  CASE WHEN c + v IS NULL THEN 'none' WHEN (c + v) / 2 > bar THEN 'high' ELSE 'low' END AS judged__verdict,
  upper(judged__verdict) AS shout__loud"""


@query(
    "odfv_functions_historical",
    f"""
WITH spine AS (SELECT event_id, user_id, ts AS entity_ts, value AS bar FROM events WHERE event_type = 'purchase'),
f AS (SELECT s.*, {newest_sql("click")} AS c, {newest_sql("view")} AS v FROM spine s)
SELECT event_id, user_id, entity_ts, bar, {CHAIN_SQL} FROM f
""",
)
def odfv_functions_historical(spark, root):
    """Pandas, Python and singleton functions that read each other, in a training frame."""
    events = table(spark, root, "events").filter("event_type = 'purchase'")
    spine = events.select("event_id", "user_id", F.col("ts").alias("entity_ts"), F.col("value").alias("bar"))
    return historical_features(spine, kind_views(spark, root), CHAIN_REFS, on_demand=CHAIN, full_names=True)


@query(
    "odfv_functions_online",
    f"""
WITH n AS (SELECT user_id, max_by(value, ts) FILTER (event_type = 'click') AS c, max_by(value, ts) FILTER (event_type = 'view') AS v
           FROM events GROUP BY 1),
f AS (SELECT o_orderkey, o_custkey AS user_id, o_totalprice / 5000 AS bar, c, v FROM orders LEFT JOIN n ON n.user_id = o_custkey)
SELECT o_orderkey, user_id, bar, {CHAIN_SQL} FROM f
""",
)
def odfv_functions_online(spark, root):
    """The same functions behind a lookup."""
    requests = table(spark, root, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("user_id"), (F.col("o_totalprice") / 5000).alias("bar")
    )
    stored = {n: (mat.dedup_latest(df, ["user_id"], "ts"), view) for n, (df, view) in kind_views(spark, root).items()}
    now = stamp("2024-02-08 00:00:00")
    found = online_features(requests, stored, CHAIN_REFS, now, on_demand=CHAIN, full_names=True)
    return found.drop("clicks__status", "views__status")
