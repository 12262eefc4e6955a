"""Grouped, windowed, tiled and metric aggregates, and newest-row operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import aggregate, tiles, windows
from tidemark.plans.catalog import query
from tidemark.plans.columns import FIRST_SQL
from tidemark.plans.retrieval import DAY, stamp
from tidemark.session import table
from tidemark.spec import Aggregation, ViewSpec

HOUR = 3600


def rounded(df, digits=6, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "group_agg",
    """
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_l_quantity, count(l_orderkey)
  AS count_l_orderkey, max(l_extendedprice) AS max_l_extendedprice,
  round(sum(l_extendedprice), 2) AS sum_l_extendedprice
FROM lineitem GROUP BY l_returnflag, l_linestatus
""",
)
def group_agg(spark, root):
    aggs = [
        Aggregation("l_quantity", "sum"),
        Aggregation("l_orderkey", "count"),
        Aggregation("l_extendedprice", "max"),
        Aggregation("l_extendedprice", "sum"),
    ]
    keys = ["l_returnflag", "l_linestatus"]
    grouped = aggregate.group_agg(table(spark, root, "lineitem"), keys, aggs)
    return rounded(grouped, 2, "sum_l_extendedprice")


FUNCTIONS = ("sum", "count", "mean", "min", "max", "std", "var")


@query(
    "agg_functions",
    """
SELECT user_id, round(sum(value), 2) AS sum_value, count(value) AS count_value,
  round(avg(value), 6) AS mean_value, min(value) AS min_value, max(value) AS max_value,
  round(stddev_samp(value), 6) AS std_value, round(var_samp(value), 6) AS var_value
FROM events GROUP BY user_id
""",
)
def agg_functions(spark, root):
    aggs = [Aggregation("value", f) for f in FUNCTIONS]
    grouped = aggregate.group_agg(table(spark, root, "events"), ["user_id"], aggs)
    return rounded(rounded(grouped, 2, "sum_value"), 6, "mean_value", "std_value", "var_value")


@query(
    "global_agg",
    """
SELECT round(sum(o_totalprice), 2) AS sum_o_totalprice, count(o_orderkey) AS count_o_orderkey,
       max(o_totalprice) AS max_o_totalprice FROM orders
""",
)
def global_agg(spark, root):
    aggs = [
        Aggregation("o_totalprice", "sum"),
        Aggregation("o_orderkey", "count"),
        Aggregation("o_totalprice", "max"),
    ]
    return rounded(aggregate.group_agg(table(spark, root, "orders"), [], aggs), 2, "sum_o_totalprice")


@query(
    "tumbling_agg",
    """
WITH h AS (SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01')
             + INTERVAL 6 HOUR AS window_end, round(sum(value), 2) AS sum_value_21600s
           FROM events GROUP BY ALL),
d AS (SELECT user_id, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01')
        + INTERVAL 1 DAY AS window_end, count(value) AS count_value_86400s,
        max(value) AS max_value_86400s FROM events GROUP BY ALL)
SELECT user_id, window_end, sum_value_21600s, count_value_86400s, max_value_86400s
FROM h FULL JOIN d USING (user_id, window_end)
""",
)
def tumbling_agg(spark, root):
    aggs = [
        Aggregation("value", "sum", 6 * HOUR),
        Aggregation("value", "count", DAY),
        Aggregation("value", "max", DAY),
    ]
    windowed = tiles.tumbling_agg(table(spark, root, "events"), ["user_id"], "ts", aggs)
    return rounded(windowed, 2, "sum_value_21600s")


SLIDING_SQL = """
SELECT e.user_id, w.t AS window_end, count(*) AS count_value_86400s,
       round(sum(e.value), 2) AS sum_value_86400s, round(avg(e.value), 6) AS avg_value_86400s,
       min(e.value) AS min_value_86400s, round(stddev_samp(e.value), 5) AS std_value_86400s
FROM events e, range(1, 5) i(i),
LATERAL (SELECT time_bucket(INTERVAL 6 HOUR, e.ts, TIMESTAMP '1970-01-01')
         + i.i * INTERVAL 6 HOUR AS t) w
GROUP BY e.user_id, w.t
"""


@query("sliding_agg", SLIDING_SQL)
def sliding_agg(spark, root):
    aggs = [Aggregation("value", f, DAY, 6 * HOUR) for f in ("count", "sum", "avg", "min", "std")]
    slid = tiles.sliding_agg(table(spark, root, "events"), ["user_id"], "ts", aggs)
    slid = rounded(slid, 2, "sum_value_86400s")
    return rounded(rounded(slid, 6, "avg_value_86400s"), 5, "std_value_86400s")


HOPS = """
hops AS (SELECT user_id, (epoch_ms(ts) // 3600000) * 3600000 AS hop_ms, count(value) AS n,
                sum(value) AS s, sum(value * value) AS q, min(value) AS lo, max(value) AS hi
         FROM events GROUP BY ALL)"""


@query(
    "hop_partials",
    f"""
WITH {HOPS} SELECT user_id, hop_ms, n AS value__count, round(s, 2) AS value__sum,
  round(q, 4) AS value__sum_sq, lo AS value__min, hi AS value__max FROM hops
""",
)
def hop_partials(spark, root):
    made = tiles.hop_partials(table(spark, root, "events"), ["user_id"], "ts", ["value"], HOUR)
    return rounded(rounded(made, 2, "value__sum"), 4, "value__sum_sq")


GRID = """
grid AS (SELECT user_id, unnest(range(lo, hi + 3600000, 3600000)) AS hop_ms
         FROM (SELECT DISTINCT user_id FROM hops), (SELECT min(hop_ms) AS lo, max(hop_ms) AS hi FROM hops)),
dense AS (SELECT g.user_id, g.hop_ms, coalesce(n, 0) AS n, coalesce(s, 0) AS s,
                 coalesce(q, 0) AS q, lo, hi
          FROM grid g LEFT JOIN hops h ON h.user_id = g.user_id AND h.hop_ms = g.hop_ms)"""


@query(
    "cumulative_tiles",
    f"""
WITH {HOPS}, {GRID}
SELECT user_id, hop_ms, hop_ms + 3600000 AS tile_end_ms,
  (sum(n) OVER w)::BIGINT AS value__count, round(sum(s) OVER w, 2) AS value__sum,
  round(sum(q) OVER w, 4) AS value__sum_sq
FROM dense WINDOW w AS (PARTITION BY user_id ORDER BY hop_ms)
""",
)
def cumulative_tiles(spark, root):
    made = tiles.cumulative_tiles(table(spark, root, "events"), ["user_id"], "ts", ["value"], HOUR)
    return rounded(rounded(made, 2, "value__sum"), 4, "value__sum_sq")


@query(
    "windowed_from_tiles",
    f"""
WITH {HOPS}, {GRID}
SELECT user_id, hop_ms + 3600000 AS window_end_ms, (sum(n) OVER w)::BIGINT AS count_value_86400s,
  CASE WHEN sum(n) OVER w > 0 THEN round(sum(s) OVER w, 2) END AS sum_value_86400s,
  CASE WHEN sum(n) OVER w > 0 THEN round(sum(s) OVER w / sum(n) OVER w, 6) END AS avg_value_86400s,
  max(hi) OVER w AS max_value_86400s
FROM dense
WINDOW w AS (PARTITION BY user_id ORDER BY hop_ms RANGE BETWEEN 82800000 PRECEDING AND CURRENT ROW)
""",
)
def windowed_from_tiles(spark, root):
    aggs = [Aggregation("value", f, DAY) for f in ("count", "sum", "avg", "max")]
    made = tiles.windowed_from_tiles(table(spark, root, "events"), ["user_id"], "ts", aggs, HOUR)
    return rounded(rounded(made, 2, "sum_value_86400s"), 6, "avg_value_86400s")


@query(
    "window_changes",
    f"""
WITH {HOPS},
ends AS (SELECT DISTINCT user_id, hop_ms + 3600000 + d AS e FROM hops, (VALUES (0), (21600000), (86400000)) v(d)),
w AS (SELECT n.user_id, e, s, lo, hi, q, n, CASE WHEN hop_ms >= e - 21600000 THEN s END AS s6,
        CASE WHEN hop_ms >= e - 21600000 THEN lo END AS lo6
      FROM ends n LEFT JOIN hops h ON h.user_id = n.user_id AND hop_ms >= e - 86400000 AND hop_ms < e)
SELECT user_id, e AS window_end_ms, round(sum(s6), 2) AS sum_value_21600s, min(lo6) AS min_value_21600s,
  coalesce(sum(n), 0)::BIGINT AS count_value_86400s, max(hi) AS max_value_86400s,
  round(CASE WHEN sum(n) > 1 THEN sqrt(greatest(sum(q) - sum(s) * sum(s) / sum(n), 0) / (sum(n) - 1)) END, 4) AS std_value_86400s
FROM w GROUP BY user_id, e
""",
)
def window_changes(spark, root):
    events = table(spark, root, "events")
    partials = tiles.hop_partials(events, ["user_id"], "ts", ["value"], HOUR)
    aggs = [Aggregation("value", f, 6 * HOUR) for f in ("sum", "min")]
    aggs += [Aggregation("value", f, DAY) for f in ("count", "max", "std")]
    made = tiles.window_changes(partials, ["user_id"], HOUR, aggs)
    return rounded(rounded(made, 2, "sum_value_21600s"), 4, "std_value_86400s")


@query(
    "cumulative_changes",
    f"""
WITH {HOPS}
SELECT user_id, hop_ms, hop_ms + 3600000 AS tile_end_ms, (sum(n) OVER w)::BIGINT AS value__count,
  round(sum(s) OVER w, 2) AS value__sum, round(sum(q) OVER w, 4) AS value__sum_sq
FROM hops WINDOW w AS (PARTITION BY user_id ORDER BY hop_ms)
""",
)
def cumulative_changes(spark, root):
    made = tiles.cumulative_tiles(table(spark, root, "events"), ["user_id"], "ts", ["value"], HOUR, dense=False)
    return rounded(rounded(made, 2, "value__sum"), 4, "value__sum_sq")


@query(
    "tiled_latest",
    """
WITH edge AS (SELECT max(epoch_ms(ts) // 3600000) * 3600000 + 3600000 AS t FROM events),
recent AS (SELECT user_id, count(*) AS n, sum(value) AS s, min(value) AS lo, stddev_samp(value) AS sd
           FROM events, edge WHERE epoch_ms(ts) >= t - 43200000 GROUP BY user_id)
SELECT user_id, coalesce(n, 0) AS count_value_43200s, round(s, 2) AS sum_value_43200s,
       lo AS min_value_43200s, round(sd, 5) AS std_value_43200s
FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN recent USING (user_id)
""",
)
def tiled_latest(spark, root):
    aggs = [Aggregation("value", f, 12 * HOUR) for f in ("count", "sum", "min", "std")]
    made = tiles.tiled_latest(table(spark, root, "events"), ["user_id"], "ts", aggs, HOUR)
    return rounded(rounded(made, 2, "sum_value_43200s"), 5, "std_value_43200s")


@query(
    "range_frame",
    f"""
WITH {HOPS}
SELECT user_id, hop_ms + 3600000 AS window_end_ms, (sum(n) OVER w)::BIGINT AS count_value_21600s,
  round(sum(s) OVER w, 2) AS sum_value_21600s
FROM hops
WINDOW w AS (PARTITION BY user_id ORDER BY hop_ms RANGE BETWEEN 18000000 PRECEDING AND CURRENT ROW)
""",
)
def range_frame(spark, root):
    events = table(spark, root, "events")
    partials = tiles.hop_partials(events, ["user_id"], "ts", ["value"], HOUR)
    aggs = [Aggregation("value", f, 6 * HOUR) for f in ("count", "sum")]
    return rounded(tiles.range_frame(partials, ["user_id"], HOUR, aggs), 2, "sum_value_21600s")


@query(
    "running_sum_frame",
    """
SELECT event_id, user_id, ts, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS UNBOUNDED PRECEDING), 2) AS running FROM events
""",
)
def running_sum_frame(spark, root):
    events = table(spark, root, "events").select("event_id", "user_id", "ts", "value")
    total = aggregate.running_sum(
        events, ["user_id"], "ts", F.col("value"), "running", tie=["event_id"]
    )
    return rounded(total, 2, "running").drop("value")


@query(
    "odfv_aggregate",
    """
SELECT c_mktsegment, round(sum(c_acctbal), 2) AS sum_c_acctbal, max(n_orders) AS max_n_orders
FROM (SELECT c.*, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_orders
      FROM customer c) GROUP BY 1
""",
)
def odfv_aggregate(spark, root):
    orders = table(spark, root, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    retrieved = table(spark, root, "customer").join(
        orders.agg(F.count("*").alias("n_orders")), "c_custkey", "left"
    )
    retrieved = retrieved.fillna(0, ["n_orders"])
    aggs = [Aggregation("c_acctbal", "sum"), Aggregation("n_orders", "max")]
    return rounded(aggregate.odfv_aggregate(retrieved, ["c_mktsegment"], aggs), 2, "sum_c_acctbal")


@query("min_max_spine", "SELECT min(ts) AS min_ts, max(ts) AS max_ts FROM events")
def min_max_spine(spark, root):
    return aggregate.min_max_spine(table(spark, root, "events"), "ts")


@query(
    "class_weight",
    """
SELECT count(*) FILTER (quality = 0) AS neg, count(*) FILTER (quality = 1) AS pos,
  round(count(*) FILTER (quality = 0) / count(*) FILTER (quality = 1), 2) AS weight FROM labels
""",
)
def class_weight(spark, root):
    return aggregate.class_weight(table(spark, root, "labels"), "quality")


SCORED = """
scored AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
                  round(l_quantity / 50, 2) AS score FROM lineitem)"""


def scored(spark, root):
    return table(spark, root, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.round(F.col("l_quantity") / 50, 2).alias("score"),
    )


@query(
    "eval_metrics",
    f"""
WITH {SCORED},
c AS (SELECT count(*) FILTER (label = 1 AND score >= 0.5) AS tp,
             count(*) FILTER (label = 0 AND score >= 0.5) AS fp,
             count(*) FILTER (label = 1 AND score < 0.5) AS fn FROM scored),
g AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n
      FROM scored GROUP BY score),
r AS (SELECT p, n, sum(n) OVER (ORDER BY score) AS upto FROM g),
a AS (SELECT sum(p * (upto - n / 2.0)) / (sum(p)::DOUBLE * sum(n)) AS auc FROM r)
SELECT round(auc, 9) AS roc_auc, round(2 * tp / (2 * tp + fp + fn), 9) AS f1,
       round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall FROM c, a
""",
)
def eval_metrics(spark, root):
    made = aggregate.eval_metrics(scored(spark, root), "label", "score")
    return rounded(made, 9, *made.columns)


@query(
    "class_report",
    f"""
WITH {SCORED}, j AS (SELECT label, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS said FROM scored),
k AS (SELECT k.label, count(*) FILTER (j.label = k.label AND said = k.label) AS tp,
             count(*) FILTER (j.label <> k.label AND said = k.label) AS fp,
             count(*) FILTER (j.label = k.label AND said <> k.label) AS fn, count(*) AS n
      FROM j, (VALUES (0), (1)) k(label) GROUP BY k.label)
SELECT label, tp + fn AS support, round((tp + fn) / n, 9) AS share,
       round(n / (2 * (tp + fn)), 9) AS weight, round(tp / (tp + fp), 9) AS precision,
       round(tp / (tp + fn), 9) AS recall, round(2 * tp / (2 * tp + fp + fn), 9) AS f1 FROM k
""",
)
def class_report(spark, root):
    judged = scored(spark, root).withColumn("said", (F.col("score") >= 0.5).cast("int"))
    made = aggregate.class_report(judged, "label", "said", [0, 1])
    return rounded(made, 9, "share", "weight", "precision", "recall", "f1")


@query("distinct_keys", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_keys(spark, root):
    return table(spark, root, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query(
    "registry_counts",
    "SELECT p_type AS kind, count(*) AS objects FROM part GROUP BY p_type",
)
def registry_counts(spark, root):
    parts = table(spark, root, "part").withColumnRenamed("p_type", "kind")
    return aggregate.registry_counts(parts, "kind")


@query(
    "tag_popularity",
    """
SELECT tag, value, count(*) AS uses FROM (
  SELECT 'brand' AS tag, p_brand AS value FROM part UNION ALL SELECT 'type', p_type FROM part)
GROUP BY ALL ORDER BY uses DESC, tag, value LIMIT 10
""",
)
def tag_popularity(spark, root):
    tagged = table(spark, root, "part").select(
        F.create_map(F.lit("brand"), "p_brand", F.lit("type"), "p_type").alias("tags")
    )
    return aggregate.tag_popularity(tagged, "tags", 10)


@query(
    "latest_per_key",
    """
SELECT user_id, event_type, value, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events
  WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25') WHERE rn = 1
""",
)
def latest_per_key(spark, root):
    view = ViewSpec("activity", ["user_id"], ["event_type", "value"], "ts")
    start, end = stamp("2024-01-05 00:00:00"), stamp("2024-01-25 00:00:00")
    return windows.latest_per_key(table(spark, root, "events"), view, start, end)


@query(
    "dedup_latest",
    """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
         ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
""",
)
def dedup_latest(spark, root):
    orders = table(spark, root, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    return windows.dedup_latest(orders, ["o_custkey"], "o_orderdate")


@query("first_per_key", FIRST_SQL)
def first_per_key(spark, root):
    events = table(spark, root, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return windows.first_per_key(events, ["user_id", "event_type"], "ts")
