"""Data quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quality as q
from tidemark.operators.profiles import DISTINCT_ERROR, RANK_ERROR, ProfileStore
from tidemark.plans.catalog import query
from tidemark.plans.columns import GAPPY, gappy
from tidemark.session import fresh_path, table
from tidemark.sources import sinks


@query(
    "quality_counts",
    f"""
WITH {GAPPY} SELECT 'quantity' AS name, count(*) AS rows, count(*) - count(quantity) AS nulls,
       min(quantity) IS NOT DISTINCT FROM max(quantity) AS constant FROM gappy
UNION ALL SELECT 'price', count(*), count(*) - count(price),
       min(price) IS NOT DISTINCT FROM max(price) FROM gappy
UNION ALL SELECT 'one', count(*), 0, true FROM gappy
""",
)
def quality_counts(spark, root):
    rows = gappy(spark, root).withColumn("one", F.lit(1))
    return q.quality_counts(rows, ["quantity", "price", "one"])


def profiled(spark, root, column="o_orderdate"):
    """Orders profiled by year's end: old years first, then each new one, without reading the old ones again."""
    store = ProfileStore(spark, fresh_path(spark, "profiles"))
    orders = table(spark, root, "orders").withColumn("even", F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey")))
    cut = [F.expr(f"TIMESTAMP_NTZ '{year}-01-01 00:00:00'") for year in (1996, 1998, 2000)]
    at = F.col(column)
    for part in (at < cut[0], (at >= cut[0]) & (at < cut[1]), (at >= cut[1]) & (at < cut[2]), at >= cut[2]):
        store.add(orders.filter(part), F.date_trunc("month", at), ["o_totalprice", "even", "o_orderstatus"])
    return store, orders


@query(
    "profile_counts",
    """
WITH o AS (SELECT *, CASE WHEN o_custkey % 2 = 0 THEN o_custkey END AS even FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
SELECT 'o_totalprice' AS name, count(*) AS rows, count(*) - count(o_totalprice) AS nulls, false AS constant, true AS distinct_fits FROM o
UNION ALL SELECT 'even', count(*), count(*) - count(even), false, true FROM o
UNION ALL SELECT 'o_orderstatus', count(*), count(*) - count(o_orderstatus), false, true FROM o
""",
)
def profile_counts(spark, root):
    """Counts of the later years from stored months; distinct counts against exact ones."""
    store, orders = profiled(spark, root)
    later = orders.filter(F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00'"))
    names = ["o_totalprice", "even", "o_orderstatus"]
    exact = later.agg(*[F.count_distinct(c).alias(c) for c in names]).unpivot([], names, "name", "exact")
    fits = F.abs(F.col("distinct") - F.col("exact")) <= DISTINCT_ERROR * F.col("exact")
    return store.counts("1996-01-01").join(exact, "name").select("name", "rows", "nulls", "constant", fits.alias("distinct_fits"))


@query(
    "profile_quantiles",
    "SELECT unnest([0.1, 0.5, 0.9]::DOUBLE[]) AS rank, unnest(['o_totalprice', 'o_totalprice', 'o_totalprice']) AS name, TRUE AS fits",
)
def profile_quantiles(spark, root):
    """Quantiles of all stored months: their exact ranks are within the bound."""
    store, orders = profiled(spark, root)
    ranks = [0.1, 0.5, 0.9]
    found = store.quantiles(ranks)["o_totalprice"]
    price, total = F.col("o_totalprice"), F.count("o_totalprice")
    checks = [
        F.struct(
            F.lit(r).alias("rank"),
            F.lit("o_totalprice").alias("name"),
            ((F.count_if(price < v) / total <= r + RANK_ERROR) & (F.count_if(price <= v) / total >= r - RANK_ERROR)).alias("fits"),
        )
        for r, v in zip(ranks, found, strict=True)
    ]
    return orders.agg(F.array(*checks).alias("c")).select(F.inline("c"))


@query(
    "profile_suite",
    """
WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'),
t AS (SELECT count(*) AS n, count(*) FILTER (o_totalprice < lo OR o_totalprice > hi) AS bad,
             max(o_totalprice) AS top, min(o_totalprice) AS low, any_value(lo) AS lo, any_value(hi) AS hi
      FROM orders, r WHERE o_orderdate >= TIMESTAMP '1996-01-01')
SELECT 'between' AS kind, bad = 0 AS success, n AS rows, bad AS unexpected, NULL::DOUBLE AS observed FROM t
UNION ALL SELECT 'max_between', top <= hi, n, 0, top FROM t
UNION ALL SELECT 'min_between', low >= lo, n, 0, low FROM t
""",
)
def profile_suite(spark, root):
    """New orders checked by bounds of the stored months before them."""
    store, orders = profiled(spark, root)
    later = orders.filter(F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00'"))
    report = q.expectations(later, store.learn_suite(["o_totalprice"], last="1995-12-31"))
    return report.select("kind", "success", "rows", "unexpected", "observed")


@query(
    "training_checks",
    f"""
WITH {GAPPY} SELECT l_orderkey, l_linenumber::DOUBLE AS l_linenumber,
  coalesce(quantity, 0)::INTEGER AS quantity, coalesce(price, 0) AS price FROM gappy
""",
)
def training_checks(spark, root):
    kinds = {"l_linenumber": "double", "quantity": "int", "price": "double"}
    fixed, _ = q.training_checks(gappy(spark, root), ["quantity", "price"], kinds)
    return fixed


@query("validate_schema", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def validate_schema(spark, root):
    expected = {"o_orderkey": T.IntegerType(), "o_custkey": T.LongType(), "o_totalprice": T.FloatType()}
    orders = table(spark, root, "orders").select(*expected)
    return q.validate_schema(orders, expected)


@query(
    "schema_states",
    """
SELECT 'o_orderkey' AS name, 'ok' AS state UNION ALL SELECT 'o_custkey', 'mismatch' UNION ALL SELECT 'o_totalprice', 'ok'
UNION ALL SELECT 'o_colour', 'missing' UNION ALL SELECT 'o_orderdate', 'mismatch'
""",
)
def schema_states(spark, root):
    """What the check says of each expected column of the stored table."""
    expected = {
        "o_orderkey": T.IntegerType(), "o_custkey": T.StringType(), "o_totalprice": T.FloatType(),
        "o_colour": T.StringType(), "o_orderdate": T.LongType(),
    }
    report = q.schema_report(table(spark, root, "orders"), expected)
    return spark.createDataFrame(list(report.items()), "name string, state string")


@query(
    "validate_json",
    """
WITH b AS (SELECT props, CASE WHEN event_type = 'error' THEN substr(props, 1, 4)
                              WHEN event_type = 'view' THEN NULL ELSE props END AS cut FROM events)
SELECT 'props' AS name, count(*) AS rows, count(props) AS present,
       count(*) FILTER (NOT json_valid(props)) AS malformed FROM b
UNION ALL SELECT 'cut', count(*), count(cut), count(*) FILTER (NOT json_valid(cut)) FROM b
""",
)
def validate_json(spark, root):
    cut = F.when(F.col("event_type") == "error", F.substring("props", 1, 4)).when(
        F.col("event_type") != "view", F.col("props")
    )
    return q.json_report(table(spark, root, "events").withColumn("cut", cut), ["props", "cut"])


@query(
    "expectations",
    """
WITH s AS (SELECT l_returnflag AS flag,
  CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS quantity,
  CASE WHEN l_linestatus <> 'F' THEN l_extendedprice END AS price FROM lineitem),
t AS (SELECT count(*) AS n, count(*) FILTER (flag NOT IN ('A', 'N')) AS bad,
   count(*) - count(quantity) AS no_q, count(quantity) AS has_q,
   count(*) FILTER (quantity < 5 OR quantity > 45) AS out_q, max(price) AS top,
   count(*) - count(price) AS no_p FROM s)
SELECT 'in_set' AS kind, 'flag' AS column_name, (n - bad) / n >= 0.5 AS success, n AS rows, 0 AS missing,
  0.0::DOUBLE AS missing_percent, bad AS unexpected, 100.0 * bad / n AS unexpected_percent,
  NULL::DOUBLE AS observed FROM t
UNION ALL SELECT 'between', 'quantity', (has_q - out_q) / has_q >= 0.95, n, no_q, 100.0 * no_q / n,
  out_q, 100.0 * out_q / n, NULL FROM t
UNION ALL SELECT 'max_between', 'price', top BETWEEN 0 AND 1000000, n, no_p, 100.0 * no_p / n,
  0, 0.0, top FROM t
UNION ALL SELECT 'not_null', 'quantity', no_q = 0, n, no_q, 100.0 * no_q / n, no_q, 100.0 * no_q / n, NULL FROM t
UNION ALL SELECT 'exists', 'colour', false, n, 0, 0.0, 0, 0.0, NULL FROM t
""",
)
def expectations(spark, root):
    flags = table(spark, root, "lineitem")
    rows = flags.select(
        F.col("l_returnflag").alias("flag"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_linestatus") != "F", F.col("l_extendedprice")).alias("price"),
    )
    suite = [
        q.Expectation("in_set", "flag", values=["A", "N"], mostly=0.5),
        q.Expectation("between", "quantity", low=5, high=45, mostly=0.95),
        q.Expectation("max_between", "price", low=0, high=1_000_000),
        q.Expectation("not_null", "quantity"),
        q.Expectation("exists", "colour"),
    ]
    return q.expectations(rows, suite)


@query(
    "profile_reference",
    """
WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders
           WHERE o_orderdate < TIMESTAMP '1996-01-01'),
t AS (SELECT count(*) AS n, count(*) FILTER (o_totalprice < lo OR o_totalprice > hi) AS bad,
             max(o_totalprice) AS top, min(o_totalprice) AS low, any_value(lo) AS lo, any_value(hi) AS hi
      FROM orders, r WHERE o_orderdate >= TIMESTAMP '1996-01-01')
SELECT 'between' AS kind, bad = 0 AS success, n AS rows, bad AS unexpected, NULL::DOUBLE AS observed FROM t
UNION ALL SELECT 'max_between', top <= hi, n, 0, top FROM t
UNION ALL SELECT 'min_between', low >= lo, n, 0, low FROM t
""",
)
def profile_reference(spark, root):
    orders = table(spark, root, "orders")
    cut = F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00'")
    old, new = orders.filter(F.col("o_orderdate") < cut), orders.filter(F.col("o_orderdate") >= cut)
    report = q.profile_reference(old, new, ["o_totalprice"])
    return report.select("kind", "success", "rows", "unexpected", "observed")


@query(
    "feature_metadata",
    """
SELECT c_custkey, top, d AS top__timestamp, CASE WHEN top IS NULL THEN 'NOT_FOUND' ELSE 'PRESENT' END
  AS top__status FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS top,
  max(o_orderdate) AS d FROM orders GROUP BY 1)
  ON o_custkey = c_custkey
""",
)
def feature_metadata(spark, root):
    tops = table(spark, root, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("top"), F.max("o_orderdate").alias("d")
    )
    joined = table(spark, root, "customer").select("c_custkey").join(tops, "c_custkey", "left")
    return q.feature_metadata(joined, ["top"], "d").drop("d")


@query(
    "log_schema",
    """
SELECT user_id, value AS activity__value, CASE WHEN value > 20 THEN 1 ELSE 0 END AS activity__value__status,
       strftime(ts, '%Y-%m-%d') AS log_date, 'req-' || event_id AS __request_id FROM events
""",
)
def log_schema(spark, root):
    path = fresh_path(spark, "feature-log")
    schema = q.log_schema({"user_id": T.LongType()}, {"activity": {"value": T.DoubleType()}})
    events = table(spark, root, "events")
    at = F.col("ts").cast("timestamp")
    logs = events.select(
        "user_id",
        F.col("value").alias("activity__value"),
        at.alias("activity__value__timestamp"),
        F.when(F.col("value") > 20, 1).otherwise(0).alias("activity__value__status"),
        at.alias("__log_timestamp"),
        F.to_date(at).alias("__log_date"),
        F.concat(F.lit("req-"), "event_id").alias("__request_id"),
    )
    sinks.sink_feature_logs(logs.to(schema), path, ["__log_date"])
    back = spark.read.schema(schema).parquet(path)
    return back.select(
        "user_id",
        "activity__value",
        "activity__value__status",
        F.date_format("__log_date", "yyyy-MM-dd").alias("log_date"),
        "__request_id",
    )
