"""User transformations, on-demand views and scalar functions."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import names
from tidemark.functions.queries import datasets_of_query, tables_of_query
from tidemark.operators import clean, joins
from tidemark.operators import transform as tr
from tidemark.operators.tiles import hop_start
from tidemark.plans.catalog import query
from tidemark.session import spread_table, table

LINES = "SELECT l_orderkey, l_linenumber, l_quantity * l_tax AS taxed FROM lineitem"
OUT = T.StructType().add("l_orderkey", "long").add("l_linenumber", "integer").add("taxed", "double")


def lines(spark, root):
    return spread_table(spark, root, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax"
    )


@query("transform_spark", LINES)
def transform_spark(spark, root):
    def taxed(df):
        product = F.col("l_quantity") * F.col("l_tax")
        return df.select("l_orderkey", "l_linenumber", product.alias("taxed"))

    return tr.transform_spark(lines(spark, root), taxed)


@query(
    "transform_spark_sql",
    """
SELECT c_mktsegment, max(o_totalprice) AS top FROM customer JOIN orders ON o_custkey = c_custkey
GROUP BY c_mktsegment
""",
)
def transform_spark_sql(spark, root):
    def sql(customer, orders):
        return f"""SELECT c_mktsegment, max(o_totalprice) AS top FROM {customer}
                   JOIN {orders} ON o_custkey = c_custkey GROUP BY c_mktsegment"""

    return tr.transform_spark_sql(sql, table(spark, root, "customer"), table(spark, root, "orders"))


@query("transform_pandas", LINES)
def transform_pandas(spark, root):
    def taxed(frame):
        frame["taxed"] = frame["l_quantity"] * frame["l_tax"]
        return frame[["l_orderkey", "l_linenumber", "taxed"]]

    return tr.transform_pandas(lines(spark, root), taxed, OUT)


@query("transform_python", LINES)
def transform_python(spark, root):
    def taxed(columns):
        pairs = zip(columns["l_quantity"], columns["l_tax"])
        return {**columns, "taxed": [q * t for q, t in pairs]}

    return tr.transform_python(lines(spark, root), taxed, OUT)


@query("transform_singleton", LINES)
def transform_singleton(spark, root):
    def taxed(row):
        return {**row, "taxed": row["l_quantity"] * row["l_tax"]}

    return tr.transform_singleton(lines(spark, root), taxed, OUT)


@query(
    "transform_on_write",
    """
SELECT l_orderkey, l_linenumber, l_quantity, l_tax, l_quantity * l_tax AS taxed FROM lineitem
""",
)
def transform_on_write(spark, root):
    def taxed(frame):
        frame["taxed"] = frame["l_quantity"] * frame["l_tax"]
        return frame

    made = tr.transform_on_write(lines(spark, root), taxed, T.StructType().add("taxed", "double"))
    return made.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "taxed")


BALANCE = tr.OnDemandView(
    "balance",
    {"profile": ["c_acctbal"], "orders": ["top"]},
    {"covers": "c_acctbal >= top", "gap": "profile__c_acctbal - orders__top + surplus"},
    request=["surplus"],
)
RISK = tr.OnDemandView("risk", {"balance": ["gap"]}, {"short": "balance__gap < 0"})

RETRIEVED = """
r AS (SELECT c_custkey, c_acctbal, top, c_nationkey AS surplus FROM customer
      LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS top FROM orders GROUP BY 1)
      ON o_custkey = c_custkey)"""


def retrieved(spark, root):
    profile = table(spark, root, "customer").select("c_custkey", "c_acctbal")
    orders = table(spark, root, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    views = [("profile", profile), ("orders", orders.agg(F.max("o_totalprice").alias("top")))]
    request = table(spark, root, "customer").select("c_custkey", F.col("c_nationkey").alias("surplus"))
    return request.join(joins.join_views(views, ["c_custkey"], "left"), "c_custkey", "left")


@query(
    "odfv_read",
    f"""
WITH {RETRIEVED}
SELECT c_custkey, surplus, c_acctbal AS profile__c_acctbal, top AS orders__top,
       c_acctbal >= top AS balance__covers, c_acctbal - top + surplus AS balance__gap FROM r
""",
)
def odfv_read(spark, root):
    return tr.odfv_read(retrieved(spark, root), BALANCE, full_names=True)


@query(
    "odfv_dependencies",
    f"""
WITH {RETRIEVED}
SELECT c_custkey, c_acctbal AS profile__c_acctbal, c_acctbal - top + surplus < 0 AS risk__short FROM r
""",
)
def odfv_dependencies(spark, root):
    wanted = ["risk:short", "profile:c_acctbal"]
    found = tr.odfv_dependencies(retrieved(spark, root), wanted, [BALANCE, RISK], ["c_custkey"])
    return found.select("c_custkey", "profile__c_acctbal", "risk__short")


# -- scalar functions -----------------------------------------------------------------------


@query(
    "str_functions",
    r"""
SELECT page_id, concat_ws('/', lower(split_part(url, '/', 3)), page_id::VARCHAR) AS joined,
       list_last(string_split(url, '/')) AS last_part, starts_with(url, 'https') AS secure,
       regexp_replace(trim(url || '  '), '/+', '/', 'g') AS collapsed FROM pages
""",
)
def str_functions(spark, root):
    url = F.col("url")
    return table(spark, root, "pages").select(
        "page_id",
        F.concat_ws(
            "/", F.lower(F.split_part(url, F.lit("/"), F.lit(3))), F.col("page_id").cast("string")
        ).alias("joined"),
        F.element_at(F.split(url, "/"), -1).alias("last_part"),
        url.startswith("https").alias("secure"),
        F.regexp_replace(F.trim(F.concat(url, F.lit("  "))), "/+", "/").alias("collapsed"),
    )


@query(
    "sanitize_name",
    r"""
WITH n AS (SELECT p_partkey, upper(p_name) || '__' || p_type || ' @' || p_brand || '.v1-' AS raw FROM part),
s AS (SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(lower(raw), '[ _]', '-', 'g'),
        '[^a-z0-9\-.]', '', 'g'), '-+', '-', 'g'), '-') AS name FROM n)
SELECT p_partkey, CASE WHEN name = '' THEN 'unnamed' ELSE name END AS name,
       'kfp/parts/' || name AS job FROM s
""",
)
def sanitize_name(spark, root):
    raw = F.concat(
        F.upper("p_name"), F.lit("__"), "p_type", F.lit(" @"), "p_brand", F.lit(".v1-")
    )
    return table(spark, root, "part").select(
        "p_partkey",
        names.sanitize_name(raw).alias("name"),
        names.job_name(F.lit("KFP"), raw, F.lit("Parts")).alias("job"),
    )


URI = r"regexp_extract(url, '^([A-Za-z]+)://([^/?#]*)([^?#]*)', {})"


@query(
    "normalize_dataset_uri",
    f"""
SELECT page_id, url, {URI.format(1)} AS namespace,
       trim({URI.format(2)} || {URI.format(3)}, '/') AS name FROM pages
UNION ALL
SELECT page_id, {URI.format(3)}, 'file',
       coalesce(nullif(ltrim({URI.format(3)}, '/'), ''), '') FROM pages
""",
)
def normalize_dataset_uri(spark, root):
    pages = table(spark, root, "pages").select("page_id", "url")
    local = pages.withColumn("url", F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^?#]*)", 1))
    both = pages.unionAll(local)
    return both.select("page_id", "url", names.normalize_dataset_uri(F.col("url")).alias("d")).select(
        "page_id", "url", "d.namespace", "d.name"
    )


@query(
    "dataset_identity",
    f"""
SELECT page_id, 'postgres://' || lower({URI.format(2)}) || ':5432' AS namespace,
       ltrim({URI.format(3)}, '/') AS name,
       'public_' || page_id AS from_table FROM pages
""",
)
def dataset_identity(spark, root):
    pages = table(spark, root, "pages")
    parts = r"^[A-Za-z]+://([^/?#]*)([^?#]*)"
    uri = F.concat(
        F.lit("jdbc:postgresql://user:pw@"),
        F.upper(F.regexp_extract("url", parts, 1)),
        F.lit(":5432"),
        F.regexp_extract("url", parts, 2),
    )
    sql = F.concat(F.lit("select a\nfrom public_"), "page_id", F.lit(" where b > 1"))
    return pages.select(
        "page_id",
        names.dataset_identity(uri).alias("d"),
        names.table_of_query(sql).alias("from_table"),
    ).select("page_id", "d.namespace", "d.name", "from_table")


@query(
    "entity_ids",
    """
SELECT l_orderkey, l_linenumber, sha256('l_linenumber=' || length(l_linenumber::VARCHAR) || ':' || l_linenumber
  || '|l_orderkey=' || length(l_orderkey::VARCHAR) || ':' || l_orderkey) AS entity FROM lineitem
""",
)
def entity_ids(spark, root):
    keys = {c: F.col(c) for c in ("l_orderkey", "l_linenumber")}
    return table(spark, root, "lineitem").select(*keys, names.entity_id(keys).alias("entity"))


def order_queries(spark, root):
    """A query for each order: comments, strings, CTEs, quoted and dotted names, joins, lists, nesting, functions."""
    text = '''WITH recent_{k} (a, b) AS (SELECT x, 'from "lost" --' FROM raw.orders_{c} /* from nowhere */),
      "Other {k}" AS NOT MATERIALIZED (SELECT extract(year FROM day) AS y, p FROM days_{s})
    SELECT r.a, (SELECT max(z) FROM limits l WHERE l.k IS DISTINCT FROM r.a) -- FROM comments
    FROM recent_{k} r JOIN "Other {k}" o ON o.y = r.a, "My ""Db"""."Table {s}" AS t
      LEFT JOIN (lake.parts_{p} p CROSS JOIN generate_series(1, 3) g(i)) USING (k), lateral (VALUES (1, 2)) v, days_{s}
    WHERE r.b IN (SELECT c, d FROM customers_{c})
    UNION ALL SELECT a, b FROM RECENT_{k}'''
    orders = spread_table(spark, root, "orders")
    values = {
        mark: F.regexp_replace(F.lower(F.col(column).cast("string")), "[^a-z0-9]+", "_")
        for mark, column in (("{k}", "o_orderkey"), ("{c}", "o_custkey"), ("{s}", "o_orderstatus"), ("{p}", "o_orderpriority"))
    }
    parts = re.split(r"(\{[kcsp]\})", text)  # joined once: replacing a mark goes through the whole text
    return orders.withColumn("sql", F.concat(*(values.get(part, F.lit(part)) for part in parts)))


TABLES_SQL = """
named AS (SELECT *, lower(o_orderstatus) AS s, regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g') AS p FROM orders),
read AS (SELECT o_orderkey, o_orderdate, unnest(['raw.orders_' || o_custkey, 'days_' || s, 'limits', 'My "Db".Table ' || s,
  'lake.parts_' || p, 'customers_' || o_custkey]) AS name, generate_subscripts([1, 2, 3, 4, 5, 6], 1) - 1 AS place FROM named)"""


@query("query_tables", f"WITH {TABLES_SQL} SELECT o_orderkey, place::INTEGER AS place, name FROM read")
def query_tables(spark, root):
    """All tables that each query reads, in order."""
    found = order_queries(spark, root).select("o_orderkey", F.posexplode(tables_of_query(F.col("sql"))).alias("place", "name"))
    return found


@query("query_identities", f"""
WITH {TABLES_SQL}
SELECT o_orderkey, 'postgres://db:5432' AS namespace,
       CASE WHEN contains(name, '.') THEN name ELSE 'shop.' || name END AS name FROM read
""")
def query_identities(spark, root):
    """The datasets of each query as run inputs."""
    inputs = datasets_of_query(F.lit("postgres://db:5432"), F.lit("shop"), F.col("sql"))
    return order_queries(spark, root).select("o_orderkey", F.inline(inputs))


@query(
    "date_functions",
    """
SELECT event_id, (epoch_ms(ts) // 900000) * 900000 AS hop_ms, date_trunc('day', ts) AS day,
       ts - INTERVAL 90 MINUTE AS earlier, strftime(ts, '%Y%m%d') AS part,
       (ts AT TIME ZONE 'Asia/Tokyo') AT TIME ZONE 'UTC' AS utc FROM events
""",
)
def date_functions(spark, root):
    events = table(spark, root, "events")
    utc = F.to_utc_timestamp(F.col("ts").cast("timestamp"), "Asia/Tokyo")
    return events.select(
        "event_id",
        hop_start(F.col("ts"), 900).alias("hop_ms"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"),
        (F.col("ts") - F.expr("INTERVAL 90 MINUTES")).alias("earlier"),
        F.date_format("ts", "yyyyMMdd").alias("part"),
        utc.cast("timestamp_ntz").alias("utc"),
    )


@query(
    "math_functions",
    """
WITH s AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)
SELECT c_custkey, (c_acctbal - lo) / (hi - lo) AS scaled,
       c_acctbal / CASE WHEN c_nationkey = 0 THEN 1 ELSE c_nationkey END AS per_nation,
       round(sqrt(c_acctbal * c_acctbal + c_nationkey * c_nationkey), 6) AS norm,
       round(c_acctbal * c_nationkey, 6) AS dot FROM customer, s
""",
)
def math_functions(spark, root):
    customer = table(spark, root, "customer").withColumn("scaled", F.col("c_acctbal"))
    scaled = clean.minmax_scale(customer, ["scaled"])
    pair = F.array(F.col("c_acctbal"), F.col("c_nationkey").cast("double"))
    squares = F.aggregate(pair, F.lit(0.0), lambda a, x: a + x * x)
    return scaled.select(
        "c_custkey",
        "scaled",
        clean.ratio(F.col("c_acctbal"), F.col("c_nationkey").cast("double")).alias("per_nation"),
        F.round(F.sqrt(squares), 6).alias("norm"),
        F.round(F.col("c_acctbal") * F.col("c_nationkey"), 6).alias("dot"),
    )


@query(
    "array_functions",
    """
WITH w AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents)
SELECT doc_id, len(w) AS words, len(list_distinct(w)) AS distinct_words,
       len(list_concat(w, w[1:2])) AS longer,
       list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS chars FROM w
""",
)
def array_functions(spark, root):
    words = F.split("text", " ")
    lengths = F.transform("w", lambda x: F.length(x).cast("long"))
    return (
        table(spark, root, "documents")
        .select("doc_id", words.alias("w"))
        .select(
            "doc_id",
            F.size("w").cast("long").alias("words"),
            F.size(F.array_distinct("w")).cast("long").alias("distinct_words"),
            F.size(F.concat("w", F.slice("w", 1, 2))).cast("long").alias("longer"),
            F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("chars"),
        )
    )


@query(
    "map_functions",
    """
SELECT p_partkey, p_brand AS brand, p_type AS kind, 2::INTEGER AS entries,
       '{"brand":"' || p_brand || '","type":"' || p_type || '"}' AS as_json FROM part
""",
)
def map_functions(spark, root):
    entries = F.array(
        F.struct(F.lit("brand").alias("key"), F.col("p_brand").alias("value")),
        F.struct(F.lit("type").alias("key"), F.col("p_type").alias("value")),
    )
    held = table(spark, root, "part").withColumn("m", F.map_from_entries(entries))
    back = F.from_json(F.to_json("m"), "brand string, type string")
    return held.select(
        "p_partkey",
        back["brand"].alias("brand"),
        back["type"].alias("kind"),
        F.size("m").alias("entries"),
        F.to_json("m").alias("as_json"),
    )


@query(
    "json_functions",
    """
SELECT event_id, json_valid(broken) AS valid, json_extract_string(props, '$.k')::INTEGER AS k,
       '{"k":' || json_extract_string(props, '$.k') || '}' AS again
FROM (SELECT *, CASE WHEN event_type = 'error' THEN substr(props, 1, 4) ELSE props END AS broken FROM events)
""",
)
def json_functions(spark, root):
    broken = F.when(F.col("event_type") == "error", F.substring("props", 1, 4)).otherwise(
        F.col("props")
    )
    parsed = F.from_json("props", "k int")
    return table(spark, root, "events").select(
        "event_id",
        F.try_parse_json(broken).isNotNull().alias("valid"),
        parsed["k"].alias("k"),
        F.to_json(parsed).alias("again"),
    )


@query(
    "hash_functions",
    """
SELECT o_orderkey, sha256('o_custkey|' || o_custkey) AS digest,
       sha256(o_orderkey || '|' || o_orderstatus) AS pair FROM orders
""",
)
def hash_functions(spark, root):
    return table(spark, root, "orders").select(
        "o_orderkey",
        F.sha2(F.concat_ws("|", F.lit("o_custkey"), F.col("o_custkey")), 256).alias("digest"),
        F.sha2(F.concat_ws("|", "o_orderkey", "o_orderstatus"), 256).alias("pair"),
    )
