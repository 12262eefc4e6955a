"""Run events, registry relations, provenance, audit and search over derived registries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.operators import lineage as ln
from tidemark.plans.catalog import query
from tidemark.session import cut_lineage, spread_table, table


def shipments(spark, root):
    """One run per event: its job is the event type, it reads the user and writes the day."""
    events = spread_table(spark, root, "events")
    user = F.concat(F.lit("users/"), "user_id")
    day = F.concat(F.lit("days/"), F.date_format("ts", "yyyy-MM-dd"))
    return ln.lineage_events(
        events,
        run_id=F.concat(F.lit("run-"), "event_id"),
        namespace=F.lit("shop"),
        job=F.col("event_type"),
        started=F.col("ts"),
        ended=F.col("ts") + F.expr("INTERVAL 5 MINUTES"),
        failed=F.col("event_type") == "error",
        inputs=F.array(ln.dataset(F.lit("file"), user, ln.schema_facet(events.select("user_id")))),
        outputs=F.array(ln.dataset(F.lit("file"), day)),
        producer="shop/events",
    )


RUNS = """
runs AS (
  SELECT event_id, 'run-' || event_id AS run_id, event_type AS job_name, user_id, s.state AS event_type,
         CASE s.state WHEN 'START' THEN ts ELSE ts + INTERVAL 5 MINUTE END AS event_time,
         strftime(ts, '%Y-%m-%d') AS day
  FROM events, (VALUES ('START'), ('END')) s(state)),
named AS (SELECT * REPLACE (CASE WHEN event_type = 'START' THEN 'START' WHEN job_name = 'error'
            THEN 'FAIL' ELSE 'COMPLETE' END AS event_type) FROM runs)"""


@query(
    "lineage_events",
    f"""
WITH {RUNS}
SELECT run_id, event_type, event_time, job_name,
  '{{"eventType":"' || event_type || '","eventTime":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%SZ')
  || '","run":{{"runId":"' || run_id || '"}},"job":{{"namespace":"shop","name":"' || job_name
  || '"}},"inputs":[{{"namespace":"file","name":"users/' || user_id
  || '","facets":{{"schema":{{"fields":[{{"name":"user_id","type":"bigint"}}]}}}}}}],"outputs":'
  || '[{{"namespace":"file","name":"days/' || day || '"}}],"producer":"shop/events"}}' AS event
FROM named
""",
)
def lineage_events(spark, root):
    return shipments(spark, root).select("run_id", "event_type", "event_time", "job_name", "event")


@query(
    "prov_triples",
    f"""
WITH {RUNS},
e AS (SELECT *, strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') AS started FROM named)
SELECT 'urn:uuid:' || run_id AS s, 'rdf:type' AS p, 'prov:Activity' AS o FROM e
UNION ALL SELECT 'urn:uuid:' || run_id, 'prov:startedAtTime', started FROM e
UNION ALL SELECT 'urn:uuid:' || run_id, 'trust:jobName', job_name FROM e
UNION ALL SELECT 'urn:uuid:' || run_id, 'trust:namespace', 'shop/events' FROM e
UNION ALL SELECT 'urn:dataset:' || run_id || ':0', 'rdf:type', 'prov:Entity' FROM e
UNION ALL SELECT 'urn:dataset:' || run_id || ':0', 'rdfs:label', 'users/' || user_id FROM e
UNION ALL SELECT 'urn:uuid:' || run_id, 'prov:used', 'urn:dataset:' || run_id || ':0' FROM e
UNION ALL SELECT '_:g_' || run_id || '_0', 'rdf:type', 'prov:Generation' FROM e
UNION ALL SELECT 'urn:artifact:' || run_id || ':0', 'rdf:type', 'prov:Entity' FROM e
UNION ALL SELECT 'urn:artifact:' || run_id || ':0', 'rdfs:label', 'days/' || day FROM e
UNION ALL SELECT '_:g_' || run_id || '_0', 'prov:entity', 'urn:artifact:' || run_id || ':0' FROM e
UNION ALL SELECT '_:g_' || run_id || '_0', 'prov:activity', 'urn:uuid:' || run_id FROM e
""",
)
def prov_triples(spark, root):
    return ln.prov_triples(ln.parse_events(shipments(spark, root), "event"))


@query(
    "dataset_match",
    """
WITH u AS (SELECT page_id, regexp_extract(url, '^([a-z]+)://([^/?#]*)([^?#]*)', 1) AS namespace,
             trim(regexp_extract(url, '^([a-z]+)://([^/?#]*)([^?#]*)', 2)
               || regexp_extract(url, '^([a-z]+)://([^/?#]*)([^?#]*)', 3), '/') AS name FROM pages),
m AS (SELECT namespace, name, count(*) AS producers, min('crawl-' || page_id) AS first_producer
      FROM u GROUP BY ALL)
SELECT 'parse-' || page_id AS consumer, namespace, name, producers, first_producer
FROM u JOIN m USING (namespace, name)
""",
)
def dataset_match(spark, root):
    pages = table(spark, root, "pages").select("page_id", "url")
    produced = pages.select(
        F.concat(F.lit("crawl-"), "page_id").alias("producer"),
        names.normalize_dataset_uri(F.col("url")).alias("d"),
    ).select("producer", "d.*")
    read = F.concat(F.regexp_extract("url", r"^([^?#]*)", 1), F.lit("#read"))
    consumed = pages.select(
        F.concat(F.lit("parse-"), "page_id").alias("consumer"),
        names.normalize_dataset_uri(read).alias("d"),
    ).select("consumer", "d.*")
    return ln.dataset_match(produced, consumed)


@query(
    "audit_chain_verify",
    """
WITH base AS (SELECT conv_id, turn, text AS payload, repeat('0', 64) AS genesis FROM conversations),
log AS (SELECT b.conv_id, b.turn, b.payload,
          CASE WHEN b.turn = 0 THEN b.genesis ELSE sha256(b.genesis || '|' || p.payload) END AS prev_hash
        FROM base b LEFT JOIN base p ON p.conv_id = b.conv_id AND p.turn = b.turn - 1),
signed AS (SELECT *, sha256(prev_hash || '|' || payload) AS entry_hash,
             CASE WHEN length(payload) % 10 = 0 THEN payload || '!' ELSE payload END AS shown FROM log)
SELECT s.conv_id, s.turn, s.entry_hash = sha256(s.prev_hash || '|' || s.shown) AS hash_ok,
       s.prev_hash IS NOT DISTINCT FROM
         CASE WHEN s.turn = 0 THEN repeat('0', 64) ELSE p.entry_hash END AS link_ok
FROM signed s LEFT JOIN signed p ON p.conv_id = s.conv_id AND p.turn = s.turn - 1
""",
)
def audit_chain_verify(spark, root):
    """Each entry was signed as if it followed a first entry, and some texts were edited later."""
    turns = table(spark, root, "conversations").select(
        "conv_id", "turn", F.col("text").alias("payload")
    )
    genesis = F.lit(ln.GENESIS)
    before = turns.select(
        "conv_id", (F.col("turn") + 1).alias("turn"), ln.entry_hash(genesis, F.col("payload")).alias("b")
    )
    signed = turns.join(before, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        "payload",
        F.when(F.col("turn") == 0, genesis).otherwise(F.col("b")).alias("prev_hash"),
    )
    signed = signed.withColumn("entry_hash", ln.entry_hash(F.col("prev_hash"), F.col("payload")))
    edited = F.when(
        F.length("payload") % 10 == 0, F.concat("payload", F.lit("!"))
    ).otherwise(F.col("payload"))
    return ln.audit_chain_verify(signed.withColumn("payload", edited), "conv_id", "turn")


def registry(spark, root):
    """Parts as feature views and suppliers as the services that read them."""
    part = table(spark, root, "part")
    kind = (
        F.when(F.col("p_type") == "ECONOMY", "on_demand")
        .when(F.col("p_type") == "PROMO", "stream")
        .otherwise("batch")
    )
    small = F.col("p_size") <= 25
    source = F.struct(
        F.when(small, F.col("p_brand")).otherwise("").alias("name"),
        F.lower("p_type").alias("table"),
        F.lit("").alias("path"),
    )
    views = part.select(
        F.concat(F.lit("view-"), "p_partkey").alias("name"),
        kind.alias("kind"),
        F.array(F.concat(F.lit("size-"), "p_size")).alias("entities"),
        F.split("p_name", " ").alias("features"),
        source.alias("batch_source"),
        F.concat(F.lit("topic-"), F.lower("p_brand")).alias("stream_source"),
        F.array(F.concat(F.lit("view-"), F.col("p_partkey") + 1)).alias("input_views"),
        F.array(F.concat(F.lit("request-"), F.lower("p_brand"))).alias("request_sources"),
    )
    services = table(spark, root, "lineitem").select(
        F.concat(F.lit("service-"), "l_suppkey").alias("service"),
        F.concat(F.lit("view-"), "l_partkey").alias("view"),
    )
    return views, ln.distinct_rows(services)


DIRECT = """
p AS (SELECT 'view-' || p_partkey AS name, p_partkey, p_name, p_brand, p_size, p_type,
  CASE p_type WHEN 'ECONOMY' THEN 'on_demand' WHEN 'PROMO' THEN 'stream' ELSE 'batch' END AS kind,
  CASE WHEN p_size <= 25 THEN p_brand END AS named FROM part),
direct AS (
  SELECT 'featureView' AS src_type, 'view-' || l_partkey AS src, 'featureService' AS dst_type,
         'service-' || l_suppkey AS dst FROM lineitem
  UNION SELECT 'entity', 'size-' || p_size, 'featureView', name FROM p WHERE kind <> 'stream'
  UNION SELECT 'feature', unnest(string_split(p_name, ' ')), 'featureView', name FROM p WHERE kind <> 'stream'
  UNION SELECT 'dataSource', coalesce(named, 'table:' || lower(p_type)), 'featureView', name
        FROM p WHERE kind = 'batch'
  UNION SELECT 'dataSource', 'topic-' || lower(p_brand), 'featureView', name FROM p WHERE kind = 'stream'
  UNION SELECT 'dataSource', named, 'featureView', name FROM p WHERE kind = 'stream' AND named IS NOT NULL
  UNION SELECT 'dataSource', 'request-' || lower(p_brand), 'featureView', name FROM p WHERE kind = 'on_demand'
  UNION SELECT 'dataSource', b.named, 'featureView', o.name FROM p o JOIN p b
        ON b.p_partkey = o.p_partkey + 1 AND b.kind = 'batch' AND b.named IS NOT NULL
        WHERE o.kind = 'on_demand')"""


@query("lineage_edges_direct", f"WITH {DIRECT} SELECT * FROM direct")
def lineage_edges_direct(spark, root):
    return ln.lineage_edges_direct(*registry(spark, root))


@query(
    "lineage_edges_indirect",
    f"""
WITH {DIRECT}
SELECT DISTINCT a.src_type, a.src, 'featureService' AS dst_type, b.dst
FROM direct a JOIN direct b ON b.dst_type = 'featureService' AND b.src = a.dst
WHERE a.dst_type = 'featureView'
UNION
SELECT 'entity', e.src, 'dataSource', s.src FROM direct e JOIN direct s ON s.dst = e.dst
WHERE e.src_type = 'entity' AND e.dst_type = 'featureView' AND s.src_type = 'dataSource'
  AND s.dst_type = 'featureView'
""",
)
def lineage_edges_indirect(spark, root):
    direct = cut_lineage(ln.lineage_edges_direct(*registry(spark, root)))
    return ln.lineage_edges_indirect(direct)


def trade_edges(spark, root):
    """Region to nation to customer to order to part."""

    def edge(df, left, a, right, b):
        return df.select(
            F.concat(F.lit(f"{left}:"), a).alias("src"), F.concat(F.lit(f"{right}:"), b).alias("dst")
        )

    return (
        edge(table(spark, root, "nation"), "region", "n_regionkey", "nation", "n_nationkey")
        .unionAll(edge(table(spark, root, "customer"), "nation", "c_nationkey", "customer", "c_custkey"))
        .unionAll(edge(table(spark, root, "orders"), "customer", "o_custkey", "order", "o_orderkey"))
        .unionAll(edge(table(spark, root, "lineitem"), "order", "l_orderkey", "part", "l_partkey"))
    )


TRADE = """
edges AS (SELECT 'region:' || n_regionkey AS src, 'nation:' || n_nationkey AS dst FROM nation
  UNION SELECT 'nation:' || c_nationkey, 'customer:' || c_custkey FROM customer
  UNION SELECT 'customer:' || o_custkey, 'order:' || o_orderkey FROM orders
  UNION SELECT 'order:' || l_orderkey, 'part:' || l_partkey FROM lineitem)"""


@query(
    "lineage_graph_depth",
    f"""
WITH {TRADE},
l0 AS (SELECT 0::INTEGER AS level, src, dst FROM edges WHERE src = 'region:1'),
l1 AS (SELECT 1::INTEGER AS level, src, dst FROM edges WHERE src IN (SELECT dst FROM l0)),
l2 AS (SELECT 2::INTEGER AS level, src, dst FROM edges WHERE src IN (SELECT dst FROM l1))
SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2
""",
)
def lineage_graph_depth(spark, root):
    start = spark.createDataFrame([("region:1",)], "node string")
    return ln.lineage_graph_depth(trade_edges(spark, root), start)


@query(
    "dataset_pipelines",
    """
WITH RECURSIVE
e AS (SELECT DISTINCT 'job:' || o_custkey AS j, 'dataset:' || (l_partkey // 100) AS d
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
both_ways AS (SELECT j AS src, d AS dst FROM e UNION SELECT d, j FROM e),
r AS (SELECT 'dataset:0' AS node, 0 AS level
      UNION SELECT b.dst, r.level + 1 FROM r JOIN both_ways b ON b.src = r.node WHERE r.level <= 3)
SELECT DISTINCT c_mktsegment AS namespace FROM customer
WHERE 'job:' || c_custkey IN (SELECT node FROM r)
""",
)
def dataset_pipelines(spark, root):
    orders = table(spark, root, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    used = table(spark, root, "lineitem").join(orders, "l_orderkey")
    group = F.floor(F.col("l_partkey") / 100)
    edges = used.select(
        F.concat(F.lit("dataset:"), group).alias("src"), F.concat(F.lit("job:"), "o_custkey").alias("dst")
    )
    jobs = table(spark, root, "customer").select(
        F.concat(F.lit("job:"), "c_custkey").alias("node"), F.col("c_mktsegment").alias("namespace")
    )
    return ln.dataset_pipelines(edges.distinct(), jobs, "dataset:0")


SEARCH = "brand#1"


MATCHES_SQL = f"""
WITH o AS (SELECT p_partkey, p_name AS name, p_type || ' part' AS description, p_brand, p_type,
             lower('brand=' || p_brand) AS t1, lower('type=' || p_type) AS t2 FROM part),
j AS (SELECT *, {{q}} AS q FROM o),
f AS (SELECT *,
  len(list_intersect(string_split(q, ''), string_split(t1, '')))
    / len(list_distinct(string_split(q, '') || string_split(t1, ''))) AS f1,
  len(list_intersect(string_split(q, ''), string_split(t2, '')))
    / len(list_distinct(string_split(q, '') || string_split(t2, ''))) AS f2,
  len(list_intersect(string_split(q, ''), string_split(lower(name), '')))
    / len(list_distinct(string_split(q, '') || string_split(lower(name), ''))) AS fn FROM j),
g AS (SELECT *, greatest(CASE WHEN contains(t1, q) THEN 0 ELSE f1 END,
                         CASE WHEN contains(t2, q) THEN 0 ELSE f2 END) AS best FROM f),
s AS (SELECT *, CASE WHEN contains(lower(name), q) THEN 100.0::DOUBLE
  WHEN contains(lower(description), q) THEN 80.0 WHEN contains(t1, q) OR contains(t2, q) THEN 60.0
  WHEN best >= 0.75 THEN best * 100 WHEN fn >= 0.75 THEN fn * 100 END AS score FROM g)
SELECT p_partkey, name, round(score, 6) AS match_score,
  CASE WHEN contains(t1, q) OR f1 >= 0.75 THEN p_brand END AS matched_brand,
  CASE WHEN contains(t2, q) OR f2 >= 0.75 THEN p_type END AS matched_type
FROM s WHERE score IS NOT NULL """.replace("{q}", f"'{SEARCH}'")


def matches(spark, root):
    part = table(spark, root, "part")
    tags = F.create_map(F.lit("brand"), "p_brand", F.lit("type"), "p_type")
    objects = part.select(
        "p_partkey",
        F.col("p_name").alias("name"),
        F.concat("p_type", F.lit(" part")).alias("description"),
        tags.alias("tags"),
    )
    return ln.registry_search(objects, "Brand#1")


def shown(found):
    return found.select(
        "p_partkey",
        "name",
        F.round("match_score", 6).alias("match_score"),
        F.col("matched_tags")["brand"].alias("matched_brand"),
        F.col("matched_tags")["type"].alias("matched_type"),
    )


@query("registry_matches", MATCHES_SQL)
def registry_matches(spark, root):
    """All matches."""
    return shown(matches(spark, root))


@query("registry_search", MATCHES_SQL + "ORDER BY score DESC, p_partkey LIMIT 50 OFFSET 50")
def registry_search(spark, root):
    """Second page of the matches, best first."""
    return shown(ln.page(matches(spark, root), [F.desc("match_score"), F.asc("p_partkey")], 2, 50))


@query(
    "resolve_dataset",
    """
SELECT o_orderkey, 'raw' AS namespace, 'party/' || o_custkey AS name, 'spark' AS tool,
  CASE WHEN s_suppkey IS NULL THEN 'raw' ELSE 'nation-' || s_nationkey END AS canonical_namespace,
  coalesce(s_name, 'party/' || o_custkey) AS canonical_name, s_suppkey IS NOT NULL AS resolved
FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey
""",
)
def resolve_dataset(spark, root):
    references = table(spark, root, "orders").select(
        "o_orderkey",
        F.lit("raw").alias("namespace"),
        F.concat(F.lit("party/"), "o_custkey").alias("name"),
        F.lit("spark").alias("tool"),
    )
    catalog = table(spark, root, "supplier").select(
        F.lit("raw").alias("namespace"),
        F.concat(F.lit("party/"), "s_suppkey").alias("name"),
        F.lit("spark").alias("tool"),
        F.concat(F.lit("nation-"), "s_nationkey").alias("canonical_namespace"),
        F.col("s_name").alias("canonical_name"),
    )
    return ln.resolve_dataset(references, catalog)


@query(
    "dbt_columns",
    """
WITH n AS (SELECT p_partkey, lower(p_type) AS schema, (p_size % 10)::INTEGER AS k FROM part),
t AS (SELECT *, ['varchar(255)', 'NUMBER(38,2)', 'NUMBER(9,0)', 'number(18)', 'ARRAY<INT64>',
   'double precision', 'timestamp_ntz', 'GEOGRAPHY', '', 'array<varchar(10)>'][k + 1] AS raw,
   ['String', 'Float64', 'Int32', 'Int64', 'Array(Int64)', 'Float64', 'UnixTimestamp', 'String',
    'String', 'Array(String)'][k + 1] AS kind FROM n)
SELECT 'model.shop.part_' || p_partkey AS unique_id, 'part_' || p_partkey AS model, schema,
  'value' AS column_name, CASE WHEN raw = '' THEN 'STRING' ELSE raw END AS data_type, kind AS feature_type
FROM t
UNION ALL
SELECT 'model.shop.part_' || p_partkey, 'part_' || p_partkey, schema, 'id', 'bigint', 'Int64' FROM t
""",
)
def dbt_columns(spark, root):
    kinds = F.array(
        *[
            F.lit(k)
            for k in (
                "varchar(255)",
                "NUMBER(38,2)",
                "NUMBER(9,0)",
                "number(18)",
                "ARRAY<INT64>",
                "double precision",
                "timestamp_ntz",
                "GEOGRAPHY",
                "",
                "array<varchar(10)>",
            )
        ]
    )
    name = F.concat(F.lit("part_"), "p_partkey")
    columns = F.create_map(
        F.lit("id"),
        F.struct(F.lit("key").alias("description"), F.lit("bigint").alias("data_type")),
        F.lit("value"),
        F.struct(F.lit("").alias("description"), F.get(kinds, F.col("p_size") % 10).alias("data_type")),
    )
    node = F.struct(
        F.lit("model").alias("resource_type"),
        name.alias("name"),
        F.lower("p_type").alias("schema"),
        columns.alias("columns"),
    )
    nodes = F.create_map(
        F.concat(F.lit("model.shop."), name), node, F.concat(F.lit("test.shop."), name), node
    )
    manifests = table(spark, root, "part").select(
        F.to_json(F.struct(nodes.alias("nodes"))).alias("manifest")
    )
    return ln.dbt_columns(manifests, "manifest")


@query(
    "document_labels",
    """
WITH stored AS (SELECT l.doc_id || ':0' AS chunk_id, l.doc_id AS document_id,
    CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS label FROM labels l
  UNION ALL SELECT doc_id || ':0', doc_id, 'lang-' || lang FROM documents)
SELECT * FROM stored WHERE document_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
""",
)
def document_labels(spark, root):
    chunk = F.concat(F.col("doc_id").cast("string"), F.lit(":0")).alias("chunk_id")
    document = F.col("doc_id").alias("document_id")
    labels, documents = table(spark, root, "labels"), table(spark, root, "documents")
    good = F.when(F.col("quality") == 1, "good").otherwise("poor")
    stored = labels.select(chunk, document, good.alias("label"))
    added = documents.select(chunk, document, F.concat(F.lit("lang-"), "lang").alias("label"))
    toxic = labels.filter("toxic = 1").select(chunk, document)
    return ln.remove_labels(ln.store_labels(stored, added), toxic)
