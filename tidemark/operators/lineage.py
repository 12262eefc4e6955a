"""Run events, registry relations, provenance and audit trails as tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.splits import split_count
from tidemark.session import cut_lineage, fresh_path

EDGE = ["src_type", "src", "dst_type", "dst"]

# Object types of the registry.
SERVICE, VIEW, ENTITY, FEATURE, SOURCE = (
    "featureService",
    "featureView",
    "entity",
    "feature",
    "dataSource",
)


# -- run events -----------------------------------------------------------------------------


def schema_facet(df: DataFrame) -> Column:
    """Column names and types of a frame as a literal facet."""
    fields = [
        F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"))
        for f in df.schema
    ]
    return F.struct(F.array(*fields).alias("fields"))


def dataset(namespace: Column, name: Column, facet: Column | None = None) -> Column:
    columns = [namespace.alias("namespace"), name.alias("name")]
    if facet is not None:
        columns.append(F.struct(facet.alias("schema")).alias("facets"))
    return F.struct(*columns)


def lineage_events(
    runs: DataFrame,
    *,
    run_id: Column,
    namespace: Column,
    job: Column,
    started: Column,
    ended: Column,
    failed: Column,
    inputs: Column,
    outputs: Column,
    producer: str,
) -> DataFrame:
    """START and COMPLETE or FAIL events of each run, with the event as JSON text."""
    states = F.explode(
        F.array(
            F.struct(F.lit("START").alias("state"), started.alias("at")),
            F.struct(
                F.when(failed, "FAIL").otherwise("COMPLETE").alias("state"), ended.alias("at")
            ),
        )
    )
    flat = runs.select(
        run_id.alias("run_id"),
        namespace.alias("job_namespace"),
        job.alias("job_name"),
        inputs.alias("inputs"),
        outputs.alias("outputs"),
        states.alias("s"),
    ).select("*", F.col("s.state").alias("event_type"), F.col("s.at").alias("event_time"))
    event = F.struct(
        F.col("event_type").alias("eventType"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventTime"),
        F.struct(F.col("run_id").alias("runId")).alias("run"),
        F.struct(F.col("job_namespace").alias("namespace"), F.col("job_name").alias("name")).alias(
            "job"
        ),
        F.col("inputs"),
        F.col("outputs"),
        F.lit(producer).alias("producer"),
    )
    return flat.select(
        "run_id",
        "event_type",
        "event_time",
        "job_namespace",
        "job_name",
        "inputs",
        "outputs",
        F.to_json(event).alias("event"),
    )


EVENT_SCHEMA = """
eventType string, eventTime string, run struct<runId:string>,
job struct<namespace:string,name:string>, producer string,
inputs array<struct<namespace:string,name:string>>,
outputs array<struct<namespace:string,name:string>>
"""


def parse_events(df: DataFrame, text: str) -> DataFrame:
    """Event columns from JSON text."""
    parsed = df.select(F.from_json(text, EVENT_SCHEMA).alias("e"))
    return parsed.select(
        F.col("e.run.runId").alias("run_id"),
        F.col("e.eventType").alias("event_type"),
        F.col("e.eventTime").alias("event_time"),
        F.col("e.job.namespace").alias("job_namespace"),
        F.col("e.job.name").alias("job_name"),
        "e.producer",
        "e.inputs",
        "e.outputs",
    )


def event_edges(events: DataFrame) -> DataFrame:
    """Edges dataset -> job for inputs and job -> dataset for outputs."""
    job = F.concat_ws(":", F.lit("job"), "job_namespace", "job_name")

    def node(column: str) -> Column:
        return F.concat_ws(":", F.lit("dataset"), f"{column}.namespace", f"{column}.name")

    into = events.select(job.alias("dst"), F.explode("inputs").alias("d")).select(
        node("d").alias("src"), "dst"
    )
    out = events.select(job.alias("src"), F.explode("outputs").alias("d")).select(
        "src", node("d").alias("dst")
    )
    return into.unionByName(out).distinct()


def dataset_match(
    producers: DataFrame, consumers: DataFrame, identity: Sequence[str] = ("namespace", "name")
) -> DataFrame:
    """Each consumed dataset with how many jobs produce it and the first of them.

    Producers are reduced to one row per dataset before the join, so a dataset
    with many producers and consumers does not multiply.
    """
    made = producers.groupBy(*identity).agg(
        F.count(F.lit(1)).alias("producers"), F.min("producer").alias("first_producer")
    )
    return consumers.join(made, list(identity), "left").withColumn(
        "producers", F.coalesce("producers", F.lit(0))
    )


# -- provenance and audit -------------------------------------------------------------------

# Vocabulary of the provenance triples.
RDF_TYPE = "rdf:type"
RDFS_LABEL = "rdfs:label"
PROV = "prov:"


def prov_triples(events: DataFrame, custom: str = "trust:") -> DataFrame:
    """Run events as (s, p, o): the activity, what it used, and what it generated."""
    act = F.concat(F.lit("urn:uuid:"), "run_id")

    def triple(s: Column, p: str, o: Column) -> Column:
        return F.struct(s.alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"))

    def numbered(prefix: str, at: Column) -> Column:
        return F.concat_ws(":", F.lit(prefix), "run_id", at.cast("string"))

    own = F.array(
        triple(act, RDF_TYPE, F.lit(f"{PROV}Activity")),
        triple(act, f"{PROV}startedAtTime", F.col("event_time")),
        triple(act, f"{custom}jobName", F.coalesce("job_name", F.lit("job"))),
        triple(act, f"{custom}namespace", F.coalesce("producer", F.lit("openlineage"))),
    )

    def used(item: Column, at: Column) -> Column:
        entity = numbered("urn:dataset", at)
        return F.array(
            triple(entity, RDF_TYPE, F.lit(f"{PROV}Entity")),
            triple(entity, RDFS_LABEL, item["name"]),
            triple(act, f"{PROV}used", entity),
        )

    def generated(item: Column, at: Column) -> Column:
        entity = numbered("urn:artifact", at)
        node = F.concat_ws("_", F.lit("_:g"), "run_id", at.cast("string"))
        label = F.coalesce(item["name"], F.concat(F.lit("output-"), at.cast("string")))
        return F.array(
            triple(node, RDF_TYPE, F.lit(f"{PROV}Generation")),
            triple(entity, RDF_TYPE, F.lit(f"{PROV}Entity")),
            triple(entity, RDFS_LABEL, label),
            triple(node, f"{PROV}entity", entity),
            triple(node, f"{PROV}activity", act),
        )

    every = F.concat(
        own,
        F.flatten(F.transform(F.coalesce("inputs", F.array()), used)),
        F.flatten(F.transform(F.coalesce("outputs", F.array()), generated)),
    )
    return events.select(F.inline(every)).filter(F.col("o").isNotNull())


def turtle_lines(triples: DataFrame) -> DataFrame:
    """One statement per row; names stay as they are, other objects are quoted."""
    quoted = F.concat(F.lit('"'), F.regexp_replace("o", r'(["\\])', r"\\$1"), F.lit('"'))
    name = F.col("o").rlike(r"^(prov:|_:)")
    resource = F.when(F.col("o").startswith("urn:"), F.format_string("<%s>", "o"))
    subject = F.when(F.col("s").startswith("urn:"), F.format_string("<%s>", "s")).otherwise(
        F.col("s")
    )
    target = resource.when(name, F.col("o")).otherwise(quoted)
    return triples.select(F.format_string("%s %s %s .", subject, "p", target).alias("line"))


GENESIS = "0" * 64


def entry_hash(prev_hash: Column, payload: Column) -> Column:
    return F.sha2(F.concat_ws("|", prev_hash, payload), 256)


def audit_chain_verify(log: DataFrame, log_id: str, seq: str) -> DataFrame:
    """Check a chained log: each entry's own hash, and its link to the entry before.

    Entries are numbered without gaps from 0, so the predecessor is found by an
    equality join on (log, number); a long log is checked by many tasks.
    """
    before = log.select(
        F.col(log_id).alias("__log"),
        (F.col(seq) + 1).alias("__seq"),
        F.col("entry_hash").alias("__before"),
    )
    same = (F.col(log_id) == F.col("__log")) & (F.col(seq) == F.col("__seq"))
    expected = F.when(F.col(seq) == 0, F.lit(GENESIS)).otherwise(F.col("__before"))
    return log.join(before, same, "left").select(
        log_id,
        seq,
        (F.col("entry_hash") == entry_hash(F.col("prev_hash"), F.col("payload"))).alias("hash_ok"),
        F.col("prev_hash").eqNullSafe(expected).alias("link_ok"),
    )


# -- registry -------------------------------------------------------------------------------

#: Marks of rows that lead from a view's inputs to their sources; no edges themselves.
INPUT, NAMED = "input view", "named source"
#: So many edges of one view are joined as one part.
PART_EDGES = 10_000
#: So many rows are told apart, and so many pairs made, by one task.
EDGES_PER_TASK, PAIRS_PER_TASK = 1_000_000, 5_000_000


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows of a table or a plain selection of one, which is counted first.

    Where the session's tasks would hold more than ``EDGES_PER_TASK`` rows, their
    number follows from the rows.
    """
    tasks = split_count(df.count(), EDGES_PER_TASK)
    return (df.repartition(tasks, *df.columns) if tasks > _shuffle_tasks(df) else df).distinct()


def _shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _edges(df: DataFrame, src_type: str, src: Column, dst_type: str, dst: Column) -> DataFrame:
    return df.select(
        F.lit(src_type).alias("src_type"),
        src.alias("src"),
        F.lit(dst_type).alias("dst_type"),
        dst.alias("dst"),
    ).filter(F.col("src").isNotNull())


def source_name(source: Column) -> Column:
    """Name of a source, else its table or path with a prefix."""

    def filled(field: str) -> Column:
        return F.when(source[field] != "", source[field])

    return F.coalesce(
        filled("name"),
        F.concat(F.lit("table:"), filled("table")),
        F.concat(F.lit("path:"), filled("path")),
        F.when(
            source.isNotNull(),
            F.concat(F.lit("unnamed_source_"), F.xxhash64(F.to_json(source)).cast("string")),
        ),
    )


def lineage_edges_direct(views: DataFrame, services: DataFrame) -> DataFrame:
    """Edges written in the registry.

    ``views`` has name, kind (batch, on_demand or stream), entities, features,
    batch_source (name, table, path), stream_source, input_views and
    request_sources; ``services`` has one row per (service, view).
    """
    kind, source = F.col("kind"), F.col("batch_source")
    stored, batch, stream, on_demand = kind != "stream", kind == "batch", kind == "stream", kind == "on_demand"

    def edges(when: Column, src_type: str, sources: Column) -> Column:
        """The view's edges from ``sources``, an array, if it is of the kind."""
        to_view = F.transform(sources, lambda x: F.struct(F.lit(src_type).alias("src_type"), x.cast("string").alias("src")))
        return F.when(when, to_view)

    def present(value: Column) -> Column:
        return F.nullif(value, F.lit(""))

    # one array of edges for each view; those of inputs are led on to the inputs' own sources below
    listed = [
        edges(stored, ENTITY, F.col("entities")),
        edges(stored, FEATURE, F.col("features")),
        edges(batch, SOURCE, F.array(source_name(source))),
        edges(stream, SOURCE, F.array(present(F.col("stream_source")), present(source["name"]))),
        edges(on_demand, SOURCE, F.col("request_sources")),
        edges(on_demand, INPUT, F.col("input_views")),
        edges(batch, NAMED, F.array(present(source["name"]))),
    ]
    empty = F.array().cast("array<struct<src_type:string,src:string>>")
    every = F.flatten(F.array(*[F.coalesce(x, empty) for x in listed]))
    opened = views.select(F.col("name").alias("dst"), F.explode(every).alias("e")).select("e.*", "dst")
    opened = cut_lineage(opened.where(F.col("src").isNotNull()))
    to_view = opened.where(~F.col("src_type").isin(INPUT, NAMED)).select(
        "src_type", "src", F.lit(VIEW).alias("dst_type"), "dst"
    )
    named = opened.where(F.col("src_type") == NAMED).select(F.col("dst").alias("input"), F.col("src").alias("source"))
    inputs = opened.where(F.col("src_type") == INPUT).select(F.col("src").alias("input"), "dst")
    through = _edges(inputs.join(named, "input"), SOURCE, F.col("source"), VIEW, F.col("dst"))
    served = _edges(services, VIEW, F.col("view"), SERVICE, F.col("service"))
    return distinct_rows(cut_lineage(to_view.unionAll(through).unionAll(served)))


def _led_through(into: DataFrame, onward: DataFrame) -> DataFrame:
    """Distinct (src_type, src, dst) of ``into`` (src_type, src, via) and ``onward`` (via, dst).

    The edges of one view are dealt in parts by hash, and each part of its feeds
    meets each part of its services once: no task makes all pairs of a hot view.
    The number of tasks follows from the number of pairs.
    """
    feeds = cut_lineage(distinct_rows(into.select("src_type", "src", "via")))
    outs = cut_lineage(distinct_rows(onward.select("via", "dst")))
    sizes = feeds.select("via", F.lit(1).alias("in"), F.lit(0).alias("out")).unionAll(
        outs.select("via", F.lit(0).alias("in"), F.lit(1).alias("out"))
    )
    sizes = sizes.groupBy("via").agg(F.sum("in").alias("ins"), F.sum("out").alias("outs")).where("ins > 0 and outs > 0")
    sizes = cut_lineage(sizes)
    tasks = split_count(sizes.agg(F.sum(F.col("ins") * F.col("outs"))).first()[0] or 0, PAIRS_PER_TASK, _shuffle_tasks(sizes))
    # only views with more edges on a side than a part holds are in this list: at most edges / part
    hot = cut_lineage(sizes.where((F.col("ins") > PART_EDGES) | (F.col("outs") > PART_EDGES)))
    part = lambda n: F.coalesce(F.ceil(F.col(n) / PART_EDGES), F.lit(1)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), part(n) - 1))
    marked = feeds.join(hot, "via", "left")
    left = marked.withColumn("i", F.pmod(F.xxhash64("src_type", "src"), part("ins")).cast("int")).withColumn("o", every("outs"))
    marked = outs.join(hot, "via", "left")
    right = marked.withColumn("o", F.pmod(F.xxhash64("dst"), part("outs")).cast("int")).withColumn("i", every("ins"))
    unit = ["via", "i", "o"]
    left, right = left.select("src_type", "src", *unit), right.select("dst", *unit)
    if tasks > _shuffle_tasks(sizes):
        left, right = left.repartition(tasks, *unit), right.repartition(tasks, *unit)
    met = left.join(right, unit)
    return met.select("src_type", "src", "dst").distinct()


def lineage_edges_indirect(direct: DataFrame) -> DataFrame:
    """What feeds a service through its views, and the sources behind an entity."""
    into_view = direct.filter(F.col("dst_type") == VIEW).select("src_type", "src", F.col("dst").alias("via"))
    served = direct.filter(F.col("dst_type") == SERVICE).select(F.col("src").alias("via"), "dst")
    to_service = _led_through(into_view, served).select("src_type", "src", F.lit(SERVICE).alias("dst_type"), "dst")
    sources = into_view.filter(F.col("src_type") == SOURCE).select("via", F.col("src").alias("dst"))
    to_source = _led_through(into_view.filter(F.col("src_type") == ENTITY), sources)
    return to_service.unionAll(to_source.select("src_type", "src", F.lit(SOURCE).alias("dst_type"), "dst"))


def lineage_graph_depth(edges: DataFrame, start: DataFrame, depth: int = 2) -> DataFrame:
    """Edges (level, src, dst) met within ``depth`` steps of the start nodes.

    True breadth-first levels: every node is expanded once, at the level it is
    first met.  ``start`` has one column ``node``.  Each level's edges are written
    as they are found, and the next frontier is read from them; edges already
    met aren't looked at again, as their sources were all expanded.
    """
    spark = edges.sparkSession
    rest = cut_lineage(edges.select("src", "dst").distinct())
    path, kind = fresh_path(spark, "levels"), rest.schema.simpleString().removeprefix("struct<").removesuffix(">")
    schema = "level int, " + kind.replace(":", " ").replace(",", ", ")
    frontier = cut_lineage(start.select("node").distinct())
    visited = frontier
    for level in range(depth + 1):
        step = rest.join(frontier.withColumnRenamed("node", "src"), "src", "left_semi")
        step.select(F.lit(level).alias("level"), "src", "dst").write.parquet(f"{path}/step-{level}")
        if level == depth:
            break
        met = spark.read.schema(schema).parquet(f"{path}/step-{level}")
        frontier = cut_lineage(met.select(F.col("dst").alias("node")).distinct().join(visited, "node", "left_anti"))
        if frontier.isEmpty():
            break
        visited = visited.unionAll(frontier)
    return spark.read.schema(schema).parquet(*(f"{path}/step-{i}" for i in range(level + 1)))


def dataset_pipelines(
    edges: DataFrame, jobs: DataFrame, node: str, depth: int = 10
) -> DataFrame:
    """Job namespaces reachable from a dataset in either direction, sorted."""
    both = edges.select("src", "dst").unionAll(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    )
    spark = edges.sparkSession
    start = spark.createDataFrame([(node,)], "node string")
    met = lineage_graph_depth(both, start, depth).select(F.col("dst").alias("node")).distinct()
    named = jobs.select(F.col("node"), "namespace").filter(F.col("namespace") != "")
    return named.join(met, "node", "left_semi").select("namespace").distinct().orderBy("namespace")


# Match scores and the fuzzy threshold.
NAME_SCORE, DESCRIPTION_SCORE, TAG_SCORE = 100.0, 80.0, 60.0
FUZZY_THRESHOLD = 0.75


def _overlap(a: Column, b: Column) -> Column:
    """Jaccard overlap of the characters of two texts, 0 when either is empty."""
    left, right = F.array_distinct(F.split(a, "")), F.array_distinct(F.split(b, ""))
    shared = F.size(F.array_intersect(left, right)) / F.size(F.array_union(left, right))
    return F.when((F.length(a) > 0) & (F.length(b) > 0), shared).otherwise(0.0)


def registry_search(objects: DataFrame, query: str) -> DataFrame:
    """Objects matching a text in name, description or tags, with a score.

    Without an exact match the best fuzzy overlap counts, if it reaches the
    threshold.  ``matched_tags`` holds the tags that match either way.
    """
    if not query:
        return objects.withColumns(
            {"match_score": F.lit(None).cast("double"), "matched_tags": F.col("tags")}
        )
    wanted = F.lit(query.lower())
    pairs = F.transform(
        F.map_entries(F.coalesce("tags", F.create_map().cast("map<string,string>"))),
        lambda e: F.struct(
            e["key"].alias("key"),
            e["value"].alias("value"),
            F.lower(F.concat_ws("=", e["key"], e["value"])).alias("text"),
        ),
    )
    judged = objects.withColumn(
        "__tags",
        F.transform(
            pairs,
            lambda t: F.struct(
                t["key"].alias("key"),
                t["value"].alias("value"),
                F.contains(t["text"], wanted).alias("exact"),
                _overlap(wanted, t["text"]).alias("fuzzy"),
            ),
        ),
    )
    matched = F.filter("__tags", lambda t: t["exact"] | (t["fuzzy"] >= FUZZY_THRESHOLD))
    exact_tag = F.exists("__tags", lambda t: t["exact"])
    best = F.array_max(
        F.transform("__tags", lambda t: F.when(~t["exact"], t["fuzzy"]).otherwise(0.0))
    )
    name_fuzzy = _overlap(wanted, F.lower("name"))
    score = (
        F.when(F.contains(F.lower("name"), wanted), NAME_SCORE)
        .when(F.contains(F.lower("description"), wanted), DESCRIPTION_SCORE)
        .when(exact_tag, TAG_SCORE)
        .when(best >= FUZZY_THRESHOLD, best * 100)
        .when(name_fuzzy >= FUZZY_THRESHOLD, name_fuzzy * 100)
    )
    kept = F.map_from_entries(
        F.transform(matched, lambda t: F.struct(t["key"].alias("key"), t["value"].alias("value")))
    )
    # A generator holds the result, so the filter does not make the score be computed twice.
    result = F.inline(F.array(F.struct(score.alias("match_score"), kept.alias("matched_tags"))))
    found = judged.select(*objects.columns, result)
    return found.filter(F.col("match_score").isNotNull())


def page(df: DataFrame, order: Sequence[Column], number: int, size: int) -> DataFrame:
    """One page of a sorted listing; the order must name a unique column last."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def resolve_dataset(references: DataFrame, catalog: DataFrame) -> DataFrame:
    """Canonical (namespace, name) of tool-specific references; unknown ones stay as given."""
    known = catalog.select(
        "namespace",
        "name",
        "tool",
        F.col("canonical_namespace").alias("__namespace"),
        F.col("canonical_name").alias("__name"),
        F.lit(True).alias("__known"),
    )
    joined = references.join(known, ["namespace", "name", "tool"], "left")
    return joined.select(
        *[c for c in references.columns],
        F.coalesce("__namespace", "namespace").alias("canonical_namespace"),
        F.coalesce("__name", "name").alias("canonical_name"),
        F.coalesce("__known", F.lit(False)).alias("resolved"),
    )


def with_tag(catalog: DataFrame, tag: str) -> DataFrame:
    return catalog.filter(F.array_contains("tags", tag))


# -- manifests and labels -------------------------------------------------------------------

# Warehouse type names and the feature types they become.
WAREHOUSE_TYPES = {
    "Int32": ["INT32", "SMALLINT", "TINYINT", "BYTEINT"],
    "Int64": ["INT", "INT64", "INTEGER", "BIGINT", "NUMBER", "NUMERIC", "DECIMAL"],
    "Float32": ["FLOAT", "FLOAT32", "REAL"],
    "Float64": ["FLOAT64", "DOUBLE", "DOUBLE PRECISION"],
    "Bool": ["BOOL", "BOOLEAN"],
    "UnixTimestamp": [
        "TIMESTAMP",
        "TIMESTAMP_NTZ",
        "TIMESTAMP_LTZ",
        "TIMESTAMP_TZ",
        "DATETIME",
        "DATE",
        "TIME",
    ],
    "Bytes": ["BYTES", "BINARY", "VARBINARY", "BLOB"],
}


def _scalar_type(text: Column) -> Column:
    base = F.trim(F.split_part(text, F.lit("("), F.lit(1)))
    number = r"^NUMBER\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)"
    precision = F.regexp_extract(text, number, 1).try_cast("int")
    scale = F.coalesce(F.regexp_extract(text, number, 2).try_cast("int"), F.lit(0))
    sized = (base == "NUMBER") & precision.isNotNull()
    result = (
        F.when(sized & (scale > 0), "Float64")
        .when(sized & (precision <= 9), "Int32")
        .when(sized & (precision <= 18), "Int64")
        .when(sized, "Float64")
    )
    for name, spellings in WAREHOUSE_TYPES.items():
        result = result.when(base.isin(spellings), name)
    return result.otherwise("String")


def warehouse_feature_type(data_type: Column) -> Column:
    """Feature type of a warehouse column type; nested arrays and unknowns are strings."""
    text = F.upper(F.trim(F.coalesce(data_type, F.lit(""))))
    inner = F.trim(F.regexp_extract(text, r"^ARRAY<(.*)>$", 1))
    array = text.rlike(r"^ARRAY<.*>$")
    return F.when(array, F.concat(F.lit("Array("), _scalar_type(inner), F.lit(")"))).otherwise(
        _scalar_type(text)
    )


MANIFEST_SCHEMA = T.StructType().add(
    "nodes",
    T.MapType(
        T.StringType(),
        T.StructType()
        .add("resource_type", "string")
        .add("name", "string")
        .add("database", "string")
        .add("schema", "string")
        .add("alias", "string")
        .add("tags", T.ArrayType(T.StringType()))
        .add(
            "columns",
            T.MapType(
                T.StringType(),
                T.StructType().add("description", "string").add("data_type", "string"),
            ),
        ),
    ),
)


def dbt_columns(
    manifests: DataFrame, text: str, names: Sequence[str] | None = None, tag: str | None = None
) -> DataFrame:
    """Columns of the models in manifest JSON, with the feature type each becomes."""
    parsed = manifests.select(F.from_json(text, MANIFEST_SCHEMA).alias("m"))
    nodes = parsed.select(F.explode("m.nodes").alias("unique_id", "n"))
    kind = F.col("n.resource_type")
    models = nodes.filter(
        F.col("unique_id").startswith("model.") & (kind.isNull() | (kind == "model"))
    )
    if names:
        models = models.filter(F.col("n.name").isin(list(names)))
    if tag:
        models = models.filter(F.array_contains("n.tags", tag))
    columns = models.select(
        "unique_id",
        F.col("n.name").alias("model"),
        F.coalesce("n.schema", F.lit("")).alias("schema"),
        F.explode("n.columns").alias("column_name", "c"),
    )
    declared = F.coalesce(F.nullif("c.data_type", F.lit("")), F.lit("STRING"))
    return columns.select(
        "unique_id",
        "model",
        "schema",
        "column_name",
        declared.alias("data_type"),
        warehouse_feature_type(declared).alias("feature_type"),
    )


def store_labels(stored: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels are appended; a chunk may carry several."""
    return stored.unionByName(labels)


def remove_labels(stored: DataFrame, removed: DataFrame) -> DataFrame:
    """Drop every label of the given (chunk_id, document_id) pairs."""
    return stored.join(removed.select("chunk_id", "document_id"), ["chunk_id", "document_id"], "left_anti")

