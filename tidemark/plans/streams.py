"""Streams over the event table, run until the input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import tiles
from tidemark.operators.materialize import read_online, write_online
from tidemark.plans.aggregates import HOPS, SLIDING_SQL, rounded
from tidemark.plans.catalog import query
from tidemark.plans.retrieval import DAY, stamp
from tidemark.session import fresh_path, table
from tidemark.spec import Aggregation
from tidemark.streaming import ingest

HOUR = 3600
COLUMNS = ["user_id", "event_id", "ts", "value"]


def event_stream(spark, root):
    """Events as a stream of the supplied files."""
    schema = table(spark, root, "events").schema
    return ingest.file_stream(spark, f"{root}/events.parquet*", schema)


def staged(spark, root, parts=3):
    """Events laid out as several files by time, one micro-batch each, in any order."""
    path = fresh_path(spark, "staged-events")
    events = table(spark, root, "events").select(*COLUMNS)
    events.repartitionByRange(parts, "ts").write.parquet(path)
    return ingest.file_stream(spark, path, events.schema, files_per_batch=1)


NEWEST = """
SELECT user_id, max_by(event_id, ts) AS event_id, max(ts) AS ts, max_by({value}, ts) AS value
FROM events GROUP BY user_id
"""


@query("stream_ingest", NEWEST.format(value="value * 2"))
def stream_ingest(spark, root):
    path = fresh_path(spark, "stream-ingest")
    write = ingest.microbatch_latest(["user_id"], "ts", online_path=path)

    def doubled(df):
        return df.select(*COLUMNS).withColumn("value", F.col("value") * 2)

    ingest.stream_ingest(event_stream(spark, root), write, transform=doubled)
    return read_online(spark, path, ["user_id"], "ts").select(*COLUMNS)


@query("online_writers", NEWEST.format(value="value"))
def online_writers(spark, root):
    """A push, a stream and a second push into one table: each has keys that no other has."""
    path, source = fresh_path(spark, "writers-online"), fresh_path(spark, "writers-source")
    events = table(spark, root, "events").select(*COLUMNS)
    parts = [events.filter(F.pmod("user_id", F.lit(3)) == i) for i in range(3)]
    write_online(parts[0], path, ["user_id"], "ts")
    parts[1].write.parquet(source)
    write = ingest.microbatch_latest(["user_id"], "ts", online_path=path)
    ingest.stream_ingest(ingest.file_stream(spark, source, events.schema), write)
    write_online(parts[2].withColumn("created", F.current_timestamp()), path, ["user_id"], "ts")
    stored = read_online(spark, path, ["user_id"], "ts")
    return stored.select(*COLUMNS)


def two_streams(spark, root, split):
    """Events as two streams, apart by ``split``."""
    events = table(spark, root, "events").select(*COLUMNS)
    streams = []
    for i in range(2):
        source = fresh_path(spark, "writers-source")
        events.filter(F.pmod(split, F.lit(2)) == i).write.parquet(source)
        streams.append(ingest.file_stream(spark, source, events.schema))
    return streams


@query("offline_writers", NEWEST.format(value="value"))
def offline_writers(spark, root):
    """Two streams into one history: both number their batches from 0."""
    path = fresh_path(spark, "writers-offline")
    for stream in two_streams(spark, root, F.col("user_id")):
        ingest.stream_ingest(stream, ingest.microbatch_latest(["user_id"], "ts", offline_path=path))
    return spark.read.parquet(path).select(*COLUMNS)


@query(
    "tile_writers",
    f"""
WITH {HOPS} SELECT user_id, hop_ms, n AS value__count, round(s, 2) AS value__sum, lo AS value__min, hi AS value__max FROM hops
""",
)
def tile_writers(spark, root):
    """Two streams into one table of tiles, with rows of the same users and hops."""
    path = fresh_path(spark, "writers-tiles")
    for stream in two_streams(spark, root, F.col("event_id")):
        ingest.stream_ingest(stream, ingest.write_tiles(path, ["user_id"], "ts", ["value"], HOUR))
    found = ingest.read_tiles(spark, path, ["user_id"], ["value"])
    return rounded(found, 2, "value__sum").drop("value__sum_sq")


@query(
    "tile_states",
    f"""
WITH {HOPS} SELECT user_id, hop_ms, n AS value__count, round(s, 2) AS value__sum, lo AS value__min, hi AS value__max FROM hops
""",
)
def tile_states(spark, root):
    """Two streams keep tiles as state; each is stopped and started again from its checkpoint between batches."""
    path = fresh_path(spark, "tile-states")
    events = table(spark, root, "events").select(*COLUMNS)
    cut = stamp("2024-01-15 00:30:00")
    for i in range(2):
        source, checkpoint = fresh_path(spark, "states-source"), fresh_path(spark, "states-checkpoint")
        own = events.filter(F.pmod("event_id", F.lit(2)) == i)
        for rows in (own.filter(F.col("ts") >= cut), own.filter(F.col("ts") < cut)):
            rows.write.mode("append").parquet(source)
            stream = ingest.file_stream(spark, source, events.schema)
            states = ingest.tile_states(stream, ["user_id"], "ts", ["value"], HOUR, "40 days")
            ingest.stream_ingest(states, ingest.write_updates(path), checkpoint=checkpoint)
    found = ingest.read_tile_states(spark, path, ["user_id"], ["value"])
    return rounded(found, 2, "value__sum").drop("value__sum_sq")


@query("microbatch_latest", NEWEST.format(value="value"))
def microbatch_latest(spark, root):
    path = fresh_path(spark, "microbatch")
    write = ingest.microbatch_latest(
        ["user_id"], "ts", online_path=f"{path}/online", offline_path=f"{path}/offline"
    )
    ingest.stream_ingest(staged(spark, root), write)
    return read_online(spark, f"{path}/online", ["user_id"], "ts").select(*COLUMNS)


@query(
    "late_data",
    """
WITH first AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-20'),
kept AS (SELECT user_id, event_id, ts, value FROM first
         UNION ALL SELECT user_id, event_id, ts, value FROM events WHERE ts < TIMESTAMP '2024-01-20')
SELECT user_id, max_by(event_id, ts) AS event_id, max(ts) AS ts, max_by(value, ts) AS value
FROM kept GROUP BY user_id
""",
)
def late_data(spark, root):
    """Newer rows arrive first; the older ones after them must not replace anything."""
    source, path = fresh_path(spark, "late-source"), fresh_path(spark, "late-online")
    checkpoint = fresh_path(spark, "late-checkpoint")
    events = table(spark, root, "events").select(*COLUMNS)
    cut = stamp("2024-01-20 00:00:00")
    for rows in (events.filter(F.col("ts") >= cut), events.filter(F.col("ts") < cut)):
        rows.write.mode("append").parquet(source)
        write = ingest.microbatch_latest(["user_id"], "ts", online_path=path)
        stream = ingest.file_stream(spark, source, events.schema)
        ingest.stream_ingest(stream, write, checkpoint=checkpoint)
    return read_online(spark, path, ["user_id"], "ts").select(*COLUMNS)


@query(
    "stream_tumbling",
    """
SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 6 HOUR AS window_end,
  count(value) AS count_value_21600s, round(sum(value), 2) AS sum_value_21600s FROM events GROUP BY ALL
""",
)
def stream_tumbling(spark, root):
    path = fresh_path(spark, "tumbling")
    aggs = [Aggregation("value", f, 6 * HOUR) for f in ("count", "sum")]
    windows = ingest.stream_windows(staged(spark, root), ["user_id"], "ts", aggs, "40 days")
    ingest.stream_ingest(windows, ingest.write_updates(path))
    found = ingest.read_updates(spark, path, ["user_id", "window_end"])
    return rounded(found, 2, "sum_value_21600s")


@query(
    "update_writers",
    """
SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 6 HOUR AS window_end,
  count(value) AS count_value_21600s FROM events GROUP BY ALL
""",
)
def update_writers(spark, root):
    """Two streams of different users write their windows to one path."""
    path = fresh_path(spark, "writers-updates")
    aggs = [Aggregation("value", "count", 6 * HOUR)]
    for stream in two_streams(spark, root, F.col("user_id")):
        windows = ingest.stream_windows(stream, ["user_id"], "ts", aggs, "40 days")
        ingest.stream_ingest(windows, ingest.write_updates(path))
    return ingest.read_updates(spark, path, ["user_id", "window_end"])


@query("stream_sliding", SLIDING_SQL)
def stream_sliding(spark, root):
    path = fresh_path(spark, "sliding")
    aggs = [Aggregation("value", f, DAY, 6 * HOUR) for f in ("count", "sum", "avg", "min", "std")]
    stream = event_stream(spark, root)
    windows = ingest.stream_windows(stream, ["user_id"], "ts", aggs, "40 days")
    ingest.stream_ingest(windows, ingest.write_updates(path))
    found = ingest.read_updates(spark, path, ["user_id", "window_end"])
    found = rounded(found, 2, "sum_value_86400s")
    return rounded(rounded(found, 6, "avg_value_86400s"), 5, "std_value_86400s")


@query(
    "watermark",
    """
WITH first AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20'),
mark AS (SELECT max(ts) - INTERVAL 2 DAY AS w FROM first),
late AS (SELECT user_id, ts - INTERVAL 5 DAY AS ts FROM events WHERE ts >= TIMESTAMP '2024-01-20'),
kept AS (
  SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 6 HOUR AS e FROM first
  UNION ALL
  SELECT user_id, e FROM (SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01')
    + INTERVAL 6 HOUR AS e FROM late), mark WHERE e > w)
SELECT user_id, e AS window_end, count(*) AS count_event_id_21600s FROM kept GROUP BY ALL
""",
)
def watermark(spark, root):
    """A second arrival dated five days back: windows closed by the mark take no more rows."""
    source, path = fresh_path(spark, "mark-source"), fresh_path(spark, "mark-windows")
    checkpoint = fresh_path(spark, "mark-checkpoint")
    events = table(spark, root, "events").select(*COLUMNS)
    cut = stamp("2024-01-20 00:00:00")
    late = events.filter(F.col("ts") >= cut).withColumn("ts", F.col("ts") - F.expr("INTERVAL 5 DAYS"))
    for rows in (events.filter(F.col("ts") < cut), late):
        rows.write.mode("append").parquet(source)
        stream = ingest.file_stream(spark, source, events.schema)
        aggs = [Aggregation("event_id", "count", 6 * HOUR)]
        windows = ingest.stream_windows(stream, ["user_id"], "ts", aggs, "2 days")
        ingest.stream_ingest(windows, ingest.write_updates(path), checkpoint=checkpoint)
    return ingest.read_updates(spark, path, ["user_id", "window_end"])


@query(
    "stream_tiles",
    f"""
WITH {HOPS}
SELECT user_id, hop_ms + 3600000 AS window_end_ms, (sum(n) OVER w)::BIGINT AS count_value_43200s,
  round(sum(s) OVER w / sum(n) OVER w, 6) AS avg_value_43200s, max(hi) OVER w AS max_value_43200s
FROM hops
WINDOW w AS (PARTITION BY user_id ORDER BY hop_ms RANGE BETWEEN 39600000 PRECEDING AND CURRENT ROW)
""",
)
def stream_tiles(spark, root):
    path = fresh_path(spark, "tiles")
    write = ingest.write_tiles(path, ["user_id"], "ts", ["value"], HOUR)
    ingest.stream_ingest(staged(spark, root), write)
    partials = ingest.read_tiles(spark, path, ["user_id"], ["value"])
    aggs = [Aggregation("value", f, 12 * HOUR) for f in ("count", "avg", "max")]
    return rounded(tiles.range_frame(partials, ["user_id"], HOUR, aggs), 6, "avg_value_43200s")
