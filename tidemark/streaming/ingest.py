"""Structured Streaming ingestion into offline history, online tables and tiles.

Every stream has folders of its own in what it writes to, named by the id that
its checkpoint keeps, and overwrites the folder of a micro-batch that it repeats.
So a batch replayed after a failure or a restart leaves one copy, and streams
that write to one path never replace each other's rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import tiles
from tidemark.operators.aggregate import aggregate_column
from tidemark.operators.materialize import BATCH, COMMITTED, WRITER, batch_folder, new_writer, write_online
from tidemark.operators.windows import dedup_latest, extreme_per_key
from tidemark.session import fresh_path
from tidemark.spec import Aggregation

BatchWriter = Callable[[DataFrame, int], None]

# Fixed value: the property under which a micro-batch finds the id of its stream.
QUERY_ID = "sql.streaming.queryId"


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files as a stream, new files as they appear."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_ingest(
    stream: DataFrame,
    write: BatchWriter,
    *,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    checkpoint: str | None = None,
    every: str | None = None,
    mode: str = "update",
    timeout: int | None = None,
) -> StreamingQuery:
    """Run a stream into ``write``; each stream needs a checkpoint folder of its own.

    With ``every`` the stream runs on that processing-time trigger until
    stopped or ``timeout`` seconds pass; without it, it takes what is there
    and ends.
    """
    ready = transform(stream) if transform else stream
    folder = checkpoint or fresh_path(stream.sparkSession, "stream-checkpoint")
    writer = ready.writeStream.outputMode(mode).option("checkpointLocation", folder)
    if every:
        query = writer.foreachBatch(write).trigger(processingTime=every).start()
        if timeout is not None:
            query.awaitTermination(timeout)
            query.stop()
        return query
    query = writer.foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def writer_names(named: str | None) -> Callable[[DataFrame], str]:
    """The writer of a batch: the given name, else its stream's id, else one name for this function."""
    other = new_writer("stream")

    def of(batch: DataFrame) -> str:
        return named or batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or other

    return of


def microbatch_latest(
    keys: Sequence[str],
    ts: str,
    *,
    online_path: str | None = None,
    offline_path: str | None = None,
    created: str = "created",
    preprocess: Callable[[DataFrame], DataFrame] | None = None,
    writer: str | None = None,
) -> BatchWriter:
    """Writer of each batch's newest row per key, stamped with its creation time.

    ``writer`` names the folders in place of the stream's id.
    """
    name = writer_names(writer)

    def write(batch: DataFrame, number: int) -> None:
        rows = preprocess(batch) if preprocess else batch
        newest = dedup_latest(rows, keys, ts).withColumn(created, F.current_timestamp())
        if offline_path:
            newest.write.mode("overwrite").parquet(batch_folder(offline_path, name(batch), number))
        if online_path:
            write_online(newest, online_path, keys, ts, batch=number, writer=name(batch))

    return write


def stream_windows(
    stream: DataFrame, keys: Sequence[str], ts: str, aggs: Sequence[Aggregation], delay: str
) -> DataFrame:
    """Tumbling or sliding windows with a watermark; rows later than ``delay`` are dropped."""
    size, slide = aggs[0].window, aggs[0].hop
    if any((a.window, a.hop) != (size, slide) for a in aggs):
        raise ValueError("one stream handles one window and slide")
    kind = stream.schema[ts].dataType
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    window = F.window(ts, f"{size} seconds", f"{slide} seconds").alias("w")
    counted = timed.groupBy(*keys, window).agg(*[aggregate_column(a).alias(a.alias) for a in aggs])
    end = F.col("w.end").cast(kind).alias("window_end")
    return counted.select(*keys, end, *[a.alias for a in aggs])


def write_updates(path: str, writer: str | None = None) -> BatchWriter:
    """Writer of changed rows by batch, for streams in update mode."""
    name = writer_names(writer)

    def write(batch: DataFrame, number: int) -> None:
        stamped = batch.withColumn(COMMITTED, F.lit(time.time_ns() // 1000))
        stamped.write.mode("overwrite").parquet(batch_folder(path, name(batch), number))

    return write


def read_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Last written state of each key, whichever stream wrote it."""
    rows = spark.read.parquet(path)
    return extreme_per_key(rows, keys, [COMMITTED, BATCH, WRITER], newest=True).drop(COMMITTED, BATCH, WRITER)


def write_tiles(
    path: str, keys: Sequence[str], ts: str, columns: Sequence[str], hop: int, writer: str | None = None
) -> BatchWriter:
    """Writer of each batch's partials per hop; nothing is kept in stream state."""
    name = writer_names(writer)

    def write(batch: DataFrame, number: int) -> None:
        made = tiles.hop_partials(batch, keys, ts, columns, hop)
        made.write.mode("overwrite").parquet(batch_folder(path, name(batch), number))

    return write


def read_tiles(
    spark: SparkSession, path: str, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Partials of all batches of all streams merged; rows that came late are simply added to their hop."""
    return tiles.merge_tiles(spark.read.parquet(path), keys, columns)


def tile_states(
    stream: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], hop: int, delay: str
) -> DataFrame:
    """Partials per hop kept as state: in update mode a hop comes out whole whenever rows were added to it.

    State of hops older than the watermark is dropped, and rows later than
    ``delay`` with it.  Write the result by ``write_updates``.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    grouped = timed.groupBy(*keys, F.window(ts, f"{hop} seconds").alias("w"))
    made = grouped.agg(*tiles.partial_columns(columns))
    names = [f"{c}__{p}" for c in columns for p in tiles.PARTIALS]
    return made.select(*keys, F.unix_millis("w.start").alias(tiles.HOP), *names)


def read_tile_states(
    spark: SparkSession, path: str, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Last state of each hop of each stream, merged over the streams."""
    rows = spark.read.parquet(path).drop(COMMITTED)
    newest = extreme_per_key(rows, [WRITER, *keys, tiles.HOP], [BATCH], newest=True)
    return tiles.merge_tiles(newest, keys, columns)
