"""Readers: files, tables, queries, documents and decoded message streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_FORMATS = ("csv", "json", "parquet", "avro", "orc")
TABLE_FORMATS = ("iceberg", "delta", "hudi")
DOCUMENT_SUFFIXES = ("txt", "md")


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header row; a given schema avoids the inference pass over the files."""
    reader = spark.read.option("header", "true")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", "true")
    return reader.csv(path)


def scan_files(
    spark: SparkSession,
    path: str,
    file_format: str,
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    if file_format not in FILE_FORMATS:
        raise ValueError(f"file format {file_format!r} is not one of {FILE_FORMATS}")
    reader = spark.read.format(file_format).options(**(options or {}))
    return (reader.schema(schema) if schema else reader).load(path)


def scan_table_format(
    spark: SparkSession, path: str, table_format: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Iceberg, Delta or Hudi; needs that format's package on the class path."""
    if table_format not in TABLE_FORMATS:
        raise ValueError(f"table format {table_format!r} is not one of {TABLE_FORMATS}")
    return spark.read.format(table_format).options(**(options or {})).load(path)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    quoted = ".".join(f"`{part.strip('`')}`" for part in name.split("."))
    return spark.table(quoted)


def scan_query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """A query as a source; frames can be named in the text as ``{name}``."""
    return spark.sql(sql, **frames)


def scan_source(
    spark: SparkSession,
    *,
    table: str | None = None,
    query: str | None = None,
    path: str | None = None,
    file_format: str | None = None,
    table_format: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a source given by exactly one of table, query or path."""
    if sum(x is not None for x in (table, query, path)) != 1:
        raise ValueError("give exactly one of table, query and path")
    if table is not None:
        return scan_table(spark, table)
    if query is not None:
        return scan_query(spark, query)
    if table_format:
        return scan_table_format(spark, path, table_format, options)
    if not file_format:
        raise ValueError("a path needs a file format")
    return scan_files(spark, path, file_format, options=options)


def scan_documents(
    spark: SparkSession, path: str, suffixes: Sequence[str] = DOCUMENT_SUFFIXES
) -> DataFrame:
    """Text documents below ``path``: source, content, size in characters, filename."""
    pattern = "*.{" + ",".join(suffixes) + "}"
    files = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .text(path, wholetext=True)
    )
    return files.select(
        F.col("_metadata.file_path").alias("source"),
        F.col("value").alias("content"),
        F.length("value").alias("size"),
        F.col("_metadata.file_name").alias("filename"),
    )


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Topic as a stream from the latest offsets unless the options say otherwise."""
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        **(options or {}),
    }
    return spark.readStream.format("kafka").options(**settings).load()


def decode_json(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Flat columns from JSON messages in the binary ``value`` column."""
    text = F.col("value").cast("string")
    return df.select(F.from_json(text, schema).alias("t")).select("t.*")


def decode_avro(df: DataFrame, json_schema: str) -> DataFrame:
    """Flat columns from Avro messages; the binary value is decoded as it is.

    Needs the ``spark-avro`` package on the class path.
    """
    from pyspark.sql.avro.functions import from_avro

    return df.select(from_avro(F.col("value"), json_schema).alias("t")).select("t.*")


def require_request_columns(spine: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Request-time columns travel in the spine; a missing one is an error."""
    missing = [c for c in columns if c not in spine.columns]
    if missing:
        raise ValueError(f"request columns missing from the spine: {missing}")
    return spine


# Text patterns of the inferred column types, tried in this order.
INTEGER_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"
FLOAT_TEXT = (
    r"(?i)^\s*[+-]?(([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)(e[+-]?[0-9]+)?"
    r"|inf|infinity|nan)\s*$"
)
TIMESTAMP_TEXT = r"^([0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4})"


def introspect_schema(df: DataFrame) -> DataFrame:
    """Name and simple type of each text column, judged over all its non-blank values.

    Columns that are not text keep their own type.  One aggregate reads the
    table once; the result has one row per column.
    """

    def every(text: Column, pattern: str) -> Column:
        filled = F.trim(text) != ""
        return F.bool_and(F.when(filled, text.rlike(pattern)))

    kinds = []
    for field in df.schema:
        text = F.col(f"`{field.name}`").cast("string")
        if isinstance(field.dataType, T.StringType):
            kind = (
                F.when(every(text, INTEGER_TEXT), "INTEGER")
                .when(every(text, FLOAT_TEXT), "FLOAT")
                .when(every(text, TIMESTAMP_TEXT), "TIMESTAMP")
                .otherwise("STRING")
            )
        else:
            kind = F.max(F.lit(_simple_type(field.dataType)))
        kinds.append(F.struct(F.lit(field.name).alias("name"), kind.alias("type")))
    return df.agg(F.array(*kinds).alias("columns")).select(F.inline("columns"))


def _simple_type(data_type: T.DataType) -> str:
    if isinstance(data_type, T.IntegralType):
        return "INTEGER"
    if isinstance(data_type, (T.FractionalType, T.DecimalType)):
        return "FLOAT"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "TIMESTAMP"
    return "STRING"
