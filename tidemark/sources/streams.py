"""Stream sources. Each gives a streaming DataFrame that every streaming operator accepts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from tidemark.functions.text import field
from tidemark.functions.times import parse_server_time


def parquet_stream(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Files that appear under ``path`` (a folder or glob) as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def table_stream(spark: SparkSession, folder: str, name: str, schema: str | StructType) -> DataFrame:
    """Parquet table ``name`` below ``folder`` as a stream, whether it is a file or a folder."""
    # A pattern, though of one name only: a stream refuses the plain path of a file.
    return parquet_stream(spark, f"{folder.rstrip('/')}/{name}.parque[t]", schema)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines of a socket with their arrival time: ``value, timestamp``."""
    return (
        spark.readStream.format("socket")
        .options(host=host, port=port, includeTimestamp=True)
        .load()
    )


def kafka_reader(
    spark: SparkSession,
    servers: str,
    topics: list[str],
    starting_offsets: str = "latest",
    group_id: str | None = None,
    max_offsets_per_batch: int | None = None,
) -> DataStreamReader:
    """Reader of Kafka topics. Progress is kept in the query's checkpoint, never by auto-commit."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
    )
    if group_id is not None:
        reader = reader.option("kafka.group.id", group_id)
    if max_offsets_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_batch)
    return reader


def kafka_values(
    spark: SparkSession, servers: str, topics: list[str], name: str = "value", **options
) -> DataFrame:
    """Kafka messages as text: ``name, timestamp``."""
    records = kafka_reader(spark, servers, topics, **options).load()
    return records.select(F.col("value").cast("string").alias(name), "timestamp")


def log_levels(lines: DataFrame, line: str = "value", arrival: str = "timestamp") -> DataFrame:
    """Level and event time of lines ``LEVEL,date text``: ``level, timestamp``.

    A line whose date cannot be read counts at its arrival.
    """
    written = parse_server_time(field(F.col(line), 1))
    event_time = F.coalesce(written, F.col(arrival))
    return lines.select(field(F.col(line), 0).alias("level"), event_time.alias("timestamp"))
