"""Event sources. A file stream and a Kafka topic give the same columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import TRIP_EVENT


def _file_stream(spark: SparkSession, max_files: int | None):
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


def read_event_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Typed events from Parquet files, oldest file first."""
    return _file_stream(spark, max_files).schema(TRIP_EVENT).parquet(path)


def read_json_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Undecoded events, one JSON document per line, in a column ``value``."""
    return _file_stream(spark, max_files).format("text").load(path)


def write_in_slices(events: DataFrame, path: str, bounds: tuple[datetime, datetime], slices: int, files: int = 1,
                    only: range | None = None, time: str = "dropoff_datetime", as_text: bool = False) -> None:
    """Append events to a folder that a file stream watches, one equal slice of their time after the other.

    A file stream takes files by age, so a slice is one job of ``files`` tasks. The first slice also takes what lies before
    ``bounds`` and rows without a time, the last one what lies beyond. ``only`` names the slices to write.
    """
    low, high = bounds
    cuts = [low + (high - low) * i / slices for i in range(1, slices)]
    number = sum((F.when(F.col(time) >= F.lit(cut), 1).otherwise(0) for cut in cuts), F.lit(0))
    for n in only if only is not None else range(slices):
        part = events.where(number == n)
        part = part.select("value") if as_text else part
        writer = part.repartition(files).write.mode("append")
        writer.text(path) if as_text else writer.parquet(path)


def kafka_values(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Undecoded events of a topic from its earliest offset. Needs Spark's Kafka package."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", "earliest").options(**options)
            .load().select("key", "value"))


def decode_avro(raw: DataFrame, avro_schema: str) -> DataFrame:
    """Registry-framed Avro values to events. Needs Spark's Avro package.

    The frame is one marker byte and a four-byte schema id before the record. A record that does not
    decode becomes NULL and fails the contract.
    """
    from pyspark.sql.avro.functions import from_avro
    body = F.expr("substring(value, 6, length(value) - 5)")
    return raw.select(from_avro(body, avro_schema, {"mode": "PERMISSIVE"}).alias("e"), "value").select("e.*", "value")
