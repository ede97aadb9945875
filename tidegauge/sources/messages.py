"""Streams of event messages with a binary or text ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidegauge.settings import Settings


def kafka_source_options(settings: Settings) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": settings.topic,
        "startingOffsets": settings.starting_offsets,
        "failOnDataLoss": "false",
    }
    if settings.min_partitions is not None:
        options["minPartitions"] = str(settings.min_partitions)
    return options


def kafka_stream(spark: SparkSession, settings: Settings) -> DataFrame:
    """Message stream of one topic; needs the Kafka package of Spark on the class path."""
    return spark.readStream.format("kafka").options(**kafka_source_options(settings)).load()


def text_stream(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """The same contract from a folder of text files, one JSON event per line."""
    return spark.readStream.options(**options).text(folder)


def parquet_stream(spark: SparkSession, path: str, schema: StructType, **options: str) -> DataFrame:
    """Stream of a Parquet file or folder.

    A stream refuses the plain path of a single file but takes a pattern, and the
    pattern below matches that one name.
    """
    path = path.rstrip("/")
    return (spark.readStream.schema(schema).options(**options)
                 .parquet(f"{path[:-1]}[{path[-1]}]"))
