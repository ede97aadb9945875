"""Events as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.schema import EVENT_SCHEMA
from tidegauge.settings import Settings

# Producer settings unless others are given.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "10",
    "kafka.compression.type": "snappy",
}


def to_messages(events: DataFrame) -> DataFrame:
    """``key`` (the user) and ``value`` (the event fields as JSON, nulls left out).

    One user's events share a key, hence a topic partition and their order.
    """
    fields = [c for c in EVENT_SCHEMA.names if c in events.columns]
    return events.select(F.col("user_id").alias("key"),
                         F.to_json(F.struct(*fields)).alias("value"))


def kafka_sink_options(settings: Settings, producer: dict[str, str] | None = None) -> dict[str, str]:
    """``producer`` replaces or adds to ``PRODUCER_OPTIONS``."""
    return {"kafka.bootstrap.servers": settings.bootstrap_servers, "topic": settings.topic,
            **PRODUCER_OPTIONS, **(producer or {})}


def publish(events: DataFrame, settings: Settings, producer: dict[str, str] | None = None) -> None:
    """Send a batch of events; needs the Kafka package of Spark on the class path."""
    to_messages(events).write.format("kafka").options(**kafka_sink_options(settings, producer)).save()


def start_publishing(events: DataFrame, settings: Settings, checkpoint: str,
                     producer: dict[str, str] | None = None) -> StreamingQuery:
    """Send a stream of events; delivery is at least once."""
    return (to_messages(events).writeStream.queryName("publish_events")
            .format("kafka").options(**kafka_sink_options(settings, producer))
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=settings.trigger).start())
