"""Messages to events: JSON decoding with a fixed schema, and what does not decode."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegauge.operators.events import with_event_flags
from tidegauge.schema import EVENT_SCHEMA


def decode_messages(messages: DataFrame) -> DataFrame:
    """Every message as an event row with its derived columns.

    A value that is no JSON object gives a row of nulls, a field of another type a
    null in that field. Such rows have no event time and fall out of every window.
    """
    events = messages.select(F.from_json(F.col("value").cast("string"), EVENT_SCHEMA).alias("event"))
    return with_event_flags(events.select("event.*"))


def rejected_messages(messages: DataFrame) -> DataFrame:
    """Messages without a usable event time, with the reason; other columns are kept."""
    text = F.col("value").cast("string")
    event = F.from_json(text, EVENT_SCHEMA)
    empty = F.coalesce(F.trim(text), F.lit("")) == ""
    blank = F.forall(F.array(*[event[name].isNull() for name in EVENT_SCHEMA.names]),
                     lambda missing: missing)
    reason = (F.when(empty, "empty").when(blank, "malformed")
               .when(event["timestamp"].isNull(), "no_time").otherwise("bad_time"))
    return (messages.withColumns({"event_time": F.try_to_timestamp(event["timestamp"]),
                                  "reason": reason})
                    .filter(F.col("event_time").isNull()).drop("event_time"))
