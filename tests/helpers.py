"""Small builders shared by the tests."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidegauge.operators.events import with_event_flags
from tidegauge.schema import EVENT_SCHEMA

T0 = datetime(2024, 1, 1)


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def event(minutes, event_type="click", user="u1", product="p1", name="Name", category="cat",
          price=10.0, quantity=1, revenue=None, device="mobile", source="organic", event_id="e"):
    stamp = None if minutes is None else at(minutes).isoformat()
    return (event_id, stamp, user, "s", event_type, product, name, category, price, quantity,
            revenue, device, source)


def events(spark, rows):
    return with_event_flags(spark.createDataFrame(rows, EVENT_SCHEMA))


def zoneless(frame):
    """Event time as a zone-less timestamp."""
    return frame.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def tuples(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def same_rows(a, b, without=("processed_at",)):
    """Equal as bags of rows; doubles to nine digits."""
    columns = [c for c in a.columns if c not in without]
    assert sorted(columns) == sorted(c for c in b.columns if c not in without)

    def rows(frame):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                       for r in frame.select(*columns).collect()), key=repr)

    left, right = rows(a), rows(b)
    assert left == right
    return left
