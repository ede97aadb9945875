import json
from types import SimpleNamespace

import pytest
from hypothesis import given, settings as hypothesis_settings, strategies as st
from pyspark.sql import functions as F

from helpers import event, events, tuples
from tidegauge.operators.events import purchase_revenue, with_catalog
from tidegauge.schema import CATALOG_SCHEMA
from tidegauge.settings import Settings, shared_root
from tidegauge.sources.catalog import read_catalog
from tidegauge.sources.decode import decode_messages, rejected_messages
from tidegauge.sources.messages import kafka_source_options
from tidegauge.streaming.publish import kafka_sink_options, to_messages


def messages(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_bad_messages_give_null_rows_and_are_listed(spark):
    raw = messages(spark, ["not json", "", None, '{"timestamp":"bad"}', '{"event_id":"x"}',
                           '{"timestamp":"2024-01-01T00:01:00","quantity":1}'])
    decoded = decode_messages(raw)
    assert decoded.count() == 6
    assert decoded.filter("event_timestamp is not null").count() == 1
    reasons = dict((r["value"], r["reason"]) for r in rejected_messages(raw).collect())
    assert reasons == {"not json": "malformed", "": "empty", None: "empty",
                       '{"timestamp":"bad"}': "bad_time", '{"event_id":"x"}': "no_time"}


def test_field_of_wrong_type_is_null_alone(spark):
    raw = messages(spark, ['{"timestamp":"2024-01-01T00:01:00","event_id":"a","quantity":"one","price":2}',
                           '{"timestamp":"2024-01-01T00:01:00","event_id":"b","quantity":1.0}'])
    assert tuples(decode_messages(raw), "event_id", "quantity", "price") == [
        ("a", None, 2.0), ("b", None, None)]
    assert rejected_messages(raw).isEmpty()


def test_binary_values_and_both_time_forms(spark):
    raw = messages(spark, ['{"timestamp":"2024-01-01T00:01:00"}', '{"timestamp":"2024-01-01T00:01:00.250000"}'])
    raw = raw.withColumn("value", F.encode("value", "UTF-8"))
    stamps = sorted(r[0].microsecond for r in decode_messages(raw).select("event_timestamp").collect())
    assert stamps == [0, 250000]


def test_flags_and_null_revenue(spark):
    rows = events(spark, [event(0, "click"), event(0, "purchase", revenue=5.0),
                          event(0, "view"), event(0, None)])
    assert tuples(rows, "is_click", "is_purchase", "revenue_filled") == [
        (0, 0, 0.0), (0, 0, 0.0), (0, 1, 5.0), (1, 0, 0.0)]
    assert rows.filter("revenue is null").count() == 3


def test_purchase_revenue(spark):
    rows = spark.createDataFrame([("purchase", 1.005, 1), ("purchase", 9.99, 3), ("click", 1.0, 1)],
                                 "event_type string, price double, quantity int")
    got = [r[0] for r in rows.select(purchase_revenue(F.col("event_type"), F.col("price"),
                                                      F.col("quantity"))).collect()]
    assert got == [1.01, 29.97, None]


def test_catalog(spark, shared):
    catalog = spark.createDataFrame([("p1", "Lamp", "Light", 12.5), ("p2", "Rope", "Yard", 3.0), ("p3", None, None, None)],
                                    CATALOG_SCHEMA)
    catalog.write.parquet(f"{shared}/catalog")
    stored = read_catalog(spark, f"{shared}/catalog")
    bare = spark.createDataFrame([("p2",), ("none",), ("p3",)], "product_id string")
    joined = with_catalog(bare, stored)
    assert tuples(joined, "product_id", "category", "price") == [
        ("none", None, None), ("p2", "Yard", 3.0), ("p3", None, None)]
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().toString()


def test_unknown_size_catalog_is_not_broadcast(spark):
    big = spark.range(0, 50_000_000).select(F.concat(F.lit("p"), "id").alias("product_id"),
                                            F.lit("n").alias("product_name"))
    plan = with_catalog(spark.range(9).select(F.lit("p1").alias("product_id")), big)
    assert "BroadcastHashJoin LeftOuter BuildRight" not in plan._jdf.queryExecution().toString()


def test_messages_have_the_user_as_key_and_no_null_fields(spark):
    sent = to_messages(events(spark, [event(1, "click", user="u7")])).collect()[0]
    value = json.loads(sent["value"])
    assert sent["key"] == value["user_id"] == "u7"
    assert "revenue" not in value and value["quantity"] == 1


def test_connector_options():
    settings = Settings.from_environment({"KAFKA_BOOTSTRAP_SERVERS": "a:1,b:2", "KAFKA_INPUT_TOPIC": "t",
                                          "SPARK_CHECKPOINT_LOCATION": "/shared/x"})
    assert kafka_source_options(settings) == {
        "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "t", "startingOffsets": "latest",
        "failOnDataLoss": "false"}
    assert kafka_source_options(Settings(min_partitions=64))["minPartitions"] == "64"
    sink = kafka_sink_options(settings)
    assert sink["topic"] == "t" and sink["kafka.acks"] == "all"
    assert sink["kafka.compression.type"] == "snappy"
    assert Settings().trigger == "30 seconds" and Settings().watermark == "5 minutes"


def test_shared_root(spark):
    assert shared_root(spark, Settings(root="/x")) == "/x"
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")

    def bare(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default),
                               sparkContext=SimpleNamespace(master=master))

    assert shared_root(bare("local[2]")) == shared_root(bare("local[2]"))
    with pytest.raises(ValueError):
        shared_root(bare("spark://cluster:7077"))


@hypothesis_settings(max_examples=4, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=6))
def test_decoding_never_fails(spark, texts):
    raw = messages(spark, texts)
    assert decode_messages(raw).count() == len(texts)
    assert rejected_messages(raw).count() == len(texts)
