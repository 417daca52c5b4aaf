"""Kafka options, value-format dispatch, framing, producer."""

import pytest
from pyspark.sql import functions as F

from helpers import envelopes, record
from quayside.functions import wire
from quayside.operators.decode import MissingConnectorError, decode_events
from quayside.plans.ingest import accepted_conformed, process_events
from quayside.sources.kafka import kafka_options, offsets_json, read_kafka
from quayside.sources.producer import producer_envelopes


def test_kafka_options_defaults():
    o = kafka_options("b:9092", "events", group_id="g")
    assert o == {"kafka.bootstrap.servers": "b:9092", "subscribe": "events", "startingOffsets": "latest",
                 "failOnDataLoss": "false", "kafka.group.id": "g"}
    assert kafka_options("b", "t", max_offsets_per_trigger=1000)["maxOffsetsPerTrigger"] == "1000"
    assert kafka_options("b", "t", min_partitions=64)["minPartitions"] == "64"
    assert offsets_json("t", {0: 5, 1: 7}) == '{"t": {"0": 5, "1": 7}}'
    with pytest.raises(ValueError):
        kafka_options("", "t")


def test_kafka_needs_its_package(spark):
    with pytest.raises(MissingConnectorError):
        read_kafka(spark, kafka_options("localhost:1", "t", starting_offsets="earliest"), streaming=False)
    with pytest.raises(ValueError):   # a batch read of nothing is refused, not turned into a read of everything
        read_kafka(spark, kafka_options("localhost:1", "t"), streaming=False)


def test_value_format_dispatch(spark):
    env = envelopes(spark, [record()])
    with pytest.raises(ValueError):
        decode_events(env, fmt="xml")
    with pytest.raises(ValueError):
        decode_events(env, fmt="avro")          # no writer schemas
    assert decode_events(env, fmt="JSON").count() == 1


def test_avro_needs_no_module(spark):
    env = envelopes(spark, [record()])
    schema = '{"type":"record","name":"E","fields":[{"name":"event_id","type":"string"}]}'
    r = decode_events(env, fmt="avro", schemas={1: schema}).first()     # a JSON text is no framed value
    assert r["event_id"] is None and r["decode_error"] == "bad_frame"


def test_wire_frame_roundtrip(spark):
    df = spark.createDataFrame([(7, "hello"), (300, "")], "sid int, body string")
    framed = df.select(wire.frame(F.col("sid"), F.col("body").cast("binary")).alias("v"))
    rows = framed.select(wire.frame_magic("v").alias("m"), wire.frame_schema_id("v").alias("s"),
                         wire.frame_body("v").cast("string").alias("b"), wire.frame_ok("v").alias("ok")).collect()
    assert [(r.m, r.s, r.b, r.ok) for r in rows] == [(0, 7, "hello", True), (0, 300, "", True)]
    short = spark.createDataFrame([(bytearray(b"\x00\x01"),)], "v binary")
    assert short.select(wire.frame_ok("v")).first()[0] is False


def test_producer_records_are_accepted(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = accepted_conformed(process_events(producer_envelopes(ev), as_of="2024-02-01T00:00:00"))
    assert out.count() == ev.count()
    r = out.first()
    assert r["source"] == "web-app" and r["event_id"].startswith("event_")


def test_protobuf_message_index(spark):
    df = spark.createDataFrame([(bytearray(b"\x00rest"),), (bytearray(b"\x02\x01rest"),)], "body binary")
    got = [r[0] for r in df.select(wire.protobuf_single_message(F.col("body"))).collect()]
    assert got == [True, False]


def test_publish_needs_its_package(spark):
    from quayside.sources.kafka import publish
    env = envelopes(spark, [record()])
    with pytest.raises(MissingConnectorError):
        publish(env, "localhost:1", "events")
