"""The ``events`` table as registry-framed Avro and Protobuf envelopes (S3, S4 offline).

Column expressions only.  Each table row becomes one envelope, of one of two
writer schemas (Avro) or message types (Protobuf), and a fixed share of the rows
is cut short, framed with an unknown schema id or, for Protobuf, with the index
of a message that the reader does not take.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import wire
from quayside.sources.envelope import ENVELOPE_PARTITIONS

# fixed values: the two Avro writer schemas of the test envelopes
AVRO_V1 = json.dumps({"type": "record", "name": "Event", "namespace": "shop", "fields": [
    {"name": "event_id", "type": "string"}, {"name": "event_type", "type": ["null", "string"]}, {"name": "timestamp", "type": "string"},
    {"name": "payload", "type": "string"}, {"name": "source", "type": "string"},
    {"name": "metadata", "type": {"type": "map", "values": "long"}}]})
AVRO_V2 = json.dumps({"type": "record", "name": "Event", "namespace": "shop", "fields": [
    {"name": "region", "type": {"type": "fixed", "name": "Region", "size": 2}}, {"name": "event_id", "type": "string"},
    {"name": "event_type", "type": ["string", "null"]}, {"name": "timestamp", "type": {"type": "long", "logicalType": "timestamp-micros"}},
    {"name": "payload", "type": {"type": "record", "name": "Payload", "fields": [
        {"name": "user", "type": "int"}, {"name": "marks", "type": {"type": "array", "items": "long"}}, {"name": "note", "type": ["null", "string"]}]}},
    {"name": "source", "type": {"type": "enum", "name": "Source", "symbols": ["web", "app", "api"]}},
    {"name": "metadata", "type": ["null", {"type": "map", "values": "long"}]}]})
AVRO_SCHEMAS = {1: AVRO_V1, 2: AVRO_V2}
UNKNOWN_ID = 9


def _pb(number: int, value: int | str | bytes) -> bytes:
    """One field of a small message (numbers below 128, values below 128 bytes or split into two length bytes)."""
    if isinstance(value, int):
        return bytes([number << 3, value])
    raw = value.encode() if isinstance(value, str) else value
    size = [len(raw)] if len(raw) < 128 else [len(raw) & 127 | 128, len(raw) >> 7]
    return bytes([number << 3 | 2, *size]) + raw


def _field(name: str, number: int, kind: int, type_name: str = "", label: int = 1) -> bytes:
    return _pb(2, _pb(1, name) + _pb(3, number) + _pb(4, label) + _pb(5, kind) + (_pb(6, type_name) if type_name else b""))


def _event_descriptor() -> bytes:
    """package shop; message Note {text} · Event {…, message Payload, map<string, int64> metadata, enum Source} · Wrap {message Event {…}}"""
    note = _pb(1, "Note") + _field("text", 1, 9)
    payload = _pb(1, "Payload") + _field("user", 1, 18) + _field("marks", 2, 5, label=3)
    entry = _pb(1, "MetadataEntry") + _field("key", 1, 9) + _field("value", 2, 3) + _pb(7, _pb(7, 1))
    source = _pb(1, "Source") + b"".join(_pb(2, _pb(1, s) + _pb(2, k)) for k, s in enumerate(("web", "app", "api")))
    event = (_pb(1, "Event") + _field("event_id", 1, 9) + _field("event_type", 2, 9) + _field("timestamp", 3, 9)
             + _field("payload", 4, 11, ".shop.Event.Payload") + _field("source", 5, 14, ".shop.Event.Source")
             + _field("metadata", 6, 11, ".shop.Event.MetadataEntry", 3) + _pb(3, payload) + _pb(3, entry) + _pb(4, source))
    inner = _pb(1, "Event") + _field("event_id", 1, 9) + _field("event_type", 2, 9) + _field("payload", 3, 9)
    wrap = _pb(1, "Wrap") + _pb(3, inner)
    return _pb(1, _pb(1, "shop.proto") + _pb(2, "shop") + _pb(4, note) + _pb(4, event) + _pb(4, wrap))


PROTOBUF_DESCRIPTOR = _event_descriptor()
PROTOBUF_SCHEMAS = {1: [{"message": m, "descriptor": PROTOBUF_DESCRIPTOR} for m in ("shop.Event", "shop.Wrap.Event")]}


def _bin(text: str) -> Column:
    return F.unhex(F.lit(text))


def _framed(events: DataFrame, body: Column, schema_id: Column) -> DataFrame:
    whole = events.withColumn("_body", body)
    body = F.col("_body")
    cut = F.when(F.col("event_id") % 50 == 0, F.substring(body, F.lit(1), F.octet_length(body) - 1)).otherwise(body)
    sid = F.when(F.col("event_id") % 50 == 1, F.lit(UNKNOWN_ID)).otherwise(schema_id)
    return whole.select(
        F.col("event_id").cast("string").cast("binary").alias("key"), wire.frame(sid, cut).alias("value"), F.lit("events").alias("topic"),
        (F.col("user_id") % ENVELOPE_PARTITIONS).cast("int").alias("partition"), F.col("event_id").cast("long").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"))


def _with_texts(events: DataFrame) -> DataFrame:
    return events.withColumns({
        "_id": F.col("event_id").cast("string"), "_iso": F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "_source": F.concat(F.lit("src-"), F.col("user_id") % 3), "_kind": F.col("user_id") % 3, "_micros": F.unix_micros(F.col("ts").cast("timestamp"))})


def avro_envelopes(events: DataFrame) -> DataFrame:
    string, number = wire.avro_sized, wire.zigzag
    parts = _with_texts(events).withColumns({
        "_a_id": string(F.col("_id")), "_a_type": string(F.col("event_type")), "_a_iso": string(F.col("_iso")), "_a_props": string(F.col("props")),
        "_a_source": string(F.col("_source")), "_a_kind": number(F.col("_kind")), "_a_user": number(F.col("user_id")),
        "_a_micros": number(F.col("_micros")), "_a_minus": number(-F.col("event_id")),
        "_a_key": string(F.lit("user_id")), "_a_99": number(F.lit(99))})
    c = F.col
    metadata = F.concat(_bin("02"), c("_a_key"), c("_a_user"), _bin("00"))
    v1 = F.concat(c("_a_id"), _bin("02"), c("_a_type"), c("_a_iso"), c("_a_props"), c("_a_source"), metadata)
    marks = F.concat(_bin("03"), c("_a_99"), c("_a_minus"), c("_a_user"), _bin("00"))       # a block of -2 items, then its size
    note = F.when(c("event_id") % 3 == 0, _bin("00")).otherwise(F.concat(_bin("02"), c("_a_type")))
    v2 = F.concat(F.lit("eu").cast("binary"), c("_a_id"), _bin("00"), c("_a_type"), c("_a_micros"), c("_a_user"), marks, note, c("_a_kind"),
                  F.when(c("event_id") % 7 == 0, _bin("00")).otherwise(F.concat(_bin("02"), metadata)))
    first = c("event_id") % 4 < 2
    return _framed(parts, F.when(first, v1).otherwise(v2), F.when(first, 1).otherwise(2))


def protobuf_envelopes(events: DataFrame) -> DataFrame:
    c = F.col

    def tag(number: int, wire_type: int = 2) -> Column:
        key = number << 3 | wire_type
        return F.lit(bytes([key]) if key < 128 else bytes([key & 127 | 128, key >> 7]))

    parts = _with_texts(events).withColumns({
        "_p_user": wire.varint(c("user_id")), "_p_number": wire.varint(c("event_id")), "_p_minus": wire.zigzag(-c("user_id")), "_p_kind": wire.varint(c("_kind")),
        "_p_id": wire.sized(c("_id")), "_p_type": wire.sized(c("event_type")), "_p_iso": wire.sized(c("_iso")), "_p_props": wire.sized(c("props"))})
    parts = parts.withColumn("_marks", F.concat(c("_p_user"), c("_p_number"))).withColumn("_p_marks", wire.sized(c("_marks")))
    parts = parts.withColumns({
        "_payload": F.concat(tag(1, 0), c("_p_minus"), F.when(c("event_id") % 5 == 0, _bin("")).otherwise(F.concat(tag(2), c("_p_marks")))),
        "_entry": F.concat(tag(1), F.lit(b"\x07user_id"), tag(2, 0), c("_p_user"))})
    parts = parts.withColumns({"_p_payload": wire.sized(c("_payload")), "_p_entry": wire.sized(c("_entry"))})
    fields = [tag(1), c("_p_id"), tag(2), c("_p_type"), tag(3), c("_p_iso"), tag(4), c("_p_payload"), tag(5, 0), c("_p_kind"), tag(6), c("_p_entry")]
    backward = [x for k in range(len(fields) - 2, -1, -2) for x in fields[k:k + 2]]
    unknown = F.concat(tag(200), F.lit(b"\x05later"))
    event = (F.when(c("event_id") % 6 == 0, F.concat(unknown, *fields)).when(c("event_id") % 2 == 0, F.concat(*fields))
             .otherwise(F.concat(tag(2), F.lit(b"\x05first"), *backward, tag(200, 0), c("_p_user"), tag(1), c("_p_id"))))
    inner = F.concat(tag(3), c("_p_props"), tag(1), c("_p_id"), tag(2), c("_p_type"))
    body = (F.when(c("event_id") % 50 == 2, F.concat(_bin("00"), tag(1), c("_p_props")))
            .when(c("event_id") % 10 == 7, F.concat(_bin("040400"), inner)).otherwise(F.concat(_bin("0202"), event)))
    return _framed(parts, body, F.lit(1))
