"""Avro and Protobuf values: readers, framing, schema versions, broken values."""

import json
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.functions.avro import decode_avro, parse_avro
from quayside.functions.protobuf import decode_protobuf, index_prefixes, load_message
from quayside.operators.decode import decode_events
from quayside.sources.envelope import ENVELOPE_SCHEMA
from quayside.sources.records import AVRO_V1, PROTOBUF_DESCRIPTOR, PROTOBUF_SCHEMAS


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def zz(n):
    return varint((n << 1) ^ (n >> 63) if n >= 0 else -2 * n - 1)


def text(t):
    return zz(len(t.encode())) + t.encode()


WRITER = {"type": "record", "name": "R", "namespace": "n", "fields": [
    {"name": "id", "type": "string"}, {"name": "i", "type": "int"}, {"name": "l", "type": "long"}, {"name": "f", "type": "float"},
    {"name": "b", "type": "boolean"}, {"name": "tags", "type": {"type": "array", "items": ["null", "string"]}},
    {"name": "m", "type": {"type": "map", "values": {"type": "array", "items": "int"}}}, {"name": "u", "type": ["null", "string", "long"]},
    {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["A", "B"]}}, {"name": "e2", "type": "E"},
    {"name": "x", "type": {"type": "fixed", "name": "X", "size": 2}}]}


def encode(id, i, l, f, b, tags, m, u, e, e2, x):
    out = text(id) + zz(i) + zz(l) + struct.pack("<f", f) + bytes([b])
    if tags:
        out += zz(len(tags)) + b"".join(zz(0) if t is None else zz(1) + text(t) for t in tags)
    out += zz(0)
    for k, v in m.items():       # a block for each entry, with its size
        entry = text(k) + (zz(len(v)) + b"".join(map(zz, v)) if v else b"") + zz(0)
        out += zz(-1) + zz(len(entry)) + entry
    out += zz(0) + (zz(0) if u is None else zz(1) + text(u) if isinstance(u, str) else zz(2) + zz(u))
    return out + zz("AB".index(e)) + zz("AB".index(e2)) + x


ROWS = [("", 0, 0, 0.0, False, [], {}, None, "A", "B", b"ab"),
        ("aé" * 300, -2**31, -2**63, 1.5, True, ["x", None, ""], {"k": [1, -2], "": []}, "s", "B", "A", b"\0\xff"),
        ("z", 2**31 - 1, 2**63 - 1, -0.25, True, [None], {"k": [7]}, -5, "A", "A", b"  ")]


def plain(row):
    names = [f["name"] for f in WRITER["fields"]]
    out = dict(zip(names, row))
    out["m"] = list(out["m"].items())
    if out["u"] is not None:
        out["u"] = {"member0": out["u"] if isinstance(out["u"], str) else None, "member1": None if isinstance(out["u"], str) else out["u"]}
    return out


def test_avro_types_round_trip_and_broken_values_are_null():
    w = parse_avro(json.dumps(WRITER))
    good = [encode(*r) for r in ROWS]
    values = [good[0], None, good[1], good[1][:-1], good[2], b"", b"\xff" * 30, good[0] + b"rest"]
    got = decode_avro(pa.array(values, pa.binary()), w, w).to_pylist()
    assert got == [plain(ROWS[0]), None, plain(ROWS[1]), None, plain(ROWS[2]), None, None, plain(ROWS[0])]
    sliced = decode_avro(pa.array(values, pa.binary()).slice(4, 2), w, w).to_pylist()
    assert sliced == [plain(ROWS[2]), None]
    assert decode_avro(pa.array([], pa.binary()), w, w).to_pylist() == []
    every_cut = decode_avro(pa.array([good[1][:k] for k in range(len(good[1]))], pa.binary()), w, w)
    assert every_cut.null_count == len(good[1])


def test_avro_reader_schema():
    w = parse_avro(json.dumps(WRITER))
    r = parse_avro({"type": "record", "name": "R", "fields": [
        {"name": "key", "aliases": ["id"], "type": "bytes"}, {"name": "i", "type": ["null", "double"]}, {"name": "new", "type": "string", "default": "d"},
        {"name": "m", "type": {"type": "map", "values": {"type": "array", "items": "long"}}},
        {"name": "more", "type": {"type": "map", "values": "int"}, "default": {"a": 1}}]})
    got = decode_avro(pa.array([encode(*ROWS[2])], pa.binary()), w, r).to_pylist()
    assert got == [{"key": b"z", "i": 2.0**31 - 1, "new": "d", "m": [("k", [7])], "more": [("a", 1)]}]
    no_default = parse_avro({"type": "record", "name": "R", "fields": [{"name": "gone", "type": "string"}]})
    assert decode_avro(pa.array([encode(*ROWS[2])], pa.binary()), w, no_default).to_pylist() == [None]


def test_avro_recursive_schema_is_refused():
    with pytest.raises(ValueError, match="contains itself"):
        parse_avro({"type": "record", "name": "T", "fields": [{"name": "next", "type": ["null", "T"]}]})


def test_protobuf_fields_in_any_order():
    message, path = load_message("shop.Event", PROTOBUF_DESCRIPTOR)
    assert path == (1,) and load_message("shop.Wrap.Event", PROTOBUF_DESCRIPTOR)[1] == (2, 0)
    assert index_prefixes((0,)) == [b"\x00", b"\x02\x00"] and index_prefixes((2, 0)) == [b"\x04\x04\x00"]
    ident, payload = b"\x0a\x01x", b"\x22\x07" + b"\x08\x05\x12\x03\x01\xac\x02"       # user zigzag 5 = -3, marks 1 and 300
    unpacked = b"\x22\x04\x10\x07\x10\x08"                                            # marks one by one; replaces the payload before
    empty_entry = b"\x32\x00"
    got = decode_protobuf(pa.array([
        ident + payload, payload + b"\xc0\x0c\x09" + ident, ident + payload + unpacked, b"", ident + empty_entry + b"\x28\x63",
        ident + payload[:-1], b"\x0a\x02x", b"\x0b", b"\x0a\x01\xff", None], pa.binary()), message).to_pylist()
    base = {"event_id": "x", "event_type": None, "timestamp": None, "payload": {"user": -3, "marks": [1, 300]}, "source": None, "metadata": []}
    assert got[:2] == [base, base]
    assert got[2]["payload"] == {"user": None, "marks": [7, 8]}
    assert got[3] == {**base, "event_id": None, "payload": None}
    assert got[4]["metadata"] == [("", 0)] and got[4]["source"] == "99"
    assert got[5:] == [None] * 5      # cut, cut, group, no UTF-8, null


def test_protobuf_against_the_library():
    pool = pytest.importorskip("google.protobuf.descriptor_pool").DescriptorPool()
    from google.protobuf.descriptor_pb2 import FileDescriptorSet
    from google.protobuf.message_factory import GetMessageClass
    pool.Add(FileDescriptorSet.FromString(PROTOBUF_DESCRIPTOR).file[0])
    event = GetMessageClass(pool.FindMessageTypeByName("shop.Event"))
    made = [event(event_id=f"é{k}" * k, event_type="t", payload={"user": -k * 10**12, "marks": [-k, k, 2**31 - 1]}, source=k % 3,
                  metadata={"a": -k, "b": k}) for k in range(1, 40)]
    message, _ = load_message("shop.Event", PROTOBUF_DESCRIPTOR)
    got = decode_protobuf(pa.array([m.SerializeToString() for m in made], pa.binary()), message).to_pylist()
    for m, g in zip(made, got):
        assert g["event_id"] == m.event_id and g["payload"] == {"user": m.payload.user, "marks": list(m.payload.marks)}
        assert dict(g["metadata"]) == dict(m.metadata) and g["source"] == ("web", "app", "api")[m.source]


def _envelopes(spark, values):
    rows = [(b"k%d" % i, v, "t", 0, i, None, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))


def test_framed_values_keep_key_and_say_what_is_wrong(spark):
    body = text("e1") + zz(1) + text("t") + text("2024-01-01") + text("{}") + text("s") + zz(0)
    reader = json.dumps({"type": "record", "name": "Event", "namespace": "shop", "fields": [
        {"name": "event_id", "type": "string"}, {"name": "source", "type": "string"}, {"name": "event_type", "type": "string", "default": "none"}]})
    values = [b"\0\0\0\0\x01" + body, b"\x01\0\0\0\x01" + body, b"\0\0\0\0\x07" + body, b"\0\0\0\0\x01" + body[:5], None, b"\0\0\0\0\x02" + body]
    out = decode_events(_envelopes(spark, values), "avro", {1: AVRO_V1, 2: {"writer": AVRO_V1, "reader": reader}}, keep_key=True)
    got = [(r.key, r.event_id, r.event_type, r.source, r.decode_error) for r in out.orderBy("offset").collect()]
    assert got == [("k0", "e1", "t", "s", None), ("k1", None, None, None, "bad_frame"), ("k2", None, None, None, "unknown_schema_id"),
                   ("k3", None, None, None, "bad_record"), ("k4", None, None, None, "bad_frame"), ("k5", "e1", "t", "s", None)]


def test_decoding_is_one_narrow_pass(spark):
    out = decode_events(_envelopes(spark, [b"\0\0\0\0\x01\x00"]), "protobuf", PROTOBUF_SCHEMAS)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
    assert out.first().decode_error == "unsupported_message_index"
