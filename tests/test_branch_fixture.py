"""One row per parse / validation branch (FIXTURES.md §4)."""

import json

import pytest

from helpers import AS_OF, MISSING, envelopes, record
from quayside.plans.ingest import process_events

CASES = [
    # (name, raw value, expected reject reason or None)
    ("base", record(), None),
    ("not_json", "not json", "malformed_value"),
    ("tombstone", None, "malformed_value"),
    ("json_array_root", '[{"event_id":"x"}]', "malformed_value"),
    ("no_event_id", record(event_id=MISSING), "missing_event_id"),
    ("empty_event_id", record(event_id=""), "empty_event_id"),
    ("numeric_event_id", record(event_id=123), None),
    ("no_event_type", record(event_type=MISSING), "empty_event_type"),
    ("no_source", record(source=MISSING), "empty_source"),
    ("empty_source", record(source=""), "empty_source"),
    *[(f"payload_{i}", record(payload=p), "empty_payload")
      for i, p in enumerate([MISSING, None, {}, [], 0, False, ""])],
    ("payload_text_not_json", record(payload="abc"), "payload_invalid_json"),
    ("payload_encoded_twice", record(payload='{"a":1}'), None),
    ("payload_trailing_junk", record(payload='{"a":1} junk'), "payload_invalid_json"),
    ("payload_array", record(payload=[1, 2]), None),
    ("payload_number", record(payload=5), None),
    ("payload_true", record(payload=True), None),
    *[(f"metadata_falsy_{i}", record(metadata=m), None) for i, m in enumerate([MISSING, None, {}, [], 0])],
    ("metadata_text_not_json", record(metadata="abc"), "metadata_invalid_json"),
    ("metadata_number", record(metadata=5), "metadata_not_object"),
    ("metadata_array", record(metadata=[1]), "metadata_not_object"),
    ("metadata_overwrite", record(metadata={"processed_at": "old", "v": 1}), None),
    ("metadata_nested", record(metadata={"n": {"x": [1, None]}, "z": None}), None),
    ("ts_space", record(timestamp="2024-01-01 00:00:00"), None),
    ("ts_unpadded", record(timestamp="2024-1-1 1:2:3"), None),
    ("ts_date", record(timestamp="2024-01-01"), None),
    ("ts_zulu", record(timestamp="2024-01-01T00:00:00Z"), None),
    ("ts_offset", record(timestamp="2024-01-01T05:30:00+05:30"), None),
    ("ts_basic_date", record(timestamp="20240101"), None),
    ("ts_basic", record(timestamp="20240101T101112"), None),
    ("ts_comma", record(timestamp="2024-01-01T10:11:12,5"), None),
    *[(f"ts_default_{i}", record(timestamp=t), None)
      for i, t in enumerate(["01/02/2024", "2024-1-1", "12:00", MISSING, None, "", 1704067200])],
    ("ts_future", record(timestamp="2024-01-26T00:00:00"), "future_timestamp"),
    ("ts_as_of", record(timestamp=AS_OF), None),
    ("extra_field", record(extra={"x": 1}), None),
]


@pytest.fixture(scope="module")
def processed(spark):
    env = envelopes(spark, [c[1] for c in CASES])
    rows = process_events(env, as_of=AS_OF).collect()
    return {CASES[r["offset"]][0]: r for r in rows}


@pytest.mark.parametrize("name,value,reason", CASES, ids=[c[0] for c in CASES])
def test_reason(processed, name, value, reason):
    assert processed[name]["reject_reason"] == reason


def test_every_row_has_one_outcome(processed):
    assert len(processed) == len(CASES)


def test_enriched_metadata(processed):
    m = json.loads(processed["base"]["metadata"])
    assert m == {"version": "1.0", "processed_at": "2024-01-25T00:00:00", "processing_version": "1.0"}
    assert list(m)[-2:] == ["processed_at", "processing_version"]
    for i in range(5):
        assert json.loads(processed[f"metadata_falsy_{i}"]["metadata"]) == {
            "processed_at": "2024-01-25T00:00:00", "processing_version": "1.0"}
    over = json.loads(processed["metadata_overwrite"]["metadata"])
    assert over["processed_at"] == "2024-01-25T00:00:00"
    assert list(over) == ["processed_at", "v", "processing_version"]      # dict.update keeps the position
    nested = json.loads(processed["metadata_nested"]["metadata"])
    assert nested["n"] == {"x": [1, None]} and nested["z"] is None


def test_values(processed):
    assert processed["numeric_event_id"]["event_id"] == "123"
    assert json.loads(processed["payload_encoded_twice"]["payload"]) == {"a": 1}
    assert processed["payload_array"]["payload"] == "[1,2]"
    ts = lambda n: processed[n]["timestamp"].isoformat()
    assert ts("ts_unpadded") == "2024-01-01T01:02:03"
    assert ts("ts_date") == "2024-01-01T00:00:00"
    assert ts("ts_offset") == "2024-01-01T00:00:00"
    assert ts("ts_basic") == "2024-01-01T10:11:12"
    assert ts("ts_comma") == "2024-01-01T10:11:12.500000"
    for i in range(7):
        r = processed[f"ts_default_{i}"]
        assert r["timestamp_defaulted"] and r["timestamp"].isoformat() == "2024-01-25T00:00:00"
    assert not processed["ts_as_of"]["timestamp_defaulted"]


def test_digits_as_epoch_option(spark):
    env = envelopes(spark, [record(timestamp="1704067200")])
    r = process_events(env, as_of=AS_OF, digits_as_epoch=True).first()
    assert r["timestamp"].isoformat() == "2024-01-01T00:00:00" and not r["timestamp_defaulted"]


def test_numeric_time_column_is_epoch_seconds(spark):
    from quayside.operators.validate import coerce_events
    df = spark.createDataFrame([("x", 1704067200)], "event_id string, timestamp long") \
        .selectExpr("event_id", "'t' AS event_type", "timestamp", "'{}' AS payload", "'s' AS source",
                    "CAST(NULL AS STRING) AS metadata")
    r = coerce_events(df, as_of=AS_OF).first()
    assert r["timestamp"].isoformat() == "2024-01-01T00:00:00"


def test_export_json(spark):
    from quayside.operators.conform import export_json
    from quayside.plans.ingest import accepted_conformed
    env = envelopes(spark, [record(), record(metadata=None, payload=[1, 2])])
    rows = export_json(accepted_conformed(process_events(env, as_of=AS_OF))).collect()
    docs = sorted((json.loads(r["event_json"]) for r in rows), key=lambda d: str(d["payload"]))
    assert docs[0]["payload"] == [1, 2] and docs[1]["payload"] == {"a": 1}
    assert docs[0]["timestamp"] == "2024-01-01T00:00:00"
    assert docs[0]["metadata"]["processing_version"] == "1.0"
    assert set(docs[0]) == {"event_id", "event_type", "timestamp", "payload", "source", "metadata"}
