import json

from pyspark.sql import functions as F

from quayside.sources.envelope import ENVELOPE_SCHEMA

BASE = {"event_id": "x", "event_type": "t", "timestamp": "2024-01-01T00:00:00", "payload": {"a": 1},
        "source": "s", "metadata": {"version": "1.0"}}
AS_OF = "2024-01-25T00:00:00"
MISSING = object()


def record(**changes):
    rec = dict(BASE)
    for k, v in changes.items():
        if v is MISSING:
            rec.pop(k, None)
        else:
            rec[k] = v
    return json.dumps(rec)


def envelopes(spark, values):
    """Envelope rows from raw value texts (offset = position)."""
    rows = [(None, None if v is None else v.encode(), "t", 0, i, None, 0) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, ENVELOPE_SCHEMA)
    return df.withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))
