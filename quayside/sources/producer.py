"""Producer-shaped events from a table, as Kafka envelopes.

The sample producer's record shape, built for every row of a source table
with ``to_json(struct(...))`` on the executors (no driver loop, no sleep).
Publish with ``sources.kafka.publish``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.timestamps import python_isoformat_sql

# fixed values: the sample producer's constant fields
SAMPLE_PAGE = "/home"
SAMPLE_VALUE = 100
SAMPLE_SOURCE = "web-app"
SAMPLE_METADATA = {"version": "1.0", "environment": "production"}


def producer_events(events: DataFrame) -> DataFrame:
    """One producer record per ``events`` row (id, type, time, user)."""
    ts = F.col("ts").cast("timestamp")
    event_id = F.concat(F.lit("event_"), F.col("event_id").cast("string"), F.lit("_"),
                        F.unix_seconds(ts).cast("string"))
    payload = F.struct(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
                       F.col("event_type").alias("action"), F.lit(SAMPLE_PAGE).alias("page"),
                       F.lit(SAMPLE_VALUE).alias("value"))
    metadata = F.struct(*[F.lit(v).alias(k) for k, v in SAMPLE_METADATA.items()])
    record = F.struct(event_id.alias("event_id"), F.col("event_type").alias("event_type"),
                      F.expr(python_isoformat_sql("CAST(ts AS TIMESTAMP)")).alias("timestamp"), payload.alias("payload"),
                      F.lit(SAMPLE_SOURCE).alias("source"), metadata.alias("metadata"))
    return events.select(F.col("event_id").alias("_n"), F.col("user_id").alias("_u"), ts.alias("_ts"),
                         F.to_json(record).alias("value_text"))


def producer_envelopes(events: DataFrame, topic: str = "stream-events", partitions: int = 4) -> DataFrame:
    """The producer records as Kafka-shaped envelopes (keyed by user)."""
    p = producer_events(events)
    return p.select(F.col("_u").cast("string").cast("binary").alias("key"),
                    F.col("value_text").cast("binary").alias("value"),
                    F.lit(topic).alias("topic"),
                    (F.col("_u") % partitions).cast("int").alias("partition"),
                    F.col("_n").cast("long").alias("offset"),
                    F.col("_ts").alias("timestamp"),
                    F.lit(0).alias("timestampType"))
