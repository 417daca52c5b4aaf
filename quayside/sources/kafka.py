"""Kafka source and publisher.

The options the ingestion job uses, in one place, for both the streaming
reader and the batch reader (replay by explicit offsets).  Kafka support is
Spark's own ``kafka`` data source; it needs the
``spark-sql-kafka-0-10`` package on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.operators.decode import MissingConnectorError

KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13"


def kafka_options(bootstrap_servers: str, topic: str, group_id: str | None = None,
                  starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                  max_offsets_per_trigger: int | None = None, ending_offsets: str | None = None,
                  min_partitions: int | None = None, extra: dict | None = None) -> dict[str, str]:
    """Subscribe to one topic; start at ``latest`` and tolerate lost
    offsets by default.  ``max_offsets_per_trigger`` bounds a micro-batch;
    ``min_partitions`` splits large offset ranges into more Spark tasks
    without a shuffle (for topics with fewer partitions than task slots)."""
    if not bootstrap_servers or not topic:
        raise ValueError("bootstrap_servers and topic are required")
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if ending_offsets:
        opts["endingOffsets"] = ending_offsets
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update(extra or {})
    return opts


def _missing_kafka(e: Exception) -> bool:
    msg = str(e)
    return "DATA_SOURCE_NOT_FOUND" in msg or "find data source: kafka" in msg


def _load(reader, what: str) -> DataFrame:
    try:
        return reader.load()
    except Exception as e:
        if _missing_kafka(e):
            raise MissingConnectorError(f"{what} needs {KAFKA_PACKAGE}:<spark version> on the classpath") from e
        raise


def read_kafka(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """Envelope DataFrame from Kafka (streaming, or batch between offsets)."""
    opts = dict(options)
    if not streaming:
        opts.pop("maxOffsetsPerTrigger", None)
        if opts.get("startingOffsets") == "latest":
            raise ValueError("a batch read that starts at the latest offsets reads nothing: "
                             "give starting_offsets='earliest' or explicit offsets")
        # split large offset ranges over every task slot; unlike a repartition
        # this moves no data (each task reads its own offset sub-range)
        opts.setdefault("minPartitions", str(spark.sparkContext.defaultParallelism))
    reader = (spark.readStream if streaming else spark.read).format("kafka").options(**opts)
    return _load(reader, "reading Kafka")


def publish(envelopes: DataFrame, bootstrap_servers: str, topic: str | None = None) -> None:
    """Write envelopes (``key``, ``value``) to a topic (batch)."""
    out = envelopes.select("key", "value", *([] if topic else ["topic"]))
    writer = out.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
    if topic:
        writer = writer.option("topic", topic)
    try:
        writer.save()
    except Exception as e:
        if _missing_kafka(e):
            raise MissingConnectorError(f"publishing to Kafka needs {KAFKA_PACKAGE}:<spark version>") from e
        raise


def offsets_json(topic: str, offsets: dict[int, int]) -> str:
    """``{"topic": {"0": 42, ...}}`` for startingOffsets / endingOffsets."""
    import json
    return json.dumps({topic: {str(p): int(o) for p, o in offsets.items()}})

