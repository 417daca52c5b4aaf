"""Registered queries: one per operator group, over the driver's tables.

Each query takes ``(spark, sf_dir)`` and reads the given tables (``events``
and, for the producer, the same table) at full size.  Outputs alias every
computed column and cast instants to ``timestamp_ntz`` so they compare with
DuckDB's ``TIMESTAMP``.  Queries that exercise sinks write into a fresh
folder under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import wire
from quayside.operators.conform import conform, export_json_column, read_conformed
from quayside.operators.decode import decode_events
from quayside.operators.dedup import keep_first
from quayside.operators.validate import check_json, coerce_times, outcome_counts, quarantine
from quayside.plans.ingest import accepted_conformed, accepted_rows, process_events
from quayside.schema import POLICIES, add_field, ensure_table, event_schema, evolve_table, field, remove_field
from quayside.session import ensure_checkpoint_dir, pin_session, scratch_path
from quayside.sinks.commit import read_committed
from quayside.sinks.deliver import deliver, redeliver
from quayside.sinks.writers import Sink, clickhouse_layout, files_sink, landing_sink, table_sink
from quayside.sources.envelope import envelope_from_events, read_envelope_files, write_envelope_files
from quayside.sources.producer import producer_envelopes
from quayside.sources.records import AVRO_SCHEMAS, PROTOBUF_SCHEMAS, avro_envelopes, protobuf_envelopes
from quayside.streaming.late import batches_of_data_only, dedup_keeping_late
from quayside.streaming.stream import handle_batch, start_stream

# fixed batch time of the deterministic runs: inside the events' month, so
# the future-time rule rejects the last days
AS_OF = "2024-01-25T00:00:00"
# the producer query's batch time: after every generated event
PRODUCER_AS_OF = "2024-02-01T00:00:00"
SPLIT_TIME = "2024-01-10T00:00:00"     # first delivery / second delivery boundary
EVOLVE_TIME = "2024-01-15T00:00:00"    # rows before: schema v1, after: v2

CONFORMED = ("event_id", "event_type", "timestamp", "payload", "source", "metadata", "processed_at")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_session(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _envelopes(spark, sf_dir) -> DataFrame:
    events, cores = _events(spark, sf_dir), spark.sparkContext.defaultParallelism
    # the decode costs far more than the small rows' way to idle cores
    if events.rdd.getNumPartitions() < cores:
        events = events.repartition(cores)
    return envelope_from_events(events)


def _processed(spark, sf_dir, as_of=AS_OF) -> DataFrame:
    return process_events(_envelopes(spark, sf_dir), as_of=as_of)


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.selectExpr(*[f"CAST(`{c}` AS TIMESTAMP_NTZ) AS `{c}`" if c in cols else f"`{c}`" for c in df.columns])


def _out(df: DataFrame) -> DataFrame:
    """Cast every TimestampType column to timestamp_ntz (DuckDB TIMESTAMP)."""
    ts = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return _ntz(df, *ts)


def _accepted(spark, sf_dir, keep=("partition", "offset")) -> DataFrame:
    return accepted_conformed(_processed(spark, sf_dir), keep=keep)


# ---------------------------------------------------------------- queries

def q_envelope_parse(spark, sf_dir):
    d = decode_events(_envelopes(spark, sf_dir), keep_unparsed=False)
    return _out(d.select("event_id", "event_type", "timestamp", "payload", "source", "metadata",
                         "kafka_timestamp", "partition", "offset"))


def q_wire_frame_split(spark, sf_dir):
    env = _envelopes(spark, sf_dir)
    schema_id = 1 + F.col("partition")
    good = wire.frame(schema_id, F.col("value"))
    bad_magic = F.concat(F.unhex(F.lit("01")), F.substring(good, 2, 1 << 30))
    framed = env.select("offset", F.when(F.col("offset") % 50 == 0, bad_magic).otherwise(good).alias("value"))
    return framed.select(
        "offset", wire.frame_magic(F.col("value")).alias("magic"),
        wire.frame_schema_id(F.col("value")).alias("schema_id"),
        wire.frame_body(F.col("value")).cast("string").alias("body"),
        wire.frame_ok(F.col("value")).alias("frame_ok"))


def q_timestamp_coerce(spark, sf_dir):
    c = coerce_times(decode_events(_envelopes(spark, sf_dir)), as_of=AS_OF)
    return _out(c.select("offset", "event_id", "timestamp_text", "timestamp", "timestamp_defaulted"))


def q_payload_json_check(spark, sf_dir):
    return check_json(decode_events(_envelopes(spark, sf_dir))).select("offset", "event_id", "payload", "payload_valid", "payload_truthy")


def q_metadata_json_check(spark, sf_dir):
    return check_json(decode_events(_envelopes(spark, sf_dir))).select(
        "offset", "event_id", "metadata", "metadata_valid", "metadata_truthy", "metadata_is_object")


def q_mandatory_fields(spark, sf_dir):
    d = decode_events(_envelopes(spark, sf_dir))
    ok = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    return d.select("offset", "event_id", ok("event_id").alias("event_id_ok"),
                    ok("event_type").alias("event_type_ok"), ok("source").alias("source_ok"))


def q_future_filter(spark, sf_dir):
    c = coerce_times(decode_events(_envelopes(spark, sf_dir)), as_of=AS_OF)
    return _out(c.select("offset", "event_id", "timestamp",
                         (F.col("timestamp") > F.col("batch_ts")).alias("is_future")))


def q_accepted_events(spark, sf_dir):
    return _out(_accepted(spark, sf_dir))


def q_rejected_events(spark, sf_dir):
    return _out(quarantine(_processed(spark, sf_dir)).drop("event_date"))


def q_reject_counts(spark, sf_dir):
    return outcome_counts(_processed(spark, sf_dir))


def q_enrich_metadata(spark, sf_dir):
    a = _accepted(spark, sf_dir)
    m = F.col("metadata")
    return a.select("offset", "event_id",
                    F.get_json_object(m, "$.processed_at").alias("processed_at_key"),
                    F.get_json_object(m, "$.processing_version").alias("processing_version_key"),
                    F.get_json_object(m, "$.user_id").alias("user_id_key"),
                    F.size(F.json_object_keys(m)).cast("long").alias("key_count"))


def normalize_type_and_extract_k(df: DataFrame) -> DataFrame:
    """Example user transform (E3): canonical event type + payload key ``k``."""
    return (df.withColumn("event_type", F.upper(F.trim(F.col("event_type"))))
              .withColumn("payload_k", F.get_json_object(F.col("payload"), "$.k").cast("long")))


def q_user_transform(spark, sf_dir):
    out = accepted_rows(_processed(spark, sf_dir), normalize_type_and_extract_k)
    return out.select("offset", "event_id", "event_type", "payload_k")


def q_conform_default_schema(spark, sf_dir):
    return _out(accepted_conformed(_processed(spark, sf_dir)))


def q_conform_empty(spark, sf_dir):
    p = _processed(spark, sf_dir)
    none = p.filter(F.col("reject_reason").isNull() & (F.col("timestamp") > F.col("batch_ts")))
    return _out(conform(none, event_schema().struct))


def q_export_event_json(spark, sf_dir):
    a = _accepted(spark, sf_dir)
    # from_json reads NaN, which get_json_object does not, but would quote it in the payload's own text
    fields = "event_id STRING, timestamp STRING, metadata STRUCT<processing_version: STRING>"
    text = a.select("offset", export_json_column().alias("event_json"))
    return text.select("offset", F.from_json("event_json", fields).alias("ej"), F.regexp_extract("event_json", '"payload":(.*),"source":', 1).alias("ej_payload")).select(
        "offset", F.col("ej.event_id").alias("ej_event_id"), F.col("ej.timestamp").alias("ej_timestamp"),
        "ej_payload", F.col("ej.metadata.processing_version").alias("ej_processing_version"))


def _deduped(spark, sf_dir) -> DataFrame:
    return keep_first(_accepted(spark, sf_dir))


def q_dedup_in_batch(spark, sf_dir):
    return _out(_deduped(spark, sf_dir))


def q_dedup_against_sink(spark, sf_dir):
    """The whole batch into a sink that holds its first days: what the second delivery adds."""
    ensure_checkpoint_dir(spark)
    batch = _accepted(spark, sf_dir, keep=("partition", "offset", "event_date"))
    path, added = scratch_path(spark, "dedup-target"), scratch_path(spark, "dedup-added")
    first = keep_first(batch).filter(F.col("timestamp") < F.lit(SPLIT_TIME).cast("timestamp"))
    target = files_sink("target", path)
    target.write(first.drop("partition", "offset"), 0)
    # the second delivery goes to a folder of its own, compared with what the target holds
    deliver(batch, 1, [Sink("added", landing_sink("added", added).write, target.existing, wants_event_date=True,
                            keeps_positions=True)], dedup=True)
    return _out(spark.read.parquet(f"{added}/batch_id=1").drop("event_date"))


def _broken_sink(name: str = "broken") -> Sink:
    def write(df, batch_id):
        raise RuntimeError(f"sink {name} is unreachable")
    return Sink(name, write)


def q_fanout_counts(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    a = _accepted(spark, sf_dir, keep=("partition", "offset", "event_date"))
    sinks = [files_sink("a", scratch_path(spark, "sink-a")), _broken_sink(),
             files_sink("b", scratch_path(spark, "sink-b"))]
    ledger = deliver(a, 0, sinks, scratch_path(spark, "ledger"), "fanout", dedup=True)
    return ledger.select("sink", "status", F.col("rows").alias("row_count"), "duplicates")


def q_replay_safe(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    a = _accepted(spark, sf_dir, keep=("partition", "offset", "event_date"))
    path, ledger = scratch_path(spark, "replay-sink"), scratch_path(spark, "replay-ledger")
    sink = files_sink("events", path)
    deliver(a, 7, [sink], ledger, "replay", dedup=True)   # first delivery
    deliver(a, 7, [sink], None, dedup=True)               # crash before the ledger write: replay sees the sink
    deliver(a, 7, [sink], ledger, "replay", dedup=True)   # replay after restart: ledger says done
    return _out(spark.read.parquet(path).drop("event_date"))


def q_redelivery(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    a = _accepted(spark, sf_dir, keep=("partition", "offset", "event_date"))
    ledger, landing, target = (scratch_path(spark, "redeliver-ledger"), scratch_path(spark, "landing"),
                               scratch_path(spark, "redeliver-target"))
    deliver(a, 11, [landing_sink("landing", landing), _broken_sink("target")], ledger, "redelivery", dedup=True)
    redeliver(spark, ledger, landing, [files_sink("target", target)], "redelivery")     # the sink is back
    return _out(spark.read.parquet(target).drop("event_date"))


def q_stream_parity(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    src, out = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-out")
    write_envelope_files(_envelopes(spark, sf_dir), src, files=4)
    stream = read_envelope_files(spark, src, streaming=True, max_files_per_trigger=1,
                                 partitions=spark.sparkContext.defaultParallelism)
    q = start_stream(process_events(stream, as_of=AS_OF), [files_sink("out", out)], scratch_path(spark, "stream-checkpoint"),
                     ledger_path=scratch_path(spark, "stream-ledger"), trigger={"availableNow": True})
    q.awaitTermination()
    return _out(spark.read.parquet(out).drop("event_date"))


def q_stream_outcome_metrics(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    src, metrics = scratch_path(spark, "metrics-src"), scratch_path(spark, "metrics")
    write_envelope_files(_envelopes(spark, sf_dir), src, files=4)
    stream = read_envelope_files(spark, src, streaming=True, max_files_per_trigger=2,
                                 partitions=spark.sparkContext.defaultParallelism)
    q = start_stream(process_events(stream, as_of=AS_OF), [files_sink("out", scratch_path(spark, "metrics-out"))],
                     scratch_path(spark, "metrics-checkpoint"), trigger={"availableNow": True}, metrics_path=metrics)
    q.awaitTermination()
    return spark.read.parquet(metrics).groupBy("outcome").agg(F.sum("events").alias("events"))


def q_restart_new_query(spark, sf_dir):
    """Two queries over the two halves of the events, one sink and one ledger: both count
    their batches from 0, and neither is taken for a replay of the other."""
    ensure_checkpoint_dir(spark)
    env = _envelopes(spark, sf_dir)
    out, ledger = scratch_path(spark, "restart-out"), scratch_path(spark, "restart-ledger")
    for half in (0, 1):
        src = scratch_path(spark, "restart-src")
        write_envelope_files(env.filter(F.col("offset") % 2 == half), src, files=2)
        stream = read_envelope_files(spark, src, streaming=True)
        start_stream(process_events(stream, as_of=AS_OF), [files_sink("out", out)], scratch_path(spark, "restart-checkpoint"),
                     ledger_path=ledger, trigger={"availableNow": True}).awaitTermination()
    return _out(spark.read.parquet(out).drop("event_date"))


def q_quarantine_delivery(spark, sf_dir):
    """Rejected rows as they arrive in a quarantine sink of the default layout."""
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, "quarantine")
    handle_batch(_processed(spark, sf_dir), 0, [files_sink("out", scratch_path(spark, "quarantine-out"))],
                 scratch_path(spark, "quarantine-ledger"), "quarantine", quarantine=files_sink("q", path))
    return _out(spark.read.parquet(path).drop("event_date"))


def q_redelivery_plain(spark, sf_dir):
    """A batch delivered without dedup is delivered again without dedup: every accepted row arrives."""
    ensure_checkpoint_dir(spark)
    a = _accepted(spark, sf_dir, keep=("partition", "offset", "event_date"))
    ledger, landing, target = (scratch_path(spark, "plain-ledger"), scratch_path(spark, "plain-landing"),
                               scratch_path(spark, "plain-target"))
    deliver(a, 3, [landing_sink("landing", landing), _broken_sink("target")], ledger, "plain")
    redeliver(spark, ledger, landing, [files_sink("target", target)], "plain")
    return _out(spark.read.parquet(target).drop("event_date"))


def q_plain_replay_safe(spark, sf_dir):
    """A batch delivered without dedup whose ledger row is lost: the replay finds the sink's commit, and every accepted row stands once."""
    ensure_checkpoint_dir(spark)
    a = _accepted(spark, sf_dir, keep=("partition", "offset", "event_date"))
    path = scratch_path(spark, "plain-sink")
    for ledger in ("plain-ledger-lost", "plain-ledger"):       # the second ledger knows nothing of the first delivery
        deliver(a, 4, [files_sink("t", path)], scratch_path(spark, ledger), "plain")
    return _out(read_committed(spark, path).drop("event_date"))


def q_table_replay_safe(spark, sf_dir):
    """A batch delivered three times to a catalog table."""
    ensure_checkpoint_dir(spark)
    table = f"quayside_replay_{uuid.uuid4().hex[:10]}"
    ensure_table(spark, event_schema(), table, location=scratch_path(spark, table))
    a = _accepted(spark, sf_dir, keep=("partition", "offset", "event_date"))
    ledger = scratch_path(spark, "table-ledger")
    for path in (ledger, None, ledger):
        deliver(a, 0, [table_sink("t", table)], path, "table", dedup=True)
    return _out(spark.table(table).drop("event_date"))


def q_evolved_table_append(spark, sf_dir):
    """Rows of version 1, of version 2 and of a schema without ``metadata`` in one evolved table."""
    ensure_checkpoint_dir(spark)
    v1 = event_schema(1)
    v2 = add_field(v1, field("region", "string"), version=2)
    v3 = remove_field(v2, "metadata", version=3)
    table = f"quayside_append_{uuid.uuid4().hex[:10]}"
    ensure_table(spark, v1, table, location=scratch_path(spark, table))
    evolve_table(spark, table, v1, v2)
    a = _accepted(spark, sf_dir, keep=("offset",)).withColumn("region", F.concat(F.lit("region-"), F.col("source")))
    for n, schema in enumerate((v1, v2, v3)):
        table_sink(f"v{n + 1}", table).write(conform(a.filter(F.col("offset") % 3 == n), schema.struct), n)
    return _out(spark.table(table).select("event_id", "timestamp", "region",
                                          F.col("metadata").isNotNull().alias("has_metadata")))


def q_newer_rows_older_table(spark, sf_dir):
    """Rows with a column that the table lacks (those with an odd offset have a value there), by policy: where they arrive."""
    ensure_checkpoint_dir(spark)
    a = _accepted(spark, sf_dir, keep=("offset", "event_date")).withColumn("region", F.when(F.col("offset") % 2 == 1, F.concat(F.lit("region-"), F.col("source"))))
    batch, out = a.drop("offset"), None
    for policy in POLICIES:
        table, away = f"quayside_newer_{uuid.uuid4().hex[:10]}", scratch_path(spark, "newer-quarantine")
        ensure_table(spark, event_schema(1), table, location=scratch_path(spark, table))
        sink = table_sink("t", table, on_newer=policy, quarantine=files_sink("q", away))
        deliver(batch, 0, [sink], scratch_path(spark, "newer-ledger"), f"newer-{policy}")
        held = spark.table(table)
        region = F.col("region") if "region" in held.columns else F.lit(None).cast("string")
        parts = [held.select(F.lit(policy).alias("policy"), F.lit("table").alias("place"), "event_id", region.alias("region"))]
        if policy == "quarantine":
            parts.append(spark.read.parquet(away).select(F.lit(policy).alias("policy"), F.lit("quarantine").alias("place"), "event_id",
                                                         F.get_json_object("raw_value", "$.region").alias("region")))
        for p in parts:
            out = p if out is None else out.unionByName(p)
    return out


def q_dedup_all_dates(spark, sf_dir):
    """One row per event_id over all batches and dates: the second batch repeats the first
    with event times a day later, and brings the odd offsets."""
    ensure_checkpoint_dir(spark)
    a = _accepted(spark, sf_dir, keep=("partition", "offset", "event_date")).persist(StorageLevel.MEMORY_AND_DISK)     # both batches have its rows
    path = scratch_path(spark, "all-dates")
    try:
        deliver(a.filter(F.col("offset") % 2 == 0), 0, [files_sink("t", path)], dedup=True, key_scope="all")
        later = (a.withColumn("timestamp", F.expr("`timestamp` + INTERVAL 1 DAY"))
                 .withColumn("event_date", F.date_add("event_date", 1)))
        deliver(later, 1, [files_sink("t", path)], dedup=True, key_scope="all")
    finally:
        a.unpersist()
    return spark.read.parquet(path).groupBy("event_id").agg(F.count(F.lit(1)).alias("row_count"))


def q_schema_merge_read(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    v1 = event_schema(1)
    v2 = add_field(v1, field("region", "string"), version=2)
    path = scratch_path(spark, "merge")
    a = _accepted(spark, sf_dir, keep=())
    cut = F.lit(EVOLVE_TIME).cast("timestamp")
    conform(a.filter(F.col("timestamp") < cut), v1.struct).write.parquet(f"{path}/schema_version=1")
    later = a.filter(F.col("timestamp") >= cut).withColumn("region", F.concat(F.lit("region-"), F.col("source")))
    conform(later, v2.struct).write.parquet(f"{path}/schema_version=2")
    return _out(read_conformed(spark, path, v2.struct).select("event_id", "timestamp", "region"))


def q_layout_by_day(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, "by-day")
    files_sink("by_day", path).write(_accepted(spark, sf_dir, keep=("event_date",)), 0)
    return spark.read.parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))


def q_layout_by_month(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, "by-month")
    laid = clickhouse_layout(_accepted(spark, sf_dir, keep=()))
    laid.withColumn("event_month", F.date_format("timestamp", "yyyyMM")).write.partitionBy("event_month") \
        .parquet(path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("event_month").cast("int").alias("event_month")).agg(
        F.count(F.lit(1)).alias("events"))


def q_schema_evolve_read(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    v1 = event_schema(1)
    v2 = add_field(v1, field("region", "string"), version=2)
    table = f"quayside_evolve_{uuid.uuid4().hex[:10]}"
    ensure_table(spark, v1, table, location=scratch_path(spark, table))
    a = _accepted(spark, sf_dir, keep=())
    cut = F.lit(EVOLVE_TIME).cast("timestamp")
    table_sink("v1", table).write(a.filter(F.col("timestamp") < cut), 0)
    evolve_table(spark, table, v1, v2)
    later = a.filter(F.col("timestamp") >= cut).withColumn("region", F.concat(F.lit("region-"), F.col("source")))
    table_sink("v2", table).write(conform(later, v2.struct), 1)
    return _out(spark.table(table).select("event_id", "timestamp", "region"))


def q_generated_events(spark, sf_dir):
    env = producer_envelopes(_events(spark, sf_dir))
    return _out(accepted_conformed(process_events(env, as_of=PRODUCER_AS_OF)))


def _decoded_records(envelopes: DataFrame, fmt: str, schemas: dict) -> DataFrame:
    d = decode_events(envelopes, fmt, schemas)
    return _out(d.select("offset", "event_id", "event_type", F.col("timestamp").cast("timestamp").alias("event_time"), "payload", "source",
                         "metadata", "decode_error"))


def q_avro_decode(spark, sf_dir):
    """Every event as a framed Avro value of one of two writer schemas, decoded."""
    return _decoded_records(avro_envelopes(_events(spark, sf_dir)), "avro", AVRO_SCHEMAS)


def q_protobuf_decode(spark, sf_dir):
    """Every event as a framed Protobuf value of one of two messages of a file, decoded."""
    return _decoded_records(protobuf_envelopes(_events(spark, sf_dir)), "protobuf", PROTOBUF_SCHEMAS)


def q_late_side_output(spark, sf_dir):
    """One row per event_id over two runs of a stream: the even offsets, then the odd ones, of which those behind the watermark are late."""
    ensure_checkpoint_dir(spark)
    src, out, checkpoint = (scratch_path(spark, f"late-{n}") for n in ("src", "out", "checkpoint"))
    env = _envelopes(spark, sf_dir)
    for half in (0, 1):
        write_envelope_files(env.filter(F.col("offset") % 2 == half), src, files=max(2, spark.sparkContext.defaultParallelism))
        rows = accepted_conformed(process_events(read_envelope_files(spark, src, streaming=True), as_of=AS_OF), keep=("partition", "offset"))
        with batches_of_data_only(spark):
            q = (dedup_keeping_late(rows).writeStream.format("parquet").option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start(out))
        q.awaitTermination()
    return _out(spark.read.parquet(out).select("event_id", "offset", "timestamp", "arrival", "missed_watermark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "envelope_parse": q_envelope_parse,
    "wire_frame_split": q_wire_frame_split,
    "timestamp_coerce": q_timestamp_coerce,
    "payload_json_check": q_payload_json_check,
    "metadata_json_check": q_metadata_json_check,
    "mandatory_fields": q_mandatory_fields,
    "future_filter": q_future_filter,
    "accepted_events": q_accepted_events,
    "rejected_events": q_rejected_events,
    "reject_counts": q_reject_counts,
    "enrich_metadata": q_enrich_metadata,
    "user_transform": q_user_transform,
    "conform_default_schema": q_conform_default_schema,
    "conform_empty": q_conform_empty,
    "export_event_json": q_export_event_json,
    "dedup_in_batch": q_dedup_in_batch,
    "dedup_against_sink": q_dedup_against_sink,
    "fanout_counts": q_fanout_counts,
    "replay_safe": q_replay_safe,
    "redelivery": q_redelivery,
    "stream_parity": q_stream_parity,
    "stream_outcome_metrics": q_stream_outcome_metrics,
    "schema_merge_read": q_schema_merge_read,
    "layout_by_day": q_layout_by_day,
    "layout_by_month": q_layout_by_month,
    "schema_evolve_read": q_schema_evolve_read,
    "generated_events": q_generated_events,
    "restart_new_query": q_restart_new_query,
    "quarantine_delivery": q_quarantine_delivery,
    "redelivery_plain": q_redelivery_plain,
    "plain_replay_safe": q_plain_replay_safe,
    "table_replay_safe": q_table_replay_safe,
    "evolved_table_append": q_evolved_table_append,
    "dedup_all_dates": q_dedup_all_dates,
    "newer_rows_older_table": q_newer_rows_older_table,
    "avro_decode": q_avro_decode,
    "protobuf_decode": q_protobuf_decode,
    "late_side_output": q_late_side_output,
}
