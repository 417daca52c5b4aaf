"""Batch = stream parity, restart from checkpoint, watermark dedup."""

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF
from quayside.plans.ingest import accepted_conformed, process_events
from quayside.sinks.deliver import read_ledger
from quayside.sinks.writers import files_sink
from quayside.sources.envelope import envelope_from_events, read_envelope_files, write_envelope_files
from quayside.streaming.late import batches_of_data_only, dedup_keeping_late, split_late
from quayside.streaming.stream import dedup_within_watermark, handle_batch, start_stream

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.select("event_id", "timestamp", "payload", "metadata").collect())


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    src = str(tmp_path_factory.mktemp("src"))
    write_envelope_files(envelope_from_events(spark.read.parquet(f"{SF}/events.parquet")), src, files=4)
    batch = accepted_conformed(process_events(read_envelope_files(spark, src), as_of=AS_OF))
    return src, _rows(batch)


@pytest.mark.parametrize("per_trigger", [1, 4])
def test_stream_matches_batch(spark, tmp_dir, landed, per_trigger):
    src, expected = landed
    stream = read_envelope_files(spark, src, streaming=True, max_files_per_trigger=per_trigger)
    q = start_stream(process_events(stream, as_of=AS_OF), [files_sink("out", f"{tmp_dir}/out")],
                     ledger_path=f"{tmp_dir}/ledger", quarantine=files_sink("q", f"{tmp_dir}/q"),
                     checkpoint=f"{tmp_dir}/ckpt", trigger={"availableNow": True}, metrics_path=f"{tmp_dir}/m")
    q.awaitTermination()
    assert _rows(spark.read.parquet(f"{tmp_dir}/out")) == expected
    metrics = spark.read.parquet(f"{tmp_dir}/m")
    assert metrics.agg(F.sum("events")).first()[0] == spark.read.parquet(src).count()
    ledger = read_ledger(spark, f"{tmp_dir}/ledger")
    assert ledger.select("batch_id").distinct().count() == 4 // per_trigger
    total = spark.read.parquet(f"{tmp_dir}/out").count() + spark.read.parquet(f"{tmp_dir}/q").count()
    assert total == spark.read.parquet(src).count()       # every row has exactly one outcome


def test_restart_resumes_without_duplicates(spark, tmp_dir, landed):
    src, expected = landed
    sink = files_sink("out", f"{tmp_dir}/out")
    counts = []
    for _ in range(2):    # second start finds everything committed in the checkpoint
        stream = read_envelope_files(spark, src, streaming=True, max_files_per_trigger=2)
        q = start_stream(process_events(stream, as_of=AS_OF), [sink], ledger_path=f"{tmp_dir}/ledger",
                         checkpoint=f"{tmp_dir}/ckpt", trigger={"availableNow": True}, dedup=True)
        q.awaitTermination()
        counts.append(spark.read.parquet(f"{tmp_dir}/out").count())
    assert counts[0] == counts[1]
    ids = spark.read.parquet(f"{tmp_dir}/out").groupBy("event_date", "event_id").count()
    assert ids.filter("count > 1").count() == 0


def test_replayed_batch_is_not_duplicated(spark, tmp_dir, landed):
    src, _ = landed
    processed = process_events(read_envelope_files(spark, src), as_of=AS_OF)
    sink = files_sink("out", f"{tmp_dir}/out")
    handle_batch(processed, 0, [sink], f"{tmp_dir}/ledger", "r", dedup=True)
    handle_batch(processed, 0, [sink], None, dedup=True)          # ledger lost: sink read-back guards
    ids = spark.read.parquet(f"{tmp_dir}/out").groupBy("event_id").count()
    assert ids.filter("count > 1").count() == 0


def test_batch_time_is_one_value_per_micro_batch(spark, tmp_dir, landed):
    src, _ = landed
    stream = read_envelope_files(spark, src, streaming=True, max_files_per_trigger=2)
    q = start_stream(process_events(stream), [files_sink("out", f"{tmp_dir}/out")],
                     checkpoint=f"{tmp_dir}/ckpt", trigger={"availableNow": True})
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/out")
    per_batch = out.groupBy("processed_at").count().count()
    assert 1 <= per_batch <= 2
    md = out.select(F.get_json_object("metadata", "$.processed_at").alias("m"), "processed_at").distinct()
    assert md.count() == per_batch


def test_watermark_dedup_is_streaming(spark, tmp_dir, landed):
    src, _ = landed
    stream = read_envelope_files(spark, src, streaming=True)
    acc = accepted_conformed(process_events(stream, as_of=AS_OF))
    d = dedup_within_watermark(acc)
    assert d.isStreaming


def test_a_stream_needs_a_checkpoint(spark, landed):
    stream = read_envelope_files(spark, landed[0], streaming=True)
    with pytest.raises(TypeError):
        start_stream(process_events(stream), [files_sink("out", "unused")])
    with pytest.raises(ValueError):
        start_stream(process_events(stream), [files_sink("out", "unused")], "")
    with pytest.raises(ValueError):
        start_stream(process_events(stream), [files_sink("out", "unused")], "unused",
                     quarantine=files_sink("q", "unused", partition_by=("nope",)))


def test_a_new_query_is_no_replay_of_another(spark, tmp_dir, landed):
    """Two queries whose batch ids both begin at 0 share a ledger and a sink."""
    src, expected = landed
    for n in (1, 2):
        q = start_stream(process_events(read_envelope_files(spark, src, streaming=True), as_of=AS_OF),
                         [files_sink("out", f"{tmp_dir}/out")], f"{tmp_dir}/ckpt{n}", ledger_path=f"{tmp_dir}/ledger",
                         trigger={"availableNow": True})
        q.awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 2 * len(expected)
    assert read_ledger(spark, f"{tmp_dir}/ledger").select("run_id").distinct().count() == 2


def test_metrics_of_a_replayed_batch_are_replaced(spark, tmp_dir, landed):
    processed = process_events(read_envelope_files(spark, landed[0]), as_of=AS_OF)
    for _ in range(2):
        handle_batch(processed, 0, [files_sink("out", f"{tmp_dir}/out")], None, "r", metrics_path=f"{tmp_dir}/m")
    assert spark.read.parquet(f"{tmp_dir}/m").agg(F.sum("events")).first()[0] == spark.read.parquet(landed[0]).count()


def test_transform_sees_accepted_rows_only(spark, tmp_dir, landed):
    def upper(df):
        assert "reject_reason" in df.columns
        return df.withColumn("event_type", F.upper("event_type"))

    processed = process_events(read_envelope_files(spark, landed[0]), as_of=AS_OF)
    handle_batch(processed, 0, [files_sink("out", f"{tmp_dir}/out")], None, "r", quarantine=files_sink("q", f"{tmp_dir}/q"), transform=upper)
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.filter("event_type <> upper(event_type)").count() == 0 and out.count() == len(landed[1])
    assert out.count() + spark.read.parquet(f"{tmp_dir}/q").count() == spark.read.parquet(landed[0]).count()


def test_late_rows_are_kept_apart(spark, tmp_dir):
    """Ten ids over two runs: all arrive once, those behind the watermark as late; copies in a batch and over runs go."""
    src, out, checkpoint = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    schema = "event_id string, timestamp timestamp, partition int, offset long, note string"
    row = "SELECT '{}' AS event_id, TIMESTAMP'2024-01-0{} 12:00:00' AS timestamp, 0 AS partition, {}L AS offset, cast(null AS string) AS note"
    runs = ([(f"a{k}", 5, 10 - k) for k in range(5)] + [("a0", 5, 1), ("a1", 4, 99)],
            [("b0", 6, 20), ("b1", 5, 21), ("b2", 1, 22), ("b2", 1, 3), ("b3", 2, 23), ("b4", 4, 24), ("a2", 1, 25), ("a3", 5, 26)])
    for rows in runs:
        spark.sql(" UNION ALL ".join(row.format(*r) for r in rows)).coalesce(1).write.mode("append").parquet(src)
        with batches_of_data_only(spark):
            q = (dedup_keeping_late(spark.readStream.schema(schema).parquet(src), "1 hour").writeStream.format("parquet")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))
        q.awaitTermination(120)
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"
    delivered, late = split_late(spark.read.parquet(out))
    assert delivered.columns == schema.replace(",", "").split()[::2]
    assert {(r.event_id, r.offset) for r in delivered.collect()} == {("a0", 1), ("a1", 9), ("a2", 8), ("a3", 7), ("a4", 6), ("b0", 20), ("b1", 21)}
    assert {(r.event_id, r.offset) for r in late.collect()} == {("b2", 3), ("b3", 23), ("b4", 24)}
    assert [str(r[0]) for r in late.select("missed_watermark").distinct().collect()] == ["2024-01-05 11:00:00"]


def test_late_dedup_holds_its_keys_in_buckets(spark, tmp_dir):
    """State rows are bounded by the buckets, however many keys; chunks, null keys, copies in a batch and over runs, the time keys are kept."""
    src, out, checkpoint, chunk = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", "spark.sql.execution.arrow.maxRecordsPerBatch"

    def run(keys, keep_seconds=86_400, buckets=4):
        rows = spark.sql(f"SELECT CASE WHEN id >= 0 THEN id END AS event_id, TIMESTAMP'2024-01-05 12:00:00' AS timestamp, 0 AS partition, n AS offset "
                         f"FROM (SELECT explode(sequence({keys[0]}, {keys[1]})) AS id) CROSS JOIN (SELECT explode(array(2L, 1L, 3L)) AS n)")
        rows.coalesce(1).write.mode("append").parquet(src)
        with batches_of_data_only(spark):
            q = (dedup_keeping_late(spark.readStream.schema(rows.schema).parquet(src), "1 hour", keep_seconds=keep_seconds, buckets=buckets)
                 .writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))
        q.awaitTermination(120)
        assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= buckets
        return spark.read.parquet(out)

    before = spark.conf.get(chunk)
    spark.conf.set(chunk, "7")
    try:
        first = run((-1, 59))
        assert first.count() == first.select("event_id").distinct().count() == 61 and first.filter("offset <> 1").count() == 0
        assert first.filter("arrival <> 'delivered'").count() == 0
        assert run((-1, 79)).count() == 81
        assert run((0, 9)).count() == 81
        assert run((0, 9), keep_seconds=1).count() == 91          # the last batch began more than a second before: all keys are out of time
        with pytest.raises(Exception, match="buckets"):
            run((0, 99), buckets=5)
    finally:
        spark.conf.set(chunk, before)
