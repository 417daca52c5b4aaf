"""Plan shape: no Python evaluation, no shuffle in the per-event plan,
bounded plan size, one shuffle for keep-first dedup."""

from helpers import AS_OF
from quayside.operators.dedup import keep_first
from quayside.plans.ingest import accepted_conformed, process_events
from quayside.sources.envelope import envelope_from_events

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _accepted(spark):
    env = envelope_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    return accepted_conformed(process_events(env, as_of=AS_OF), keep=("partition", "offset"))


def test_no_python_and_no_shuffle(spark):
    plan = _plan(_accepted(spark))
    assert "EvalPython" not in plan and "PythonUDF" not in plan
    assert "Exchange" not in plan


def test_plan_stays_small(spark):
    # filters on classification results must not re-expand the parse chain
    plan = _plan(_accepted(spark))
    assert len(plan) < 60_000
    assert plan.count("from_json") <= 2


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(_accepted(spark))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "value" not in scan.split("ReadSchema")[1] and "ts:" in scan
    assert "struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in scan


def test_keep_first_is_one_aggregation_shuffle(spark):
    plan = _plan(keep_first(_accepted(spark)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Window" not in plan


def test_keep_first_with_a_hot_key(spark):
    """A third of the rows share one key: result is exact and the plan
    aggregates partially before the exchange (no single-task group)."""
    from pyspark.sql import functions as F
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("event_id"),
        (F.col("id") % 7).cast("int").alias("partition"), F.col("id").alias("offset"),
        F.col("id").cast("string").alias("payload")).repartition(8)
    out = keep_first(df, copies_col="copies")
    rows = {r.event_id: r for r in out.filter("event_id = 'hot' OR event_id = '1'").collect()}
    assert rows["hot"].copies == n // 3 and rows["hot"].partition == 0 and rows["hot"].offset == 0
    assert rows["1"].copies == 1
    assert out.count() == n - n // 3 + 1
    plan = _plan(out)
    assert "partial_min" in plan


def test_replay_check_prunes_target_partitions(spark, tmp_dir):
    """Against-sink dedup reads only the batch's date partitions of the
    target and only the key column."""
    import datetime as dt

    from pyspark.sql import functions as F
    from quayside.operators.dedup import drop_existing
    from quayside.sinks.writers import files_sink
    acc = _accepted(spark).withColumn("event_date", F.to_date("timestamp"))
    files_sink("t", f"{tmp_dir}/t").write(acc.drop("partition", "offset"), 0)
    batch = acc.filter(F.col("event_date") == F.lit("2024-01-20").cast("date"))
    out = drop_existing(batch, spark.read.parquet(f"{tmp_dir}/t"), dates=[dt.date(2024, 1, 20)])
    assert out.count() == 0
    plan = _plan(out)
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "PartitionFilters: [" in line
             and "event_date" in line.split("PartitionFilters: [")[1].split("]")[0]]
    assert scans and all("2024-01-20" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)
    assert any("ReadSchema: struct<event_id:string>" in s for s in scans)


def test_registered_reads_add_no_shuffle(spark):
    from quayside.plans import registry
    for name in ("envelope_parse", "accepted_events", "rejected_events", "user_transform"):
        plan = _plan(registry.QUERIES[name](spark, SF))
        assert "Exchange" not in plan, name


def test_time_alone_pays_for_no_json_check(spark):
    from quayside.plans import registry
    from quayside.functions.json import NUMBER
    for name, checks in (("timestamp_coerce", False), ("future_filter", False), ("payload_json_check", True)):
        plan = _plan(registry.QUERIES[name](spark, SF))
        assert ("parse_json" in plan or NUMBER in plan) == checks, name
        assert ("_strptime_groups" in plan) != checks, name


def test_export_of_what_variant_refuses(spark):
    import json
    from quayside.operators.conform import export_json
    rows = [("a", "t", "s", '{"k":1,"k": 2}', None), ("b", "t", None, '{"k": NaN}', '{"m":[1, 2]}'), ("c", "t", "s", None, '{"x":{"y":1,"y":3}}')]
    df = spark.createDataFrame(rows, "event_id string, event_type string, source string, payload string, metadata string").selectExpr(
        "*", "TIMESTAMP'2024-01-01 00:00:00' AS timestamp")
    got = {r.event_id: r.event_json for r in export_json(df).collect()}
    assert json.loads(got["a"]) == {"event_id": "a", "event_type": "t", "timestamp": "2024-01-01T00:00:00", "payload": {"k": 2}, "source": "s", "metadata": {}}
    assert list(json.loads(got["b"])) == ["event_id", "event_type", "timestamp", "payload", "metadata"] and '"payload":{"k":NaN}' in got["b"]
    assert json.loads(got["c"])["metadata"] == {"x": {"y": 3}}


def test_enrichment_of_what_variant_refuses(spark):
    import json
    from helpers import envelopes
    texts = ['{"event_id":"%d","event_type":"t","payload":{"a":1},"source":"s","metadata":"%s"}' % (i, m.replace('"', '\\"'))
             for i, m in enumerate(('{"k":1,"k":2}', '{"processed_at":"old","k":NaN}', '{"processed_at":"old","k":{"z":1,"z":2}}'))]
    rows = {r.event_id: r.metadata for r in accepted_conformed(process_events(envelopes(spark, texts), as_of=AS_OF)).collect()}
    new = {"processed_at": "2024-01-25T00:00:00", "processing_version": "1.0"}
    assert json.loads(rows["0"]) == {"k": 2, **new} and json.loads(rows["2"]) == {"k": {"z": 2}, **new}
    kept = json.loads(rows["1"])
    assert kept.pop("k") != kept and kept == new


def test_transform_reads_its_input_once(spark):
    from quayside.plans import registry
    assert _plan(registry.QUERIES["user_transform"](spark, SF)).count("FileScan parquet") == 1


def test_accepted_rows_carry_no_raw_value(spark):
    env = envelope_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    p = process_events(env, as_of=AS_OF)
    assert p.filter("reject_reason IS NULL AND raw_value IS NOT NULL").count() == 0
    assert p.filter("reject_reason IS NOT NULL AND raw_value IS NULL").count() == 0


def test_small_event_files_are_decoded_on_all_cores(spark):
    from quayside.plans.registry import _envelopes

    envelopes = _envelopes(spark, "/root/testdata/sf0.001")
    assert envelopes.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert envelopes.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
