"""Fan-out, isolation, ledger, empty batches, replay safety (K4–K9, T4)."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, envelopes, record
from quayside.operators.conform import conform
from quayside.operators.dedup import drop_existing
from quayside.plans.ingest import accepted_conformed, process_events
from quayside.schema import add_field, ensure_table, event_schema, evolve_table, field, remove_field, table_version
from quayside.sinks.deliver import deliver, failed_deliveries, read_ledger, redeliver
from quayside.sinks.writers import Sink, files_sink, landing_sink, sinks_from_settings, table_sink
from quayside.streaming.stream import handle_batch


def _batch(spark, n=20, dup=3):
    vals = [record(event_id=f"e{i}") for i in range(n)] + [record(event_id="e0")] * dup
    return accepted_conformed(process_events(envelopes(spark, vals), as_of=AS_OF), keep=("partition", "offset"))


def _broken(name="broken"):
    def write(df, batch_id):
        raise RuntimeError("down")
    return Sink(name, write)


def test_isolation_and_ledger(spark, tmp_dir):
    a, b = files_sink("a", f"{tmp_dir}/a"), files_sink("b", f"{tmp_dir}/b")
    ledger = f"{tmp_dir}/ledger"
    rows = {r.sink: r for r in deliver(_batch(spark), 0, [a, _broken(), b], ledger, "r", dedup=True).collect()}
    assert rows["a"].status == "ok" and rows["a"].rows == 20 and rows["a"].duplicates == 3
    assert rows["broken"].status == "failed" and "down" in rows["broken"].error
    assert rows["b"].status == "ok"
    assert spark.read.parquet(f"{tmp_dir}/b").count() == 20
    assert "partition" not in spark.read.parquet(f"{tmp_dir}/b").columns
    assert [tuple(r) for r in failed_deliveries(spark, ledger).collect()] == [("r", "broken", 0, True)]


def test_fail_policy_raises(spark, tmp_dir):
    with pytest.raises(RuntimeError):
        deliver(_batch(spark), 0, [_broken()], f"{tmp_dir}/ledger", "r", on_error="fail")
    assert read_ledger(spark, f"{tmp_dir}/ledger").first().status == "failed"


def test_replay_is_skipped_or_deduplicated(spark, tmp_dir):
    sink, ledger = files_sink("s", f"{tmp_dir}/s"), f"{tmp_dir}/ledger"
    batch = _batch(spark)
    deliver(batch, 5, [sink], ledger, "r", dedup=True)
    again = deliver(batch, 5, [sink], ledger, "r", dedup=True).first()
    assert again.status == "replay_skipped"
    no_ledger = deliver(batch, 5, [sink], None, dedup=True).first()   # crash before ledger write
    assert no_ledger.rows == 0
    assert spark.read.parquet(f"{tmp_dir}/s").count() == 20


def test_empty_batch_writes_nothing(spark, tmp_dir):
    allbad = accepted_conformed(process_events(envelopes(spark, ["not json", record(source="")]), as_of=AS_OF))
    out = deliver(allbad, 1, [files_sink("s", f"{tmp_dir}/s")], f"{tmp_dir}/ledger", "r").first()
    assert out.status == "empty"
    import os
    assert not os.path.exists(f"{tmp_dir}/s")


def test_sink_selection():
    with pytest.raises(ValueError):
        sinks_from_settings({})
    sinks = sinks_from_settings({"iceberg_database": "db", "iceberg_table": "t", "postgres_host": "h",
                                 "postgres_port": 5432, "postgres_database": "d", "postgres_table": "t",
                                 "clickhouse_host": "h", "clickhouse_port": 8123, "clickhouse_database": ""})
    assert [s.name for s in sinks] == ["postgres", "iceberg"]


def test_no_sinks_is_an_error(spark):
    with pytest.raises(ValueError):
        deliver(_batch(spark), 0, [])


def test_redeliver_failed_sink_from_landing(spark, tmp_dir):
    ledger, landing = f"{tmp_dir}/ledger", f"{tmp_dir}/landing"
    batch = _batch(spark)
    deliver(batch, 3, [landing_sink("landing", landing), _broken("a")], ledger, "r", dedup=True)
    assert [tuple(r) for r in failed_deliveries(spark, ledger).collect()] == [("r", "a", 3, True)]
    fixed = files_sink("a", f"{tmp_dir}/a")
    rows = redeliver(spark, ledger, landing, [fixed], "r").collect()
    assert [(r.sink, r.batch_id, r.status, r.rows) for r in rows] == [("a", 3, "ok", 20)]
    assert failed_deliveries(spark, ledger).count() == 0
    assert redeliver(spark, ledger, landing, [fixed], "r") is None          # nothing left to do
    assert spark.read.parquet(f"{tmp_dir}/a").count() == 20


def test_ledger_is_keyed_by_run(spark, tmp_dir):
    sink, ledger = files_sink("s", f"{tmp_dir}/s"), f"{tmp_dir}/ledger"
    deliver(_batch(spark, dup=0), 0, [sink], ledger, "one")
    assert deliver(_batch(spark, dup=0), 0, [sink], ledger, "two/with slash").first().status == "ok"
    assert spark.read.parquet(f"{tmp_dir}/s").count() == 40
    with pytest.raises(ValueError):
        deliver(_batch(spark), 0, [sink], ledger)


def test_fail_policy_keeps_what_was_delivered(spark, tmp_dir):
    """The sinks before the failing one are in the ledger, so the retry does not write them again."""
    processed = process_events(envelopes(spark, [record(event_id=f"e{i}") for i in range(10)] + ["bad"]), as_of=AS_OF)
    good, ledger = files_sink("good", f"{tmp_dir}/good"), f"{tmp_dir}/ledger"
    for q in (_broken("q"), files_sink("q", f"{tmp_dir}/q")):
        try:
            handle_batch(processed, 0, [good], ledger, "r", quarantine=q, on_error="fail")
        except RuntimeError:
            assert q.name == "q"
    assert spark.read.parquet(f"{tmp_dir}/good").count() == 10
    assert spark.read.parquet(f"{tmp_dir}/q").count() == 1
    attempts = {(r.sink, r.status): r.attempt for r in read_ledger(spark, ledger).collect()}
    assert attempts[("q", "failed")] == 1 and attempts[("q", "ok")] == 2


def test_default_quarantine_sink_takes_rejected_rows(spark, tmp_dir):
    processed = process_events(envelopes(spark, [record(), "bad", record(source="")]), as_of=AS_OF)
    handle_batch(processed, 0, [files_sink("s", f"{tmp_dir}/s")], f"{tmp_dir}/l", "r", quarantine=files_sink("q", f"{tmp_dir}/q"))
    rows = spark.read.parquet(f"{tmp_dir}/q").collect()
    assert sorted(r.reject_reason for r in rows) == ["empty_source", "malformed_value"] and all(r.raw_value for r in rows)
    with pytest.raises(ValueError):
        files_sink("q", f"{tmp_dir}/q2", partition_by=("nope",)).check(processed.columns)


def test_failing_read_back_is_isolated(spark, tmp_dir):
    def existing(spark, dates=None):
        raise RuntimeError("refused")
    bad = Sink("bad", lambda df, i: None, existing)
    rows = {r.sink: r.status for r in deliver(_batch(spark), 0, [bad, files_sink("s", f"{tmp_dir}/s")], dedup=True).collect()}
    assert rows == {"bad": "failed", "s": "ok"}


def test_only_a_missing_path_reads_as_empty(spark, tmp_dir):
    assert files_sink("s", f"{tmp_dir}/none").existing(spark) is None
    assert files_sink("s", f"{tmp_dir}/none").existing(spark, [dt.date(2024, 1, 1)]) is None
    assert read_ledger(spark, f"{tmp_dir}/none") is None
    with pytest.raises(Exception):
        files_sink("s", "nosuchscheme://x/y").existing(spark)
    with pytest.raises(Exception):
        read_ledger(spark, "nosuchscheme://x/y")


def test_redelivery_keeps_the_mode_and_goes_on(spark, tmp_dir):
    ledger, landing = f"{tmp_dir}/ledger", f"{tmp_dir}/landing"
    land = landing_sink("landing", landing)
    deliver(_batch(spark), 1, [_broken("a")], ledger, "r")                       # no landing copy
    deliver(_batch(spark), 2, [land, _broken("a")], ledger, "r")                 # plain: 23 rows
    assert {"partition", "offset"} <= set(spark.read.parquet(f"{landing}/batch_id=2").columns)
    rows = redeliver(spark, ledger, landing, [files_sink("a", f"{tmp_dir}/a")], "r").collect()
    assert {(r.batch_id, r.status, r.rows) for r in rows} == {(1, "failed", 0), (2, "ok", 23)}
    assert spark.read.parquet(f"{tmp_dir}/a").count() == 23


def test_replay_computes_nothing(spark, tmp_dir):
    sink, ledger = files_sink("s", f"{tmp_dir}/s"), f"{tmp_dir}/ledger"
    deliver(_batch(spark), 0, [sink], ledger, "r", dedup=True)
    poison = _batch(spark).withColumn("event_type", F.raise_error(F.lit("computed")).cast("string"))
    assert deliver(poison, 0, [sink], ledger, "r", dedup=True).first().status == "replay_skipped"


def test_one_row_per_key_over_all_dates(spark, tmp_dir):
    sink = files_sink("s", f"{tmp_dir}/s")
    day = [record(event_id="a", timestamp="2024-01-01T00:00:00"), record(event_id="b")]
    again = [record(event_id="a", timestamp="2024-01-02T00:00:00"), record(event_id="c")]
    for n, values in enumerate((day, again)):
        rows = accepted_conformed(process_events(envelopes(spark, values), as_of=AS_OF), keep=("partition", "offset", "event_date"))
        deliver(rows, n, [sink], dedup=True, key_scope="all")
    assert sorted(r.event_id for r in spark.read.parquet(f"{tmp_dir}/s").collect()) == ["a", "b", "c"]


def test_rows_of_other_schema_versions_fit_an_evolved_table(spark, tmp_dir):
    table = f"versions_{uuid.uuid4().hex[:8]}"
    v1 = event_schema()
    v2 = add_field(v1, field("region", "string"), version=2)
    ensure_table(spark, v1, table, location=f"{tmp_dir}/{table}")
    evolve_table(spark, table, v1, v2)
    rows = _batch(spark, n=3, dup=0).withColumn("region", F.lit("eu"))
    for n, schema in enumerate((v1, v2, remove_field(v2, "metadata", version=3))):
        table_sink("t", table).write(conform(rows, schema.struct), n)
    got = spark.table(table).groupBy("region", F.col("metadata").isNull().alias("none")).count().collect()
    assert {(r.region, r.none): r["count"] for r in got} == {(None, False): 3, ("eu", False): 3, ("eu", True): 3}


def test_evolution_can_be_repeated_after_a_crash(spark, tmp_dir):
    table = f"crash_{uuid.uuid4().hex[:8]}"
    v1 = event_schema()
    v2 = add_field(v1, field("region", "string"), version=2)
    ensure_table(spark, v1, table, location=f"{tmp_dir}/{table}")
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (region STRING)")     # crashed before the version was set
    assert evolve_table(spark, table, v1, v2) is True
    assert table_version(spark, table) == 2 and spark.table(table).columns.count("region") == 1
    assert evolve_table(spark, table, v1, v2) is False


def test_table_read_back_prunes_by_date(spark, tmp_dir):
    table = f"prune_{uuid.uuid4().hex[:8]}"
    ensure_table(spark, event_schema(), table, location=f"{tmp_dir}/{table}")
    plan = table_sink("t", table).existing(spark, [dt.date(2024, 1, 20)])._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-20" in plan.split("PartitionFilters: [")[1].split("]")[0]
    scan = drop_existing(_batch(spark).withColumn("event_date", F.to_date("timestamp")), spark.table(table), dates=[dt.date(2024, 1, 20)])
    filters = [x.split("]")[0] for x in scan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1:]]
    assert any("2024-01-20" in x for x in filters)
