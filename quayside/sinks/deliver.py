"""Multi-sink delivery of one batch with isolation and a ledger (K4–K9, T4).

``deliver`` writes one batch to every sink in order.  The batch is persisted
once when more than one output reads it; an empty batch writes nothing.
Each sink's outcome becomes a ledger row as soon as it is known.  The ledger
is keyed by ``(run_id, sink, batch_id)``: ``run_id`` names the query whose
batch ids these are (a streaming query's id, or a name the caller gives a
batch job), so a new query that counts its batches from 0 again is never
taken for a replay of another.  A sink that has the batch is skipped, and a
batch that all sinks have is not even computed.

A file sink takes a batch of a run as one atomic commit (``sinks.commit``), so a crash between the
sink write and the ledger write does not double a batch, with or without ``dedup``.

With ``dedup=True`` the batch keeps one row per ``event_id`` and, for sinks
that can be read back, rows the sink already holds are dropped, so a replay
after a crash between the sink write and the ledger write does not
duplicate rows either.  ``key_scope="date"`` looks for a key among the
rows of its event date only (partitions of other dates are not read);
``key_scope="all"`` looks in the sink's key index (``sinks.keyindex``; without
one, in the keys of the whole sink), so an ``event_id`` stays unique even if it comes back with
another event time.

The ledger is a commit log per run and 1,000 batches: a look-up opens a bounded number of small
files and starts no Spark job.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

from quayside.operators.dedup import drop_existing, keep_first
from quayside.session import path_exists
from quayside.sinks.commit import log_folder
from quayside.sinks.commitlog import CommitLog, HadoopFolder
from quayside.sinks.writers import Sink, with_event_date

LEDGER_SCHEMA = StructType([
    StructField("run_id", StringType(), False),
    StructField("sink", StringType(), False),
    StructField("batch_id", LongType(), False),
    StructField("status", StringType(), False),   # ok | failed | empty | replay_skipped
    StructField("rows", LongType()),
    StructField("duplicates", LongType()),
    StructField("error", StringType()),
    StructField("dedup", BooleanType()),
    StructField("delivered_at", TimestampType()),
    StructField("attempt", IntegerType()),
])
ON_ERROR = ("isolate", "fail")
KEY_SCOPES = ("date", "all")


def _ledger_log(spark: SparkSession, ledger_path: str, run_id: str, batch_id: int) -> CommitLog:
    return CommitLog(HadoopFolder(spark, log_folder(ledger_path, run_id, batch_id)))


def read_ledger(spark: SparkSession, ledger_path: str | None) -> DataFrame | None:
    """All ledger rows; None when nothing was written yet.  Any other error is raised."""
    if not ledger_path or not path_exists(spark, ledger_path):
        return None
    # an entry that was summed up and is not removed yet stands in two files
    rows = spark.read.schema(StructType([*LEDGER_SCHEMA.fields, StructField("entry", StringType())])).json(f"{ledger_path}/*/*")
    return rows.dropDuplicates(["entry"]).select(*LEDGER_SCHEMA.fieldNames())


def _history(spark: SparkSession, ledger_path: str | None, run_id: str | None, batch_id: int) -> dict[str, tuple[bool, int]]:
    """sink → (has the batch, attempts so far), from the one log that can hold this batch."""
    if not ledger_path:
        return {}
    out: dict[str, tuple[bool, int]] = {}
    for r in _ledger_log(spark, ledger_path, run_id, batch_id).records():
        if r["batch_id"] == batch_id:
            done, attempts = out.get(r["sink"], (False, 0))
            out[r["sink"]] = (done or r["status"] in ("ok", "empty"), attempts + (r["status"] != "replay_skipped"))
    return out


def delivered(spark: SparkSession, ledger_path: str | None, run_id: str | None, batch_id: int) -> set[str]:
    """Sinks that have this batch of this run."""
    return {s for s, (done, _) in _history(spark, ledger_path, run_id, batch_id).items() if done}


def deliver(df: DataFrame, batch_id: int, sinks: list[Sink], ledger_path: str | None = None,
            run_id: str | None = None, on_error: str = "isolate", dedup: bool = False,
            key_scope: str = "date", drop_cols: tuple[str, ...] = ("partition", "offset"),
            persist: bool = True) -> DataFrame:
    """Write one batch to every sink; return this call's ledger rows.

    ``run_id`` is required with a ledger.  ``drop_cols`` (source positions
    used to order the dedup) are removed before the sinks see the rows,
    unless a sink keeps positions.  ``persist=False`` when the caller has
    already persisted the rows this batch is a cheap projection of (the
    de-duplicated batch is always persisted: it is a shuffle result).
    ``on_error="fail"`` raises at the first failing sink; the rows of the
    sinks before it are in the ledger by then."""
    if not sinks:
        raise ValueError("deliver needs at least one sink")
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    if key_scope not in KEY_SCOPES:
        raise ValueError(f"key_scope must be one of {KEY_SCOPES}")
    if ledger_path and not run_id:
        raise ValueError("a ledger needs a run_id: batch ids are only unique within one query")
    for s in sinks:
        s.check(df.columns)
    spark = df.sparkSession
    history = _history(spark, ledger_path, run_id, batch_id)
    records: list[tuple] = []

    def record(sink: Sink, status: str, rows: int = 0, duplicates: int = 0, error: str | None = None) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        row = (run_id or "", sink.name, batch_id, status, rows, duplicates, error, dedup, now,
               history.get(sink.name, (False, 0))[1] + (status != "replay_skipped"))
        records.append(row)
        if ledger_path:
            _ledger_log(spark, ledger_path, run_id, batch_id).append(
                [dict(zip(LEDGER_SCHEMA.fieldNames(), row), delivered_at=now.isoformat() + "Z", entry=uuid.uuid4().hex)])

    todo = [s for s in sinks if not history.get(s.name, (False, 0))[0]]
    if not todo:                      # a replay: nothing is computed
        for s in sinks:
            record(s, "replay_skipped")
        return spark.createDataFrame(records, LEDGER_SCHEMA)
    batch = keep_first(df, copies_col="_copies") if dedup else df
    cached = batch.persist(StorageLevel.MEMORY_AND_DISK) if (persist or dedup) else None
    try:
        # one pass over the persisted batch for both the empty check and the metrics
        stats = batch.agg(F.count(F.lit(1)).alias("n"),
                          (F.sum(F.col("_copies") - 1) if dedup else F.sum(F.lit(0))).alias("dups")).first()
        n, duplicates = int(stats["n"]), int(stats["dups"] or 0)
        if dedup:
            batch = batch.drop("_copies")
        dates = None
        if n and dedup and key_scope == "date" and any(s.existing is not None for s in todo):
            batch = with_event_date(batch)
            # partition keys only: at most one row per calendar day
            dates = sorted(r[0] for r in batch.select("event_date").distinct().collect())
        for sink in sinks:
            if sink not in todo:
                record(sink, "replay_skipped")
            elif n == 0:
                record(sink, "empty")
            else:
                try:
                    rows = _write(spark, batch, run_id, batch_id, sink, dates, dedup, key_scope, drop_cols)
                except Exception as e:  # K5: one failing sink does not stop the others
                    record(sink, "failed", error=f"{type(e).__name__}: {e}")
                    if on_error == "fail":
                        raise
                else:
                    record(sink, "ok", rows, duplicates)
    finally:
        if cached is not None:
            cached.unpersist()
    return spark.createDataFrame(records, LEDGER_SCHEMA)


def _write(spark: SparkSession, batch: DataFrame, run_id: str | None, batch_id: int, sink: Sink, dates: list | None, dedup: bool,
           key_scope: str, drop_cols: tuple[str, ...]) -> int:
    """Rows written to one sink."""
    out = batch
    indexed = dedup and key_scope == "all" and sink.keys is not None
    if indexed:
        if sink.keys.generation(spark) is None:
            sink.keys.rebuild(spark, sink.existing(spark, None))
        out = sink.keys.drop_held(batch)
    elif dedup and sink.existing is not None:
        target = sink.existing(spark, dates)
        if target is not None:
            out = drop_existing(batch, target, date_col="event_date" if key_scope == "date" else None, dates=dates)
    if not sink.keeps_positions:
        out = out.drop(*drop_cols)
    if not sink.wants_event_date:
        out = out.drop("event_date")
    if run_id and sink.commit is not None:
        rows, _ = sink.commit(out, run_id, batch_id)
    else:
        obs = Observation(f"rows_{sink.name}_{batch_id}")
        sink.write(out.observe(obs, F.count(F.lit(1)).alias("rows")), batch_id)
        rows = int(obs.get["rows"])
    if sink.keys is not None and sink.keys.generation(spark) is not None:
        # after the commit, and again on a replay: a crash between the two must not leave keys out (those of the whole batch are in the sink now)
        sink.keys.add(batch)
    return rows


def failed_deliveries(spark: SparkSession, ledger_path: str) -> DataFrame:
    """(run_id, sink, batch_id, dedup) that were tried and never succeeded: the re-delivery list."""
    ledger = read_ledger(spark, ledger_path)
    if ledger is None:
        return spark.createDataFrame([], "run_id string, sink string, batch_id long, dedup boolean")
    key = ["run_id", "sink", "batch_id"]
    ok = ledger.filter(F.col("status").isin("ok", "empty")).select(*key)
    return (ledger.filter(F.col("status") == "failed").groupBy(*key).agg(F.max("dedup").alias("dedup"))
            .join(ok, key, "left_anti").select(*key, "dedup"))


def redeliver(spark: SparkSession, ledger_path: str, landing_path: str, sinks: list[Sink], run_id: str,
              fmt: str = "parquet", key_scope: str = "date") -> DataFrame | None:
    """T4: deliver again every (sink, batch_id) of ``run_id`` that never
    succeeded, reading the batch back from its landing copy
    (``landing_sink``), in the mode (plain or de-duplicated) of the first
    try.  Replay-safe, so it can run any number of times; a batch whose
    landing copy cannot be read gets a ``failed`` row and the others go on.
    The failure list is ledger metadata (sinks × failed batches); each
    re-delivery is a distributed job."""
    by_name = {s.name: s for s in sinks}
    todo = [r for r in failed_deliveries(spark, ledger_path).filter(F.col("run_id") == run_id).collect()
            if r["sink"] in by_name]
    out = None
    for r in sorted(todo, key=lambda r: (r["batch_id"], r["sink"])):
        sink, batch_id = by_name[r["sink"]], r["batch_id"]
        try:
            batch = spark.read.format(fmt).load(f"{landing_path}/batch_id={batch_id}")
        except Exception as e:
            now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
            attempts = _history(spark, ledger_path, run_id, batch_id).get(sink.name, (False, 0))[1]
            row = (run_id, sink.name, batch_id, "failed", 0, 0, f"{type(e).__name__}: {e}", r["dedup"], now, attempts + 1)
            _ledger_log(spark, ledger_path, run_id, batch_id).append(
                [dict(zip(LEDGER_SCHEMA.fieldNames(), row), delivered_at=now.isoformat() + "Z", entry=uuid.uuid4().hex)])
            rows = spark.createDataFrame([row], LEDGER_SCHEMA)
        else:
            rows = deliver(batch, batch_id, [sink], ledger_path, run_id, dedup=r["dedup"], key_scope=key_scope)
        out = rows if out is None else out.unionByName(rows)
    return out
