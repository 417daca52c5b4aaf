"""Structured Streaming entry points.

The per-event work lives in the streaming plan itself (``process_events``),
so ``current_timestamp()`` is one value per micro-batch.  ``foreachBatch``
only persists the batch, splits accepted / rejected rows, and delivers them
(fan-out, isolation, ledger, optional dedup).  The same handler serves a
batch DataFrame, which is how batch and stream stay identical.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quayside.operators.validate import QUARANTINE_COLUMNS, outcome_counts, quarantine as quarantine_rows
from quayside.plans.ingest import accepted_conformed
from quayside.schema import VersionedSchema
from quayside.sinks.deliver import deliver, delivered
from quayside.sinks.writers import Sink

DEFAULT_TRIGGER = {"processingTime": "10 seconds"}


def handle_batch(processed: DataFrame, batch_id: int, sinks: list[Sink], ledger_path: str | None = None,
                 run_id: str | None = None, quarantine: Sink | None = None, schema: VersionedSchema | None = None,
                 dedup: bool = False, key_scope: str = "date", on_error: str = "isolate",
                 metrics_path: str | None = None, transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """One micro-batch (or one batch run): accepted rows, after the user's
    ``transform``, to every sink, rejected rows to the quarantine sink,
    per-outcome counts to ``metrics_path``.  The processed batch is computed
    once (persisted) for all outputs; a batch that every output has already
    is not computed at all.  Metrics of a batch replace those of an earlier
    try."""
    if metrics_path and not run_id:
        raise ValueError("metrics need a run_id: batch ids are only unique within one query")
    spark = processed.sparkSession
    outputs = [s.name for s in sinks] + ([quarantine.name] if quarantine is not None else [])
    if ledger_path and run_id and set(outputs) <= delivered(spark, ledger_path, run_id, batch_id):
        return
    b = processed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if metrics_path:
            (outcome_counts(b).coalesce(1).write.mode("overwrite")
             .parquet(f"{metrics_path}/run_id={run_id}/batch_id={batch_id}"))
        accepted = accepted_conformed(b, schema, keep=("partition", "offset", "event_date"), transform=transform)
        # b is persisted: the accepted / quarantine projections need no second cache
        deliver(accepted, batch_id, sinks, ledger_path, run_id, on_error=on_error, dedup=dedup, key_scope=key_scope,
                persist=False)
        if quarantine is not None:
            deliver(quarantine_rows(b), batch_id, [quarantine], ledger_path, run_id, on_error=on_error,
                    drop_cols=(), persist=False)
    finally:
        b.unpersist()


def start_stream(processed_stream: DataFrame, sinks: list[Sink], checkpoint: str, ledger_path: str | None = None,
                 quarantine: Sink | None = None, trigger: dict | None = None,
                 schema: VersionedSchema | None = None, dedup: bool = False, key_scope: str = "date",
                 on_error: str = "isolate", query_name: str | None = None, metrics_path: str | None = None,
                 transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Start the ``foreachBatch`` query and return it (the caller
    waits with ``awaitTermination`` / ``processAllAvailable``).

    ``checkpoint`` is the query's own folder on shared storage: started again
    with it, the query goes on where it stopped.  The id Spark keeps there is
    the ledger's ``run_id``.  ``trigger``: ``{"processingTime": "10 seconds"}``
    (default) or ``{"availableNow": True}`` for back-fills.  Sinks that cannot
    take the rows' columns are refused before the query starts.
    """
    if not sinks:
        raise ValueError("start_stream needs at least one sink")
    if not checkpoint:
        raise ValueError("start_stream needs a checkpoint folder, else a restart would begin anew")
    if quarantine is not None:
        quarantine.check(list(QUARANTINE_COLUMNS))

    def on_batch(batch_df: DataFrame, batch_id: int) -> None:
        run_id = batch_df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        handle_batch(batch_df, batch_id, sinks, ledger_path, run_id, quarantine, schema, dedup, key_scope, on_error,
                     metrics_path, transform)

    writer = processed_stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.trigger(**(trigger or DEFAULT_TRIGGER)).start()


def dedup_within_watermark(stream: DataFrame, delay: str = "1 hour", key: str = "event_id",
                           time_col: str = "timestamp") -> DataFrame:
    """T7 option: bounded cross-batch dedup when the target cannot be read
    back; state is kept per key until the watermark passes.

    Spark drops rows that come later than ``delay`` behind the newest event
    time, unique ones too.  Where no row may be lost use ``deliver(dedup=True)``
    instead, which compares with the sink."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])
