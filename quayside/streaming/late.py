"""Cross-batch de-duplication that keeps late rows.

``dropDuplicatesWithinWatermark`` drops every row behind the watermark, unique
ones too.  Here a key's first row is emitted whenever it comes: within the
watermark as ``delivered``, behind it as ``late``, with the watermark that it
missed.  Nothing unique is lost; the caller decides what becomes of late rows
(``split_late``).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, MapType, StringType, StructField, StructType, TimestampType

from quayside.operators.dedup import DEFAULT_ORDER

DELIVERED, LATE = "delivered", "late"
BUCKETS = 4096


def _key_text(stream: DataFrame, key: str) -> Column:
    """The key as a text of its own."""
    kind = stream.schema[key].dataType
    if isinstance(kind, StringType):
        return F.col(key)
    if isinstance(kind, BinaryType):
        return F.hex(key)
    if isinstance(kind, (StructType, ArrayType, MapType)):
        return F.to_json(F.struct(key), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return F.col(key).cast("string")


def dedup_keeping_late(stream: DataFrame, delay: str = "1 hour", key: str = "event_id", time_col: str = "timestamp",
                       order: tuple[str, ...] = DEFAULT_ORDER, keep_seconds: int = 86_400, buckets: int = BUCKETS) -> DataFrame:
    """One row per ``key`` over the batches of a stream, plus ``arrival`` (``delivered`` or ``late``) and ``missed_watermark``.

    The watermark trails the newest ``time_col`` by ``delay``; a row at or behind it is late.  Of a key's rows in one
    batch the one with the smallest ``order`` stays.  State is each key with the time of the batch that brought its last row; a
    copy that comes ``keep_seconds`` of processing time after that is emitted again, so these should exceed the time
    over which a source repeats itself.

    Keys are dealt by hash to ``buckets``, whose state is one value each, so a batch costs at most that many calls into Python,
    however many keys it has.  A call drops the keys that are out of time; a bucket without any row for ``keep_seconds`` is removed by
    its timer.  A bucket that gets a row is written whole: streams of small batches over very many keys want more buckets.
    Their number belongs to the checkpoint; another one is refused.

    Keys are compared null-safe: rows without a key are one key.  A batch's copies are
    reduced in the group, chunk by chunk, so a hot key needs the memory of one Arrow batch beside its bucket's first rows.  The
    rows pass through Python; where the sink can be read back, ``deliver(dedup=True)`` does without.
    """
    columns = list(stream.columns)
    order = tuple(c for c in order if c in columns)
    out = StructType([*stream.schema.fields, StructField("arrival", StringType()), StructField("missed_watermark", TimestampType())])
    keep_ms, late, delivered = keep_seconds * 1000, LATE, DELIVERED

    def firsts_of_bucket(_bucket, chunks: Iterator, state: GroupState) -> Iterator:
        import pandas as pd
        import pyarrow as pa
        import pyarrow.compute as pc

        if state.hasTimedOut:                       # no row for as long as any key is kept
            state.remove()
            return
        now, held = state.getCurrentProcessingTimeMs(), pa.table({"key": pa.array([], pa.string()), "seen": pa.array([], pa.int64())})
        if state.exists:
            n, packed = state.get
            if n != buckets:
                raise ValueError(f"the checkpoint has its keys in {n} buckets, not {buckets}")
            with pa.ipc.open_stream(packed) as reader:
                held = reader.read_all()
            held = held.filter(pc.greater(held["seen"], now - keep_ms))
        known, again, first = held["key"].combine_chunks(), [], None
        for rows in chunks:
            keys = pa.array(rows["_key"], pa.string(), from_pandas=True)
            new = pc.is_null(pc.index_in(keys, value_set=known)).to_numpy(zero_copy_only=False)
            again.append(keys.filter(pa.array(~new)).unique())
            rows = rows[new]
            if len(rows):
                rows = rows if first is None else pd.concat([first, rows], ignore_index=True)
                first = (rows.sort_values(list(order), kind="stable") if order else rows).drop_duplicates("_key")
        came = pa.concat_arrays(again).unique()
        kept = held.filter(pc.is_null(pc.index_in(held["key"], value_set=came)))
        if first is not None:
            came = pa.concat_arrays([came, pa.array(first["_key"], pa.string(), from_pandas=True)])
        held = pa.concat_tables([kept, pa.table({"key": came, "seen": pa.array([now] * len(came), pa.int64())})]).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held.schema) as writer:
            writer.write_table(held)
        state.update((buckets, sink.getvalue().to_pybytes()))
        state.setTimeoutDuration(keep_ms)
        if first is not None:
            mark = pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")
            behind = first[time_col] <= mark        # not where the time is null
            yield first[columns].assign(arrival=behind.map({True: late, False: delivered}),
                                        missed_watermark=pd.Series(mark, first.index).where(behind))

    keyed = stream.withColumn("_key", _key_text(stream, key)).withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int"))
    # processing-time timers: with event-time ones Spark would drop the late rows before the function sees them
    return (keyed.withWatermark(time_col, delay).groupBy("_bucket")
            .applyInPandasWithState(firsts_of_bucket, out, StructType([StructField("buckets", IntegerType()), StructField("held", BinaryType())]), "append",
                                    GroupStateTimeout.ProcessingTimeTimeout))


@contextmanager
def batches_of_data_only(spark: SparkSession) -> Iterator[None]:
    """Queries started inside run no batch without data.  A back-fill (``availableNow``) of ``dedup_keeping_late`` needs
    it to end: as long as timers are set, Spark would go on with empty batches.  Timers then run with the next data."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def split_late(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(delivered rows as they were, late rows with ``missed_watermark``) of a batch of ``dedup_keeping_late``."""
    return (batch.filter(F.col("arrival") == DELIVERED).drop("arrival", "missed_watermark"),
            batch.filter(F.col("arrival") == LATE).drop("arrival"))
