"""The ingestion plan: decode → coerce → classify → enrich; transform and conform the accepted rows.

``process_events`` returns accepted and rejected rows in one DataFrame
(``reject_reason`` NULL = accepted) so one pass yields both outputs.  It is
one lazy, shuffle-free plan that works the same on batch and streaming
DataFrames; ``current_timestamp()`` (when no ``as_of`` is given) is fixed
per query / micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.conform import conform
from quayside.operators.decode import decode_events
from quayside.operators.enrich import PROCESSING_VERSION, apply_transform, enrich_events
from quayside.operators.validate import classify_events, coerce_events
from quayside.schema import VersionedSchema, event_schema


def process_events(envelopes: DataFrame, fmt: str = "json", schemas: dict | None = None, as_of=None,
                   version: str = PROCESSING_VERSION, digits_as_epoch: bool = False) -> DataFrame:
    """Every envelope row once, with ``reject_reason`` and enriched
    metadata.  ``raw_value`` is kept for rejected rows only."""
    decoded = decode_events(envelopes, fmt=fmt, schemas=schemas)
    classified = classify_events(coerce_events(decoded, as_of=as_of, digits_as_epoch=digits_as_epoch))
    return enrich_events(classified, version=version).withColumn(
        "raw_value", F.expr("CASE WHEN reject_reason IS NOT NULL THEN raw_value END"))


def accepted_rows(processed: DataFrame, transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The accepted rows after the user's transform, which never sees a rejected row."""
    return apply_transform(processed.filter(F.col("reject_reason").isNull()), transform)


def accepted_conformed(processed: DataFrame, schema: VersionedSchema | None = None, keep: tuple[str, ...] = (),
                       transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Accepted rows in the declared schema (the sink shape)."""
    schema = schema or event_schema()
    return conform(accepted_rows(processed, transform), schema.struct, keep=keep)


def event_date(col: str = "timestamp"):
    """UTC calendar date of the event time: the partition key of file sinks."""
    return F.to_date(F.col(col))
