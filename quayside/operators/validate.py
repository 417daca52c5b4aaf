"""Parse, coerce and classify decoded events.

``coerce_events`` adds parsed-JSON facts and the event time;
``classify_events`` adds ``reject_reason`` (NULL = accepted).  Both are
narrow projections over built-in expressions, identical for batch and
streaming DataFrames.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import json as J
from quayside.functions.timestamps import event_time_columns, sql_literal

# Reject reasons, in the order the rules are applied (first match wins).
# fixed values: reject reason codes in rule order
REJECT_REASONS = (
    "malformed_value",        # value is not a JSON object / could not be decoded (P1, P3)
    "missing_event_id",       # decoded, but no event_id (P3)
    "payload_invalid_json",   # payload given but not one JSON document (P7)
    "metadata_invalid_json",  # metadata given but not one JSON document (P8)
    "empty_event_id",         # V1
    "empty_event_type",       # V2
    "empty_source",           # V3
    "future_timestamp",       # V4
    "empty_payload",          # V5
    "metadata_not_object",    # V8
)


def batch_time_sql(as_of=None) -> str:
    """SQL: the batch timestamp, a fixed instant or the query's current time.

    ``current_timestamp()`` is evaluated once per query / micro-batch, so all
    rows (and every sink of one ``foreachBatch``) see the same value.
    """
    if as_of is None:
        return "current_timestamp()"
    if isinstance(as_of, _dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        as_of = as_of.isoformat()
    return f"CAST({sql_literal(str(as_of))} AS TIMESTAMP)"


def batch_time(as_of=None) -> Column:
    return F.expr(batch_time_sql(as_of))


def coerce_times(events: DataFrame, as_of=None, digits_as_epoch: bool = False) -> DataFrame:
    """The event time.

    Adds ``timestamp_text``, ``timestamp_defaulted``, ``batch_ts`` and ``event_date``; replaces
    ``timestamp`` with the coerced instant (the batch time when the text is
    missing or unknown).

    ``event_date`` is the partition date of file sinks and the pruning key of
    replay dedup, so it must not change when a record is delivered again:
    the parsed event time's date, else the broker timestamp's date, else the
    batch date.
    """
    ts_type = events.schema["timestamp"].dataType
    time_helpers, event_time = event_time_columns("timestamp", ts_type, digits_as_epoch)
    parsed = events.selectExpr(
        "*",
        *[f"{sql} AS {name}" for name, sql in time_helpers.items()],
        f"{batch_time_sql(as_of)} AS batch_ts",
    ).selectExpr("*", f"{event_time} AS _event_time")
    # the broker time is the same on every replay of a record, the batch time is not
    stable = "kafka_timestamp, " if "kafka_timestamp" in events.columns else ""
    facts = {
        "timestamp": "coalesce(_event_time, batch_ts)",
        "timestamp_text": "CAST(`timestamp` AS STRING)",
        "timestamp_defaulted": "_event_time IS NULL",
        "event_date": f"to_date(coalesce(_event_time, {stable}batch_ts))",
    }
    kept = [c for c in events.columns if c != "timestamp"] + ["batch_ts"]
    return with_settled_columns(parsed.selectExpr(*[f"`{c}`" for c in [*kept, "timestamp", "_event_time"]]), facts, keep=kept)


def check_json(events: DataFrame) -> DataFrame:
    """Adds ``payload_valid``, ``payload_truthy``, ``metadata_valid``,
    ``metadata_truthy`` and ``metadata_is_object``."""
    # _payload_ok and _metadata_ok: NULL when not given
    parsed = events.selectExpr(
        "*",
        f"CASE WHEN {J.present_sql('payload')} THEN {J.valid_sql('payload')} END AS _payload_ok",
        f"CASE WHEN {J.present_sql('metadata')} THEN {J.valid_sql('metadata')} END AS _metadata_ok",
    )
    return with_settled_columns(parsed, {
        "payload_valid": "coalesce(_payload_ok, true)",
        "payload_truthy": f"coalesce(_payload_ok AND {J.truthy_sql('payload')}, false)",
        "metadata_valid": "coalesce(_metadata_ok, true)",
        "metadata_truthy": f"coalesce(_metadata_ok AND {J.truthy_sql('metadata')}, false)",
        "metadata_is_object": f"coalesce(_metadata_ok AND {J.object_sql('metadata')}, false)",
    }, keep=events.columns)


def coerce_events(events: DataFrame, as_of=None, digits_as_epoch: bool = False) -> DataFrame:
    """``coerce_times`` and ``check_json``, a fence each: who asks for the time
    only takes the first and does not pay for the JSON checks, nor the other way round."""
    return check_json(coerce_times(events, as_of, digits_as_epoch))


def with_settled_columns(df: DataFrame, exprs: dict[str, str], keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``exprs``, computed once per row.

    Catalyst pushes a filter through projections by substituting each column
    with its definition; for the parse chain here (JSON decode, VARIANT
    parses, time regexes) a later ``reject_reason IS NULL`` would re-run all
    of it inside the filter.  Emitting the results through a one-row
    ``inline`` (a Generate node) keeps them as real attributes: filters on
    them stay above it and the parse work runs exactly once per row.
    """
    fields = ", ".join(f"'{n}', {sql}" for n, sql in exprs.items())
    return df.selectExpr(*[f"`{k}`" for k in keep], f"inline(array(named_struct({fields})))")


def reject_reason_sql() -> str:
    """SQL: first failing rule, in REJECT_REASONS order; NULL when all pass."""
    value_is_object = f"coalesce(({J.valid_sql('raw_value')}) AND {J.object_sql('raw_value')}, false)"
    rules = [
        ("decode_error IS NOT NULL OR (event_id IS NULL AND NOT " + value_is_object + ")", "malformed_value"),
        ("event_id IS NULL", "missing_event_id"),
        ("NOT payload_valid", "payload_invalid_json"),
        ("NOT metadata_valid", "metadata_invalid_json"),
        ("coalesce(event_id, '') = ''", "empty_event_id"),
        ("coalesce(event_type, '') = ''", "empty_event_type"),
        ("coalesce(source, '') = ''", "empty_source"),
        ("`timestamp` > batch_ts", "future_timestamp"),
        ("NOT payload_truthy", "empty_payload"),
        ("metadata_truthy AND NOT metadata_is_object", "metadata_not_object"),
    ]
    assert [r for _, r in rules] == list(REJECT_REASONS)
    return "CASE " + " ".join(f"WHEN {cond} THEN '{reason}'" for cond, reason in rules) + " END"


def reject_reason() -> Column:
    return F.expr(reject_reason_sql())


def classify_events(coerced: DataFrame) -> DataFrame:
    """V1–V8 as one column: ``reject_reason`` (NULL = accepted)."""
    return coerced.selectExpr("*", f"{reject_reason_sql()} AS reject_reason")


def accepted(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reject_reason").isNull())


def rejected(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reject_reason").isNotNull())


QUARANTINE_COLUMNS = ("raw_value", "kafka_timestamp", "partition", "offset", "event_id", "reject_reason", "batch_ts",
                      "event_date")


def quarantine(classified: DataFrame) -> DataFrame:
    """V7: rejected rows with their raw value, source position, reason and the
    date that partitions them."""
    return rejected(classified).select(*QUARANTINE_COLUMNS)


def outcome_counts(classified: DataFrame) -> DataFrame:
    """K9: rows per outcome (``accepted`` or the reject reason), one small
    distributed aggregate (at most len(REJECT_REASONS) + 1 rows)."""
    return (classified.groupBy(F.coalesce(F.col("reject_reason"), F.lit("accepted")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("events")))
