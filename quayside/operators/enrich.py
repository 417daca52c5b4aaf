"""Metadata enrichment and the user transform hook."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import json as J
from quayside.functions.timestamps import python_isoformat_sql, sql_literal

PROCESSING_VERSION = "1.0"  # fixed value: the enrichment's processing_version


def enrich_events(classified: DataFrame, version: str = PROCESSING_VERSION) -> DataFrame:
    """Set ``processed_at`` (batch time, ISO text) and
    ``processing_version`` in the metadata object of accepted rows.

    Falsy metadata (missing, ``{}``, ``[]``, ``0``, ``null`` …) becomes an object
    holding only the two keys; existing keys and nested values are kept, and
    an existing ``processed_at`` is overwritten in place (``dict.update``).
    Rejected rows are left as they are.
    """
    values = {"processed_at": python_isoformat_sql("batch_ts"), "processing_version": sql_literal(version)}
    held = " OR ".join(f"array_contains(_keys, {sql_literal(k)})" for k in values)
    parsed = classified.selectExpr(
        "*",
        f"CASE WHEN reject_reason IS NULL THEN CASE WHEN metadata_truthy THEN {J.compact_sql('metadata')} "
        f"ELSE '{{}}' END END AS _object",
        "CASE WHEN reject_reason IS NULL AND metadata_truthy THEN json_object_keys(metadata) END AS _keys",
    # VARIANT takes no duplicate keys and no NaN: there the members are appended, and the last one of a name counts
    ).selectExpr("*", f"CASE WHEN ({held}) AND try_parse_json(_object) IS NOT NULL THEN {J.object_map_sql('_object')} END AS _metadata_map")
    # nearly all rows have neither key: the two members are appended to the text, which leaves
    # numbers of any length as they are; only where a key is overwritten is the object rebuilt
    merged = (f"CASE WHEN reject_reason IS NOT NULL THEN metadata "
              f"WHEN _metadata_map IS NOT NULL THEN {J.set_map_keys_sql('_metadata_map', values)} "
              f"ELSE {J.append_keys_sql('_object', values)} END")
    return parsed.withColumn("metadata", F.expr(merged)).drop("_object", "_keys", "_metadata_map")


def apply_transform(df: DataFrame, transform: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """A user ``DataFrame → DataFrame`` step (identity when None)."""
    return df if transform is None else df.transform(transform)
