"""Conform rows to a declared schema; export; empty results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, TimestampType

from quayside.functions import json as J
from quayside.functions.timestamps import python_isoformat
from quayside.schema import JSON_TYPES, declared_default_sql, logical_type


def _field_sql(df: DataFrame, field) -> str:
    name, dtype = field.name, field.dataType
    t = dtype.simpleString()
    if name in df.columns:
        src_type = df.schema[name].dataType
        if logical_type(field) in JSON_TYPES and not isinstance(src_type, StringType):
            return f"to_json(`{name}`)"
        if isinstance(dtype, TimestampType) and isinstance(src_type, StringType):
            return f"to_timestamp(`{name}`)"
        return f"CAST(`{name}` AS {t})"
    if name == "processed_at" and "batch_ts" in df.columns:
        return f"CAST(batch_ts AS {t})"
    default = declared_default_sql(field)
    return f"CAST({default if default is not None else 'NULL'} AS {t})"


def conform(df: DataFrame, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """One projection generated from the declared schema, in its order.

    A declared field is taken from the same-named column (cast to the declared
    type; JSON fields must be text, non-text is written with ``to_json``), else
    ``processed_at`` is the batch time, else the declared default, else a
    typed NULL.  ``keep`` appends extra columns (e.g. source positions).
    """
    cols = [f"{_field_sql(df, f)} AS `{f.name}`" for f in schema.fields]
    return df.selectExpr(*cols, *[f"`{k}`" for k in keep if k not in schema.fieldNames()])


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """A 0-row DataFrame with the declared schema."""
    return spark.createDataFrame([], schema)


def export_json_column() -> Column:
    """P11 as one column: the event as JSON text with an ISO timestamp,
    payload/metadata nested as JSON, missing metadata as ``{}``."""
    payload, metadata = "coalesce(payload, '{}')", "coalesce(metadata, '{}')"
    head = F.struct(F.col("event_id"), F.col("event_type"), python_isoformat("timestamp").alias("timestamp"))
    as_variants = F.to_json(F.struct(
        head["event_id"].alias("event_id"), head["event_type"].alias("event_type"), head["timestamp"].alias("timestamp"),
        F.expr(f"try_parse_json({payload})").alias("payload"), F.col("source"), F.expr(f"try_parse_json({metadata})").alias("metadata")))
    # VARIANT takes no duplicate keys and no NaN: such documents go into the text as they are written
    before, after = F.to_json(head), F.to_json(F.struct("source"))
    as_text = F.concat(
        F.regexp_replace(before, r"\}$", ""),
        F.lit(',"payload":'), F.expr(J.compact_sql(payload)), F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit(","), F.regexp_replace(after, r"^\{|\}$", ""))),
        F.lit(',"metadata":'), F.expr(J.compact_sql(metadata)), F.lit("}"))
    parses = F.expr(f"try_parse_json({payload}) IS NOT NULL AND try_parse_json({metadata}) IS NOT NULL")
    valid = F.expr(f"({J.valid_sql(payload)}) AND ({J.valid_sql(metadata)})")
    return F.when(parses, as_variants).when(valid, as_text).otherwise(F.raise_error(F.lit("payload or metadata is not a JSON document")).cast("string"))


def export_json(df: DataFrame) -> DataFrame:
    """``event_id`` and the exported ``event_json`` per row."""
    return df.select(F.col("event_id"), export_json_column().alias("event_json"))


def read_conformed(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                   keep: tuple[str, ...] = ("event_date",)) -> DataFrame:
    """Files written under older schema versions, read under ``schema``.

    ``mergeSchema`` unifies the file footers (added columns appear, old
    files read NULL for them); ``conform`` then fixes order and types and
    gives declared columns no file has as typed NULLs.  Columns dropped from
    the schema stay in the files but are not returned.
    """
    df = spark.read.option("mergeSchema", "true").format(fmt).load(path)
    return conform(df, schema, keep=tuple(k for k in keep if k in df.columns))
