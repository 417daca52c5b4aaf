"""Envelope → event fields.

``decode_events`` is a narrow projection: no shuffle, and for JSON no Python
(Avro and Protobuf without Spark's modules are read by Arrow batch).  Output:
the six event fields as text, the source position (``kafka_timestamp``,
``partition``, ``offset``), the raw value text (``raw_value``, for the
quarantine) and ``decode_error`` (NULL when the value could be decoded).
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from quayside.functions import avro, cursors, protobuf, wire

# the record readers run in Python workers, which need not have this package
for _module in (cursors, avro, protobuf):
    cloudpickle.register_pickle_by_value(_module)

# fixed values: the event fields the producer contract defines, in order
EVENT_FIELDS = ("event_id", "event_type", "timestamp", "payload", "source", "metadata")

# The JSON read schema: every field as text (numbers/booleans keep their
# text, nested objects arrive as compact JSON text).
JSON_READ_SCHEMA_DDL = ", ".join(f"`{f}` STRING" for f in EVENT_FIELDS)

VALUE_FORMATS = ("json", "avro", "protobuf")


class MissingConnectorError(RuntimeError):
    """A Spark module needed for this format is not on the classpath."""


def _positions(df: DataFrame) -> list[Column]:
    return [F.col("timestamp").alias("kafka_timestamp"), F.col("partition"), F.col("offset")]


def _check_format(fmt: str, schemas) -> str:
    f = (fmt or "").lower()
    if f not in VALUE_FORMATS:
        raise ValueError(f"Unsupported value format: {fmt!r} (expected one of {', '.join(VALUE_FORMATS)})")
    if f != "json" and not schemas:
        raise ValueError(f"{f} values need writer schemas (schema id → schema) from the registry")
    return f


def decode_json(envelopes: DataFrame, keep_key: bool = False) -> DataFrame:
    cols = [f"from_json(CAST(value AS STRING), '{JSON_READ_SCHEMA_DDL}') AS data",
            "`timestamp` AS kafka_timestamp", "`partition`", "`offset`", "CAST(value AS STRING) AS raw_value"]
    if keep_key:
        cols.append("CAST(key AS STRING) AS key")
    rest = ["kafka_timestamp", "`partition`", "`offset`", "raw_value"] + (["key"] if keep_key else [])
    return envelopes.selectExpr(*cols).selectExpr(
        *[f"data.`{f}` AS `{f}`" for f in EVENT_FIELDS], *rest, "CAST(NULL AS STRING) AS decode_error")


def _as_text(c: Column, dtype) -> Column:
    """Decoded record field → text; structs/maps/arrays become JSON text."""
    if isinstance(dtype, (StructType, MapType)) or dtype.typeName() == "array":
        return F.to_json(c)
    return c.cast("string")


def _has_spark_module(spark: SparkSession, fmt: str) -> bool:
    """Whether Spark's own module for the format is on the classpath."""
    package = getattr(spark._jvm.org.apache.spark.sql, fmt)
    return type(getattr(package, f"{fmt.capitalize()}DataToCatalyst")).__name__ != "JavaPackage"


def _avro_record(body: Column, schema, spark_module: bool) -> Column:
    writer, reader = (schema["writer"], schema.get("reader")) if isinstance(schema, dict) and "writer" in schema else (schema, None)
    if not spark_module:
        return avro.avro_column(body, writer, reader)
    from pyspark.sql.avro.functions import from_avro
    return from_avro(body, writer, {"mode": "PERMISSIVE", **({"avroSchema": reader} if reader else {})})


def _protobuf_record(body: Column, schema: dict, message, spark_module: bool) -> Column:
    if not spark_module:
        return protobuf.protobuf_column(body, message)
    from pyspark.sql.protobuf.functions import from_protobuf
    return from_protobuf(body, schema["message"], binaryDescriptorSet=schema["descriptor"], options={"mode": "PERMISSIVE"})


def _variants(fmt: str, schemas: dict, spark_module: bool) -> list[tuple[Column, Column]]:
    """(condition, decoded record) of every schema, and of every message of it."""
    sid, body, out = F.col("_sid"), F.col("_body"), []
    for schema_id, schema in schemas.items():
        if fmt == "avro":
            here = sid == schema_id
            out.append((here, _avro_record(F.when(here, body), schema, spark_module)))
            continue
        for one in schema if isinstance(schema, list) else [schema]:
            message, path = protobuf.load_message(one["message"], one["descriptor"])
            for prefix in protobuf.index_prefixes(path):
                here = (sid == schema_id) & (F.hex(F.substring(body, 1, len(prefix))) == prefix.hex().upper())
                rest = F.substring(body, len(prefix) + 1, 2147483647)
                out.append((here, _protobuf_record(F.when(here, rest), one, message, spark_module)))
    return out


def decode_framed(envelopes: DataFrame, fmt: str, schemas: dict, keep_key: bool = False) -> DataFrame:
    """Registry-framed Avro/Protobuf values → event fields.

    ``schemas`` maps schema id → writer schema.  Avro: JSON text, or
    ``{"writer": text, "reader": text}`` to read under another schema.
    Protobuf: ``{"message": name, "descriptor": bytes}``, or a list of them where
    values of one id hold several messages of the file (nested ones too): the
    index list before the body says which.  Records of several schema versions
    are decoded in one pass, without grouping.

    Spark's own module decodes where it is on the classpath, else the Arrow
    readers of ``functions.avro`` and ``functions.protobuf`` do, a batch at a
    time.  ``decode_error``: ``bad_frame``, ``unknown_schema_id``,
    ``unsupported_message_index`` or ``bad_record``.
    """
    fmt = _check_format(fmt, schemas)
    value = F.col("value")
    ok = F.coalesce(wire.frame_ok(value), F.lit(False))
    kept = [F.col("key").cast("string").alias("key")] if keep_key else []
    framed = envelopes.select(*_positions(envelopes), *kept, F.hex(value).alias("raw_value"), ok.alias("_ok"),
                              F.when(ok, wire.frame_schema_id(value)).alias("_sid"), F.when(ok, wire.frame_body(value)).alias("_body"))
    variants = _variants(fmt, schemas, _has_spark_module(envelopes.sparkSession, fmt))
    decoded = framed.select("*", *[record.alias(f"_r{k}") for k, (_, record) in enumerate(variants)])
    known, data = F.lit(False), None
    for k, (here, _) in enumerate(variants):
        types = {f.name: f.dataType for f in decoded.schema[f"_r{k}"].dataType.fields}
        record = F.col(f"_r{k}")
        texts = F.struct(*[(_as_text(record[f], types[f]) if f in types else F.lit(None).cast("string")).alias(f) for f in EVENT_FIELDS])
        data = F.when(record.isNotNull(), texts) if data is None else data.when(record.isNotNull(), texts)
        known = known | here
    error = (F.when(~F.col("_ok"), F.lit("bad_frame"))
             .when(~F.col("_sid").isin(*schemas.keys()), F.lit("unknown_schema_id"))
             .when(~known, F.lit("unsupported_message_index"))
             .when(data.isNull(), F.lit("bad_record")))
    rest = ["kafka_timestamp", "partition", "offset", *(["key"] if keep_key else []), "raw_value"]
    out = decoded.select(data.alias("data"), *rest, error.alias("decode_error"))
    return out.select(*[F.col(f"data.{f}").alias(f) for f in EVENT_FIELDS], *rest, "decode_error")


def decode_events(envelopes: DataFrame, fmt: str = "json", schemas: dict | None = None,
                  keep_unparsed: bool = True, keep_key: bool = False) -> DataFrame:
    """S5 dispatch.  ``keep_unparsed=False`` drops id-less rows right here,
    exactly like a plain source filter; by default they stay so the
    classifier can route them to the quarantine with a reason."""
    f = _check_format(fmt, schemas)
    out = decode_json(envelopes, keep_key) if f == "json" else decode_framed(envelopes, f, schemas, keep_key)
    if not keep_unparsed:
        out = out.filter(F.col("event_id").isNotNull())
    return out
