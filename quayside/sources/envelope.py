"""Kafka-shaped envelopes: schema, files as an offline stand-in, and G1.

An *envelope* DataFrame has the Kafka source schema (``key``, ``value`` binary,
``topic``, ``partition``, ``offset``, ``timestamp``, ``timestampType``).  Every
decode operator reads this shape, whether it comes from Kafka, from envelope
files (batch or file stream), or from a table turned into envelopes.

``envelope_from_events`` (G1) turns the driver's ``events`` table into JSON
envelopes, with a deterministic share of malformed and rule-breaking records
so that every parse/validation branch is hit at every scale.  It is a pure
projection: one output row per input row, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (BinaryType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

ENVELOPE_SCHEMA = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
    StructField("timestampType", IntegerType()),
])

ENVELOPE_PARTITIONS = 4   # Kafka partitions simulated by G1 (user_id % 4)
TIME_LAYOUTS = 14         # event_id % 14 picks the event-time text layout
DIRT_CYCLE = 37           # event_id % 37 picks the record variant

# G1 record variants.  Fragments are SQL valid in both Spark SQL and DuckDB
# over the columns id_txt, dup_txt, uid, src, props (see ``record_sql``).  Each entry
# replaces one JSON member ('' = member left out); the rest stay clean.
# fixed values: G1 variant table (code → member overrides)
DIRT: dict[int, dict[str, str]] = {
    0: {"value": "'not json'"},
    1: {"value": "substr(clean, 1, 30)"},
    2: {"event_id": ""},
    3: {"event_id": "'\"event_id\":\"\"'"},
    4: {"event_id": "'\"event_id\":' || id_txt"},
    5: {"event_type": ""},
    6: {"source": "'\"source\":\"\"'"},
    7: {"source": ""},
    8: {"payload": "'\"payload\":{}'"},
    9: {"payload": "'\"payload\":[]'"},
    10: {"payload": "'\"payload\":0'"},
    11: {"payload": "'\"payload\":false'"},
    12: {"payload": "'\"payload\":\"\"'"},
    13: {"payload": "'\"payload\":null'"},
    14: {"payload": "'\"payload\":\"abc\"'"},
    15: {"payload": "'\"payload\":\"' || replace(props, '\"', chr(92) || '\"') || '\"'"},
    16: {"payload": "'\"payload\":\"' || replace(props, '\"', chr(92) || '\"') || ' junk\"'"},
    17: {"payload": "'\"payload\":[1,2]'"},
    18: {"payload": "'\"payload\":5'"},
    19: {"payload": "'\"payload\":true'"},
    20: {"metadata": "'\"metadata\":\"abc\"'"},
    21: {"metadata": "'\"metadata\":5'"},
    22: {"metadata": "'\"metadata\":[1]'"},
    23: {"metadata": ""},
    24: {"metadata": "'\"metadata\":{}'"},
    25: {"metadata": "'\"metadata\":0'"},
    26: {"metadata": "'\"metadata\":{\"processed_at\":\"old\",\"user_id\":' || uid || '}'"},
    27: {"metadata": "'\"metadata\":{\"user_id\":' || uid || ',\"tags\":{\"a\":[1,null]},\"note\":null}'"},
    28: {"metadata": "'\"metadata\":\"{' || chr(92) || '\"user_id' || chr(92) || '\": ' || uid || '}\"'"},
    29: {"event_id": "'\"event_id\":\"' || dup_txt || '\"'"},
    30: {"extra": "'\"extra\":{\"x\":1}'"},
    31: {"payload": "'\"payload\":\" \"'"},
    32: {"event_type": "'\"event_type\":\"\"'"},
    33: {"metadata": "'\"metadata\":{\"user_id\":' || uid || ',\"big\":123456789012345678901234567890123456789012345}'"},
    34: {"payload": "'\"payload\":\"{' || chr(92) || '\"a' || chr(92) || '\":1,' || chr(92) || '\"a' || chr(92) || '\":2}\"'"},
    35: {"payload": "'\"payload\":\"{' || chr(92) || '\"a' || chr(92) || '\":NaN}\"'"},
}

# Clean members, in record order.
# fixed values: G1 clean record members
CLEAN = {
    "event_id": "'\"event_id\":\"' || id_txt || '\"'",
    "event_type": "'\"event_type\":\"' || event_type || '\"'",
    "timestamp": "'\"timestamp\":\"' || ts_txt || '\"'",
    "payload": "'\"payload\":' || props",
    "source": "'\"source\":\"' || src || '\"'",
    "metadata": "'\"metadata\":{\"user_id\":' || uid || ',\"version\":\"1.0\"}'",
    "extra": "NULL",
}


def _member(name: str) -> str:
    cases = [f"WHEN {d} THEN {('NULL' if o[name] == '' else o[name])}"
             for d, o in DIRT.items() if name in o]
    if not cases:
        return CLEAN[name]
    return f"CASE dirt {' '.join(cases)} ELSE {CLEAN[name]} END"


def record_sql() -> tuple[str, str]:
    """(clean-record SQL, final-value SQL) over id_txt, dup_txt, uid, src, props,
    event_type, ts_txt, dirt.  Shared by the Spark builder and the SQL oracle
    so both start from byte-identical input."""
    members = ", ".join(_member(m) for m in CLEAN)
    clean = f"'{{' || concat_ws(',', {members}) || '}}'"
    value_cases = " ".join(f"WHEN {d} THEN {o['value']}" for d, o in DIRT.items() if "value" in o)
    return clean, f"CASE dirt {value_cases} ELSE clean END"


# event_id % 14 → one of the accepted (or deliberately unaccepted) layouts
# fixed values: G1 event-time text layouts (Spark SQL over the instant `ts`)
TIME_LAYOUT_SQL = (
    "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
    "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS\"), 'Z')",
    "concat(date_format(ts + INTERVAL '5:30' HOUR TO MINUTE, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+05:30')",
    "date_format(ts, 'yyyy-MM-dd')",
    "date_format(ts, \"yyyyMMdd'T'HHmmss\")",
    "date_format(ts, 'yyyy-M-d H:m:s')",
    "date_format(ts, 'MM/dd/yyyy')",
    "CAST(unix_seconds(ts) AS STRING)",
    "CAST(NULL AS STRING)",
    "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss,SSS\")",
    "concat(date_format(ts - INTERVAL '8' HOUR, \"yyyy-MM-dd'T'HH:mm:ss\"), '-0800')",
    "concat(extract(YEAROFWEEK FROM ts), '-W', lpad(weekofyear(ts), 2, '0'), '-', weekday(ts) + 1)",
    "concat(date_format(ts, 'yyyy-MM-dd'), 'Z')",
)


def envelope_from_events(events: DataFrame, dirty: bool = True, topic: str = "events") -> DataFrame:
    """G1: the ``events`` table as Kafka JSON envelopes (one per event row)."""
    layouts = " ".join(f"WHEN {i} THEN {sql}" for i, sql in enumerate(TIME_LAYOUT_SQL))
    base = events.selectExpr(
        "event_id", "user_id", "event_type", "props", "CAST(ts AS TIMESTAMP) AS ts",
        "CAST(event_id AS STRING) AS id_txt", "CAST(event_id - 1 AS STRING) AS dup_txt",
        "CAST(user_id AS STRING) AS uid", "concat('src-', CAST(user_id % 3 AS STRING)) AS src",
        f"event_id % {DIRT_CYCLE if dirty else 1} + {0 if dirty else -1} AS dirt",
    ).selectExpr("*", f"CASE event_id % {TIME_LAYOUTS} {layouts} END AS ts_txt")
    clean_sql, value_sql = record_sql()
    return base.selectExpr("*", f"{clean_sql} AS clean").selectExpr(
        "CAST(id_txt AS BINARY) AS key",
        f"CAST({value_sql} AS BINARY) AS value",
        f"{sql_str(topic)} AS topic",
        f"CAST(user_id % {ENVELOPE_PARTITIONS} AS INT) AS `partition`",
        "CAST(event_id AS BIGINT) AS `offset`",
        "ts AS `timestamp`",
        "0 AS timestampType",
    )


def sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def read_envelope_files(spark: SparkSession, path: str, streaming: bool = False,
                        max_files_per_trigger: int | None = None, partitions: int | None = None) -> DataFrame:
    """Envelope Parquet files, batch or as a file stream with a fixed schema.

    A read has one task per file split.  Where files are few and small for the
    cores at hand, ``partitions`` spreads the raw envelopes (a round-robin
    shuffle of the undecoded rows) before the CPU-heavy decode; leave it
    unset when files are large or many, or set Spark's own split size
    (``spark.sql.files.maxPartitionBytes``).
    """
    if streaming:
        reader = spark.readStream.schema(ENVELOPE_SCHEMA).format("parquet")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        df = reader.load(path)
    else:
        df = spark.read.schema(ENVELOPE_SCHEMA).parquet(path)
    return df.repartition(partitions) if partitions else df


def write_envelope_files(envelopes: DataFrame, path: str, files: int | None = None) -> None:
    """Land envelopes as Parquet (e.g. the offline stand-in for a topic)."""
    out = envelopes.repartition(files) if files else envelopes
    out.write.mode("append").parquet(path)
