"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark operators: DuckDB's JSON functions
decode the envelope, ``try_strptime`` reads the time, a
``json_keys`` list transform rebuilds the enriched metadata.  Only the input construction
(the G1 record table) is shared, so both sides start from byte-identical
envelopes; the time texts are read by DuckDB's own ``strptime`` formats.
"""

from __future__ import annotations

from quayside.plans.registry import AS_OF, EVOLVE_TIME, PRODUCER_AS_OF, SPLIT_TIME
from quayside.sources.envelope import DIRT_CYCLE, ENVELOPE_PARTITIONS, TIME_LAYOUTS, record_sql


def _ts(text: str) -> str:
    return f"TIMESTAMP '{text.replace('T', ' ')}'"


def _truthy(x: str) -> str:
    return f"""(CASE json_type({x})
        WHEN 'NULL' THEN false
        WHEN 'BOOLEAN' THEN json_extract_string({x}, '$') = 'true'
        WHEN 'VARCHAR' THEN json_extract_string({x}, '$') <> ''
        WHEN 'ARRAY' THEN json_array_length({x}) > 0
        WHEN 'OBJECT' THEN len(json_keys({x})) > 0
        ELSE CAST(json_extract_string({x}, '$') AS DOUBLE) <> 0 END)"""


def _iso_text(ts: str) -> str:
    return (f"CASE WHEN strftime({ts}, '%f') = '000000' THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') END")


def base_cte(envelope: str = "g1", as_of: str = AS_OF) -> str:
    """CTEs env → d (decoded) → c (coerced) → r (classified) → e (enriched)."""
    clean_sql, value_sql = record_sql()
    if envelope == "g1":
        env = f"""
g AS (
  SELECT event_id AS eid, user_id, event_type, props, ts,
    CAST(event_id AS STRING) AS id_txt, CAST(event_id - 1 AS STRING) AS dup_txt,
    CAST(user_id AS STRING) AS uid, 'src-' || CAST(user_id % 3 AS STRING) AS src,
    CASE event_id % {TIME_LAYOUTS}
      WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
      WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'
      WHEN 3 THEN strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30'
      WHEN 4 THEN strftime(ts, '%Y-%m-%d')
      WHEN 5 THEN strftime(ts, '%Y%m%dT%H%M%S')
      WHEN 6 THEN strftime(ts, '%Y-%-m-%-d %-H:%-M:%-S')
      WHEN 7 THEN strftime(ts, '%m/%d/%Y')
      WHEN 8 THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS STRING)
      WHEN 9 THEN NULL
      WHEN 10 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S,%g')
      WHEN 11 THEN strftime(ts - INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '-0800'
      WHEN 12 THEN strftime(ts, '%G-W%V-%u')
      WHEN 13 THEN strftime(ts, '%Y-%m-%d') || 'Z'
    END AS ts_txt,
    event_id % {DIRT_CYCLE} AS dirt
  FROM events),
g2 AS (SELECT *, {clean_sql} AS clean FROM g),
env AS (
  SELECT eid AS "offset", CAST(user_id % {ENVELOPE_PARTITIONS} AS INTEGER) AS "partition",
         ts AS kafka_timestamp, {value_sql} AS raw_value
  FROM g2)"""
    else:  # producer records
        env = f"""
env AS (
  SELECT event_id AS "offset", CAST(user_id % 4 AS INTEGER) AS "partition", ts AS kafka_timestamp,
    CAST(json_object(
      'event_id', 'event_' || CAST(event_id AS STRING) || '_' || CAST(CAST(floor(epoch(ts)) AS BIGINT) AS STRING),
      'event_type', event_type,
      'timestamp', {_iso_text('ts')},
      'payload', json_object('user_id', 'user_' || CAST(user_id AS STRING), 'action', event_type,
                             'page', '/home', 'value', 100),
      'source', 'web-app',
      'metadata', json_object('version', '1.0', 'environment', 'production')) AS VARCHAR) AS raw_value
  FROM events)"""
    fields = ", ".join(
        f"CASE WHEN obj_ok THEN json_extract_string(raw_value, '$.{f}') END AS {a}"
        for f, a in [("event_id", "event_id"), ("event_type", "event_type"), ("timestamp", "ts_text"),
                     ("payload", "payload"), ("source", "source"), ("metadata", "metadata")])
    return f"""WITH {env.strip()},
dec AS (
  SELECT *, coalesce(CASE WHEN json_valid(raw_value) THEN json_type(raw_value) = 'OBJECT' END, false) AS obj_ok
  FROM env),
d AS (SELECT "offset", "partition", kafka_timestamp, raw_value, obj_ok, {fields} FROM dec),
tz AS (
  -- a zone only follows a time: take it off, read the rest, shift
  SELECT *, CASE WHEN contains(ts_text, 'T') THEN regexp_extract(ts_text, '[+-]\\d\\d:?\\d\\d$') ELSE '' END AS zone FROM d),
tc AS (
  SELECT *,
    try_strptime(replace(regexp_replace(substr(ts_text, 1, length(ts_text) - length(zone)), 'Z$', ''), ',', '.'),
                 ['%Y-%m-%dT%H:%M:%S.%f', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%Y%m%dT%H%M%S', '%G-W%V-%u'])
      - to_minutes(CASE WHEN zone = '' THEN 0 ELSE (CASE WHEN zone[1] = '-' THEN -1 ELSE 1 END)
          * (CAST(substr(zone, 2, 2) AS INTEGER) * 60 + CAST(right(zone, 2) AS INTEGER)) END) AS read_ts
  FROM tz),
c AS (
  SELECT *, {_ts(as_of)} AS batch_ts,
    coalesce(read_ts, {_ts(as_of)}) AS ts_c,
    read_ts IS NULL AS timestamp_defaulted,
    (payload IS NOT NULL AND payload <> '') AS p_present,
    (metadata IS NOT NULL AND metadata <> '') AS m_present
  FROM tc),
c3 AS (
  SELECT *,
    (NOT p_present OR json_valid(payload)) AS payload_valid,
    coalesce(CASE WHEN p_present AND json_valid(payload) THEN {_truthy('payload')} END, false) AS payload_truthy,
    (NOT m_present OR json_valid(metadata)) AS metadata_valid,
    coalesce(CASE WHEN m_present AND json_valid(metadata) THEN {_truthy('metadata')} END, false) AS metadata_truthy,
    coalesce(CASE WHEN m_present AND json_valid(metadata) THEN json_type(metadata) = 'OBJECT' END, false)
      AS metadata_is_object
  FROM c),
r AS (
  SELECT *, CASE
    WHEN event_id IS NULL AND NOT obj_ok THEN 'malformed_value'
    WHEN event_id IS NULL THEN 'missing_event_id'
    WHEN NOT payload_valid THEN 'payload_invalid_json'
    WHEN NOT metadata_valid THEN 'metadata_invalid_json'
    WHEN event_id = '' THEN 'empty_event_id'
    WHEN coalesce(event_type, '') = '' THEN 'empty_event_type'
    WHEN coalesce(source, '') = '' THEN 'empty_source'
    WHEN ts_c > batch_ts THEN 'future_timestamp'
    WHEN NOT payload_truthy THEN 'empty_payload'
    WHEN metadata_truthy AND NOT metadata_is_object THEN 'metadata_not_object'
  END AS reject_reason
  FROM c3),
em AS (SELECT *, CASE WHEN metadata_truthy THEN metadata ELSE '{{}}' END AS m,
             '"' || {_iso_text('batch_ts')} || '"' AS processed_at_json FROM r),
e AS (
  -- dict.update: an existing key keeps its position, new keys are appended in order
  SELECT *, CASE WHEN reject_reason IS NULL THEN '{{' || concat_ws(',',
      nullif(array_to_string(list_transform(json_keys(m), lambda k: CAST(to_json(k) AS VARCHAR) || ':' ||
        CASE k WHEN 'processed_at' THEN processed_at_json WHEN 'processing_version' THEN '"1.0"'
               ELSE CAST(json_extract(m, '$."' || k || '"') AS VARCHAR) END), ','), ''),
      CASE WHEN NOT list_contains(json_keys(m), 'processed_at') THEN '"processed_at":' || processed_at_json END,
      CASE WHEN NOT list_contains(json_keys(m), 'processing_version') THEN '"processing_version":"1.0"' END) || '}}'
    ELSE metadata END AS metadata_out
  FROM em),
acc AS (
  SELECT event_id, event_type, ts_c AS "timestamp", payload, source, metadata_out AS metadata,
         batch_ts AS processed_at, "partition", "offset",
         CAST(coalesce(read_ts, kafka_timestamp, batch_ts) AS DATE) AS event_date
  FROM e WHERE reject_reason IS NULL),
dd AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY "partition", "offset") AS rn FROM acc)
  WHERE rn = 1)
"""


CONFORMED = 'event_id, event_type, "timestamp", payload, source, metadata, processed_at'


def oracle_queries() -> dict[str, str]:
    b = base_cte()
    q = {
        "envelope_parse": b + """SELECT event_id, event_type, ts_text AS "timestamp", payload, source, metadata,
            kafka_timestamp, "partition", "offset" FROM d WHERE event_id IS NOT NULL""",
        "wire_frame_split": b + """, fr AS (
            SELECT "offset", CASE WHEN "offset" % 50 = 0 THEN unhex('01') ELSE unhex('00') END
                   || unhex(lpad(hex(CAST(1 + "partition" AS INTEGER)), 8, '0')) || encode(raw_value) AS v
            FROM env)
            SELECT "offset", CAST(('0x' || substr(hex(v), 1, 2)) AS INTEGER) AS magic,
                   CAST(('0x' || substr(hex(v), 3, 8)) AS INTEGER) AS schema_id,
                   decode(unhex(substr(hex(v), 11))) AS body,
                   (octet_length(v) >= 5 AND substr(hex(v), 1, 2) = '00') AS frame_ok
            FROM fr""",
        "timestamp_coerce": b + """SELECT "offset", event_id, ts_text AS timestamp_text, ts_c AS "timestamp",
            timestamp_defaulted FROM c""",
        "payload_json_check": b + """SELECT "offset", event_id, payload, payload_valid, payload_truthy FROM c3""",
        "metadata_json_check": b + """SELECT "offset", event_id, metadata, metadata_valid, metadata_truthy,
            metadata_is_object FROM c3""",
        "mandatory_fields": b + """SELECT "offset", event_id, coalesce(event_id, '') <> '' AS event_id_ok,
            coalesce(event_type, '') <> '' AS event_type_ok, coalesce(source, '') <> '' AS source_ok FROM d""",
        "future_filter": b + """SELECT "offset", event_id, ts_c AS "timestamp", ts_c > batch_ts AS is_future FROM c""",
        "accepted_events": b + f"""SELECT {CONFORMED}, "partition", "offset" FROM acc""",
        "rejected_events": b + """SELECT raw_value, kafka_timestamp, "partition", "offset", event_id, reject_reason,
            batch_ts FROM r WHERE reject_reason IS NOT NULL""",
        "reject_counts": b + """SELECT coalesce(reject_reason, 'accepted') AS outcome, count(*) AS events
            FROM r GROUP BY 1""",
        "enrich_metadata": b + """SELECT "offset", event_id,
            json_extract_string(metadata, '$.processed_at') AS processed_at_key,
            json_extract_string(metadata, '$.processing_version') AS processing_version_key,
            json_extract_string(metadata, '$.user_id') AS user_id_key,
            CAST(len(json_keys(metadata)) AS BIGINT) AS key_count FROM acc""",
        "user_transform": b + """SELECT "offset", event_id, upper(trim(event_type)) AS event_type,
            CAST(json_extract_string(payload, '$.k') AS BIGINT) AS payload_k FROM acc""",
        "conform_default_schema": b + f"SELECT {CONFORMED} FROM acc",
        "conform_empty": b + f"""SELECT {CONFORMED} FROM acc WHERE "timestamp" > processed_at""",
        "export_event_json": b + f"""SELECT "offset", event_id AS ej_event_id,
            {_iso_text('"timestamp"')} AS ej_timestamp,
            CAST(json(payload) AS VARCHAR) AS ej_payload,
            json_extract_string(metadata, '$.processing_version') AS ej_processing_version FROM acc""",
        "dedup_in_batch": b + f"""SELECT {CONFORMED}, "partition", "offset" FROM dd""",
        "dedup_against_sink": b + f"""SELECT {CONFORMED}, "partition", "offset" FROM dd
            WHERE NOT EXISTS (SELECT 1 FROM dd t WHERE t."timestamp" < {_ts(SPLIT_TIME)}
                              AND t.event_id = dd.event_id AND t.event_date = dd.event_date)""",
        "fanout_counts": b + """SELECT * FROM (VALUES ('a', 'ok'), ('broken', 'failed'), ('b', 'ok')) s(sink, status),
            LATERAL (SELECT CASE WHEN s.status = 'ok' THEN count(DISTINCT event_id) ELSE 0 END AS row_count,
                            CASE WHEN s.status = 'ok' THEN count(*) - count(DISTINCT event_id) ELSE 0 END
                              AS duplicates FROM acc)""",
        "replay_safe": b + f"SELECT {CONFORMED} FROM dd",
        "redelivery": b + f"SELECT {CONFORMED} FROM dd",
        "stream_parity": b + f"SELECT {CONFORMED} FROM acc",
        "stream_outcome_metrics": b + """SELECT coalesce(reject_reason, 'accepted') AS outcome,
            count(*) AS events FROM r GROUP BY 1""",
        "schema_merge_read": b + f"""SELECT event_id, "timestamp",
            CASE WHEN "timestamp" >= {_ts(EVOLVE_TIME)} THEN 'region-' || source END AS region FROM acc""",
        "restart_new_query": b + f"""SELECT {CONFORMED} FROM acc""",
        "quarantine_delivery": b + """SELECT raw_value, kafka_timestamp, "partition", "offset", event_id, reject_reason,
            batch_ts FROM r WHERE reject_reason IS NOT NULL""",
        "redelivery_plain": b + f"""SELECT {CONFORMED} FROM acc""",
        "plain_replay_safe": b + f"""SELECT {CONFORMED} FROM acc""",
        "table_replay_safe": b + f"""SELECT {CONFORMED} FROM dd""",
        "evolved_table_append": b + """SELECT event_id, "timestamp",
            CASE WHEN "offset" % 3 > 0 THEN 'region-' || source END AS region,
            "offset" % 3 < 2 AS has_metadata FROM acc""",
        "newer_rows_older_table": b + """SELECT policy, CASE WHEN policy = 'quarantine' AND "offset" % 2 = 1 THEN 'quarantine' ELSE 'table' END AS place,
            event_id, CASE WHEN "offset" % 2 = 1 THEN 'region-' || source END AS region
            FROM acc, (VALUES ('evolve'), ('quarantine')) v(policy)""",
        "dedup_all_dates": b + """SELECT event_id, CAST(1 AS BIGINT) AS row_count FROM acc GROUP BY event_id""",
        "layout_by_day": b + """SELECT event_date, count(*) AS events FROM acc GROUP BY 1""",
        "layout_by_month": b + """SELECT CAST(strftime("timestamp", '%Y%m') AS INTEGER) AS event_month,
            count(*) AS events FROM acc GROUP BY 1""",
        "schema_evolve_read": b + f"""SELECT event_id, "timestamp",
            CASE WHEN "timestamp" >= {_ts(EVOLVE_TIME)} THEN 'region-' || source END AS region FROM acc""",
        "avro_decode": """WITH t AS (SELECT *, CASE event_id % 50 WHEN 0 THEN 'bad_record' WHEN 1 THEN 'unknown_schema_id' END AS err FROM events)
            SELECT event_id AS "offset", CASE WHEN err IS NULL THEN CAST(event_id AS VARCHAR) END AS event_id,
              CASE WHEN err IS NULL THEN event_type END AS event_type, CASE WHEN err IS NULL THEN ts END AS event_time,
              CASE WHEN err IS NULL THEN CASE WHEN event_id % 4 < 2 THEN props
                ELSE '{"user":' || user_id || ',"marks":[' || -event_id || ',' || user_id || ']'
                     || CASE WHEN event_id % 3 = 0 THEN '' ELSE ',"note":"' || event_type || '"' END || '}' END END AS payload,
              CASE WHEN err IS NULL THEN CASE WHEN event_id % 4 < 2 THEN 'src-' || (user_id % 3)
                ELSE ['web', 'app', 'api'][user_id % 3 + 1] END END AS source,
              CASE WHEN err IS NULL AND (event_id % 4 < 2 OR event_id % 7 > 0) THEN '{"user_id":' || user_id || '}' END AS metadata,
              err AS decode_error FROM t""",
        "protobuf_decode": """WITH t AS (SELECT *, event_id % 10 = 7 AS inner_event, CASE event_id % 50 WHEN 0 THEN 'bad_record'
                WHEN 1 THEN 'unknown_schema_id' WHEN 2 THEN 'unsupported_message_index' END AS err FROM events)
            SELECT event_id AS "offset", CASE WHEN err IS NULL THEN CAST(event_id AS VARCHAR) END AS event_id,
              CASE WHEN err IS NULL THEN event_type END AS event_type, CASE WHEN err IS NULL AND NOT inner_event THEN ts END AS event_time,
              CASE WHEN err IS NULL THEN CASE WHEN inner_event THEN props
                ELSE '{"user":' || -user_id || ',"marks":[' || CASE WHEN event_id % 5 = 0 THEN '' ELSE user_id || ',' || event_id END || ']}' END END AS payload,
              CASE WHEN err IS NULL AND NOT inner_event THEN ['web', 'app', 'api'][user_id % 3 + 1] END AS source,
              CASE WHEN err IS NULL AND NOT inner_event THEN '{"user_id":' || user_id || '}' END AS metadata,
              err AS decode_error FROM t""",
        "late_side_output": b + """, mark AS (SELECT date_trunc('milliseconds', max("timestamp")) - INTERVAL 1 HOUR AS m FROM acc WHERE "offset" % 2 = 0),
            firsts AS (SELECT event_id, "offset", "timestamp", "offset" % 2 AS half,
                row_number() OVER (PARTITION BY event_id ORDER BY "offset" % 2, "partition", "offset") AS rn FROM acc)
            SELECT event_id, "offset", "timestamp", CASE WHEN half = 1 AND "timestamp" <= m THEN 'late' ELSE 'delivered' END AS arrival,
              CASE WHEN half = 1 AND "timestamp" <= m THEN m END AS missed_watermark FROM firsts, mark WHERE rn = 1""",
        "generated_events": base_cte("producer", PRODUCER_AS_OF) + f"SELECT {CONFORMED} FROM acc",
    }
    return q
