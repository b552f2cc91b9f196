"""The registered queries as DuckDB SQL over the same tables.

The SQL builds the payload text by the fixture's rules and reads it with DuckDB's own JSON
functions.
"""

from __future__ import annotations

_LOG = r"""
WITH parts AS (
  SELECT event_id, ts,
    '{"$schema":"/events/1",' AS head,
    '"meta":{"uri":"/e/' || event_id || '","request_id":"r' || event_id || '","id":"' || user_id
      || '","domain":"' || event_type || '.example","stream":"events"},' AS meta,
    '"id":' || event_id || ',"type":"' || event_type || '","title":"t' || event_id
      || '","comment":"' || replace(replace(props, '\', '\\'), '"', '\"') || '","timestamp":'
      || CASE WHEN event_id % 79 = 0 THEN '"abc"'
              WHEN event_id % 73 = 0 THEN '"' || CAST(epoch(date_trunc('hour', ts)) AS BIGINT) || '.7"'
              ELSE CAST(CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS VARCHAR) END
      || ',"user":"' || user_id || '","bot":'
      || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END || '}' AS rest
  FROM events
), log AS (
  SELECT event_id, 'events' AS topic,
    CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset",
    CAST(ts AS DATE) AS kafka_date,
    CASE WHEN event_id % 97 = 0 THEN substring(head || meta || rest, 1, 20)
         WHEN event_id % 89 = 0 THEN head || rest
         WHEN event_id % 83 = 0 THEN NULL
         ELSE head || meta || rest END AS raw_values
  FROM parts
)"""

_FLAT = _LOG + r""", parsed AS (
  SELECT *, CASE WHEN json_valid(raw_values) THEN raw_values END AS doc FROM log
), texts AS (
  SELECT "partition", "offset",
    json_extract_string(doc, '$."$schema"') AS kafka_schema,
    json_extract_string(doc, '$.meta.uri') AS meta_url,
    json_extract_string(doc, '$.meta.request_id') AS meta_request_id,
    json_extract_string(doc, '$.meta.id') AS meta_id,
    json_extract_string(doc, '$.meta.domain') AS meta_domain,
    json_extract_string(doc, '$.meta.stream') AS meta_stream,
    json_extract_string(doc, '$.id') AS id,
    json_extract_string(doc, '$.type') AS type,
    json_extract_string(doc, '$.namespace') AS namespace,
    json_extract_string(doc, '$.title') AS title,
    json_extract_string(doc, '$.title_url') AS title_url,
    json_extract_string(doc, '$.comment') AS comment,
    json_extract_string(doc, '$.user') AS "user",
    json_extract_string(doc, '$.bot') AS bot,
    json_extract_string(doc, '$.parsedcomment') AS parsedcomment,
    CASE WHEN doc IS NULL THEN raw_values END AS corrupt_json,
    TRY_CAST(regexp_extract(json_extract_string(doc, '$.timestamp'), '^([0-9]+)(\.[0-9]*)?$', 1) AS BIGINT)
      AS event_second
  FROM parsed
), valid AS (
  SELECT * FROM texts WHERE meta_id IS NOT NULL AND corrupt_json IS NULL
)"""

_NEWEST = 'event_second DESC NULLS LAST, "offset" DESC, "partition" DESC'


def _winner(batch: str, columns: str) -> str:
    """The row that survives when batch ``batch`` of a row is processed after the smaller ones."""
    return (
        f"{_FLAT}, ranked AS (SELECT *, row_number() OVER (PARTITION BY meta_id "
        f"ORDER BY {batch} DESC, {_NEWEST}) AS rn, {batch} AS batch FROM valid) "
        f"SELECT {columns} FROM ranked WHERE rn = 1"
    )


_STATE = "meta_id, id, type, event_second"
_TWO = 'CASE WHEN "partition" IN (0, 2) THEN 0 ELSE 1 END'
_THREE = 'CASE WHEN "partition" IN (2, 3) THEN 0 WHEN "partition" = 0 THEN 1 ELSE 2 END'

_RAW = _LOG + ' SELECT topic, "partition", "offset", kafka_date, raw_values FROM log'
_ONE_BATCH = _winner("0", _STATE)

_PUBLISHED = _LOG + " SELECT raw_values AS value FROM log WHERE json_valid(raw_values)"


def _tail(days: int) -> str:
    """What lies past the marks of the log without its last ``days`` days, and in those days."""
    return _LOG + f""", days AS (
      SELECT kafka_date FROM log GROUP BY kafka_date ORDER BY kafka_date DESC LIMIT {days}
    ), marks AS (
      SELECT topic, "partition", max("offset") AS mark FROM log
      WHERE kafka_date < (SELECT min(kafka_date) FROM days) GROUP BY topic, "partition"
    ) SELECT log.topic, log."partition", log."offset", raw_values AS value
    FROM log LEFT JOIN marks ON log.topic = marks.topic AND log."partition" = marks."partition"
    WHERE kafka_date IN (SELECT kafka_date FROM days) AND (mark IS NULL OR log."offset" > mark)"""


_KEPT = _FLAT + f""", ranked AS (
  SELECT *, {_TWO} AS batch, row_number() OVER (PARTITION BY meta_id, {_TWO} ORDER BY {_NEWEST}) AS rn
  FROM valid
), newest AS (SELECT * FROM ranked WHERE rn = 1), added AS (
  SELECT meta_id, CAST(length(title) AS INTEGER) AS title_length FROM newest WHERE batch = 0
) SELECT newest.meta_id, id, type, event_second, title_length
  FROM newest LEFT JOIN added ON newest.meta_id = added.meta_id
  WHERE batch = (SELECT max(batch) FROM newest AS n WHERE n.meta_id = newest.meta_id)"""

ORACLE_SQL: dict[str, str] = {
    "bronze_envelope": _RAW,
    "bronze_stream": _LOG
    + ' SELECT topic, "partition", "offset", kafka_date, raw_values, true AS is_stamped FROM log',
    "bronze_checked": _RAW,
    "bronze_pruned": _RAW + " WHERE kafka_date = (SELECT max(kafka_date) FROM log)",
    "bronze_rerun_no_dup": _LOG + ' SELECT "partition", count(*) AS n FROM log GROUP BY "partition"',
    "offset_gaps": _LOG + """, spaced AS (
      SELECT topic, "partition", "offset" + "offset" // 50 AS "offset" FROM log
    ), steps AS (
      SELECT topic, "partition", "offset",
        lag("offset") OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS prev_offset
      FROM spaced
    ) SELECT topic, "partition", prev_offset, "offset" FROM steps WHERE "offset" - prev_offset > 1""",
    "rows_per_kafka_date": _LOG + " SELECT kafka_date, count(*) AS n FROM log GROUP BY kafka_date",
    "silver_flatten": _FLAT + " SELECT * FROM texts",
    "valid_records": _FLAT + """
      SELECT CASE WHEN corrupt_json IS NOT NULL THEN 'corrupt' WHEN meta_id IS NULL THEN 'keyless'
        ELSE 'valid' END AS class, count(*) AS n FROM texts GROUP BY 1""",
    "latest_per_key": _ONE_BATCH,
    "silver_first_load": _winner("0", _STATE + ", true AS is_stamped"),
    "merge_two_batches": _winner(_TWO, _STATE),
    "merge_by_event_time": _winner("0", _STATE + ", unnest([0, 1]) AS first_batch"),
    "silver_stream": _ONE_BATCH,
    "rejected_records": _FLAT + """
      SELECT CASE WHEN corrupt_json IS NOT NULL THEN 'corrupt' ELSE 'keyless' END AS class,
        log.topic, log."partition", log."offset", raw_values
      FROM texts JOIN log ON texts."partition" = log."partition" AND texts."offset" = log."offset"
      WHERE corrupt_json IS NOT NULL OR meta_id IS NULL""",
    "silver_current": _winner(_THREE, _STATE),
    "current_pruned": "SELECT * FROM (" + _winner(
        _THREE, _STATE + ", CAST(to_timestamp(event_second) AT TIME ZONE 'UTC' AS DATE) AS kafka_date"
    ) + ") WHERE kafka_date = (SELECT max(CAST(ts AS DATE)) FROM events)",
    "silver_empty_batch": _winner("0", _STATE + ", 1 AS n_batches"),
    "compaction_preserves_rows": _winner(_THREE, _STATE + ", 1 AS n_folders"),
    "compaction_notes_updates": _winner(_THREE, _STATE + ", 3 AS n_folders"),
    "schema_evolution": _winner(
        _TWO, _STATE + ", CASE WHEN batch = 1 THEN CAST(length(title) AS INTEGER) END AS title_length"
    ),
    "schema_evolution_widened": _winner(
        _THREE, _STATE + ", CAST(length(title) AS BIGINT) * CASE WHEN batch = 1 THEN 1099511627776 ELSE 1 END AS title_size"
    ),
    "schema_evolution_back": _KEPT,
    "schema_evolution_back_folded": _KEPT,
    "silver_backlog": _winner('"offset" % 12', _STATE),
    "feed_stream": _PUBLISHED,
    "sse_extract": _LOG + """
      SELECT event_id, raw_values AS value, json_valid(raw_values) AS is_json
      FROM log WHERE raw_values IS NOT NULL""",
    "publish_log": _PUBLISHED,
    "publish_stream": _PUBLISHED,
    "feed_to_state": _ONE_BATCH,
    "tail_stream": _tail(1),
    "tail_resumed": _tail(2),
    "tail_after_mark": _LOG + """, marks AS (
      SELECT topic, "partition", max("offset") AS mark FROM log
      WHERE kafka_date < (SELECT max(kafka_date) FROM log) GROUP BY topic, "partition"
    ) SELECT log.topic, log."partition", log."offset", log.kafka_date
    FROM log LEFT JOIN marks ON log.topic = marks.topic AND log."partition" = marks."partition"
    WHERE mark IS NULL OR log."offset" > mark""",
}
