"""The same queries as plain SQL over the given tables, for cross-checking.

Each query is a body over shared common table expressions; only those a body
needs are put in front of it.
"""

from __future__ import annotations

import re


def padded(prefix: str, number: str, width: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return (
        f"'{prefix}' || lpad({text}, CAST(greatest({width}, length({text})) AS INTEGER), '0')"
    )


def _quality(signal: str) -> str:
    return f"CASE WHEN {signal} < -80 THEN 'WEAK' WHEN {signal} < -60 THEN 'MEDIUM' ELSE 'STRONG' END"


SIGNAL = "CAST(signal_strength AS DECIMAL(38,0))"
COMMON = """
    user_name, user_type, department, email, phone, clearance_level"""
USER_TYPE = """CASE WHEN c_acctbal >= 8000 THEN 'EMPLOYEE' WHEN c_acctbal >= 4000 THEN 'CONTRACTOR'
       WHEN c_acctbal >= 1000 THEN 'VENDOR' ELSE 'VISITOR' END"""
CALENDAR = """CAST(event_timestamp AS DATE) AS event_date,
    CAST(hour(event_timestamp) AS BIGINT) AS event_hour,
    CAST(dayofweek(event_timestamp) AS BIGINT) AS event_day_of_week,
    hour(event_timestamp) < 6 OR hour(event_timestamp) >= 22 AS is_after_hours,
    dayofweek(event_timestamp) IN (0, 6) AS is_weekend"""

HIST = """
  SELECT name AS task_name, state, scheduled_time, completed_time,
    date_diff('second', scheduled_time, completed_time) AS duration_seconds, error_code, error_message,
    CASE state WHEN 'SUCCEEDED' THEN 'SUCCESS' WHEN 'FAILED' THEN 'FAILED' WHEN 'SKIPPED' THEN 'SKIPPED' ELSE 'UNKNOWN' END AS execution_status"""

CTES: dict[str, str] = {
    "ev": "SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events",
    "sent": f"""
  SELECT event_id, copy, k,
    {padded('BADGE-', 'user_id', 5)} AS badge_id,
    {padded('USR-', 'user_id', 4)} AS user_id,
    {padded('ZONE-', 'k % 30', 2)} AS zone_id,
    CASE WHEN copy = 1 THEN 'RDR-999' ELSE {padded('RDR-', 'k % 25', 3)} END AS reader_id,
    ts AS event_timestamp,
    CASE WHEN k % 10 <> 0 THEN CAST(-(CAST(value AS DECIMAL(9,2)) % 110) AS DECIMAL(5,2)) END AS signal_strength,
    CASE event_type WHEN 'view' THEN 'entry' WHEN 'purchase' THEN 'EXIT' WHEN 'signup' THEN 'Entry'
      ELSE CASE WHEN k % 2 = 0 THEN 'LOITER' END END AS direction,
    ts + INTERVAL 1 SECOND * (k + CASE WHEN copy = 1 THEN 60 ELSE 0 END) AS ingestion_time
  FROM (SELECT *, 0 AS copy FROM ev UNION ALL SELECT *, 1 FROM ev WHERE event_type = 'error'
        UNION ALL SELECT *, 2 FROM ev WHERE value >= 100)""",
    "raw": f"""
  SELECT badge_id, user_id, zone_id, reader_id, event_timestamp,
    CAST(coalesce({SIGNAL}, -999) AS DECIMAL(5,2)) AS signal_strength,
    {_quality(SIGNAL)} AS signal_quality, upper(direction) AS direction, ingestion_time
  FROM sent WHERE copy < 2""",
    "stg": """
  SELECT * EXCLUDE (rn), date_trunc('minute', ingestion_time) + INTERVAL 1 MINUTE AS staging_time
  FROM (SELECT *, row_number() OVER (PARTITION BY badge_id, event_timestamp
          ORDER BY ingestion_time DESC, reader_id, zone_id, user_id,
                   signal_strength NULLS LAST, direction NULLS LAST) AS rn FROM raw)
  WHERE rn = 1""",
    "enrolled": f"""
  SELECT c_custkey + 1 AS user_key, {padded('USR-', 'c_custkey', 4)} AS user_id,
    c_name AS user_name, {USER_TYPE} AS user_type, c_mktsegment AS department,
    lower(replace(c_name, '#', '.')) || '@example.com' AS email,
    {padded('555-', 'c_custkey', 7)} AS phone,
    CASE WHEN c_acctbal >= 7000 THEN 'SECRET' WHEN c_acctbal >= 3000 THEN 'CONFIDENTIAL' ELSE 'PUBLIC' END AS clearance_level,
    TRUE AS is_active, TIMESTAMP '2024-01-01' AS effective_start_date,
    CAST(NULL AS TIMESTAMP) AS effective_end_date, TRUE AS is_current,
    TIMESTAMP '2024-01-01' AS created_timestamp, TIMESTAMP '2024-01-01' AS updated_timestamp
  FROM customer WHERE c_acctbal >= 0""",
    "missing": "SELECT DISTINCT user_id FROM stg WHERE user_id NOT IN (SELECT user_id FROM enrolled)",
    "newm": """
  SELECT (SELECT max(user_key) FROM enrolled) + row_number() OVER (ORDER BY substr(md5(user_id), 1, 3), user_id) AS user_key,
    user_id, 'UNKNOWN' AS user_name, 'UNKNOWN' AS user_type, 'UNKNOWN' AS department,
    CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone, 'PUBLIC' AS clearance_level,
    TRUE AS is_active, {stamp} AS effective_start_date, CAST(NULL AS TIMESTAMP) AS effective_end_date,
    TRUE AS is_current, {stamp} AS created_timestamp, {stamp} AS updated_timestamp
  FROM missing""".replace("{stamp}", "(SELECT max(ingestion_time) FROM raw)"),
    "users": "SELECT * FROM enrolled UNION ALL SELECT * FROM newm",
    "zones": f"""
  SELECT CAST(n_nationkey + 1 AS BIGINT) AS zone_key, {padded('ZONE-', 'n_nationkey', 2)} AS zone_id,
    {padded('RDR-', 'n_nationkey', 3)} AS reader_id, r_name AS building_name,
    CAST(NULL AS BIGINT) AS floor_number, n_name AS zone_name,
    CASE n_nationkey % 5 WHEN 0 THEN 'SECURE_AREA' WHEN 1 THEN 'LOBBY' ELSE 'OFFICE' END AS zone_type,
    CAST(NULL AS BIGINT) AS capacity, CAST(NULL AS VARCHAR) AS requires_clearance,
    TRUE AS is_monitored, n_nationkey % 4 = 0 AS is_restricted,
    CAST(NULL AS VARCHAR) AS reader_location, CAST(NULL AS VARCHAR) AS reader_type,
    CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
    TIMESTAMP '2024-01-01' AS created_timestamp, TIMESTAMP '2024-01-01' AS updated_timestamp
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "fct": f"""
  SELECT u.user_key, z.zone_key, s.badge_id, s.reader_id, s.event_timestamp, {CALENDAR},
    s.direction, s.signal_strength, s.signal_quality, z.is_restricted AS is_restricted_access,
    s.ingestion_time, s.staging_time + INTERVAL 1 MINUTE AS fact_load_time
  FROM stg s JOIN users u ON u.user_id = s.user_id AND u.is_current
    JOIN zones z ON z.zone_id = s.zone_id""",
    "clock": "SELECT max(ingestion_time) + INTERVAL 5 MINUTE AS as_of FROM raw",
    "today": "SELECT max(event_timestamp) AS last_event, CAST(max(event_timestamp) AS DATE) AS day FROM fct",
    # -- lines and the logs over them --
    "faulty": "SELECT *, CASE WHEN copy = 2 THEN k % 6 END AS fault FROM sent",
    "lines": """
  SELECT *, CASE WHEN fault = 2 THEN substr(line, 1, 20) ELSE line END AS value,
    'CH-' || CAST(k % 4 AS VARCHAR) AS channel_name
  FROM (SELECT *, '{' || concat_ws(',',
      CASE WHEN fault IS NULL OR fault <> 1 THEN '"badge_id":"' || badge_id || '"' END,
      CASE WHEN fault = 5 THEN '"user_id":null' ELSE '"user_id":"' || user_id || '"' END,
      '"zone_id":"' || CASE WHEN fault = 4 THEN rpad(zone_id, 60, 'X') ELSE zone_id END || '"',
      '"reader_id":"' || reader_id || '"',
      '"event_timestamp":"' || CASE WHEN fault = 0 THEN 'not-a-time' ELSE strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') END || '"',
      '"signal_strength":' || CASE WHEN fault = 3 THEN '"n/a"' ELSE coalesce(CAST(signal_strength AS VARCHAR), 'null') END,
      CASE WHEN fault = 5 THEN '"direction":"SIDEWAYS-LONG"' ELSE coalesce('"direction":"' || direction || '"', '"direction":null') END
    ) || '}' AS line FROM faulty)""",
    "parsed": """
  SELECT value AS raw_json, json_valid(value) AS ok,
    json_extract_string(j, '$.badge_id') AS badge_id, json_extract_string(j, '$.user_id') AS user_id,
    json_extract_string(j, '$.zone_id') AS zone_id, json_extract_string(j, '$.reader_id') AS reader_id,
    json_extract_string(j, '$.event_timestamp') AS time_text,
    try_cast(json_extract_string(j, '$.event_timestamp') AS TIMESTAMP) AS event_timestamp,
    json_extract_string(j, '$.signal_strength') AS signal_text,
    try_cast(json_extract_string(j, '$.signal_strength') AS DECIMAL(38,2)) AS signal,
    json_extract_string(j, '$.direction') AS direction
  FROM (SELECT value, CASE WHEN json_valid(value) THEN value END AS j FROM lines)""",
    "judged": """
  SELECT *, CASE WHEN NOT ok THEN 'line is not a JSON object' ELSE concat_ws('; ',
      CASE WHEN time_text IS NULL THEN 'event_timestamp is missing'
           WHEN event_timestamp IS NULL THEN 'event_timestamp is not a time' END,
      CASE WHEN badge_id IS NULL THEN 'badge_id is missing' END,
      CASE WHEN user_id IS NULL THEN 'user_id is missing' END,
      CASE WHEN zone_id IS NULL THEN 'zone_id is missing' END,
      CASE WHEN reader_id IS NULL THEN 'reader_id is missing' END,
      CASE WHEN length(badge_id) > 50 THEN 'badge_id is longer than 50' END,
      CASE WHEN length(user_id) > 50 THEN 'user_id is longer than 50' END,
      CASE WHEN length(zone_id) > 50 THEN 'zone_id is longer than 50' END,
      CASE WHEN length(reader_id) > 50 THEN 'reader_id is longer than 50' END,
      CASE WHEN length(direction) > 10 THEN 'direction is longer than 10' END,
      CASE WHEN signal_text IS NOT NULL AND signal IS NULL THEN 'signal_strength is not a number'
           WHEN abs(signal) >= 1000 THEN 'signal_strength is out of range' END) END AS reject_reasons
  FROM parsed""",
    "landed": f"""
  SELECT badge_id, user_id, zone_id, reader_id, event_timestamp,
    CAST(coalesce(CAST(signal AS DECIMAL(38,0)), -999) AS DOUBLE) AS signal_strength,
    {_quality('CAST(signal AS DECIMAL(38,0))')} AS signal_quality,
    upper(direction) AS direction, raw_json
  FROM judged WHERE reject_reasons = ''""",
    "ilog": """
  SELECT channel_name, 'BADGE_EVENTS_PIPE' AS pipe_name, date_trunc('minute', ingestion_time) AS server_timestamp,
    count(*) AS rows_parsed, count(*) FILTER (WHERE fault IS NULL) AS rows_inserted,
    count(*) FILTER (WHERE fault IS NOT NULL) AS rows_error_count,
    CAST(coalesce(sum(strlen(value)) FILTER (WHERE fault IS NULL), 0) AS BIGINT) AS bytes_inserted,
    max('fault ' || CAST(fault AS VARCHAR)) AS last_error_message
  FROM lines GROUP BY ALL""",
    "newest": "SELECT max(ingestion_time) AS as_of FROM faulty",
    "rlog": """
  SELECT name, state, scheduled_time, completed_time, error_code, error_message FROM (
    WITH m AS (
      SELECT date_trunc('minute', ingestion_time) AS minute, count(*) FILTER (WHERE fault IS NOT NULL) AS n_bad,
        count(*) FILTER (WHERE copy = 1) AS n_resent, count(*) AS n, CAST(sum(k) AS BIGINT) AS work
      FROM faulty GROUP BY 1),
    t AS (
      SELECT *, CASE WHEN n_bad * 2 > n THEN 'FAILED' WHEN n_resent = n THEN 'SKIPPED' ELSE 'SUCCEEDED' END AS stage_state,
        minute + INTERVAL 60 SECOND AS stage_at,
        minute + INTERVAL 60 SECOND + INTERVAL 1 SECOND * (work % 90) AS staged_at,
        minute + INTERVAL 60 SECOND + INTERVAL 1 SECOND * (work % 90) + INTERVAL 1 SECOND * (work % 60) AS loaded_at
      FROM m)
    SELECT 'raw_to_staging_task' AS name, stage_state AS state, stage_at AS scheduled_time, staged_at AS completed_time,
      CASE WHEN stage_state = 'FAILED' THEN '100038' END AS error_code,
      CASE WHEN stage_state = 'FAILED' THEN CAST(n_bad AS VARCHAR) || ' bad lines' END AS error_message FROM t
    UNION ALL
    SELECT 'staging_to_analytics_task', CASE WHEN stage_state = 'SUCCEEDED' THEN 'SUCCEEDED' ELSE 'SKIPPED' END,
      staged_at, loaded_at, NULL, NULL FROM t)""",
    "scanlog": """
  SELECT CASE WHEN event_type = 'view' THEN 'RAW_BADGE_EVENTS' WHEN event_type IN ('click', 'purchase') THEN 'FCT_ACCESS_EVENTS'
      ELSE 'STG_BADGE_EVENTS' END AS table_name,
    CAST(floor(value) AS BIGINT) % (k + 1) AS partitions_scanned, k AS partitions_total,
    CAST(floor(value) AS BIGINT) * 10000000 AS bytes_scanned, ts AS start_time FROM ev""",
    "meter": """
  SELECT CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'ETL_WH' ELSE 'BI_WH' END AS warehouse_name,
    CAST(CAST(value AS DECIMAL(9,2)) AS DECIMAL(18,5)) * CAST(0.001 AS DECIMAL(4,3)) AS credits_used, ts AS start_time FROM ev""",
    # -- field scans and rules --
    "field": f"""
  SELECT event_id, {padded('BADGE-', 'user_id', 5)} AS badge_id,
    CASE WHEN k = 7 THEN '  ' WHEN k <> 8 THEN {padded('USR-', 'user_id', 4)} END AS user_id,
    {padded('ZONE-', 'k % 30', 2)} AS zone_id,
    CASE WHEN k = 11 THEN rpad({padded('RDR-', 'k % 25', 3)}, 60, 'X') ELSE {padded('RDR-', 'k % 25', 3)} END AS reader_id,
    CASE WHEN k <> 13 THEN CASE WHEN event_type = 'signup' THEN ts - INTERVAL 20 DAY ELSE ts END END AS event_timestamp,
    CASE WHEN k % 10 <> 0 THEN CAST((CAST(value AS DECIMAL(9,2)) % 110) * CASE WHEN k = 3 THEN 1 ELSE -1 END AS DOUBLE) END AS signal_strength,
    CASE event_type WHEN 'view' THEN 'ENTRY' WHEN 'purchase' THEN 'EXIT' WHEN 'signup' THEN 'Entry' END AS direction
  FROM ev""",
    "deadline": "SELECT max(event_timestamp) - INTERVAL 1 DAY AS as_of FROM field",
    "ruled": """
  SELECT event_id, event_timestamp,
    concat_ws('; ',
      CASE WHEN regexp_full_match(coalesce(badge_id, ''), '\\s*') THEN 'badge_id is required and cannot be empty' END,
      CASE WHEN regexp_full_match(coalesce(user_id, ''), '\\s*') THEN 'user_id is required and cannot be empty' END,
      CASE WHEN regexp_full_match(coalesce(zone_id, ''), '\\s*') THEN 'zone_id is required and cannot be empty' END,
      CASE WHEN regexp_full_match(coalesce(reader_id, ''), '\\s*') THEN 'reader_id is required and cannot be empty' END,
      CASE WHEN event_timestamp IS NULL THEN 'event_timestamp is required' END) AS e_required,
    CASE WHEN event_timestamp > as_of THEN 'Event timestamp ' || stamp || ' is in the future' END AS e_time,
    concat_ws('; ',
      CASE WHEN event_timestamp < as_of - INTERVAL 30 DAY THEN 'Event timestamp ' || stamp || ' is more than 30 days old' END,
      CASE WHEN age > 3600 THEN 'Event is ' || printf('%.1f', age / 3600.0) || ' hours old' END) AS w_time,
    concat_ws('; ',
      CASE WHEN signal_strength > 0 THEN 'Signal strength ' || CAST(signal_strength AS VARCHAR) || ' dBm cannot be positive' END,
      CASE WHEN signal_strength < -100 THEN 'Signal strength ' || CAST(signal_strength AS VARCHAR) || ' dBm is too weak (< -100 dBm)' END) AS e_signal,
    CASE WHEN signal_strength < -80 THEN 'Weak signal strength: ' || CAST(signal_strength AS VARCHAR) || ' dBm' END AS w_signal,
    concat_ws('; ',
      CASE WHEN length(badge_id) > 50 THEN 'badge_id exceeds maximum length of 50' END,
      CASE WHEN length(user_id) > 50 THEN 'user_id exceeds maximum length of 50' END,
      CASE WHEN length(zone_id) > 50 THEN 'zone_id exceeds maximum length of 50' END,
      CASE WHEN length(reader_id) > 50 THEN 'reader_id exceeds maximum length of 50' END) AS e_ids,
    CASE WHEN NOT regexp_matches(direction, '^(ENTRY|EXIT)$') THEN 'direction must be ENTRY or EXIT' END AS e_direction
  FROM (SELECT *,
          CAST(epoch_us(as_of) - epoch_us(event_timestamp) AS DOUBLE) / 1e6 AS age,
          CASE WHEN epoch_us(event_timestamp) % 1000000 = 0 THEN strftime(event_timestamp, '%Y-%m-%d %H:%M:%S')
               ELSE strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') END AS stamp
        FROM field, deadline)""",
    "checked": """
  SELECT event_id, event_timestamp, concat_ws('; ', nullif(e_required, ''), e_time, nullif(e_signal, ''), nullif(e_ids, ''), e_direction) AS errors,
    concat_ws('; ', nullif(w_time, ''), w_signal) AS warnings FROM ruled""",
    # -- versions --
    "changes": f"""
  SELECT {padded('USR-', 'c_custkey', 4)} AS user_id, c_name AS user_name, {USER_TYPE} AS user_type,
    c_mktsegment AS department, lower(replace(c_name, '#', '.')) || '@example.com' AS email,
    {padded('555-', 'c_custkey', 7)} AS phone,
    CASE WHEN n >= 12 THEN 'SECRET' WHEN n >= 9 THEN 'CONFIDENTIAL' ELSE 'PUBLIC' END AS clearance_level
  FROM customer JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
    "changed": """
  SELECT c.*, coalesce(e.created_timestamp, TIMESTAMP '2024-01-16') AS created_timestamp
  FROM changes c LEFT JOIN enrolled e ON e.user_id = c.user_id
  WHERE (c.user_name, c.user_type, c.department, c.email, c.phone, c.clearance_level)
    IS DISTINCT FROM (e.user_name, e.user_type, e.department, e.email, e.phone, e.clearance_level)""",
    "versions": f"""
  SELECT e.user_key, e.user_id, {COMMON.replace('user_name', 'e.user_name').replace(' user_type', ' e.user_type').replace(' department', ' e.department').replace(' email', ' e.email').replace(' phone', ' e.phone').replace(' clearance_level', ' e.clearance_level')},
    e.is_active, e.effective_start_date,
    CASE WHEN c.user_id IS NOT NULL THEN TIMESTAMP '2024-01-16' END AS effective_end_date,
    c.user_id IS NULL AS is_current, e.created_timestamp,
    CASE WHEN c.user_id IS NOT NULL THEN TIMESTAMP '2024-01-16' ELSE e.updated_timestamp END AS updated_timestamp
  FROM enrolled e LEFT JOIN changed c ON c.user_id = e.user_id
  UNION ALL
  SELECT (SELECT max(user_key) FROM enrolled) + row_number() OVER (ORDER BY substr(md5(user_id), 1, 3), user_id),
    user_id, {COMMON}, TRUE, TIMESTAMP '2024-01-16', NULL, TRUE, created_timestamp, TIMESTAMP '2024-01-16'
  FROM changed""",
    # -- hourly quality log --
    "hourly": """
  SELECT 'STAGE' AS table_schema, 'RAW_BADGE_EVENTS' AS table_name, * FROM (SELECT * FROM raw)
  UNION ALL SELECT 'TRANSFORM', 'STG_BADGE_EVENTS', * EXCLUDE (staging_time) FROM stg""",
    "measured": """
  SELECT table_schema, table_name, date_trunc('hour', ingestion_time) + INTERVAL 1 HOUR AS measurement_time,
    count(*) FILTER (WHERE direction IS NULL) AS v0, count(*) FILTER (WHERE trim(badge_id) = '') AS v1, count(*) AS v2,
    count(*) FILTER (WHERE signal_strength NOT BETWEEN -100 AND 0 AND signal_strength <> -999) AS v3,
    count(*) FILTER (WHERE event_timestamp > TIMESTAMP '2099-12-31') AS v4,
    count(*) FILTER (WHERE direction NOT IN ('ENTRY', 'EXIT')) AS v5
  FROM hourly GROUP BY ALL""",
    "dq": """
  SELECT measurement_time, 'BADGES' AS table_database, table_schema, table_name, data_metric_name, column_names, value,
    CASE WHEN NOT holds THEN expectation ELSE '' END AS expectation_violations, 'HOURLY' AS schedule_type, 'COMPLETED' AS status
  FROM (
    SELECT *, 'NULL_COUNT' AS data_metric_name, 'direction' AS column_names, v0 AS value, 'no_nulls' AS expectation, v0 = 0 AS holds FROM measured
    UNION ALL SELECT *, 'BLANK_COUNT', 'badge_id', v1, 'no_blanks', v1 = 0 FROM measured
    UNION ALL SELECT *, 'ROW_COUNT', '', v2, 'growing', v2 >= 10 FROM measured
    UNION ALL SELECT *, 'INVALID_SIGNAL_STRENGTH', 'signal_strength', v3, 'valid_signals', v3 = 0 FROM measured
    UNION ALL SELECT *, 'FUTURE_TIMESTAMPS', 'event_timestamp', v4, 'no_future', v4 = 0 FROM measured
    UNION ALL SELECT *, 'INVALID_DIRECTION', 'direction', v5, 'valid_directions', v5 < 3 FROM measured)""",
    "dqv": """
  SELECT measurement_time, 'BADGES.' || table_schema || '.' || table_name AS full_table_name, table_name, data_metric_name,
    column_names, value AS measurement_value, CAST(1 AS BIGINT) AS violation_count, expectation_violations
  FROM dq WHERE expectation_violations <> ''""",
    "suite_raw": """
  SELECT 'RAW_BADGE_EVENTS' AS table_name, m AS data_metric_name, c AS column_names, v AS value, CASE WHEN holds THEN '' ELSE x END AS expectation_violations
  FROM (
    SELECT 'NULL_COUNT' AS m, 'badge_id' AS c, 'no_nulls' AS x, count(*) FILTER (WHERE badge_id IS NULL) AS v, v = 0 AS holds FROM raw
    UNION ALL SELECT 'NULL_COUNT', 'user_id', 'no_nulls', count(*) FILTER (WHERE user_id IS NULL) AS v, v = 0 FROM raw
    UNION ALL SELECT 'NULL_COUNT', 'zone_id', 'no_nulls', count(*) FILTER (WHERE zone_id IS NULL) AS v, v = 0 FROM raw
    UNION ALL SELECT 'NULL_COUNT', 'event_timestamp', 'no_nulls', count(*) FILTER (WHERE event_timestamp IS NULL) AS v, v = 0 FROM raw
    UNION ALL SELECT 'BLANK_COUNT', 'badge_id', 'no_blanks', count(*) FILTER (WHERE trim(badge_id) = '') AS v, v = 0 FROM raw
    UNION ALL SELECT 'ROW_COUNT', '', 'growing', count(*) AS v, v >= 1000 FROM raw
    UNION ALL SELECT 'FRESHNESS', 'ingestion_time', 'fresh_data', date_diff('second', max(ingestion_time), any_value(as_of)) AS v, v <= 300 FROM raw, clock
    UNION ALL SELECT 'DUPLICATE_EVENTS', 'badge_id,event_timestamp', 'no_duplicates', count(*) AS v, v = 0
      FROM (SELECT 1 FROM raw GROUP BY badge_id, event_timestamp HAVING count(*) > 1)
    UNION ALL SELECT 'INVALID_SIGNAL_STRENGTH', 'signal_strength', 'valid_signals',
      count(*) FILTER (WHERE signal_strength NOT BETWEEN -100 AND 0 AND signal_strength <> -999) AS v, v = 0 FROM raw
    UNION ALL SELECT 'FUTURE_TIMESTAMPS', 'event_timestamp', 'no_future', count(*) FILTER (WHERE event_timestamp > TIMESTAMP '2099-12-31') AS v, v = 0 FROM raw
    UNION ALL SELECT 'INVALID_DIRECTION', 'direction', 'valid_directions', count(*) FILTER (WHERE direction NOT IN ('ENTRY', 'EXIT')) AS v, v = 0 FROM raw
    UNION ALL SELECT 'ABNORMAL_USER_ACTIVITY', 'user_id,event_timestamp', 'normal_activity', count(DISTINCT user_id) AS v, v < 5
      FROM (SELECT user_id FROM raw WHERE event_timestamp >= (SELECT max(event_timestamp) FROM raw) - INTERVAL 1 HOUR
            GROUP BY user_id, date_trunc('hour', event_timestamp) HAVING count(*) > 100))""",
    "suite_staging": """
  SELECT 'STG_BADGE_EVENTS' AS table_name, m AS data_metric_name, c AS column_names, v AS value, CASE WHEN holds THEN '' ELSE x END AS expectation_violations
  FROM (
    SELECT 'ROW_COUNT' AS m, '' AS c, 'data_exists' AS x, count(*) AS v, v > 0 AS holds FROM stg
    UNION ALL SELECT 'NULL_COUNT', 'signal_quality', 'quality_populated', count(*) FILTER (WHERE signal_quality IS NULL) AS v, v = 0 FROM stg)""",
    "suite_fact": """
  SELECT 'FCT_ACCESS_EVENTS' AS table_name, m AS data_metric_name, c AS column_names, v AS value, CASE WHEN holds THEN '' ELSE x END AS expectation_violations
  FROM (
    SELECT 'ROW_COUNT' AS m, '' AS c, '' AS x, count(*) AS v, TRUE AS holds FROM fct
    UNION ALL SELECT 'NULL_COUNT', 'user_key', 'valid_user_key', count(*) FILTER (WHERE user_key IS NULL) AS v, v = 0 FROM fct
    UNION ALL SELECT 'NULL_COUNT', 'zone_key', 'valid_zone_key', count(*) FILTER (WHERE zone_key IS NULL) AS v, v = 0 FROM fct
    UNION ALL SELECT 'FRESHNESS', 'event_timestamp', 'recent_data', date_diff('second', max(event_timestamp), any_value(as_of)) AS v, v <= 3600 FROM fct, clock)""",
    "hist": HIST + """
  FROM rlog WHERE scheduled_time >= (SELECT as_of FROM newest) - INTERVAL 24 HOUR""",
}

_NAMES = re.compile(r"\b(" + "|".join(CTES) + r")\b")


def _needs(text: str, seen: list[str]) -> list[str]:
    """Names of the CTEs a text uses, each after those it builds on."""
    for name in _NAMES.findall(text):
        if name not in seen:
            _needs(CTES[name].replace(f"AS {name}", ""), seen)
            if name not in seen:
                seen.append(name)
    return seen


def with_ctes(body: str) -> str:
    names = _needs(body, [])
    if not names:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names) + "\n" + body


FACT_OUT = """user_key, zone_key, badge_id, reader_id, event_timestamp, CAST(event_date AS VARCHAR) AS event_date,
  event_hour, event_day_of_week, direction, CAST(signal_strength AS DOUBLE) AS signal_strength, signal_quality,
  is_restricted_access, is_after_hours, is_weekend, ingestion_time, fact_load_time"""
RAW_OUT = """badge_id, user_id, zone_id, reader_id, event_timestamp, CAST(signal_strength AS DOUBLE) AS signal_strength,
  signal_quality, direction, ingestion_time"""
GIB = "1073741824.0"


def _fact_join(users: str, zones: str = "zones") -> str:
    return f"""SELECT u.user_key, z.zone_key, s.badge_id, s.reader_id, s.event_timestamp, {CALENDAR}, s.direction,
    s.signal_strength, s.signal_quality, z.is_restricted AS is_restricted_access, s.ingestion_time,
    s.staging_time + INTERVAL 1 MINUTE AS fact_load_time
  FROM stg s JOIN {users} u ON u.user_id = s.user_id JOIN {zones} z ON z.zone_id = s.zone_id"""


def _changed_users(which: str) -> str:
    return f"SELECT {padded('USR-', 'o_custkey', 4)} FROM orders WHERE {which}"


def _rebuilt(which: str, users: str = "") -> str:
    """Versions of the enrolled users and of those with such orders: gaps and islands."""
    user = padded("USR-", "c_custkey", 4)
    return f"""
  WITH dated AS (
    SELECT {user} AS user_id, c_name AS user_name, CAST(o_orderdate AS TIMESTAMP) AS t,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'SECRET' WHEN '2-HIGH' THEN 'CONFIDENTIAL' ELSE 'PUBLIC' END AS clearance_level
    FROM customer JOIN orders ON o_custkey = c_custkey WHERE {which}),
  points AS (
    SELECT user_id, user_name, t, max(clearance_level) AS clearance_level
    FROM (SELECT * FROM dated UNION ALL SELECT user_id, user_name, effective_start_date, clearance_level FROM enrolled)
    WHERE TRUE {users} GROUP BY ALL),
  islands AS (
    SELECT *, lag(clearance_level) OVER (PARTITION BY user_id ORDER BY t) AS before FROM points
    QUALIFY before IS DISTINCT FROM clearance_level)
  SELECT *, lead(t) OVER (PARTITION BY user_id ORDER BY t) AS until FROM islands"""


def _seeded(table: str, key: str, natural: str, columns: str, values: list[str]) -> str:
    rows = ",\n    ".join(values)
    return f"""SELECT * FROM {table} UNION ALL
SELECT {columns.replace('#key', f"(SELECT max({key}) FROM {table}) + row_number() OVER (ORDER BY substr(md5({natural}), 1, 3), {natural})")}
FROM (VALUES {rows}) AS seed({natural}, a, b, c, d, e, f, g, h, i, j) WHERE {natural} NOT IN (SELECT {natural} FROM {table})"""


SEED_USERS = _seeded(
    "enrolled", "user_key", "user_id",
    "#key, user_id, a, b, c, NULL, NULL, d, TRUE, TIMESTAMP '2024-01-01', NULL, TRUE, TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-01'",
    [
        "('USR-001', 'John Smith', 'EMPLOYEE', 'Engineering', 'CONFIDENTIAL', 0, 0, 0, 0, 0, 0)",
        "('USR-002', 'Jane Doe', 'EMPLOYEE', 'HR', 'PUBLIC', 0, 0, 0, 0, 0, 0)",
        "('USR-003', 'Bob Johnson', 'CONTRACTOR', 'IT Support', 'PUBLIC', 0, 0, 0, 0, 0, 0)",
        "('USR-004', 'Alice Williams', 'EMPLOYEE', 'Security', 'SECRET', 0, 0, 0, 0, 0, 0)",
        "('USR-005', 'Mike Davis', 'VISITOR', 'External', 'PUBLIC', 0, 0, 0, 0, 0, 0)",
    ],
)
SEED_ZONES = _seeded(
    "zones", "zone_key", "zone_id",
    "#key, zone_id, a, b, c, d, e, f, g, TRUE, h, i, j, NULL, NULL, TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-01'",
    [
        "('ZONE-LOBBY-1', 'RDR-101', 'Main Building', 1, 'Main Lobby', 'LOBBY', 100, NULL, FALSE, 'Main Entrance', 'BIDIRECTIONAL')",
        "('ZONE-OFFICE-2A', 'RDR-201', 'Main Building', 2, 'Engineering Office 2A', 'OFFICE', 30, 'CONFIDENTIAL', TRUE, 'Floor 2 East', 'ENTRY')",
        "('ZONE-SERVER-B1', 'RDR-B101', 'Main Building', -1, 'Server Room B1', 'SECURE_AREA', 5, 'SECRET', TRUE, 'Basement Security Door', 'BIDIRECTIONAL')",
        "('ZONE-CONF-3B', 'RDR-301', 'Main Building', 3, 'Conference Room 3B', 'CONFERENCE_ROOM', 20, NULL, FALSE, 'Floor 3 West', 'ENTRY')",
        "('ZONE-PARKING-1', 'RDR-P01', 'Parking Structure', 1, 'Employee Parking Level 1', 'PARKING', 200, NULL, FALSE, 'Garage Entry', 'ENTRY')",
    ],
)


def _rules(errors: str, warnings: str = "''") -> str:
    return f"SELECT event_id, {errors} AS errors, {warnings} AS warnings, {errors} = '' AS is_valid FROM ruled"


BODIES: dict[str, str] = {
    "pipe_transform": "SELECT *, TIMESTAMP '2024-02-01' AS ingestion_time FROM landed",
    "pipe_transform_fractional": f"""
SELECT badge_id, user_id, zone_id, reader_id, event_timestamp, CAST(coalesce(signal, -999) AS DOUBLE) AS signal_strength,
  {_quality('signal')} AS signal_quality, trim(upper(direction)) AS direction, TIMESTAMP '2024-02-01' AS ingestion_time
FROM judged WHERE reject_reasons = ''""",
    "pipe_rejects": "SELECT raw_json, reject_reasons, TIMESTAMP '2024-02-01' AS ingestion_time FROM judged WHERE reject_reasons <> ''",
    "signal_quality_class": f"""
SELECT event_id, CAST(copy AS BIGINT) AS copy, CAST(signal_strength AS DOUBLE) AS signal_strength,
  {_quality('signal_strength')} AS signal_quality FROM sent WHERE copy < 2""",
    "normalize_event_time": """
SELECT event_id, date_trunc('millisecond', CASE event_type WHEN 'click' THEN ts - INTERVAL 2 HOUR
    WHEN 'error' THEN ts + INTERVAL 330 MINUTE WHEN 'signup' THEN NULL ELSE ts END) AS event_timestamp FROM events""",
    "event_calendar": f"""
SELECT event_id, ts, CAST(event_date AS VARCHAR) AS event_date, event_hour, event_day_of_week, is_after_hours, is_weekend
FROM (SELECT event_id, ts, {CALENDAR.replace('event_timestamp', 'ts')} FROM events)""",
    "ingest_totals": """
SELECT events_sent, events_rejected, duration_seconds,
  round(CASE WHEN duration_seconds > 0 THEN CAST(events_sent AS DOUBLE) / duration_seconds ELSE 0 END, 6) AS events_per_second
FROM (SELECT count(*) FILTER (WHERE errors = '') AS events_sent, count(*) FILTER (WHERE errors <> '') AS events_rejected,
  CAST(epoch_us(max(event_timestamp)) - epoch_us(min(event_timestamp)) AS DOUBLE) / 1e6 AS duration_seconds FROM checked)""",
    "validate_required": _rules("e_required"),
    "validate_timestamp": _rules("coalesce(e_time, '')", "w_time"),
    "validate_signal": _rules("e_signal", "coalesce(w_signal, '')"),
    "validate_ids": _rules("e_ids"),
    "validate_direction": _rules("coalesce(e_direction, '')"),
    "validate_events": "SELECT event_id, errors, warnings, errors = '' AS is_valid FROM checked",
    "validate_events_strict": "SELECT event_id, errors, warnings, errors = '' AND warnings = '' AS is_valid FROM checked",
    "split_valid": """
SELECT event_id, CASE WHEN errors = '' THEN 'accepted' ELSE 'rejected' END AS verdict,
  CASE WHEN errors = '' THEN '' ELSE concat_ws('; ', errors, nullif(warnings, '')) END AS reasons FROM checked""",
    "cdc_insert_filter": f"SELECT {RAW_OUT}, 'INSERT' AS _action, reader_id = 'RDR-999' AS _is_update FROM raw",
    "dedup_latest": f"SELECT {RAW_OUT} FROM stg",
    "raw_to_staging": f"SELECT {RAW_OUT}, staging_time FROM stg",
    "pending_count": """
SELECT 'Stream Pending Records' AS check_type, count(*) AS pending_count FROM raw
WHERE ingestion_time >= (SELECT max(ingestion_time) FROM raw) - INTERVAL 1 DAY""",
    "pending_status": """
SELECT 'raw_badge_events_stream' AS stream_name, count(*) > 0 AS has_data FROM raw
WHERE ingestion_time >= (SELECT max(ingestion_time) FROM raw) - INTERVAL 1 DAY""",
    "seed_users": SEED_USERS,
    "seed_zones": SEED_ZONES,
    "unknown_users": "SELECT user_id, user_name, user_type, department, clearance_level FROM newm",
    "orphaned_users": """
SELECT user_id, count(*) AS orphaned_records FROM stg WHERE user_id NOT IN (SELECT user_id FROM enrolled) GROUP BY 1""",
    "dim_users_upsert": """
SELECT * FROM enrolled UNION ALL SELECT * REPLACE (TIMESTAMP '2024-01-16' AS effective_start_date,
  TIMESTAMP '2024-01-16' AS created_timestamp, TIMESTAMP '2024-01-16' AS updated_timestamp) FROM newm""",
    "scd2_apply": "SELECT * FROM versions",
    "scd2_rebuild": f"""
SELECT user_id, user_name, clearance_level, t AS effective_start_date, until AS effective_end_date, until IS NULL AS is_current
FROM ({_rebuilt('TRUE')})""",
    "snapshot_changes": f"""
SELECT * FROM (
WITH later AS (
  SELECT user_id, clearance_level, t AS effective_start_date, until AS effective_end_date, until IS NULL AS is_current
  FROM ({_rebuilt('o_orderkey % 5 = 0', 'AND user_id IN (SELECT user_id FROM dated)')})
  UNION ALL SELECT user_id, clearance_level, effective_start_date, effective_end_date, is_current FROM enrolled
  WHERE user_id NOT IN ({_changed_users('o_orderkey % 5 = 0')})),
was AS (SELECT user_id, clearance_level, effective_start_date, effective_end_date, is_current FROM enrolled),
came AS (SELECT * FROM later EXCEPT ALL SELECT * FROM was),
gone AS (SELECT * FROM was EXCEPT ALL SELECT * FROM later)
SELECT c.*, 'INSERT' AS _action, g.user_id IS NOT NULL AS _is_update
FROM came c LEFT JOIN gone g ON g.user_id = c.user_id AND g.effective_start_date = c.effective_start_date
UNION ALL SELECT g.*, 'DELETE', c.user_id IS NOT NULL
FROM gone g LEFT JOIN came c ON g.user_id = c.user_id AND g.effective_start_date = c.effective_start_date)""",
    "users_current": "SELECT * FROM versions WHERE is_current",
    "users_point_in_time": """
SELECT looked_up, user_id, user_key, clearance_level, is_current FROM versions,
  (VALUES ('before', TIMESTAMP '2024-01-10'), ('after', TIMESTAMP '2024-01-20')) AS points(looked_up, t)
WHERE effective_start_date <= t AND (effective_end_date IS NULL OR effective_end_date > t)""",
    "fact_as_of_users": """
SELECT s.badge_id, s.event_timestamp, v.user_key, v.user_name, v.clearance_level FROM stg s JOIN versions v
  ON v.user_id = s.user_id AND v.effective_start_date <= s.event_timestamp
  AND (v.effective_end_date IS NULL OR v.effective_end_date > s.event_timestamp)""",
    "masked_users": "SELECT user_key, user_id, '***@***' AS email, phone FROM enrolled",
    "fact_load": f"SELECT {FACT_OUT} FROM ({_fact_join('enrolled')})",
    "process_badge_events": f"SELECT {FACT_OUT} FROM fct",
    "fact_idempotent_load": f"SELECT {FACT_OUT} FROM fct WHERE event_timestamp >= TIMESTAMP '2024-01-16'",
    "late_dimension_replay": f"""
SELECT {FACT_OUT} FROM ({_fact_join('users', '''(
  SELECT (SELECT max(zone_key) FROM zones) + row_number() OVER (ORDER BY substr(md5(zone_id), 1, 3), zone_id) AS zone_key,
    zone_id, FALSE AS is_restricted
  FROM (SELECT DISTINCT zone_id FROM stg WHERE zone_id NOT IN (SELECT zone_id FROM zones)))''')})""",
    "event_keys": "SELECT count(*) AS facts, count(*) AS distinct_keys, CAST(0 AS BIGINT) AS bad_keys FROM fct",
    "fact_compact": f"SELECT {FACT_OUT} FROM fct",
    "ingest_stream": """
SELECT *, CAST(NULL AS VARCHAR) AS reject_reasons FROM landed
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, raw_json, reject_reasons FROM judged WHERE reject_reasons <> ''""",
    "stream_dedup": f"SELECT {RAW_OUT}, TIMESTAMP '2024-01-20' AS staging_time FROM stg",
    "cdc_incremental": """
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) FILTER (WHERE ingestion_time < TIMESTAMP '2024-01-16') AS rows_read FROM raw
UNION ALL SELECT 1, count(*) FILTER (WHERE ingestion_time >= TIMESTAMP '2024-01-16') FROM raw""",
    "stream_alerts": """
SELECT 'DUPLICATE_EVENTS' AS alert, badge_id AS subject, event_timestamp AS at FROM raw GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'ABNORMAL_ACTIVITY', user_id, date_trunc('hour', event_timestamp) FROM raw GROUP BY ALL HAVING count(*) > 2""",
    "pipeline_end_to_end": """
SELECT f.badge_id, f.event_timestamp, u.user_id, u.user_name, z.zone_name, CAST(f.event_date AS VARCHAR) AS event_date,
  f.event_hour, f.event_day_of_week, f.direction, CAST(f.signal_strength AS DOUBLE) AS signal_strength, f.signal_quality,
  f.is_restricted_access, f.is_after_hours, f.is_weekend
FROM fct f JOIN users u USING (user_key) JOIN zones z USING (zone_key)""",
    "dq_null_count": """
SELECT count(*) FILTER (WHERE badge_id IS NULL) AS null_badge_id, count(*) FILTER (WHERE user_id IS NULL) AS null_user_id,
  count(*) FILTER (WHERE zone_id IS NULL) AS null_zone_id, count(*) FILTER (WHERE event_timestamp IS NULL) AS null_event_timestamp,
  count(*) FILTER (WHERE direction IS NULL) AS null_direction FROM raw""",
    "dq_blank_count": """
SELECT count(*) FILTER (WHERE trim(badge_id) = '') AS blank_badge_id, count(*) FILTER (WHERE trim(user_id) = '') AS blank_user_id FROM field""",
    "dq_row_count": "SELECT count(*) AS value FROM raw",
    "dq_freshness": """
SELECT 'RAW_BADGE_EVENTS' AS table_name, date_diff('second', max(ingestion_time), (SELECT as_of FROM clock)) AS value FROM raw
UNION ALL SELECT 'FCT_ACCESS_EVENTS', date_diff('second', max(event_timestamp), (SELECT as_of FROM clock)) FROM fct""",
    "dq_duplicate_events": "SELECT count(*) AS value FROM (SELECT 1 FROM raw GROUP BY badge_id, event_timestamp HAVING count(*) > 1)",
    "dq_invalid_signal": "SELECT value FROM suite_raw WHERE data_metric_name = 'INVALID_SIGNAL_STRENGTH'",
    "dq_future_timestamps": "SELECT value FROM suite_raw WHERE data_metric_name = 'FUTURE_TIMESTAMPS'",
    "dq_invalid_direction": "SELECT value FROM suite_raw WHERE data_metric_name = 'INVALID_DIRECTION'",
    "dq_abnormal_activity": """
SELECT CAST(t AS BIGINT) AS more_than, (SELECT count(DISTINCT user_id) FROM (
    SELECT user_id, count(*) AS n FROM raw WHERE event_timestamp >= (SELECT max(event_timestamp) FROM raw) - INTERVAL 1 HOUR
    GROUP BY user_id, date_trunc('hour', event_timestamp)) WHERE n > t) AS value FROM (VALUES (100), (1)) AS limits(t)""",
    "dq_orphaned_facts": """
SELECT count(*) AS value FROM fct WHERE user_key NOT IN (SELECT user_key FROM enrolled) OR zone_key NOT IN (SELECT zone_key FROM zones)""",
    "dq_suite_raw": "SELECT *, (SELECT as_of FROM clock) AS measurement_time FROM suite_raw",
    "dq_suite_staging": "SELECT * FROM suite_staging",
    "dq_suite_fact": "SELECT * FROM suite_fact",
    "dq_expectations": "SELECT measurement_time, table_name, data_metric_name, value, expectation_violations FROM dq",
    "dq_run": "SELECT * FROM suite_raw UNION ALL SELECT * FROM suite_staging UNION ALL SELECT * FROM suite_fact",
    "dq_dashboard": "SELECT * RENAME (value AS measurement_value) FROM dq",
    "dq_violations": "SELECT * FROM dqv",
    "dq_quality_scores": """
SELECT 'BADGES.' || table_schema || '.' || table_name AS full_table_name, count(*) AS total_measurements,
  count(*) FILTER (WHERE expectation_violations = '') AS passed_checks,
  round(CAST(100.0 * count(*) FILTER (WHERE expectation_violations = '') AS DOUBLE) / count(*), 2) AS quality_score_pct,
  max(measurement_time) AS last_measured
FROM dq WHERE measurement_time >= (SELECT max(measurement_time) FROM dq) - INTERVAL 7 DAY GROUP BY 1""",
    "dq_violation_trends": """
SELECT date_trunc('hour', measurement_time) AS measurement_hour, table_name, data_metric_name, count(*) AS violation_count
FROM dqv WHERE measurement_time >= (SELECT max(measurement_time) FROM dq) - INTERVAL 1 DAY GROUP BY ALL""",
    "dq_alert_log": """
SELECT m.t AS alert_time, table_name, data_metric_name, column_names, measurement_value AS value, expectation_violations
FROM dqv, (SELECT max(measurement_time) AS t FROM dq) m WHERE measurement_time >= m.t - INTERVAL 5 MINUTE""",
    "ingestion_metrics": """
SELECT date_trunc('hour', ingestion_time) AS ingestion_hour, count(*) AS event_count, count(DISTINCT badge_id) AS unique_badges,
  count(DISTINCT zone_id) AS unique_zones, round(CAST(sum(signal_strength) AS DOUBLE) / count(signal_strength), 2) AS avg_signal_strength,
  count(*) FILTER (WHERE signal_quality = 'WEAK') AS weak_signal_count, count(*) FILTER (WHERE direction = 'ENTRY') AS entry_count,
  count(*) FILTER (WHERE direction = 'EXIT') AS exit_count, CAST(count(*) AS DOUBLE) / 3600.0 AS events_per_second,
  round(CAST(100.0 * count(*) FILTER (WHERE signal_quality = 'WEAK') AS DOUBLE) / count(*), 2) AS weak_signal_pct,
  count(*) FILTER (WHERE direction = 'ENTRY') - count(*) FILTER (WHERE direction = 'EXIT') AS net_occupancy_change
FROM raw WHERE ingestion_time >= (SELECT as_of FROM clock) - INTERVAL 1 DAY GROUP BY 1""",
    "hourly_rollup": """
SELECT date_trunc('hour', ingestion_time) AS ingestion_hour, count(*) AS event_count, count(DISTINCT badge_id) AS unique_badges,
  count(DISTINCT zone_id) AS unique_zones, round(CAST(sum(signal_strength) AS DOUBLE) / count(signal_strength), 2) AS avg_signal_strength,
  count(*) FILTER (WHERE signal_quality = 'WEAK') AS weak_signal_count, count(*) FILTER (WHERE direction = 'ENTRY') AS entry_count,
  count(*) FILTER (WHERE direction = 'EXIT') AS exit_count FROM raw GROUP BY 1""",
    "pipeline_latency": """
SELECT *, CASE WHEN seconds_since_update > 300 THEN 'STALE' WHEN seconds_since_update > 120 THEN 'WARNING' ELSE 'HEALTHY' END AS health_status
FROM (SELECT layer, last_update, row_count, date_diff('second', last_update, (SELECT as_of FROM clock)) AS seconds_since_update FROM (
  SELECT 'RAW' AS layer, max(ingestion_time) AS last_update, count(*) AS row_count FROM raw WHERE ingestion_time >= (SELECT as_of FROM clock) - INTERVAL 1 HOUR
  UNION ALL SELECT 'STAGING', max(staging_time), count(*) FROM stg WHERE staging_time >= (SELECT as_of FROM clock) - INTERVAL 1 HOUR
  UNION ALL SELECT 'ANALYTICS', max(fact_load_time), count(*) FROM fct WHERE fact_load_time >= (SELECT as_of FROM clock) - INTERVAL 1 HOUR))""",
    "data_freshness": """
SELECT *, date_diff('second', last_event_timestamp, (SELECT as_of FROM clock)) AS event_age_seconds,
  date_diff('second', last_ingestion_timestamp, (SELECT as_of FROM clock)) AS ingestion_age_seconds FROM (
  SELECT 'RAW_BADGE_EVENTS' AS table_name, max(event_timestamp) AS last_event_timestamp, max(ingestion_time) AS last_ingestion_timestamp,
    count(*) AS total_rows, count(*) FILTER (WHERE ingestion_time >= (SELECT as_of FROM clock) - INTERVAL 1 HOUR) AS rows_last_hour FROM raw
  UNION ALL SELECT 'FCT_ACCESS_EVENTS', max(event_timestamp), max(fact_load_time), count(*),
    count(*) FILTER (WHERE fact_load_time >= (SELECT as_of FROM clock) - INTERVAL 1 HOUR) FROM fct)""",
    "channel_status": f"""
SELECT channel_name, pipe_name, max(server_timestamp) AS last_ingestion_time, CAST(sum(rows_inserted) AS BIGINT) AS total_rows_inserted,
  CAST(sum(bytes_inserted) AS DOUBLE) / {GIB} AS total_gb_inserted, count(DISTINCT server_timestamp) AS active_minutes_last_hour,
  round(CAST(sum(rows_inserted) AS DOUBLE) / count(*), 6) AS avg_rows_per_insert, max(rows_inserted) AS max_rows_per_insert,
  date_diff('second', max(server_timestamp), (SELECT as_of FROM newest)) AS seconds_since_last_ingestion
FROM ilog WHERE server_timestamp >= (SELECT as_of FROM newest) - INTERVAL 1 HOUR GROUP BY 1, 2""",
    "streaming_costs": f"""
SELECT *, gb_ingested_uncompressed * CAST(0.01 AS DOUBLE) AS estimated_credits, round(rows_ingested / nullif(gb_ingested_uncompressed, 0), 0) AS rows_per_gb
FROM (SELECT CAST(CAST(server_timestamp AS DATE) AS VARCHAR) AS ingestion_date, CAST(sum(bytes_inserted) AS DOUBLE) / {GIB} AS gb_ingested_uncompressed,
  CAST(sum(rows_inserted) AS BIGINT) AS rows_ingested
  FROM ilog WHERE server_timestamp >= (SELECT as_of FROM newest) - INTERVAL 30 DAY GROUP BY 1)""",
    "streaming_cost_total": f"""
SELECT CAST(sum(bytes_inserted) AS DOUBLE) / {GIB} * CAST(0.01 AS DOUBLE) AS total_credits_last_30_days
FROM ilog WHERE server_timestamp >= (SELECT as_of FROM newest) - INTERVAL 30 DAY""",
    "ingest_error_rate": """
SELECT *, coalesce(error_pct < 0.1, TRUE) AS within_target FROM (
  SELECT channel_name, CAST(sum(rows_parsed) AS BIGINT) AS rows_parsed, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
    CAST(sum(rows_error_count) AS BIGINT) AS rows_error_count,
    max_by(last_error_message, server_timestamp) FILTER (WHERE last_error_message IS NOT NULL) AS last_error_message,
    round(100.0 * CAST(sum(rows_error_count) AS DOUBLE) / sum(rows_parsed), 4) AS error_pct
  FROM ilog WHERE server_timestamp >= (SELECT as_of FROM newest) - INTERVAL 1 DAY GROUP BY 1)""",
    "pipe_volume": f"""
SELECT pipe_name, CAST(sum(bytes_inserted) AS DOUBLE) / {GIB} AS gb_ingested, CAST(sum(rows_inserted) AS BIGINT) AS total_rows
FROM ilog WHERE server_timestamp >= (SELECT as_of FROM newest) - INTERVAL 7 DAY GROUP BY 1""",
    "task_history": HIST + " FROM rlog WHERE scheduled_time >= (SELECT as_of FROM newest) - INTERVAL 72 HOUR",
    "task_durations": """
SELECT task_name, count(*) AS executions, round(CAST(sum(duration_seconds) AS DOUBLE) / count(*), 6) AS avg_duration
FROM hist WHERE execution_status = 'SUCCESS' GROUP BY 1""",
    "task_success_rate": """
SELECT name, count(*) AS total_runs, count(*) FILTER (WHERE state = 'SUCCEEDED') AS successful, count(*) FILTER (WHERE state = 'FAILED') AS failed,
  round(CAST(100.0 * count(*) FILTER (WHERE state = 'SUCCEEDED') AS DOUBLE) / count(*), 2) AS success_pct
FROM rlog WHERE scheduled_time >= (SELECT as_of FROM newest) - INTERVAL 1 DAY GROUP BY 1""",
    "task_failures": "SELECT name, error_code, error_message, scheduled_time FROM rlog WHERE state = 'FAILED'",
    "partition_efficiency": f"""
SELECT table_name, count(*) AS query_count, round(CAST(sum(pct) AS DOUBLE) / count(*), 2) AS avg_scan_ratio_pct,
  CAST(min(pct) AS DOUBLE) AS best_scan_ratio_pct, CAST(max(pct) AS DOUBLE) AS worst_scan_ratio_pct,
  round(CAST(sum(bytes_scanned) AS DOUBLE) / {GIB} / count(*), 2) AS avg_gb_scanned,
  CASE WHEN CAST(sum(pct) AS DOUBLE) / count(*) < 20 THEN 'EXCELLENT' WHEN CAST(sum(pct) AS DOUBLE) / count(*) < 50 THEN 'GOOD'
    WHEN CAST(sum(pct) AS DOUBLE) / count(*) < 80 THEN 'FAIR' ELSE 'POOR' END AS pruning_efficiency
FROM (SELECT *, CAST(round(CAST(100 * partitions_scanned AS DOUBLE) / partitions_total, 2) AS DECIMAL(9,2)) AS pct FROM scanlog
  WHERE partitions_total > 0 AND table_name IN ('RAW_BADGE_EVENTS', 'FCT_ACCESS_EVENTS')
    AND start_time >= (SELECT max(start_time) FROM scanlog) - INTERVAL 1 DAY) GROUP BY 1""",
    "layer_counts": """
SELECT 'RAW_BADGE_EVENTS' AS layer, count(*) AS row_count FROM raw UNION ALL SELECT 'STG_BADGE_EVENTS', count(*) FROM stg
UNION ALL SELECT 'FCT_ACCESS_EVENTS', count(*) FROM fct""",
    "layer_count_diff": """
SELECT layer, cnt, lag(cnt) OVER (ORDER BY layer) - cnt AS difference FROM (
  SELECT 'RAW' AS layer, count(*) AS cnt FROM raw UNION ALL SELECT 'STAGING', count(*) FROM stg
  UNION ALL SELECT 'ANALYTICS', count(*) FROM fct)""",
    "dim_user_summary": """
SELECT 'DIM_USERS' AS dimension_name, count(*) AS total_users, count(*) FILTER (WHERE user_name = 'UNKNOWN') AS auto_created_users,
  count(*) FILTER (WHERE user_name <> 'UNKNOWN') AS seed_users FROM users WHERE is_current""",
    "auto_created_users": """
SELECT 'Sample Auto-Created Users' AS check_type, user_id, user_name, clearance_level, created_timestamp
FROM users WHERE user_name = 'UNKNOWN' AND is_current ORDER BY user_id LIMIT 5""",
    "fact_date_range": """
SELECT 'FCT_ACCESS_EVENTS' AS table_name, count(*) AS total_events, CAST(min(event_date) AS VARCHAR) AS earliest_date,
  CAST(max(event_date) AS VARCHAR) AS latest_date, min(event_timestamp) AS earliest_timestamp, max(event_timestamp) AS latest_timestamp FROM fct""",
    "events_by_date": """
SELECT CAST(event_date AS VARCHAR) AS event_date, count(*) AS event_count, count(DISTINCT badge_id) AS unique_badges,
  count(DISTINCT zone_key) AS unique_zones FROM fct GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
    "direction_distribution": """
SELECT direction, count(*) AS event_count, round(CAST(100.0 * count(*) AS DOUBLE) / sum(count(*)) OVER (), 2) AS percentage FROM fct GROUP BY 1""",
    "signal_quality_distribution": """
SELECT signal_quality, count(*) AS event_count, round(CAST(sum(signal_strength) AS DOUBLE) / count(*), 2) AS avg_signal_strength FROM fct GROUP BY 1""",
    "signal_quality_known": """
SELECT signal_quality, count(*) AS event_count,
  round(CAST(sum(nullif(signal_strength, -999)) AS DOUBLE) / count(nullif(signal_strength, -999)), 2) AS avg_signal_strength FROM fct GROUP BY 1""",
    "flag_shares": """
SELECT category, event_count, round(CAST(100.0 * event_count AS DOUBLE) / (SELECT count(*) FROM fct), 2) AS percentage FROM (
  SELECT 'After-Hours Events' AS category, count(*) AS event_count FROM fct WHERE is_after_hours
  UNION ALL SELECT 'Weekend Events', count(*) FROM fct WHERE is_weekend
  UNION ALL SELECT 'Restricted Access Events', count(*) FROM fct WHERE is_restricted_access)""",
    "top_zones": """
SELECT z.zone_name, z.zone_type, count(*) AS access_count FROM fct f JOIN zones z ON f.zone_key = z.zone_key
GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 5""",
    "top_badges": """
SELECT f.badge_id, u.user_name, u.user_type, count(*) AS access_count FROM fct f JOIN users u ON f.user_key = u.user_key
GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1, 2, 3 LIMIT 5""",
    "fact_completeness": """
SELECT 'Completeness Check' AS check_type, count(*) AS total_records, count(*) FILTER (WHERE badge_id IS NULL) AS null_badge_id,
  count(*) FILTER (WHERE user_key IS NULL) AS null_user_key, count(*) FILTER (WHERE zone_key IS NULL) AS null_zone_key,
  count(*) FILTER (WHERE event_timestamp IS NULL) AS null_timestamp, count(*) FILTER (WHERE direction IS NULL) AS null_direction FROM fct""",
    "ingestion_latency": """
SELECT 'Ingestion Latency' AS metric, min(s) AS min_latency_sec, max(s) AS max_latency_sec,
  round(CAST(sum(s) AS DOUBLE) / count(*), 6) AS avg_latency_sec, CAST(median(s) AS DOUBLE) AS median_latency_sec
FROM (SELECT date_diff('second', ingestion_time, fact_load_time) AS s FROM fct)""",
    "pipeline_verdict": """
SELECT *, counts_match AND stream_empty AND no_failed_tasks AND latency_ok AS pipeline_ok FROM (
  SELECT staged_until, (SELECT count(*) FROM raw) = (SELECT count(*) FROM stg) AND (SELECT count(*) FROM stg) = (SELECT count(*) FROM fct) AS counts_match,
    (SELECT count(*) FROM raw WHERE ingestion_time >= until) = 0 AS stream_empty, (SELECT count(*) FROM rlog WHERE state = 'FAILED') = 0 AS no_failed_tasks,
    (SELECT max(date_diff('second', ingestion_time, fact_load_time)) FROM fct) < 120 AS latency_ok
  FROM (SELECT 'now' AS staged_until, as_of AS until FROM clock UNION ALL SELECT 'yesterday', as_of - INTERVAL 24 HOUR FROM clock))""",
    "events_in_range": f"SELECT {FACT_OUT} FROM fct WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'",
    "user_access_history": f"""
SELECT {FACT_OUT}, user_name, zone_name FROM (SELECT f.*, u.user_name, z.zone_name FROM fct f JOIN users u ON u.user_key = f.user_key
  JOIN zones z ON z.zone_key = f.zone_key)
WHERE badge_id = (SELECT badge_id FROM fct ORDER BY event_timestamp DESC, badge_id DESC LIMIT 1) AND event_date >= (SELECT day FROM today) - 7""",
    "zone_entries": """
SELECT zone_key, count(*) AS entry_count FROM fct WHERE event_date = (SELECT day FROM today) AND direction = 'ENTRY' GROUP BY 1""",
    "after_hours_alerts": f"""
SELECT {FACT_OUT} FROM fct WHERE is_after_hours AND is_restricted_access AND event_date = (SELECT day FROM today)""",
    "after_hours_restricted": """
SELECT u.user_name, z.zone_name, f.event_timestamp, f.signal_quality FROM fct f JOIN users u ON u.user_key = f.user_key AND u.is_current
  JOIN zones z ON z.zone_key = f.zone_key WHERE f.is_after_hours AND f.is_restricted_access AND f.event_date = (SELECT day FROM today)""",
    "daily_zone_access": """
SELECT z.zone_name, CAST(f.event_date AS VARCHAR) AS event_date, count(*) AS access_count, count(*) FILTER (WHERE f.direction = 'ENTRY') AS entries,
  count(*) FILTER (WHERE f.direction = 'EXIT') AS exits
FROM fct f JOIN zones z ON z.zone_key = f.zone_key WHERE f.event_date >= (SELECT day FROM today) - 7 GROUP BY 1, 2""",
    "recent_events": """
(SELECT 'RAW' AS layer, badge_id, reader_id, event_timestamp, signal_quality FROM raw ORDER BY ingestion_time DESC, badge_id, event_timestamp, reader_id LIMIT 10)
UNION ALL
(SELECT 'STAGING', badge_id, reader_id, event_timestamp, signal_quality FROM stg ORDER BY staging_time DESC, badge_id, event_timestamp, reader_id LIMIT 10)
UNION ALL
(SELECT 'ANALYTICS', badge_id, reader_id, event_timestamp, signal_quality FROM fct ORDER BY fact_load_time DESC, badge_id, event_timestamp, reader_id LIMIT 10)""",
}

for _key, _hours in (("credit_usage", 2), ("credit_usage_week", 168)):
    BODIES[_key] = f"""
SELECT warehouse_name, CAST(sum(credits_used) AS DOUBLE) AS total_credits, count(*) AS execution_count,
  round(CAST(sum(credits_used) AS DOUBLE) / count(*), 4) AS avg_credits_per_run
FROM meter WHERE warehouse_name = 'ETL_WH' AND start_time >= (SELECT max(start_time) FROM meter) - INTERVAL {_hours} HOUR GROUP BY 1"""


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in BODIES.items()}
