"""DuckDB SQL for every ``queries()`` key of ``__spark_entry__``.

The views ``region nation customer supplier part orders lineitem events ...``
are registered by the caller. ``BASE`` derives the raw and staged factory
tables with the same expressions as ``forgeline.sources.testbind``; each
query adds its own CTEs and a final SELECT. Where the Spark operator uses a
distributed formulation (gap ranges, range-partitioned next-row pairing),
the SQL here is the plain brute-force statement of the same question.
"""

from __future__ import annotations

TS = "'%Y-%m-%dT%H:%M:%S'"
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
AS_OF_DATE = "DATE '2024-01-31'"


def _norm(c: str) -> str:
    return f"trim(lower({c}), ' ')"


BASE = f"""
raw_machines AS (
  SELECT 'mach_' || printf('%05d', s_suppkey) AS machine_id,
         'fac_' || printf('%02d', s_nationkey) AS factory_id,
         lower(r_name) AS machine_type,
         strftime(DATE '2020-01-01' + CAST(s_suppkey AS INTEGER), '%Y-%m-%d') AS install_date,
         CASE WHEN s_acctbal < 0 THEN 'maintenance' ELSE 'active' END AS status
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
raw_telemetry AS (
  SELECT 'evt_' || printf('%06d', event_id) AS event_id,
         'mach_' || printf('%05d', user_id) AS machine_id,
         'fac_' || printf('%02d', user_id % 25) AS factory_id,
         strftime(ts, {TS}) AS timestamp,
         CAST(68.0 AS DOUBLE) + value * CAST(0.125 AS DOUBLE) AS temperature_c,
         CAST(json_extract_string(props, '$.k') AS INTEGER) * CAST(0.05859375 AS DOUBLE) AS vibration_mm_s,
         value * CAST(0.5 AS DOUBLE) AS power_kw,
         CASE event_type WHEN 'purchase' THEN 'Idle' WHEN 'signup' THEN 'OFF '
                         WHEN 'error' THEN 'error' ELSE 'running' END AS status,
         '0' AS _batch_id
  FROM events
  UNION ALL
  SELECT 'evt_' || printf('%06d', event_id),
         ' MACH_' || printf('%05d', user_id) || ' ',
         'fac_' || printf('%02d', user_id % 25),
         strftime(ts, {TS}),
         CAST(69.0 AS DOUBLE) + value * CAST(0.125 AS DOUBLE),
         CAST(json_extract_string(props, '$.k') AS INTEGER) * CAST(0.05859375 AS DOUBLE),
         value * CAST(0.5 AS DOUBLE),
         'ERROR',
         '1'
  FROM events WHERE event_type = 'error'
),
raw_production AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS date,
         'mach_' || printf('%05d', l_suppkey) AS machine_id,
         l_returnflag AS shift,
         CAST(l_quantity AS BIGINT) AS units_produced,
         (CAST(l_quantity AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT)) // 80 AS scrap_units,
         'op_' || printf('%03d', l_partkey % 40) AS operator_id
  FROM lineitem
),
raw_maintenance AS (
  SELECT 'mnt_' || CAST(o_orderkey AS VARCHAR) AS maintenance_id,
         'mach_' || printf('%05d', o_custkey // 14) AS machine_id,
         strftime(o_orderdate, {TS}) AS timestamp,
         replace(substr(o_orderpriority, 3), ' ', '_') AS maintenance_type,
         CASE o_orderstatus WHEN 'O' THEN 'none' WHEN 'F' THEN 'bearing' WHEN 'P' THEN 'motor' END
           AS part_replaced,
         CAST(floor(o_totalprice) AS BIGINT) % 125 - 5 AS downtime_minutes
  FROM orders
),
stg_telemetry AS (
  SELECT event_id, machine_id, factory_id, timestamp, temperature_c, vibration_mm_s, power_kw, status
  FROM (
    SELECT event_id, {_norm('machine_id')} AS machine_id, {_norm('factory_id')} AS factory_id,
           strptime(timestamp, {TS}) AS timestamp, temperature_c, vibration_mm_s, power_kw,
           {_norm('status')} AS status,
           row_number() OVER (PARTITION BY event_id ORDER BY _batch_id DESC) AS rn
    FROM raw_telemetry) WHERE rn = 1
),
stg_machines AS (
  SELECT {_norm('machine_id')} AS machine_id, {_norm('factory_id')} AS factory_id,
         {_norm('machine_type')} AS machine_type,
         CAST(strptime(install_date, '%Y-%m-%d') AS DATE) AS install_date, {_norm('status')} AS status
  FROM raw_machines
),
stg_maintenance AS (
  SELECT maintenance_id, {_norm('machine_id')} AS machine_id, strptime(timestamp, {TS}) AS timestamp,
         {_norm('maintenance_type')} AS maintenance_type, {_norm('part_replaced')} AS part_replaced,
         greatest(downtime_minutes, 0) AS downtime_minutes
  FROM raw_maintenance
),
stg_production AS (
  SELECT CAST(strptime(date, '%Y-%m-%d') AS DATE) AS date, {_norm('machine_id')} AS machine_id,
         {_norm('shift')} AS shift, greatest(units_produced, 0) AS units_produced,
         greatest(scrap_units, 0) AS scrap_units, {_norm('operator_id')} AS operator_id
  FROM raw_production
),
dim AS (SELECT machine_id AS mid, factory_id AS dim_factory_id, machine_type AS dim_machine_type FROM stg_machines),
fact_machine_events AS (
  SELECT t.*, dim_machine_type AS machine_type FROM stg_telemetry t LEFT JOIN dim ON t.machine_id = dim.mid
),
fact_production AS (
  SELECT p.*, dim_factory_id AS factory_id,
         CAST(scrap_units AS DOUBLE) / greatest(CAST(units_produced AS DOUBLE), CAST(1.0 AS DOUBLE)) AS scrap_rate
  FROM stg_production p LEFT JOIN dim ON p.machine_id = dim.mid
),
fact_maintenance AS (
  SELECT m.*, dim_factory_id AS factory_id, dim_machine_type AS machine_type
  FROM stg_maintenance m LEFT JOIN dim ON m.machine_id = dim.mid
),
fact_downtime AS (
  SELECT m.*, dim_factory_id AS factory_id
  FROM stg_maintenance m LEFT JOIN dim ON m.machine_id = dim.mid WHERE m.downtime_minutes > 0
),
health AS (
  SELECT machine_id,
    round(avg(temperature_c) + 1e-10, 8) AS avg_temperature_c,
    max(temperature_c) AS max_temperature_c,
    round(avg(vibration_mm_s) + 1e-10, 8) AS avg_vibration_mm_s,
    max(vibration_mm_s) AS max_vibration_mm_s,
    round(avg(power_kw) + 1e-10, 8) AS avg_power_kw,
    count(event_id) AS event_count
  FROM stg_telemetry GROUP BY machine_id
),
factory_metrics AS (
  SELECT factory_id, CAST(sum(downtime_minutes) AS BIGINT) AS total_downtime_minutes,
         avg(downtime_minutes) AS avg_downtime_minutes, count(downtime_minutes) AS downtime_event_count,
         max(downtime_minutes) AS max_single_downtime_minutes
  FROM fact_downtime GROUP BY factory_id
),
scrap AS (
  SELECT machine_id, total_units_produced, total_scrap_units,
         CAST(total_scrap_units AS DOUBLE) / greatest(CAST(total_units_produced AS DOUBLE), CAST(1.0 AS DOUBLE))
           AS scrap_rate
  FROM (SELECT machine_id, CAST(sum(units_produced) AS BIGINT) AS total_units_produced,
               CAST(sum(scrap_units) AS BIGINT) AS total_scrap_units
        FROM stg_production GROUP BY machine_id)
),
effectiveness AS (
  SELECT maintenance_type, avg(downtime_minutes) AS avg_downtime_minutes,
         CAST(sum(downtime_minutes) AS BIGINT) AS total_downtime_minutes, count(downtime_minutes) AS event_count
  FROM stg_maintenance GROUP BY maintenance_type
),
latest AS (SELECT machine_id, max(timestamp) AS last_event FROM stg_telemetry GROUP BY machine_id),
status AS (
  SELECT machine_id, last_event, round(h, 1) AS hours_since,
         CASE WHEN last_event IS NULL THEN 'no_data' WHEN h > 1.0 THEN 'silent' ELSE 'active' END AS status
  FROM (SELECT m.machine_id, l.last_event,
               CAST(date_diff('microsecond', l.last_event, {AS_OF}) AS DOUBLE) / CAST(3600000000 AS DOUBLE) AS h
        FROM stg_machines m LEFT JOIN latest l ON m.machine_id IS NOT DISTINCT FROM l.machine_id)
),
silence_items AS (
  SELECT machine_id, last_event, round(h, 1) AS hours_since
  FROM (SELECT m.machine_id, l.last_event,
               CAST(date_diff('microsecond', l.last_event, {AS_OF}) AS DOUBLE) / CAST(3600000000 AS DOUBLE) AS h
        FROM (SELECT DISTINCT machine_id FROM stg_machines) m
        LEFT JOIN latest l ON m.machine_id IS NOT DISTINCT FROM l.machine_id)
  WHERE last_event IS NULL OR h > 1.0
),
temp_items AS (
  SELECT machine_id, round(max_temperature_c, 1) AS max_temperature_c,
         round(avg_temperature_c, 1) AS avg_temperature_c
  FROM health WHERE max_temperature_c > 85.0
),
scrap_items AS (
  SELECT machine_id, round(scrap_rate, 4) AS scrap_rate, total_units_produced AS total_units,
         total_scrap_units AS total_scrap
  FROM scrap WHERE scrap_rate > 0.05
),
state AS (
  SELECT 'maintenance_logs' AS source, max(timestamp) AS mark FROM raw_maintenance
  UNION ALL SELECT 'production', max(date) FROM raw_production
),
late AS (
  SELECT 'late_data' AS alert_type, 'warning' AS severity,
         'Maintenance data is ' || CAST(CAST(round(h, 1) AS DECIMAL(20,1)) AS VARCHAR)
           || 'h old (threshold: 2.0h)' AS message,
         CAST(1 AS BIGINT) AS item_count, 'maintenance' AS source, mark AS last_watermark, round(h, 1) AS age
  FROM (SELECT mark, CAST(date_diff('microsecond', CAST(mark AS TIMESTAMP), {AS_OF}) AS DOUBLE)
                       / CAST(3600000000 AS DOUBLE) AS h
        FROM state WHERE source = 'maintenance_logs' AND coalesce(mark, '') <> '')
  WHERE h > 2.0
  UNION ALL
  SELECT 'late_data', CASE WHEN d <= 1 THEN 'info' ELSE 'warning' END,
         'Production data is ' || CAST(d AS VARCHAR) || ' day(s) behind',
         CAST(1 AS BIGINT), 'production', mark, CAST(d AS DOUBLE)
  FROM (SELECT mark, date_diff('day', CAST(mark AS DATE), {AS_OF_DATE}) AS d
        FROM state WHERE source = 'production' AND coalesce(mark, '') <> '')
  WHERE d > 0
),
failed_runs AS (
  SELECT ts AS timestamp, event_type AS step, 'failure' AS status FROM events
  WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-30 00:00:00'
),
alert_report AS (
  SELECT 'telemetry_silence' AS alert_type, 'warning' AS severity,
         CAST(n AS VARCHAR) || ' machine(s) have not sent telemetry in 1.0h' AS message,
         n AS item_count, 0 AS alert_order
  FROM (SELECT count(*) AS n FROM silence_items) WHERE n > 0
  UNION ALL
  SELECT 'temperature_exceedance', CASE WHEN c THEN 'critical' ELSE 'warning' END,
         CAST(n AS VARCHAR) || ' machine(s) exceeded 85.0°C temperature threshold', n, 1
  FROM (SELECT count(*) AS n, bool_or(max_temperature_c > 95.0) AS c FROM temp_items) WHERE n > 0
  UNION ALL
  SELECT 'scrap_rate_spike', 'warning', CAST(n AS VARCHAR) || ' machine(s) exceed 5% scrap rate threshold', n, 2
  FROM (SELECT count(*) AS n FROM scrap_items) WHERE n > 0
  UNION ALL
  SELECT alert_type, severity, message, item_count, 3 FROM late
  UNION ALL
  SELECT 'pipeline_failure', 'critical', CAST(n AS VARCHAR) || ' pipeline step(s) failed in the last 24h', n, 4
  FROM (SELECT count(*) AS n FROM failed_runs) WHERE n > 0
),
alert_totals AS (
  SELECT count(*) AS total_alerts, count(*) FILTER (WHERE severity = 'critical') AS critical,
         count(*) FILTER (WHERE severity = 'warning') AS warnings
  FROM alert_report
),
nums AS (
  SELECT CAST(replace(event_id, 'evt_', '') AS BIGINT) AS n FROM stg_telemetry
  WHERE event_id IS NOT NULL AND event_id <> ''
),
gap_stats AS (
  SELECT count(n) AS cnt, min(n) AS lo, max(n) AS hi, count(DISTINCT n) AS dn FROM nums
),
gap_sample AS (
  SELECT min(n) AS s_lo, max(n) AS s_hi FROM (
    SELECT g.n FROM (SELECT unnest(generate_series(lo, hi)) AS n FROM gap_stats WHERE lo IS NOT NULL) g
    WHERE g.n NOT IN (SELECT n FROM nums) ORDER BY g.n LIMIT 10)
),
chk_missing AS (
  SELECT 'missing_telemetry' AS check_name,
         (cnt < 2 OR hi - lo + 1 - dn = 0) AS passed,
         CASE WHEN cnt >= 2 AND hi - lo + 1 - dn > 0 THEN 'warning' ELSE 'info' END AS severity,
         CASE WHEN cnt < 2 THEN 'Too few events to check gaps'
              WHEN hi - lo + 1 - dn > 0 THEN CAST(hi - lo + 1 - dn AS VARCHAR)
                   || ' missing event(s) in sequence. Sample: evt_' || printf('%06d', s_lo) || '..evt_'
                   || printf('%06d', s_hi)
              ELSE 'No gaps in telemetry event sequence' END AS details,
         CAST(CASE WHEN cnt < 2 THEN cnt WHEN hi - lo + 1 - dn > 0 THEN hi - lo + 1 ELSE dn END AS BIGINT)
           AS records_checked,
         CAST(CASE WHEN cnt >= 2 AND hi - lo + 1 - dn > 0 THEN hi - lo + 1 - dn ELSE 0 END AS BIGINT)
           AS records_failed
  FROM gap_stats, gap_sample
),
unknown_ids AS (
  SELECT 'telemetry' AS source, machine_id, 0 AS o FROM (SELECT DISTINCT machine_id FROM stg_telemetry) s
  WHERE NOT EXISTS (SELECT 1 FROM stg_machines m WHERE m.machine_id IS NOT DISTINCT FROM s.machine_id)
  UNION ALL
  SELECT 'production', machine_id, 1 FROM (SELECT DISTINCT machine_id FROM stg_production) s
  WHERE NOT EXISTS (SELECT 1 FROM stg_machines m WHERE m.machine_id IS NOT DISTINCT FROM s.machine_id)
  UNION ALL
  SELECT 'maintenance_logs', machine_id, 2 FROM (SELECT DISTINCT machine_id FROM stg_maintenance) s
  WHERE NOT EXISTS (SELECT 1 FROM stg_machines m WHERE m.machine_id IS NOT DISTINCT FROM s.machine_id)
),
chk_mismatch AS (
  SELECT 'machine_id_mismatch' AS check_name, bad = 0 AS passed,
         CASE WHEN bad > 0 THEN 'warning' ELSE 'info' END AS severity,
         CASE WHEN bad > 0 THEN 'Unknown machine_ids — ' || txt
              ELSE 'All machine_ids match the machines dimension' END AS details,
         CAST(valid AS BIGINT) AS records_checked, CAST(bad AS BIGINT) AS records_failed
  FROM (SELECT count(DISTINCT machine_id) + max(CASE WHEN machine_id IS NULL THEN 1 ELSE 0 END) AS valid
        FROM stg_machines),
       (SELECT coalesce(sum(n), 0) AS bad, string_agg(entry, '; ' ORDER BY o) AS txt FROM (
          SELECT o, source || ': ' || CAST(count(*) AS VARCHAR) AS entry, count(*) AS n
          FROM unknown_ids u GROUP BY source, o))
),
null_rows AS (
  SELECT 'telemetry' AS t, 'event_id' AS c, 0 AS pos, count(*) AS rows, count(*) FILTER (WHERE event_id IS NULL) AS nulls FROM stg_telemetry
  UNION ALL SELECT 'telemetry', 'machine_id', 1, count(*), count(*) FILTER (WHERE machine_id IS NULL) FROM stg_telemetry
  UNION ALL SELECT 'telemetry', 'timestamp', 2, count(*), count(*) FILTER (WHERE timestamp IS NULL) FROM stg_telemetry
  UNION ALL SELECT 'production', 'date', 3, count(*), count(*) FILTER (WHERE date IS NULL) FROM stg_production
  UNION ALL SELECT 'production', 'machine_id', 4, count(*), count(*) FILTER (WHERE machine_id IS NULL) FROM stg_production
  UNION ALL SELECT 'maintenance_logs', 'maintenance_id', 5, count(*), count(*) FILTER (WHERE maintenance_id IS NULL) FROM stg_maintenance
  UNION ALL SELECT 'maintenance_logs', 'machine_id', 6, count(*), count(*) FILTER (WHERE machine_id IS NULL) FROM stg_maintenance
),
chk_nulls AS (
  SELECT 'null_critical_fields' AS check_name, nulls = 0 AS passed,
         CASE WHEN nulls > 0 THEN 'error' ELSE 'info' END AS severity,
         CASE WHEN nulls > 0 THEN 'Nulls found: ' || txt ELSE 'No nulls in critical fields' END AS details,
         CAST(checked AS BIGINT) AS records_checked, CAST(nulls AS BIGINT) AS records_failed
  FROM (SELECT sum(rows) AS checked, sum(nulls) AS nulls,
               string_agg(CASE WHEN nulls > 0 THEN t || ':' || c || '=' || CAST(nulls AS VARCHAR) END, ', '
                          ORDER BY pos) AS txt
        FROM null_rows)
),
chk_negative AS (
  SELECT 'negative_production' AS check_name, nu + ns = 0 AS passed,
         CASE WHEN nu + ns > 0 THEN 'error' ELSE 'info' END AS severity,
         CASE WHEN nu + ns > 0 THEN CAST(nu AS VARCHAR) || ' negative units_produced, ' || CAST(ns AS VARCHAR)
                                    || ' negative scrap_units'
              ELSE 'No negative production values' END AS details,
         CAST(r AS BIGINT) AS records_checked, CAST(nu + ns AS BIGINT) AS records_failed
  FROM (SELECT count(*) AS r, count(*) FILTER (WHERE units_produced < 0) AS nu,
               count(*) FILTER (WHERE scrap_units < 0) AS ns FROM {{production_table}})
),
quality_report AS (
  SELECT *, 0 AS check_order FROM chk_missing
  UNION ALL SELECT *, 1 FROM chk_negative
  UNION ALL SELECT *, 2 FROM chk_mismatch
  UNION ALL SELECT *, 3 FROM chk_nulls
)
"""


def _with(select: str, production_table: str = "stg_production") -> str:
    return "WITH " + BASE.replace("{production_table}", production_table).strip() + "\n" + select


MAINT_COLS = "maintenance_id, machine_id, timestamp, maintenance_type, part_replaced, downtime_minutes"

_QUERIES: dict[str, str] = {
    # 2.3 incremental ingestion
    "incremental_maintenance": f"SELECT {MAINT_COLS} FROM raw_maintenance WHERE timestamp > '2000-01-01T00:00:00'",
    "incremental_production": "SELECT * FROM raw_production WHERE date > '2000-01-01'",
    "watermark_advance": """
        SELECT 'maintenance_logs' AS source, count(*) AS rows, coalesce(max(timestamp), '2000-01-01T00:00:00') AS mark
        FROM raw_maintenance WHERE timestamp > '2000-01-01T00:00:00'
        UNION ALL
        SELECT 'production', count(*), coalesce(max(date), '2000-01-01') FROM raw_production WHERE date > '2000-01-01'
    """,
    # 2.4 staging
    "normalize_strings": f"""SELECT event_id, _batch_id, {_norm('machine_id')} AS machine_id,
        {_norm('factory_id')} AS factory_id, {_norm('status')} AS status FROM raw_telemetry""",
    "dedup_keep_last": """SELECT event_id, machine_id, temperature_c, status, _batch_id FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY _batch_id DESC) AS rn FROM raw_telemetry)
        WHERE rn = 1""",
    "cast_timestamp": f"SELECT maintenance_id, strptime(timestamp, {TS}) AS timestamp FROM raw_maintenance",
    "cast_date": "SELECT machine_id, CAST(strptime(install_date, '%Y-%m-%d') AS DATE) AS install_date FROM raw_machines",
    "clamp_non_negative": "SELECT maintenance_id, greatest(downtime_minutes, 0) AS downtime_minutes FROM raw_maintenance",
    "stage_telemetry": "SELECT * FROM stg_telemetry",
    "stage_machines": "SELECT * FROM stg_machines",
    "stage_maintenance": "SELECT * FROM stg_maintenance",
    "stage_production": "SELECT * FROM stg_production",
    # 2.5 facts
    "fact_machine_events": "SELECT * FROM fact_machine_events",
    "fact_production": "SELECT * FROM fact_production",
    "fact_maintenance": "SELECT * FROM fact_maintenance",
    "fact_downtime": "SELECT * FROM fact_downtime",
    "machine_id_mismatch": "SELECT source, machine_id FROM unknown_ids",
    "missing_telemetry": "SELECT * FROM chk_missing",
    # 2.6 metrics
    "machine_health_features": "SELECT * FROM health",
    "factory_downtime_metrics": "SELECT * FROM factory_metrics",
    "scrap_rate_metrics": "SELECT * FROM scrap",
    "maintenance_effectiveness_metrics": "SELECT * FROM effectiveness",
    "group_by_agg": """SELECT shift, CAST(sum(units_produced) AS BIGINT) AS units, max(scrap_units) AS max_scrap,
        count(machine_id) AS rows FROM stg_production GROUP BY shift""",
    "latest_event_per_machine": "SELECT * FROM latest",
    # 2.7 quality
    "negative_production": "SELECT * FROM chk_negative",
    "null_critical_fields": "SELECT * FROM chk_nulls",
    "quality_report": "SELECT * FROM quality_report",
    "quality_summary": """SELECT count(*) AS total, count(*) FILTER (WHERE passed) AS passed,
        count(*) FILTER (WHERE NOT passed) AS failed FROM quality_report""",
    # 2.8 business queries
    "machines_trending_toward_failure": """
        SELECT machine_id,
          CASE WHEN coalesce(avg_temperature_c <> 0, false) THEN round(avg_temperature_c, 1) END AS avg_temperature_c,
          CASE WHEN coalesce(avg_vibration_mm_s <> 0, false) THEN round(avg_vibration_mm_s, 2) END AS avg_vibration_mm_s,
          CASE WHEN coalesce(max_temperature_c <> 0, false) THEN round(max_temperature_c, 1) END AS max_temperature_c,
          concat_ws('; ',
            CASE WHEN avg_temperature_c > 75.0 THEN 'avg_temp='
              || CAST(CAST(round(avg_temperature_c, 1) AS DECIMAL(20,1)) AS VARCHAR) || '°C' END,
            CASE WHEN avg_vibration_mm_s > 3.0 THEN 'avg_vibration='
              || CAST(CAST(round(avg_vibration_mm_s, 2) AS DECIMAL(20,2)) AS VARCHAR) || 'mm/s' END,
            CASE WHEN max_temperature_c > 90.0 THEN 'max_temp='
              || CAST(CAST(round(max_temperature_c, 1) AS DECIMAL(20,1)) AS VARCHAR) || '°C' END) AS risk_factors
        FROM health
        WHERE avg_temperature_c > 75.0 OR avg_vibration_mm_s > 3.0 OR max_temperature_c > 90.0
    """,
    "overheating_before_shutdown": """
        SELECT machine_id, round(temperature_c, 1) AS hot_event_temp, timestamp AS hot_event_time,
               next_status, next_time
        FROM (
          SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY pos) AS rn FROM (
            SELECT machine_id, timestamp, temperature_c,
                   lead(status) OVER w AS next_status, lead(timestamp) OVER w AS next_time,
                   row_number() OVER w AS pos
            FROM stg_telemetry
            WINDOW w AS (PARTITION BY machine_id ORDER BY timestamp, event_id))
          WHERE temperature_c > 85.0 AND next_status IN ('idle', 'off', 'error'))
        WHERE rn = 1
    """,
    "frequently_failing_machines": """
        SELECT machine_id, count(*) AS maintenance_events,
               CAST(sum(coalesce(downtime_minutes, 0)) AS BIGINT) AS total_downtime_min
        FROM fact_maintenance GROUP BY machine_id
        ORDER BY maintenance_events DESC, machine_id ASC NULLS FIRST LIMIT 10
    """,
    "downtime_by_factory": """
        SELECT factory_id, total_downtime_minutes, round(avg_downtime_minutes, 1) AS avg_downtime_minutes,
               downtime_event_count AS downtime_events
        FROM factory_metrics ORDER BY total_downtime_minutes DESC
    """,
    "maintenance_reducing_downtime": """
        SELECT maintenance_type, round(avg_downtime_minutes, 1) AS avg_downtime_minutes, total_downtime_minutes,
               event_count FROM effectiveness ORDER BY 2
    """,
    "machines_high_scrap": """
        SELECT machine_id, round(scrap_rate, 4) AS scrap_rate, total_scrap_units, total_units_produced
        FROM scrap ORDER BY 2 DESC
    """,
    "lines_abnormal_variability": """
        SELECT machine_id, round(mean, 1) AS mean_units, round(sqrt(var), 1) AS std_units,
               round(sqrt(var) / mean, 4) AS cv, n AS data_points, sqrt(var) / mean > 0.15 AS abnormal
        FROM (
          SELECT machine_id, n, CAST(s1 AS DOUBLE) / CAST(n AS DOUBLE) AS mean,
                 CAST(CAST(n AS HUGEINT) * s2 - s1 * s1 AS DOUBLE) / (CAST(n AS DOUBLE) * CAST(n AS DOUBLE)) AS var
          FROM (SELECT machine_id, count(units_produced) AS n, sum(CAST(units_produced AS HUGEINT)) AS s1,
                       sum(CAST(units_produced AS HUGEINT) * CAST(units_produced AS HUGEINT)) AS s2
                FROM stg_production GROUP BY machine_id)
          WHERE n >= 2 AND s1 <> 0)
    """,
    # 2.9 alerts
    "alert_telemetry_silence": "SELECT * FROM silence_items",
    "alert_temperature": "SELECT * FROM temp_items",
    "alert_scrap_rate": "SELECT * FROM scrap_items",
    "alert_late_data": "SELECT * FROM late",
    "alert_pipeline_failure": "SELECT * FROM failed_runs",
    "alert_report": "SELECT * FROM alert_report",
    "alert_summary": "SELECT * FROM alert_totals",
    # 2.10 serving
    "telemetry_status": "SELECT * FROM status",
    "dashboard_kpis": """
        SELECT (SELECT count(*) FROM factory_metrics) AS factories,
               (SELECT count(*) FROM health) AS machines,
               (SELECT count(*) FROM health WHERE coalesce(max_temperature_c, 0) > 85.0) AS abnormal,
               (SELECT count(*) FROM status WHERE status <> 'active') AS silent,
               (SELECT count(*) FROM scrap WHERE coalesce(scrap_rate, 0) > 0.05) AS high_scrap,
               (SELECT total_alerts FROM alert_totals) AS alerts
    """,
    "dashboard_abnormal": """
        SELECT machine_id, max_temperature_c, avg_temperature_c, max_vibration_mm_s, event_count,
               CASE WHEN coalesce(max_temperature_c, 0) > 90.0 THEN 'danger' ELSE 'warn' END AS css_class
        FROM health WHERE coalesce(max_temperature_c, 0) > 85.0
        ORDER BY coalesce(max_temperature_c, 0) DESC, machine_id NULLS FIRST LIMIT 10
    """,
    "dashboard_high_scrap": """
        SELECT machine_id, scrap_rate, total_scrap_units, total_units_produced FROM scrap
        WHERE coalesce(scrap_rate, 0) > 0.05 ORDER BY coalesce(scrap_rate, 0) DESC, machine_id NULLS FIRST LIMIT 10
    """,
    "dashboard_silent": """
        SELECT * FROM status WHERE status <> 'active' ORDER BY machine_id NULLS FIRST LIMIT 10
    """,
    # 2.13 declared in documents / DDL
    "row_count_threshold": """
        SELECT 'telemetry' AS table_name, count(*) AS rows, CAST(1000 AS BIGINT) AS min_rows, count(*) >= 1000 AS passed FROM stg_telemetry
        UNION ALL SELECT 'machines', count(*), 10, count(*) >= 10 FROM stg_machines
        UNION ALL SELECT 'maintenance_logs', count(*), 1000, count(*) >= 1000 FROM stg_maintenance
        UNION ALL SELECT 'production', count(*), 1000, count(*) >= 1000 FROM stg_production
    """,
    "missing_event_windows": """
        SELECT e.machine_id, e.hour AS missing_hour
        FROM (SELECT machine_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour
              FROM (SELECT machine_id, min(date_trunc('hour', timestamp)) AS lo,
                           max(date_trunc('hour', timestamp)) AS hi
                    FROM stg_telemetry WHERE timestamp IS NOT NULL GROUP BY machine_id)) e
        WHERE NOT EXISTS (SELECT 1 FROM stg_telemetry s
                          WHERE s.machine_id IS NOT DISTINCT FROM e.machine_id
                            AND date_trunc('hour', s.timestamp) = e.hour)
    """,
    "missing_event_gaps": """
        SELECT machine_id, hour + INTERVAL 1 HOUR AS first_hour, after - INTERVAL 1 HOUR AS last_hour,
               date_diff('hour', hour, after) - 1 AS hours
        FROM (SELECT machine_id, hour, lead(hour) OVER (PARTITION BY machine_id ORDER BY hour) AS after
              FROM (SELECT DISTINCT machine_id, date_trunc('hour', timestamp) AS hour FROM stg_telemetry WHERE timestamp IS NOT NULL))
        WHERE date_diff('hour', hour, after) > 1
    """,
    "declared_keys": """
        SELECT 'machines' AS table_name, machine_id AS key, count(*) AS rows FROM raw_machines GROUP BY 2 HAVING count(*) > 1 OR machine_id IS NULL
        UNION ALL
        SELECT 'maintenance_logs', maintenance_id, count(*) FROM raw_maintenance GROUP BY 2 HAVING count(*) > 1 OR maintenance_id IS NULL
    """,
    "declared_defaults": "SELECT maintenance_id, coalesce(downtime_minutes, 0) AS downtime_minutes FROM raw_maintenance",
    "dashboard_downtime": """
        SELECT factory_id, total_downtime_minutes, avg_downtime_minutes, downtime_event_count FROM factory_metrics
    """,
    "health_flags": """
        SELECT event_id, machine_id, timestamp,
               CASE WHEN temperature_c > 95.0 THEN 'critical' WHEN temperature_c > 85.0 THEN 'warning'
                    WHEN temperature_c IS NULL THEN 'unknown' ELSE 'normal' END AS temperature_flag,
               coalesce(vibration_mm_s > 3.0, false) AS high_vibration
        FROM fact_machine_events
    """,
    "enum_validation": """
        SELECT 'machine_type' AS column_name, machine_type AS value, count(*) AS rows FROM stg_machines
        WHERE NOT coalesce(machine_type IN ('packaging', 'soldering', 'inspection', 'assembly'), false)
        GROUP BY machine_type
        UNION ALL
        SELECT 'status', status, count(*) FROM stg_machines
        WHERE NOT coalesce(status IN ('active', 'maintenance'), false) GROUP BY status
    """,
    "pk_uniqueness": "SELECT event_id, count(*) AS rows FROM raw_telemetry GROUP BY event_id HAVING count(*) > 1",
    "fk_violations": """
        SELECT * FROM stg_maintenance m WHERE machine_id IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM stg_machines d WHERE d.machine_id = m.machine_id)
    """,
    "not_null_report": """
        SELECT 'machines' AS table_name, 'factory_id' AS column_name, count(*) AS rows,
               count(*) FILTER (WHERE factory_id IS NULL) AS nulls FROM stg_machines
        UNION ALL SELECT 'machines', 'machine_type', count(*), count(*) FILTER (WHERE machine_type IS NULL) FROM stg_machines
        UNION ALL SELECT 'maintenance_logs', 'machine_id', count(*), count(*) FILTER (WHERE machine_id IS NULL) FROM stg_maintenance
        UNION ALL SELECT 'maintenance_logs', 'timestamp', count(*), count(*) FILTER (WHERE timestamp IS NULL) FROM stg_maintenance
        UNION ALL SELECT 'maintenance_logs', 'maintenance_type', count(*), count(*) FILTER (WHERE maintenance_type IS NULL) FROM stg_maintenance
    """,
}

# keys whose Spark side checks the raw (not staged) production table
_RAW_PRODUCTION = {"negative_production"}


def oracle_sql() -> dict[str, str]:
    out = {}
    for key, select in _QUERIES.items():
        out[key] = _with(select, "raw_production" if key in _RAW_PRODUCTION else "stg_production")
    return out
