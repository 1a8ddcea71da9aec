"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The telemetry tables are rebuilt from the driver tables as CTEs that state the
binding rules of ``fleetspark.bindings`` independently in SQL; typed columns
stand in for metric-map keys (a key is present exactly when its column is not
NULL). Doubles are rounded to 6 places, as in ``catalog.finish``.
"""

from __future__ import annotations

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, deps: tuple[str, ...] = ()):
    CTES[name] = (sql, deps)


cte("measurements", """
  SELECT 'site' AS site_id, event_type AS system, CAST(user_id AS VARCHAR) AS device_id,
         CASE WHEN user_id % 5 = 0 THEN NULL ELSE 'zone' || CAST(user_id % 4 AS VARCHAR) END AS location,
         ts, event_id,
         CAST(props->>'k' AS DOUBLE) AS m_humidity,
         CASE WHEN event_id % 10 <> 7 THEN value / 10 END AS m_temperature,
         CASE WHEN event_id % 4 <> 3 THEN
           ['Off','Starting','Warming','Running','Ventilation','ShuttingDown','Cooling'][CAST(props->>'k' AS BIGINT) % 7 + 1]
         END AS m_heater_state,
         CASE WHEN event_id % 6 <> 5 THEN value END AS m_battery_v
  FROM events""")

cte("power", """
  SELECT CAST(l_suppkey AS VARCHAR) AS device_sn, l_shipdate AS ts, l_orderkey, l_linenumber,
    CAST(ROUND(100 - l_discount * 1000) AS INTEGER) AS soc_percent,
    CAST(l_partkey % 1440 AS INTEGER) AS remain_time_min,
    CAST(ROUND(l_extendedprice / 100) AS INTEGER) AS watts_in_sum,
    CAST(ROUND(l_quantity * 10) AS INTEGER) AS watts_out_sum,
    CAST(ROUND(l_quantity * 7) AS INTEGER) AS ac_out_watts,
    CAST(l_linenumber * 3 AS INTEGER) AS car_watts,
    CASE WHEN l_linestatus = 'O' THEN NULL ELSE CAST(ROUND(l_quantity) AS INTEGER) END AS typec_out_watts,
    CAST(ROUND(l_discount * 100) AS INTEGER) AS usb_out_watts,
    CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(ROUND(l_tax * 1000) AS INTEGER) END AS pv_in_watts,
    CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_extendedprice / 200 END AS inv_input_watts,
    CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN CAST(0 AS DOUBLE) ELSE 20 + l_tax * 100 END AS bms_temp,
    CASE WHEN l_returnflag = 'R' THEN NULL ELSE 25 + l_discount * 100 END AS inv_out_temp,
    CASE WHEN l_linestatus = 'F' THEN CAST(0 AS DOUBLE) ELSE 30 + l_tax * 50 END AS mppt_temp
  FROM lineitem""")

cte("devices", """
  SELECT c.c_name AS device_id, c.c_mktsegment AS device_model, o.current_firmware_version,
         o.last_seen, o.created_at, c.c_custkey
  FROM customer c LEFT JOIN (
    SELECT o_custkey, first(o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS current_firmware_version,
           max(o_orderdate) AS last_seen, min(o_orderdate) AS created_at
    FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey""")

cte("updates", """
  SELECT o.o_orderkey AS id, c.c_name AS device_id, o.o_orderpriority AS firmware_version,
    CASE o.o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status,
    CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_orderdate END AS started_at,
    CASE WHEN o.o_orderstatus <> 'O' THEN o.o_orderdate + to_seconds(o.o_orderkey % 5000) END AS completed_at,
    o.o_orderdate AS reported_at,
    CASE o.o_orderstatus WHEN 'F' THEN 100 WHEN 'O' THEN 0 ELSE CAST(o.o_orderkey % 100 AS INTEGER) END AS progress_percent,
    CASE WHEN o.o_orderstatus NOT IN ('F', 'O') THEN 'Update failed on block ' || CAST(o.o_orderkey AS VARCHAR)
         || CASE WHEN o.o_orderkey % 2 = 0 THEN ': image checksum mismatch after download' ELSE '' END END AS error_message
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")

cte("releases", """
  SELECT c.c_mktsegment AS device_model, o.o_orderpriority AS version, min(o.o_orderdate) AS created_at
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2""")

cte("latest_rel", """
  SELECT device_model, version AS latest_version FROM releases
  QUALIFY row_number() OVER (PARTITION BY device_model ORDER BY created_at DESC, version DESC) = 1""", ("releases",))

cte("rollouts", """
  SELECT device_model || '-' || version AS name, version AS firmware_version, device_model,
    CASE device_model WHEN 'BUILDING' THEN 'specific' WHEN 'HOUSEHOLD' THEN 'all' ELSE 'canary' END AS target_type,
    CASE WHEN device_model IN ('HOUSEHOLD', 'BUILDING') THEN 100 ELSE 40 END AS rollout_percentage,
    device_model <> 'FURNITURE' AS is_active, created_at
  FROM releases""", ("releases",))

cte("status", """
  SELECT 'site' AS site_id, 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS device_id, ts, event_id,
    upper(event_type) AS s_state,
    CASE WHEN event_id % 5 <> 1 THEN CAST(-30 - CAST(props->>'k' AS BIGINT) AS VARCHAR) END AS s_signal,
    CASE WHEN event_id % 7 <> 3 THEN CAST(CAST(floor(value * 10000) AS BIGINT) AS VARCHAR) END AS s_uptime,
    CASE WHEN event_id % 3 = 0 THEN 'scenario' || CAST(CAST(props->>'k' AS BIGINT) % 3 AS VARCHAR) END AS s_scenario,
    'fw' || CAST(CAST(props->>'k' AS BIGINT) % 4 AS VARCHAR) AS s_firmware
  FROM events""")

AS_OF = {
    "events": "(SELECT max(ts) FROM events)",
    "lineitem": "(SELECT max(l_shipdate) FROM lineitem)",
    "orders": "(SELECT max(o_orderdate) FROM orders)",
}


def with_ctes(*names: str) -> str:
    order: list[str] = []

    def visit(n):
        for d in CTES[n][1]:
            visit(d)
        if n not in order:
            order.append(n)
    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n"


SQL: dict[str, str] = {}


def sql(name: str, *ctes: str):
    def deco(body: str):
        SQL[name] = (with_ctes(*ctes) if ctes else "") + body
        return body
    return deco


LABEL = "device_id || ' (' || COALESCE(location, 'unknown') || ')'"


def tb(every: str, col: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{every}', {col}, TIMESTAMP '1970-01-01')"


# ------------------------------------------------------------------ buckets

sql("bucket_avg_label", "measurements")(f"""
SELECT {tb('6 hours')} AS time, ROUND(AVG(m_temperature), 6) AS value, {LABEL} AS metric
FROM measurements WHERE site_id = 'site' AND m_temperature IS NOT NULL
GROUP BY 1, device_id, location""")

sql("bucket_avg_single", "power")(f"""
SELECT {tb('7 days')} AS time, ROUND(AVG(soc_percent), 6) AS value, 'Akku SOC (%)' AS metric
FROM power GROUP BY 1""")

sql("bucket_avg_zero", "power")(f"""
SELECT {tb('7 days')} AS time, ROUND(AVG(COALESCE(pv_in_watts, 0)), 6) AS value, 'Solar' AS metric
FROM power GROUP BY 1""")

sql("bucket_wide", "power")(f"""
SELECT {tb('30 days')} AS time, device_sn,
  ROUND(AVG(COALESCE(ac_out_watts, 0)), 6) AS ac_output_w, ROUND(AVG(COALESCE(car_watts, 0)), 6) AS dc_output_w,
  ROUND(AVG(COALESCE(typec_out_watts, 0)), 6) AS usbc_w, ROUND(AVG(COALESCE(usb_out_watts, 0)), 6) AS usba_w
FROM power GROUP BY 1, 2""")

sql("bucket_net_of_avgs", "power")(f"""
SELECT {tb('7 days')} AS time, ROUND(AVG(watts_in_sum) - AVG(watts_out_sum), 6) AS value
FROM power GROUP BY 1""")

sql("bucket_avg_of_net", "power")(f"""
SELECT {tb('7 days')} AS time, ROUND(AVG(COALESCE(pv_in_watts, 0) - COALESCE(typec_out_watts, 0)), 6) AS value
FROM power GROUP BY 1""")

sql("dew_point", "measurements")(f"""
SELECT time, ROUND((237.7 * (ln(rh / 100.0) + (17.27 * t) / (237.7 + t)))
                   / (17.27 - (ln(rh / 100.0) + (17.27 * t) / (237.7 + t))), 6) AS value, metric
FROM (SELECT {tb('6 hours')} AS time, AVG(m_temperature) AS t, AVG(m_humidity) AS rh, {LABEL} AS metric
      FROM measurements
      WHERE m_temperature IS NOT NULL AND m_humidity IS NOT NULL AND m_humidity > 0
      GROUP BY 1, device_id, location)""")

sql("abs_humidity", "measurements")(f"""
SELECT time, ROUND((rh / 100.0 * 6.112 * exp((17.67 * t) / (t + 243.5)) * 2.1674) / (273.15 + t), 6) AS value, metric
FROM (SELECT {tb('6 hours')} AS time, AVG(m_temperature) AS t, AVG(m_humidity) AS rh, {LABEL} AS metric
      FROM measurements WHERE m_temperature IS NOT NULL AND m_humidity IS NOT NULL
      GROUP BY 1, device_id, location)""")

sql("message_rate_5m", "status")(f"""
SELECT date_trunc('minute', ts) - (CAST(extract(minute FROM ts) AS INTEGER) % 5) * INTERVAL '1 minute' AS time,
       device_id, COUNT(*) AS messages
FROM status
WHERE ts > {AS_OF['events']} - INTERVAL '7 days' AND ts < {AS_OF['events']} AND regexp_matches(device_id, '.*')
GROUP BY 1, 2""")

sql("bucket_count", "measurements")(f"""
SELECT {tb('1 hour')} AS time, COUNT(*) AS count FROM measurements GROUP BY 1""")

sql("series_long", "power")(f"""
SELECT {tb('7 days')} AS time, ROUND(AVG(watts_in_sum), 6) AS value, 'In' AS metric FROM power GROUP BY 1
UNION ALL
SELECT {tb('7 days')}, ROUND(AVG(watts_out_sum), 6), 'Out' FROM power GROUP BY 1
UNION ALL
SELECT {tb('7 days')}, ROUND(AVG(watts_in_sum) - AVG(watts_out_sum), 6), 'Net' FROM power GROUP BY 1
UNION ALL
SELECT {tb('7 days')}, ROUND(AVG(COALESCE(pv_in_watts, 0)), 6), 'Solar' FROM power GROUP BY 1
UNION ALL
SELECT {tb('7 days')}, ROUND(AVG(bms_temp), 6), 'BMS' FROM power
  WHERE bms_temp IS NOT NULL AND bms_temp != 0 GROUP BY 1
UNION ALL
SELECT {tb('7 days')}, ROUND(AVG(inv_out_temp), 6), 'Inverter' FROM power
  WHERE inv_out_temp IS NOT NULL AND inv_out_temp != 0 GROUP BY 1
UNION ALL
SELECT {tb('7 days')}, ROUND(AVG(mppt_temp), 6), 'MPPT' FROM power
  WHERE mppt_temp IS NOT NULL AND mppt_temp != 0 GROUP BY 1""")

sql("all_temperatures", "measurements", "power")(f"""
SELECT {tb('1 day')} AS time, ROUND(AVG(m_temperature), 6) AS value, {LABEL} AS metric
FROM measurements WHERE m_temperature IS NOT NULL GROUP BY 1, device_id, location
UNION ALL
SELECT {tb('1 day')}, ROUND(AVG(inv_out_temp), 6), 'Inverter Out' FROM power WHERE inv_out_temp IS NOT NULL GROUP BY 1
UNION ALL
SELECT {tb('1 day')}, ROUND(AVG(bms_temp), 6), 'BMS' FROM power WHERE bms_temp IS NOT NULL GROUP BY 1
UNION ALL
SELECT {tb('1 day')}, ROUND(AVG(mppt_temp), 6), 'MPPT' FROM power WHERE mppt_temp IS NOT NULL GROUP BY 1""")

# ------------------------------------------------------------------ latest

sql("latest_nulls_first", "updates")("""
SELECT DISTINCT ON (device_id) device_id, id, firmware_version, status, started_at, completed_at
FROM updates ORDER BY device_id, started_at DESC NULLS FIRST, id DESC""")

POWER_DESC = "ts DESC, l_orderkey DESC, l_linenumber DESC"

sql("latest_value", "power")(f"""
SELECT DISTINCT ON (device_sn) device_sn,
  COALESCE(soc_percent, 0) AS soc, COALESCE(watts_in_sum, 0) AS watts_in, COALESCE(watts_out_sum, 0) AS watts_out,
  COALESCE(pv_in_watts, 0) AS pv_in, ROUND(COALESCE(bms_temp, 0), 6) AS bms_temp,
  ROUND(inv_out_temp, 6) AS inv_out_temp_raw,
  COALESCE(watts_in_sum, 0) - COALESCE(watts_out_sum, 0) AS net_watts,
  CONCAT(CAST(FLOOR(remain_time_min / 60) AS BIGINT), 'h ', remain_time_min % 60, 'm') AS remain_text
FROM power ORDER BY device_sn, {POWER_DESC}""")

sql("latest_non_null", "power")(f"""
SELECT DISTINCT ON (device_sn) device_sn, pv_in_watts
FROM power WHERE pv_in_watts IS NOT NULL ORDER BY device_sn, {POWER_DESC}""")

sql("latest_staleness", "power")(f"""
SELECT DISTINCT ON (device_sn) device_sn, ts, soc_percent, watts_in_sum, watts_out_sum, pv_in_watts,
  CAST(ROUND(epoch({AS_OF['lineitem']}) - epoch(ts)) AS INTEGER) AS staleness_sec
FROM power ORDER BY device_sn, {POWER_DESC}""")

sql("latest_metric", "measurements")("""
SELECT COALESCE(s.system, b.system) AS system, s.state_code, b.battery_v FROM
 (SELECT DISTINCT ON (system) system,
    CASE m_heater_state WHEN 'Off' THEN 0 WHEN 'Starting' THEN 1 WHEN 'Warming' THEN 2 WHEN 'Running' THEN 3
      WHEN 'ShuttingDown' THEN 4 WHEN 'Cooling' THEN 5 ELSE -1 END AS state_code
  FROM measurements WHERE m_heater_state IS NOT NULL ORDER BY system, ts DESC, event_id DESC) s
FULL JOIN
 (SELECT DISTINCT ON (system) system, ROUND(m_battery_v, 6) AS battery_v
  FROM measurements WHERE m_battery_v IS NOT NULL ORDER BY system, ts DESC, event_id DESC) b
ON s.system = b.system""")

sql("latest_release", "latest_rel")("""
SELECT device_model, latest_version FROM latest_rel""")

sql("latest_release_overall", "releases")("""
SELECT device_model || ': ' || version AS latest FROM releases
ORDER BY created_at DESC, version DESC, device_model DESC LIMIT 1""")

sql("current_states", "status")("""
SELECT device_id, COALESCE(s_state, 'unknown') || ' (' || COALESCE(s_scenario, 'default') || ')' AS current_state
FROM (SELECT DISTINCT ON (device_id) device_id, s_state, s_scenario FROM status
      WHERE regexp_matches(device_id, '.*') ORDER BY device_id, ts DESC, event_id DESC)""")

# ------------------------------------------------------------------ runs

sql("state_intervals", "measurements")("""
SELECT device_id, run, min(m_heater_state) AS state, min(ts) AS start, max(ts) AS "end", COUNT(*) AS rows
FROM (SELECT *, CAST(SUM(CASE WHEN prev IS NULL OR prev <> m_heater_state THEN 1 ELSE 0 END)
                 OVER (PARTITION BY device_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run
      FROM (SELECT device_id, ts, event_id, m_heater_state,
                   lag(m_heater_state) OVER (PARTITION BY device_id ORDER BY ts, event_id) AS prev
            FROM measurements WHERE m_heater_state IS NOT NULL))
GROUP BY device_id, run""")

sql("gap_segments", "measurements")("""
SELECT device_id, segment, min(ts) AS start, max(ts) AS "end", COUNT(*) AS rows
FROM (SELECT *, CAST(SUM(CASE WHEN prev IS NULL OR ts - prev > INTERVAL '4 hours' THEN 1 ELSE 0 END)
                 OVER (PARTITION BY device_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment
      FROM (SELECT device_id, ts, event_id, lag(ts) OVER (PARTITION BY device_id ORDER BY ts, event_id) AS prev
            FROM measurements))
GROUP BY device_id, segment""")

# ------------------------------------------------------------------ fleet

sql("power_stats_last", "power")(f"""
SELECT device_sn, ROUND(ROUND(AVG(COALESCE(watts_out_sum, 0))), 6) AS avg_output, MAX(COALESCE(watts_out_sum, 0)) AS peak_output,
       ROUND(ROUND(AVG(COALESCE(watts_in_sum, 0))), 6) AS avg_input, MAX(COALESCE(watts_in_sum, 0)) AS peak_input
FROM power WHERE ts >= {AS_OF['lineitem']} - INTERVAL '30 days' GROUP BY device_sn""")

sql("update_timeline", "updates")(f"""
SELECT date_trunc('day', started_at) AS time,
  CASE WHEN status = 'success' THEN 'Success' WHEN status = 'failed' THEN 'Failed'
       WHEN status IN ('downloading', 'installing', 'pending') THEN 'In Progress' ELSE 'Other' END AS status,
  COUNT(*) AS count
FROM updates WHERE started_at > {AS_OF['orders']} - INTERVAL '180 days'
GROUP BY date_trunc('day', started_at), updates.status""")

sql("update_activity_hourly", "updates")(f"""
SELECT date_trunc('hour', reported_at) AS hour, status, COUNT(*) AS count
FROM updates WHERE reported_at > {AS_OF['orders']} - INTERVAL '30 days' GROUP BY 1, 2""")

sql("count_by_model", "devices")("""
SELECT device_model, COUNT(*) AS count FROM devices GROUP BY 1""")

sql("count_by_firmware", "devices")("""
SELECT current_firmware_version, COUNT(*) AS count FROM devices GROUP BY 1""")

sql("update_success_recent", "updates")(f"""
SELECT status, COUNT(*) AS count FROM updates
WHERE reported_at > {AS_OF['orders']} - INTERVAL '180 days' AND status IN ('success', 'failed') GROUP BY 1""")

sql("fleet_counts", "devices", "updates", "status", "rollouts")(f"""
SELECT (SELECT COUNT(*) FROM devices) AS total_devices,
       (SELECT COUNT(*) FROM devices WHERE last_seen > {AS_OF['orders']} - INTERVAL '30 days') AS online_devices,
       (SELECT COUNT(*) FROM updates WHERE status IN ('downloading', 'installing', 'pending')) AS active_updates,
       (SELECT COUNT(*) FROM status WHERE ts > {AS_OF['events']} - INTERVAL '1 hour') AS status_messages_recent,
       (SELECT COUNT(*) FROM rollouts WHERE is_active) AS active_rollouts""")

sql("table_profile", "power")("""
SELECT COUNT(*) AS total_rows, MIN(ts) AS first_ts, MAX(ts) AS last_ts, COUNT(DISTINCT device_sn) AS devices
FROM power""")

sql("non_null_counts", "power")("""
SELECT 'pv_in_watts' AS field, COUNT(*) AS count FROM power WHERE pv_in_watts IS NOT NULL
UNION ALL SELECT 'typec_out_watts', COUNT(*) FROM power WHERE typec_out_watts IS NOT NULL
UNION ALL SELECT 'inv_input_watts', COUNT(*) FROM power WHERE inv_input_watts IS NOT NULL
UNION ALL SELECT 'bms_temp', COUNT(*) FROM power WHERE bms_temp IS NOT NULL
UNION ALL SELECT 'Total measurements', COUNT(*) FROM power""")


def _field_summary() -> str:
    parts = []
    for c in ("soc_percent", "watts_in_sum", "pv_in_watts", "bms_temp"):
        parts.append(f"""SELECT '{c}' AS field, COUNT({c}) AS records, ROUND(CAST(MIN({c}) AS DOUBLE), 6) AS min_value,
  ROUND(CAST(MAX({c}) AS DOUBLE), 6) AS max_value, ROUND(AVG(CAST({c} AS DOUBLE)), 6) AS avg_value
FROM power WHERE ts > {AS_OF['lineitem']} - INTERVAL '365 days'""")
    return "\nUNION ALL\n".join(parts)


sql("field_summary", "power")(_field_summary())

sql("avg_by_location", "measurements")(f"""
SELECT location, ROUND(AVG(m_temperature), 6) AS avg_value, COUNT(*) AS readings
FROM measurements WHERE ts > {AS_OF['events']} - INTERVAL '24 hours' AND m_temperature IS NOT NULL
GROUP BY location""")

sql("device_online", "power")(f"""
SELECT device_sn, CASE WHEN MAX(ts) > {AS_OF['lineitem']} - INTERVAL '30 days' THEN 1 ELSE 0 END AS online
FROM power GROUP BY device_sn""")

sql("up_to_date", "devices", "releases")("""
SELECT COUNT(*) AS uptodate FROM devices d WHERE d.current_firmware_version =
  (SELECT version FROM releases fr WHERE fr.device_model = d.device_model ORDER BY created_at DESC, version DESC LIMIT 1)""")

sql("fleet_metrics", "devices", "updates", "rollouts")(f"""
SELECT 'total_devices' AS metric, CAST(NULL AS VARCHAR) AS key, COUNT(*) AS value FROM devices
UNION ALL SELECT 'devices_by_model', device_model, COUNT(*) FROM devices GROUP BY device_model
UNION ALL SELECT 'recent_updates_24h', status, COUNT(*) FROM updates
  WHERE reported_at > {AS_OF['orders']} - INTERVAL '180 days' GROUP BY status
UNION ALL SELECT 'active_rollouts', NULL, COUNT(*) FROM rollouts WHERE is_active""")


def _age(col: str, recent: str, hour: str, fmt: str, never: str) -> str:
    now = AS_OF["orders"]
    return f"""CASE
    WHEN {col} > {now} - INTERVAL '{recent}' THEN CAST(CAST(ROUND(epoch({now}) - epoch({col})) AS BIGINT) AS VARCHAR) || 's ago'
    WHEN {col} > {now} - INTERVAL '{hour}' THEN CAST(CAST(ROUND((epoch({now}) - epoch({col})) / 60) AS BIGINT) AS VARCHAR) || 'm ago'
    WHEN {col} IS NOT NULL THEN strftime({col}, '{fmt}')
    ELSE '{never}' END"""


def _uptime(col: str) -> str:
    u = f"CAST({col} AS DOUBLE)"
    return f"""CASE
    WHEN {u} >= 86400 THEN CAST(CAST(ROUND({u} / 86400) AS BIGINT) AS VARCHAR) || 'd'
    WHEN {u} >= 3600 THEN CAST(CAST(ROUND({u} / 3600) AS BIGINT) AS VARCHAR) || 'h'
    WHEN {u} >= 60 THEN CAST(CAST(ROUND({u} / 60) AS BIGINT) AS VARCHAR) || 'm'
    WHEN {col} IS NOT NULL THEN CAST(CAST(ROUND({u}) AS BIGINT) AS VARCHAR) || 's'
    ELSE '-' END"""


sql("device_overview", "devices", "status", "updates", "latest_rel")(f"""
SELECT d.device_id, d.device_model AS model, d.current_firmware_version AS current_fw, lr.latest_version AS latest_fw,
  CASE WHEN d.last_seen > {AS_OF['orders']} - INTERVAL '30 days' THEN 'Online'
       WHEN d.last_seen > {AS_OF['orders']} - INTERVAL '180 days' THEN 'Recent' ELSE 'Offline' END AS status,
  {_age('d.last_seen', '30 days', '180 days', '%m-%d %H:%M', 'Never')} AS last_seen_text,
  {_age('ls.last_status_ts', '60 days', '180 days', '%m-%d %H:%M', 'No data')} AS last_status,
  COALESCE(ls.s_signal, '-') AS wifi_dbm,
  {_uptime('ls.s_uptime')} AS uptime,
  COALESCE(ls.s_state, '-') AS state,
  CASE WHEN lu.status IN ('downloading', 'installing', 'pending') THEN 'Updating'
       WHEN lu.status = 'success' THEN 'Success' WHEN lu.status = 'failed' THEN 'Failed' ELSE '-' END AS update_status,
  strftime(d.created_at, '%Y-%m-%d') AS registered,
  d.last_seen
FROM devices d
LEFT JOIN (SELECT DISTINCT ON (device_id) device_id, s_signal, s_uptime, s_state, ts AS last_status_ts
           FROM status ORDER BY device_id, ts DESC, event_id DESC) ls ON d.device_id = ls.device_id
LEFT JOIN (SELECT DISTINCT ON (device_id) device_id, status FROM updates
           ORDER BY device_id, started_at DESC NULLS FIRST, id DESC) lu ON d.device_id = lu.device_id
LEFT JOIN latest_rel lr ON d.device_model = lr.device_model
WHERE regexp_matches(d.device_id, '.*')""")

sql("device_update_progress", "devices", "updates")(f"""
SELECT d.device_id, d.device_model AS model, d.current_firmware_version AS current_version,
  CASE WHEN lu.status IN ('downloading', 'installing', 'pending') THEN 'Updating...' ELSE '-' END AS update_progress,
  COALESCE(lu.firmware_version, '-') AS target_version,
  CASE WHEN d.last_seen > {AS_OF['orders']} - INTERVAL '30 days' THEN 'Online' ELSE 'Offline' END AS online,
  {_age('d.last_seen', '30 days', '180 days', '%Y-%m-%d %H:%M', 'Never')} AS last_seen_text,
  CASE WHEN lu.completed_at IS NOT NULL THEN strftime(lu.completed_at, '%Y-%m-%d %H:%M') ELSE 'Never' END AS last_update,
  CASE WHEN lu.status IN ('downloading', 'installing', 'pending') THEN 'Updating'
       WHEN lu.status = 'success' THEN 'Success' WHEN lu.status = 'failed' THEN 'Failed' ELSE '-' END AS status,
  d.last_seen
FROM devices d
LEFT JOIN (SELECT DISTINCT ON (device_id) device_id, firmware_version, status, completed_at FROM updates
           ORDER BY device_id, started_at DESC NULLS FIRST, id DESC) lu ON d.device_id = lu.device_id""")

_HIST_LABEL = """CASE WHEN u.status = 'success' THEN 'Success' WHEN u.status = 'failed' THEN 'Failed'
       WHEN u.status IN ('downloading', 'installing', 'pending') THEN 'In Progress' ELSE u.status END"""


def _duration(ongoing: str) -> str:
    return f"""CASE WHEN u.completed_at IS NOT NULL
       THEN CAST(CAST(ROUND(epoch(u.completed_at) - epoch(u.started_at)) AS BIGINT) AS VARCHAR) || 's'
       ELSE '{ongoing}' END"""


sql("recent_updates", "updates", "devices")(f"""
SELECT strftime(u.started_at, '%Y-%m-%d %H:%M:%S') AS started, u.id, u.device_id, u.firmware_version AS target_version,
  {_HIST_LABEL} AS status, {_duration('-')} AS duration, COALESCE(u.error_message, '-') AS message,
  d.device_model AS model, d.current_firmware_version AS from_version
FROM (SELECT * FROM updates ORDER BY started_at DESC NULLS FIRST, id DESC LIMIT 20) u
LEFT JOIN devices d ON u.device_id = d.device_id""")

sql("recent_updates_device", "updates")(f"""
SELECT strftime(u.started_at, '%Y-%m-%d %H:%M:%S') AS started, u.id, u.device_id, u.firmware_version AS target_version,
  {_HIST_LABEL} AS status, {_duration('Ongoing')} AS duration,
  COALESCE(CASE WHEN length(u.error_message) > 50 THEN left(u.error_message, 50) || '...' ELSE u.error_message END, '-') AS message
FROM updates u WHERE regexp_matches(u.device_id, '.*')
ORDER BY u.started_at DESC NULLS FIRST, u.id DESC LIMIT 30""")

sql("recent_rows", "power")(f"""
SELECT device_sn, ts, l_orderkey, l_linenumber, soc_percent, watts_in_sum, watts_out_sum, pv_in_watts, remain_time_min
FROM power ORDER BY {POWER_DESC} LIMIT 20""")

sql("latest_uptime", "status")("""
SELECT DISTINCT ON (device_id) device_id, CAST(s_uptime AS DOUBLE) AS value FROM status
WHERE s_uptime IS NOT NULL ORDER BY device_id, ts DESC, event_id DESC""")

sql("status_log", "status")("""
SELECT device_id, ts, event_id, s_state AS state, s_signal AS signal_strength_dbm, s_uptime AS uptime_seconds FROM status
ORDER BY ts DESC, event_id DESC LIMIT 50""")

sql("raw_series", "status")(f"""
SELECT ts, device_id, event_id, CAST(s_signal AS DOUBLE) AS rssi FROM status
WHERE s_signal IS NOT NULL AND ts > {AS_OF['events']} - INTERVAL '2 days' AND ts < {AS_OF['events']}
ORDER BY ts""")

sql("device_list", "power")("""
SELECT DISTINCT device_sn FROM power WHERE device_sn IS NOT NULL AND device_sn <> '' ORDER BY 1""")

sql("devices_by_last_seen", "devices")("""
SELECT device_id, device_model, last_seen FROM devices ORDER BY last_seen DESC NULLS LAST, device_id""")

sql("list_devices", "devices")("""
SELECT device_id, device_model, current_firmware_version, last_seen, created_at FROM devices
WHERE device_model = 'MACHINERY' ORDER BY last_seen DESC NULLS FIRST, device_id LIMIT 50""")

sql("firmware_history", "releases")("""
SELECT * FROM releases ORDER BY created_at DESC, version DESC, device_model LIMIT 10""")

sql("update_status_list", "updates")("""
SELECT device_id, firmware_version, status, error_message, progress_percent, started_at, completed_at, reported_at
FROM updates WHERE firmware_version = '1-URGENT' ORDER BY reported_at DESC, id DESC LIMIT 50""")

# ------------------------------------------------------------------ rollouts


def hash_fold(col: str) -> str:
    """``int(sha256(col), 16) % 100`` by Horner's rule over eight 32-bit chunks."""
    acc = "0"
    for i in range(8):
        chunk = f"CAST(('0x' || substr(sha256({col}), {8 * i + 1}, 8)) AS UBIGINT)"
        acc = f"(({acc}) * 96 + {chunk}) % 100"
    return f"CAST({acc} AS INTEGER)"


sql("hash_bucket", "devices")(f"""
SELECT device_id, {hash_fold('device_id')} AS bucket, {hash_fold('device_id')} < 50 AS selected FROM devices""")

sql("rollout_coverage", "devices")(f"""
SELECT percentage,
  CAST(SUM(CASE WHEN percentage >= 100 THEN 1 WHEN percentage <= 0 THEN 0 WHEN bucket < percentage THEN 1 ELSE 0 END)
       AS BIGINT) AS selected,
  COUNT(*) AS total,
  ROUND(CAST(SUM(CASE WHEN percentage >= 100 THEN 1 WHEN percentage <= 0 THEN 0 WHEN bucket < percentage THEN 1 ELSE 0 END)
        AS DOUBLE) / COUNT(*), 6) AS share
FROM (SELECT {hash_fold('device_id')} AS bucket FROM devices) b,
     (SELECT unnest([0, 10, 25, 40, 50, 75, 90, 100]) AS percentage) p
GROUP BY percentage""")

_DECISIONS = f"""
SELECT device_id, device_model, current_version, latest_version, reason = 'update' AS update_available, reason FROM (
 SELECT d.device_id, d.device_model, d.current_firmware_version AS current_version, lr.latest_version,
  CASE WHEN lr.latest_version IS NULL THEN 'no_release'
       WHEN lr.latest_version = d.current_firmware_version THEN 'up_to_date'
       WHEN ar.target_type IS NULL THEN 'no_rollout'
       WHEN NOT COALESCE(CASE
            WHEN ar.target_type IN ('all', 'canary', 'group') THEN
              (CASE WHEN ar.rollout_percentage >= 100 THEN TRUE WHEN ar.rollout_percentage <= 0 THEN FALSE
                    ELSE {hash_fold('d.device_id')} < ar.rollout_percentage END)
            WHEN ar.target_type = 'specific' THEN d.device_id IN (SELECT c_name FROM customer WHERE c_custkey % 50 = 0)
            ELSE FALSE END, FALSE) THEN 'not_eligible'
       ELSE 'update' END AS reason
 FROM devices d
 LEFT JOIN latest_rel lr ON d.device_model = lr.device_model
 LEFT JOIN (SELECT * FROM rollouts WHERE is_active
            QUALIFY row_number() OVER (PARTITION BY device_model, firmware_version ORDER BY created_at DESC, name DESC) = 1) ar
   ON ar.device_model = d.device_model AND ar.firmware_version = lr.latest_version)"""

sql("update_decisions", "devices", "latest_rel", "rollouts")(_DECISIONS)

sql("decision_events", "devices", "latest_rel", "rollouts")(f"""
SELECT 'update_started' AS event_type, device_id, latest_version AS firmware_version,
  CASE WHEN current_version IS NULL THEN '{{}}' ELSE '{{"from_version":"' || current_version || '"}}' END AS event_data
FROM ({_DECISIONS}) WHERE update_available""")

sql("check_rollout_rows", "rollouts")("""
SELECT COUNT(*) AS rows,
  COUNT(*) FILTER (WHERE target_type NOT IN ('all', 'group', 'canary', 'specific')) AS bad_target_type,
  COUNT(*) FILTER (WHERE NOT COALESCE(rollout_percentage BETWEEN 0 AND 100, TRUE)) AS bad_percentage FROM rollouts""")

# ------------------------------------------------------------------ power transforms

cte("raw", """
  SELECT CAST(l_suppkey AS VARCHAR) AS device_sn, l_shipdate AS ts, l_orderkey, l_linenumber, l_returnflag,
    CASE WHEN l_linenumber <= 3 THEN l_extendedprice / 100 END AS k_watts_in,
    CASE WHEN l_linenumber BETWEEN 4 AND 5 THEN l_extendedprice / 50 END AS k_bms_input,
    CASE WHEN l_linenumber % 2 = 1 THEN l_quantity * 10 END AS k_watts_out,
    CASE WHEN l_linenumber % 2 = 0 THEN l_quantity * 7 END AS k_inv_output,
    CAST(ROUND(100 - l_discount * 1000) AS INTEGER) AS k_soc,
    CASE WHEN l_linenumber <> 2 THEN CAST(l_partkey % 1440 AS INTEGER) END AS k_remain,
    CASE WHEN l_linenumber <= 4 THEN l_tax * 100 END AS k_typec1,
    CASE WHEN l_linenumber >= 3 THEN l_discount * 100 END AS k_typec2,
    CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END AS k_usb1,
    CASE WHEN l_returnflag <> 'N' THEN l_tax * 1000 END AS k_mppt_in,
    CASE WHEN l_linenumber = 1 THEN CAST(ROUND(l_extendedprice / 100) AS INTEGER) END AS watts_in_sum,
    CASE WHEN l_linenumber = 1 THEN 50 END AS soc_percent
  FROM lineitem""")

RAW_KEYS = "device_sn, ts, l_orderkey, l_linenumber"


def _i(e: str) -> str:
    return f"CAST(ROUND({e}) AS INTEGER)"


sql("flatten_power", "raw")(f"""
SELECT {RAW_KEYS}, 0 AS soc_percent, COALESCE(k_remain, 0) AS remain_time_min,
  {_i('COALESCE(k_watts_in, 0)')} AS watts_in_sum, {_i('COALESCE(k_watts_out, 0)')} AS watts_out_sum,
  {_i('COALESCE(k_inv_output, 0)')} AS ac_out_watts, {_i('COALESCE(k_mppt_in, 0)')} AS pv_in_watts,
  0 AS car_watts, {_i('COALESCE(k_usb1, 0)')} AS dc_out_watts,
  {_i('COALESCE(k_typec1, 0) + COALESCE(k_typec2, 0)')} AS typec_out_watts,
  {_i('COALESCE(k_usb1, 0)')} AS usb_out_watts, CAST(NULL AS DOUBLE) AS inv_input_watts, FALSE AS rejected
FROM raw""")

sql("power_summary", "raw")(f"""
SELECT DISTINCT ON (device_sn) device_sn, CAST(0 AS DOUBLE) AS soc, ROUND(COALESCE(k_mppt_in, 0), 6) AS solar_w,
  CAST(0 AS DOUBLE) AS ac_in_w, ROUND(COALESCE(k_inv_output, 0), 6) AS ac_out_w,
  ROUND(COALESCE(k_usb1, 0) + COALESCE(k_typec1, 0) + COALESCE(k_typec2, 0), 6) AS dc_out_w,
  ROUND(COALESCE(k_watts_in, 0), 6) AS watts_in, ROUND(COALESCE(k_watts_out, 0), 6) AS watts_out
FROM raw ORDER BY device_sn, ts DESC, l_orderkey DESC, l_linenumber DESC""")

sql("backfill", "raw")(f"""
SELECT {RAW_KEYS},
  COALESCE(watts_in_sum, {_i('COALESCE(k_watts_in, k_bms_input)')}) AS watts_in_sum,
  {_i('COALESCE(k_watts_out, k_inv_output)')} AS watts_out_sum,
  COALESCE(soc_percent, k_soc) AS soc_percent,
  k_remain AS remain_time_min,
  {_i('k_inv_output')} AS ac_out_watts,
  CAST(NULL AS INTEGER) AS dc_out_watts,
  {_i('k_mppt_in')} AS pv_in_watts,
  CASE WHEN (k_typec1 IS NOT NULL OR k_typec2 IS NOT NULL) AND (k_typec1 > 0 OR k_typec2 > 0)
       THEN {_i('COALESCE(k_typec1 + COALESCE(k_typec2, 0), 0)')} END AS typec_out_watts,
  CASE WHEN k_usb1 IS NOT NULL AND k_usb1 > 0 THEN {_i('COALESCE(k_usb1, 0)')} END AS usb_out_watts
FROM raw""")

sql("net_watts", "power")("""
SELECT device_sn, ts, l_orderkey, l_linenumber,
  COALESCE(watts_in_sum, 0) - COALESCE(watts_out_sum, 0) AS net_watts,
  ROUND(watts_out_sum / NULLIF(soc_percent, 0), 6) AS watts_per_percent,
  ac_out_watts + car_watts + typec_out_watts + usb_out_watts AS watts_out_components,
  ROUND(bms_temp / 10.0, 6) AS bms_temp_scaled
FROM power""")

sql("fmt_minutes", "power")("""
SELECT DISTINCT remain_time_min,
  CONCAT(CAST(FLOOR(remain_time_min / 60) AS BIGINT), 'h ', remain_time_min % 60, 'm') AS remain_text
FROM power""")


def _r(e: str) -> str:
    return f"CAST(CAST(ROUND({e}) AS BIGINT) AS VARCHAR)"


sql("fmt_uptime", "status")(f"""
SELECT event_id, device_id,
  {_uptime('s_uptime')} AS uptime_coarse,
  CASE WHEN u >= 3600 THEN {_r('u / 3600')} || 'h' WHEN u >= 60 THEN {_r('u / 60')} || 'm'
       WHEN u IS NOT NULL THEN {_r('u')} || 's' ELSE '-' END AS uptime_table,
  CASE WHEN u >= 86400 THEN {_r('u / 86400')} || 'd ' || {_r('(u % 86400) / 3600')} || 'h'
       WHEN u >= 3600 THEN {_r('u / 3600')} || 'h ' || {_r('(u % 3600) / 60')} || 'm'
       WHEN u >= 60 THEN {_r('u / 60')} || 'm' ELSE {_r('u')} || 's' END AS uptime_detail,
  ROUND(u / 3600, 6) AS uptime_hours
FROM (SELECT *, CAST(s_uptime AS DOUBLE) AS u FROM status WHERE s_uptime IS NOT NULL)""")

sql("value_bands", "power")("""
SELECT device_sn, ts, l_orderkey, l_linenumber,
  CASE WHEN soc_percent IS NULL THEN NULL WHEN soc_percent >= 60 THEN 'green' WHEN soc_percent >= 30 THEN 'yellow'
       WHEN soc_percent >= 15 THEN 'orange' ELSE 'red' END AS soc_band,
  CASE WHEN bms_temp IS NULL THEN NULL WHEN bms_temp >= 85 THEN 'red' WHEN bms_temp >= 70 THEN 'orange'
       WHEN bms_temp >= 30 THEN 'green' ELSE 'blue' END AS temp_band
FROM power""")

sql("metric_bands", "measurements", "status")("""
SELECT device_id, ts, event_id, metric,
  CASE metric
    WHEN 'battery_v' THEN CASE WHEN value < 11.5 THEN 'red' WHEN value < 12.2 THEN 'yellow' ELSE 'green' END
    WHEN 'coolant_temp_c' THEN CASE WHEN value < 30 THEN 'blue' WHEN value < 70 THEN 'green' WHEN value < 85 THEN 'yellow' ELSE 'red' END
    WHEN 'core_temp_c' THEN CASE WHEN value < 95 THEN 'green' ELSE 'red' END
    WHEN 'flow_lpm' THEN CASE WHEN value < 0.5 THEN 'red' WHEN value < 1.5 THEN 'yellow' ELSE 'green' END
    ELSE CASE WHEN value < -70 THEN 'red' WHEN value < -50 THEN 'yellow' ELSE 'green' END END AS band
FROM (
  SELECT device_id, ts, event_id, 'battery_v' AS metric, m_battery_v AS value FROM measurements
  UNION ALL SELECT device_id, ts, event_id, 'coolant_temp_c', m_temperature FROM measurements
  UNION ALL SELECT device_id, ts, event_id, 'core_temp_c', m_temperature FROM measurements
  UNION ALL SELECT device_id, ts, event_id, 'flow_lpm', m_battery_v / 10 FROM measurements
  UNION ALL SELECT device_id, ts, event_id, 'signal_strength_dbm', CAST(s_signal AS DOUBLE) FROM status)
WHERE value IS NOT NULL""")

sql("online_state", "devices")(f"""
SELECT device_id,
  CASE WHEN last_seen > {AS_OF['orders']} - INTERVAL '30 days' THEN 'online'
       WHEN last_seen > {AS_OF['orders']} - INTERVAL '180 days' THEN 'recent' ELSE 'offline' END AS state3,
  CASE WHEN last_seen > {AS_OF['orders']} - INTERVAL '30 days' THEN 'online' ELSE 'offline' END AS state2
FROM devices""")

# ------------------------------------------------------------------ ingest

cte("msgs", """
  SELECT event_id, user_id, event_type, ts, value, CAST(props->>'k' AS DOUBLE) AS k,
    CASE WHEN event_id % 19 = 0 THEN 'site/' || event_type
         WHEN event_id % 7 = 5 THEN 'site/edge/' || CAST(user_id AS VARCHAR) || '/status'
         WHEN event_id % 7 = 6 THEN 'site/edge/' || CAST(user_id AS VARCHAR) || '/config'
         WHEN event_id % 23 <= 3 THEN 'site/edge/' || CAST(user_id AS VARCHAR) || '/ota/'
           || ['unknown', 'status', 'progress', 'result'][CAST(event_id % 23 AS INTEGER) + 1]
         ELSE 'site/' || event_type || '/' || CAST(user_id AS VARCHAR) || '/data' END AS topic
  FROM events""")

cte("parsed", """
  SELECT *,
    CASE WHEN is_ota AND p[5] IN ('status', 'progress', 'result') THEN 'ota_' || p[5]
         WHEN NOT is_ota AND n = 4 AND p[4] IN ('data', 'status', 'config') THEN p[4] END AS ttype
  FROM (SELECT *, n = 5 AND p[2] = 'edge' AND p[4] = 'ota' AS is_ota
        FROM (SELECT *, string_split(topic, '/') AS p, len(string_split(topic, '/')) AS n FROM msgs))""", ("msgs",))

cte("routed", """
  SELECT *, CASE WHEN reason = 'unhandled' THEN 'dropped' WHEN reason IS NOT NULL THEN 'rejected'
                 WHEN ttype = 'data' THEN 'measurements' WHEN ttype = 'status' THEN 'edge_status'
                 WHEN ttype = 'config' THEN 'edge_config' ELSE 'ota' END AS route
  FROM (SELECT *, CASE
      WHEN ttype IS NULL THEN 'bad_topic'
      WHEN event_id % 17 = 0 THEN 'bad_json'
      WHEN event_id % 17 = 1 THEN 'not_object'
      WHEN ttype = 'data' AND event_id % 17 IN (2, 3, 4) THEN 'invalid_payload'
      WHEN (ttype = 'data' OR (ttype = 'status' AND p[2] = 'edge')) AND event_id % 17 > 4 AND event_id % 31 <> 0 AND event_id % 29 = 0
        THEN 'bad_timestamp'
      WHEN NOT (ttype = 'data' OR p[2] = 'edge') THEN 'unhandled' END AS reason
    FROM parsed)""", ("parsed",))

sql("parse_topics", "parsed")("""
SELECT event_id, CASE WHEN ttype IS NOT NULL THEN p[1] END AS site_id, CASE WHEN ttype IS NOT NULL THEN p[2] END AS system,
  CASE WHEN ttype IS NOT NULL THEN p[3] END AS device_id, ttype AS topic_type,
  regexp_full_match(topic, '[^/]*/[^/]*/[^/]*/data') OR regexp_full_match(topic, '[^/]*/edge/[^/]*/status')
    OR regexp_full_match(topic, '[^/]*/edge/[^/]*/config') OR regexp_full_match(topic, '[^/]*/edge/[^/]*/ota/[^/]*')
    AS subscribed,
  topic LIKE 'site/edge/%' AS edge_topic
FROM parsed""")

sql("route_counts", "routed")("""
SELECT route, reason, COUNT(*) AS count FROM routed GROUP BY 1, 2""")

sql("rejects", "routed")("""
SELECT event_id, topic, reason FROM routed WHERE route IN ('rejected', 'dropped')""")

sql("ingest_measurements", "routed")("""
SELECT 'site' AS site_id, event_type AS system, CAST(user_id AS VARCHAR) AS device_id,
  CASE WHEN user_id % 5 <> 0 AND event_id % 31 <> 0 THEN 'zone' || CAST(user_id % 4 AS VARCHAR) END AS location,
  ts, ROUND(value, 6) AS value, k
FROM routed WHERE route = 'measurements'""")

sql("archive_raw", "msgs")("""
SELECT topic, ts AS received_at, event_id % 17 = 0 AS wrapped,
  CASE WHEN event_id % 17 = 0 THEN 'not json {' END AS raw,
  CASE WHEN event_id % 17 > 4 THEN ROUND(value, 6) END AS value FROM msgs""")

# ------------------------------------------------------------------ update tracking

cte("ota", """
  SELECT CAST(o_custkey AS VARCHAR) AS device_id, o_orderdate AS received_at, o_orderkey AS seq,
    CASE WHEN o_orderkey % 4 = 0 THEN 'status' WHEN o_orderkey % 4 = 3 THEN 'result' ELSE 'progress' END AS kind,
    CASE WHEN o_orderkey % 24 = 12 THEN 'unknown' ELSE o_orderpriority END AS fw,
    ['installing', 'downloaded', 'downloading'][(o_orderkey // 4) % 3 + 1] AS p_status,
    CASE WHEN o_orderkey % 43 = 1 THEN 1000 WHEN o_orderkey % 41 = 1 THEN 1000 WHEN o_orderkey % 37 = 1 THEN 12
         WHEN o_orderkey % 9 = 0 THEN 0 WHEN o_orderkey % 13 = 0 THEN NULL
         ELSE CAST(o_orderkey % 130 AS INTEGER) END AS pct,
    o_orderkey % 4 IN (1, 2) AND o_orderkey % 31 = 5 AS bad_state,
    o_orderkey % 4 = 3 AND o_orderkey % 47 <> 3 AND (o_orderkey % 53 = 3 OR o_orderkey % 59 = 3) AS bad_success,
    o_orderkey % 47 = 3 OR o_orderstatus = 'F' AS success, o_orderkey % 47 <> 3 AND o_orderstatus = 'F' AS sets_full,
    'error ' || CAST(o_orderkey AS VARCHAR) AS message,
    CAST(epoch(o_orderdate) AS BIGINT) * 100000000 + o_orderkey AS ordk
  FROM orders""")

sql("update_attempts", "ota")("""
SELECT device_id, attempt,
  max(fw) FILTER (WHERE kind = 'status') AS firmware_version,
  arg_max_null(new_status, ordk) AS status,
  arg_max_null(pct2, ordk) FILTER (WHERE sets_pct) AS progress_percent,
  arg_max_null(err, ordk) FILTER (WHERE kind = 'result') AS error_message,
  max(received_at) FILTER (WHERE kind = 'status') AS started_at,
  max(received_at) FILTER (WHERE kind = 'result') AS completed_at,
  max(received_at) AS reported_at,
  COUNT(*) AS messages
FROM (SELECT *, CAST(SUM(CASE WHEN kind = 'status' THEN 1 ELSE 0 END)
                  OVER (PARTITION BY device_id ORDER BY received_at, seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS attempt,
        CASE kind WHEN 'status' THEN 'pending' WHEN 'progress' THEN p_status
             ELSE CASE WHEN success THEN 'success' ELSE 'failed' END END AS new_status,
        CASE WHEN kind = 'progress' THEN pct WHEN kind = 'result' THEN 100 END AS pct2,
        kind = 'progress' OR (kind = 'result' AND sets_full) AS sets_pct,
        CASE WHEN kind = 'result' AND NOT success THEN message END AS err
      FROM ota WHERE NOT bad_state AND NOT bad_success AND NOT COALESCE(kind = 'progress' AND pct > 100, FALSE))
WHERE attempt > 0
GROUP BY device_id, attempt""")

sql("ota_event_log", "ota")("""
SELECT CASE WHEN kind = 'status' THEN 'update_started' WHEN success THEN 'update_completed' ELSE 'update_failed' END
         AS event_type,
       device_id, CASE WHEN kind = 'status' THEN fw ELSE 'unknown' END AS firmware_version, received_at, seq
FROM ota WHERE kind IN ('status', 'result') AND NOT bad_success""")

sql("update_reports", "updates")("""
SELECT id, device_id, status, CASE WHEN status = 'downloading' THEN reported_at END AS report_started_at,
  CASE WHEN status IN ('success', 'failed') THEN reported_at END AS report_completed_at,
  status IN ('pending', 'downloading', 'downloaded', 'installing', 'success', 'failed', 'rolled_back')
    AND COALESCE(progress_percent BETWEEN 0 AND 100, TRUE) AS valid
FROM updates""")

sql("apply_success", "devices", "updates")("""
SELECT d.device_id, COALESCE(s.fw, d.current_firmware_version) AS current_firmware_version,
  CASE WHEN s.seen IS NULL THEN d.last_seen WHEN d.last_seen IS NULL THEN s.seen
       ELSE greatest(s.seen, d.last_seen) END AS last_seen
FROM devices d LEFT JOIN (
  SELECT device_id, first(firmware_version ORDER BY reported_at DESC, id DESC) AS fw, max(reported_at) AS seen
  FROM updates WHERE status = 'success' GROUP BY device_id) s ON d.device_id = s.device_id""")

# ------------------------------------------------------------------ alerts

sql("alert_failure_rate", "updates")("""
SELECT firmware_version, COUNT(*) AS finished, COUNT(*) FILTER (WHERE status = 'failed') AS failed,
  ROUND(CAST(COUNT(*) FILTER (WHERE status = 'failed') AS DOUBLE) / COUNT(*), 6) AS failure_rate,
  CAST(COUNT(*) FILTER (WHERE status = 'failed') AS DOUBLE) / COUNT(*) > 0.05 AS alert
FROM updates WHERE status IN ('success', 'failed') GROUP BY firmware_version""")

sql("alert_offline_after_update", "devices", "updates")(f"""
SELECT d.device_id, l.updated_at, d.last_seen FROM devices d
JOIN (SELECT device_id, max(completed_at) AS updated_at FROM updates
      WHERE status = 'success' AND completed_at IS NOT NULL GROUP BY 1) l ON d.device_id = l.device_id
WHERE {AS_OF['orders']} > l.updated_at + INTERVAL '30 days'
  AND (d.last_seen IS NULL OR d.last_seen < l.updated_at + INTERVAL '30 days')""")

sql("alert_stuck", "updates")(f"""
SELECT device_id, id, firmware_version, status, reported_at FROM (
  SELECT device_id, id, firmware_version, status, reported_at FROM updates
  QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY started_at DESC NULLS FIRST, id DESC) = 1)
WHERE status IN ('downloading', 'installing', 'pending') AND reported_at < {AS_OF['orders']} - INTERVAL '90 days'""")

sql("alert_power", "power")(f"""
SELECT device_sn, alert FROM (
  SELECT device_sn, unnest([
    CASE WHEN soc_percent < 20 THEN 'battery_low' END,
    CASE WHEN watts_out_sum > 300 THEN 'output_high' END,
    CASE WHEN last_ts < {AS_OF['lineitem']} - INTERVAL '5 days' THEN 'no_data' END,
    CASE WHEN remain_time_min < 30 THEN 'remaining_low' END,
    CASE WHEN (CASE WHEN bms_temp IS NULL THEN inv_out_temp WHEN inv_out_temp IS NULL THEN bms_temp
                    ELSE greatest(bms_temp, inv_out_temp) END) > 25 THEN 'temperature_high' END]) AS alert
  FROM (SELECT DISTINCT ON (device_sn) device_sn, soc_percent, watts_out_sum, remain_time_min, bms_temp, inv_out_temp,
          max(ts) OVER (PARTITION BY device_sn) AS last_ts
        FROM power ORDER BY device_sn, ts DESC, l_orderkey DESC, l_linenumber DESC))
WHERE alert IS NOT NULL""")

# ------------------------------------------------------------------ upkeep

sql("upsert_latest", "routed")("""
SELECT DISTINCT ON (device_id) 'site' AS site_id, CAST(user_id AS VARCHAR) AS device_id, ts AS updated_at, event_id,
  CASE WHEN event_id % 17 > 4 THEN ROUND(value, 6) END AS config_value
FROM routed WHERE route = 'edge_config' ORDER BY device_id, ts DESC, event_id DESC""")

cte("sightings", """
  SELECT device_id, CASE WHEN event_id % 8 = 4 THEN '' WHEN event_id % 8 = 1 THEN NULL
                         WHEN CAST(props_k AS BIGINT) % 2 = 0 THEN 'esp32' ELSE 'esp8266' END AS device_model,
         s_firmware AS firmware_version, ts AS seen_at, event_id AS seq
  FROM (SELECT *, CAST(props->>'k' AS BIGINT) AS props_k, 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS device_id,
               'fw' || CAST(CAST(props->>'k' AS BIGINT) % 4 AS VARCHAR) AS s_firmware FROM events)""")

cte("fresh", """
  SELECT device_id,
    first(device_model ORDER BY seen_at DESC, seq DESC) AS last_model,
    first(device_model ORDER BY seen_at, seq) AS first_model,
    first(firmware_version ORDER BY seen_at DESC, seq DESC) AS fw,
    max(seen_at) AS last_seen, min(seen_at) AS created_at
  FROM sightings GROUP BY device_id""", ("sightings",))

cte("fresh_status", """
  SELECT device_id,
    first(device_model ORDER BY seen_at DESC, seq DESC) AS last_model,
    first(firmware_version ORDER BY seen_at DESC, seq DESC) AS fw,
    max(seen_at) AS last_seen, min(seen_at) AS created_at
  FROM sightings WHERE device_model <> '' GROUP BY device_id""", ("sightings",))


def _upsert_devices(mode: str) -> str:
    model = ("CASE WHEN f.last_seen IS NOT NULL THEN f.last_model ELSE r.device_model END" if mode == "status"
             else "CASE WHEN r.device_id IS NOT NULL THEN r.device_model ELSE f.first_model END")
    return f"""
SELECT COALESCE(r.device_id, f.device_id) AS device_id, {model} AS device_model,
  CASE WHEN f.last_seen IS NOT NULL THEN f.fw ELSE r.current_firmware_version END AS current_firmware_version,
  CASE WHEN f.last_seen IS NULL THEN r.last_seen WHEN r.last_seen IS NULL THEN f.last_seen
       ELSE greatest(r.last_seen, f.last_seen) END AS last_seen,
  CASE WHEN r.device_id IS NOT NULL THEN r.created_at ELSE f.created_at END AS created_at
FROM devices r FULL JOIN {"fresh_status" if mode == "status" else "fresh"} f ON r.device_id = f.device_id"""


sql("upsert_devices_status", "devices", "fresh_status")(_upsert_devices("status"))
sql("upsert_devices_check", "devices", "fresh")(_upsert_devices("check"))

sql("migrate_flat")("""
SELECT 'site' AS site_id, 'sensors' AS system, CAST(user_id AS VARCHAR) AS device_id, ts,
  '{' || concat_ws(',',
     '"humidity_percent":' || CAST(CAST(props->>'k' AS INTEGER) AS VARCHAR),
     CASE WHEN event_id % 6 <> 5 THEN '"battery_mv":' || CAST(CAST(floor(value * 100) AS INTEGER) AS VARCHAR) END,
     CASE WHEN event_id % 4 <> 0 THEN '"movement_counter":' || CAST(event_id % 50 AS VARCHAR) END) || '}' AS metrics
FROM events""")

sql("retention", "power")(f"""
SELECT device_sn, ts, l_orderkey, l_linenumber FROM power WHERE ts >= {AS_OF['lineitem']} - INTERVAL '90 days'""")

sql("duplicate_keys", "devices")("""
SELECT device_model, current_firmware_version, COUNT(*) AS count FROM devices GROUP BY 1, 2 HAVING COUNT(*) > 1""")

sql("check_update_rows", "updates")("""
SELECT COUNT(*) AS rows,
  COUNT(*) FILTER (WHERE status NOT IN ('pending', 'downloading', 'downloaded', 'installing', 'success', 'failed',
                                        'rolled_back')) AS bad_status,
  COUNT(*) FILTER (WHERE NOT COALESCE(progress_percent BETWEEN 0 AND 100, TRUE)) AS bad_progress,
  COUNT(*) FILTER (WHERE firmware_version IS NULL) AS missing_version
FROM updates""")

# ------------------------------------------------------------------ legacy flat messages

FLAT_ERROR = """CASE WHEN event_id % 11 = 0 THEN 'Missing required field: sensor_id'
    WHEN event_id % 13 = 0 THEN 'Field ''sensor_id'' has incorrect type: expected str, got int'
    WHEN event_id % 17 = 0 THEN 'Field ''temperature_c'' has incorrect type: expected int or float, got str'
    WHEN event_id % 19 = 0 THEN 'Field ''battery_mv'' has incorrect type: expected int, got float' END"""

sql("validate_flat")(f"""
SELECT event_id, ({FLAT_ERROR}) IS NULL AS ok, {FLAT_ERROR} AS error FROM events""")

sql("migrate_legacy")(f"""
SELECT event_id, 'site' AS site_id, 'sensors' AS system,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS device_id,
  'zone' || CAST(user_id % 4 AS VARCHAR) AS location, ts,
  CASE WHEN event_id % 29 = 0 THEN 'Not a legacy topic' ELSE {FLAT_ERROR} END AS error,
  5 AS n_metrics,
  ROUND(CASE WHEN event_id % 17 <> 0 AND event_id % 23 = 0 THEN floor(value / 10) ELSE value / 10 END, 6) AS temperature
FROM events""")

# ------------------------------------------------------------------ streams

sql("stream_ingest", "routed")("""
SELECT 'measurements' AS sink, COUNT(*) FILTER (WHERE route = 'measurements') AS rows FROM routed
UNION ALL SELECT 'edge_status', COUNT(*) FILTER (WHERE route = 'edge_status') FROM routed
UNION ALL SELECT 'edge_config', COUNT(*) FILTER (WHERE route = 'edge_config') FROM routed
UNION ALL SELECT 'ota_messages', COUNT(*) FILTER (WHERE route = 'ota') FROM routed
UNION ALL SELECT 'rejects', COUNT(*) FILTER (WHERE route IN ('rejected', 'dropped')) FROM routed""")

sql("stream_edge_status", "routed")("""
SELECT 'site' AS site_id, CAST(user_id AS VARCHAR) AS device_id, ts, ts AS received_at,
  CASE WHEN whole AND event_id % 4 <> 1 THEN CASE WHEN event_id % 4 = 3 THEN '' ELSE 'm' || CAST(event_id % 3 AS VARCHAR) END END AS device_model,
  CASE WHEN whole AND event_id % 5 <> 2 THEN 'fw' || CAST(event_id % 6 AS VARCHAR) END AS firmware_version,
  CASE WHEN event_id % 17 = 2 THEN 1 WHEN NOT whole THEN 2
       ELSE 3 + CAST(event_id % 4 <> 1 AS INTEGER) + CAST(event_id % 5 <> 2 AS INTEGER) + CAST(user_id % 5 <> 0 AS INTEGER) END AS n_fields
FROM (SELECT *, event_id % 17 > 4 AND event_id % 31 <> 0 AS whole FROM routed WHERE route = 'edge_status')""")

for _name, _query in (("stream_update_attempts", "update_attempts"), ("stream_state_intervals", "state_intervals"),
                      ("stream_gap_segments", "gap_segments"), ("stream_ingest_twice", "ingest_measurements")):
    SQL[_name] = SQL[_query]

sql("ingest_update_attempts", "routed")("""
SELECT CAST(user_id AS VARCHAR) AS device_id, attempt, 'unknown' AS firmware_version,
  first(CASE ttype WHEN 'ota_status' THEN 'pending' WHEN 'ota_progress' THEN 'downloading' ELSE 'failed' END
        ORDER BY ts DESC, event_id DESC) AS status,
  max(0) FILTER (WHERE ttype = 'ota_progress') AS progress_percent,
  max(ts) FILTER (WHERE ttype = 'ota_status') AS started_at, max(ts) FILTER (WHERE ttype = 'ota_result') AS completed_at,
  max(ts) AS reported_at, COUNT(*) AS messages
FROM (SELECT *, CAST(SUM(CASE WHEN ttype = 'ota_status' THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS attempt
      FROM routed WHERE route = 'ota')
WHERE attempt > 0 GROUP BY user_id, attempt""")

sql("ingest_registry", "parsed")("""
SELECT CAST(user_id AS VARCHAR) AS device_id,
  first('m' || CAST(event_id % 3 AS VARCHAR) ORDER BY ts DESC, event_id DESC) AS device_model,
  first(CASE WHEN event_id % 5 <> 2 THEN 'fw' || CAST(event_id % 6 AS VARCHAR) END ORDER BY ts DESC, event_id DESC)
    AS current_firmware_version,
  max(ts) AS last_seen, min(ts) AS created_at
FROM parsed WHERE ttype = 'status' AND event_id % 17 > 4 AND event_id % 31 <> 0 AND event_id % 4 NOT IN (1, 3)
GROUP BY user_id""")
for _name, _query in (("stream_ingest_attempts", "ingest_update_attempts"), ("stream_ingest_registry", "ingest_registry")):
    SQL[_name] = SQL[_query]

# ------------------------------------------------------------------ snapshots, nested payloads, schema

sql("power_snapshots", "raw")(f"""
SELECT {RAW_KEYS}, 0 AS soc_percent, {_i('COALESCE(k_watts_in, 0)')} AS watts_in_sum,
  {_i('COALESCE(k_watts_out, 0)')} AS watts_out_sum,
  {_i('COALESCE(k_typec1, 0) + COALESCE(k_typec2, 0)')} AS typec_out_watts
FROM raw WHERE l_linenumber NOT IN (6, 7)""")

sql("flatten_nested")("""
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber = 5 THEN 'unknown' ELSE CAST(l_suppkey AS VARCHAR) END AS device_sn,
  CAST(ROUND(100 - l_discount * 1000) AS DOUBLE) AS soc_percent,
  CAST(l_partkey % 1440 AS DOUBLE) AS remain_time_min,
  ROUND(CASE WHEN l_linenumber % 2 = 1 AND l_extendedprice <> 0 THEN l_extendedprice / 100
             ELSE l_extendedprice / 200 END, 6) AS watts_in_sum,
  ROUND(l_quantity * 10, 6) AS watts_out_sum, ROUND(l_quantity * 7, 6) AS ac_out_watts,
  CAST(NULL AS DOUBLE) AS dc_out_watts, CAST(NULL AS DOUBLE) AS typec_out_watts, CAST(NULL AS DOUBLE) AS usb_out_watts,
  ROUND(CASE WHEN l_returnflag <> 'N' THEN l_tax * 1000 END, 6) AS pv_in_watts
FROM lineitem""")

sql("bucket_avg_scaled", "power")(f"""
SELECT {tb('7 days')} AS time, ROUND(AVG(remain_time_min) * (CAST(1 AS DOUBLE) / 60), 6) AS value,
  'Remaining (h)' AS metric
FROM power GROUP BY 1""")

sql("power_series", "power")(f"""
SELECT ts, device_sn, l_orderkey, l_linenumber, ROUND(bms_temp, 6) AS bms_temp, ROUND(inv_out_temp, 6) AS inv_out_temp,
  ROUND(mppt_temp, 6) AS mppt_temp
FROM power WHERE (bms_temp IS NOT NULL OR inv_out_temp IS NOT NULL)
  AND ts BETWEEN {AS_OF['lineitem']} - INTERVAL '60 days' AND {AS_OF['lineitem']}""")

sql("align_schema", "raw")("""
SELECT device_sn, ts, soc_percent, CAST(NULL AS INTEGER) AS remain_time_min, watts_in_sum,
  CAST(NULL AS INTEGER) AS watts_out_sum, CAST(NULL AS INTEGER) AS ac_out_watts, CAST(NULL AS INTEGER) AS dc_out_watts,
  CAST(NULL AS INTEGER) AS typec_out_watts, CAST(NULL AS INTEGER) AS usb_out_watts, CAST(NULL AS INTEGER) AS pv_in_watts,
  CAST(NULL AS INTEGER) AS car_watts, CAST(NULL AS INTEGER) AS bms_cycles,
  CAST(NULL AS DOUBLE) AS inv_out_temp, CAST(NULL AS DOUBLE) AS bms_temp, CAST(NULL AS DOUBLE) AS mppt_temp,
  CAST(NULL AS DOUBLE) AS inv_input_watts, CAST(NULL AS DOUBLE) AS bms_vol, CAST(NULL AS DOUBLE) AS bms_amp,
  l_orderkey, l_linenumber
FROM raw""")

sql("stream_bucket_avg", "power")(f"""
SELECT {tb('7 days')} AS time, ROUND(AVG(soc_percent), 6) AS value, COUNT(*) AS rows FROM power GROUP BY 1""")

SQL["stream_latest_config"] = SQL["upsert_latest"]

sql("stream_bucket_exact", "power")(f"""
SELECT {tb('1 day')} AS time, ROUND(AVG(soc_percent), 6) AS value, COUNT(*) AS rows FROM power GROUP BY 1""")


# ------------------------------------------------------------------ alerts as streams: the watermark is an hour behind the newest row

sql("stream_alert_no_data", "measurements")("""
SELECT device_id, make_timestamp((epoch_us(max(ts)) // 1000 + 12 * 3600000) * 1000) AS at FROM measurements GROUP BY device_id
HAVING epoch_us(max(ts)) // 1000 + 12 * 3600000 < (SELECT epoch_us(max(ts)) // 1000 FROM measurements) - 3600000""")

sql("stream_alert_stuck", "updates")("""
SELECT device_id, reported_at + INTERVAL '90 days' AS at
FROM (SELECT device_id, status, reported_at, max(reported_at) OVER (PARTITION BY device_id) AS newest FROM updates)
WHERE reported_at = newest GROUP BY device_id, reported_at
HAVING bool_and(status IN ('downloading', 'installing', 'pending'))
  AND reported_at + INTERVAL '90 days' < (SELECT max(reported_at) FROM updates) - INTERVAL '1 hour'""")

sql("stream_alert_offline", "updates")("""
SELECT device_id, newest + INTERVAL '30 days' AS at
FROM (SELECT device_id, max(reported_at) FILTER (status = 'success') AS newest, max(reported_at) FILTER (status <> 'success') AS seen
      FROM updates GROUP BY device_id)
WHERE newest + INTERVAL '30 days' < (SELECT max(reported_at) FROM updates) - INTERVAL '1 hour'
  AND (seen IS NULL OR seen < newest + INTERVAL '30 days')""")


# ------------------------------------------------------------------ written tables, read back

sql("refresh_latest_view", "power")(f"""
SELECT DISTINCT ON (device_sn) device_sn, ts, soc_percent, watts_out_sum
FROM power WHERE strftime(ts, '%Y-%m') < (SELECT strftime(max(ts), '%Y-%m') FROM power) ORDER BY device_sn, {POWER_DESC}""")

sql("dated_snapshot", "devices")("""
SELECT dt, device_id, device_model, current_firmware_version, last_seen FROM devices, (VALUES ('2024-01-06'), ('2024-01-09')) AS d(dt)""")

sql("export_roundtrip", "devices")("""
SELECT fmt, device_id, device_model, current_firmware_version FROM devices, (VALUES ('csv'), ('json')) AS f(fmt)""")
