"""Registered queries: one per operator family, over the driver tables of one sf.

Each entry is ``fn(spark, sf_dir) -> DataFrame``. Computed columns carry the
same names as the SQL in ``fleetspark.plans.oracle``; doubles are rounded to 6
places on both sides so that summation order cannot change the compare.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType

from fleetspark.functions import formats as fm
from fleetspark.functions import predicates as pr
from fleetspark.functions.jsonmap import MAP_SCHEMA, has_metric, keep_last, metric, metric_text
from fleetspark.operators import buckets as bk
from fleetspark.operators import fleet as fl
from fleetspark.operators import latest as lt
from fleetspark.operators import alerts as al
from fleetspark.operators import power as pw
from fleetspark.operators import rollout as ro
from fleetspark.operators import runs as rn
from fleetspark.operators import updates as up
from fleetspark.operators import upkeep as uk
from fleetspark import bindings as B
from fleetspark.sources import legacy as lg
from fleetspark.sources import messages as ms
from fleetspark.plans.context import Telemetry
from fleetspark.schemas import POWER_SCHEMA

QUERIES: dict[str, Callable[[Telemetry], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating columns so engines with different summation order agree."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def _label():
    return F.concat(F.col("device_id"), F.lit(" ("), F.coalesce(F.col("location"), F.lit("unknown")), F.lit(")"))


# ------------------------------------------------------------------ buckets

@query("bucket_avg_label")
def q_bucket_avg_label(t: Telemetry) -> DataFrame:
    """A2 + P8/P9: 6-hour mean temperature per device label (env panel)."""
    m = t.measurements
    return bk.bucket_avg(m, "ts", metric("temperature_c"), "6 hours", by=["device_id", "location"],
                         label=_label(), where=(F.col("site_id") == "site") & has_metric("temperature_c"))


@query("bucket_avg_single")
def q_bucket_avg_single(t: Telemetry) -> DataFrame:
    """A1: weekly mean SOC, one series."""
    return bk.bucket_avg(t.power, "ts", "soc_percent", "7 days", metric="Akku SOC (%)")


@query("bucket_avg_zero")
def q_bucket_avg_zero(t: Telemetry) -> DataFrame:
    """A3: weekly mean solar input with NULL counted as 0."""
    return bk.bucket_avg(t.power, "ts", "pv_in_watts", "7 days", null_as_zero=True, metric="Solar")


@query("bucket_wide")
def q_bucket_wide(t: Telemetry) -> DataFrame:
    """A4: four output means per device and 30-day bucket, NULL as 0."""
    return bk.bucket_avg_wide(t.power, "ts", {"ac_output_w": "ac_out_watts", "dc_output_w": "car_watts",
                                              "usbc_w": "typec_out_watts", "usba_w": "usb_out_watts"},
                              "30 days", by=["device_sn"], null_as_zero=True)


@query("bucket_net_of_avgs")
def q_bucket_net_of_avgs(t: Telemetry) -> DataFrame:
    """A5 (v2 panel): AVG(in) - AVG(out) per week."""
    return bk.bucket_net(t.power, "ts", "watts_in_sum", "watts_out_sum", "7 days", "of_avgs")


@query("bucket_avg_of_net")
def q_bucket_avg_of_net(t: Telemetry) -> DataFrame:
    """A5 (legacy panel): AVG(COALESCE(in,0) - COALESCE(out,0)) per week."""
    return bk.bucket_net(t.power, "ts", "pv_in_watts", "typec_out_watts", "7 days", "avg_of_net")


@query("dew_point")
def q_dew_point(t: Telemetry) -> DataFrame:
    """Dew point from 6-hour means per device label."""
    m = t.measurements
    where = has_metric("temperature_c") & has_metric("humidity_percent")
    return bk.bucket_dew_point(m, "ts", metric("temperature_c"), metric("humidity_percent"), "6 hours",
                               by=["device_id", "location"], label=_label(), where=where)


@query("abs_humidity")
def q_abs_humidity(t: Telemetry) -> DataFrame:
    """Absolute humidity from 6-hour means per device label."""
    m = t.measurements
    where = has_metric("temperature_c") & has_metric("humidity_percent")
    return bk.bucket_abs_humidity(m, "ts", metric("temperature_c"), metric("humidity_percent"), "6 hours",
                                  by=["device_id", "location"], label=_label(), where=where)


@query("message_rate_5m")
def q_message_rate(t: Telemetry) -> DataFrame:
    """A8 + P12/P14: status messages per 5 minutes per device in the last 7 days (exclusive ends)."""
    s = t.status
    as_of = t.events_as_of
    s = s.where(pr.time_between("ts", as_of - F.expr("INTERVAL 7 DAYS"), as_of, "neither")
                & pr.device_matches(F.col("device_id"), ".*"))
    return bk.message_rate(s, "ts", "5 minutes", ["device_id"])


@query("bucket_count")
def q_bucket_count(t: Telemetry) -> DataFrame:
    """Rows per hour."""
    return bk.bucket_count(t.measurements, "ts", "1 hour")


@query("series_long")
def q_series_long(t: Telemetry) -> DataFrame:
    """U1 + P16: seven labelled weekly series in one scan (filtered temperature series drop
    empty buckets, X-16)."""
    c = F.col
    return bk.series_long(t.power, "ts", {
        "In": {"value": "watts_in_sum"},
        "Out": {"value": "watts_out_sum"},
        "Net": {"net": ("watts_in_sum", "watts_out_sum")},
        "Solar": {"value": "pv_in_watts", "null_as_zero": True},
        "BMS": {"value": "bms_temp", "where": pr.valid_reading(c("bms_temp"))},
        "Inverter": {"value": "inv_out_temp", "where": pr.valid_reading(c("inv_out_temp"))},
        "MPPT": {"value": "mppt_temp", "where": pr.valid_reading(c("mppt_temp"))},
    }, "7 days")


@query("all_temperatures")
def q_all_temperatures(t: Telemetry) -> DataFrame:
    """Sensor temperatures and power-station temperatures in one long result."""
    m = t.measurements
    sensors = bk.bucket_avg(m, "ts", metric("temperature_c"), "1 day", by=["device_id", "location"],
                            label=_label(), where=has_metric("temperature_c"))
    p = t.power
    parts = [sensors]
    for col, name in (("inv_out_temp", "Inverter Out"), ("bms_temp", "BMS"), ("mppt_temp", "MPPT")):
        parts.append(bk.bucket_avg(p, "ts", col, "1 day", metric=name, where=F.col(col).isNotNull()))
    return bk.all_temperatures(parts)


# ------------------------------------------------------------------ latest

@query("latest_nulls_first")
def q_latest_nulls_first(t: Telemetry) -> DataFrame:
    """Newest update attempt per device, started_at DESC with NULL first (X-2)."""
    return lt.latest_by(t.updates, ["device_id"], ["started_at", "id"],
                        ["id", "firmware_version", "status", "started_at", "completed_at"], nulls="first")


_POWER_ORDER = ["ts", "l_orderkey", "l_linenumber"]


@query("latest_value")
def q_latest_value(t: Telemetry) -> DataFrame:
    """W2 + T7: newest value per device, NULL -> 0, and the newest net power."""
    p = t.power
    cols = ["soc_percent", "watts_in_sum", "watts_out_sum", "pv_in_watts", "bms_temp", "inv_out_temp",
            "remain_time_min"]
    # take the newest row first, derive and format on one row per device afterwards
    last = p.groupBy("device_sn").agg(
        F.max_by(F.struct(*cols), lt.order_key(_POWER_ORDER, "last")).alias("r")).select("device_sn", "r.*")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return last.select(
        "device_sn", z("soc_percent").alias("soc"), z("watts_in_sum").alias("watts_in"),
        z("watts_out_sum").alias("watts_out"), z("pv_in_watts").alias("pv_in"),
        F.coalesce(F.col("bms_temp"), F.lit(0.0)).alias("bms_temp"), F.col("inv_out_temp").alias("inv_out_temp_raw"),
        pw.net_watts().alias("net_watts"), fm.fmt_minutes(F.col("remain_time_min")).alias("remain_text"))


@query("latest_non_null")
def q_latest_non_null(t: Telemetry) -> DataFrame:
    """Newest non-NULL solar input per device."""
    return lt.latest_non_null(t.power, ["device_sn"], "pv_in_watts", _POWER_ORDER, name="pv_in_watts")


@query("latest_staleness")
def q_latest_staleness(t: Telemetry) -> DataFrame:
    """Newest row per device plus staleness seconds against as_of."""
    return lt.latest_with_staleness(t.power, ["device_sn"], "ts", _POWER_ORDER,
                                    ["soc_percent", "watts_in_sum", "watts_out_sum", "pv_in_watts"],
                                    t.lineitem_as_of)


@query("latest_metric")
def q_latest_metric(t: Telemetry) -> DataFrame:
    """W4 + P22: newest heater state code and battery voltage per system, from rows having the key."""
    m = t.measurements
    order = ["ts", "event_id"]
    st = lt.latest_non_null(m.where(has_metric("heater_state")), ["system"],
                            fm.heater_state_code(metric_text("heater_state")), order, name="state_code")
    bv = lt.latest_non_null(m.where(has_metric("battery_v")), ["system"], metric("battery_v"), order,
                            name="battery_v")
    return st.join(bv, "system", "full")


@query("latest_release")
def q_latest_release(t: Telemetry) -> DataFrame:
    """Newest release per model (created_at, tiebreak version)."""
    return fl.latest_release(t.releases)


@query("latest_release_overall")
def q_latest_release_overall(t: Telemetry) -> DataFrame:
    """``model: version`` of the newest release overall."""
    return lt.latest_release_overall(t.releases)


@query("current_states")
def q_current_states(t: Telemetry) -> DataFrame:
    """W11 + P14: ``state (scenario)`` of each device's newest status."""
    return lt.current_states(t.status, device_filter=".*")


# ------------------------------------------------------------------ runs

def _heater_states(t: Telemetry) -> DataFrame:
    return t.measurements.where(has_metric("heater_state")).select(
        "device_id", "ts", "event_id", metric_text("heater_state").alias("heater_state"))


@query("state_intervals")
def q_state_intervals(t: Telemetry) -> DataFrame:
    """Heater-state runs per device (consecutive equal states merged)."""
    return rn.state_intervals(_heater_states(t), ["device_id"], "ts", "heater_state", "event_id", chunk_seconds=86400)


@query("gap_segments")
def q_gap_segments(t: Telemetry) -> DataFrame:
    """Per-device series segments split at gaps over 4 hours."""
    return rn.gap_segments(t.measurements, ["device_id"], "ts", "event_id", "4 hours", chunk_seconds=86400)


# ------------------------------------------------------------------ fleet

@query("power_stats_last")
def q_power_stats(t: Telemetry) -> DataFrame:
    """A10 + P13: trailing-window rounded mean and peak of output/input per device."""
    return fl.power_stats(t.power, t.lineitem_as_of, "30 days")


@query("update_timeline")
def q_update_timeline(t: Telemetry) -> DataFrame:
    """A11 + P23: daily counts per raw status, labelled after grouping (X-3)."""
    return fl.update_timeline(t.updates, t.orders_as_of, "180 days")


@query("update_activity_hourly")
def q_update_activity(t: Telemetry) -> DataFrame:
    """Hourly counts by status."""
    return fl.update_activity_hourly(t.updates, t.orders_as_of, "30 days")


@query("count_by_model")
def q_count_by_model(t: Telemetry) -> DataFrame:
    """Devices per model."""
    return fl.count_by(t.devices, "device_model")


@query("count_by_firmware")
def q_count_by_firmware(t: Telemetry) -> DataFrame:
    """Devices per firmware version."""
    return fl.count_by(t.devices, "current_firmware_version")


@query("update_success_recent")
def q_update_success_recent(t: Telemetry) -> DataFrame:
    """success/failed counts in the trailing window."""
    where = pr.trailing("reported_at", t.orders_as_of, "180 days") & F.col("status").isin("success", "failed")
    return fl.count_by(t.updates, "status", where)


@query("fleet_counts")
def q_fleet_counts(t: Telemetry) -> DataFrame:
    """A14 + P13/P18: total/online devices, active updates, recent status messages, active rollouts."""
    return fl.fleet_counts(t.devices, t.updates, t.status, t.rollouts, t.orders_as_of, t.events_as_of,
                           online_span="30 days", status_span="1 hour")


@query("table_profile")
def q_table_profile(t: Telemetry) -> DataFrame:
    """Rows, time range and distinct devices of the power table."""
    return fl.profile(t.power, "ts", "device_sn")


@query("non_null_counts")
def q_non_null_counts(t: Telemetry) -> DataFrame:
    """Filled rows per field plus the total, one pass."""
    return fl.non_null_counts(t.power, {"pv_in_watts": "pv_in_watts", "typec_out_watts": "typec_out_watts",
                                        "inv_input_watts": "inv_input_watts", "bms_temp": "bms_temp"})


@query("field_summary")
def q_field_summary(t: Telemetry) -> DataFrame:
    """Per-field records/min/max/avg over the trailing year."""
    return fl.field_summary(t.power, ["soc_percent", "watts_in_sum", "pv_in_watts", "bms_temp"],
                            t.lineitem_as_of, "365 days")


@query("avg_by_location")
def q_avg_by_location(t: Telemetry) -> DataFrame:
    """Mean temperature and readings by location over the last 24 hours."""
    m = t.measurements
    return fl.avg_by_location(m, metric("temperature_c"), t.events_as_of, "24 hours",
                              where=has_metric("temperature_c"))


@query("device_online")
def q_device_online(t: Telemetry) -> DataFrame:
    """Power device online flag from its newest row (30-day threshold)."""
    return fl.device_online(t.power, "device_sn", t.lineitem_as_of, "30 days")


@query("up_to_date")
def q_up_to_date(t: Telemetry) -> DataFrame:
    """Devices on the newest release of their model."""
    return fl.up_to_date_count(t.devices, t.releases)


@query("fleet_metrics")
def q_fleet_metrics(t: Telemetry) -> DataFrame:
    """Metrics bundle as long rows."""
    return fl.fleet_metrics(t.devices, t.updates, t.rollouts, t.orders_as_of, "180 days")


@query("latest_uptime")
def q_latest_uptime(t: Telemetry) -> DataFrame:
    """Newest reported uptime per edge device."""
    return lt.latest_non_null(t.status, ["device_id"], metric("uptime_seconds", "status"), ["ts", "event_id"])


@query("status_log")
def q_status_log(t: Telemetry) -> DataFrame:
    """O1: the newest edge status rows as a table."""
    text = lambda k: metric_text(k, "status").alias(k)
    rows = t.status.select("device_id", "ts", "event_id", text("state"), text("signal_strength_dbm"), text("uptime_seconds"))
    return fl.recent(rows, 50, ["ts", "event_id"])


@query("device_overview")
def q_device_overview(t: Telemetry) -> DataFrame:
    """J1 + T11/T12/P24: device table with latest status, latest update and latest release."""
    return fl.device_overview(t.devices, t.status, t.updates, t.releases, t.orders_as_of,
                              online=("30 days", "180 days"), status_recent="60 days")


@query("device_update_progress")
def q_device_update_progress(t: Telemetry) -> DataFrame:
    """Devices with their latest update attempt."""
    return fl.device_update_progress(t.devices, t.updates, t.orders_as_of, "30 days", "180 days")


@query("recent_updates")
def q_recent_updates(t: Telemetry) -> DataFrame:
    """J2 + O1/P23: newest 20 attempts joined with the registry (X-2 NULL-first order)."""
    return fl.recent_updates(t.updates, t.devices, n=20)


@query("recent_updates_device")
def q_recent_updates_device(t: Telemetry) -> DataFrame:
    """J2 (no-join form): newest 30 attempts, messages cut at 50 chars."""
    return fl.recent_updates(t.updates, None, n=30, device_filter=".*", truncate=50)


@query("recent_rows")
def q_recent_rows(t: Telemetry) -> DataFrame:
    """O1: newest 20 power rows."""
    return fl.recent(t.power, 20, _POWER_ORDER, ["device_sn", "ts", "l_orderkey", "l_linenumber", "soc_percent",
                                                 "watts_in_sum", "watts_out_sum", "pv_in_watts", "remain_time_min"])


@query("raw_series")
def q_raw_series(t: Telemetry) -> DataFrame:
    """O2 + P8: signal strength series over the last 2 days (exclusive ends)."""
    s = t.status
    as_of = t.events_as_of
    return fl.series(s, ["ts", "device_id", "event_id",
                         F.try_element_at("status", F.lit("signal_strength_dbm")).cast("double").alias("rssi")],
                     where=has_metric("signal_strength_dbm", "status"),
                     start=as_of - F.expr("INTERVAL 2 DAYS"), end=as_of, closed="neither")


@query("device_list")
def q_device_list(t: Telemetry) -> DataFrame:
    """Distinct power device ids."""
    return fl.device_list(t.power, "device_sn")


@query("devices_by_last_seen")
def q_devices_by_last_seen(t: Telemetry) -> DataFrame:
    """O3: every device, newest first, those never seen last."""
    return fl.order_last_seen(t.devices).select("device_id", "device_model", "last_seen")


@query("list_devices")
def q_list_devices(t: Telemetry) -> DataFrame:
    """50 most recently seen devices of one model."""
    return fl.list_devices(t.devices, "MACHINERY", 50)


@query("firmware_history")
def q_firmware_history(t: Telemetry) -> DataFrame:
    """Ten newest releases."""
    return fl.firmware_history(t.releases, None, 10)


@query("update_status_list")
def q_update_status_list(t: Telemetry) -> DataFrame:
    """Update history for one firmware version, newest 50."""
    return fl.update_status_list(t.updates, None, "1-URGENT", 50)


# ------------------------------------------------------------------ rollouts

@query("hash_bucket")
def q_hash_bucket(t: Telemetry) -> DataFrame:
    """Stable bucket of every registered device and its selection at 50 %."""
    return ro.device_buckets(t.devices, "device_id", 50)


@query("rollout_coverage")
def q_rollout_coverage(t: Telemetry) -> DataFrame:
    """Share of the fleet selected at each rollout percentage."""
    return ro.rollout_coverage(t.devices, (0, 10, 25, 40, 50, 75, 90, 100))


@query("update_decisions")
def q_update_decisions(t: Telemetry) -> DataFrame:
    """J4 + R2: whole-fleet update check with reasons."""
    return ro.update_decisions(t.devices, t.releases, t.rollouts, t.rollout_targets)


@query("decision_events")
def q_decision_events(t: Telemetry) -> DataFrame:
    """S8 (check path): an audit event with its data per device that is offered an update."""
    return ro.decision_events(ro.update_decisions(t.devices, t.releases, t.rollouts, t.rollout_targets))


@query("check_rollout_rows")
def q_check_rollout_rows(t: Telemetry) -> DataFrame:
    """P20: CHECK-rule violation counts of the rollout table."""
    return uk.check_rollout_rows(t.rollouts)


# ------------------------------------------------------------------ power transforms

_RAW_KEEP = ("device_sn", "ts", "l_orderkey", "l_linenumber")


@query("flatten_power")
def q_flatten_power(t: Telemetry) -> DataFrame:
    """T1 + T2: dotted snapshot keys -> typed columns and component sums."""
    raw = t.power_raw.select(*_RAW_KEEP, F.get_json_object("raw_data", "$.params").alias("params"))
    out = pw.flatten_power(raw, "params", _RAW_KEEP)
    return out.select(*_RAW_KEEP, "soc_percent", "remain_time_min", "watts_in_sum", "watts_out_sum",
                      "ac_out_watts", "pv_in_watts", "car_watts", "dc_out_watts", "typec_out_watts",
                      "usb_out_watts", "inv_input_watts", "rejected")


@query("power_summary")
def q_power_summary(t: Telemetry) -> DataFrame:
    """T3 + S12: retained summary per device (newest snapshot), dc_out_w includes type-C."""
    raw = t.power_raw.select(*_RAW_KEEP, F.get_json_object("raw_data", "$.params").alias("params"))
    s = pw.power_summary(raw, "params", _RAW_KEEP)
    last = lt.latest_by(s, ["device_sn"], ["ts", "l_orderkey", "l_linenumber"], ["summary"], nulls="last")
    return last.select("device_sn", "summary.*")


@query("backfill")
def q_backfill(t: Telemetry) -> DataFrame:
    """T6 + P10: NULL typed columns filled from raw JSON by ordered fallback keys (X-9)."""
    out = pw.backfill_power(t.power_raw, "raw_data")
    return out.select(*_RAW_KEEP, "watts_in_sum", "watts_out_sum", "soc_percent", "remain_time_min",
                      "ac_out_watts", "dc_out_watts", "pv_in_watts", "typec_out_watts", "usb_out_watts")


@query("net_watts")
def q_net_watts(t: Telemetry) -> DataFrame:
    """T5, T7, T8, T9 row-wise: net power, watts per SOC percent, component total, scaled temperature."""
    p = pw.scale_temp(t.power, ("bms_temp",), 10.0)
    return p.select("device_sn", "ts", "l_orderkey", "l_linenumber",
                    pw.net_watts().alias("net_watts"),
                    pw.power_per_percent("watts_out_sum", "soc_percent").alias("watts_per_percent"),
                    pw.watts_out_components("ac_out_watts", "car_watts", "typec_out_watts", "usb_out_watts")
                    .alias("watts_out_components"),
                    F.col("bms_temp").alias("bms_temp_scaled"))


@query("fmt_minutes")
def q_fmt_minutes(t: Telemetry) -> DataFrame:
    """Remaining minutes as ``Nh Mm`` for every distinct value."""
    return t.power.select("remain_time_min").distinct().select(
        "remain_time_min", fm.fmt_minutes("remain_time_min").alias("remain_text"))


@query("fmt_uptime")
def q_fmt_uptime(t: Telemetry) -> DataFrame:
    """The three uptime text variants for every status row that reports uptime."""
    s = t.status.where(has_metric("uptime_seconds", "status"))
    up = F.try_element_at("status", F.lit("uptime_seconds"))
    return s.select("event_id", "device_id", fm.fmt_uptime(up, "coarse").alias("uptime_coarse"),
                    fm.fmt_uptime(up, "table").alias("uptime_table"),
                    fm.fmt_uptime(up, "detail").alias("uptime_detail"),
                    (up.cast("double") / 3600).alias("uptime_hours"))


@query("value_bands")
def q_value_bands(t: Telemetry) -> DataFrame:
    """P25: colour bands for battery SOC and BMS temperature of every power row."""
    p = t.power
    return p.select("device_sn", "ts", "l_orderkey", "l_linenumber",
                    fm.band("soc_percent", [15, 30, 60], ["red", "orange", "yellow", "green"]).alias("soc_band"),
                    fm.band("bms_temp", [30, 70, 85], ["blue", "green", "orange", "red"]).alias("temp_band"))


@query("metric_bands")
def q_metric_bands(t: Telemetry) -> DataFrame:
    """P25: every dashboard's threshold set, over the long form of measurements, status signal and power rows."""
    m = t.measurements.select("device_id", "ts", "event_id", F.try_element_at("metrics", F.lit("battery_v")).cast("double").alias("battery_v"),
                              F.try_element_at("metrics", F.lit("temperature_c")).cast("double").alias("coolant_temp_c"))
    long = m.select("device_id", "ts", "event_id", F.expr(
        "stack(4, 'battery_v', battery_v, 'coolant_temp_c', coolant_temp_c, 'core_temp_c', coolant_temp_c, 'flow_lpm', battery_v / 10) AS (metric, value)"))
    signal = t.status.select("device_id", "ts", "event_id", F.lit("signal_strength_dbm").alias("metric"),
                             F.try_element_at("status", F.lit("signal_strength_dbm")).cast("double").alias("value"))
    rows = long.unionByName(signal).where("value IS NOT NULL")
    return rows.select("device_id", "ts", "event_id", "metric", fm.metric_band("metric", "value").alias("band"))


@query("online_state")
def q_online_state(t: Telemetry) -> DataFrame:
    """3-way and 2-way online classification of every device."""
    d = t.devices
    as_of = t.orders_as_of
    return d.select("device_id",
                    pr.online_state("last_seen", as_of, ("30 days", "180 days"),
                                    ("online", "recent", "offline")).alias("state3"),
                    pr.online_state("last_seen", as_of, ("30 days",), ("online", "offline")).alias("state2"))


@query("power_snapshots")
def q_power_snapshots(t: Telemetry) -> DataFrame:
    """S2 + T1: polled responses -> snapshots (code "0" with data only) -> typed rows."""
    env = B.power_envelopes(t.src)
    snaps = pw.read_power_snapshots(env, "body")
    out = pw.flatten_power(snaps, "params", _RAW_KEEP)
    return out.select(*_RAW_KEEP, "soc_percent", "watts_in_sum", "watts_out_sum", "typec_out_watts")


@query("flatten_nested")
def q_flatten_nested(t: Telemetry) -> DataFrame:
    """T4 + X-5: nested payloads with Python-``or`` fallbacks."""
    n = B.nested_snapshots(t.src)
    return pw.flatten_power_nested(n.select("l_orderkey", "l_linenumber", "payload"), "payload", 
                                   keep=("l_orderkey", "l_linenumber"))


@query("bucket_avg_scaled")
def q_bucket_avg_scaled(t: Telemetry) -> DataFrame:
    """Weekly mean remaining time in hours (``AVG(min)/60``)."""
    return bk.bucket_avg(t.power, "ts", "remain_time_min", "7 days", scale=1 / 60, metric="Remaining (h)")


@query("power_series")
def q_power_series(t: Telemetry) -> DataFrame:
    """O2 + P17 + P11: raw series over the last 60 days where any temperature is set."""
    p = t.power
    as_of = t.lineitem_as_of
    return fl.series(p, ["ts", "device_sn", "l_orderkey", "l_linenumber", "bms_temp", "inv_out_temp", "mppt_temp"],
                     where=pr.any_not_null("bms_temp", "inv_out_temp"),
                     start=as_of - F.expr("INTERVAL 60 DAYS"), end=as_of, closed="both")


@query("align_schema")
def q_align_schema(t: Telemetry) -> DataFrame:
    """M3: raw power rows aligned to the full typed power schema (missing columns NULL)."""
    out = uk.align_schema(t.power_raw.drop("raw_data"), POWER_SCHEMA)
    return out.select(*[f.name for f in POWER_SCHEMA.fields], "l_orderkey", "l_linenumber")


# ------------------------------------------------------------------ ingest

def _classified(t: Telemetry) -> DataFrame:
    return ms.classify(t.messages)


@query("parse_topics")
def q_parse_topics(t: Telemetry) -> DataFrame:
    """P1 + P7 + P15: parsed topic fields, subscription match and a LIKE filter flag."""
    m = t.messages
    pt = ms.parse_topic("topic")
    return m.select("event_id", pt.site_id.alias("site_id"), pt.system.alias("system"),
                    pt.device_id.alias("device_id"), pt.topic_type.alias("topic_type"),
                    pr.topic_matches("topic", *ms.SUBSCRIPTIONS).alias("subscribed"),
                    pr.like_filter("topic", "site/edge/%").alias("edge_topic"))


@query("route_counts")
def q_route_counts(t: Telemetry) -> DataFrame:
    """P5: messages per route and reason."""
    return _classified(t).groupBy("route", "reason").agg(F.count(F.lit(1)).alias("count"))


@query("rejects")
def q_rejects(t: Telemetry) -> DataFrame:
    """Dead-letter rows with reason."""
    c = _classified(t)
    return c.where(F.col("route").isin("rejected", "dropped")).select("event_id", "topic", "reason")


@query("ingest_measurements")
def q_ingest_measurements(t: Telemetry) -> DataFrame:
    """S3 + P2/P3/X-6/X-7: measurement rows produced by ingest."""
    meas = ms.to_measurements(_classified(t))
    return meas.select("site_id", "system", "device_id", "location", "ts",
                       metric("value").alias("value"), metric("k").alias("k"))


@query("archive_raw")
def q_archive_raw(t: Telemetry) -> DataFrame:
    """Raw archive; undecodable payloads wrapped as {"raw": ...}."""
    a = ms.archive_raw(t.messages.select("received_at", "topic", "payload", "event_id"))
    body = ms.decode_payload(a)
    metrics = F.from_json(F.try_element_at("body", F.lit("metrics")), MAP_SCHEMA)
    raw = F.try_element_at("body", F.lit("raw"))
    return body.select("topic", "received_at", raw.isNotNull().alias("wrapped"), raw.alias("raw"),
                       F.try_element_at(keep_last(metrics), F.lit("value")).try_cast("double").alias("value"))


def _attempt_columns(df: DataFrame) -> DataFrame:
    return df.select("device_id", "attempt", "firmware_version", "status", "progress_percent", "started_at", "completed_at",
                     "reported_at", "messages")


def _fold_tasks(t: Telemetry, table: str) -> int:
    """Tasks that fold the messages bound to a table; a count of the table reads no column."""
    return up.fold_tasks(t.spark, t.src.table(table).count())


@query("ingest_update_attempts")
def q_ingest_update_attempts(t: Telemetry) -> DataFrame:
    """Raw messages -> classify -> OTA messages -> attempts."""
    return _attempt_columns(up.update_attempts(ms.to_ota(_classified(t), seq="event_id"), chunk_seconds=30 * 86400, tasks=_fold_tasks(t, "events")))


@query("ingest_registry")
def q_ingest_registry(t: Telemetry) -> DataFrame:
    """Raw messages -> classify -> sightings -> registry (X-6: kept when the status row is refused)."""
    return uk.upsert_devices(None, ms.to_sightings(_classified(t), seq="event_id"), "status")


@query("validate_flat")
def q_validate_flat(t: Telemetry) -> DataFrame:
    """Strict flat-message validation, first failing rule per message."""
    return lg.validate_flat(B.flat_messages(t.src), "payload").select("event_id", "ok", "error")


@query("migrate_legacy")
def q_migrate_legacy(t: Telemetry) -> DataFrame:
    """M5: legacy 3-level topic + flat JSON -> new-style measurement rows (errors kept)."""
    out = lg.migrate_legacy_message(B.flat_messages(t.src), extra_cols=["event_id"])
    return out.select("event_id", "site_id", "system", "device_id", "location", "ts", "error",
                      F.size("metrics").alias("n_metrics"),
                      F.try_element_at("metrics", F.lit("temperature_c")).try_cast("double").alias("temperature"))


# ------------------------------------------------------------------ update tracking

@query("update_attempts")
def q_update_attempts(t: Telemetry) -> DataFrame:
    """Update attempts folded from the OTA message log."""
    return up.update_attempts(t.ota_messages, "seq", chunk_seconds=30 * 86400, tasks=_fold_tasks(t, "orders"))


@query("ota_event_log")
def q_ota_event_log(t: Telemetry) -> DataFrame:
    """Audit events of the OTA message path."""
    return up.ota_event_log(t.ota_messages, "seq")


@query("update_reports")
def q_update_reports(t: Telemetry) -> DataFrame:
    """Status reports with started/completed rules and CHECK validity."""
    r = up.update_reports(t.updates)
    return r.select("id", "device_id", "status", "report_started_at", "report_completed_at", "valid")


@query("apply_success")
def q_apply_success(t: Telemetry) -> DataFrame:
    """Registry after applying success reports (newest success per device wins)."""
    return up.apply_success(t.devices, t.updates).select("device_id", "current_firmware_version", "last_seen")


# ------------------------------------------------------------------ alerts

@query("alert_failure_rate")
def q_alert_failure_rate(t: Telemetry) -> DataFrame:
    """AL1: failure rate over finished attempts per firmware version (> 5 %)."""
    return al.alert_failure_rate(t.updates, 0.05)


@query("alert_offline_after_update")
def q_alert_offline(t: Telemetry) -> DataFrame:
    """AL2: devices silent for 30 days after their newest successful update."""
    return al.alert_offline_after_update(t.devices, t.updates, t.orders_as_of, "30 days")


@query("alert_stuck")
def q_alert_stuck(t: Telemetry) -> DataFrame:
    """AL3: newest attempt still in progress for more than 90 days."""
    return al.alert_stuck(t.updates, t.orders_as_of, "90 days")


@query("alert_power")
def q_alert_power(t: Telemetry) -> DataFrame:
    """AL4/AL5: power rules on each device's newest row."""
    return al.alert_power(t.power, t.lineitem_as_of, silent="5 days", low_soc=20, high_out=300,
                          low_remain=30, high_temp=25.0)


# ------------------------------------------------------------------ upkeep

@query("upsert_latest")
def q_upsert_latest(t: Telemetry) -> DataFrame:
    """Current config per (site, device) after all config messages (newest wins)."""
    cfg = _configs(t)
    return _config_value(uk.upsert_latest(None, cfg, ["site_id", "device_id"], ["updated_at", "event_id"]))


def _configs(t: Telemetry) -> DataFrame:
    return _classified(t).where(F.col("route") == "edge_config").select(
        "site_id", "device_id", F.col("payload").alias("config"), F.col("received_at").alias("updated_at"), "event_id")


def _config_value(df: DataFrame) -> DataFrame:
    """The stored config read back: its metrics.value stands for the body in the compare."""
    body = ms.decode_payload(df, "config")
    metrics = F.from_json(F.try_element_at("body", F.lit("metrics")), MAP_SCHEMA)
    return body.select("site_id", "device_id", "updated_at", "event_id",
                       F.try_element_at(keep_last(metrics), F.lit("value")).try_cast("double").alias("config_value"))


def _sightings(t: Telemetry) -> DataFrame:
    s = t.status
    return s.select("device_id", F.try_element_at("status", F.lit("device_model")).alias("device_model"),
                    F.try_element_at("status", F.lit("firmware_version")).alias("firmware_version"),
                    F.col("ts").alias("seen_at"), F.col("event_id").alias("seq"))


@query("upsert_devices_status")
def q_upsert_devices_status(t: Telemetry) -> DataFrame:
    """Registry after status sightings (model and firmware overwritten)."""
    return uk.upsert_devices(t.devices, _sightings(t), "status")


@query("upsert_devices_check")
def q_upsert_devices_check(t: Telemetry) -> DataFrame:
    """Registry after update checks (firmware overwritten, first model kept)."""
    return uk.upsert_devices(t.devices, _sightings(t), "check")


@query("migrate_flat")
def q_migrate_flat(t: Telemetry) -> DataFrame:
    """M1: wide sensor rows -> JSON metrics with NULL fields stripped."""
    ev = t.src.events
    k = F.get_json_object("props", "$.k").cast("int")
    wide = ev.select(F.col("user_id").cast("string").alias("sensor_id"), "ts", "event_id",
                     k.alias("humidity_percent"),
                     F.when(F.col("event_id") % 6 != 5, F.floor(F.col("value") * 100).cast("int")).alias("battery_mv"),
                     F.when(F.col("event_id") % 4 != 0, (F.col("event_id") % 50).cast("int")).alias("movement_counter"))
    out = uk.migrate_flat(wide, "site", "sensors", ["humidity_percent", "battery_mv", "movement_counter"])
    return out.select("site_id", "system", "device_id", "ts", "metrics")


@query("retention")
def q_retention(t: Telemetry) -> DataFrame:
    """M2: power rows kept by a 90-day retention."""
    return uk.retain(t.power, t.lineitem_as_of, 90).select("device_sn", "ts", "l_orderkey", "l_linenumber")


@query("duplicate_keys")
def q_duplicate_keys(t: Telemetry) -> DataFrame:
    """(model, firmware) combinations held by more than one device."""
    return uk.duplicate_keys(t.devices, ["device_model", "current_firmware_version"])


@query("check_update_rows")
def q_check_update_rows(t: Telemetry) -> DataFrame:
    """P20: CHECK-rule violation counts of the update table."""
    return uk.check_update_rows(t.updates)


# ------------------------------------------------------------------ streams (run availableNow, return the sink)

def _scratch(t: Telemetry, name: str) -> str:
    """A fresh folder under the shared checkpoint folder that the session names."""
    import os
    import uuid
    from fleetspark.session import checkpoint_dir
    return os.path.join(checkpoint_dir(t.spark), "runs", f"{name}-{uuid.uuid4().hex}")


def _feed(df: DataFrame, run: str, start: Callable, batches: int = 3, name: str = "checkpoint", by_time: str | None = None) -> None:
    """Drop the rows as folders and stream each as one micro-batch. A hash deals them, so that every batch brings late
    rows and keys that other batches brought too, or ``by_time`` equal spans of that column in order. ``start(stream,
    checkpoint)`` starts the query."""
    import os
    drop, spark = os.path.join(run, "drop"), df.sparkSession
    deal = F.pmod(F.xxhash64(*df.columns), F.lit(batches))
    if by_time:
        us = F.unix_micros(F.col(by_time).cast("timestamp"))
        first, last = df.agg(F.min(us), F.max(us)).first()
        deal = F.coalesce(F.floor((us - F.lit(first)) * batches / F.lit((last or 0) - (first or 0) + 1)), F.lit(0))
    for i in range(batches):
        folder = os.path.join(drop, f"part={i}")
        if not _has(spark, folder):
            df.where(deal == i).write.parquet(folder)
        start(spark.readStream.schema(df.schema).parquet(os.path.join(drop, "*")), os.path.join(run, name)).awaitTermination()


def _has(spark: SparkSession, path: str) -> bool:
    from fleetspark.streaming.store import Files
    return Files(spark, path).exists(path)


def _stream_buckets(t: Telemetry) -> int:
    """Buckets of the registered streams' snapshots: as many as the cluster merges at a time."""
    return max(8, t.spark.sparkContext.defaultParallelism)


def _ingested(t: Telemetry, upkeep: bool, times: int = 1) -> str:
    """Folder of an ingest of all messages; ``times``: how often the same drop is delivered, each time under a fresh checkpoint."""
    import os
    from fleetspark.streaming.ingest import start_ingest
    run = _scratch(t, "ingest")
    out = os.path.join(run, "out")
    rows = t.messages.select("topic", "payload", "received_at", F.col("event_id").alias("seq"))
    for i in range(times):
        _feed(rows, run, lambda s, ck: start_ingest(s, out, ck, upkeep=upkeep, buckets=_stream_buckets(t)), name=f"checkpoint-{i}")
    return out


@query("stream_ingest")
def q_stream_ingest(t: Telemetry) -> DataFrame:
    """ST1 + S1/S3/S4: messages dropped as files, ingested by a stream, counted per sink table."""
    import os
    from functools import reduce
    out = _ingested(t, upkeep=False)
    parts = [t.spark.read.parquet(os.path.join(out, name)).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("sink"), "rows")
             for name in ("measurements", "edge_status", "edge_config", "ota_messages", "rejects")]
    return reduce(DataFrame.unionByName, parts)


@query("stream_ingest_twice")
def q_stream_ingest_twice(t: Telemetry) -> DataFrame:
    """ST1, repeated delivery: the same drop ingested twice, the second time under a fresh checkpoint, gives every row once."""
    import os
    rows = t.spark.read.parquet(os.path.join(_ingested(t, upkeep=False, times=2), "measurements"))
    return rows.select("site_id", "system", "device_id", "location", "ts", metric("value").alias("value"), metric("k").alias("k"))


@query("stream_edge_status")
def q_stream_edge_status(t: Telemetry) -> DataFrame:
    """S4 through ST1: rows of the edge status sink with fields of the kept payload."""
    import os
    rows = t.spark.read.parquet(os.path.join(_ingested(t, upkeep=False), "edge_status"))
    field = lambda k: F.try_element_at("status", F.lit(k))
    return rows.select("site_id", "device_id", "ts", "received_at", field("device_model").alias("device_model"),
                       field("firmware_version").alias("firmware_version"), F.size("status").alias("n_fields"))


@query("stream_ingest_attempts")
def q_stream_ingest_attempts(t: Telemetry) -> DataFrame:
    """ST1 + ST4/W9: attempts streamed from the OTA messages of an ingest that got its drop twice (same result as the batch path)."""
    import os
    from fleetspark.streaming.ingest import attempts_of_ingest
    from fleetspark.streaming.store import read_snapshot
    out = _ingested(t, upkeep=False, times=2)
    snapshot = os.path.join(out, "update_attempts")
    attempts_of_ingest(t.spark, out, snapshot, os.path.join(out, "attempts_checkpoint"), buckets=_stream_buckets(t), chunk_seconds=30 * 86400).awaitTermination()
    return _attempt_columns(read_snapshot(t.spark, snapshot, ["device_id"]))


@query("stream_ingest_registry")
def q_stream_ingest_registry(t: Telemetry) -> DataFrame:
    """ST1 with upkeep, S6: registry that the ingest stream keeps (same result as the batch path)."""
    import os
    from fleetspark.streaming.store import read_snapshot
    return read_snapshot(t.spark, os.path.join(_ingested(t, upkeep=True), "devices"), ["device_id"])


@query("stream_update_attempts")
def q_stream_update_attempts(t: Telemetry) -> DataFrame:
    """ST4: OTA messages streamed into the attempt snapshot (same result as W9)."""
    import os
    from fleetspark.streaming.ingest import update_attempts_stream
    from fleetspark.streaming.store import read_snapshot
    run = _scratch(t, "attempts")
    snapshot = os.path.join(run, "snapshot")
    _feed(t.ota_messages, run, lambda s, ck: update_attempts_stream(s, snapshot, ck, buckets=_stream_buckets(t), chunk_seconds=30 * 86400))
    return read_snapshot(t.spark, snapshot, ["device_id"])


@query("stream_state_intervals")
def q_stream_state_intervals(t: Telemetry) -> DataFrame:
    """W7 as a stream: heater states in three shuffled batches, late rows included (same result as the batch query)."""
    import os
    from fleetspark.streaming.ingest import read_state_intervals, state_intervals_stream
    run = _scratch(t, "intervals")
    snapshot = os.path.join(run, "snapshot")
    _feed(_heater_states(t).select("device_id", "ts", "heater_state", "event_id"), run,
          lambda s, ck: state_intervals_stream(s, ["device_id"], "ts", "heater_state", "event_id", snapshot, ck, buckets=_stream_buckets(t)))
    return read_state_intervals(t.spark, snapshot, ["device_id"])


@query("stream_gap_segments")
def q_stream_gap_segments(t: Telemetry) -> DataFrame:
    """W8 as a stream: segments merged from three shuffled batches (same result as the batch query)."""
    import os
    from fleetspark.streaming.ingest import gap_segments_stream
    from fleetspark.streaming.store import read_snapshot
    run = _scratch(t, "segments")
    snapshot = os.path.join(run, "snapshot")
    _feed(t.measurements.select("device_id", "ts", "event_id"), run,
          lambda s, ck: gap_segments_stream(s, ["device_id"], "ts", "event_id", snapshot, "4 hours", ck, buckets=_stream_buckets(t)))
    return read_snapshot(t.spark, snapshot, ["device_id"]).select("device_id", "segment", "start", "end", "rows")


@query("stream_bucket_avg")
def q_stream_bucket_avg(t: Telemetry) -> DataFrame:
    """ST2: power rows streamed into weekly means, replaced per batch (no row is ever too late)."""
    import os
    from fleetspark.streaming.ingest import bucket_avg_stream, bucket_avg_to_snapshot
    from fleetspark.streaming.store import read_snapshot
    run = _scratch(t, "buckets")
    snapshot = os.path.join(run, "snapshot")
    mean = lambda s: bucket_avg_stream(s, "ts", "soc_percent", "7 days", lateness=None)
    _feed(t.power.select("ts", "soc_percent"), run, lambda s, ck: bucket_avg_to_snapshot(mean(s), snapshot, ["time"], ck, buckets=_stream_buckets(t)))
    return read_snapshot(t.spark, snapshot, ["time"]).select("time", "value", "rows")


@query("stream_latest_config")
def q_stream_latest_config(t: Telemetry) -> DataFrame:
    """ST5: config messages streamed into a latest-per-device snapshot (same result as S5)."""
    import os
    from fleetspark.streaming.ingest import latest_stream
    from fleetspark.streaming.store import read_snapshot
    run = _scratch(t, "latest")
    snapshot, keys = os.path.join(run, "snapshot"), ["site_id", "device_id"]
    _feed(_configs(t), run, lambda s, ck: latest_stream(s, snapshot, keys, ["updated_at", "event_id"], ck, buckets=_stream_buckets(t)))
    return _config_value(read_snapshot(t.spark, snapshot, keys))


@query("stream_bucket_exact")
def q_stream_bucket_exact(t: Telemetry) -> DataFrame:
    """ST3: daily SOC means kept exact for any lateness by sums that merge."""
    import os
    from fleetspark.streaming.ingest import bucket_avg_exact_stream, read_bucket_avg
    run = _scratch(t, "exact")
    store = os.path.join(run, "store")
    _feed(t.power.select("ts", "soc_percent"), run,
          lambda s, ck: bucket_avg_exact_stream(s, store, "ts", "soc_percent", "1 day", checkpoint=ck, grain="month", buckets=1))
    return read_bucket_avg(t.spark, store)


@query("refresh_latest_view")
def q_refresh_latest_view(t: Telemetry) -> DataFrame:
    """The latest-row view refreshed from changed months only: some get more rows, the newest month is deleted."""
    import os
    from fleetspark.streaming.store import Files
    from fleetspark.streaming.views import LatestView
    run = _scratch(t, "view")
    source, cols = os.path.join(run, "source"), ["ts", "soc_percent", "watts_out_sum"]
    rows = t.power.select("device_sn", "l_orderkey", "l_linenumber", *cols, F.date_format("ts", "yyyy-MM").alias("dt"))
    later = (F.col("l_orderkey") % 3 == 0) & (F.year("ts") >= 1997)
    view = LatestView(t.spark, source, os.path.join(run, "view"), ["device_sn"], _POWER_ORDER, cols, buckets=1)
    rows.where(~later).write.partitionBy("dt").parquet(source)
    view.refresh()
    rows.where(later).write.mode("append").partitionBy("dt").parquet(source)
    Files(t.spark, source).delete(os.path.join(source, f"dt={rows.agg(F.max('dt')).first()[0]}"))
    view.refresh()
    return view.read()


@query("dated_snapshot")
def q_dated_snapshot(t: Telemetry) -> DataFrame:
    """Three dated snapshots of the registry with a keep of 7 days, read back: the first date is gone."""
    import os
    base = os.path.join(_scratch(t, "dated"), "devices")
    for day in ("2024-01-01", "2024-01-06", "2024-01-09"):
        path = uk.export_snapshot(t.devices, base, day, keep_days=7)
    back = t.spark.read.parquet(base)
    return back.select(F.col("dt").cast("string").alias("dt"), "device_id", "device_model", "current_firmware_version", "last_seen")


@query("export_roundtrip")
def q_export_roundtrip(t: Telemetry) -> DataFrame:
    """Registry exported as CSV and as JSON lines, both read back."""
    import os
    run = _scratch(t, "export")
    rows = t.devices.select("device_id", "device_model", "current_firmware_version")
    back = []
    for fmt in ("csv", "json"):
        path = os.path.join(run, fmt)
        uk.export(rows, path, fmt)
        read = t.spark.read.option("header", True).csv(path) if fmt == "csv" else t.spark.read.schema(rows.schema).json(path)
        back.append(read.select(F.lit(fmt).alias("fmt"), *[F.col(c).cast("string").alias(c) for c in rows.columns]))
    return back[0].unionByName(back[1])


def _alerts(t: Telemetry, rows: DataFrame, ts: str, kind, wait_hours: int) -> DataFrame:
    """Alerts that stand after the rows came in order of time, with an hour of lateness allowed."""
    import os
    from fleetspark.streaming.absence import absence_stream, read_alerts
    run = _scratch(t, "absence")
    snapshot = os.path.join(run, "snapshot")
    _feed(rows, run, lambda s, ck: absence_stream(s, "device_id", ts, kind, wait_hours * 3600 * 1000, "1 hour", snapshot, ck,
                                                  buckets=_stream_buckets(t)), by_time=ts)
    return read_alerts(t.spark, snapshot, "device_id")


@query("stream_alert_no_data")
def q_stream_alert_no_data(t: Telemetry) -> DataFrame:
    """AL4 "no data" as a stream: devices without a measurement for 12 hours, by event-time timers."""
    return _alerts(t, t.measurements.select("device_id", "ts"), "ts", F.lit("arm"), 12)


@query("stream_alert_stuck")
def q_stream_alert_stuck(t: Telemetry) -> DataFrame:
    """AL3 as a stream: the newest report is of an update in progress and 90 days old."""
    active = F.when(F.col("status").isin("downloading", "installing", "pending"), "arm").otherwise("disarm")
    return _alerts(t, t.updates.select("device_id", "status", "reported_at"), "reported_at", active, 90 * 24)


@query("stream_alert_offline")
def q_stream_alert_offline(t: Telemetry) -> DataFrame:
    """AL2 as a stream: no report in the 30 days after the newest success, nor any time since."""
    kind = F.when(F.col("status") == "success", "arm").otherwise("seen")
    return _alerts(t, t.updates.select("device_id", "status", "reported_at"), "reported_at", kind, 30 * 24)


# ------------------------------------------------------------------ entry points

def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(QUERIES[name](Telemetry(spark, sf_dir)))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def make(n):
        return lambda spark, sf_dir: run(n, spark, sf_dir)
    return {n: make(n) for n in QUERIES}
