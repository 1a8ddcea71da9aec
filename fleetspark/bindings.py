"""Bind the driver's tables to the telemetry data model.

Each function returns a lazy DataFrame; nothing is collected. Rules that add
NULLs, absent keys or broken rows are stated next to the column they affect and
are mirrored one-to-one by the SQL in ``fleetspark.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetspark.functions.formats import HEATER_STATES
from fleetspark.functions.util import with_parsed
from fleetspark.session import prepare

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


class Source:
    """Lazy access to the driver parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)


def _state_by(k):
    """Heater state text from an integer column: HEATER_STATES[k % 7]."""
    idx = (k % len(HEATER_STATES)).cast("int")
    return F.element_at(F.array(*[F.lit(s) for s in HEATER_STATES]), idx + 1)


def measurements(src: Source) -> DataFrame:
    """events -> measurements(site_id, system, device_id, location, mac, ts, metrics, event_id).

    metrics keys: k (from props), humidity_percent = k, temperature_c = value/10
    (absent when event_id % 10 = 7), heater_state = state[k % 7] (absent when
    event_id % 4 = 3), battery_v = value (absent when event_id % 6 = 5).
    """
    ev = src.events
    k = F.get_json_object("props", "$.k")
    eid = F.col("event_id")
    m = F.create_map(
        F.lit("k"), k,
        F.lit("humidity_percent"), k,
        F.lit("temperature_c"), F.when(eid % 10 != 7, (F.col("value") / 10).cast("string")),
        F.lit("heater_state"), F.when(eid % 4 != 3, _state_by(k.cast("long"))),
        F.lit("battery_v"), F.when(eid % 6 != 5, F.col("value").cast("string")),
    )
    ev = with_parsed(ev.select("event_type", "user_id", "ts", "event_id", "value", "props"),
                     metrics=F.map_filter(m, lambda _k, v: v.isNotNull()))
    return ev.select(
        F.lit("site").alias("site_id"),
        F.col("event_type").alias("system"),
        F.col("user_id").cast("string").alias("device_id"),
        F.when(F.col("user_id") % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("zone"), (F.col("user_id") % 4).cast("string"))).alias("location"),
        F.lit(None).cast("string").alias("mac"),
        F.col("ts"),
        F.col("metrics"),
        eid,
    )


def power_measurements(src: Source) -> DataFrame:
    """lineitem -> power_measurements (typed power-station rows).

    INTEGER columns round on assignment (X-1). NULL rules: pv_in_watts when
    l_returnflag = 'N'; typec_out_watts when l_linestatus = 'O'; inv_input_watts
    when l_linenumber % 3 = 0; bms_temp NULL at line 1 and 0 at line 2;
    inv_out_temp NULL when l_returnflag = 'R'; mppt_temp 0 when l_linestatus = 'F'.
    """
    li = src.lineitem
    r = lambda c: F.round(c).cast("int")
    return li.select(
        F.col("l_suppkey").cast("string").alias("device_sn"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_orderkey"), F.col("l_linenumber"),
        r(100 - F.col("l_discount") * 1000).alias("soc_percent"),
        (F.col("l_partkey") % 1440).cast("int").alias("remain_time_min"),
        r(F.col("l_extendedprice") / 100).alias("watts_in_sum"),
        r(F.col("l_quantity") * 10).alias("watts_out_sum"),
        r(F.col("l_quantity") * 7).alias("ac_out_watts"),
        (F.col("l_linenumber") * 3).cast("int").alias("car_watts"),
        F.when(F.col("l_linestatus") == "O", F.lit(None).cast("int"))
         .otherwise(r(F.col("l_quantity"))).alias("typec_out_watts"),
        r(F.col("l_discount") * 100).alias("usb_out_watts"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("int"))
         .otherwise(r(F.col("l_tax") * 1000)).alias("pv_in_watts"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("l_extendedprice") / 200).alias("inv_input_watts"),
        F.when(F.col("l_linenumber") == 1, F.lit(None).cast("double"))
         .when(F.col("l_linenumber") == 2, F.lit(0.0))
         .otherwise(20 + F.col("l_tax") * 100).alias("bms_temp"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("double"))
         .otherwise(25 + F.col("l_discount") * 100).alias("inv_out_temp"),
        F.when(F.col("l_linestatus") == "F", F.lit(0.0))
         .otherwise(30 + F.col("l_tax") * 50).alias("mppt_temp"),
    )


def devices(src: Source) -> DataFrame:
    """customer + orders -> devices(device_id, device_model, current_firmware_version,
    last_seen, created_at, c_custkey).

    Firmware is the priority of the newest order by (date, key); customers without
    orders keep NULL firmware and NULL last_seen. Orders are reduced per customer
    first (partial aggregation), then joined on the key.
    """
    per_cust = (src.orders.groupBy("o_custkey").agg(
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("current_firmware_version"),
        F.max("o_orderdate").alias("last_seen"),
        F.min("o_orderdate").alias("created_at")))
    c = src.customer.select("c_custkey", "c_name", "c_mktsegment")
    return (c.join(per_cust, c.c_custkey == per_cust.o_custkey, "left")
            .select(F.col("c_name").alias("device_id"),
                    F.col("c_mktsegment").alias("device_model"),
                    "current_firmware_version", "last_seen", "created_at", "c_custkey"))


def _customer_names(src: Source) -> DataFrame:
    return src.customer.select(F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment"))


def update_status(src: Source) -> DataFrame:
    """orders -> device_update_status.

    status F/O/P -> success/pending/failed; started_at NULL when o_orderkey % 11 = 0;
    completed_at = date + (key % 5000) s for finished rows; progress 100 / 0 /
    key % 100; error text for failed rows, longer than 50 chars for even keys.
    """
    o = src.orders
    st = (F.when(F.col("o_orderstatus") == "F", "success")
          .when(F.col("o_orderstatus") == "O", "pending").otherwise("failed"))
    key = F.col("o_orderkey")
    rows = o.select(
        key.alias("id"), "o_custkey",
        F.col("o_orderpriority").alias("firmware_version"),
        st.alias("status"),
        F.when(key % 11 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("o_orderdate")).alias("started_at"),
        F.when(st.isin("success", "failed"),
               F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (key % 5000).cast("int")))
         .alias("completed_at"),
        F.col("o_orderdate").alias("reported_at"),
        F.when(st == "success", 100).when(st == "pending", 0).otherwise((key % 100).cast("int")).alias("progress_percent"),
        F.when(st == "failed", F.concat(F.lit("Update failed on block "), key.cast("string"),
                                        F.when(key % 2 == 0, F.lit(": image checksum mismatch after download"))
                                        .otherwise(F.lit("")))).alias("error_message"),
    )
    c = _customer_names(src)
    return (rows.join(c, rows.o_custkey == c.c_custkey, "inner")
            .select("id", F.col("c_name").alias("device_id"), "firmware_version", "status",
                    "started_at", "completed_at", "reported_at", "progress_percent", "error_message"))


def firmware_releases(src: Source) -> DataFrame:
    """orders + customer -> firmware_releases(device_model, version, created_at).

    One release per (segment, priority), created at the first order date. The
    grouping cardinality is bounded by models x versions, not by the data.
    """
    o = src.orders.select("o_custkey", "o_orderpriority", "o_orderdate")
    c = _customer_names(src)
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .groupBy(F.col("c_mktsegment").alias("device_model"), F.col("o_orderpriority").alias("version"))
            .agg(F.min("o_orderdate").alias("created_at")))


def rollout_targets(src: Source, releases: DataFrame | None = None) -> DataFrame:
    """rollout_name, device_id: the device lists of 'specific' rollouts, every 50th customer."""
    rel = releases if releases is not None else firmware_releases(src)
    names = rel.where(F.col("device_model") == "BUILDING").select(F.concat("device_model", F.lit("-"), "version").alias("rollout_name"))
    ids = src.customer.where(F.col("c_custkey") % 50 == 0).select(F.col("c_name").alias("device_id"))
    # the list is the same for each of the (few) names, so each id carries all of them
    all_names = names.agg(F.collect_set("rollout_name")).scalar()
    return ids.select("device_id", F.explode(all_names).alias("rollout_name"))


def rollout_configurations(src: Source, releases: DataFrame | None = None) -> DataFrame:
    """releases -> rollout_configurations, one per release.

    is_active = model <> 'FURNITURE'; BUILDING -> 'specific' (see ``rollout_targets``);
    HOUSEHOLD -> 'all' at 100 %; others 'canary' 40 %.
    """
    rel = releases if releases is not None else firmware_releases(src)
    m = F.col("device_model")
    return rel.select(
        F.concat(m, F.lit("-"), F.col("version")).alias("name"),
        F.col("version").alias("firmware_version"), m.alias("device_model"),
        F.when(m == "BUILDING", "specific").when(m == "HOUSEHOLD", "all").otherwise("canary").alias("target_type"),
        F.lit(None).cast("string").alias("target_filter"),
        F.when(m == "HOUSEHOLD", 100).when(m == "BUILDING", 100).otherwise(40).alias("rollout_percentage"),
        (m != "FURNITURE").alias("is_active"),
        F.col("created_at"),
    )


def update_messages(src: Source) -> DataFrame:
    """orders -> OTA messages (device_id, kind, received_at, seq, payload).

    kind by o_orderkey % 4: 0 status, 1-2 progress, 3 result. status payload has
    target_version (key % 8 = 0), version (key % 8 = 4) or nothing (key % 24 = 12).
    progress: state by (key div 4) % 3, JSON null when key % 31 = 5; percent: beyond int when
    key % 43 = 1, text "abc" when key % 41 = 1, text "12" when key % 37 = 1, absent when key % 9 = 0,
    JSON null when key % 13 = 0, else key % 130. result: success = text "false" when key % 47 = 3,
    text "maybe" when key % 53 = 3, 1 when key % 59 = 3, else (o_orderstatus = 'F').
    """
    o = src.orders
    key = F.col("o_orderkey")
    kind = F.when(key % 4 == 0, "status").when(key % 4 == 3, "result").otherwise("progress")
    ver = F.col("o_orderpriority")
    status_payload = (F.when(key % 24 == 12, F.lit("{}"))
                      .when(key % 8 == 0, F.to_json(F.struct(ver.alias("target_version"))))
                      .otherwise(F.to_json(F.struct(ver.alias("version")))))
    state = F.element_at(F.array(F.lit("installing"), F.lit("Verifying"), F.lit("downloading")),
                         ((key / 4).cast("long") % 3).cast("int") + 1)
    pct_json = (F.when(key % 43 == 1, F.lit(', "percent": 5000000000'))
                .when(key % 41 == 1, F.lit(', "percent": "abc"'))
                .when(key % 37 == 1, F.lit(', "percent": "12"'))
                .when(key % 9 == 0, F.lit(""))
                .when(key % 13 == 0, F.lit(', "percent": null'))
                .otherwise(F.concat(F.lit(', "percent": '), (key % 130).cast("string"))))
    state_json = F.when(key % 31 == 5, F.lit("null")).otherwise(F.concat(F.lit('"'), state, F.lit('"')))
    progress_payload = F.concat(F.lit('{"state": '), state_json, pct_json, F.lit("}"))
    success = (F.when(key % 47 == 3, F.lit('"false"')).when(key % 53 == 3, F.lit('"maybe"')).when(key % 59 == 3, F.lit("1"))
               .otherwise((F.col("o_orderstatus") == "F").cast("string")))
    result_payload = F.concat(F.lit('{"success": '), success, F.lit(', "message": "error '), key.cast("string"), F.lit('"}'))
    return o.select(
        F.col("o_custkey").cast("string").alias("device_id"),
        kind.alias("kind"),
        F.col("o_orderdate").alias("received_at"),
        key.alias("seq"),
        F.when(kind == "status", status_payload).when(kind == "progress", progress_payload)
         .otherwise(result_payload).alias("payload"),
    )


def raw_messages(src: Source) -> DataFrame:
    """events -> raw pub/sub messages (topic, payload, received_at, event_id).

    Topic: event_id % 19 = 0 -> 2 levels (invalid); % 7 = 5 -> edge status;
    % 7 = 6 -> edge config; % 23 = 0 -> unknown OTA sub-topic, 1, 2, 3 -> OTA status,
    progress, result; else data topic ``site/{event_type}/{user_id}/data``.
    Payload: % 17 = 0 not JSON, 1 array, 2 no metrics, 3 empty metrics, 4 metrics a
    string; % 31 = 0 repeated keys (the last ones count); % 29 = 0 bad timestamp;
    else a valid object with the event time as ISO text. Status payloads hold
    device_model (absent when % 4 = 1, empty when % 4 = 3) and firmware_version
    (absent when % 5 = 2).
    """
    ev = src.events
    eid, uid = F.col("event_id"), F.col("user_id").cast("string")
    topic = (F.when(eid % 19 == 0, F.concat(F.lit("site/"), F.col("event_type")))
             .when(eid % 7 == 5, F.concat(F.lit("site/edge/"), uid, F.lit("/status")))
             .when(eid % 7 == 6, F.concat(F.lit("site/edge/"), uid, F.lit("/config")))
             .when(eid % 23 == 0, F.concat(F.lit("site/edge/"), uid, F.lit("/ota/unknown")))
             .when(eid % 23 == 1, F.concat(F.lit("site/edge/"), uid, F.lit("/ota/status")))
             .when(eid % 23 == 2, F.concat(F.lit("site/edge/"), uid, F.lit("/ota/progress")))
             .when(eid % 23 == 3, F.concat(F.lit("site/edge/"), uid, F.lit("/ota/result")))
             .otherwise(F.concat(F.lit("site/"), F.col("event_type"), F.lit("/"), uid, F.lit("/data"))))
    metrics = F.struct(F.col("value").alias("value"),
                       F.get_json_object("props", "$.k").cast("long").alias("k"))
    good_ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    payload = (F.when(eid % 17 == 0, F.lit("not json {"))
               .when(eid % 17 == 1, F.lit("[1, 2]"))
               .when(eid % 17 == 2, F.to_json(F.struct(uid.alias("device_id"))))
               .when(eid % 17 == 3, F.concat(F.lit('{"device_id": "'), uid, F.lit('", "metrics": {}}')))
               .when(eid % 17 == 4, F.to_json(F.struct(uid.alias("device_id"), F.lit("hot").alias("metrics"))))
               .when(eid % 31 == 0, F.concat(F.lit('{"device_id": "other", "device_id": "'), uid, F.lit('", "metrics": {"value": -1, "value": '),
                                             F.col("value").cast("string"), F.lit(', "k": '), F.get_json_object("props", "$.k"), F.lit("}}")))
               .otherwise(F.to_json(F.struct(
                   uid.alias("device_id"),
                   F.when((eid % 7 == 5) & (eid % 4 != 1), F.when(eid % 4 == 3, F.lit("")).otherwise(F.concat(F.lit("m"), eid % 3))).alias("device_model"),
                   F.when((eid % 7 == 5) & (eid % 5 != 2), F.concat(F.lit("fw"), eid % 6)).alias("firmware_version"),
                   F.when(eid % 29 == 0, F.lit("yesterday")).otherwise(good_ts).alias("timestamp"),
                   F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("zone"), (F.col("user_id") % 4).cast("string")))
                    .alias("location"),
                   metrics.alias("metrics")))))
    return ev.select(topic.alias("topic"), payload.alias("payload"), F.col("ts").alias("received_at"), eid)


def edge_status(src: Source) -> DataFrame:
    """events -> edge_device_status(site_id, device_id, ts, status map, event_id).

    device_id = 'Customer#' + user_id zero-padded to 9 (a c_name); status keys:
    state = upper(event_type); signal_strength_dbm = -30 - k (absent when
    event_id % 5 = 1); uptime_seconds = floor(value * 10000) (absent when
    event_id % 7 = 3); active_scenario = 'scenario' + k % 3 (only when
    event_id % 3 = 0); firmware_version = 'fw' + k % 4; device_model = esp32 for
    even k, else esp8266 (absent when event_id % 8 = 1, empty when event_id % 8 = 4).
    """
    ev = src.events
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("long")
    st = F.create_map(
        F.lit("state"), F.upper("event_type"),
        F.lit("signal_strength_dbm"), F.when(eid % 5 != 1, (F.lit(-30) - k).cast("string")),
        F.lit("uptime_seconds"), F.when(eid % 7 != 3, F.floor(F.col("value") * 10000).cast("string")),
        F.lit("active_scenario"), F.when(eid % 3 == 0, F.concat(F.lit("scenario"), (k % 3).cast("string"))),
        F.lit("firmware_version"), F.concat(F.lit("fw"), (k % 4).cast("string")),
        F.lit("device_model"), F.when(eid % 8 == 4, F.lit("")).when(eid % 8 != 1, F.when(k % 2 == 0, F.lit("esp32")).otherwise(F.lit("esp8266"))),
    )
    return ev.select(
        F.lit("site").alias("site_id"),
        F.format_string("Customer#%09d", F.col("user_id")).alias("device_id"),
        F.col("ts"),
        F.map_filter(st, lambda _k, v: v.isNotNull()).alias("status"),
        eid,
    )


def power_raw(src: Source) -> DataFrame:
    """lineitem -> raw power JSON rows (device_sn, ts, tiebreak, raw_data, typed cols NULL).

    raw_data = {"params": {...}} with dotted keys present by l_linenumber:
    pd.wattsInSum (lines 1-3) else bmsMaster.inputWatts (4-5) else nothing;
    pd.wattsOutSum (odd lines) else inv.outputWatts; pd.soc always;
    pd.remainTime unless line 2; pd.typec1Watts (line <= 4), pd.typec2Watts (line >= 3);
    pd.usb1Watts on even lines; mppt.inWatts unless returnflag 'N'.
    The typed columns watts_in_sum/soc_percent are set only for line 1.
    """
    li = src.lineitem
    ln = F.col("l_linenumber")
    # a struct so that integers stay JSON integers and NULL fields are omitted
    params = F.struct(
        F.when(ln <= 3, F.col("l_extendedprice") / 100).alias("pd.wattsInSum"),
        F.when((ln >= 4) & (ln <= 5), F.col("l_extendedprice") / 50).alias("bmsMaster.inputWatts"),
        F.when(ln % 2 == 1, F.col("l_quantity") * 10).alias("pd.wattsOutSum"),
        F.when(ln % 2 == 0, F.col("l_quantity") * 7).alias("inv.outputWatts"),
        F.round(100 - F.col("l_discount") * 1000).cast("int").alias("pd.soc"),
        F.when(ln != 2, (F.col("l_partkey") % 1440).cast("int")).alias("pd.remainTime"),
        F.when(ln <= 4, F.col("l_tax") * 100).alias("pd.typec1Watts"),
        F.when(ln >= 3, F.col("l_discount") * 100).alias("pd.typec2Watts"),
        F.when(ln % 2 == 0, F.col("l_quantity")).alias("pd.usb1Watts"),
        F.when(F.col("l_returnflag") != "N", F.col("l_tax") * 1000).alias("mppt.inWatts"),
    )
    raw = F.to_json(F.struct(params.alias("params")))
    return li.select(
        F.col("l_suppkey").cast("string").alias("device_sn"),
        F.col("l_shipdate").alias("ts"), "l_orderkey", "l_linenumber",
        F.when(ln == 1, F.round(F.col("l_extendedprice") / 100).cast("int")).alias("watts_in_sum"),
        F.lit(None).cast("int").alias("watts_out_sum"),
        F.when(ln == 1, F.lit(50)).alias("soc_percent"),
        F.lit(None).cast("int").alias("remain_time_min"),
        F.lit(None).cast("int").alias("ac_out_watts"),
        F.lit(None).cast("int").alias("dc_out_watts"),
        F.lit(None).cast("int").alias("typec_out_watts"),
        F.lit(None).cast("int").alias("usb_out_watts"),
        F.lit(None).cast("int").alias("pv_in_watts"),
        raw.alias("raw_data"),
    )


def flat_messages(src: Source) -> DataFrame:
    """events -> legacy flat sensor messages on 3-level topics (topic, payload, received_at, event_id).

    Payload fields: sensor_id = user_id text, temperature_c = value / 10,
    humidity_percent = k, pressure_hpa = 1000 + k / 10, battery_mv = 2000 + k * 10,
    movement_counter = event_id % 50. Faults: event_id % 11 = 0 drops sensor_id;
    % 13 = 0 sends sensor_id as a number; % 17 = 0 sends temperature as text;
    % 19 = 0 sends battery_mv as 2870.5; % 23 = 0 sends an integer temperature
    (valid); % 29 = 0 uses a 4-level topic.
    """
    ev = src.events
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("long")
    loc = F.concat(F.lit("zone"), (F.col("user_id") % 4).cast("string"))
    topic = F.when(eid % 29 == 0, F.concat(F.lit("site/sensors/"), loc, F.lit("/data"))) \
        .otherwise(F.concat(F.lit("site/sensors/"), loc))
    sid = F.col("user_id").cast("string")
    temp = F.col("value") / 10
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))  # noqa: E731  JSON string literal
    sensor = F.when(eid % 11 == 0, F.lit(None)).when(eid % 13 == 0, sid).otherwise(q(sid))
    temp_txt = F.when(eid % 17 == 0, q(temp.cast("string"))) \
        .when(eid % 23 == 0, F.floor(temp).cast("string")).otherwise(temp.cast("string"))
    batt = F.when(eid % 19 == 0, F.lit("2870.5")).otherwise((2000 + k * 10).cast("string"))
    fields = F.concat_ws(", ",
                         F.when(sensor.isNotNull(), F.concat(F.lit('"sensor_id": '), sensor)),
                         F.concat(F.lit('"temperature_c": '), temp_txt),
                         F.concat(F.lit('"humidity_percent": '), k.cast("string")),
                         F.concat(F.lit('"pressure_hpa": '), (1000 + k / 10).cast("string")),
                         F.concat(F.lit('"battery_mv": '), batt),
                         F.concat(F.lit('"movement_counter": '), (eid % 50).cast("string")))
    return ev.select(topic.alias("topic"), F.concat(F.lit("{"), fields, F.lit("}")).alias("payload"),
                     F.col("ts").alias("received_at"), eid)


def power_envelopes(src: Source) -> DataFrame:
    """lineitem -> polled API responses (device_sn, ts, l_orderkey, l_linenumber, body).

    body = {"code": c, "message": m, "data": {...flat dotted keys...}}: code "0"
    with the power_raw params, except line 7 (code "8521", error message, no
    data) and line 6 (code "0" with an empty data object).
    """
    raw = power_raw(src)
    ln = F.col("l_linenumber")
    params = F.get_json_object("raw_data", "$.params")
    body = (F.when(ln == 7, F.lit('{"code": "8521", "message": "signature error"}'))
            .when(ln == 6, F.lit('{"code": "0", "message": "Success", "data": {}}'))
            .otherwise(F.concat(F.lit('{"code": "0", "message": "Success", "data": '), params, F.lit("}"))))
    return raw.select("device_sn", "ts", "l_orderkey", "l_linenumber", body.alias("body"))


def nested_snapshots(src: Source) -> DataFrame:
    """lineitem -> nested power payloads {sn, params{soc, remainTime, wattsInSum, ...,
    bmsMaster{soc}, inv{inputWatts, outputWatts}}}.

    soc = 0 on odd lines (falls through to bmsMaster.soc); wattsInSum absent on
    even lines (falls through to inv.inputWatts); sn absent on line 5.
    """
    li = src.lineitem
    ln = F.col("l_linenumber")
    soc = F.round(100 - F.col("l_discount") * 1000).cast("int")
    params = F.struct(
        F.when(ln % 2 == 1, F.lit(0)).otherwise(soc).alias("soc"),
        (F.col("l_partkey") % 1440).cast("int").alias("remainTime"),
        F.when(ln % 2 == 1, F.col("l_extendedprice") / 100).alias("wattsInSum"),
        (F.col("l_quantity") * 10).alias("wattsOutSum"),
        (F.col("l_quantity") * 7).alias("invOutWatts"),
        F.when(F.col("l_returnflag") != "N", F.col("l_tax") * 1000).alias("pvInWatts"),
        F.struct(soc.alias("soc")).alias("bmsMaster"),
        F.struct((F.col("l_extendedprice") / 200).alias("inputWatts"),
                 (F.col("l_quantity") * 5).alias("outputWatts")).alias("inv"))
    payload = F.to_json(F.struct(F.when(ln != 5, F.col("l_suppkey").cast("string")).alias("sn"),
                                 params.alias("params")))
    return li.select("l_orderkey", "l_linenumber", payload.alias("payload"))
