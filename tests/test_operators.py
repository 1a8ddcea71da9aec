"""Operator semantics: power transforms, latest values, series, runs and the update fold."""

import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fleetspark.operators import buckets as bk
from fleetspark.operators import latest as lt
from fleetspark.operators import power as pw
from fleetspark.operators import runs as rn
from fleetspark.operators.updates import ota_event_log, update_attempts

T0 = datetime(2024, 1, 1)


def test_flatten_power_defaults_and_null_reject(spark):
    """T1/T2 and X-8: absent -> 0, explicit null stays NULL; a null summed field rejects."""
    rows = [("a", json.dumps({"bmsMaster.soc": 85, "pd.carWatts": 10, "pd.usb1Watts": 2.4, "pd.typec1Watts": 18,
                              "inv.outTemp": 41.5})),
            ("b", json.dumps({"pd.usb2Watts": None})),
            ("c", json.dumps({"pd.wattsInSum": None}))]
    df = spark.createDataFrame([(d, T0, p) for d, p in rows], "device_sn string, ts timestamp_ntz, params string")
    out = {r.device_sn: r for r in pw.flatten_power(df).collect()}
    a = out["a"]
    assert (a.soc_percent, a.dc_out_watts, a.typec_out_watts, a.usb_out_watts, a.remain_time_min) == (85, 12, 18, 2, 0)
    assert a.inv_out_temp == 41.5 and a.bms_temp is None and not a.rejected
    assert out["b"].rejected and out["b"].dc_out_watts is None
    assert not out["c"].rejected and out["c"].watts_in_sum is None


def test_nested_payload_or_fallback(spark):
    """T4 and X-5: a nested payload parses to the expected values; 0 falls through."""
    sample = {"sn": "PS-2", "params": {"soc": 41, "remainTime": 95, "wattsInSum": 33, "wattsOutSum": 210, "invOutWatts": 150, "dcOutWatts": 44,
                                       "typecOutWatts": 11, "usbOutWatts": 5, "pvInWatts": 27, "bmsMaster": {"soc": 40}, "inv": {"outputWatts": 149}}}
    zero = {"params": {"soc": 0, "bmsMaster": {"soc": 77}, "wattsInSum": 0}}
    df = spark.createDataFrame([(json.dumps(sample),), (json.dumps(zero),)], "payload string")
    r = pw.flatten_power_nested(df).collect()
    assert (r[0].soc_percent, r[0].remain_time_min, r[0].watts_in_sum, r[0].watts_out_sum, r[0].ac_out_watts,
            r[0].dc_out_watts, r[0].typec_out_watts, r[0].usb_out_watts, r[0].pv_in_watts) == \
        (41, 95, 33, 210, 150, 44, 11, 5, 27)
    assert r[1].device_sn == "unknown" and r[1].soc_percent == 77 and r[1].watts_in_sum is None


def test_backfill_typec_trap(spark):
    """T6 and X-9: typec1 NULL with typec2 > 0 gives 0; filled only where NULL."""
    raw = lambda p: json.dumps({"params": p})
    rows = [(1, raw({"pd.typec2Watts": 5}), None), (2, raw({"pd.typec1Watts": 3, "pd.typec2Watts": 4}), None),
            (3, raw({"pd.typec1Watts": 0}), None), (4, raw({"pd.typec1Watts": 9}), 1),
            (5, raw({"pd.soc": 40, "pd.wattsInSum": 12.6}), None)]
    df = spark.createDataFrame(rows, "id int, raw_data string, typec_out_watts int")
    out = {r.id: r for r in pw.backfill_power(df).collect()}
    assert out[1].typec_out_watts == 0
    assert out[2].typec_out_watts == 7
    assert out[3].typec_out_watts is None
    assert out[4].typec_out_watts == 1
    assert out[5].soc_percent == 40 and out[5].watts_in_sum == 12.6


def test_latest_nulls_first_and_tiebreak(spark):
    """X-2 and X-14: NULL start is newest under DESC; ties resolved by the tiebreak."""
    rows = [("d1", 1, T0), ("d1", 2, None), ("d1", 3, T0 + timedelta(days=1)),
            ("d2", 4, T0), ("d2", 5, T0)]
    df = spark.createDataFrame(rows, "device_id string, id int, started_at timestamp_ntz")
    got = {r.device_id: r.id for r in lt.latest_by(df, ["device_id"], ["started_at", "id"], ["id"]).collect()}
    assert got == {"d1": 2, "d2": 5}
    got = {r.device_id: r.id for r in lt.latest_by(df, ["device_id"], ["started_at", "id"], ["id"], nulls="last").collect()}
    assert got == {"d1": 3, "d2": 5}


def test_latest_non_null_skips_nulls(spark):
    """Newest non-NULL value."""
    rows = [("a", T0, 1, 5), ("a", T0 + timedelta(1), 2, None), ("b", T0, 3, None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id int, v int")
    got = {r.k: r.value for r in lt.latest_non_null(df, ["k"], "v", ["ts", "id"]).collect()}
    assert got == {"a": 5}


def test_series_long_drops_empty_filtered_buckets(spark):
    """X-16: a filtered series has no row where nothing passes; an unfiltered one keeps NULL means."""
    rows = [(T0, None, 0.0), (T0 + timedelta(days=8), None, 35.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, a double, t double")
    out = bk.series_long(df, "ts", {"A": {"value": "a"}, "T": {"value": "t", "where": F.col("t") != 0}}, "7 days")
    got = sorted((r.metric, r.value) for r in out.collect())
    assert got == [("A", None), ("A", None), ("T", 35.0)]


def _py_runs(events, gap=None):
    """Plain-Python gaps-and-islands per key: list of (key, start, end, rows)."""
    out = []
    by = {}
    for k, t, i, s in sorted(events, key=lambda e: (e[0], e[1], e[2])):
        by.setdefault(k, []).append((t, i, s))
    for k, seq in by.items():
        cur = None
        for t, i, s in seq:
            new = cur is None or (gap is None and s != cur[3]) or (gap is not None and t - cur[2] > gap)
            if new:
                if cur:
                    out.append((k, cur[1], cur[2], cur[4]))
                cur = [k, t, t, s, 1]
            else:
                cur[2], cur[4] = t, cur[4] + 1
        out.append((k, cur[1], cur[2], cur[4]))
    return sorted(out)


def _random_events(n=3000, seed=7):
    rnd = random.Random(seed)
    ev = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.4 else f"d{rnd.randint(0, 20)}"
        t = T0 + timedelta(minutes=rnd.randint(0, 60 * 24 * 5))
        ev.append((k, t, i, rnd.choice(["Off", "Running", "Cooling", None])))
    return ev


def test_state_intervals_exact_across_chunks(spark):
    """Runs exact for any chunk width, hot key included."""
    ev = _random_events()
    df = spark.createDataFrame(ev, "k string, ts timestamp_ntz, id int, s string")
    for chunk in (3600, 86400, 10 ** 7):
        got = sorted((r.k, r.start, r.end, r.rows) for r in rn.state_intervals(df, ["k"], "ts", "s", "id", chunk).collect())
        assert got == _py_runs(ev), chunk


def test_gap_segments_exact_across_chunks(spark):
    """Gap segments exact for any chunk width."""
    ev = _random_events(seed=11)
    df = spark.createDataFrame(ev, "k string, ts timestamp_ntz, id int, s string")
    got = sorted((r.k, r.start, r.end, r.rows)
                 for r in rn.gap_segments(df, ["k"], "ts", "id", "2 hours", chunk_seconds=7200).collect())
    assert got == _py_runs(ev, gap=timedelta(hours=2))


def _py_attempts(msgs):
    """Apply OTA messages one at a time as the collector does (insert / update newest row)."""
    rows = {}
    for dev, kind, t, seq, payload in sorted(msgs, key=lambda m: (m[2], m[3])):
        p = json.loads(payload)
        rs = rows.setdefault(dev, [])
        if kind == "status":
            fw = p.get("target_version", p.get("version", "unknown"))
            if fw is None:
                continue
            rs.append({"fw": fw, "status": "pending", "pct": None, "err": None, "start": t, "done": None,
                       "rep": t, "n": 1})
        elif kind == "progress":
            st = p.get("state", "").lower()
            status = "installing" if st == "installing" else ("downloaded" if st == "verifying" else "downloading")
            pct = p.get("percent", 0)
            if pct is not None and not 0 <= pct <= 100:
                continue
            if rs:
                rs[-1].update(status=status, pct=pct, rep=t)
                rs[-1]["n"] += 1
        else:
            ok = bool(p.get("success", False))
            if rs:
                r = rs[-1]
                r.update(status="success" if ok else "failed", pct=100 if ok else r["pct"],
                         err=None if ok else p.get("message"), done=t, rep=t)
                r["n"] += 1
    return sorted((d, i + 1, r["fw"], r["status"], r["pct"], r["err"], r["start"], r["done"], r["rep"], r["n"])
                  for d, rs in rows.items() for i, r in enumerate(rs))


def _random_ota(n=4000, seed=3):
    rnd = random.Random(seed)
    msgs = []
    for seq in range(n):
        dev = "hot" if rnd.random() < 0.35 else f"d{rnd.randint(0, 30)}"
        t = T0 + timedelta(hours=rnd.randint(0, 24 * 90))
        kind = rnd.choice(["status", "progress", "progress", "result"])
        if kind == "status":
            p = rnd.choice([{"target_version": "1.1"}, {"version": "1.0"}, {}, {"target_version": None}])
        elif kind == "progress":
            p = {"state": rnd.choice(["installing", "Verifying", "downloading", ""])}
            r = rnd.random()
            if r < 0.7:
                p["percent"] = rnd.randint(0, 130)
            elif r < 0.8:
                p["percent"] = None
        else:
            p = {"success": rnd.random() < 0.5, "message": f"m{seq}"}
        msgs.append((dev, kind, t, seq, json.dumps(p)))
    return msgs


def test_update_attempts_match_python_model(spark):
    """W9 with X-11 (percent absent/null/out of range) and X-12 (version by key presence)."""
    msgs = _random_ota()
    df = spark.createDataFrame(msgs, "device_id string, kind string, received_at timestamp_ntz, seq long, payload string")
    for chunk in (86400 * 7, 86400 * 365):
        got = sorted(tuple(r) for r in update_attempts(df, chunk_seconds=chunk)
                     .select("device_id", "attempt", "firmware_version", "status", "progress_percent",
                             "error_message", "started_at", "completed_at", "reported_at", "messages").collect())
        assert got == _py_attempts(msgs), chunk


def test_event_log(spark):
    """Audit events of the message path."""
    msgs = [("d", "result", T0, 1, json.dumps({"success": True})),
            ("d", "status", T0 + timedelta(1), 2, json.dumps({"version": "2"})),
            ("d", "status", T0 + timedelta(2), 3, json.dumps({"target_version": None})),
            ("d", "result", T0 + timedelta(3), 4, json.dumps({"success": False, "message": "x"}))]
    df = spark.createDataFrame(msgs, "device_id string, kind string, received_at timestamp_ntz, seq long, payload string")
    got = [(r.event_type, r.firmware_version) for r in ota_event_log(df).orderBy("seq").collect()]
    assert got == [("update_completed", "unknown"), ("update_started", "2"), ("update_failed", "unknown")]


def test_state_intervals_property(spark):
    """Random sequences and chunk widths give the plain-Python runs exactly."""
    from hypothesis import HealthCheck, given, settings, strategies as st

    event = st.tuples(st.sampled_from(["a", "b", "hot"]), st.integers(0, 3 * 24 * 60),
                      st.sampled_from(["Off", "Running", None]))

    @settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(event, min_size=1, max_size=60), st.sampled_from([600, 3600, 86400]))
    def check(evs, chunk):
        rows = [(k, T0 + timedelta(minutes=m), i, s) for i, (k, m, s) in enumerate(evs)]
        df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id int, s string")
        got = sorted((r.k, r.start, r.end, r.rows) for r in rn.state_intervals(df, ["k"], "ts", "s", "id", chunk).collect())
        assert got == _py_runs(rows)

    check()
