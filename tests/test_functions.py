"""Golden tables and the semantics traps (X-*)."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetspark.functions import formats as fm
from fleetspark.functions import predicates as pr
from fleetspark.functions.hashing import hash_bucket, percentage_match
from fleetspark.functions.util import round_int
from fleetspark.operators.rollout import eligible
from fleetspark.sources.legacy import validate_flat
from fleetspark.sources.messages import classify, parse_topic

TOPICS = [
    ("plantA/air/attic/data", ("plantA", "air", "attic", "data")),
    ("plantA/edge/gw-07/status", ("plantA", "edge", "gw-07", "status")),
    ("plantA/edge/gw-07/config", ("plantA", "edge", "gw-07", "config")),
    ("plantA/edge/gw-07/ota/status", ("plantA", "edge", "gw-07", "ota_status")),
    ("plantA/edge/gw-07/ota/progress", ("plantA", "edge", "gw-07", "ota_progress")),
    ("plantA/edge/gw-07/ota/result", ("plantA", "edge", "gw-07", "ota_result")),
    ("plantA/heater/boiler2/data", ("plantA", "heater", "boiler2", "data")),
    ("plantA/air/attic/unknown", None),
    ("plantA/air", None),
    ("plantA/air/attic/data/extra", None),
    ("", None),
    ("plantA/edge/gw-07/ota/unknown", None),
    ("plantA/air/probe9/ota/status", None),
]


def test_parse_topic_golden(spark):
    """Topic parse golden table."""
    df = spark.createDataFrame([(t,) for t, _ in TOPICS], "topic string")
    got = {r.topic: (tuple(r.p) if r.p is not None else None) for r in df.select("topic", parse_topic("topic").alias("p")).collect()}
    for t, exp in TOPICS:
        assert got[t] == exp, t


PAYLOADS = [
    ({"device_id": "d", "metrics": {"lux": 310, "co2_ppm": 412.5}}, True),
    ({"device_id": "d", "metrics": {"t": 1}, "location": "attic", "extra": 1}, True),
    ({"device_id": "d", "metrics": {"t": 1}}, True),
    ({"metrics": {"t": 1}}, False),
    ({"device_id": "d"}, False),
    ({"device_id": "d", "metrics": "hot"}, False),
    ({"device_id": "d", "metrics": {}}, False),
    ({}, False),
]


def test_validate_payload_golden(spark):
    """Payload decode and validation golden table."""
    rows = [("s/sensors/d/data", json.dumps(p), datetime(2024, 1, 1), i) for i, (p, _) in enumerate(PAYLOADS)]
    rows += [("s/sensors/d/data", "{not json", datetime(2024, 1, 1), 100), ("s/sensors/d/data", "[1]", datetime(2024, 1, 1), 101)]
    df = spark.createDataFrame(rows, "topic string, payload string, received_at timestamp_ntz, i int")
    got = {r.i: (r.route, r.reason) for r in classify(df).select("i", "route", "reason").collect()}
    for i, (_, ok) in enumerate(PAYLOADS):
        assert (got[i][0] == "measurements") == ok, (PAYLOADS[i], got[i])
    assert got[100] == ("rejected", "bad_json")
    assert got[101] == ("rejected", "not_object")


def test_topic_device_wins_and_timestamp_rules(spark):
    """X-6, X-7: topic device id wins; absent/null timestamp falls back; bad one rejects."""
    rows = [
        ("s/sensors/topicdev/data", json.dumps({"device_id": "payloaddev", "metrics": {"a": 1}}), 1),
        ("s/sensors/d/data", json.dumps({"device_id": "d", "metrics": {"a": 1}, "timestamp": None}), 2),
        ("s/sensors/d/data", json.dumps({"device_id": "d", "metrics": {"a": 1}, "timestamp": "garbage"}), 3),
        ("s/sensors/d/data", json.dumps({"device_id": "d", "metrics": {"a": 1}, "timestamp": "2025-12-01T20:00:00Z"}), 4),
        ("s/heater/d/status", json.dumps({"state": "x"}), 5),
    ]
    df = spark.createDataFrame([(t, p, datetime(2024, 1, 1), i) for t, p, i in rows],
                               "topic string, payload string, received_at timestamp_ntz, i int")
    got = {r.i: r for r in classify(df).collect()}
    assert got[1].device_id == "topicdev" and got[1].route == "measurements"
    assert got[2].ts == datetime(2024, 1, 1) and got[2].route == "measurements"
    assert got[3].reason == "bad_timestamp"
    assert got[4].ts == datetime(2025, 12, 1, 20, 0, 0)
    assert got[5].route == "dropped" and got[5].reason == "unhandled"


FLAT_BASE = {"sensor_id": "attic", "temperature_c": 17.25, "humidity_percent": 61.0,
             "pressure_hpa": 987.5, "battery_mv": 3011, "movement_counter": 7}


def _flat(**kw):
    d = dict(FLAT_BASE)
    for k, v in kw.items():
        if v is ...:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


def test_validate_flat_golden(spark):
    """Strict flat-message validation golden table."""
    cases = [
        (_flat(), None),
        (_flat(sensor_id=...), "Missing required field: sensor_id"),
        (_flat(temperature_c=...), "Missing required field: temperature_c"),
        (_flat(sensor_id=44), "Field 'sensor_id' has incorrect type: expected str, got int"),
        (_flat(temperature_c="17.25"), "Field 'temperature_c' has incorrect type: expected int or float, got str"),
        (_flat(temperature_c=17), None),
        (_flat(battery_mv=3011.5), "Field 'battery_mv' has incorrect type: expected int, got float"),
    ]
    df = spark.createDataFrame([(p, i) for i, (p, _) in enumerate(cases)], "payload string, i int")
    got = {r.i: r.error for r in validate_flat(df).collect()}
    for i, (_, exp) in enumerate(cases):
        assert got[i] == exp, cases[i]


def _py_bucket(s):
    return int(hashlib.sha256(s.encode()).hexdigest(), 16) % 100


def test_hash_bucket_matches_python(spark):
    """Bucket equals Python big-integer modulo."""
    ids = [f"device{i}" for i in range(1000)] + ["", "gw-07", "Customer#000000001", "äöü"]
    df = spark.createDataFrame([(x,) for x in ids], "id string")
    got = {r.id: r.b for r in df.select("id", hash_bucket("id").alias("b")).collect()}
    for x in ids:
        assert got[x] == _py_bucket(x), x
    assert [got[f"device{i}"] for i in range(5)] == [19, 60, 80, 40, 96]


def test_percentage_spread_and_edges(spark):
    """Spread at 50 % and the 0/100 edges."""
    df = spark.createDataFrame([(f"device{i}",) for i in range(1000)], "id string")
    n = df.where(percentage_match("id", 50)).count()
    assert 400 < n < 600
    assert df.where(percentage_match("id", 100)).count() == 1000
    assert df.where(percentage_match("id", 0)).count() == 0


def test_eligibility(spark):
    """R2: all/canary/group/specific and bad filters."""
    flt = json.dumps({"device_ids": ["u-a", "u-b", "u-c", "u-d", "u-e"]})
    rows = [("u-a", "specific", flt, 0), ("u-e", "specific", flt, 0), ("u-f", "specific", flt, 100),
            ("unit-999", "specific", flt, 100), ("device1", "specific", None, 100), ("device1", "specific", "{bad", 100),
            ("device1", "all", None, 100), ("device1", "all", None, 0), ("device1", "canary", None, 100),
            ("device1", "group", None, 100), ("device1", "weird", None, 100)]
    df = spark.createDataFrame(rows, "d string, t string, f string, p int")
    got = [r.e for r in df.select(eligible("d", "t", "f", "p").alias("e")).collect()]
    assert got == [True, True, False, False, False, False, True, False, True, True, False]


def test_round_half_away_from_zero(spark):
    """X-1: numeric::int rounds 2.5 -> 3 and -2.5 -> -3; a cast alone truncates."""
    df = spark.createDataFrame([(2.5,), (-2.5,), (1.49,)], "x double")
    assert [r.r for r in df.select(round_int("x").alias("r")).collect()] == [3, -3, 1]


def test_concat_skips_null_and_integer_division(spark):
    """X-4, X-10: CONCAT keeps the text around a NULL part; minutes use integer hours."""
    df = spark.createDataFrame([(407,), (None,), (59,)], "m int")
    assert [r.t for r in df.select(fm.fmt_minutes("m").alias("t")).collect()] == ["6h 47m", "h m", "0h 59m"]


def test_uptime_formats(spark):
    """Uptime text variants."""
    df = spark.createDataFrame([(90061.0,), (7200.0,), (59.0,), (150.0,), (None,)], "s double")
    out = df.select(fm.fmt_uptime("s", "coarse").alias("c"), fm.fmt_uptime("s", "table").alias("t"),
                    fm.fmt_uptime("s", "detail").alias("d")).collect()
    assert [r.c for r in out] == ["1d", "2h", "59s", "3m", "-"]
    assert [r.t for r in out] == ["25h", "2h", "59s", "3m", "-"]
    assert [r.d for r in out][:4] == ["1d 1h", "2h 0m", "59s", "3m"]


def test_heater_codes_and_bands(spark):
    """State codes and value bands."""
    df = spark.createDataFrame([(s,) for s in ["Off", "Starting", "Warming", "Running", "Ventilation",
                                               "ShuttingDown", "Cooling", "x"]], "s string")
    assert [r.c for r in df.select(fm.heater_state_code("s").alias("c")).collect()] == [0, 1, 2, 3, -1, 4, 5, -1]
    v = spark.createDataFrame([(10,), (15,), (30,), (59,), (60,), (None,)], "v int")
    got = [r.b for r in v.select(fm.band("v", [15, 30, 60], ["red", "orange", "yellow", "green"]).alias("b")).collect()]
    assert got == ["red", "orange", "yellow", "yellow", "green", None]


def test_topic_filter_regex():
    """Subscription filters as anchored regexes."""
    assert pr.topic_filter_regex("+/+/+/data") == "^[^/]*/[^/]*/[^/]*/data$"
    assert pr.topic_filter_regex("a/#") == "^a(/.*)?$"


def test_online_state(spark):
    """Online classification."""
    now = datetime(2024, 1, 1, 12, 0, 0)
    df = spark.createDataFrame([(datetime(2024, 1, 1, 11, 58),), (datetime(2024, 1, 1, 11, 30),),
                                (datetime(2024, 1, 1, 9, 0),), (None,)], "t timestamp_ntz")
    got = [r.s for r in df.select(pr.online_state("t", F.lit(now).cast("timestamp_ntz")).alias("s")).collect()]
    assert got == ["online", "recent", "offline", "offline"]


def test_binary_payload_decoding(spark):
    """Binary payloads decode as UTF-8 with replacement, then route as text."""
    from fleetspark.sources.messages import normalize_messages
    rows = [("s/sensors/a/data", bytearray(b'{"device_id": "a", "metrics": {"t": 1}}'), datetime(2024, 1, 1)),
            ("s/sensors/a/data", bytearray(b'\xff\xfe{"x"'), datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "topic string, payload binary, received_at timestamp_ntz")
    out = classify(normalize_messages(df)).collect()
    assert out[0].route == "measurements"
    assert out[1].reason == "bad_json" and "�" in out[1].payload


def test_timeline_groups_on_raw_status(spark):
    """X-3: pending/downloading/installing on one day give three 'In Progress' rows."""
    from fleetspark.operators.fleet import update_timeline
    d = datetime(2024, 1, 10)
    rows = [(1, "pending", d), (2, "downloading", d), (3, "installing", d), (4, "installing", d), (5, "success", d)]
    df = spark.createDataFrame(rows, "id int, status string, started_at timestamp_ntz")
    got = sorted((r.status, r["count"]) for r in update_timeline(df, F.lit(d).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).collect())
    assert got == [("In Progress", 1), ("In Progress", 1), ("In Progress", 2), ("Success", 1)]


def test_latest_release_by_creation_not_semver(spark):
    """X-13: the newest release is the one created last, not the highest version."""
    from fleetspark.operators.fleet import latest_release
    rows = [("esp32", "2.0.0", datetime(2024, 1, 1)), ("esp32", "1.9.0", datetime(2024, 2, 1)),
            ("esp8266", "b", datetime(2024, 1, 1)), ("esp8266", "a", datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "device_model string, version string, created_at timestamp_ntz")
    got = {r.device_model: r.latest_version for r in latest_release(df).collect()}
    assert got == {"esp32": "1.9.0", "esp8266": "b"}


def test_hash_bucket_property(spark):
    """Random unicode ids bucket exactly as Python's big-integer modulo."""
    from hypothesis import given, settings, strategies as st

    ids = []

    @settings(max_examples=300, deadline=None)
    @given(st.text(min_size=0, max_size=40))
    def collect(s):
        ids.append(s)

    collect()
    ids = [s for s in ids if "\x00" not in s]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(ids)], "i int, s string")
    got = {r.i: r.b for r in df.select("i", hash_bucket("s").alias("b")).collect()}
    assert all(got[i] == _py_bucket(s) for i, s in enumerate(ids))


def test_bands_of_every_dashboard_metric(spark):
    """P25: below, at and above each step of each metric's set; unknown metrics and nulls have no band."""
    rows, want = [("other", 1.0), ("flow_lpm", None)], [None, None]
    for metric, (steps, labels) in fm.BANDS.items():
        for i, step in enumerate(steps):
            rows += [(metric, step - 0.25), (metric, float(step)), (metric, step + 0.25)]
            want += [labels[i], labels[i + 1], labels[i + 1]]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, metric string, value double")
    assert [r.b for r in df.orderBy("i").select(fm.metric_band("metric", "value").alias("b")).collect()] == want
