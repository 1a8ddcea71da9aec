"""Writers and file sources: snapshot refresh, dated export, CSV/JSON export, firmware inventory."""

import hashlib
import os
from datetime import datetime

from fleetspark.operators.fleet import order_last_seen
from fleetspark.operators.latest import refresh_latest
from fleetspark.operators.upkeep import export, export_snapshot
from fleetspark.sources.firmware import firmware_inventory, upload_events


def test_refresh_and_exports(spark, scratch):
    """Snapshot refresh, dated export, CSV/JSON export."""
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    refresh_latest(df, os.path.join(scratch, "latest"))
    refresh_latest(df.where("k = 'a'"), os.path.join(scratch, "latest"))
    assert spark.read.parquet(os.path.join(scratch, "latest")).count() == 1
    p = export_snapshot(df, os.path.join(scratch, "snap"), "2024-01-02")
    assert p.endswith("dt=2024-01-02")
    assert spark.read.parquet(os.path.join(scratch, "snap")).where("dt = '2024-01-02'").count() == 2
    export(df, os.path.join(scratch, "csv"), "csv")
    export(df, os.path.join(scratch, "json"), "json")
    assert spark.read.option("header", True).csv(os.path.join(scratch, "csv")).count() == 2
    assert spark.read.json(os.path.join(scratch, "json")).count() == 2


def test_firmware_inventory(spark, scratch):
    """Artifact inventory and upload events."""
    folder = os.path.join(scratch, "fw")
    os.makedirs(folder)
    files = {"esp32_1.2.0.bin": b"\x00\x01abc", "board-a_2.0.bin": b"xyz" * 10, "bad name_1.0.bin": b"q"}
    for name, data in files.items():
        with open(os.path.join(folder, name), "wb") as f:
            f.write(data)
    inv = {r.device_model: r for r in firmware_inventory(spark, folder).collect()}
    assert inv["esp32"].version == "1.2.0" and inv["esp32"].file_size == 5
    assert inv["esp32"].checksum_sha256 == hashlib.sha256(files["esp32_1.2.0.bin"]).hexdigest()
    assert inv["board-a"].valid_name and not inv["bad name"].valid_name
    assert upload_events(firmware_inventory(spark, folder)).count() == 2


def test_order_last_seen_nulls_last(spark):
    """O3: DESC NULLS LAST."""
    df = spark.createDataFrame([("a", None), ("b", datetime(2024, 1, 2)), ("c", datetime(2024, 1, 3))],
                               "device_id string, last_seen timestamp_ntz")
    assert [r.device_id for r in order_last_seen(df).collect()] == ["c", "b", "a"]


def test_append_measurements_partitioned(spark, scratch):
    """Day-partitioned appends."""
    import json
    from datetime import datetime as dt

    from fleetspark.sources.messages import append_edge_status, append_measurements, classify, to_edge_status, \
        to_measurements
    rows = [("s/sensors/a/data", json.dumps({"device_id": "a", "metrics": {"t": 1}}), dt(2024, 1, 1, 5)),
            ("s/sensors/a/data", json.dumps({"device_id": "a", "metrics": {"t": 2}}), dt(2024, 1, 2, 5)),
            ("s/edge/e/status", json.dumps({"state": "RUN"}), dt(2024, 1, 2, 6))]
    c = classify(spark.createDataFrame(rows, "topic string, payload string, received_at timestamp_ntz"))
    out = os.path.join(scratch, "m")
    append_measurements(to_measurements(c), out)
    append_measurements(to_measurements(c), out)
    m = spark.read.parquet(out)
    assert m.count() == 4 and m.where("dt = '2024-01-02'").count() == 2
    append_edge_status(to_edge_status(c), os.path.join(scratch, "s"))
    assert spark.read.parquet(os.path.join(scratch, "s")).first().status["state"] == "RUN"


def test_time_range_prunes_day_partitions(spark, scratch):
    from fleetspark.functions.predicates import time_range
    rows = [(datetime(2024, 1, d, 12), d) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v int")
    out = os.path.join(scratch, "t")
    df.withColumn("dt", __import__("pyspark.sql.functions", fromlist=["to_date"]).to_date("ts")) \
        .write.partitionBy("dt").parquet(out)
    q = time_range(spark.read.parquet(out), "ts", datetime(2024, 1, 3), datetime(2024, 1, 5, 23))
    assert sorted(r.v for r in q.collect()) == [3, 4, 5]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_old_days_are_removed(spark, scratch):
    """Dated folders beyond the retention go, the rest and other names stay."""
    import datetime
    import os

    from fleetspark.operators import upkeep as uk
    base = os.path.join(scratch, "snapshots")
    for day in ("2024-01-01", "2024-01-05", "2024-01-09"):
        uk.export_snapshot(spark.range(3), base, day)
    os.makedirs(os.path.join(base, "other"))
    uk.export_snapshot(spark.range(4), base, "2024-01-10", keep_days=5)
    assert sorted(n for n in os.listdir(base)) == ["dt=2024-01-05", "dt=2024-01-09", "dt=2024-01-10", "other"]
    assert uk.drop_old_days(spark, base, datetime.date(2024, 1, 10), 0) == ["dt=2024-01-05", "dt=2024-01-09"]
    assert uk.drop_old_days(spark, os.path.join(base, "absent"), datetime.date(2024, 1, 10), 0) == []

