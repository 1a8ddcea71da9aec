"""Absence alerts (AL2, AL3, AL4) against a plain model at every watermark."""

import os
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fleetspark.streaming.absence import absence_stream, absences, read_alerts

T0, HOUR = datetime(2024, 1, 1), 3600 * 1000
SCHEMA = "device_id string, ts timestamp_ntz, kind string"


def _standing(rows, now, wait):
    """Devices whose newest arming is older than ``wait`` before ``now`` and has no sighting after its deadline."""
    out = {}
    for d in {r[0] for r in rows}:
        marks = [(t, k == "disarm") for x, t, k in rows if x == d and k != "seen"]
        if marks and not max(marks)[1]:
            deadline = max(marks)[0] + wait
            if deadline < now and not any(x == d and k == "seen" and t >= deadline for x, t, k in rows):
                out[d] = deadline
    return out


def test_alerts_equal_the_model_at_every_watermark(spark, scratch):
    rnd = random.Random(2)
    rows = [(f"d{rnd.randint(0, 9)}", T0 + timedelta(minutes=rnd.randint(0, 6000)), rnd.choice(["arm", "arm", "disarm", "seen"])) for _ in range(150)]
    rows.sort(key=lambda r: r[1] + timedelta(minutes=rnd.randint(0, 100)))  # late by up to 100 minutes
    wait, folder, snap = timedelta(hours=10), os.path.join(scratch, "in"), os.path.join(scratch, "snap")
    for i in range(3):
        spark.createDataFrame(rows[i * 50:(i + 1) * 50], SCHEMA).coalesce(1).write.json(os.path.join(folder, f"c{i}"))
        stream = spark.readStream.schema(SCHEMA).json(os.path.join(folder, "*"))
        absence_stream(stream, "device_id", "ts", F.col("kind"), 10 * HOUR, "2 hours", snap, os.path.join(scratch, "ck"), buckets=2).awaitTermination(300)
        seen = rows[:(i + 1) * 50]
        want = _standing(seen, max(t for _, t, _ in seen) - timedelta(hours=2), wait)
        assert {r.device_id: r.at for r in read_alerts(spark, snap, "device_id").collect()} == want


def test_fires_once_without_a_new_row_and_clears_on_return(spark, scratch):
    folder, log = os.path.join(scratch, "in"), os.path.join(scratch, "log")
    drops = [[("a", T0, "arm"), ("b", T0, "arm")], [("b", T0 + timedelta(hours=9), "arm")], [("b", T0 + timedelta(hours=18), "arm")],
             [("a", T0 + timedelta(hours=18, minutes=30), "arm"), ("b", T0 + timedelta(hours=19), "arm"), ("b", None, "arm")]]
    for i, rows in enumerate(drops):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.json(os.path.join(folder, f"c{i}"))
        stream = spark.readStream.schema(SCHEMA).json(os.path.join(folder, "*"))
        changes = absences(stream, "device_id", "ts", F.col("kind"), 6 * HOUR, "0 seconds")
        write = lambda df, bid: df.write.mode("append").parquet(log)
        (changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start().awaitTermination(300))
    changed = sorted((r.device_id, r.alert, r.at) for r in spark.read.parquet(log).collect() if r.device_id == "a")
    assert [(a, t) for _, a, t in changed if a] == [(True, T0 + timedelta(hours=6))] and [a for _, a, _ in changed].count(False) == 1


def _share_states(spark, scratch, kinds, wait):
    """All rows in two drops, in order of time, into four states; the alerts that stand, and the rows of state."""
    rnd = random.Random(3)
    rows = [(f"d{rnd.randint(0, 299)}" if rnd.random() < 0.99 else None, T0 + timedelta(minutes=rnd.randint(0, 6000)), rnd.choice(kinds)) for _ in range(900)]
    rows.sort(key=lambda r: r[1])
    folder, snap, ck = (os.path.join(scratch, x) for x in ("in", "snap", "ck"))
    for i in range(2):
        spark.createDataFrame(rows[i * 450:(i + 1) * 450], SCHEMA).coalesce(1).write.json(os.path.join(folder, f"c{i}"))
        stream = spark.readStream.schema(SCHEMA).json(os.path.join(folder, "*"))
        q = absence_stream(stream, "device_id", "ts", F.col("kind"), wait // timedelta(milliseconds=1), "1 hour", snap, ck, buckets=2, groups=4)
        q.awaitTermination(300)
    want = _standing(rows, max(t for _, t, _ in rows) - timedelta(hours=1), wait)
    got = {r.device_id: r.at for r in read_alerts(spark, snap, "device_id").where("device_id IS NOT NULL").collect()}
    return got, {k: v for k, v in want.items() if k is not None}, q.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_many_keys_share_few_states_with_sightings(spark, scratch):
    got, want, states = _share_states(spark, scratch, ["arm", "seen", "seen"], timedelta(hours=20))
    assert got == want and len(want) > 20 and states <= 4


def test_many_keys_share_few_states_with_disarming(spark, scratch):
    got, want, states = _share_states(spark, scratch, ["arm", "arm", "disarm"], timedelta(hours=20))
    assert got == want and len(want) > 20 and states <= 4
