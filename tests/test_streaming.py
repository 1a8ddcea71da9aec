"""Batch = stream equality for the Structured Streaming forms (ST1, ST2, ST4, ST5)."""

import glob
import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetspark.operators.buckets import bucket_avg
from fleetspark.operators.updates import update_attempts
from fleetspark.sources.messages import MESSAGE_SCHEMA, classify
from fleetspark.operators.runs import gap_segments, state_intervals
from fleetspark.streaming.ingest import (SeenNumbers, attempts_of_ingest, bucket_avg_exact_batch, bucket_avg_exact_stream, bucket_avg_stream,
                                         gap_segments_stream, latest_batch, latest_stream, read_bucket_avg, read_state_intervals, start_ingest,
                                         state_intervals_stream, update_attempts_stream)
from fleetspark.streaming.store import Files, Snapshot, append_batch, read_snapshot

T0 = datetime(2024, 1, 1)


def _write_chunks(spark, rows, schema, folder, chunks=3):
    """Drop rows into a folder as several files (one micro-batch each with maxFilesPerTrigger=1)."""
    os.makedirs(folder, exist_ok=True)
    step = (len(rows) + chunks - 1) // chunks
    for i in range(chunks):
        part = rows[i * step:(i + 1) * step]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("overwrite").json(os.path.join(folder, f"c{i}"))
    return folder


def _messages():
    rows = []
    for i in range(300):
        dev = f"d{i % 7}"
        if i % 5 == 0:
            rows.append((f"s/edge/{dev}/status", json.dumps({"state": "RUN", "uptime_seconds": i}), T0 + timedelta(minutes=i), i))
        elif i % 11 == 0:
            rows.append((f"s/sensors/{dev}/data", "not json", T0 + timedelta(minutes=i), i))
        else:
            rows.append((f"s/sensors/{dev}/data", json.dumps({"device_id": dev, "metrics": {"t": i}}), T0 + timedelta(minutes=i), i))
    return rows


def test_ingest_stream_equals_batch(spark, scratch):
    """ST1: streamed ingest equals batch routing."""
    rows = _messages()
    src = _write_chunks(spark, rows, MESSAGE_SCHEMA, os.path.join(scratch, "in"))
    files = [os.path.join(dp, f) for dp, _, fs in os.walk(src) for f in fs if f.endswith(".json")]
    stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", 1).json(
        [os.path.dirname(f) for f in files][0].rsplit("/", 1)[0] + "/*")
    out = os.path.join(scratch, "out")
    q = start_ingest(stream, out, checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(120)
    batch = classify(spark.createDataFrame(rows, MESSAGE_SCHEMA))
    m = spark.read.parquet(os.path.join(out, "measurements"))
    assert m.count() == batch.where(F.col("route") == "measurements").count()
    assert spark.read.parquet(os.path.join(out, "edge_status")).count() == batch.where(F.col("route") == "edge_status").count()
    assert spark.read.parquet(os.path.join(out, "rejects")).count() == batch.where(F.col("reason").isNotNull()).count()


def test_bucket_stream_equals_batch(spark, scratch):
    """ST2: watermarked bucket means equal the batch means."""
    rows = [(T0 + timedelta(minutes=7 * i), float(i % 13)) for i in range(400)]
    schema = "ts timestamp_ntz, v double"
    src = os.path.join(scratch, "in")
    spark.createDataFrame(rows, schema).write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)
    agg = bucket_avg_stream(stream, "ts", "v", "1 hour", lateness="0 seconds")
    q = (agg.writeStream.outputMode("complete").format("memory").queryName("bucket_stream_t")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = sorted((r.time, round(r.value, 9)) for r in spark.table("bucket_stream_t").collect())
    exp = sorted((r.time, round(r.value, 9)) for r in
                 bucket_avg(spark.createDataFrame(rows, schema), "ts", "v", "1 hour", metric="v").collect())
    assert got == exp


def test_update_attempts_stream_equals_batch(spark, scratch):
    """ST4: streamed attempt tracking equals the batch fold."""
    from tests.test_operators import _random_ota
    msgs = _random_ota(n=1500, seed=5)
    schema = "device_id string, kind string, received_at timestamp_ntz, seq long, payload string"
    folder = os.path.join(scratch, "in")
    for i in range(3):
        spark.createDataFrame(msgs[i::3], schema).coalesce(1).write.parquet(os.path.join(folder, f"c{i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(folder, "*"))
    # the rows of a batch come late for the one before, and a third of all messages is delivered again
    spark.createDataFrame(msgs[::3], schema).coalesce(1).write.parquet(os.path.join(folder, "c3"))
    snap = os.path.join(scratch, "snap")
    q = update_attempts_stream(stream, snap, checkpoint=os.path.join(scratch, "ck"), buckets=4)
    q.awaitTermination(300)
    cols = ["device_id", "attempt", "firmware_version", "status", "progress_percent", "error_message",
            "started_at", "completed_at", "reported_at", "messages"]
    got = sorted(tuple(r) for r in read_snapshot(spark, snap, ["device_id"]).select(*cols).collect())
    exp = sorted(tuple(r) for r in update_attempts(spark.createDataFrame(msgs, schema)).select(*cols).collect())
    assert got == exp


def test_set_state_lies_on_disk(spark, scratch):
    """ST4: the state is in RocksDB, not in maps on the executors' heaps; neither settings nor files of a batch stay behind."""
    from tests.test_operators import _random_ota
    schema = "device_id string, kind string, received_at timestamp_ntz, seq long, payload string"
    rows, folder, ck, snap = _random_ota(n=300, seed=6), os.path.join(scratch, "in"), os.path.join(scratch, "ck"), os.path.join(scratch, "snap")
    for i in range(2):
        spark.createDataFrame(rows[i::2], schema).coalesce(1).write.parquet(os.path.join(folder, f"c{i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(folder, "*"))
    update_attempts_stream(stream, snap, checkpoint=ck, buckets=4).awaitTermination(300)
    kinds = {os.path.splitext(n)[1] for _, _, names in os.walk(os.path.join(ck, "state")) for n in names}
    assert ".delta" not in kinds and kinds & {".zip", ".changelog"}, kinds
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) is None
    assert not [n for _, _, names in os.walk(os.path.join(snap, "touched")) for n in names if n.endswith(".parquet")]
    assert read_snapshot(spark, snap, ["device_id"]).count() == update_attempts(spark.createDataFrame(rows, schema)).count()


def test_latest_stream_keeps_newest(spark, scratch):
    """ST5: latest-per-key snapshot over several batches."""
    rows = [(f"d{i % 5}", T0 + timedelta(minutes=i), i, f"cfg{i}") for i in range(60)]
    schema = "device_id string, updated_at timestamp_ntz, seq int, config string"
    folder = os.path.join(scratch, "in")
    for i in range(3):
        spark.createDataFrame(rows[i * 20:(i + 1) * 20], schema).coalesce(1).write.parquet(os.path.join(folder, f"c{i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(folder, "*"))
    snap = os.path.join(scratch, "snap")
    q = latest_stream(stream, snap, ["device_id"], ["updated_at", "seq"], checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination(300)
    got = {r.device_id: r.config for r in read_snapshot(spark, snap, ["device_id"]).collect()}
    assert got == {f"d{k}": f"cfg{55 + k}" for k in range(5)}


def test_bucket_snapshot_over_batches_equals_batch(spark, scratch):
    """ST2: update-mode buckets over several batches."""
    from fleetspark.streaming.ingest import bucket_avg_to_snapshot
    rows = [(T0 + timedelta(minutes=11 * i), float(i % 17)) for i in range(600)]
    schema = "ts timestamp_ntz, v double"
    folder = os.path.join(scratch, "in")
    # interleaved files so later batches update buckets written by earlier ones
    for i in range(3):
        spark.createDataFrame(rows[i::3], schema).coalesce(1).write.parquet(os.path.join(folder, f"c{i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(folder, "*"))
    agg = bucket_avg_stream(stream, "ts", "v", "1 hour", lateness="3650 days")
    snap = os.path.join(scratch, "snap")
    bucket_avg_to_snapshot(agg, snap, ["time"], os.path.join(scratch, "ck")).awaitTermination(300)
    got = sorted((r.time, round(r.value, 9), r.rows) for r in read_snapshot(spark, snap, ["time"]).collect())
    b = spark.createDataFrame(rows, schema)
    exp = sorted((r.time, round(r.value, 9), r.rows) for r in
                 b.groupBy(F.window("ts", "1 hour").start.alias("time")).agg(F.avg("v").alias("value"),
                                                                          F.count("*").alias("rows")).collect())
    assert got == exp


def test_exact_buckets_accept_late_rows(spark, scratch):
    """ST3: rows for earlier days are added to the stored sums; the result is the batch mean of all rows, also with odd values."""
    schema = "ts timestamp_ntz, d string, v double"
    rows = [(T0 + timedelta(hours=3 * (i * 37 % 200)), f"d{i % 2}", i / 7 if i % 11 else None) for i in range(200)]
    rows += [(T0, "nan", float("nan")), (T0, "inf", float("inf")), (T0 + timedelta(days=3), "inf", 1.0), (T0, "big", 1e300), (None, "d0", 1.0), (T0, None, 2.0)]
    folder = os.path.join(scratch, "in")
    for i in range(3):
        spark.createDataFrame(rows[i::3], schema).coalesce(1).write.parquet(os.path.join(folder, f"c{i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(folder, "*"))
    for every, grain in (("7 days", "day"), ("6 hours", "month")):
        store = os.path.join(scratch, f"store-{grain}")
        bucket_avg_exact_stream(stream, store, "ts", "v", every, ["d"], os.path.join(scratch, f"ck-{grain}"), grain=grain, buckets=2).awaitTermination(300)
        got = {(r.time, r.d): (str(r.value and round(r.value, 7)), r.rows) for r in read_bucket_avg(spark, store, ["d"]).collect()}
        every_row = spark.createDataFrame(rows, schema).groupBy(F.window("ts", every).start.alias("time"), "d").agg(F.avg("v").alias("value"), F.count("*").alias("rows"))
        assert got == {(r.time, r.d): (str(r.value and round(r.value, 7)), r.rows) for r in every_row.collect()}


def test_exact_buckets_read_touched_periods_only(spark, scratch):
    """ST3: a batch rewrites the parts of its own days; a replay of a finished batch adds nothing."""
    store = os.path.join(scratch, "store")
    day = lambda n, v: spark.createDataFrame([(T0 + timedelta(days=n), v)], "ts timestamp_ntz, v double")
    for i in range(4):
        bucket_avg_exact_batch(day(i, 1.0), i, store, "ts", "v", "1 day", "r", grain="day", buckets=1)
    for _ in range(2):
        bucket_avg_exact_batch(day(0, 5.0), 4, store, "ts", "v", "1 day", "r", grain="day", buckets=1)
    manifest = json.load(open(sorted(glob.glob(os.path.join(store, "commits", "*.json")))[-1]))
    assert sorted(manifest["parts"].values()) == [f"{n:012d}" for n in (1, 2, 3, 4)]
    assert sorted((r.value, r.rows) for r in read_bucket_avg(spark, store).collect()) == [(1.0, 1)] * 3 + [(3.0, 2)]


# --- repeated delivery -----------------------------------------------------------------------------------------

def _file_stream(spark, schema, folder):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(os.path.join(folder, "*"))


def test_messages_count_once_over_runs(spark, scratch):
    """ST1: a drop delivered again under a fresh checkpoint, with new messages among it, gives every row once."""
    rows, out, src = _messages(), os.path.join(scratch, "out"), os.path.join(scratch, "in")
    unnumbered = [("s/sensors/x/data", json.dumps({"device_id": "x", "metrics": {"t": 1}}), T0, None)] * 2
    _write_chunks(spark, rows[:200] + unnumbered, MESSAGE_SCHEMA, src, 2)
    start_ingest(_file_stream(spark, MESSAGE_SCHEMA, src), out, checkpoint=os.path.join(scratch, "a"), buckets=2).awaitTermination(300)
    again = _write_chunks(spark, rows[100:] + rows[120:130], MESSAGE_SCHEMA, os.path.join(scratch, "again"), 1)
    start_ingest(_file_stream(spark, MESSAGE_SCHEMA, again), out, checkpoint=os.path.join(scratch, "b"), buckets=2).awaitTermination(300)
    batch = classify(spark.createDataFrame(rows, MESSAGE_SCHEMA))
    for name, route in (("measurements", "measurements"), ("edge_status", "edge_status")):
        extra = 2 if name == "measurements" else 0  # messages without a number cannot be told apart
        assert spark.read.parquet(os.path.join(out, name)).count() == batch.where(F.col("route") == route).count() + extra


def test_attempts_of_a_repeated_drop(spark, scratch):
    """W9 behind ST1: one status message under two runs is one attempt."""
    rows = [("s/edge/d/ota/status", json.dumps({"version": "2"}), T0, 1), ("s/edge/d/ota/progress", json.dumps({"percent": 40}), T0, 2)]
    out, snap = os.path.join(scratch, "out"), os.path.join(scratch, "snap")
    src = _write_chunks(spark, rows, MESSAGE_SCHEMA, os.path.join(scratch, "in"), 1)
    for run in ("a", "b"):
        start_ingest(_file_stream(spark, MESSAGE_SCHEMA, src), out, checkpoint=os.path.join(scratch, run), buckets=2).awaitTermination(300)
    attempts_of_ingest(spark, out, snap, os.path.join(scratch, "ck"), buckets=2).awaitTermination(300)
    assert [(r.attempt, r.progress_percent, r.messages) for r in read_snapshot(spark, snap, ["device_id"]).collect()] == [(1, 40, 2)]


def test_seen_numbers(spark, scratch, monkeypatch):
    """Ranges of seen numbers: sets of any order and distance, a replay finds what its first try found."""
    import random

    from fleetspark.streaming import ingest
    monkeypatch.setattr(ingest, "SEQ_BLOCK", 50)
    rnd, known = random.Random(1), set()
    seen = SeenNumbers(spark, os.path.join(scratch, "seen"), 3)
    for batch in range(5):
        numbers = [rnd.randint(-60, 400) for _ in range(80)] + list(range(batch * 70, batch * 70 + 70))
        df = spark.createDataFrame([(n,) for n in numbers] + [(None,)], "seq long")
        for _ in range(2):
            got = [r.seq for r in seen.first_deliveries(df, "r", batch).collect()]
            assert sorted(x for x in got if x is not None) == sorted(set(numbers) - known) and got.count(None) == 1
            seen.add(df, "r", batch)
        known |= set(numbers)
    assert seen.snapshot.read().count() < len(known) / 3


# --- runs as streams -------------------------------------------------------------------------------------------

def _series(n, seed):
    import random
    rnd = random.Random(seed)
    return [(rnd.choice(["a", "a", "b", None]), T0 + timedelta(minutes=rnd.randint(0, 9000)), i, rnd.choice(["on", "on", "off", None])) for i in range(n)]


def test_intervals_and_segments_over_shuffled_batches(spark, scratch):
    """Shuffled batches, which split intervals and join segments, equal the batch operators; null keys and states included."""
    schema, rows = "k string, ts timestamp_ntz, i int, s string", _series(500, 4)
    folder = os.path.join(scratch, "in")
    for i in range(3):
        spark.createDataFrame(rows[i::3], schema).coalesce(1).write.parquet(os.path.join(folder, f"c{i}"))
    spark.createDataFrame(rows[:40], schema).coalesce(1).write.parquet(os.path.join(folder, "c3"))  # again: sets of rows do not change
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    whole = spark.createDataFrame(rows, schema)
    at, ck = os.path.join(scratch, "intervals"), os.path.join(scratch, "ck1")
    state_intervals_stream(stream.parquet(os.path.join(folder, "*")), ["k"], "ts", "s", "i", at, ck, buckets=2, chunk_seconds=3600).awaitTermination(300)
    cols = ["k", "run", "state", "start", "end", "rows"]
    key = lambda df, c: sorted((tuple(r) for r in df.select(*c).collect()), key=str)
    assert key(read_state_intervals(spark, at, ["k"]), cols) == key(state_intervals(whole, ["k"], "ts", "s", "i"), cols)
    at, ck = os.path.join(scratch, "segments"), os.path.join(scratch, "ck2")
    gap_segments_stream(stream.parquet(os.path.join(folder, "c[012]")), ["k"], "ts", "i", at, "45 minutes", ck, buckets=2).awaitTermination(300)
    cols = ["k", "segment", "start", "end", "rows"]
    assert key(read_snapshot(spark, at, ["k"]), cols) == key(gap_segments(whole, ["k"], "ts", "i", "45 minutes"), cols)


# --- no loss ---------------------------------------------------------------------------------------------------

ROW = "device_id string, updated_at timestamp_ntz, seq int, config string"


def _configs(spark, ids, seq):
    return spark.createDataFrame([(f"d{i}", T0 + timedelta(minutes=seq), seq, f"c{seq}") for i in ids], ROW)


def test_unreadable_snapshot_fails_the_batch(spark, scratch):
    """A read error is not an empty table: the batch fails and nothing is lost."""
    snap, order = os.path.join(scratch, "snap"), ["updated_at", "seq"]
    latest_batch(_configs(spark, range(300), 1), 0, snap, ["device_id"], order, "r")
    files = glob.glob(os.path.join(snap, "data", "*", "*", "*.parquet"))
    whole = {f: open(f, "rb").read() for f in files}
    for f in files:
        open(f, "wb").write(b"broken")
    with pytest.raises(Exception):
        latest_batch(_configs(spark, range(100), 2), 1, snap, ["device_id"], order, "r")
    for f, data in whole.items():
        open(f, "wb").write(data)
    for crc in glob.glob(os.path.join(snap, "data", "*", "*", ".*.crc")):
        os.remove(crc)
    assert read_snapshot(spark, snap, ["device_id"]).count() == 300
    latest_batch(_configs(spark, range(100), 2), 1, snap, ["device_id"], order, "r")
    got = read_snapshot(spark, snap, ["device_id"]).groupBy("config").count().collect()
    assert {r["config"]: r["count"] for r in got} == {"c1": 200, "c2": 100}


def test_crash_before_the_manifest_and_replay(spark, scratch, monkeypatch):
    """A commit that stops before its manifest leaves the table as it was; the replay completes it."""
    snap, order = os.path.join(scratch, "snap"), ["updated_at", "seq"]
    latest_batch(_configs(spark, range(50), 1), 0, snap, ["device_id"], order, "r")
    with monkeypatch.context() as m:
        m.setattr(Files, "write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            latest_batch(_configs(spark, range(20, 70), 2), 1, snap, ["device_id"], order, "r")
    assert read_snapshot(spark, snap, ["device_id"]).count() == 50
    for _ in range(2):  # the replay, and a replay of the finished batch
        latest_batch(_configs(spark, range(20, 70), 2), 1, snap, ["device_id"], order, "r")
        got = {r["device_id"]: r["config"] for r in read_snapshot(spark, snap, ["device_id"]).collect()}
        assert got == {f"d{i}": "c1" if i < 20 else "c2" for i in range(70)}


def test_old_commits_are_cleaned(spark, scratch):
    snap = os.path.join(scratch, "snap")
    for i in range(6):
        latest_batch(_configs(spark, range(40), i), i, snap, ["device_id"], ["updated_at", "seq"], "r")
    assert len(os.listdir(os.path.join(snap, "data"))) <= 4
    assert read_snapshot(spark, snap, ["device_id"]).select("config").distinct().collect()[0][0] == "c5"


def test_fresh_checkpoint_keeps_earlier_batches(spark, scratch):
    """A stream that starts again from batch 0 is another run: its folders do not replace the old ones."""
    path = os.path.join(scratch, "table")
    append_batch(spark.range(10), path, "run-a", 0)
    append_batch(spark.range(100, 105), path, "run-b", 0)
    append_batch(spark.range(100, 105), path, "run-b", 0)
    assert spark.read.parquet(path).count() == 15


def test_null_keys_live_in_a_snapshot(spark, scratch):
    snap = Snapshot(spark, os.path.join(scratch, "snap"), ["device_id"])
    df = spark.createDataFrame([(None, T0, 1, "a"), ("x", T0, 1, "b")], ROW)
    snap.update(df, lambda cur, new: new, "r", 0)
    assert snap.read().count() == 2


def test_upkeep_needs_seq(spark, scratch):
    schema = "topic string, payload string, received_at timestamp_ntz"
    src = os.path.join(scratch, "in")
    spark.createDataFrame([], schema).write.json(src)
    with pytest.raises(ValueError):
        start_ingest(spark.readStream.schema(schema).json(src), os.path.join(scratch, "out"), upkeep=True)


def test_readme_example(spark, scratch):
    """Messages with a seq go from a drop folder through classify to attempts."""
    from fleetspark.operators import updates
    from fleetspark.sources import messages as ms
    src = os.path.join(scratch, "in")
    rows = [("s/edge/d/ota/status", json.dumps({"version": "2"}), T0, 1), ("s/edge/d/ota/progress", json.dumps({"percent": 5000000000}), T0, 2),
            ("s/edge/d/ota/progress", json.dumps({"percent": 40}), T0, 3)]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).write.json(src)
    got = updates.update_attempts(ms.to_ota(ms.classify(ms.read_messages(spark, src)))).collect()
    assert [(r["device_id"], r["attempt"], r["firmware_version"], r["progress_percent"], r["messages"]) for r in got] == [("d", 1, "2", 40, 2)]
    binary = spark.createDataFrame([("s/x/d/data", b"\xff{", T0, 1)], "topic string, payload binary, received_at timestamp_ntz, seq long")
    binary.write.parquet(os.path.join(scratch, "bin"))
    assert ms.read_messages(spark, os.path.join(scratch, "bin"), fmt="parquet", binary=True).first()["payload"] == "\ufffd{"
