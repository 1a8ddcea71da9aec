"""Structured Streaming forms of ingest, bucketing, update tracking, runs and alerts (ST1-ST5, W7, W8).

Sinks are Parquet folders written from ``foreachBatch`` (see ``store``): appends
are keyed by run and micro-batch, keyed tables are snapshots that commit by
manifest, so a replay after a loss gives the same table and no write puts
committed rows at risk. The checkpoint lives in the shared folder the cluster
names in ``spark.checkpoint.dir``.

No batch body reads stored messages again. What a late row can change is kept in a form that merges:
sums (ST3), segments (W8), sets of seen sequence numbers as ranges (ST1), and where a late row can split
what earlier rows made (ST4, W7) the set of row effects of each (key, time chunk), a streaming aggregate in Spark's
state store whose touched groups alone reach the batch body.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fleetspark.operators.buckets import bucket
from fleetspark.operators.runs import chunk_intervals, gap_segments, intervals_of, join_segments, time_chunk
from fleetspark.operators.updates import EFFECT, attempt_parts, merge_attempts, message_effects
from fleetspark.operators.upkeep import upsert_devices, upsert_latest
from fleetspark.session import checkpoint_dir
from fleetspark.sources import messages as ms
from fleetspark.streaming.store import KEY_BUCKETS, Files, Snapshot, append_batch, batch_folder, read_snapshot, run_of


#: For streams whose state grows with the messages: it lies in RocksDB on the executors' disks, where Spark's default
#: holds every group of every state in maps on their heaps. The states of an executor share one bounded cache.
STATE_ON_DISK = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
                 "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true", "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


def _start(stream: DataFrame, body: Callable[[DataFrame, int, str], None], name: str, checkpoint: str | None,
           trigger: dict | None, mode: str = "append", settings: dict[str, str] | None = None):
    """Start a stream whose batches go to ``body(batch, batch id, run id)``. ``settings`` hold for this stream alone, where the
    session has none of its own; a checkpoint keeps the kind of state store that it began with."""
    spark = stream.sparkSession
    at = checkpoint or os.path.join(checkpoint_dir(spark), "streams", name)
    run = run_of(spark, at)
    w = (stream.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", at)
         .foreachBatch(lambda df, bid: body(df, bid, run)))
    unset = [k for k in settings or {} if spark.conf.get(k, None) is None]
    try:
        for k in unset:
            spark.conf.set(k, settings[k])
        return w.trigger(**(trigger or {"availableNow": True})).start()  # copies the session's settings
    finally:
        for k in unset:
            spark.conf.unset(k)


#: Sequence numbers of one block of the table of seen numbers.
SEQ_BLOCK = 1 << 20


def _seen_before(fresh: DataFrame, stored: DataFrame | None) -> DataFrame:
    """The rows of ``fresh`` (block, lo = hi) that no stored range (block, lo, hi) holds."""
    if stored is None:
        return fresh
    both = fresh.withColumn("_new", F.lit(True)).unionByName(stored.select("block", "lo", "hi").withColumn("_new", F.lit(False)))
    w = Window.partitionBy("block").orderBy("lo", "_new").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = F.max(F.when(~F.col("_new"), F.col("hi"))).over(w)
    return both.withColumn("_held", held).where(F.col("_new") & (F.col("_held").isNull() | (F.col("_held") < F.col("lo")))).drop("_new", "_held")


def _join_ranges(ranges: DataFrame) -> DataFrame:
    """Neighbouring and overlapping ranges of a block as one."""
    w = Window.partitionBy("block").orderBy("lo", "hi")
    reach = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = ranges.withColumn("_opens", F.coalesce(F.col("lo") > reach + 1, F.lit(True)).cast("long"))
    numbered = opened.withColumn("_n", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("block", "_n").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_n")


class SeenNumbers:
    """Sequence numbers delivered so far, as ranges per block of numbers: a source that counts up leaves one row a block.

    Exact for repeats at any distance and over any number of runs; a watermark (as in
    ``dropDuplicatesWithinWatermark``) would also drop late first deliveries."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = KEY_BUCKETS):
        self.snapshot = Snapshot(spark, path, ["block"], buckets)

    def _numbers(self, batch: DataFrame) -> DataFrame:
        seq = F.col("seq")
        return (batch.where(seq.isNotNull()).select(F.floor(seq / SEQ_BLOCK).alias("block"), seq.alias("lo"), seq.alias("hi")).distinct())

    def first_deliveries(self, batch: DataFrame, run: str, batch_id: int) -> DataFrame:
        """One row of ``batch`` per number that earlier batches did not bring; rows without a number all stay."""
        numbers = self._numbers(batch)
        stored = self.snapshot.read_before(run, batch_id, self.snapshot.parts_of(numbers))
        fresh = _seen_before(numbers, stored).select(F.col("lo").alias("_seq"))
        once = batch.dropDuplicates(["seq"]).join(fresh, F.col("seq") == F.col("_seq"), "left_semi")
        return once.unionByName(batch.where(F.col("seq").isNull()))

    def add(self, batch: DataFrame, run: str, batch_id: int) -> None:
        merge = lambda cur, new: _join_ranges(new if cur is None else cur.unionByName(new))
        self.snapshot.update(self._numbers(batch), merge, run, batch_id)


def ingest_batch(batch: DataFrame, batch_id: int, out: str, run: str, upkeep: bool = False, buckets: int = KEY_BUCKETS) -> None:
    """ST1 body: classify once, append each routed table and the rejects; with ``upkeep``
    also keep the current configs (S5) and the registry (S6).

    With a ``seq`` column a message gives its rows once, however often and under whatever run it is delivered. The numbers are
    noted last, so a batch that stops half-way is done again in full."""
    spark = batch.sparkSession
    at = lambda name: os.path.join(out, name)
    batch = batch.persist()
    numbered = "seq" in batch.columns
    seen = SeenNumbers(spark, at("seen"), buckets) if numbered else None
    c = ms.classify(seen.first_deliveries(batch, run, batch_id) if numbered else batch).persist()
    try:
        append_batch(ms.to_measurements(c).withColumn("dt", F.to_date("ts")), at("measurements"), run, batch_id, ["dt"])
        append_batch(ms.to_edge_status(c), at("edge_status"), run, batch_id)
        append_batch(ms.to_edge_config(c), at("edge_config"), run, batch_id)
        append_batch(ms.rejects(c), at("rejects"), run, batch_id)
        append_batch(ms.to_ota(c), at("ota_messages"), run, batch_id)
        if upkeep:
            latest_batch(ms.to_edge_config(c), batch_id, at("current_configs"), ["site_id", "device_id"], ["updated_at", "seq"], run, buckets)
            Snapshot(spark, at("devices"), ["device_id"], buckets).update(
                ms.to_sightings(c), lambda cur, new: upsert_devices(cur, new, "status", late=True), run, batch_id)
        if numbered:
            seen.add(batch, run, batch_id)
    finally:
        c.unpersist()
        batch.unpersist()


def start_ingest(stream: DataFrame, out: str, checkpoint: str | None = None, trigger: dict | None = None,
                 name: str = "ingest", upkeep: bool = False, buckets: int = KEY_BUCKETS):
    """ST1: continuous ingest and routing. ``trigger`` e.g. ``{"availableNow": True}``
    or ``{"processingTime": "30 seconds"}`` (the poll interval). ``upkeep`` needs a ``seq``
    column (a stable per-message number such as the Kafka offset) in the stream; ``buckets`` sizes
    its snapshots. ``attempts_of_ingest`` follows the OTA messages that this stream writes."""
    if upkeep and "seq" not in stream.columns:
        raise ValueError("upkeep orders messages by seq; the stream has no such column")
    return _start(stream, lambda df, bid, run: ingest_batch(df, bid, out, run, upkeep, buckets), name, checkpoint, trigger)


def attempts_of_ingest(spark: SparkSession, out: str, snapshot: str, checkpoint: str | None = None, trigger: dict | None = None,
                       name: str = "ingest_attempts", buckets: int = KEY_BUCKETS, chunk_seconds: int = 86400):
    """ST4 behind ST1: the OTA messages that an ingest writes, as a stream into the attempt table. A message read
    twice (its folder was written again after a loss) changes nothing."""
    log = os.path.join(out, "ota_messages")
    Files(spark, log).make_folder(log)
    schema = "device_id string, kind string, received_at timestamp_ntz, payload string, seq long"
    stream = spark.readStream.schema(schema).parquet(log).select("device_id", "kind", "received_at", "payload", "seq")
    return update_attempts_stream(stream, snapshot, checkpoint, trigger, name, buckets, chunk_seconds)


def bucket_avg_stream(stream: DataFrame, ts: str, value, every: str, lateness: str | None,
                      by: Sequence[str] = ()) -> DataFrame:
    """ST2/ST3: incremental tumbling-bucket mean.

    ``lateness`` has no default because it decides what is lost: rows later than that behind
    the newest event time are dropped by the state store (Spark counts them in
    ``numRowsDroppedByWatermark``). None drops nothing and keeps the state of every
    bucket; ``bucket_avg_exact_stream`` accepts any lateness without such state.
    """
    v = F.col(value) if isinstance(value, str) else value
    # watermarks need an instant; timestamp_ntz is read as UTC (session zone) and converted back
    ntz = dict(stream.dtypes)[ts] == "timestamp_ntz"
    s = stream.withColumn("_event_time", F.col(ts).cast("timestamp"))
    s = s.withWatermark("_event_time", lateness) if lateness is not None else s
    agg = (s.groupBy(bucket("_event_time", every).alias("time"), *by)
           .agg(F.avg(v).alias("value"), F.count(F.lit(1)).alias("rows")))
    return agg.withColumn("time", F.col("time").cast("timestamp_ntz")) if ntz else agg


def _matching(df: DataFrame, keyed: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows of ``df`` whose key is (left_semi) or is not (left_anti) in ``keyed``; NULL keys match."""
    other = keyed.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
    return df.join(other, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys], how)


def _effect_sets(rows: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str], chunk_seconds: int, lateness: str | None) -> DataFrame:
    """Streaming aggregate: all distinct rows (``ts``, ``values``) of each (keys, ``_chunk``), given out whenever one is added.

    Repeats change no set, sets merge in any order, and partial sets combine before the shuffle. With ``lateness`` the state of
    chunks behind the watermark is dropped, and rows later than that with it (Spark counts them); None keeps every
    chunk's state, so no row is too late."""
    packed = F.collect_set(F.struct(ts, *values)).alias("_rows")
    if lateness is None:
        return rows.groupBy(*keys, "_chunk").agg(packed)
    timed = rows.withColumn("_event_time", F.col(ts).cast("timestamp")).withWatermark("_event_time", lateness)
    sets = timed.groupBy(*keys, "_chunk", F.window("_event_time", f"{chunk_seconds} seconds")).agg(packed)
    return sets.drop("window")


def _chunk_parts(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> Snapshot:
    return Snapshot(spark, os.path.join(path, "parts"), keys, buckets)


@contextmanager
def _written_once(sets: DataFrame, path: str, run: str, batch_id: int) -> Iterator[DataFrame]:
    """The sets of a batch, written to a folder of the batch while its body runs: what reads them several times in one plan would
    run the stateful step again for each but one of the reads, which Spark does not find in a cache."""
    at = os.path.join(path, "touched")
    append_batch(sets, at, run, batch_id)
    folder = batch_folder(at, run, batch_id)
    try:
        yield sets.sparkSession.read.schema(sets.schema).parquet(folder)
    finally:
        Files(sets.sparkSession, folder).delete(folder)


def _replace_chunks(parts: Snapshot, sets: DataFrame, reduce: Callable[[DataFrame], DataFrame], run: str, batch_id: int) -> None:
    """Commit the parts that ``reduce`` makes of the touched (key, chunk) sets in place of their old ones."""
    on = [*parts.keys, "_chunk"]

    def merge(current: DataFrame | None, changed: DataFrame) -> DataFrame:
        fresh = reduce(changed.select(*on, F.explode("_rows").alias("_r")).select(*on, "_r.*"))
        return fresh if current is None else _matching(current, changed, on, "left_anti").unionByName(fresh)

    parts.update(sets, merge, run, batch_id)


def update_attempts_batch(sets: DataFrame, batch_id: int, snapshot: str, run: str, buckets: int = KEY_BUCKETS) -> None:
    """ST4 body: the touched chunks' effects become parts of attempts, and the attempts of their devices are merged anew
    from the stored parts (a few rows per device and chunk)."""
    with _written_once(sets, snapshot, run, batch_id) as sets:
        spark = sets.sparkSession
        parts = _chunk_parts(spark, snapshot, ["device_id"], buckets)
        _replace_chunks(parts, sets, attempt_parts, run, batch_id)

        def merge(current: DataFrame | None, changed: DataFrame) -> DataFrame:
            known = parts.read(parts.parts_of(changed))
            fresh = merge_attempts(_matching(known, changed, ["device_id"], "left_semi"))
            return fresh if current is None else _matching(current, changed, ["device_id"], "left_anti").unionByName(fresh)

        Snapshot(spark, snapshot, ["device_id"], buckets).update(sets.select("device_id").distinct(), merge, run, batch_id)


def update_attempts_stream(stream: DataFrame, snapshot: str, checkpoint: str | None = None, trigger: dict | None = None,
                           name: str = "update_attempts", buckets: int = KEY_BUCKETS, chunk_seconds: int = 86400,
                           lateness: str | None = None):
    """ST4: keep the attempt table current from a stream of OTA messages (device_id, kind, received_at, seq, payload).

    A late insert splits an attempt, so the state is the set of message effects per (device, chunk) in Spark's state store;
    ``chunk_seconds`` bounds one set. Repeated messages change nothing. ``lateness`` bounds the state (and what may
    still come); None accepts any. A lost checkpoint means a new ``snapshot`` folder and the messages from their start."""
    effects = message_effects(stream, "seq", chunk_seconds)
    sets = _effect_sets(effects, ["device_id"], "received_at", ["seq", *EFFECT], chunk_seconds, lateness)
    return _start(sets, lambda df, bid, run: update_attempts_batch(df, bid, snapshot, run, buckets), name, checkpoint, trigger, "update", STATE_ON_DISK)


def state_intervals_stream(stream: DataFrame, keys: Sequence[str], ts: str, state: str, tiebreak: str, snapshot: str, checkpoint: str | None = None,
                           trigger: dict | None = None, name: str = "state_intervals", buckets: int = KEY_BUCKETS, chunk_seconds: int = 86400,
                           lateness: str | None = None):
    """W7 as a stream: intervals per (key, chunk), made anew for the chunks that rows were added to (a late row of
    another state splits an interval); ``read_state_intervals`` joins them at the chunk borders."""
    rows = stream.select(*keys, ts, tiebreak, F.col(state).alias("_state"), time_chunk(ts, chunk_seconds).alias("_chunk"))
    sets = _effect_sets(rows, keys, ts, [tiebreak, "_state"], chunk_seconds, lateness)

    def body(df: DataFrame, bid: int, run: str) -> None:
        with _written_once(df, snapshot, run, bid) as sets:
            _replace_chunks(_chunk_parts(sets.sparkSession, snapshot, keys, buckets), sets, lambda r: chunk_intervals(r, keys, [ts, tiebreak]), run, bid)

    return _start(sets, body, name, checkpoint, trigger, "update", STATE_ON_DISK)


def read_state_intervals(spark: SparkSession, snapshot: str, keys: Sequence[str]) -> DataFrame:
    """W7 result of what the stream has committed."""
    return intervals_of(read_snapshot(spark, os.path.join(snapshot, "parts"), keys), keys)


def gap_segments_stream(stream: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, snapshot: str, max_gap: str = "10 minutes",
                        checkpoint: str | None = None, trigger: dict | None = None, name: str = "gap_segments", buckets: int = KEY_BUCKETS,
                        chunk_seconds: int = 86400):
    """W8 as a stream: a batch's own segments merge with the stored ones of their keys. A late row can join two
    segments but never split one, so segments are all the state; any lateness is exact."""

    def merge(current: DataFrame | None, new: DataFrame) -> DataFrame:
        both = new if current is None else current.drop("segment").unionByName(new)
        return join_segments(both, keys, max_gap)

    def body(df: DataFrame, bid: int, run: str) -> None:
        own = gap_segments(df, keys, ts, tiebreak, max_gap, chunk_seconds).drop("segment")
        Snapshot(df.sparkSession, snapshot, keys, buckets).update(own, merge, run, bid)

    return _start(stream, body, name, checkpoint, trigger)


def latest_batch(batch: DataFrame, batch_id: int, snapshot: str, keys: Sequence[str], order: Sequence[str], run: str,
                 buckets: int = KEY_BUCKETS) -> None:
    """ST5 body: merge the batch into the keyed snapshot, rewriting touched buckets only."""
    Snapshot(batch.sparkSession, snapshot, keys, buckets).update(
        batch, lambda cur, new: upsert_latest(cur, new, list(keys), list(order)), run, batch_id)


def latest_stream(stream: DataFrame, snapshot: str, keys: Sequence[str], order: Sequence[str],
                  checkpoint: str | None = None, trigger: dict | None = None, name: str = "latest", buckets: int = KEY_BUCKETS):
    """ST5: keep a latest-per-key snapshot current (configs, registry, retained topics).

    ``buckets``: more of them make the rewrites of a micro-batch smaller; fixed by the first commit."""
    return _start(stream, lambda df, bid, run: latest_batch(df, bid, snapshot, keys, order, run, buckets), name, checkpoint, trigger)


def bucket_avg_to_snapshot(agg: DataFrame, snapshot: str, keys: Sequence[str] = ("time",),
                           checkpoint: str | None = None, trigger: dict | None = None, name: str = "bucket_avg", buckets: int = KEY_BUCKETS):
    """ST2 sink: stream ``bucket_avg_stream`` output in update mode; each micro-batch's
    changed buckets replace the committed ones."""

    def replace(current: DataFrame | None, changed: DataFrame) -> DataFrame:
        return changed if current is None else _matching(current, changed, keys, "left_anti").unionByName(changed)

    def body(df: DataFrame, bid: int, run: str) -> None:
        Snapshot(df.sparkSession, snapshot, keys, buckets).update(df, replace, run, bid)

    return _start(agg, body, name, checkpoint, trigger, "update")


#: Decimal places that the exact sums of doubles keep; integers and decimals up to it are summed as they are.
SUM_SCALE = 9


def _partial_sums(rows: DataFrame, ts: str, value: str, every: str, by: Sequence[str]) -> DataFrame:
    """Sums that merge without error: an exact decimal sum, the sum of what no decimal holds (1e20 and more, infinite, NaN), counts."""
    v = F.col(value)
    odd = F.lit(False)
    if dict(rows.dtypes)[value] in ("double", "float"):
        odd = F.coalesce(F.abs(v) >= F.lit(1e20), F.lit(False))  # beyond the decimal, infinite or NaN (the greatest value)
    return rows.groupBy(bucket(ts, every).alias("time"), *by).agg(
        F.sum(F.when(~odd, v).cast(f"decimal(29,{SUM_SCALE})")).alias("total"), F.sum(F.when(odd, v.cast("double"))).alias("odd"),
        F.count(v).alias("n"), F.count(F.lit(1)).alias("rows"))


def bucket_avg_exact_batch(batch: DataFrame, batch_id: int, store: str, ts: str, value: str, every: str, run: str,
                           by: Sequence[str] = (), grain: str = "month", buckets: int = KEY_BUCKETS) -> None:
    """ST3 exact mode body: the batch's partial sums are added to the stored ones of the same buckets. Only partial sums of
    the touched periods (``grain``: "day" or "month") are read; rows are stored nowhere."""
    period = F.to_date("time") if grain == "day" else F.date_format("time", "yyyy-MM")

    def merge(current: DataFrame | None, new: DataFrame) -> DataFrame:
        both = new if current is None else current.unionByName(new)
        return both.groupBy("time", *by).agg(F.sum("total").cast(f"decimal(38,{SUM_SCALE})").alias("total"), F.sum("odd").alias("odd"),
                                             F.sum("n").alias("n"), F.sum("rows").alias("rows"))

    new = _partial_sums(batch, ts, value, every, by).withColumn("total", F.col("total").cast(f"decimal(38,{SUM_SCALE})"))
    Snapshot(batch.sparkSession, store, ["time", *by], buckets, period).update(new, merge, run, batch_id)


def read_bucket_avg(spark: SparkSession, store: str, by: Sequence[str] = ()) -> DataFrame:
    """ST3 result: time, ``by``, value (mean), rows of what the stream has committed."""
    total = F.when(F.col("n") > 0, F.coalesce(F.col("total").cast("double"), F.lit(0.0)) + F.coalesce("odd", F.lit(0.0)))
    return read_snapshot(spark, store, ["time", *by]).select("time", *by, (total / F.col("n")).alias("value"), "rows")


def bucket_avg_exact_stream(stream: DataFrame, store: str, ts: str, value: str, every: str, by: Sequence[str] = (), checkpoint: str | None = None,
                            trigger: dict | None = None, name: str = "bucket_avg_exact", grain: str = "month", buckets: int = KEY_BUCKETS):
    """ST3: bucket means that stay exact under unbounded lateness (``read_bucket_avg`` reads them)."""
    return _start(stream, lambda df, bid, run: bucket_avg_exact_batch(df, bid, store, ts, value, every, run, by, grain, buckets),
                  name, checkpoint, trigger)
