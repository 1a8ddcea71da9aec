"""Absence detection (AL2, AL3, AL4 "no data"): alerts that fire when nothing comes, by event-time timers.

A row arms a deadline for its key (``arm``: its time plus ``wait``), lifts it (``disarm``), or only shows that the key is alive
(``seen``: a sighting at or after the deadline lifts it). An alert fires once, when the watermark passes the deadline, also if no row of
the key ever comes again, and is cleared by the row that lifts or moves the deadline. The state of a key is the newest arming or
disarming, the newest sighting and whether it has fired: maxima, so rows may come in any order within ``lateness``.
Of rows with equal times a disarming one counts.

Spark calls Python once per group and batch, which costs far more than a few numbers do. So a group of the stream is not one key but
a hash bucket of keys (``groups`` of them), whose state is one array per number; the group's timer is its earliest running deadline.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fleetspark.streaming.ingest import _start
from fleetspark.streaming.store import KEY_BUCKETS, Snapshot

_NEVER = -(1 << 62)
ARM, DISARM, SEEN = "arm", "disarm", "seen"


#: Hash buckets of keys that share a state; a batch calls Python at most this often, whatever the number of keys.
GROUPS = 1024


class _Keys:
    """State of a bucket's keys: the newest arming or disarming as 2 * ms + (1: disarming), the newest sighting, whether it has fired."""

    def __init__(self, names: bytes = b"", sizes: bytes = b"", mark: bytes = b"", seen: bytes = b"", fired: bytes = b""):
        ends = np.cumsum(np.frombuffer(sizes, np.int32), dtype=np.int64).tolist()
        self.names = pd.Index([names[i:j].decode() for i, j in zip([0, *ends], ends)], dtype=object)
        self.mark, self.seen, self.fired = np.frombuffer(mark, np.int64), np.frombuffer(seen, np.int64), np.frombuffer(fired, bool)

    def packed(self) -> tuple[bytes, ...]:
        names = [x.encode() for x in self.names]
        return (b"".join(names), np.array([len(x) for x in names], np.int32).tobytes(), self.mark.tobytes(), self.seen.tobytes(), self.fired.tobytes())

    def add(self, rows: pd.DataFrame) -> None:
        new = pd.Index(rows["key"].unique(), dtype=object).difference(self.names, sort=False)
        self.names = self.names.append(new)
        more = np.full(len(new), _NEVER)
        self.mark, self.seen = np.concatenate([self.mark, 2 * more + 1]), np.concatenate([self.seen, more])
        self.fired = np.concatenate([self.fired, np.zeros(len(new), bool)])
        at, ms, kind = self.names.get_indexer(rows["key"]), rows["ms"].to_numpy(np.int64), rows["kind"].to_numpy()
        sighting = kind == SEEN
        np.maximum.at(self.seen, at[sighting], ms[sighting])
        np.maximum.at(self.mark, at[~sighting], 2 * ms[~sighting] + (kind[~sighting] != ARM))

    def decide(self, now: int, wait: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Deadlines, whether each runs, and whether it has passed at watermark ``now``."""
        deadline = (self.mark >> 1) + wait
        runs = (self.mark & 1 == 0) & (self.seen < deadline)
        return deadline, runs, runs & (deadline < now)


def absences(stream: DataFrame, key: str, ts: str, kind: Column, wait_ms: int, lateness: str, groups: int = GROUPS) -> DataFrame:
    """Stream of alert changes: ``key``, ``alert`` (true: fired, false: cleared), ``at`` (deadline that passed, or the watermark that saw the return).

    ``kind``: 'arm', 'disarm' or 'seen' per row. ``groups`` (fixed for a checkpoint) sizes the buckets of keys that share a state. Rows without a time are left out; rows later than ``lateness`` are dropped by Spark, which counts them."""
    name = F.col(key).cast("string")
    rows = stream.where(F.col(ts).isNotNull()).select(
        F.pmod(F.xxhash64(name), F.lit(groups)).alias("bucket"), F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("key"),  # empty: null
        kind.alias("kind"), F.unix_millis(F.col(ts).cast("timestamp")).alias("ms"),
        F.col(ts).cast("timestamp").alias("_event_time")).withWatermark("_event_time", lateness)

    def step(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = _Keys(*(bytes(x) for x in state.get)) if state.exists else _Keys()
        if not state.hasTimedOut:
            for rows in frames:
                held.add(rows)
        now = state.getCurrentWatermarkMs()
        deadline, runs, passed = held.decide(now, wait_ms)
        changed = np.flatnonzero(passed != held.fired)
        if len(changed):
            yield pd.DataFrame({"key": held.names[changed], "alert": passed[changed], "at": np.where(passed, deadline, now)[changed]})
        held.fired = passed
        state.update(held.packed())
        ahead = deadline[runs & ~passed]
        if len(ahead):
            state.setTimeoutTimestamp(max(int(ahead.min()), now))

    changes = rows.groupBy("bucket").applyInPandasWithState(
        step, "key string, alert boolean, at long", "names binary, sizes binary, mark binary, seen binary, fired binary", "update",
        GroupStateTimeout.EventTimeTimeout)
    back = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30))
    return changes.select(back.alias(key), "alert", F.timestamp_millis("at").cast("timestamp_ntz").alias("at"))


def absence_stream(stream: DataFrame, key: str, ts: str, kind: Column, wait_ms: int, lateness: str, snapshot: str, checkpoint: str | None = None,
                   trigger: dict | None = None, name: str = "absence", buckets: int = KEY_BUCKETS, groups: int = GROUPS):
    """Keep the table of standing alerts current (``read_alerts``)."""
    changes = absences(stream, key, ts, kind, wait_ms, lateness, groups)

    def merge(current: DataFrame | None, new: DataFrame) -> DataFrame:
        return new if current is None else current.join(new.select(key), key, "left_anti").unionByName(new)

    return _start(changes, lambda df, bid, run: Snapshot(df.sparkSession, snapshot, [key], buckets).update(df, merge, run, bid),
                  name, checkpoint, trigger, "update")


def read_alerts(spark: SparkSession, snapshot: str, key: str) -> DataFrame:
    """Keys whose alert stands, with the deadline that passed."""
    changes = Snapshot(spark, snapshot, [key]).read()
    if changes is None:  # no alert has changed yet
        return spark.createDataFrame([], f"{key} string, at timestamp_ntz")
    return changes.where("alert").select(key, "at")
