"""Refresh of the latest-row view from what changed in its source.

The source is a folder table with partition folders (``dt=...``) that are appended to, rewritten or deleted. Between the
rows and the view stands a table of the newest row per key and partition, so a changed partition is read and nothing
else of the source: its old rows in that table give way, and the keys that had or have a row in it get their newest
row from the table. A lost or rewritten row is forgotten, an older one takes its place.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetspark.operators.latest import latest_by
from fleetspark.streaming.store import KEY_BUCKETS, Files, Snapshot

_RUN = "refresh"


class LatestView:
    """Newest row of ``source`` per key by ``order`` (descending, as in W1), kept in ``path``."""

    def __init__(self, spark: SparkSession, source: str, path: str, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                 part: str = "dt", nulls: str = "first", buckets: int = KEY_BUCKETS):
        self.spark, self.source, self.path, self.part = spark, source, path, part
        self.keys, self.order, self.cols, self.nulls = list(keys), list(order), list(cols), nulls
        self.files = Files(spark, path)
        self.newest = Snapshot(spark, os.path.join(path, "newest"), [*keys, part], buckets, F.col(part))
        self.view = Snapshot(spark, os.path.join(path, "view"), keys, buckets)

    def _listing(self) -> dict[str, str]:
        """Partition value -> digest of its files' names, sizes and times."""
        found = Files(self.spark, self.source)
        return {name[len(self.part) + 1:]: hashlib.sha256(repr(found.details(os.path.join(self.source, name))).encode()).hexdigest()
                for name in found.names(self.source) if name.startswith(f"{self.part}=")}

    def _states(self) -> list[str]:
        return self.files.names(os.path.join(self.path, "seen"))

    def changed(self) -> tuple[dict[str, str], list[str]]:
        """The source's partitions now, and those that differ from the last refresh (new, other files, or gone)."""
        names = self._states()
        before = json.loads(self.files.read(os.path.join(self.path, "seen", names[-1]))) if names else {}
        now = self._listing()
        return now, sorted(p for p in {*now, *before} if now.get(p) != before.get(p))

    def changed_rows(self, now: dict[str, str], changed: Sequence[str]) -> DataFrame | None:
        """Newest row per key of the changed partitions that exist; the partition filter keeps the scan to them."""
        there = [p for p in changed if p in now]
        if not there:
            return None
        rows = self.spark.read.option("basePath", self.source).parquet(*[os.path.join(self.source, f"{self.part}={p}") for p in there])
        rows = rows.withColumn(self.part, F.col(self.part).cast("string"))
        return latest_by(rows, [*self.keys, self.part], self.order, list(dict.fromkeys([*self.order, *self.cols])), self.nulls)

    def refresh(self) -> list[str]:
        """Bring the view up to date; returns the partitions that had changed. A refresh that was cut short is done again in full."""
        now, changed = self.changed()
        if not changed:
            return []
        turn = len(self._states())
        keys = [*self.keys, self.part]
        old = self.newest.read_before(_RUN, turn, self.newest.parts_in(changed))
        new = self.changed_rows(now, changed)
        both = [df.select(*keys) for df in (old, new) if df is not None]
        if both:
            touched = both[0] if len(both) == 1 else both[0].unionByName(both[1])
            touched = touched.distinct().persist()
            try:
                self.newest.update(touched, lambda cur, keyed: new if new is not None else cur.limit(0), _RUN, turn)
                self.view.update(touched.select(*self.keys).distinct(), self._merge, _RUN, turn)
            finally:
                touched.unpersist()
        self.files.write(os.path.join(self.path, "seen", f"{turn:012d}.json"), json.dumps(now))
        return changed

    def _merge(self, current: DataFrame | None, touched: DataFrame) -> DataFrame:
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
        named = touched.select(*[F.col(k).alias(f"_{k}") for k in self.keys])
        fresh = latest_by(self.newest.read().join(named, same, "left_semi"), self.keys, self.order, list(dict.fromkeys([*self.order, *self.cols])), self.nulls)
        return fresh if current is None else current.join(named, same, "left_anti").unionByName(fresh)

    def read(self) -> DataFrame:
        return self.view.read().select(*self.keys, *self.cols)
