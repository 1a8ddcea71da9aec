"""Incremental refresh of the latest-row view equals the rebuild."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetspark.operators.latest import latest_by
from fleetspark.streaming.store import Files
from fleetspark.streaming.views import LatestView

T0 = datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp_ntz, i int, v int"


def _put(spark, source, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("dt", F.to_date("ts"))
    df.write.mode("append").partitionBy("dt").parquet(source)


def _rows(rnd, n, days, first=0):
    return [(rnd.choice(["a", "b", "c", None]), T0 + timedelta(days=rnd.choice(days), minutes=rnd.randint(0, 1400)), first + i, rnd.choice([1, 2, None])) for i in range(n)]


def test_refresh_equals_rebuild_and_reads_changed_partitions(spark, scratch, monkeypatch):
    rnd, source = random.Random(1), os.path.join(scratch, "source")
    view = LatestView(spark, source, os.path.join(scratch, "view"), ["k"], ["ts", "i"], ["ts", "v"], buckets=2)

    def check():
        want = latest_by(spark.read.parquet(source), ["k"], ["ts", "i"], ["ts", "v"])
        assert sorted(map(tuple, view.read().collect()), key=str) == sorted(map(tuple, want.collect()), key=str)

    _put(spark, source, _rows(rnd, 60, range(6)))
    assert len(view.refresh()) == 6 and view.refresh() == []
    check()
    _put(spark, source, _rows(rnd, 10, [1, 4], 100))  # late rows of two days
    now, changed = view.changed()
    assert changed == ["2024-01-02", "2024-01-05"]
    scanned = view.changed_rows(now, changed).inputFiles()
    assert scanned and all(any(f"dt={d}" in f for d in changed) for f in scanned)
    view.refresh()
    check()
    Files(spark, source).delete(os.path.join(source, "dt=2024-01-06"))  # the newest day goes: older rows take over
    with monkeypatch.context() as m:  # and the refresh is cut short between its two tables
        m.setattr(view.view, "update", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            view.refresh()
    assert view.refresh() == ["2024-01-06"]
    check()
    spark.createDataFrame([("z", T0, 1, 5)], SCHEMA).write.mode("overwrite").parquet(os.path.join(source, "dt=2024-01-05"))  # a day is rewritten
    assert view.refresh() == ["2024-01-05"]
    check()
