"""Folder tables that survive a lost executor or driver in the middle of a write.

``append_batch`` keys a micro-batch's folder by the stream's run and the batch
id: a replay overwrites its own folder, and a stream that starts again with a
fresh checkpoint is another run.

``Snapshot`` is a keyed table in hash buckets. A commit writes the touched
buckets to a folder of its own and then a manifest that names, for every
bucket, the folder that holds it. Nothing that a manifest names is changed, so
a crash before the manifest leaves the table as it was. A batch that is
committed already is not written again.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Buckets of a new snapshot; each snapshot's manifest keeps its own number.
KEY_BUCKETS = 64
#: Commits that stay readable.
KEEP_COMMITS = 2


class Files:
    """The file system that holds a path, through Spark's own client."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names inside a folder; an absent folder has none, any other error is raised."""
        if not self.exists(path):
            return []
        return sorted(x.getPath().getName() for x in self._fs.listStatus(self._path(path)))

    def details(self, path: str) -> list[tuple[str, int, int]]:
        """Name, size and modification time of what a folder holds."""
        return sorted((x.getPath().getName(), x.getLen(), x.getModificationTime()) for x in self._fs.listStatus(self._path(path)))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(self._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """A new file that appears whole or not at all; an existing one is never touched."""
        draft = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.{uuid.uuid4().hex}")
        stream = self._fs.create(self._path(draft), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.exists(path) or not self._fs.rename(self._path(draft), self._path(path)):
            raise OSError(f"cannot write {path}")

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """Identity of the stream run that owns a checkpoint folder; made with the folder."""
    files, path = Files(spark, checkpoint), os.path.join(checkpoint, "run_id")
    if not files.exists(path):
        files.write(path, uuid.uuid4().hex)
    return files.read(path)


def batch_folder(path: str, run: str, batch_id: int) -> str:
    return os.path.join(path, f"run_id={run}", f"batch_id={batch_id}")


def append_batch(df: DataFrame, path: str, run: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write one micro-batch under ``run_id=R/batch_id=N``; a replay overwrites the same folder."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(batch_folder(path, run, batch_id))


def key_bucket(*cols: str, n: int = KEY_BUCKETS) -> Column:
    """Stable hash bucket of a key."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(n)).cast("int")


class Snapshot:
    """Keyed table whose commits rewrite only the parts they touch.

    A part is a hash bucket of the keys, or with ``period`` (a column of the keys, such as a day) a bucket of one
    period, so that a batch reads and writes the periods it brings rows for and no others."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = KEY_BUCKETS, period: Column | None = None):
        self.spark, self.path, self.keys, self.files, self.period = spark, path, list(keys), Files(spark, path), period
        last = self._last()
        self.buckets = last["buckets"] if last else buckets

    def _commits(self) -> list[str]:
        return [n for n in self.files.names(os.path.join(self.path, "commits")) if n.endswith(".json") and not n.startswith(".")]

    def _manifest(self, name: str) -> dict:
        return json.loads(self.files.read(os.path.join(self.path, "commits", name)))

    def _last(self) -> dict | None:
        names = self._commits()
        return self._manifest(names[-1]) if names else None

    def with_part(self, df: DataFrame) -> DataFrame:
        kb = key_bucket(*self.keys, n=self.buckets).cast("string")
        if self.period is not None:
            kb = F.concat(F.coalesce(self.period.cast("string"), F.lit("none")), F.lit("_"), kb)
        return df.withColumn("kb", kb)

    def parts_of(self, df: DataFrame) -> list[str]:
        """Names of the parts that hold the keys of ``df``: at most ``buckets`` for each period in it."""
        return [r.kb for r in self.with_part(df).select("kb").distinct().collect()]

    def parts_in(self, periods: Sequence[str]) -> list[str]:
        """Names of all parts of some periods, whatever they hold."""
        wanted = set(periods)
        return [f"{p}_{b}" for p in wanted for b in range(self.buckets)]

    def _read(self, manifest: dict | None, parts: Sequence[str] | None = None) -> DataFrame | None:
        if manifest is None:
            return None
        data = os.path.join(self.path, "data")
        wanted = manifest["parts"] if parts is None else {k: manifest["parts"][k] for k in parts if k in manifest["parts"]}
        paths = [os.path.join(data, f"commit={c}", f"kb={k}") for k, c in wanted.items()]
        return self.spark.read.option("basePath", data).parquet(*paths).drop("commit", "kb") if paths else None

    def read(self, parts: Sequence[str] | None = None) -> DataFrame | None:
        """The table (or some parts) as of the last commit, or None where nothing is committed."""
        return self._read(self._last(), parts)

    def read_before(self, run: str, batch_id: int, parts: Sequence[str] | None = None) -> DataFrame | None:
        """The table as a batch finds it: without the batch's own commit, if a replay comes after it."""
        names = self._commits()
        if names and self._is(self._manifest(names[-1]), run, batch_id):
            names.pop()
        return self._read(self._manifest(names[-1]), parts) if names else None

    @staticmethod
    def _is(manifest: dict, run: str, batch_id: int) -> bool:
        return (manifest["run"], manifest["batch"]) == (run, batch_id)

    def update(self, changed: DataFrame, merge, run: str, batch_id: int) -> None:
        """Commit ``merge(current rows of the touched parts or None, changed)``.

        ``changed`` and the merged rows hold the keys; parts without a changed key stay as they are. The last commit
        is not repeated: nothing that a manifest names is ever written again."""
        names = self._commits()
        base = self._manifest(names[-1]) if names else None
        if base and self._is(base, run, batch_id):
            return
        changed = self.with_part(changed).persist()
        try:
            touched = [r.kb for r in changed.select("kb").distinct().collect()]
            if not touched:
                return
            commit = f"{int(names[-1].split('.')[0]) + 1 if names else 0:012d}"
            merged = self.with_part(merge(self._read(base, touched), changed.drop("kb")))
            out = os.path.join(self.path, "data", f"commit={commit}")
            merged.repartition("kb").write.mode("overwrite").partitionBy("kb").parquet(out)
            parts = {k: c for k, c in base["parts"].items() if k not in touched} if base else {}
            for n in self.files.names(out):
                if n.startswith("kb="):
                    parts[n[3:]] = commit
            self.files.write(os.path.join(self.path, "commits", f"{commit}.json"),
                             json.dumps({"run": run, "batch": batch_id, "buckets": self.buckets, "parts": parts}))
            self._clean()
        finally:
            changed.unpersist()

    def _clean(self) -> None:
        """Drop what none of the last commits names."""
        names = self._commits()
        kept = [self._manifest(n) for n in names[-KEEP_COMMITS:]]
        for n in names[:-KEEP_COMMITS]:
            self.files.delete(os.path.join(self.path, "commits", n))
        named = {(c, k) for m in kept for k, c in m["parts"].items()}
        data, last = os.path.join(self.path, "data"), names[-1].split(".")[0]
        for folder in self.files.names(data):
            commit = folder.removeprefix("commit=")
            if folder == commit or commit >= last:
                continue
            inside = [n for n in self.files.names(os.path.join(data, folder)) if n.startswith("kb=")]
            gone = [n for n in inside if (commit, n[3:]) not in named]
            if len(gone) == len(inside):
                self.files.delete(os.path.join(data, folder))
            else:
                for n in gone:
                    self.files.delete(os.path.join(data, folder, n))


def read_snapshot(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Rows of a snapshot; raises if nothing was committed."""
    df = Snapshot(spark, path, keys).read()
    if df is None:
        raise FileNotFoundError(f"no commit in {path}")
    return df
