"""Shared plumbing of the operators: table access, Arrow passes, shared tables."""

from __future__ import annotations

import ctypes
import hashlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetspark.session import checkpoint_dir

#: Text bytes that one step of an Arrow pass holds at a time (a longer text is a step of its own).
CHUNK_BYTES = 1 << 20
#: Bytes that Spark hands a Python worker at a time, if the session allows more.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(col: str) -> Column:
    """The text as bytes; null becomes empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, mod ``divisor`` (null ids: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def chunks(batches: Iterator[pa.RecordBatch], size_col: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Split Arrow batches so that the binary column holds at most ``limit`` bytes per piece."""
    for batch in batches:
        start = held = 0
        sizes = pc.binary_length(batch.column(size_col)).to_pylist()
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def ship_code(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application (as ``--py-files`` would): they need not
    share the driver's folder or path."""
    sc, root = spark.sparkContext, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if getattr(sc, "_ships", None) == root or not os.path.isdir(root):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="code-"), f"{os.path.basename(root)}-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)  # executors fetch it from the driver
    sc._ships = root


def _give_back() -> None:
    """Return a finished task's free memory to the system: Python workers live on, also those of earlier stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` whose workers can import this package and get bounded batches (by default Spark's hold 10,000
    rows, up to 64 MB, on both sides)."""
    conf, limit = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = conf.get(limit, "67108864").lower().rstrip("b")
    if now.isdigit() and int(now) > BATCH_BYTES:  # a size in other units was set by hand
        conf.set(limit, str(BATCH_BYTES))
    ship_code(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return df.mapInArrow(task, schema)


def map_texts(df: DataFrame, step: Callable[[pa.RecordBatch], dict | None], schema: str, text_col: str = "raw",
              limit: int = CHUNK_BYTES) -> DataFrame:
    """Arrow pass: ``step`` gets bounded batches and returns the columns of ``schema`` as lists or arrays."""

    def run(batches):
        for part in chunks(batches, text_col, limit):
            out = step(part)
            if out is not None:
                yield pa.RecordBatch.from_pydict(out)

    return map_arrow(df, run, schema)


def shared_table(spark: SparkSession, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the folder that all executors share and read it back (cuts lineage)."""
    path = f"{checkpoint_dir(spark)}/fleetspark-llm/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, draw: Column, size: int, total: int) -> DataFrame:
    """About ``size`` of ``total`` rows (all if there are no more), those with the lowest hashes, and at most twice as many."""
    bar = int(min(1.0, size / max(1, total)) * (1 << 32)) - 1
    return df.where(draw.bitwiseAND(F.lit((1 << 32) - 1)) <= F.lit(bar)).limit(2 * size)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
