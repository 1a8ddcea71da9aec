"""Table upkeep: upserts, quality rules, migration, retention."""

from __future__ import annotations

import datetime
import re
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from fleetspark.functions.util import interval, lit_of
from fleetspark.operators.latest import latest_by
from fleetspark.operators.updates import UPDATE_STATUSES
from fleetspark.streaming.store import Files

# Allowed enumerations of the rollout and audit tables.
TARGET_TYPES = ("all", "group", "canary", "specific")
EVENT_TYPES = ("update_check", "update_started", "update_completed", "update_failed", "rollback",
               "firmware_uploaded", "rollout_created")


def upsert_latest(target: DataFrame | None, updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keyed snapshot after applying ``updates`` (whole-row replace, newest wins).

    The union of the current snapshot and the updates is reduced with a
    ``max_by`` per key (map-side combined); write the result as a new snapshot.
    """
    src = updates if target is None else target.unionByName(updates, allowMissingColumns=True)
    cols = [c for c in src.columns if c not in keys]
    return latest_by(src, list(keys), list(order), cols, nulls="last")


def upsert_devices(registry: DataFrame | None, seen: DataFrame, mode: str = "status", late: bool = False) -> DataFrame:
    """Device registry after a batch of sightings.

    ``seen``: device_id, device_model, firmware_version, seen_at (+ tiebreak ``seq``).
    mode 'status' overwrites model, firmware (even with NULL) and last_seen; a status
    without a model (absent, null or empty) does not touch the registry;
    mode 'check' overwrites firmware and last_seen but keeps the first model.
    created_at is the first sighting and is never overwritten. With ``late`` (streams) the
    sightings may be older than the registry: the newest one by time counts, whenever it came.
    """
    if mode == "status":
        seen = seen.where(F.length("device_model") > 0)
    order = F.struct("seen_at", "seq")
    first = F.struct(F.col("seen_at"), F.col("seq"))
    agg = seen.groupBy("device_id").agg(
        F.max_by(F.struct("device_model", "firmware_version"), order).alias("_last"),
        F.min_by("device_model", first).alias("_first_model"),
        F.max("seen_at").alias("_seen"), F.min("seen_at").alias("_created"))
    fresh = agg.select(
        "device_id",
        (F.col("_last.device_model") if mode == "status" else F.col("_first_model")).alias("device_model"),
        F.col("_last.firmware_version").alias("current_firmware_version"),
        F.col("_seen").alias("last_seen"), F.col("_created").alias("created_at"))
    if registry is None:
        return fresh
    r = registry.select("device_id", "device_model", "current_firmware_version", "last_seen", "created_at") \
        .withColumn("_in_registry", F.lit(True))
    j = r.alias("r").join(fresh.alias("f"), "device_id", "full")
    seen_now = F.col("f.last_seen").isNotNull()
    if late:
        seen_now = seen_now & F.coalesce(F.col("f.last_seen") >= F.col("r.last_seen"), F.lit(True))
    known = F.coalesce(F.col("_in_registry"), F.lit(False))
    if mode == "status":
        model = F.when(seen_now, F.col("f.device_model")).otherwise(F.col("r.device_model"))
    else:
        model = F.when(known, F.col("r.device_model")).otherwise(F.col("f.device_model"))
    return j.select(
        "device_id", model.alias("device_model"),
        F.when(seen_now, F.col("f.current_firmware_version")).otherwise(F.col("r.current_firmware_version"))
        .alias("current_firmware_version"),
        F.greatest(F.col("r.last_seen"), F.col("f.last_seen")).alias("last_seen"),
        (F.least("r.created_at", "f.created_at") if late else F.when(known, F.col("r.created_at")).otherwise(F.col("f.created_at")))
        .alias("created_at"))


def check_update_rows(updates: DataFrame) -> DataFrame:
    """P20: CHECK rules as violation counts (status enum, progress range)."""
    return updates.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("status").isin(*UPDATE_STATUSES)).alias("bad_status"),
        F.count_if(~F.coalesce(F.col("progress_percent").between(0, 100), F.lit(True))).alias("bad_progress"),
        F.count_if(F.col("firmware_version").isNull()).alias("missing_version"))


def check_rollout_rows(rollouts: DataFrame) -> DataFrame:
    """P20: rollout CHECK rules (target type enum, percentage 0..100)."""
    return rollouts.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("target_type").isin(*TARGET_TYPES)).alias("bad_target_type"),
        F.count_if(~F.coalesce(F.col("rollout_percentage").between(0, 100), F.lit(True))).alias("bad_percentage"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def migrate_flat(df: DataFrame, site: str, system: str, value_cols: Sequence[str],
                 device: str = "sensor_id", ts: str = "ts") -> DataFrame:
    """M1: wide sensor rows -> (site, system, device, ts, metrics JSON) with NULL
    fields stripped (``to_json`` omits NULL struct fields)."""
    return df.select(F.lit(site).alias("site_id"), F.lit(system).alias("system"),
                     F.col(device).alias("device_id"), F.col(ts).alias("ts"),
                     F.to_json(F.struct(*[F.col(c) for c in value_cols])).alias("metrics"))


def retain(df: DataFrame, as_of, days: int = 90, ts: str = "ts") -> DataFrame:
    """M2: rows younger than ``days``; ``drop_old_days`` removes the rest from a table."""
    return df.where(F.col(ts) >= lit_of(as_of) - interval(f"{days} days"))


def drop_old_days(spark: SparkSession, path: str, as_of: datetime.date, days: int) -> list[str]:
    """M2: delete the ``dt=`` folders of a day-partitioned table that lie wholly before ``as_of - days``."""
    files, gone = Files(spark, path), []
    for name in files.names(path):
        day = re.fullmatch(r"dt=(\d{4}-\d{2}-\d{2})", name)
        if day and datetime.date.fromisoformat(day[1]) < as_of - datetime.timedelta(days=days):
            files.delete(f"{path.rstrip('/')}/{name}")
            gone.append(name)
    return gone


def align_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """M3: add missing (nullable) columns and order as ``schema``; extra columns kept last."""
    out = df
    for f in schema.fields:
        if f.name not in out.columns:
            out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
        else:
            out = out.withColumn(f.name, F.col(f.name).cast(f.dataType))
    names = [f.name for f in schema.fields]
    return out.select(*names, *[c for c in out.columns if c not in names])


def export_snapshot(df: DataFrame, base: str, as_of_date: str, keep_days: int | None = None) -> str:
    """Write a dated snapshot ``base/dt=YYYY-MM-DD`` (overwrite that date only); with
    ``keep_days`` older dates are removed once it is written."""
    path = f"{base.rstrip('/')}/dt={as_of_date}"
    df.write.mode("overwrite").parquet(path)
    if keep_days is not None:
        drop_old_days(df.sparkSession, base, datetime.date.fromisoformat(as_of_date), keep_days)
    return path


def export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Export a result as CSV (with header) or JSON lines."""
    w = df.write.mode("overwrite")
    (w.option("header", True).csv(path) if fmt == "csv" else w.json(path))
