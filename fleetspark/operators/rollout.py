"""Firmware rollout operators.

The per-request update check is evaluated for the whole fleet in one job: the
newest release per model and its newest active rollout form one lookup by model,
which is broadcast while its measured size is small, so the fleet is not
shuffled by model; device lists are a table that is joined by device.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.functions.hashing import hash_bucket, percentage_match
from fleetspark.functions.util import col_of, with_parsed
from fleetspark.operators.fleet import latest_release
from fleetspark.operators.joins import join_lookup

FILTER_SCHEMA = "struct<device_ids:array<string>>"


def eligible(device_id, target_type, target_filter, percentage) -> Column:
    """R2: all/canary/group -> percentage match; specific -> id in the filter list;
    a missing or unreadable filter or an unknown type -> false."""
    tt = col_of(target_type)
    ids = F.from_json(col_of(target_filter), FILTER_SCHEMA).getField("device_ids")
    return (F.when(tt.isin("all", "canary", "group"),
                   F.coalesce(percentage_match(device_id, col_of(percentage)), F.lit(False)))
            .when(tt == "specific", F.coalesce(F.array_contains(ids, col_of(device_id)), F.lit(False)))
            .otherwise(F.lit(False)))


def device_buckets(devices: DataFrame, key: str = "device_id", pct: int = 50) -> DataFrame:
    """Stable bucket per device and its selection at ``pct`` %."""
    return devices.select(key, hash_bucket(F.col(key)).alias("bucket"),
                          percentage_match(F.col(key), pct).alias("selected"))


def rollout_coverage(devices: DataFrame, pcts: Sequence[int] = (0, 10, 25, 50, 75, 90, 100),
                     key: str = "device_id") -> DataFrame:
    """Share of the fleet selected at each percentage.

    One pass reduces the fleet to a 100-row bucket histogram (partial
    aggregation), then each percentage sums the buckets below it.
    """
    hist = devices.groupBy(hash_bucket(F.col(key)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    p = F.explode(F.array(*[F.lit(int(x)) for x in pcts])).alias("percentage")
    expanded = hist.select("bucket", "n", p)
    sel = F.when(F.col("percentage") >= 100, True).when(F.col("percentage") <= 0, False) \
        .otherwise(F.col("bucket") < F.col("percentage"))
    return (expanded.groupBy("percentage")
            .agg(F.sum(F.when(sel, F.col("n")).otherwise(0)).alias("selected"), F.sum("n").alias("total"))
            .withColumn("share", F.col("selected") / F.col("total")))


def latest_active_rollout(rollouts: DataFrame) -> DataFrame:
    """Newest active rollout per (model, version) by created_at (tiebreak name)."""
    act = rollouts.where(F.col("is_active"))
    return (act.groupBy("device_model", F.col("firmware_version").alias("latest_version"))
            .agg(F.max_by(F.struct("target_type", "target_filter", "rollout_percentage", "name"),
                          F.struct("created_at", "name")).alias("_r"))
            .select("device_model", "latest_version", F.col("_r.target_type").alias("target_type"),
                    F.col("_r.target_filter").alias("target_filter"),
                    F.col("_r.rollout_percentage").alias("rollout_percentage"),
                    F.col("_r.name").alias("rollout_name")))


def update_decisions(devices: DataFrame, releases: DataFrame, rollouts: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """Update decision per device with a reason.

    no_release -> up_to_date -> no_rollout -> not_eligible -> update, in the
    order the update check applies them. ``targets`` (rollout_name, device_id) holds the
    device lists of 'specific' rollouts; without it they are read from ``target_filter``.
    """
    lookup = latest_release(releases).join(latest_active_rollout(rollouts), ["device_model", "latest_version"], "left")
    d = devices.select("device_id", "device_model", F.col("current_firmware_version").alias("current_version"))
    d = with_parsed(d, _bucket=hash_bucket(F.col("device_id")))
    j = join_lookup(d, lookup, "device_model")
    if targets is not None:
        t = targets.select(F.col("rollout_name").alias("_name"), F.col("device_id").alias("_id")).distinct().withColumn("_listed", F.lit(True))
        j = j.join(t, (F.col("target_type") == "specific") & (F.col("rollout_name") == F.col("_name")) & (F.col("device_id") == F.col("_id")), "left")
        listed = F.col("_listed")
    else:
        listed = F.array_contains(F.from_json("target_filter", FILTER_SCHEMA).getField("device_ids"), F.col("device_id"))
    p = F.col("rollout_percentage")
    share = F.when(p >= 100, True).when(p <= 0, False).otherwise(F.col("_bucket") < p)
    elig = (F.when(F.col("device_id").isNull(), F.lit(False)).when(F.col("target_type").isin("all", "canary", "group"), share)
            .when(F.col("target_type") == "specific", listed))
    reason = (F.when(F.col("latest_version").isNull(), "no_release")
              .when(F.col("latest_version") == F.col("current_version"), "up_to_date")
              .when(F.col("target_type").isNull(), "no_rollout")
              .when(~F.coalesce(elig, F.lit(False)), "not_eligible").otherwise("update"))
    return j.select("device_id", "device_model", "current_version", "latest_version",
                    (reason == "update").alias("update_available"), reason.alias("reason"))


def decision_events(decisions: DataFrame) -> DataFrame:
    """S8 (check path): an ``update_started`` audit event per device offered an update."""
    return decisions.where(F.col("update_available")).select(
        F.lit("update_started").alias("event_type"), "device_id",
        F.col("latest_version").alias("firmware_version"),
        F.to_json(F.struct(F.col("current_version").alias("from_version"))).alias("event_data"))
