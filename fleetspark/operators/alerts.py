"""Alert rules (AL1-AL5) as plain table jobs; thresholds are arguments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetspark.functions.predicates import ACTIVE_UPDATE_STATUSES
from fleetspark.functions.util import interval, lit_of
from fleetspark.operators.latest import latest_by, order_key


def alert_failure_rate(updates: DataFrame, threshold: float = 0.05, by: str = "firmware_version") -> DataFrame:
    """AL1: failure rate over finished attempts (success/failed) per ``by``."""
    fin = updates.where(F.col("status").isin("success", "failed"))
    g = fin.groupBy(by).agg(F.count(F.lit(1)).alias("finished"),
                            F.count_if(F.col("status") == "failed").alias("failed"))
    return (g.withColumn("failure_rate", F.col("failed") / F.col("finished"))
            .withColumn("alert", F.col("failure_rate") > F.lit(threshold)))


def alert_offline_after_update(devices: DataFrame, updates: DataFrame, as_of, silence: str = "24 hours") -> DataFrame:
    """AL2: devices not seen within ``silence`` after their newest successful update,
    once that much time has passed."""
    ok = updates.where((F.col("status") == "success") & F.col("completed_at").isNotNull())
    last = ok.groupBy("device_id").agg(F.max("completed_at").alias("updated_at"))
    j = devices.select("device_id", "last_seen").join(last, "device_id", "inner")
    deadline = F.col("updated_at") + interval(silence)
    return j.where((lit_of(as_of) > deadline) & (F.col("last_seen").isNull() | (F.col("last_seen") < deadline))) \
        .select("device_id", "updated_at", "last_seen")


def alert_stuck(updates: DataFrame, as_of, stuck_for: str = "6 hours") -> DataFrame:
    """AL3: a device's newest attempt is still in progress and was last reported
    more than ``stuck_for`` before as_of."""
    last = latest_by(updates, ["device_id"], ["started_at", "id"],
                     ["id", "firmware_version", "status", "reported_at"], nulls="first")
    return last.where(F.col("status").isin(*ACTIVE_UPDATE_STATUSES)
                      & (F.col("reported_at") < lit_of(as_of) - interval(stuck_for)))


def alert_power(power: DataFrame, as_of, order=("ts", "l_orderkey", "l_linenumber"), key: str = "device_sn",
                low_soc: int = 20, high_out: int = 3000, silent: str = "5 minutes", low_remain: int = 30,
                high_temp: float = 40.0) -> DataFrame:
    """AL4/AL5: rules on each device's newest row, one output row per firing rule."""
    ok = order_key(list(order), "last")
    last = power.groupBy(key).agg(
        F.max_by(F.struct("soc_percent", "watts_out_sum", "remain_time_min", "bms_temp", "inv_out_temp"), ok)
        .alias("r"), F.max("ts").alias("last_ts"))
    rules = [
        ("battery_low", F.col("r.soc_percent") < low_soc),
        ("output_high", F.col("r.watts_out_sum") > high_out),
        ("no_data", F.col("last_ts") < lit_of(as_of) - interval(silent)),
        ("remaining_low", F.col("r.remain_time_min") < low_remain),
        ("temperature_high", F.greatest(F.col("r.bms_temp"), F.col("r.inv_out_temp")) > high_temp),
    ]
    flags = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules])
    return (last.select(key, F.explode(flags).alias("alert")).where(F.col("alert").isNotNull()))
