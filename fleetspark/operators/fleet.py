"""Fleet statistics, overview joins and list views.

Joins are equi-joins on device_id between per-device aggregates (one row per
device, already hash-partitioned by the aggregation) and the device registry;
release lookups are bounded by models x versions; AQE broadcasts them when their
measured size is small. Top-k views end in ``orderBy(...).limit(n)`` (TakeOrderedAndProject:
per-partition top-k, then a merge of n rows per task).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.functions.formats import fmt_age, fmt_uptime, status_label
from fleetspark.functions.predicates import ACTIVE_UPDATE_STATUSES, online_state, trailing
from fleetspark.functions.util import col_of, lit_of, seconds_between
from fleetspark.operators.joins import join_lookup
from fleetspark.operators.latest import latest_by


# ---------------------------------------------------------------- aggregates

def power_stats(power: DataFrame, as_of, span: str = "1 hour", by: Sequence[str] = ("device_sn",)) -> DataFrame:
    """A10: rounded mean and max of output/input over the trailing span (``>=``)."""
    src = power.where(trailing("ts", as_of, span, inclusive=True))
    o, i = F.coalesce("watts_out_sum", F.lit(0)), F.coalesce("watts_in_sum", F.lit(0))
    return src.groupBy(*by).agg(F.round(F.avg(o)).alias("avg_output"), F.max(o).alias("peak_output"),
                                F.round(F.avg(i)).alias("avg_input"), F.max(i).alias("peak_input"))


def update_timeline(updates: DataFrame, as_of, span: str = "30 days") -> DataFrame:
    """Daily counts over ``span``, grouped on the raw status then labelled (X-3)."""
    src = updates.where(trailing("started_at", as_of, span))
    g = src.groupBy(F.date_trunc("day", "started_at").cast("timestamp_ntz").alias("time"), "status") \
        .agg(F.count(F.lit(1)).alias("count"))
    return g.select("time", status_label("status", "timeline").alias("status"), "count")


def update_activity_hourly(updates: DataFrame, as_of, span: str = "7 days") -> DataFrame:
    """Hourly counts by status over ``span`` (by reported_at)."""
    src = updates.where(trailing("reported_at", as_of, span))
    return src.groupBy(F.date_trunc("hour", "reported_at").cast("timestamp_ntz").alias("hour"), "status") \
        .agg(F.count(F.lit(1)).alias("count"))


def count_by(df: DataFrame, col: str, where: Column | None = None, name: str = "count") -> DataFrame:
    """``SELECT col, COUNT(*) ... GROUP BY col``."""
    src = df.where(where) if where is not None else df
    return src.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def fleet_counts(devices: DataFrame, updates: DataFrame, status: DataFrame, rollouts: DataFrame,
                 devices_as_of, status_as_of, online_span: str = "5 minutes",
                 status_span: str = "1 hour") -> DataFrame:
    """Scalar fleet counters as one row; each counter is one pass over its table,
    attached as a scalar subquery (no join)."""
    d = devices.agg(F.count(F.lit(1)).alias("n"),
                    F.count_if(trailing("last_seen", devices_as_of, online_span)).alias("on"))
    active = updates.agg(F.count_if(F.col("status").isin(*ACTIVE_UPDATE_STATUSES))).scalar()
    recent = status.agg(F.count_if(trailing("ts", status_as_of, status_span))).scalar()
    act_roll = rollouts.agg(F.count_if(F.col("is_active"))).scalar()
    return d.select(F.col("n").alias("total_devices"), F.col("on").alias("online_devices"),
                    active.alias("active_updates"), recent.alias("status_messages_recent"),
                    act_roll.alias("active_rollouts"))


def profile(df: DataFrame, ts: str, device: str, exact: bool = True) -> DataFrame:
    """Rows, first/last time and distinct devices."""
    nd = F.count_distinct(device) if exact else F.approx_count_distinct(device)
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.min(ts).alias("first_ts"),
                  F.max(ts).alias("last_ts"), nd.alias("devices"))


def non_null_counts(df: DataFrame, cols: dict, total_label: str = "Total measurements") -> DataFrame:
    """Filled-row count per field and the total, in one pass, long form."""
    aggs = [F.count(col_of(c)).alias(f"_c{i}") for i, c in enumerate(cols.values())]
    wide = df.agg(*aggs, F.count(F.lit(1)).alias("_total"))
    items = [F.struct(F.lit(lbl).alias("field"), F.col(f"_c{i}").alias("count"))
             for i, lbl in enumerate(cols.keys())]
    items.append(F.struct(F.lit(total_label).alias("field"), F.col("_total").alias("count")))
    return wide.select(F.explode(F.array(*items)).alias("s")).select("s.field", "s.count")


def field_summary(df: DataFrame, cols: Sequence[str], as_of, span: str = "24 hours") -> DataFrame:
    """records/min/max/avg per field over the trailing span, long form."""
    src = df.where(trailing("ts", as_of, span))
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"_n{i}"), F.min(x).alias(f"_mi{i}"), F.max(x).alias(f"_ma{i}"),
                 F.avg(x).alias(f"_a{i}")]
    wide = src.agg(*aggs)
    items = [F.struct(F.lit(c).alias("field"), F.col(f"_n{i}").alias("records"), F.col(f"_mi{i}").alias("min_value"),
                      F.col(f"_ma{i}").alias("max_value"), F.col(f"_a{i}").alias("avg_value"))
             for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*items)).alias("s")).select("s.*")


def avg_by_location(df: DataFrame, value, as_of, span: str = "1 hour", where: Column | None = None) -> DataFrame:
    """Mean and count by location over the trailing span, ordered by mean desc."""
    src = df.where(trailing("ts", as_of, span))
    if where is not None:
        src = src.where(where)
    return (src.groupBy("location").agg(F.avg(col_of(value)).alias("avg_value"), F.count(F.lit(1)).alias("readings"))
            .orderBy(F.col("avg_value").desc_nulls_last(), F.col("location").asc_nulls_last()))


def device_online(df: DataFrame, key: str, as_of, span: str = "5 minutes") -> DataFrame:
    """1 when the device's newest row is within ``span`` of as_of, else 0."""
    return df.groupBy(key).agg(F.when(F.max("ts") > lit_of(as_of) - F.expr(f"INTERVAL '{span}'"), 1)
                               .otherwise(0).alias("online"))


def latest_release(releases: DataFrame) -> DataFrame:
    """Newest release version per model (by created_at, tiebreak version, X-13)."""
    return releases.groupBy("device_model").agg(
        F.max_by("version", F.struct("created_at", "version")).alias("latest_version"))


def up_to_date_count(devices: DataFrame, releases: DataFrame) -> DataFrame:
    """Devices whose firmware equals the newest release of their model."""
    j = join_lookup(devices, latest_release(releases), "device_model")
    return j.agg(F.count_if(F.col("current_firmware_version") == F.col("latest_version")).alias("uptodate"))


def fleet_metrics(devices: DataFrame, updates: DataFrame, rollouts: DataFrame, as_of,
                  span: str = "24 hours") -> DataFrame:
    """The metrics bundle as long rows (metric, key, value)."""
    total = devices.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("total_devices").alias("metric"), F.lit(None).cast("string").alias("key"), "value")
    by_model = devices.groupBy("device_model").agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("devices_by_model").alias("metric"), F.col("device_model").alias("key"), "value")
    recent = (updates.where(trailing("reported_at", as_of, span)).groupBy("status")
              .agg(F.count(F.lit(1)).alias("value"))
              .select(F.lit("recent_updates_24h").alias("metric"), F.col("status").alias("key"), "value"))
    act = rollouts.agg(F.count_if(F.col("is_active")).alias("value")).select(
        F.lit("active_rollouts").alias("metric"), F.lit(None).cast("string").alias("key"), "value")
    return total.unionByName(by_model).unionByName(recent).unionByName(act)


# ---------------------------------------------------------------- joins

def _latest_update(updates: DataFrame) -> DataFrame:
    """Newest attempt per device by started_at DESC (NULL first, X-2), tiebreak id."""
    return latest_by(updates, ["device_id"], ["started_at", "id"],
                     ["firmware_version", "status", "started_at", "completed_at"], nulls="first")


def device_overview(devices: DataFrame, status: DataFrame, updates: DataFrame, releases: DataFrame,
                    as_of, online=("5 minutes", "1 hour"), status_recent: str = "10 minutes",
                    device_filter: str = ".*") -> DataFrame:
    """Device table with latest status and latest update (12 columns)."""
    ls = latest_by(status, ["device_id"], ["ts", "event_id"], ["status", "ts"], nulls="first") \
        .withColumnRenamed("ts", "last_status_ts")
    lu = _latest_update(updates).select("device_id", F.col("status").alias("update_status"))
    d = devices.where(F.col("device_id").rlike(device_filter))
    j = join_lookup(d.join(ls, "device_id", "left").join(lu, "device_id", "left"), latest_release(releases),
                    "device_model")
    st = F.col("status")
    up = F.try_element_at(st, F.lit("uptime_seconds"))
    ustat = F.col("update_status")
    return j.select(
        F.col("device_id"), F.col("device_model").alias("model"),
        F.col("current_firmware_version").alias("current_fw"), F.col("latest_version").alias("latest_fw"),
        online_state("last_seen", as_of, online, ("Online", "Recent", "Offline")).alias("status"),
        fmt_age("last_seen", as_of, online[0], online[1], "MM-dd HH:mm", "Never").alias("last_seen_text"),
        fmt_age("last_status_ts", as_of, status_recent, online[1], "MM-dd HH:mm", "No data").alias("last_status"),
        F.coalesce(F.try_element_at(st, F.lit("signal_strength_dbm")), F.lit("-")).alias("wifi_dbm"),
        fmt_uptime(up, "coarse").alias("uptime"),
        F.coalesce(F.try_element_at(st, F.lit("state")), F.lit("-")).alias("state"),
        F.when(ustat.isin(*ACTIVE_UPDATE_STATUSES), "Updating").when(ustat == "success", "Success")
         .when(ustat == "failed", "Failed").otherwise("-").alias("update_status"),
        F.date_format("created_at", "yyyy-MM-dd").alias("registered"),
        F.col("last_seen"),
    )


def device_update_progress(devices: DataFrame, updates: DataFrame, as_of, online: str = "5 minutes",
                           recent: str = "1 hour") -> DataFrame:
    """Devices with their latest update attempt (monitoring table)."""
    lu = _latest_update(updates)
    j = devices.join(lu.withColumnRenamed("status", "u_status"), "device_id", "left")
    us = F.col("u_status")
    active = us.isin(*ACTIVE_UPDATE_STATUSES)
    return j.select(
        "device_id", F.col("device_model").alias("model"), F.col("current_firmware_version").alias("current_version"),
        F.when(active, "Updating...").otherwise("-").alias("update_progress"),
        F.coalesce(F.col("firmware_version"), F.lit("-")).alias("target_version"),
        online_state("last_seen", as_of, (online,), ("Online", "Offline")).alias("online"),
        fmt_age("last_seen", as_of, online, recent, "yyyy-MM-dd HH:mm", "Never").alias("last_seen_text"),
        F.when(F.col("completed_at").isNotNull(), F.date_format("completed_at", "yyyy-MM-dd HH:mm"))
         .otherwise("Never").alias("last_update"),
        status_label(us, "device").alias("status"),
        F.col("last_seen"),
    )


def _duration(started, completed, ongoing: str) -> Column:
    secs = seconds_between(completed, started)
    return F.when(F.col(completed).isNotNull(),
                  F.concat(F.round(secs).cast("long").cast("string"), F.lit("s"))).otherwise(ongoing)


def recent_updates(updates: DataFrame, devices: DataFrame | None = None, n: int = 20,
                   device_filter: str | None = None, truncate: int | None = None) -> DataFrame:
    """Newest update attempts (started_at DESC NULLS FIRST, tiebreak id), optionally
    joined with the device registry (from/model) and with long messages cut to ``truncate``."""
    src = updates.where(F.col("device_id").rlike(device_filter)) if device_filter else updates
    top = src.orderBy(F.col("started_at").desc_nulls_first(), F.col("id").desc()).limit(n)
    msg = F.col("error_message")
    if truncate:
        msg = F.when(F.length(msg) > truncate, F.concat(F.left(msg, F.lit(truncate)), F.lit("..."))).otherwise(msg)
    cols = [F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started"), F.col("id"),
            F.col("device_id"), F.col("firmware_version").alias("target_version"),
            status_label("status", "history").alias("status"),
            _duration("started_at", "completed_at", "Ongoing" if devices is None else "-").alias("duration"),
            F.coalesce(msg, F.lit("-")).alias("message")]
    if devices is not None:
        d = devices.select("device_id", F.col("device_model").alias("model"),
                           F.col("current_firmware_version").alias("from_version"))
        top = top.join(d, "device_id", "left")
        cols += [F.col("model"), F.col("from_version")]
    return top.select(*cols)


# ---------------------------------------------------------------- lists

def recent(df: DataFrame, n: int, by: Sequence, cols: Sequence[str] | None = None) -> DataFrame:
    """O1: newest n rows, ``ORDER BY by DESC`` (NULLs first, X-2)."""
    out = df.orderBy(*[col_of(c).desc_nulls_first() for c in by]).limit(n)
    return out.select(*cols) if cols else out


def series(df: DataFrame, cols: Sequence, ts: str = "ts", where: Column | None = None,
           start=None, end=None, closed: str = "both") -> DataFrame:
    """O2: time-ordered raw series between ``start`` and ``end``."""
    from fleetspark.functions.predicates import time_between
    src = df.where(where) if where is not None else df
    if start is not None:
        src = src.where(time_between(ts, start, end, closed))
    return src.select(*cols).orderBy(ts)


def list_devices(devices: DataFrame, model: str | None = None, limit: int = 50) -> DataFrame:
    """Device list by last_seen (desc, NULLs first as in Postgres DESC), optional model."""
    src = devices.where(F.col("device_model") == model) if model else devices
    return (src.orderBy(F.col("last_seen").desc_nulls_first(), F.col("device_id"))
            .limit(limit).select("device_id", "device_model", "current_firmware_version", "last_seen", "created_at"))


def order_last_seen(df: DataFrame) -> DataFrame:
    """O3: ``ORDER BY last_seen DESC NULLS LAST``."""
    return df.orderBy(F.col("last_seen").desc_nulls_last(), F.col("device_id"))


def device_list(df: DataFrame, col: str = "device_id") -> DataFrame:
    """Distinct non-empty values, ordered."""
    return (df.where(F.col(col).isNotNull() & (F.col(col) != "")).select(col).distinct().orderBy(col))


def firmware_history(releases: DataFrame, model: str | None = None, limit: int = 10) -> DataFrame:
    """Releases newest first, optional model filter."""
    src = releases.where(F.col("device_model") == model) if model else releases
    return src.orderBy(F.col("created_at").desc(), F.col("version").desc(), F.col("device_model")).limit(limit)


def update_status_list(updates: DataFrame, device_id: str | None = None,
                       firmware_version: str | None = None, limit: int = 50) -> DataFrame:
    """Optional equality filters, newest reports first."""
    src = updates
    if device_id:
        src = src.where(F.col("device_id") == device_id)
    if firmware_version:
        src = src.where(F.col("firmware_version") == firmware_version)
    return (src.orderBy(F.col("reported_at").desc(), F.col("id").desc()).limit(limit)
            .select("device_id", "firmware_version", "status", "error_message", "progress_percent",
                    "started_at", "completed_at", "reported_at"))
