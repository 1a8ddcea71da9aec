"""Time-bucket aggregation family.

``$__timeGroup(ts, every)`` is an epoch-aligned tumbling bucket, i.e.
``window(ts, every).start``. Every operator is one hash aggregation with
map-side partial aggregation, so a hot device only ever ships one partial row
per bucket per task; filters on ``ts`` reach the Parquet scan.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.functions.util import col_of


def bucket(ts, every: str) -> Column:
    """Start of the epoch-aligned bucket containing ``ts``."""
    return F.window(col_of(ts), every).start


def bucket_avg(df: DataFrame, ts, value, every: str, by: Sequence[str] = (),
               label: Column | None = None, null_as_zero: bool = False,
               scale: float | None = None, where: Column | None = None,
               metric: str | None = None) -> DataFrame:
    """Mean of ``value`` per bucket (and per ``by`` keys).

    label: series name computed from the ``by`` keys (A2, ``device (location)``);
    metric: constant series name (A1); null_as_zero: ``AVG(COALESCE(v,0))`` (A3);
    scale: multiply the mean (A19, ``AVG(min)/60`` -> scale=1/60).
    Output: time, value, metric.
    """
    v = col_of(value)
    if null_as_zero:
        v = F.coalesce(v, F.lit(0))
    src = df.where(where) if where is not None else df
    agg = src.groupBy(bucket(ts, every).alias("time"), *by).agg(F.avg(v).alias("value"))
    val = F.col("value") * F.lit(scale) if scale is not None else F.col("value")
    name = label if label is not None else F.lit(metric)
    return agg.select("time", val.alias("value"), name.alias("metric"))


def bucket_avg_wide(df: DataFrame, ts, cols: Mapping[str, Column | str], every: str,
                    by: Sequence[str] = (), null_as_zero: bool = False) -> DataFrame:
    """A4: several means in one bucketed row (one scan, one aggregation)."""
    aggs = []
    for name, c in cols.items():
        v = F.coalesce(col_of(c), F.lit(0)) if null_as_zero else col_of(c)
        aggs.append(F.avg(v).alias(name))
    return df.groupBy(bucket(ts, every).alias("time"), *by).agg(*aggs)


def bucket_net(df: DataFrame, ts, a, b, every: str, mode: str = "of_avgs") -> DataFrame:
    """A5: net series. mode 'of_avgs': AVG(a) - AVG(b); 'avg_of_net':
    AVG(COALESCE(a,0) - COALESCE(b,0)). Both definitions exist in the dashboards."""
    if mode == "of_avgs":
        e = F.avg(col_of(a)) - F.avg(col_of(b))
    else:
        e = F.avg(F.coalesce(col_of(a), F.lit(0)) - F.coalesce(col_of(b), F.lit(0)))
    return df.groupBy(bucket(ts, every).alias("time")).agg(e.alias("value"))


def bucket_count(df: DataFrame, ts, every: str, by: Sequence[str] = (),
                 name: str = "count") -> DataFrame:
    """Rows per bucket (and per keys)."""
    return df.groupBy(bucket(ts, every).alias("time"), *by).agg(F.count(F.lit(1)).alias(name))


def message_rate(df: DataFrame, ts="ts", every: str = "5 minutes", by=("device_id",)) -> DataFrame:
    """Messages per 5 minutes per device.

    ``date_trunc('minute', ts) - (minute % 5) * 1 min`` equals the 5-minute
    epoch-aligned bucket, so it is a plain tumbling window.
    """
    return bucket_count(df, ts, every, by, name="messages")


def dew_point(t: Column, rh: Column) -> Column:
    """Magnus formula (17.27, 237.7) on mean temperature and mean RH."""
    g = F.ln(rh / 100.0) + (17.27 * t) / (237.7 + t)
    return (237.7 * g) / (17.27 - g)


def abs_humidity(t: Column, rh: Column) -> Column:
    """Absolute humidity g/m3 (6.112, 17.67, 243.5, 2.1674)."""
    return (rh / 100.0 * 6.112 * F.exp((17.67 * t) / (t + 243.5)) * 2.1674) / (273.15 + t)


def bucket_dew_point(df: DataFrame, ts, temp, rh, every: str, by: Sequence[str] = (),
                     label: Column | None = None, where: Column | None = None) -> DataFrame:
    """Dew point from bucket means; rows with RH <= 0 removed first."""
    src = df.where(col_of(rh) > 0)
    if where is not None:
        src = src.where(where)
    agg = src.groupBy(bucket(ts, every).alias("time"), *by).agg(
        F.avg(col_of(temp)).alias("_t"), F.avg(col_of(rh)).alias("_rh"))
    return agg.select("time", dew_point(F.col("_t"), F.col("_rh")).alias("value"),
                      (label if label is not None else F.lit(None).cast("string")).alias("metric"))


def bucket_abs_humidity(df: DataFrame, ts, temp, rh, every: str, by: Sequence[str] = (),
                        label: Column | None = None, where: Column | None = None) -> DataFrame:
    """Absolute humidity from bucket means."""
    src = df.where(where) if where is not None else df
    agg = src.groupBy(bucket(ts, every).alias("time"), *by).agg(
        F.avg(col_of(temp)).alias("_t"), F.avg(col_of(rh)).alias("_rh"))
    return agg.select("time", abs_humidity(F.col("_t"), F.col("_rh")).alias("value"),
                      (label if label is not None else F.lit(None).cast("string")).alias("metric"))


def series_long(df: DataFrame, ts, series: Mapping[str, dict], every: str) -> DataFrame:
    """UNION ALL of k labelled bucket series -> long form, in one scan.

    ``series`` maps a label to ``{"value": col, "where": col?, "null_as_zero": bool,
    "net": (a, b)?}``. Each series becomes a conditional aggregate of one pass;
    a filtered series also counts its passing rows so buckets where nothing
    passes are dropped (X-16), while unfiltered series keep NULL-mean rows.
    """
    aggs, names = [], []
    for i, (label, spec) in enumerate(series.items()):
        cond = spec.get("where")
        if "net" in spec:
            a, b = spec["net"]
            e = F.avg(col_of(a)) - F.avg(col_of(b))
        else:
            v = col_of(spec["value"])
            if spec.get("null_as_zero"):
                v = F.coalesce(v, F.lit(0))
            e = F.avg(F.when(cond, v)) if cond is not None else F.avg(v)
        aggs.append(e.alias(f"_v{i}"))
        aggs.append((F.count_if(cond) if cond is not None else F.count(F.lit(1))).alias(f"_n{i}"))
        names.append(label)
    wide = df.groupBy(bucket(ts, every).alias("time")).agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(f"_v{i}").alias("value"), F.col(f"_n{i}").alias("n"))
        for i, n in enumerate(names)]))
    return (wide.select("time", stack.alias("s"))
            .where(F.col("s.n") > 0)
            .select("time", F.col("s.value").alias("value"), F.col("s.metric").alias("metric")))


def all_temperatures(parts: Sequence[DataFrame]) -> DataFrame:
    """Several targets from different tables in one panel (unionByName)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
