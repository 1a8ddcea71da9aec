"""Latest-value operators.

``DISTINCT ON (k) ... ORDER BY k, t DESC`` and ``ORDER BY t DESC LIMIT 1`` per
device are written as ``max_by(payload, order_key)`` aggregations rather than a
``row_number`` window: the aggregate combines map-side, so a device holding a
third of all rows costs one partial row per task instead of one giant sorted
partition. The order key is a struct that ends in a unique tiebreak (X-14) and,
for ``DESC`` in Postgres, ranks NULL times first (X-2).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.functions.util import col_of, lit_of, round_int, seconds_between


def order_key(order: Sequence, nulls: str = "first") -> Column:
    """Struct whose maximum is the first row of ``ORDER BY order DESC NULLS <nulls>``."""
    parts = []
    for i, o in enumerate(order):
        c = col_of(o)
        flag = c.isNull() if nulls == "first" else c.isNotNull()
        parts += [flag.alias(f"_f{i}"), c.alias(f"_o{i}")]
    return F.struct(*parts)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence, cols: Sequence[str] | None = None,
              nulls: str = "first") -> DataFrame:
    """One row per ``keys``, the newest by ``order`` (descending).

    ``order`` should end in a unique column so ties resolve deterministically.
    """
    keys = list(keys)
    if cols is None:
        cols = [c for c in df.columns if c not in keys]
    payload = F.struct(*[F.col(c) for c in cols])
    return (df.groupBy(*keys)
            .agg(F.max_by(payload, order_key(order, nulls)).alias("_l"))
            .select(*keys, *[F.col(f"_l.{c}").alias(c) for c in cols]))


def latest_value(df: DataFrame, keys: Sequence[str], col, order: Sequence, default=0,
                 name: str = "value") -> DataFrame:
    """Value of the newest row per key, NULL replaced by ``default`` (None keeps NULL)."""
    v = col_of(col)
    if default is not None:
        v = F.coalesce(v, F.lit(default))
    return df.groupBy(*keys).agg(F.max_by(v, order_key(order, "last")).alias(name))


def latest_non_null(df: DataFrame, keys: Sequence[str], col, order: Sequence,
                    name: str = "value") -> DataFrame:
    """Newest non-NULL value per key (rows with NULL are skipped, not defaulted)."""
    v = col_of(col)
    ok = F.when(v.isNotNull(), order_key(order, "last"))
    return (df.groupBy(*keys).agg(F.max_by(v, ok).alias(name), F.count(v).alias("_n"))
            .where(F.col("_n") > 0).drop("_n"))


def latest_with_staleness(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence,
                          cols: Sequence[str], as_of) -> DataFrame:
    """Newest row per key plus ``EXTRACT(EPOCH FROM NOW() - ts)::int``."""
    last = latest_by(df, keys, order, [ts, *cols], nulls="first")
    return last.withColumn("staleness_sec", round_int(seconds_between(lit_of(as_of), F.col(ts))))


def refresh_latest(df: DataFrame, path: str) -> None:
    """Rebuild the latest-value snapshot (overwrite; readers see whole files)."""
    df.write.mode("overwrite").parquet(path)


def latest_release_overall(releases: DataFrame, label: bool = True) -> DataFrame:
    """Newest release overall, ``model: version`` (tiebreak version)."""
    key = F.struct("created_at", "version", "device_model")
    out = releases.agg(F.max_by(F.struct("device_model", "version"), key).alias("_r"))
    if label:
        return out.select(F.concat(F.col("_r.device_model"), F.lit(": "), F.col("_r.version")).alias("latest"))
    return out.select(F.col("_r.version").alias("version"))


def current_states(status: DataFrame, order=("ts", "event_id"), device_filter: str | None = None) -> DataFrame:
    """``state (scenario)`` of each device's newest status row."""
    src = status.where(F.col("device_id").rlike(device_filter)) if device_filter else status
    st = latest_by(src, ["device_id"], list(order), ["status"])
    state = F.try_element_at("status", F.lit("state"))
    scen = F.try_element_at("status", F.lit("active_scenario"))
    return st.select("device_id", F.concat(F.coalesce(state, F.lit("unknown")), F.lit(" ("),
                                           F.coalesce(scen, F.lit("default")), F.lit(")")).alias("current_state"))
