"""Ordered-run operators over per-device sequences (W7, W8) and the chunked
prefix machinery they share with the update-attempt fold (W9).

A plain ``Window.partitionBy(device).orderBy(ts)`` puts a whole device into one
task; a device with a third of all rows would then be one third of the job in a
single sorted partition. Instead every sequence is cut into chunks
(device, time chunk). Inside a chunk, ``lag`` and running sums are ordinary
windows; across chunks, the carry (last value of the previous chunk, number of
run starts before it) comes from a per-chunk summary that is tiny compared with
the rows (devices x chunks) and is scanned with a window per device. The result
is exact for any chunk width; the width only balances the tasks.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetspark.functions.util import epoch_seconds


def time_chunk(ts, width_seconds: int) -> Column:
    """Chunk number of a timestamp (epoch-aligned)."""
    return F.floor(epoch_seconds(ts) / F.lit(width_seconds)).cast("long")


def chunk_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, starts_run, group: Sequence[str]) -> DataFrame:
    """Runs inside each (key, chunk): keys, ``_chunk``, ``_local`` (0-based), ``group``, start, end, rows.

    A row opens a run when ``starts_run(previous value, value)`` holds. The rows are shuffled once, by (key, chunk)."""
    ts = order[0]
    w = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    r = df.withColumn("_rn", F.row_number().over(w)).withColumn("_prev", F.lag(value).over(w))
    r = r.withColumn("_flag", ((F.col("_rn") > 1) & starts_run(F.col("_prev"), F.col(value))).cast("long"))
    r = r.withColumn("_local", F.sum("_flag").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return r.groupBy(*keys, "_chunk", "_local", *group).agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count(F.lit(1)).alias("rows"))


def number_runs(part: DataFrame, keys: Sequence[str], starts_run, group: Sequence[str], first: str, last: str, out: str) -> DataFrame:
    """One row per run and chunk it touches: keys, ``group``, ``out`` (1-based run number), start, end, rows.

    The number of runs before a chunk comes from a summary of the reduced rows, scanned per key. ``first`` and
    ``last`` name the columns that hold a run's first and last value. NULL keys are a group of their
    own, hence the null-safe join."""
    keys = list(keys)
    wc = Window.partitionBy(*keys).orderBy("_chunk")
    summary = (part.groupBy(*keys, "_chunk")
               .agg(F.min_by(first, "_local").alias("_first"), F.max_by(last, "_local").alias("_last"), F.max("_local").alias("_n"))
               .withColumn("_fs", (F.lag(F.lit(1)).over(wc).isNull()
                                   | starts_run(F.lag("_last").over(wc), F.col("_first"))).cast("long")))
    before = F.sum(F.col("_n") + F.col("_fs")).over(wc.rowsBetween(Window.unboundedPreceding, -1))
    on = [*keys, "_chunk"]
    summary = summary.select(*[F.col(c).alias(f"_j_{c}") for c in on], "_fs", F.coalesce(before, F.lit(0)).alias("_off"))
    joined = part.join(summary, [part[c].eqNullSafe(summary[f"_j_{c}"]) for c in on], "left")
    return joined.select(*keys, *group, (F.col("_off") + F.col("_fs") + F.col("_local")).alias(out), "start", "end", "rows")


def _merged(parts: DataFrame, by: Sequence) -> DataFrame:
    """Runs from their parts: a run that spans chunks has one part in each."""
    return parts.groupBy(*by).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("rows").alias("rows"))


def state_intervals(df: DataFrame, keys: Sequence[str], ts: str, state: str,
                    tiebreak: str, chunk_seconds: int = 86400) -> DataFrame:
    """Merge consecutive equal states into intervals (gaps and islands).

    Output per run: keys, run (1-based), state, start, end (last row time), rows.
    A NULL state compares as a value of its own.
    """
    d = df.select(*keys, ts, tiebreak, F.col(state).alias("_state")).withColumn("_chunk", time_chunk(ts, chunk_seconds))
    return intervals_of(chunk_intervals(d, keys, [ts, tiebreak]), keys)


def _differs(prev: Column, cur: Column) -> Column:
    return ~prev.eqNullSafe(cur)


def chunk_intervals(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """State intervals inside each (key, ``_chunk``) of rows with a ``_state``; ``intervals_of`` joins them at the borders."""
    # every row of a run has the same state, so it is a grouping key and the buffers stay fixed-width
    return chunk_runs(rows, keys, order, "_state", _differs, ["_state"])


def intervals_of(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """W7 result from the intervals of the chunks."""
    numbered = number_runs(parts, keys, _differs, ["_state"], "_state", "_state", "run")
    return _merged(numbered, [*keys, "run", F.col("_state").alias("state")])


def gap_segments(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, max_gap: str = "10 minutes",
                 chunk_seconds: int = 86400) -> DataFrame:
    """Split each series where the gap to the previous row exceeds ``max_gap``.

    Output per segment: keys, segment (1-based), start, end, rows.
    """
    gap_s = F.expr(f"INTERVAL '{max_gap}'")
    d = df.select(*keys, ts, tiebreak).withColumn("_chunk", time_chunk(ts, chunk_seconds))
    far = lambda prev, cur: (cur - prev) > gap_s
    parts = number_runs(chunk_runs(d, keys, [ts, tiebreak], ts, far, []), keys, far, [], "start", "end", "segment")
    return _merged(parts, [*keys, "segment"])


def join_segments(segments: DataFrame, keys: Sequence[str], max_gap: str) -> DataFrame:
    """Segments (keys, start, end, rows) of disjoint sets of rows as the segments of all rows: what overlaps or
    lies within ``max_gap`` becomes one. Associative and commutative, so it may be applied to any grouping of batches."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = reach.isNull() | ((F.col("start") - reach) > F.expr(f"INTERVAL '{max_gap}'"))
    numbered = segments.withColumn("_opens", opens.cast("long")).withColumn("segment", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return _merged(numbered, [*keys, "segment"])
