"""Small helpers shared by column functions and operators."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F


def col_of(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def lit_of(v) -> Column:
    """Accept a Column or a Python literal (e.g. an ``as_of`` datetime).

    A naive ``datetime`` becomes a ``timestamp_ntz`` literal built from its text,
    so it does not depend on any time zone and compares with stored
    ``timestamp_ntz`` columns without a cast on the column (the filter then
    reaches the Parquet scan).
    """
    if isinstance(v, Column):
        return v
    if isinstance(v, datetime.datetime) and v.tzinfo is None:
        return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(v)


def interval(text: str) -> Column:
    """An interval literal such as ``'5 minutes'`` or ``'30 days'``."""
    return F.expr(f"INTERVAL {text}" if text.strip()[0] == "'" else f"INTERVAL '{text}'")


def round_int(c) -> Column:
    """X-1: ``numeric::int`` rounds half away from zero (cast alone truncates); NULL beyond the int range."""
    return F.round(col_of(c)).try_cast("int")


def epoch_seconds(c) -> Column:
    """Seconds since epoch as double, for timestamp or timestamp_ntz (session UTC)."""
    return F.unix_micros(col_of(c).cast("timestamp")) / F.lit(1_000_000.0)


def seconds_between(later, earlier) -> Column:
    """``EXTRACT(EPOCH FROM later - earlier)`` as double."""
    return epoch_seconds(later) - epoch_seconds(earlier)


def with_parsed(df: DataFrame, **exprs: Column) -> DataFrame:
    """Add columns computed exactly once per row, e.g. a decoded JSON payload.

    Catalyst substitutes projected expressions into later filters and merged
    projections, so a parsed payload referenced k times would be parsed k
    times. The new columns are expanded through a one-element ``inline``
    generator, a boundary neither rewrite crosses; everything above it reads
    plain columns.
    """
    packed = F.struct(*[e.alias(n) for n, e in exprs.items()])
    return df.select(*df.columns, F.inline(F.array(packed)))
