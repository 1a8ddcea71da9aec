"""Filter predicates as column expressions.

All time-relative predicates take ``as_of`` (a literal or a scalar-subquery
Column) instead of reading the wall clock, so results repeat.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from fleetspark.functions.util import col_of, interval, lit_of

# Update statuses counted as "in progress" by the dashboards.
ACTIVE_UPDATE_STATUSES = ("downloading", "installing", "pending")


def topic_filter_regex(pattern: str) -> str:
    """MQTT filter -> anchored regex (``+`` one level, ``#`` the rest)."""
    parts = pattern.split("/")
    out = []
    for i, p in enumerate(parts):
        if p == "#":
            # '#' also matches the parent level itself
            return "^" + "/".join(out) + ("(/.*)?$" if out else ".*$")
        out.append("[^/]*" if p == "+" else re.escape(p))
    return "^" + "/".join(out) + "$"


def topic_matches(topic, *patterns: str) -> Column:
    """Topic matches any of the subscription filters."""
    cond = F.lit(False)
    for p in patterns:
        cond = cond | col_of(topic).rlike(topic_filter_regex(p))
    return cond


def time_between(ts, start, end, closed: str = "both") -> Column:
    """``$__timeFilter`` (both ends inclusive) or ``ts > a AND ts < b``."""
    t, a, b = col_of(ts), lit_of(start), lit_of(end)
    if closed == "both":
        return t.between(a, b)
    if closed == "neither":
        return (t > a) & (t < b)
    if closed == "left":
        return (t >= a) & (t < b)
    return (t > a) & (t <= b)


def trailing(ts, as_of, span: str, inclusive: bool = False) -> Column:
    """``ts > NOW() - INTERVAL span`` with NOW() = as_of (``>=`` if inclusive)."""
    lo = lit_of(as_of) - interval(span)
    return col_of(ts) >= lo if inclusive else col_of(ts) > lo


def device_matches(c, pattern: str) -> Column:
    """Postgres ``~`` is an unanchored regex search, as is ``rlike``."""
    return col_of(c).rlike(pattern)


def like_filter(c, pattern: str) -> Column:
    """SQL LIKE."""
    return col_of(c).like(pattern)


def valid_reading(c, drop_zero: bool = True) -> Column:
    """``c IS NOT NULL AND c != 0``."""
    cond = col_of(c).isNotNull()
    return cond & (col_of(c) != 0) if drop_zero else cond


def any_not_null(*cols) -> Column:
    """At least one of the columns is set."""
    return F.coalesce(*[col_of(c) for c in cols]).isNotNull()


def is_active_update(status="status") -> Column:
    """Status in the in-progress set."""
    return col_of(status).isin(*ACTIVE_UPDATE_STATUSES)


def online_state(last_seen, as_of, levels=("5 minutes", "1 hour"),
                 labels=("online", "recent", "offline")) -> Column:
    """3-way (or 2-way with one level) classification of a last-seen time.

    NULL last_seen falls to the last label, as the CASE does in SQL.
    """
    t = col_of(last_seen)
    expr = None
    for lvl, lab in zip(levels, labels):
        cond = t > lit_of(as_of) - interval(lvl)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return expr.otherwise(labels[len(levels)])


def time_range(df, ts: str, start, end, closed: str = "both", dt: str = "dt"):
    """Filter ``df`` on ``ts`` and, when it is stored partitioned by day (``dt``),
    also on the day folders, so whole partitions are skipped before any file is
    opened (the ts filter alone can only skip row groups)."""
    out = df.where(time_between(ts, start, end, closed))
    if dt in df.columns:
        out = out.where(F.col(dt).between(F.to_date(lit_of(start)), F.to_date(lit_of(end))))
    return out
