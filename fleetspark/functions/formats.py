"""Display and coding functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetspark.functions.util import col_of, interval, lit_of, round_int, seconds_between

# Heater state ordinals as coded by the heater dashboard
# ("Ventilation" has no code there and falls to -1 like unknown text).
HEATER_STATE_CODES = {"Off": 0, "Starting": 1, "Warming": 2, "Running": 3,
                      "ShuttingDown": 4, "Cooling": 5}
# The seven states a heater reports, in protocol order.
HEATER_STATES = ("Off", "Starting", "Warming", "Running", "Ventilation",
                 "ShuttingDown", "Cooling")


def heater_state_code(state) -> Column:
    """State text -> ordinal, else -1."""
    s = col_of(state)
    expr = None
    for name, code in HEATER_STATE_CODES.items():
        expr = F.when(s == name, code) if expr is None else expr.when(s == name, code)
    return expr.otherwise(-1)


def status_label(status="status", scheme: str = "timeline") -> Column:
    """Update status -> label.

    scheme 'timeline': Success / Failed / In Progress / Other
    scheme 'history':  Success / Failed / In Progress / raw status text
    scheme 'device':   Updating / Success / Failed / '-'
    """
    s = col_of(status)
    active = s.isin("downloading", "installing", "pending")
    if scheme == "timeline":
        return (F.when(s == "success", "Success").when(s == "failed", "Failed")
                .when(active, "In Progress").otherwise("Other"))
    if scheme == "history":
        return (F.when(s == "success", "Success").when(s == "failed", "Failed")
                .when(active, "In Progress").otherwise(s))
    return (F.when(active, "Updating").when(s == "success", "Success")
            .when(s == "failed", "Failed").otherwise("-"))


def band(c, steps, labels) -> Column:
    """P25: value bands; ``steps`` ascending thresholds, len(labels) = len(steps)+1.

    A value v gets labels[i] where i = number of thresholds <= v (colour steps
    start at their threshold). NULL stays NULL.
    """
    v = col_of(c)
    expr = F.when(v.isNull(), F.lit(None).cast("string"))
    for i in range(len(steps), 0, -1):
        expr = expr.when(v >= steps[i - 1], labels[i])
    return expr.otherwise(labels[0])


#: Colour steps of the dashboards by metric. The first label also holds below the first step.
BANDS = {
    "soc_percent": ([15, 30, 60], ["dark-red", "orange", "yellow", "green"]),
    "signal_strength_dbm": ([-90, -70, -50], ["red", "red", "yellow", "green"]),
    "battery_v": ([11.0, 11.5, 12.2], ["red", "red", "yellow", "green"]),
    "coolant_temp_c": ([30, 70, 85], ["blue", "green", "yellow", "red"]),
    "flow_lpm": ([0.5, 1.5], ["red", "yellow", "green"]),
    "core_temp_c": ([95], ["green", "red"]),
}


def metric_band(metric, value) -> Column:
    """P25 for rows of (metric, value): the band by the metric's own steps (``BANDS``); other metrics have none."""
    name, expr = col_of(metric), F.lit(None).cast("string")
    for key, (steps, labels) in BANDS.items():
        expr = F.when(name == key, band(value, steps, labels)).otherwise(expr)
    return expr


def fmt_minutes(minutes) -> Column:
    """``CONCAT(FLOOR(m/60), 'h ', MOD(m,60), 'm')``; CONCAT skips NULLs (X-4)."""
    m = col_of(minutes)
    h = F.floor(m / 60).cast("string")
    r = (m % 60).cast("string")
    return F.concat(F.coalesce(h, F.lit("")), F.lit("h "), F.coalesce(r, F.lit("")), F.lit("m"))


def fmt_uptime(seconds, variant: str = "coarse") -> Column:
    """Uptime seconds as text.

    'coarse' (overview): Nd / Nh / Nm / Ns with ``::int`` rounding (X-1).
    'table' (status log): Nh / Nm / Ns.
    'detail' (uptime panel): 'Nd Nh' / 'Nh Nm' / 'Nm' / 'Ns'.
    NULL gives '-' for coarse/table and NULL for detail.
    """
    s = col_of(seconds).cast("double")
    def i(x):
        return round_int(x).cast("string")
    if variant == "coarse":
        return (F.when(s >= 86400, F.concat(i(s / 86400), F.lit("d")))
                .when(s >= 3600, F.concat(i(s / 3600), F.lit("h")))
                .when(s >= 60, F.concat(i(s / 60), F.lit("m")))
                .when(s.isNotNull(), F.concat(i(s), F.lit("s"))).otherwise("-"))
    if variant == "table":
        return (F.when(s >= 3600, F.concat(i(s / 3600), F.lit("h")))
                .when(s >= 60, F.concat(i(s / 60), F.lit("m")))
                .when(s.isNotNull(), F.concat(i(s), F.lit("s"))).otherwise("-"))
    return (F.when(s >= 86400, F.concat(i(s / 86400), F.lit("d "), i((s % 86400) / 3600), F.lit("h")))
            .when(s >= 3600, F.concat(i(s / 3600), F.lit("h "), i((s % 3600) / 60), F.lit("m")))
            .when(s >= 60, F.concat(i(s / 60), F.lit("m")))
            .otherwise(F.concat(i(s), F.lit("s"))))


def fmt_age(ts, as_of, recent: str = "5 minutes", hour: str = "1 hour",
            date_fmt: str = "MM-dd HH:mm", never: str = "Never") -> Column:
    """T12: 'Ns ago' within ``recent``, 'Nm ago' within ``hour``, else a date, else ``never``.

    Seconds use ``EXTRACT(EPOCH ...)::int`` and minutes ``ROUND(../60)::int``
    (both round half away from zero).
    """
    t, now = col_of(ts), lit_of(as_of)
    secs = seconds_between(now, t)
    return (F.when(t > now - interval(recent), F.concat(round_int(secs).cast("string"), F.lit("s ago")))
            .when(t > now - interval(hour), F.concat(round_int(secs / 60).cast("string"), F.lit("m ago")))
            .when(t.isNotNull(), F.date_format(t, date_fmt))
            .otherwise(never))
