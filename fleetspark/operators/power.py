"""Power-station transforms.

Snapshots arrive as flat JSON objects with dotted keys (``pd.wattsInSum``),
decoded once to ``map<string,string>``; every typed column is one expression
in a single ``select`` (no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pyspark.sql.types import DoubleType, StructField, StructType

from fleetspark.functions.jsonmap import json_path
from fleetspark.functions.util import col_of, round_int, with_parsed

# Typed column <- vendor key. INTEGER columns default to 0 when the
# key is absent (an explicit JSON null stays NULL); inputs read but not stored
# are inv.inputWatts (as ac_in) and mppt.outWatts.
INT_DEFAULT_ZERO = {
    "soc_percent": "bmsMaster.soc",
    "remain_time_min": "pd.remainTime",
    "watts_in_sum": "pd.wattsInSum",
    "watts_out_sum": "pd.wattsOutSum",
    "ac_out_watts": "inv.outputWatts",
    "pv_in_watts": "mppt.inWatts",
    "car_watts": "pd.carWatts",
    "usb1_watts": "pd.usb1Watts",
    "usb2_watts": "pd.usb2Watts",
    "qcusb1_watts": "pd.qcUsb1Watts",
    "qcusb2_watts": "pd.qcUsb2Watts",
    "typec1_watts": "pd.typec1Watts",
    "typec2_watts": "pd.typec2Watts",
}
# Columns that stay NULL when the key is absent.
NULL_DEFAULT = {
    "inv_out_temp": "inv.outTemp",
    "bms_temp": "bmsMaster.temp",
    "bms_max_cell_temp": "bmsMaster.maxCellTemp",
    "bms_min_cell_temp": "bmsMaster.minCellTemp",
    "mppt_temp": "mppt.mpptTemp",
    "inv_input_watts": "inv.inputWatts",
    "inv_ac_in_vol": "inv.acInVol",
    "inv_out_vol": "inv.invOutVol",
    "inv_ac_in_amp": "inv.acInAmp",
    "inv_out_amp": "inv.invOutAmp",
    "bms_amp": "bmsMaster.amp",
    "bms_vol": "bmsMaster.vol",
    "bms_min_cell_vol": "bmsMaster.minCellVol",
    "bms_max_cell_vol": "bmsMaster.maxCellVol",
    "bms_remain_cap": "bmsMaster.remainCap",
    "bms_full_cap": "bmsMaster.fullCap",
    "bms_cycles": "bmsMaster.cycles",
}
INT_NULL_DEFAULT = {"bms_cycles"}
DC_PARTS = ("car_watts", "usb1_watts", "usb2_watts", "qcusb1_watts", "qcusb2_watts")
TYPEC_PARTS = ("typec1_watts", "typec2_watts")
USB_PARTS = ("usb1_watts", "usb2_watts", "qcusb1_watts", "qcusb2_watts")


# Keys whose JSON value is an explicit null (absent keys are not listed).
_NULL_KEYS = r'"((?:[^"\\]|\\.)*)"\s*:\s*null'


class _Params:
    """Typed access to a flat dotted payload (JSON text or an already decoded map).

    JSON text is parsed once, schema-on-read, into a struct of exactly the keys
    an operator uses (numbers land as doubles, no per-key string casts). Where
    absent and explicit-null keys must be told apart, the few null-valued keys
    are listed as well (an empty list for almost every row).
    """

    def __init__(self, df: DataFrame, params: str, keys, presence: bool):
        if dict(df.dtypes)[params] == "string":
            schema = StructType([StructField(k, DoubleType()) for k in dict.fromkeys(keys)])
            txt = F.col(params)
            exprs = {"_pv": F.from_json(txt, schema)}
            if presence:
                exprs["_pn"] = F.when(txt.contains("null"), F.regexp_extract_all(txt, F.lit(_NULL_KEYS), 1)) \
                    .otherwise(F.array().cast("array<string>"))
            self.df = with_parsed(df, **exprs)
            self.num = lambda k: F.col("_pv").getField(k)
            self.is_null_key = lambda k: F.coalesce(F.array_contains(F.col("_pn"), F.lit(k)), F.lit(False))
            self.temp = ["_pv", "_pn"] if presence else ["_pv"]
        else:
            m = F.col(params)
            self.df = df
            self.num = lambda k: F.try_element_at(m, F.lit(k)).try_cast("double")
            self.is_null_key = lambda k: F.coalesce(F.map_contains_key(m, F.lit(k)), F.lit(False)) \
                & F.try_element_at(m, F.lit(k)).isNull()
            self.temp = []

    def get0(self, key: str) -> Column:
        """``data.get(key, 0)``: absent -> 0, explicit null -> NULL."""
        v = self.num(key)
        return F.when(v.isNotNull(), v).when(self.is_null_key(key), F.lit(None).cast("double")).otherwise(F.lit(0.0))


def read_power_snapshots(df: DataFrame, body: str = "body") -> DataFrame:
    """Envelope ``{code, data}``; code != "0" or empty data means no snapshot."""
    # data stays JSON text (a string field keeps the raw object) for schema-on-read later
    env = F.from_json(col_of(body), "struct<code:string,message:string,data:string>")
    out = with_parsed(df, _env=env)
    return (out.where((F.col("_env.code") == "0")
                      & F.coalesce(F.size(F.json_object_keys(F.col("_env.data"))) > 0, F.lit(False)))
            .withColumn("params", F.col("_env.data")).drop("_env"))


def flatten_power(df: DataFrame, params: str = "params", keep=("device_sn", "ts")) -> DataFrame:
    """T1 + T2: flat dotted payload -> typed columns plus component sums.

    ``params`` may be a JSON string or a map. Adds ``rejected``: true when a
    summed field is an explicit JSON null (the sum fails and the snapshot is
    lost, X-8) or a number does not fit its INTEGER column (the insert fails).
    INTEGER columns round half away from zero (X-1).
    """
    p = _Params(df, params, [*INT_DEFAULT_ZERO.values(), *NULL_DEFAULT.values()], presence=True)
    raw = {c: p.get0(k) for c, k in INT_DEFAULT_ZERO.items()}
    cols = [F.col(c) for c in keep]
    bad = F.lit(False)

    def whole(e: Column) -> Column:
        nonlocal bad
        bad = bad | (e.isNotNull() & round_int(e).isNull())
        return round_int(e)

    for c, e in raw.items():
        cols.append(whole(e).alias(c))
    total = lambda parts: sum((raw[p] for p in parts[1:]), raw[parts[0]])
    cols.append(whole(total(DC_PARTS)).alias("dc_out_watts"))
    cols.append(whole(total(TYPEC_PARTS)).alias("typec_out_watts"))
    cols.append(whole(total(USB_PARTS)).alias("usb_out_watts"))
    for c, k in NULL_DEFAULT.items():
        v = p.num(k)
        cols.append((whole(v) if c in INT_NULL_DEFAULT else v).alias(c))
    summed = set(DC_PARTS) | set(TYPEC_PARTS)
    for c in sorted(summed):
        bad = bad | p.is_null_key(INT_DEFAULT_ZERO[c])
    cols.append(bad.alias("rejected"))
    return p.df.select(*cols)


def flatten_power_nested(df: DataFrame, payload: str = "payload", keep=()) -> DataFrame:
    """T4: nested payload ``{sn, params{..., bmsMaster{..}, inv{..}}}`` with Python-``or``
    fallback: a 0 falls through to the fallback like NULL (X-5)."""
    p = F.col(payload)
    g = lambda path: F.get_json_object(p, path).try_cast("double")
    orr = lambda a, b: F.coalesce(F.nullif(a, F.lit(0.0)), b)
    # a 0 primary with a missing fallback yields the fallback (NULL), as `0 or None` does
    return df.select(
        *[F.col(c) for c in keep],
        F.coalesce(F.get_json_object(p, "$.sn"), F.lit("unknown")).alias("device_sn"),
        orr(g("$.params.soc"), g("$.params.bmsMaster.soc")).alias("soc_percent"),
        g("$.params.remainTime").alias("remain_time_min"),
        orr(g("$.params.wattsInSum"), g("$.params.inv.inputWatts")).alias("watts_in_sum"),
        orr(g("$.params.wattsOutSum"), g("$.params.inv.outputWatts")).alias("watts_out_sum"),
        g("$.params.invOutWatts").alias("ac_out_watts"),
        g("$.params.dcOutWatts").alias("dc_out_watts"),
        g("$.params.typecOutWatts").alias("typec_out_watts"),
        g("$.params.usbOutWatts").alias("usb_out_watts"),
        g("$.params.pvInWatts").alias("pv_in_watts"),
    )


def power_summary(df: DataFrame, params: str = "params", keep=("device_sn", "ts")) -> DataFrame:
    """T3 + S12: compact summary; ``dc_out_w`` here includes type-C (unlike T2)."""
    dc_keys = ("pd.carWatts", "pd.usb1Watts", "pd.usb2Watts", "pd.qcUsb1Watts", "pd.qcUsb2Watts",
               "pd.typec1Watts", "pd.typec2Watts")
    other = ("bmsMaster.soc", "mppt.inWatts", "inv.inputWatts", "inv.outputWatts", "pd.wattsInSum", "pd.wattsOutSum")
    p = _Params(df, params, [*dc_keys, *other], presence=True)
    dc = None
    for k in dc_keys:
        dc = p.get0(k) if dc is None else dc + p.get0(k)
    body = F.struct(p.get0("bmsMaster.soc").alias("soc"), p.get0("mppt.inWatts").alias("solar_w"),
                    p.get0("inv.inputWatts").alias("ac_in_w"), p.get0("inv.outputWatts").alias("ac_out_w"),
                    dc.alias("dc_out_w"), p.get0("pd.wattsInSum").alias("watts_in"),
                    p.get0("pd.wattsOutSum").alias("watts_out"))
    df = p.df
    return df.select(*[F.col(c) for c in keep], body.alias("summary"),
                     F.to_json(body).alias("payload"))


def scale_temp(df: DataFrame, cols=("inv_out_temp", "bms_temp", "mppt_temp"), divisor: float = 1.0) -> DataFrame:
    """T5: temperature unit policy; raw rows are tenths of a degree (divisor 10),
    the current loader stores degrees (divisor 1, the default)."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.col(c) / F.lit(divisor))
    return out


def net_watts(inp="watts_in_sum", out="watts_out_sum") -> Column:
    """Net power, NULL parts as 0."""
    return F.coalesce(col_of(inp), F.lit(0)) - F.coalesce(col_of(out), F.lit(0))


def power_per_percent(watts, soc) -> Column:
    """Ratio guarded by NULLIF (division by zero gives NULL)."""
    return col_of(watts) / F.nullif(col_of(soc), F.lit(0))


def watts_out_components(ac="ac_out_watts", dc="dc_out_watts", typec="typec_out_watts", usb="usb_out_watts") -> Column:
    """Historical total ``ac + dc + typec + usb`` (NULL if a part is NULL)."""
    return col_of(ac) + col_of(dc) + col_of(typec) + col_of(usb)


# Back-fill fallback keys per column, in priority order.
BACKFILL = {
    "watts_in_sum": ("pd.wattsInSum", "pd.chgPowerAc", "bmsMaster.inputWatts", "inv.inputWatts"),
    "watts_out_sum": ("pd.wattsOutSum", "pd.dsgPowerAc", "bmsMaster.outputWatts", "inv.outputWatts"),
    "soc_percent": ("pd.soc",),
    "remain_time_min": ("pd.remainTime", "bmsMaster.remainTime", "ems.chgRemainTime"),
    "ac_out_watts": ("inv.outputWatts", "inv.acOutWatts"),
    "dc_out_watts": ("mppt.carOutWatts", "mppt.outWatts", "pd.dcOutWatts"),
    "pv_in_watts": ("mppt.inWatts", "mppt.pv1InputWatts", "pd.chgSunPower"),
}
BACKFILL_INT = {"soc_percent", "remain_time_min"}


def backfill_power(df: DataFrame, raw: str = "raw_data") -> DataFrame:
    """Fill NULL typed columns from ``raw_data.params`` in one pass.

    A column is filled only when it is NULL and one of its keys exists; the
    value is the first non-NULL of the keys in order. typec/usb sums keep the
    script's exact shape, including ``typec1 + COALESCE(typec2, 0)`` being 0
    when typec1 is NULL (X-9) and the ``> 0`` guard. Columns missing from
    ``df`` are added as NULL first.
    """
    out = df.withColumn("_params_text", json_path(col_of(raw), "params"))
    keys = [k for ks in BACKFILL.values() for k in ks] + ["pd.typec1Watts", "pd.typec2Watts", "pd.usb1Watts",
                                                          "pd.usb2Watts", "pd.qcUsb1Watts", "pd.qcUsb2Watts"]
    # a key present with a JSON null changes nothing here (COALESCE of NULLs into a NULL
    # column), so "key exists" can be read as "value is not NULL"
    p = _Params(out, "_params_text", keys, presence=False)
    out = p.df
    for c in list(BACKFILL) + ["typec_out_watts", "usb_out_watts"]:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("double"))
    num = p.num
    has = lambda k: num(k).isNotNull()
    sets = {}
    for c, keys in BACKFILL.items():
        vals = [num(k).try_cast("int") if c in BACKFILL_INT else num(k) for k in keys]
        cond = F.col(c).isNull() & F.col(raw).isNotNull()
        any_key = F.lit(False)
        for k in keys:
            any_key = any_key | has(k)
        sets[c] = F.when(cond & any_key, F.coalesce(*vals)).otherwise(F.col(c))
    t1, t2 = num("pd.typec1Watts"), num("pd.typec2Watts")
    cond = (F.col("typec_out_watts").isNull() & F.col(raw).isNotNull()
            & (has("pd.typec1Watts") | has("pd.typec2Watts"))
            & F.coalesce((t1 > 0) | (t2 > 0), F.lit(False)))
    sets["typec_out_watts"] = F.when(cond, F.coalesce(t1 + F.coalesce(t2, F.lit(0.0)), F.lit(0.0))) \
        .otherwise(F.col("typec_out_watts"))
    u = [num(k) for k in ("pd.usb1Watts", "pd.usb2Watts", "pd.qcUsb1Watts", "pd.qcUsb2Watts")]
    cond = (F.col("usb_out_watts").isNull() & F.col(raw).isNotNull()
            & (has("pd.usb1Watts") | has("pd.usb2Watts") | has("pd.qcUsb1Watts") | has("pd.qcUsb2Watts"))
            & F.coalesce((u[0] > 0) | (u[1] > 0) | (u[2] > 0) | (u[3] > 0), F.lit(False)))
    usum = u[0] + F.coalesce(u[1], F.lit(0.0)) + F.coalesce(u[2], F.lit(0.0)) + F.coalesce(u[3], F.lit(0.0))
    sets["usb_out_watts"] = F.when(cond, F.coalesce(usum, F.lit(0.0))).otherwise(F.col("usb_out_watts"))
    types = dict(out.dtypes)
    # INTEGER targets round on assignment (X-1)
    sets = {c: (round_int(e) if types[c] in ("int", "bigint") else e) for c, e in sets.items()}
    return out.withColumns(sets).drop("_params_text", *p.temp)
