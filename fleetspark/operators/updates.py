"""Firmware-update tracking.

The reference applies OTA messages one at a time: ``status`` inserts a new
attempt row, ``progress`` and ``result`` update the device's newest row. Here
the whole message log is folded at once:

1. parse each message into the fields it would write (or mark it rejected,
   as the database would);
2. number attempts with a running count of inserts per device, computed per
   (device, time chunk) with a carried offset so that no device has to fit in
   one task;
3. reduce each (device, attempt) with order-keyed ``max_by`` aggregates, which
   combine map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fleetspark.functions.jsonmap import MAP_SCHEMA, keep_last
from fleetspark.functions.util import with_parsed
from fleetspark.operators.runs import time_chunk

# Statuses allowed by the update-status table.
UPDATE_STATUSES = ("pending", "downloading", "downloaded", "installing", "success", "failed", "rolled_back")


def _version(m: Column) -> dict:
    """X-12: target_version, else version, else 'unknown' -- by key presence.
    A present key with a JSON null yields NULL, which the NOT NULL column rejects."""
    has = lambda k: F.coalesce(F.map_contains_key(m, F.lit(k)), F.lit(False))
    v = (F.when(has("target_version"), F.try_element_at(m, F.lit("target_version")))
         .when(has("version"), F.try_element_at(m, F.lit("version"))).otherwise(F.lit("unknown")))
    return {"version": v, "bad": v.isNull()}


# Texts that the database reads as a boolean.
TRUE_TEXTS = ("t", "tr", "tru", "true", "y", "ye", "yes", "on", "1")
FALSE_TEXTS = ("f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0")


def _typed(field: str) -> tuple[Column, Column]:
    """JSON type (NULL: absent, VOID: null) and text of a typed payload field."""
    v = F.col(f"_typed.{field}")
    return F.schema_of_variant(v), F.try_variant_get(v, "$", "string")


def _is_number(kind: Column) -> Column:
    return kind.startswith("DECIMAL") | kind.isin("BIGINT", "DOUBLE", "FLOAT")


def parse_update_messages(msgs: DataFrame, seq: str = "seq") -> DataFrame:
    """Fields each OTA message writes. Columns added: is_insert, fw, new_status,
    sets_pct, pct, is_result, error, rejected.

    A message is rejected where handling it fails: a progress state that is no text, a percent
    that is no integer to the database or lies outside 0..100, a success that the database cannot read
    as a boolean, a NULL version.
    """
    msgs = with_parsed(msgs, _map=F.from_json(F.col("payload"), MAP_SCHEMA),
                       _typed=F.from_json(F.col("payload"), "state variant, percent variant, success variant"))
    msgs = with_parsed(msgs, _payload_map=keep_last(F.col("_map")))
    m = F.col("_payload_map")
    kind = F.col("kind")
    ver = _version(m)
    state_kind, state_text = _typed("state")
    state = F.lower(F.coalesce(state_text, F.lit("")))
    bad_state = state_kind.isNotNull() & (state_kind != "STRING")
    prog_status = (F.when(state == "installing", "installing").when(state == "verifying", "downloaded")
                   .otherwise("downloading"))
    pct_kind, pct_text = _typed("percent")
    whole = pct_text.rlike(r"^\s*[+-]?[0-9]+\s*$")
    pct_num = F.when(pct_kind.isNull(), F.lit(0.0)).when(  # X-11: absent is 0, null stays NULL
        _is_number(pct_kind) | ((pct_kind == "STRING") & whole), F.round(F.trim(pct_text).try_cast("double")))
    bad_pct = F.coalesce((pct_num < 0) | (pct_num > 100), F.lit(False)) | (
        pct_kind.isNotNull() & ~(_is_number(pct_kind) | (pct_kind == "VOID") | ((pct_kind == "STRING") & whole)))
    pct = F.when(~bad_pct, pct_num).try_cast("int")
    ok_kind, ok_text = _typed("success")
    ok_text = F.lower(F.trim(ok_text))
    said = (ok_kind == "STRING") & ok_text.isin(*TRUE_TEXTS, *FALSE_TEXTS)
    # any readable text is truthy for the status, but sets the percentage only if it reads as true
    success = F.coalesce(F.when(ok_kind == "BOOLEAN", ok_text == "true").otherwise(said), F.lit(False))
    full = success & ok_text.isin(*TRUE_TEXTS)
    bad_ok = ok_kind.isNotNull() & ~((ok_kind == "BOOLEAN") | (ok_kind == "VOID") | said)
    new_status = (F.when(kind == "status", "pending").when(kind == "progress", prog_status)
                  .when(success, "success").otherwise("failed"))
    rejected = (F.when(kind == "status", ver["bad"]).when(kind == "progress", bad_state | bad_pct)
                .otherwise(F.coalesce(bad_ok, F.lit(False))))
    return msgs.select(
        *[c for c in msgs.columns if c not in ("_map", "_typed", "_payload_map")],
        (kind == "status").alias("is_insert"), ver["version"].alias("fw"),
        new_status.alias("new_status"),
        ((kind == "progress") | ((kind == "result") & full)).alias("sets_pct"),
        F.when(kind == "progress", pct).when(kind == "result", F.lit(100)).alias("pct"),
        (kind == "result").alias("is_result"),
        F.when((kind == "result") & ~success, F.try_element_at(m, F.lit("message"))).alias("error"),
        rejected.alias("rejected"))


#: What a message can change, as the fold reads it.
EFFECT = ("is_insert", "fw", "new_status", "sets_pct", "pct", "is_result", "error")
_STATES = ("fw", "st", "pct", "err", "start", "done")


def message_effects(msgs: DataFrame, seq: str = "seq", chunk_seconds: int = 86400) -> DataFrame:
    """Accepted messages as their effects: device_id, ``_chunk`` (time chunk), received_at, ``seq`` and EFFECT."""
    p = parse_update_messages(msgs, seq).where(~F.col("rejected"))
    return p.select("device_id", time_chunk("received_at", chunk_seconds).alias("_chunk"), "received_at", seq, *EFFECT)


def attempt_parts(effects: DataFrame, seq: str = "seq") -> DataFrame:
    """Order-keyed partial states per (device, chunk, attempt counted inside the chunk; 0: before its first insert).

    The rows of a chunk must be complete; parts of different chunks merge in any order (``merge_attempts``)."""
    w = (Window.partitionBy("device_id", "_chunk").orderBy("received_at", seq)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    p = effects.withColumn("_local", F.sum(F.col("is_insert").cast("long")).over(w))
    order = F.struct(F.col("received_at").alias("t"), F.col(seq).alias("s"))

    def newest(value: str, cond=None):
        st = F.struct(order.alias("o"), F.col(value).alias("v"))
        return F.max(F.when(cond, st) if cond is not None else st)

    states = (newest("fw", F.col("is_insert")), newest("new_status"), newest("pct", F.col("sets_pct")), newest("error", F.col("is_result")),
              newest("received_at", F.col("is_insert")), newest("received_at", F.col("is_result")))
    return p.groupBy("device_id", "_chunk", "_local").agg(
        *[e.alias(n) for n, e in zip(_STATES, states)], F.max("received_at").alias("rep"), F.count(F.lit(1)).alias("n"))


def merge_attempts(part: DataFrame) -> DataFrame:
    """W9 result from the parts of the chunks: inserts before a chunk are a running sum over the (few) chunks of a
    device, and an attempt that spans chunks takes the newest of its states."""
    # _same makes this branch read the columns of the other one, so that Spark shuffles
    # the messages once and both branches reuse the exchange
    every = [*_STATES, "rep", "n"]
    wc = Window.partitionBy("device_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offs = (part.groupBy("device_id", "_chunk").agg(F.max("_local").alias("_ins"), F.max(F.struct(*every)).alias("_same"))
            .select(F.col("device_id").alias("_d"), F.col("_chunk").alias("_c"),
                    F.coalesce(F.sum("_ins").over(wc), F.lit(0)).alias("_off"), "_same"))
    cond = [part["device_id"].eqNullSafe(offs["_d"]), part["_chunk"].eqNullSafe(offs["_c"])]
    # offsets number as many as (device, chunk) pairs: left to its estimates Spark would broadcast them to every task
    g = (part.join(offs.hint("merge"), cond, "left").where(F.col("_same").isNotNull()).drop("_d", "_c", "_same")
         .withColumn("attempt", F.col("_off") + F.col("_local")).where(F.col("attempt") > 0))
    merged = g.groupBy("device_id", "attempt").agg(
        *[F.max(n).alias(n) for n in _STATES], F.max("rep").alias("rep"), F.sum("n").alias("n"))
    return merged.select(
        "device_id", "attempt", F.col("fw.v").alias("firmware_version"), F.col("st.v").alias("status"),
        F.col("pct.v").alias("progress_percent"), F.col("err.v").alias("error_message"),
        F.col("start.v").alias("started_at"), F.col("done.v").alias("completed_at"),
        F.col("rep").alias("reported_at"), F.col("n").alias("messages"))


#: Messages that one task folds at a time, where their number is known.
TASK_ROWS = 50_000


def fold_tasks(spark: SparkSession, rows: int) -> int:
    """Into how many tasks to deal ``rows`` messages: at most about TASK_ROWS each, and no fewer than run at a time."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def update_attempts(msgs: DataFrame, seq: str = "seq", chunk_seconds: int = 86400, tasks: int | None = None) -> DataFrame:
    """One row per (device, attempt) in the state the message log leaves it.

    Input: device_id, kind (status|progress|result), received_at, seq, payload.
    Messages before a device's first insert and rejected messages change nothing.

    One window pass per (device, time chunk) numbers the inserts locally; rows
    are then reduced per (device, chunk, local attempt) into order-keyed
    partial states. Inserts before each chunk come from the partial states too, and
    so does the merge of attempts that span chunks: the messages are read and
    shuffled once and no device has to fit in one task. ``tasks`` (see ``fold_tasks``) deals
    them to that many; without it Spark joins small tasks into as few as run at a time, whose
    memory then grows with the input.
    """
    effects = message_effects(msgs, seq, chunk_seconds)
    return merge_attempts(attempt_parts(effects.repartition(tasks, "device_id", "_chunk") if tasks else effects, seq))


def ota_event_log(msgs: DataFrame, seq: str = "seq") -> DataFrame:
    """Audit events of the message path: update_started per accepted insert,
    update_completed / update_failed per result (logged even with no attempt row)."""
    p = parse_update_messages(msgs, seq)
    ev = (F.when(F.col("kind") == "status", "update_started")
          .when(F.col("new_status") == "success", "update_completed").otherwise("update_failed"))
    return (p.where((F.col("kind").isin("status", "result")) & ~F.col("rejected"))
            .select(ev.alias("event_type"), "device_id", F.col("fw").alias("firmware_version"),
                    "received_at", seq))


def update_reports(reports: DataFrame) -> DataFrame:
    """REST status reports as rows; ``started_at`` only for 'downloading',
    ``completed_at`` only for success/failed; CHECK rules flagged, not dropped."""
    st = F.col("status")
    return reports.select(
        "*",
        F.when(st == "downloading", F.col("reported_at")).alias("report_started_at"),
        F.when(st.isin("success", "failed"), F.col("reported_at")).alias("report_completed_at"),
        (st.isin(*UPDATE_STATUSES) & F.coalesce(F.col("progress_percent").between(0, 100), F.lit(True)))
        .alias("valid"))


def apply_success(devices: DataFrame, reports: DataFrame, order=("reported_at", "id")) -> DataFrame:
    """A success report sets the device's current firmware (newest success wins)."""
    ok = reports.where(F.col("status") == "success").groupBy("device_id").agg(
        F.max_by("firmware_version", F.struct(*order)).alias("_fw"),
        F.max("reported_at").alias("_seen"))
    j = devices.join(ok, "device_id", "left")
    return j.select(*[F.coalesce(F.col("_fw"), F.col(c)).alias(c) if c == "current_firmware_version"
                      else (F.greatest(F.col("_seen"), F.col(c)).alias(c) if c == "last_seen" else F.col(c))
                      for c in devices.columns])
