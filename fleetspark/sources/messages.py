"""Message ingest: read, parse, validate, route.

One ``select`` turns ``(topic, payload, received_at)`` into the parsed topic,
the decoded object and a ``route`` plus ``reason`` column; each target table is
then a filter of that one projection (the caller caches it or writes it once
per micro-batch). Nothing runs per row in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampNTZType

from fleetspark.functions.jsonmap import MAP_SCHEMA, keep_last
from fleetspark.functions.util import col_of, with_parsed

MESSAGE_SCHEMA = StructType([
    StructField("topic", StringType()),
    StructField("payload", StringType()),
    StructField("received_at", TimestampNTZType()),
    StructField("seq", LongType()),
])

# Accepted topic types for 4-level and OTA (5-level) topics.
TOPIC_TYPES = ("data", "status", "config")
OTA_TYPES = ("status", "progress", "result")
# Subscription filters of the collector.
SUBSCRIPTIONS = ("+/+/+/data", "+/edge/+/status", "+/edge/+/config", "+/edge/+/ota/+")


def read_messages(spark: SparkSession, path: str, streaming: bool = False, fmt: str = "json", binary: bool = False) -> DataFrame:
    """Messages from a drop folder (JSON lines or Parquet), batch or stream.

    ``seq`` is the source's number of a message (NULL where the files have none).
    With ``binary`` the payload is stored as bytes and decoded as UTF-8 with replacement.
    """
    r = spark.readStream if streaming else spark.read
    schema = StructType([StructField("payload", BinaryType()) if binary and f.name == "payload" else f for f in MESSAGE_SCHEMA])
    return normalize_messages(r.schema(schema).format(fmt).load(path))


def normalize_messages(df: DataFrame, topic: str = "topic", payload: str = "payload",
                       received_at: str = "received_at") -> DataFrame:
    """Bring any message source to (topic, payload, received_at).

    A binary payload (e.g. a Kafka ``value``) is decoded as UTF-8; malformed
    bytes become U+FFFD instead of failing the row. A timestamp with time zone
    is converted to the session-zone wall time (UTC) as ``timestamp_ntz``.
    """
    types = dict(df.dtypes)
    p = F.col(payload)
    if types.get(payload) == "binary":
        p = F.make_valid_utf8(p.cast("string"))
    t = F.col(topic).cast("string")
    r = F.col(received_at)
    if types.get(received_at) == "timestamp":
        r = r.cast("timestamp_ntz")
    others = [c for c in df.columns if c not in (topic, payload, received_at)]
    return df.select(t.alias("topic"), p.alias("payload"), r.alias("received_at"), *others)


def parse_topic(topic) -> Column:
    """``site/system/device/type`` or ``site/edge/device/ota/{status|progress|result}``
    -> struct(site_id, system, device_id, topic_type), else NULL."""
    parts = F.split(col_of(topic), "/", -1)
    n = F.size(parts)
    p = lambda i: F.try_element_at(parts, F.lit(i + 1))
    ota = (n == 5) & (p(1) == "edge") & (p(3) == "ota")
    st = lambda t: F.struct(p(0).alias("site_id"), p(1).alias("system"), p(2).alias("device_id"),
                            t.alias("topic_type"))
    return (F.when(ota & p(4).isin(*OTA_TYPES), st(F.concat(F.lit("ota_"), p(4))))
            .when(ota, F.lit(None))
            .when((n == 4) & p(3).isin(*TOPIC_TYPES), st(p(3))))


def is_json(payload) -> Column:
    """Whether a text is JSON of any kind (a repeated key is no error)."""
    p = col_of(payload)
    return F.get_json_object(p, "$").isNotNull() | F.try_parse_json(p).isNotNull()


def decode_payload(df: DataFrame, payload: str = "payload", **more: Column) -> DataFrame:
    """Adds ``body`` (object map, last value of a repeated key) and ``_json`` (valid JSON), and ``more``."""
    m = F.from_json(F.col(payload), MAP_SCHEMA)
    raw = with_parsed(df, _map=m, **more)
    return with_parsed(raw, body=keep_last(F.col("_map")), _json=F.col("_map").isNotNull() | is_json(payload)).drop("_map")


def payload_valid(body: Column) -> Column:
    """``device_id`` and ``metrics`` present, metrics a non-empty object."""
    has = lambda k: F.map_contains_key(body, F.lit(k))
    metrics = F.from_json(F.try_element_at(body, F.lit("metrics")), MAP_SCHEMA)
    return has("device_id") & has("metrics") & F.coalesce(F.size(metrics) > 0, F.lit(False))


def timestamp_of(body: Column, fallback) -> dict:
    """S3/X-6: ``COALESCE(payload.timestamp::timestamptz, received_at)``; a present,
    non-null but unparseable timestamp is flagged (the insert would fail)."""
    txt = F.try_element_at(body, F.lit("timestamp"))
    parsed = F.try_to_timestamp(txt).cast("timestamp_ntz")
    return {"ts": F.coalesce(parsed, col_of(fallback)), "bad_ts": txt.isNotNull() & parsed.isNull()}


def classify(messages: DataFrame) -> DataFrame:
    """One projection with parsed topic, decoded body, route and reason.

    route in {measurements, edge_status, edge_config, ota, dropped, rejected};
    reason in {bad_topic, bad_json, not_object, invalid_payload, bad_timestamp,
    unhandled} or NULL for routed rows. The topic's device id wins (X-7).
    """
    tmp = decode_payload(messages, t=parse_topic("topic"))
    body = F.col("body")
    ts = timestamp_of(body, "received_at")
    ttype, system = F.col("t.topic_type"), F.col("t.system")
    valid = payload_valid(body)
    reason = (F.when(F.col("t").isNull(), "bad_topic")
              .when(~F.col("_json"), "bad_json")
              .when(body.isNull(), "not_object")
              .when((ttype == "data") & ~valid, "invalid_payload")
              .when(ttype.isin("data", "status") & ((ttype == "data") | (system == "edge")) & ts["bad_ts"],
                    "bad_timestamp")
              .when(~((ttype == "data") | (system == "edge")), "unhandled"))
    route = (F.when(reason == "unhandled", "dropped").when(reason.isNotNull(), "rejected")
             .when(ttype == "data", "measurements").when(ttype == "status", "edge_status")
             .when(ttype == "config", "edge_config").otherwise("ota"))
    return tmp.select(
        *[c for c in messages.columns],
        F.col("t.site_id").alias("site_id"), F.col("t.system").alias("system"),
        F.col("t.device_id").alias("device_id"), F.col("t.topic_type").alias("topic_type"),
        "body", ts["ts"].alias("ts"), route.alias("route"), reason.alias("reason"))


def to_measurements(classified: DataFrame) -> DataFrame:
    """S3: measurement rows (metrics decoded to a map; location/mac optional)."""
    b = F.col("body")
    rows = classified.where(F.col("route") == "measurements").select(
        "site_id", "system", "device_id",
        F.try_element_at(b, F.lit("location")).alias("location"),
        F.try_element_at(b, F.lit("mac")).alias("mac"),
        "ts", "received_at", F.try_element_at(b, F.lit("metrics")).alias("_metrics"))
    rows = with_parsed(rows, _map=F.from_json("_metrics", MAP_SCHEMA))
    return rows.select("site_id", "system", "device_id", "location", "mac", "ts", keep_last(F.col("_map")).alias("metrics"), "received_at")


def to_edge_status(classified: DataFrame) -> DataFrame:
    """Edge status rows, the whole payload kept as a map."""
    return classified.where(F.col("route") == "edge_status").select(
        "site_id", "device_id", F.col("body").alias("status"), "ts", "received_at")


def to_edge_config(classified: DataFrame) -> DataFrame:
    """Config messages (input of the S5 upsert), with the source's ``seq`` if it has one."""
    return classified.where(F.col("route") == "edge_config").select(
        "site_id", "device_id", F.col("payload").alias("config"), F.col("received_at").alias("updated_at"),
        *[c for c in classified.columns if c == "seq"])


def to_sightings(classified: DataFrame, seq: str = "seq") -> DataFrame:
    """S6 input: device sightings of edge status messages.

    The registry is written before the status row, so a message whose timestamp is refused still
    counts; a message without a model (absent, null or empty) does not."""
    b = F.col("body")
    model = F.try_element_at(b, F.lit("device_model"))
    status = (F.col("topic_type") == "status") & (F.col("system") == "edge") & b.isNotNull()
    return classified.where(status & (F.length(model) > 0)).select(
        "device_id", model.alias("device_model"), F.try_element_at(b, F.lit("firmware_version")).alias("firmware_version"),
        F.col("received_at").alias("seen_at"), F.col(seq).alias("seq"))


def to_ota(classified: DataFrame, seq: str = "seq") -> DataFrame:
    """OTA messages (input of the W9 fold): device_id, kind, received_at, payload and,
    when the source provides one, a stable per-message ``seq`` (e.g. a Kafka offset)
    that orders messages with equal arrival times."""
    extra = [F.col(seq).alias("seq")] if seq in classified.columns else []
    return classified.where(F.col("route") == "ota").select(
        "device_id", F.regexp_replace("topic_type", "^ota_", "").alias("kind"), "received_at", "payload", *extra)


def rejects(classified: DataFrame) -> DataFrame:
    """Dead-letter rows with their reason."""
    return classified.where(F.col("route").isin("rejected", "dropped")).select(
        "topic", "payload", "received_at", "reason")


def archive_raw(messages: DataFrame) -> DataFrame:
    """Raw archive; undecodable payloads are kept as ``{"raw": text}``."""
    ok = is_json("payload")
    return messages.select("received_at", "topic",
                           F.when(ok, F.col("payload")).otherwise(F.to_json(F.struct(F.col("payload").alias("raw"))))
                           .alias("payload"))


def migrate_legacy_topic(topic) -> Column:
    """M5: old 3-level ``site/sensors/location`` topic -> the 4-level data topic
    (the location becomes the device id)."""
    parts = F.split(col_of(topic), "/", -1)
    return F.when(F.size(parts) == 3, F.concat_ws("/", F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2)),
                                                 F.try_element_at(parts, F.lit(3)), F.lit("data")))


def append_measurements(measurements: DataFrame, path: str) -> None:
    """S3: append measurement rows to a Parquet table partitioned by day (``dt``),
    so time filters prune whole folders."""
    measurements.withColumn("dt", F.to_date("ts")).write.mode("append").partitionBy("dt").parquet(path)


def append_edge_status(status: DataFrame, path: str) -> None:
    """Append edge status rows (whole payload kept as a map), partitioned by day."""
    status.withColumn("dt", F.to_date("ts")).write.mode("append").partitionBy("dt").parquet(path)
