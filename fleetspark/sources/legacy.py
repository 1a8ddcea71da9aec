"""Legacy flat sensor messages: strict validation (P4) and migration (M5).

Old messages are flat JSON objects on 3-level topics ``site/sensors/location``.
JSON value types are read from a Variant (``try_parse_json`` +
``schema_of_variant``), so ``21`` (int) and ``21.5`` (float) are told apart
exactly as Python's ``isinstance`` does, including bool counting as int.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetspark.functions.util import col_of
from fleetspark.sources.messages import migrate_legacy_topic

# Required fields of a flat sensor message and their accepted types,
# in the order they are checked.
REQUIRED_FLAT = (
    ("sensor_id", ("str",)),
    ("temperature_c", ("int", "float")),
    ("humidity_percent", ("int", "float")),
    ("pressure_hpa", ("int", "float")),
    ("battery_mv", ("int",)),
)
# Optional integer fields carried into metrics on migration.
OPTIONAL_FLAT = ("acceleration_x_mg", "acceleration_y_mg", "acceleration_z_mg", "acceleration_total_mg",
                 "tx_power_dbm", "movement_counter", "measurement_sequence")


# Variant type family -> Python type name.
_PY_TYPES = {"STRING": "str", "BOOLEAN": "bool", "TINYINT": "int", "SMALLINT": "int", "INT": "int",
             "BIGINT": "int", "DECIMAL": "float", "DOUBLE": "float", "FLOAT": "float", "VOID": "NoneType",
             "OBJECT": "dict", "ARRAY": "list"}


def json_type_name(v: Column) -> Column:
    """Python type name of a Variant value (str, int, float, bool, NoneType, dict, list);
    NULL when the value is absent. DECIMAL(p,0) (integers beyond BIGINT) is int."""
    t = F.schema_of_variant(v)
    family = F.regexp_extract(t, r"^([A-Z]+)", 1)
    lookup = F.try_element_at(F.create_map(*[F.lit(x) for kv in _PY_TYPES.items() for x in kv]), family)
    return F.when(t.endswith(",0)"), F.lit("int")).otherwise(F.coalesce(lookup, F.lower(family)))


def validate_flat(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``ok`` and ``error`` -- the first failing rule, in field order.

    Staged projections (parse once, then one type name per field, then the
    error) keep each generated method small enough for whole-stage codegen.
    """
    v = df.select("*", F.try_parse_json(col_of(payload)).alias("_v"))
    names = [n for n, _ in REQUIRED_FLAT]
    typed = v.select("*", *[json_type_name(F.try_variant_get("_v", f"$.{n}", "variant")).alias(f"_t_{n}")
                            for n in names])
    err = None
    for name, types in REQUIRED_FLAT:
        tn = F.col(f"_t_{name}")
        accepted = list(types) + (["bool"] if "int" in types else [])
        wrong = F.concat(F.lit(f"Field '{name}' has incorrect type: expected {' or '.join(types)}, got "), tn)
        step = F.when(tn.isNull(), F.lit(f"Missing required field: {name}")).when(~tn.isin(*accepted), wrong)
        err = step if err is None else F.coalesce(err, step)
    err = F.when(F.col("_v").isNull(), F.lit("Invalid JSON")).otherwise(err)
    return (typed.withColumn("error", err).withColumn("ok", F.col("error").isNull())
            .drop("_v", *[f"_t_{n}" for n in names]))


def migrate_legacy_message(df: DataFrame, topic: str = "topic", payload: str = "payload",
                           received_at: str = "received_at", site_system: str = "sensors",
                           extra_cols=()) -> DataFrame:
    """M5: old topic + flat JSON -> a new-style measurement row when P4 passes.

    device_id = sensor_id, system from the topic (the old ``sensors`` level is the
    sensor system), metrics = every numeric field except sensor_id/mac/timestamp
    as a map, location = the old third topic level. Rows failing P4 or with a
    topic that is not 3 levels are returned with ``error`` set.
    """
    df = validate_flat(df, payload)
    body = F.from_json(col_of(payload), "map<string,string>")
    metrics = F.map_filter(body, lambda k, _v: ~k.isin("sensor_id", "mac", "timestamp"))
    new_topic = migrate_legacy_topic(topic)
    parts = F.split(col_of(topic), "/", -1)
    ts_txt = F.try_element_at(body, F.lit("timestamp"))
    err = F.when(new_topic.isNull(), F.lit("Not a legacy topic")).otherwise(F.col("error"))
    return df.select(
        F.try_element_at(parts, F.lit(1)).alias("site_id"),
        F.lit(site_system).alias("system"),
        F.try_element_at(body, F.lit("sensor_id")).alias("device_id"),
        F.try_element_at(parts, F.lit(3)).alias("location"),
        F.try_element_at(body, F.lit("mac")).alias("mac"),
        F.coalesce(F.try_to_timestamp(ts_txt).cast("timestamp_ntz"), F.col(received_at)).alias("ts"),
        metrics.alias("metrics"),
        err.alias("error"), *[c for c in extra_cols])
