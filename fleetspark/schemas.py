"""Typed schemas of the telemetry tables (subset used by schema alignment)."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField, StructType,
                               TimestampNTZType)

_INT = ("soc_percent", "remain_time_min", "watts_in_sum", "watts_out_sum", "ac_out_watts", "dc_out_watts",
        "typec_out_watts", "usb_out_watts", "pv_in_watts", "car_watts", "bms_cycles")
_NUM = ("inv_out_temp", "bms_temp", "mppt_temp", "inv_input_watts", "bms_vol", "bms_amp")

# The power table: key, time, INTEGER watts (rounded on assignment) and NUMERIC readings.
POWER_SCHEMA = StructType(
    [StructField("device_sn", StringType()), StructField("ts", TimestampNTZType())]
    + [StructField(c, IntegerType()) for c in _INT]
    + [StructField(c, DoubleType()) for c in _NUM])
