"""Firmware artifact inventory from a folder of ``{model}_{version}.bin`` files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The slug rule for model and version names.
SLUG = r"^[A-Za-z0-9._-]+$"


def firmware_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Name parts, size, SHA-256 and slug check per artifact (binaryFile source;
    the content column is read only for the digest)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder)
    name = F.regexp_extract("path", r"([^/]+)\.bin$", 1)
    model = F.regexp_extract(name, r"^(.*)_([^_]*)$", 1)
    version = F.regexp_extract(name, r"^(.*)_([^_]*)$", 2)
    return df.select(
        F.col("path"), model.alias("device_model"), version.alias("version"),
        F.col("length").alias("file_size"), F.sha2(F.col("content"), 256).alias("checksum_sha256"),
        (model.rlike(SLUG) & version.rlike(SLUG)).alias("valid_name"),
        F.col("modificationTime").alias("created_at"))


def upload_events(inventory: DataFrame) -> DataFrame:
    """S8 (upload path): a ``firmware_uploaded`` event per valid artifact."""
    return inventory.where("valid_name").select(
        F.lit("firmware_uploaded").alias("event_type"), F.lit(None).cast("string").alias("device_id"),
        F.col("version").alias("firmware_version"),
        F.to_json(F.struct("device_model", "file_size", "checksum_sha256")).alias("event_data"))
