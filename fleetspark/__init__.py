"""fleetspark: device-fleet telemetry analytics as plain Spark DataFrame functions.

Sub-packages:
  sources/    message and snapshot readers, table writers (append, upsert, export)
  functions/  column expressions (JSON access, predicates, formatting, hashing)
  operators/  DataFrame -> DataFrame operators (buckets, latest values, runs,
              fleet metrics, rollouts, power transforms, update attempts, alerts)
  plans/      registered queries over the driver tables and their SQL oracles
  streaming/  Structured Streaming forms of ingest, bucketing and update tracking
"""

__version__ = "0.1.0"
