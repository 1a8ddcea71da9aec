"""Bound telemetry tables of one scale factor, shared by the registered queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetspark import bindings as B


class Telemetry:
    """Lazy telemetry tables over the driver tables in ``sf_dir``.

    ``*_as_of`` are scalar subqueries (max time of the table), evaluated by
    Spark once per query; nothing is collected to the driver.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.src = B.Source(spark, sf_dir)
        self.spark = self.src.spark

    @cached_property
    def measurements(self) -> DataFrame:
        return B.measurements(self.src)

    @cached_property
    def power(self) -> DataFrame:
        return B.power_measurements(self.src)

    @cached_property
    def devices(self) -> DataFrame:
        return B.devices(self.src)

    @cached_property
    def updates(self) -> DataFrame:
        return B.update_status(self.src)

    @cached_property
    def releases(self) -> DataFrame:
        return B.firmware_releases(self.src)

    @cached_property
    def rollouts(self) -> DataFrame:
        return B.rollout_configurations(self.src, self.releases)

    @cached_property
    def rollout_targets(self) -> DataFrame:
        return B.rollout_targets(self.src, self.releases)

    @cached_property
    def status(self) -> DataFrame:
        return B.edge_status(self.src)

    @cached_property
    def messages(self) -> DataFrame:
        return B.raw_messages(self.src)

    @cached_property
    def ota_messages(self) -> DataFrame:
        return B.update_messages(self.src)

    @cached_property
    def power_raw(self) -> DataFrame:
        return B.power_raw(self.src)

    # as_of scalars ------------------------------------------------------
    def max_of(self, table: str, col: str) -> Column:
        return self.src.table(table).agg(F.max(col)).scalar()

    @property
    def events_as_of(self) -> Column:
        return self.max_of("events", "ts")

    @property
    def lineitem_as_of(self) -> Column:
        return self.max_of("lineitem", "l_shipdate")

    @property
    def orders_as_of(self) -> Column:
        return self.max_of("orders", "o_orderdate")
