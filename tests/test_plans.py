"""Plan properties that carry the design for scale (checked on executed plans)."""

import re
from datetime import datetime

import pytest

import __spark_entry__ as E
from fleetspark.operators import fleet as fl, updates
from fleetspark.operators.rollout import update_decisions
from fleetspark.plans import catalog
from fleetspark.plans.context import Telemetry
from fleetspark.sources import messages as ms
from tools.explain_plans import final_plan

SF = "/root/testdata/sf0.001"


def test_latest_values_aggregate_map_side(spark):
    plan = final_plan(catalog.run("latest_nulls_first", spark, SF))
    assert "partial_max_by" in plan and "Window" not in plan


@pytest.mark.parametrize("name", ["state_intervals", "gap_segments", "update_attempts"])
def test_run_operators_read_input_once(spark, name):
    plan = final_plan(catalog.run(name, spark, SF))
    assert plan.count("FileScan") == 1, plan


def test_literal_as_of_reaches_the_scan(spark):
    t = Telemetry(spark, SF)
    df = fl.power_stats(t.power, datetime(2001, 11, 4), "30 days")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", plan)


def test_ingest_parses_each_payload_once(spark):
    t = Telemetry(spark, SF)
    df = ms.to_measurements(ms.classify(t.messages))
    plan = df._jdf.queryExecution().executedPlan().toString().lower()
    # one decode of the message object (plus the nested metrics object)
    assert plan.count("parse_json") <= 1 and plan.count("structstojson") <= 3


def test_no_cartesian_products(spark):
    for name in sorted(catalog.QUERIES):
        if name.startswith("stream_"):
            continue
        df = E.queries()[name](spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_decisions_do_not_shuffle_the_fleet_by_model(spark):
    t = Telemetry(spark, SF)
    plan = update_decisions(t.devices, t.releases, t.rollouts, t.rollout_targets)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("sha2") <= 8 and "BroadcastHashJoin" in plan
    fleet = plan[plan.index("BroadcastHashJoin"):]
    assert not re.search(r"hashpartitioning\(device_model#\d+, \d+\), ENSURE_REQUIREMENTS[^\n]*\n[^\n]*_bucket", fleet)


def test_attempts_are_folded_in_tasks_that_follow_the_input(spark):
    assert updates.fold_tasks(spark, 100 * updates.TASK_ROWS) == 100 and updates.fold_tasks(spark, 1) == spark.sparkContext.defaultParallelism
    t = Telemetry(spark, SF)
    df = updates.update_attempts(t.ota_messages, "seq", 30 * 86400, tasks=37)
    plan = final_plan(df)
    assert re.search(r"hashpartitioning\(device_id#\d+, _chunk#\d+L?, 37\), REPARTITION_BY_NUM", plan) and "Broadcast" not in plan, plan
    assert sorted(map(str, df.collect())) == sorted(map(str, updates.update_attempts(t.ota_messages, "seq", 30 * 86400).collect()))
