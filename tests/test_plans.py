"""Plan checks: what must never appear in a plan that runs at scale."""

import pytest

from spendstar.plans.queries import QUERIES

from .conftest import SF001

FORBIDDEN = (
    "CartesianProduct",          # cross joins
    "BroadcastNestedLoopJoin",   # non-equi / cross joins
    "BatchEvalPython",           # row-at-a-time Python UDFs
    "ArrowEvalPython",           # pandas UDFs (none needed)
    "FlatMapGroupsInPandas",
    "MapInPandas",
)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_forbidden_operators(spark, key):
    plan = _plan(QUERIES[key](spark, SF001))
    for name in FORBIDDEN:
        assert name not in plan, f"{key} plans a {name}"


def test_fact_scan_is_pruned_and_dimensions_broadcast(spark):
    from spendstar.plans.queries import Build

    build = Build(spark, SF001)
    fact = build.gold.fact
    full = fact._jdf.queryExecution().toString()
    # the grain table stores campaign_name 4th; the fact's scan skips it
    assert "ReadSchema: struct<event_date:date,channel:string,campaign_id:string,impressions:bigint" in full
    plan = _plan(fact)
    assert plan.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in plan.split("BroadcastExchange")[0]  # fact side: no shuffle
    from spendstar.operators.fact import aggregate_grain

    grain_plan = _plan(aggregate_grain(build.silver))
    assert "partial_sum" in grain_plan and "partial_min" in grain_plan


def test_raw_scan_reads_only_needed_columns(spark):
    from spendstar.plans.queries import Build

    full = Build(spark, SF001).silver._jdf.queryExecution().toString()
    read = full.split("ReadSchema: struct<")[1].split(">")[0]
    assert "l_discount" not in read and "l_comment" not in read and "l_returnflag" not in read
