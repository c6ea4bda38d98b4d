"""Physical-plan properties the design relies on at scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from mediapanel.plans.chain import Chain

from .conftest import SMALL

from mediapanel.plans.registry import QUERIES as OWN  # noqa: E402

QUERIES = {n: q for n, q in E.queries().items() if n in OWN}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_python_or_sort_aggregate_in_plan(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
               "SortAggregate"):
        assert op not in plan, f"{name}: {op}"


def test_dedup_uses_window_group_limit_and_partial_aggregates(spark):
    c = Chain(spark, SMALL, cache_marts=False)
    stg = _plan(c.stg_platform_sales)
    assert stg.count("WindowGroupLimit") >= 2                 # partial before and final after the shuffle
    fact = _plan(c.fact_onplatform_ads)
    assert "partial_sum" in fact                              # map-side partial aggregation


def test_column_pruning_reaches_the_scan(spark):
    c = Chain(spark, SMALL, cache_marts=False)
    plan = _plan(c.fact_platform_sales)
    assert "o_totalprice" not in plan and "o_orderpriority" not in plan and "c_acctbal" not in plan


def test_panel_scan_prunes_date_partitions(spark, tmp_path):
    c = Chain(spark, SMALL, cache_marts=False)
    c.materialize(str(tmp_path), names=("fact_platform_sales", "fact_onplatform_ads", "fact_offplatform_ads",
                                        "fact_evc", "panel"))
    plan = _plan(c.scan)
    assert "PartitionFilters: [isnotnull(date_local" in plan and "date_local#" in plan


def test_bronze_refresh_prunes_ingest_partitions(spark, tmp_path):
    from dataclasses import replace
    c = Chain(spark, SMALL, cache_marts=False)
    c.land_bronze(str(tmp_path))
    inc = Chain(spark, SMALL, replace(c.p, refresh_days=21), cache_marts=False)
    inc.raw = c.raw
    plan = _plan(inc.stg_onplatform_ads)
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
