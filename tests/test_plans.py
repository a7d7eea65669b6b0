"""The physical plans keep the shape that scales."""

import re

import pytest

import __spark_entry__ as contract
from conftest import SF_DIR, plan_of
from doselake.plans import facts, silver
from doselake.registry import MEASURE_SLICERS

UNSPLIT = re.compile(r"CartesianProduct|CrossJoin")


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_no_cross_join_and_no_row_python(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    assert not UNSPLIT.search(plan), plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "BroadcastNestedLoopJoin" not in plan, plan


def test_dedup_combines_before_its_only_shuffle(lake):
    plan = plan_of(silver.live_documents(lake.bronze))
    below_shuffle = plan[plan.index("Exchange hashpartitioning(co_documento"):]
    assert "partial_max" in below_shuffle and "Window" not in plan
    assert plan.count("Exchange") == 1
    assert "PushedFilters: [IsNull(dt_deletado_rnds)]" in plan


def test_silver_shuffles_once(lake):
    plan = plan_of(silver.doses_aplicadas(lake.bronze, lake.uf_ibge))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_fact_counts_before_its_only_shuffle(lake):
    plan = plan_of(facts.fct_cobertura_vacinal(lake.silver, lake.bands))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "partial_count" in plan
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    read = scan[scan.index("ReadSchema"):]
    assert "idade_paciente" in read
    # Only the key columns are read.
    assert "co_pais_paciente" not in read and "codigo_documento" not in read


def test_mart_joins_by_broadcast_while_dimensions_are_small(lake):
    plan = plan_of(facts.mart_cobertura_vacinal(lake.star))
    assert plan.count("BroadcastHashJoin") == 6
    assert "Exchange hashpartitioning" not in plan


def test_mart_without_broadcast_still_builds(spark, lake):
    expected = facts.mart_cobertura_vacinal(lake.star).count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        wide = facts.mart_cobertura_vacinal(lake.star)
        plan = plan_of(wide)
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert wide.count() == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(MEASURE_SLICERS))
def test_measures_sum_the_fact_before_joining(lake, name):
    """Between a scan of the fact and the first join lies a partial aggregate."""
    from doselake.plans import measures

    plan = plan_of(measures.measure(lake.star, name, MEASURE_SLICERS[name]))
    for block in re.split(r"(?=FileScan parquet)", plan)[1:]:
        columns = block[: block.index("]")]
        if "qtd_doses" in columns:
            above = plan[: plan.index(block)].rstrip(" :+-*()0123456789\n")
            assert above.splitlines()[-1].count("partial_sum") == 1, plan


def test_columns_of_the_fact_are_pruned(lake):
    from doselake.plans import measures

    plan = plan_of(measures.measure(lake.star, "d01", ["uf"]))
    scan = next(l for l in plan.splitlines() if "FileScan parquet" in l and "qtd_doses" in l)
    assert scan[scan.index("ReadSchema"):].count(":") == 3  # label and two columns
