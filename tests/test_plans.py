"""Plan-shape guards for the scale properties the design relies on."""

import pytest

from conftest import SF_SMALL
from itemwise.plans import catalog
from itemwise.plans.similarity import item_similarity
from itemwise.sources import fixtures as fx


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - {"partition_overwrite", "job_source_recom",
                                                             "job_scored_list", "job_by_table_name",
                                                             "partition_rerun_failure"}))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_similarity_plan(spark):
    plan = _plan(item_similarity(fx.order_interactions(spark, SF_SMALL), catalog.PROD))
    # top-N is cut map-side before its shuffle
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # the salted self-join shuffles both sides on user and both block ids,
    # with an explicit partition count sized by the pairs it will emit
    salted = [l for l in plan.splitlines()
              if "Exchange hashpartitioning(user_id" in l and "k1" in l and "k2" in l]
    assert len(salted) >= 2 and all("REPARTITION_BY_NUM" in l for l in salted)
    # pairs are combined map-side
    assert "partial_count" in plan


def test_recommend_plan_cuts_per_user(spark):
    plan = _plan(catalog.q_recommend_labelled(spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "partial_sum" in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(fx.order_interactions(spark, SF_SMALL))
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l and "lineitem" in l]
    assert scans and all("l_extendedprice" not in l and "l_shipdate" not in l for l in scans)
