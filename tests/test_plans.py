"""Physical-plan checks: pushdown, pruning, and the shapes chosen for scale."""

import datetime as dt

import pytest

import __spark_entry__ as entry
from cataloom.plans import campaign as C
from cataloom.plans.campaign_analog import analog_tables

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def q():
    return entry.queries()


def test_filter_pushed_to_scan(spark, q):
    plan = plan_of(q["scan_filter_prefix"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan


def test_columns_pruned_before_join(spark, q):
    df = q["flagship_revenue_by_segment"](spark, SF)
    plan = plan_of(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in plan
    assert "l_comment" not in plan and "l_shipdate" not in plan


def test_range_join_is_an_equi_join(spark, q):
    plan = plan_of(q["join_theta"](spark, SF))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "HashJoin" in plan or "SortMergeJoin" in plan


def test_latest_per_group_reads_once_and_limits_groups_early(spark, q):
    plan = plan_of(q["latest_per_group"](spark, SF))
    assert plan.count("FileScan parquet") <= 2  # the adaptive plan shows its initial plan too
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Join" not in plan
    from cataloom.operators.aggregate import latest_per_group

    orders = spark.read.parquet(f"{SF}/orders.parquet")
    keys, order = ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"]
    plan = plan_of(latest_per_group(orders, keys, order, method="join_back"))
    # winners are checkpointed: the final step is a semi-join of two shuffles
    assert "Window" not in plan and "SortAggregate" not in plan
    assert "LeftSemi" in plan and "ExistingRDD" in plan
    assert "partial_max" in plan_of(latest_per_group(orders, keys, order, method="join_back", materialize_winners=False))


def test_fk_edges_reads_a_table_once(spark, q):
    plan = q["fk_edges"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") and plan.count("Relation [l_") == 1 and plan.count("Relation [n_") <= 2


def test_campaign_reads_claims_once_and_prunes(spark):
    t = analog_tables(spark, "/root/testdata/sf0.01")
    opts = C.CampaignOptions(as_of=dt.date(2001, 11, 29))
    plan = C.run_campaign(t, opts, ["MBR_OPPTY_GID", "MINOR_IND"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_") == 1
    full = C.enriched_table(t, opts, ["PHMCY_ZIW_ROW_ID", C.MEMBER])
    assert full.columns == ["PHMCY_ZIW_ROW_ID", C.MEMBER]


def test_duplicates_shuffle_digests_only(spark, q):
    plan = plan_of(q["find_duplicates"](spark, SF))
    assert "sha2" in plan and "partial_count" in plan


def test_no_cross_join_anywhere(spark, q):
    for name in ["auto_join_3", "auto_join_diamond", "join_full", "join_composite", "agg_join_back",
                 "fk_edges", "density_kde", "categorical_columns"]:
        plan = plan_of(q[name](spark, SF))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_campaign_enriched_is_checkpointed(spark):
    t = analog_tables(spark, "/root/testdata/sf0.01")
    enriched = C.enriched_table(t, C.CampaignOptions(as_of=dt.date(2001, 11, 29)))
    plan = plan_of(enriched)
    assert "lineitem" not in plan  # lineage cut: reads the checkpoint, not the scans


def test_member_tables_are_never_hinted(spark):
    t = analog_tables(spark, "/root/testdata/sf0.01")
    opts = C.CampaignOptions(as_of=dt.date(2001, 11, 29), checkpoint_enriched=False)
    enriched = C.enrich(C.latest_claims(C.claim_base(t, opts)), t, opts)
    logical = enriched._jdf.queryExecution().analyzed().toString()
    # hints are placed on client/pharmacy/plan dimensions only
    assert logical.count("ResolvedHint") <= 3
