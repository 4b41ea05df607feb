"""What the physical plans must look like."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.operators import keyed as K
from millrace.operators import security as S
from millrace.plans import REGISTRY
from millrace.plans import relational as plans
from millrace.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, FOLDER)


def explain(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_predicates_and_columns_reach_the_scan(t):
    plan = explain(plans.filter_in_range(t))
    assert "PushedFilters" in plan and "GreaterThanOrEqual(l_quantity,10.0)" in plan
    assert "l_comment" not in plan and "l_tax" not in plan


def test_policy_reaches_the_scan(t):
    assert "EqualTo(o_custkey,42)" in explain(S.owned_by(t.orders, "o_custkey", 42))


def test_per_key_rank_is_cut_before_the_shuffle(t):
    plan = explain(plans.recent_orders(t))
    assert plan.index("WindowGroupLimit") and "Partial" in plan


def test_global_top_k_does_not_sort_everything(t):
    assert "TakeOrderedAndProject" in explain(plans.top_k(t))


def test_small_side_is_broadcast_and_sized(t):
    assert "BroadcastHashJoin" in explain(plans.federated_join(t))


def test_merge_moves_only_the_change_keys(t):
    small = t.orders.filter("o_orderkey < 10")
    plan = explain(cdc.merge_upsert(t.orders, small, ["o_orderkey"]))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_no_query_plans_a_cross_product(spark, t):
    skip = {"knn_ivf", "knn_ivf_all_cells"} | {n for n in REGISTRY if n.startswith("stream_")}
    for name, q in REGISTRY.items():
        if name not in skip:
            plan = explain(q.run(t))
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_rank_filter_is_not_a_single_task_window(t):
    ranked = K.last_n_per_key(t.orders, ["o_custkey"], [F.col("o_orderdate").desc()], 3)
    assert "hashpartitioning(o_custkey" in explain(ranked)


def test_large_change_log_is_folded_in_one_shuffle(t):
    plan = explain(REGISTRY["apply_changes"].run(t)).split("\n\n")[0]
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_history_reads_and_comparisons_shuffle_once_per_table(t):
    for name, shuffles in (("as_of", 1), ("current_from_history", 1), ("restore_rows", 2), ("take_versions", 2),
                           ("snapshot_equal", 1)):
        tree = explain(REGISTRY[name].run(t)).split("\n\n")[0]
        assert tree.count("Exchange") <= shuffles, name
