"""Plan-shape tests: the physical operators each query is meant to get."""

from pyspark.sql import functions as F

import __spark_entry__ as E
import pytest

from lakeforge.plans.inspect import explain_text


def q(spark, sf, name):
    return E.queries()[name](spark, sf)


def test_broadcast_hint_gives_broadcast_hash_join(spark, sf):
    assert "BroadcastHashJoin" in explain_text(q(spark, sf, "jn_10_broadcast_hint"))
    assert "BroadcastHashJoin" in explain_text(q(spark, sf, "jn_11_sql_broadcast_hint"))


def test_merge_hint_gives_sort_merge_join(spark, sf):
    text = explain_text(q(spark, sf, "jn_12_sort_merge_hint"))
    assert "SortMergeJoin" in text


def test_shuffle_hash_hint(spark, sf):
    assert "ShuffledHashJoin" in explain_text(q(spark, sf, "jn_13_shuffle_hash_hint"))


def test_full_outer_is_not_broadcast(spark, sf):
    text = explain_text(q(spark, sf, "jn_04_full_outer"))
    assert "BroadcastHashJoin" not in text


def test_rank_filter_gets_window_group_limit(spark, sf):
    assert "WindowGroupLimit" in explain_text(q(spark, sf, "wn_03_top_n_per_group"))
    assert "WindowGroupLimit" in explain_text(q(spark, sf, "wn_02_latest_per_key_sql"))


def test_latest_per_key_is_an_aggregate_not_a_window(spark, sf):
    text = explain_text(q(spark, sf, "wn_01_latest_per_key"))
    assert "Window" not in text.replace("WindowGroupLimit", "")
    assert "partial_max" in text


def test_top_k_without_full_sort(spark, sf):
    assert "TakeOrderedAndProject" in explain_text(q(spark, sf, "st_04_global_top_k"))


def test_date_filter_pushed_to_scan(spark, sf):
    text = explain_text(q(spark, sf, "flt_07_date_pushdown"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text


def test_projection_prunes_read_schema(spark, sf):
    text = explain_text(q(spark, sf, "prj_03_with_columns"))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double,c_mktsegment:string>" in text
    text = explain_text(q(spark, sf, "flt_01_column_equality"))
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text


def test_select_expr_filter_on_dropped_columns_is_pushed(spark, sf):
    text = explain_text(q(spark, sf, "prj_04_select_expr"))
    assert "EqualTo(c_mktsegment,FURNITURE)" in text


@pytest.mark.parametrize("name", ["flt_02_sql_string_where", "flt_03_boolean_membership", "prj_03_with_columns", "prj_04_select_expr",
                                  "prj_09_automobile_in_debt", "ex_02_sql_function_cte_params"])
def test_balance_predicates_reach_the_scan(spark, sf, name):
    pushed = [line for line in explain_text(q(spark, sf, name)).splitlines() if "PushedFilters" in line]
    assert any("Than" in line and "(c_acctbal," in line for line in pushed), pushed


def test_aggregate_is_partial_then_final(spark, sf):
    text = explain_text(q(spark, sf, "ag_13_count_shorthand"))
    assert "partial_count" in text and "Exchange" in text


def test_repartition_plans(spark, sf):
    from lakeforge.sources.tables import raw
    c = raw(spark, sf, "customer")
    assert "RoundRobinPartitioning(8)" in explain_text(c.repartition(8))
    assert "hashpartitioning(c_nationkey" in explain_text(c.repartition(8, "c_nationkey"))
    coalesced = explain_text(c.repartition(8).coalesce(2), "simple")
    assert "Coalesce 2" in coalesced and coalesced.count("Exchange") == 1
    assert "rangepartitioning(c_acctbal" in explain_text(c.repartitionByRange(4, "c_acctbal"))


def test_dimension_broadcast_only_for_bounded_tables(spark, sf):
    text = explain_text(q(spark, sf, "jn_09_star_join"))
    assert "BroadcastHashJoin" in text          # nation (25 rows by the model)
    from lakeforge.operators.relational import dimension
    from lakeforge.sources.tables import raw
    c = raw(spark, sf, "customer")
    assert dimension(c, "customer") is c        # never hinted


def test_upsert_small_source_does_not_shuffle_target(spark, sf):
    text = explain_text(q(spark, sf, "up_01_merge_upsert"))
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_scan_uses_vectorized_codegen(spark, sf):
    df = q(spark, sf, "ag_18_customers_by_nation")
    df.collect()                                   # final adaptive plan
    text = explain_text(df, "simple")
    assert "*(" in text and "ColumnarToRow" in text and "HashAggregate" in text


def test_nation_figures_do_not_expand_rows(spark, sf):
    """One exact distinct count next to other aggregates needs no Expand."""
    text = explain_text(q(spark, sf, "ag_01_grouped_multi_aggregate"), "simple")
    assert "Expand" not in text and text.count("Exchange hashpartitioning") == 2