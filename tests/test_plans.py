"""Physical-plan properties that matter at scale."""

import pytest

from bomspark.plans import registry
from conftest import SF_SMALL

QUERIES = registry.QUERIES
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_or_row_udfs(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name} plans {bad}"


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(QUERIES["serial_join"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("name", ["latest_per_key", "best_per_child", "best_per_child_expanded"])
def test_top1_is_limited_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_distinct_count_is_pre_aggregated(spark):
    plan = plan_of(QUERIES["config_counts"](spark, SF_SMALL))
    assert "partial_count(distinct" in plan


def test_core_stages_stay_in_the_jvm(spark):
    for name in ["serial_join", "config_engine_count", "latest_per_key", "expand_children",
                 "best_per_child"]:
        plan = plan_of(QUERIES[name](spark, SF_SMALL))
        assert "Python" not in plan and "Arrow" not in plan, name


INGESTS = ["ingest_bom_option", "ingest_bom_config", "ingest_option_child", "read_delimited"]


@pytest.mark.parametrize("name", INGESTS)
def test_a_drop_is_scanned_once_and_a_line_split_once(spark, name):
    """One scan, in Arrow batches, whatever the files' dialects; fields are resolved, trimmed
    and filtered in the JVM, from a split that the optimizer has not copied."""
    df = QUERIES[name](spark, SF_SMALL)
    plan = plan_of(df).split("== Initial Plan ==")[0]
    assert plan.count("MapInArrow _read_ranges") == 1
    assert "EvalPython" not in plan and "MapInPandas" not in plan and "IN (" not in plan
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("split(value") == 1, optimized


def scans(df):
    return plan_of(df).split("== Initial Plan ==")[0].count("FileScan")


def test_diagnostics_read_each_table_once(spark):
    assert scans(QUERIES["key_overlap"](spark, SF_SMALL)) == 2
    assert scans(QUERIES["key_case_examples"](spark, SF_SMALL)) == 2


def test_rollup_runs_the_serial_join_once(spark):
    # keyed was written: the count and the join-back read that table, not lineitem
    plan = plan_of(QUERIES["config_engine_count"](spark, SF_SMALL))
    assert "lineitem" not in plan and "orders" not in plan


def test_stage_audit_computes_nothing_to_count_it(spark):
    """The audit is made of numbers observed while the stages were written."""
    df = QUERIES["stage_audit"](spark, SF_SMALL)
    assert scans(df) == 0 and "Aggregate" not in plan_of(df)


def test_rows_of_a_drop_are_not_broadcast(spark, tmpdir_path):
    """Their size is unknown before they are read: only the file tables are broadcast."""
    from bomspark.operators import best_per_child_from_parts, latest_per_key, serial_join
    from bomspark.sources import ingest as IG
    from conftest import write_file
    for name, header, row in (("option", "shop_order_num,engine_serial_num,option_assembly_num", "1,S,O"),
                              ("config", "engine_serial_num,design_config_num,build_year", "S,D,2020"),
                              ("child", "option_no,child_part", "O,C")):
        write_file(f"{tmpdir_path}/{name}", "a_2020.csv", f"{header}\n{row}\n")
    option = IG.ingest_bom_option(spark, f"{tmpdir_path}/option", with_period=False)
    joined = serial_join(option, IG.ingest_bom_config(spark, f"{tmpdir_path}/config"))
    plan = plan_of(joined).split("== Initial Plan ==")[0]
    assert "SortMergeJoin [_serial" in plan and plan.count("BroadcastExchange") == 2
    assert [tuple(r) for r in joined.collect()] == [("S", "O", "D", "1", 2020)]
    rollup = spark.createDataFrame([(1, "O", "D_1", 2020)], "Engine_serial_count long, option_assembly_num "
                                   "string, esn_config_design_config_Shop_order_num string, build_year int")
    best = best_per_child_from_parts(rollup, latest_per_key(rollup),
                                     IG.ingest_option_child(spark, f"{tmpdir_path}/child"))
    plan = plan_of(best).split("== Initial Plan ==")[0]
    assert "SortMergeJoin [_copt" in plan
    assert [tuple(r) for r in best.collect()] == [(1, "O", "D_1", 2020, "C")]
