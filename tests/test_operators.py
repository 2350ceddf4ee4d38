"""Operator semantics on small hand-made frames, and pipeline properties."""

import pytest
from pyspark.sql import functions as F

from bomspark import schemas as S
from bomspark.operators import (best_per_child, best_per_child_from_parts, build_order_key,
                                config_engine_counts, expand_children, latest_per_key,
                                serial_join)
from bomspark.operators.audit import key_overlap, reconcile
from bomspark.plans import run_workflow
from bomspark.sources import tables as TB
from conftest import SF_SMALL


def keyed_df(spark, rows):
    return spark.createDataFrame(rows, S.KEYED)


def test_key_is_null_when_a_part_is_null(spark):
    sj = spark.createDataFrame([("1", "O1", None, "5", 2020), ("2", "O1", "DC", None, 2020),
                                ("3", "O1", "DC", "7", 2020)], S.SERIAL_JOIN)
    got = sorted((r[S.ENGINE_SERIAL], r[S.KEY]) for r in build_order_key(sj).collect())
    assert got == [("1", None), ("2", None), ("3", "DC_7")]


def test_distinct_engines_per_config_id(spark):
    k = keyed_df(spark, [
        ("S1", "O1", "DC1_1", 2020), ("S1", "O2", "DC1_2", 2020),   # repeated serial: once
        ("S2", "O1", "DC1_3", 2021), (None, "O3", "DC1_4", 2021),   # NULL serial not counted
        ("S3", "O1", "A_B_C", 2020),                                # config cut at first '_'
        ("S4", "O1", None, 2020)])                                  # NULL key: dropped
    out = config_engine_counts(k)
    got = sorted((r[S.KEY], r[S.COUNT]) for r in out.collect())
    assert got == [("A_B_C", 1), ("DC1_1", 2), ("DC1_2", 2), ("DC1_3", 2), ("DC1_4", 2)]


def test_latest_per_key_deterministic_tie_break(spark):
    r = spark.createDataFrame([(3, "OPT9", "K", 2020), (3, "OPT1", "K", 2020),
                               (3, "OPT0", "K", 2019), (5, "OPT5", "J", None),
                               (2, "OPT2", "J", 2018)], S.ROLLUP)
    got = sorted((x[S.KEY], x[S.OPTION]) for x in latest_per_key(r).collect())
    assert got == [("J", "OPT2"), ("K", "OPT1")]   # NULL year sorts last


def test_best_per_child_text_years_sort_last(spark):
    e = spark.createDataFrame([("3", "O1", "K1", "abc", "C"), ("1", "O2", "K2", "2001", "C"),
                               ("9", "O3", "K3", None, "C"), ("2", "O4", "K4", "2020.0", None)],
                              "Engine_serial_count string, option_assembly_num string, "
                              "esn_config_design_config_Shop_order_num string, build_year string, "
                              "Child_Part_Number string")
    got = sorted(((x[S.CHILD] or ""), x[S.KEY]) for x in best_per_child(e).collect())
    assert got == [("", "K4"), ("C", "K2")]


def test_duplicate_child_rows_multiply_expansion(spark):
    r = spark.createDataFrame([(1, "O1", "K", 2020), (1, "O2", "K", 2019)], S.ROLLUP)
    child = spark.createDataFrame([("O1", "C1"), ("O1", "C1"), ("O2", "C2")], S.CHILD_PART_OPTION)
    out = expand_children(r, latest_per_key(r), child, source_option=True)
    got = sorted((x[S.OPTION], x["source_option"], x[S.CHILD]) for x in out.collect())
    # representative option is the latest row's (O1), even for the child of O2
    assert got == [("O1", "O1", "C1"), ("O1", "O1", "C1"), ("O1", "O2", "C2")]


def test_child_option_column_synonyms_at_join(spark):
    r = spark.createDataFrame([(1, "O1", "K", 2020)], S.ROLLUP)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("\ufeffOPTION_NUM", T.StringType()),
                           T.StructField("Child_Part_Number", T.StringType())])
    child = spark.createDataFrame([("O1", "C1")], schema)
    assert expand_children(r, latest_per_key(r), child).count() == 1


def test_best_from_parts_equals_ranked_expansion(spark):
    opt, cfg, child = (TB.bom_option(spark, SF_SMALL), TB.bom_config(spark, SF_SMALL),
                       TB.child_part_option(spark, SF_SMALL))
    r = run_workflow(opt, cfg, child)
    a = r.best_per_child.exceptAll(best_per_child(r.expanded)).count()
    b = best_per_child(r.expanded).exceptAll(r.best_per_child).count()
    assert a == 0 and b == 0


def test_per_period_union_equals_single_run(spark):
    """The serial join + key distribute over UNION ALL of option periods."""
    opt, cfg = TB.bom_option(spark, SF_SMALL), TB.bom_config(spark, SF_SMALL)
    whole = build_order_key(serial_join(opt, cfg))
    years = [r[0] for r in opt.select("build_year_2").distinct().collect()]
    parts = None
    for y in years:
        p = build_order_key(serial_join(opt.where(F.col("build_year_2") == y), cfg))
        parts = p if parts is None else parts.unionByName(p)
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0


def test_one_row_per_key_and_per_child(spark):
    opt, cfg, child = (TB.bom_option(spark, SF_SMALL), TB.bom_config(spark, SF_SMALL),
                       TB.child_part_option(spark, SF_SMALL))
    r = run_workflow(opt, cfg, child)
    assert r.latest.groupBy(S.KEY).count().where("count > 1").count() == 0
    assert r.best_per_child.groupBy(S.CHILD).count().where("count > 1").count() == 0
    assert r.latest.count() == 1036 and r.expanded.count() == 11810 and r.best_per_child.count() == 340


def test_key_overlap_and_reconcile(spark):
    a = spark.createDataFrame([("ab",), ("AB",), ("x",), (None,)], "k string")
    b = spark.createDataFrame([("ab",), ("y",), ("X",)], "k string")
    row = key_overlap(a, b, "k").collect()[0]
    assert (row.left_keys, row.right_keys, row.common_keys, row.common_keys_ignore_case) == (3, 3, 1, 2)
    rc = reconcile(a, b).collect()[0]
    assert (rc.expected_rows, rc.actual_rows, rc.match) == (4, 3, False)


def test_write_outputs_counts_by_observation(spark, tmpdir_path):
    from bomspark.plans import write_outputs
    opt, cfg, child = (TB.bom_option(spark, SF_SMALL), TB.bom_config(spark, SF_SMALL),
                       TB.child_part_option(spark, SF_SMALL))
    counts = dict(write_outputs(run_workflow(opt, cfg, child), tmpdir_path).collect())
    assert counts == {"rollup": 6000, "latest": 1036, "expanded": 11810, "best_per_child": 340}
    assert spark.read.parquet(f"{tmpdir_path}/latest").count() == 1036
    assert spark.read.option("header", True).csv(f"{tmpdir_path}/best_per_child").count() == 340


def test_end_to_end_from_landing_drops(spark):
    """Landing drops -> ingest -> report equals the report on the mapped tables
    (the config drop is typed on the way in)."""
    from bomspark.sources import fixtures as FX
    from bomspark.sources import ingest as IG
    opt = IG.ingest_bom_option(spark, FX.option_landing(spark, SF_SMALL)).drop("period")
    cfg = IG.ingest_bom_config(spark, FX.config_landing(spark, SF_SMALL))
    child = IG.ingest_option_child(spark, FX.child_landing(spark, SF_SMALL))
    from_files = run_workflow(opt, cfg, child)
    # status 'P' orders landed without shop_order_num: their keys are NULL and
    # drop out at the join-back, exactly as they would in the reference
    direct_opt = TB.bom_option(spark, SF_SMALL)
    assert from_files.serial_joined.count() == direct_opt.count()
    assert from_files.best_per_child.count() > 0


def test_serial_join_casts_text_years_leniently(spark):
    opt = spark.createDataFrame([("S1", "O1", "1"), ("S2", "O2", "2"), ("S3", "O3", "3")],
                                "Engine_serial string, option_assembly_num string, shop_order_num string")
    cfg = spark.createDataFrame([("S1", "D", "2020.0"), ("S2", "D", "n/a"), ("S3", "D", " 2021 ")],
                                "Engine_serial string, design_config_2 string, build_year string")
    got = sorted((r[S.ENGINE_SERIAL], r[S.BUILD_YEAR]) for r in serial_join(opt, cfg).collect())
    assert got == [("S1", 2020), ("S2", None), ("S3", 2021)]


def test_checkpoint_dir_fallback_when_unset(spark, monkeypatch):
    """With no configured folder, a local one is set on the context (a
    running session cannot change spark.checkpoint.dir itself)."""
    from bomspark import session as SS
    before = SS._configured_checkpoint_dir(spark)
    monkeypatch.setattr(SS, "_configured_checkpoint_dir", lambda s: None)
    try:
        got = SS.ensure_checkpoint_dir(spark)
        assert got and "bomspark-ckpt-" in got
    finally:
        spark.sparkContext.setCheckpointDir(before)


def test_written_and_lazy_stages_are_equal(spark):
    opt, cfg, child = (TB.bom_option(spark, SF_SMALL), TB.bom_config(spark, SF_SMALL),
                       TB.child_part_option(spark, SF_SMALL))
    lazy = run_workflow(opt, cfg, child, checkpoint=False).best_per_child
    written = run_workflow(opt, cfg, child).best_per_child
    assert lazy.exceptAll(written).count() == 0 and written.exceptAll(lazy).count() == 0


def test_no_local_checkpoint_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from bomspark import session as SS
    monkeypatch.setattr(SS, "_configured_checkpoint_dir", lambda s: None)
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            SS.ensure_checkpoint_dir(SimpleNamespace(sparkContext=SimpleNamespace(master=master)))


def test_key_case_examples(spark):
    from bomspark.operators.audit import key_case_examples
    a = spark.createDataFrame([("Ab",), ("AB",), ("x",), ("Same",), (None,)], "k string")
    b = spark.createDataFrame([("ab",), ("X",), ("Same",), ("same",)], "k string")
    got = [tuple(r) for r in key_case_examples(a, b, "k").collect()]
    assert got == [("AB", "ab"), ("x", "X")]


def test_child_table_without_an_option_column_is_an_error(spark):
    from bomspark.operators import require_columns, resolve_column
    frame = spark.createDataFrame([("1", "2")], "a string, b string")
    with pytest.raises(ValueError):
        resolve_column(frame, S.JOIN_OPTION_SYNONYMS)
    with pytest.raises(ValueError):
        require_columns(frame, ["a", "c"])


@pytest.mark.parametrize("name,keys", [
    ("distinct_years", [(S.BUILD_YEAR, True)]),
    ("ordered_export", [(S.BUILD_YEAR, True), (S.COUNT, True)]),
    ("period_order", [("year_num", False), ("half_num", False)])])
def test_ordered_results_are_in_order(spark, name, keys):
    from bomspark.plans import registry
    got = [tuple(r[k] for k, _ in keys) for r in registry.QUERIES[name](spark, SF_SMALL).collect()]
    sign = [-1 if down else 1 for _, down in keys]
    flat = [tuple(s * v for s, v in zip(sign, t)) for t in got]
    assert flat == sorted(flat) and len(got) > 1


def test_java_trim_matches_string_trim_on_edge_characters(spark):
    """Every char <= U+0020 is stripped at both ends and nothing else: not a
    no-break space, not a byte-order mark, not a space before a trailing
    U+2028 (a regex ``$`` would stop before that line separator)."""
    from bomspark.functions.text import clean_field, java_trim

    def java(s):
        i, j = 0, len(s)
        while i < j and ord(s[i]) <= 0x20:
            i += 1
        while j > i and ord(s[j - 1]) <= 0x20:
            j -= 1
        return s[i:j]
    vals = ["", " ", "\t a b \r\n", "\x00abc\x1f", "abc  ", "\xa0x\xa0", "﻿q ",
            ' "" ', "x\x00", "\x0b\x0c mid dle \x1b"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    rows = df.select("v", java_trim("v").alias("t"), clean_field("v").alias("c")).collect()
    for r in rows:
        assert r["t"] == java(r["v"]), repr(r["v"])
        cleaned = java(r["v"].replace('"', ""))
        assert r["c"] == (cleaned or None), repr(r["v"])


def test_year_export_parts_are_globally_ordered(spark, tmpdir_path):
    """Read back part by part in file-name order, the rows run newest year
    first (NULL years last), then count descending: the range exchange keeps
    its order when AQE merges neighbouring ranges."""
    import glob
    import os

    import pandas as pd
    from pyspark.sql import functions as F
    from bomspark import schemas as S
    from bomspark.sinks import export_year_ordered
    df = spark.range(50_000).repartition(7).select(
        F.when(F.col("id") % 11 == 0, F.lit(None))
         .otherwise(F.lit(1990) + F.col("id") % 25).cast("int").alias(S.BUILD_YEAR),
        (F.col("id") % 13).cast("long").alias(S.COUNT),
        F.concat(F.lit("K"), F.col("id").cast("string")).alias(S.KEY))
    export_year_ordered(df, tmpdir_path, then=[S.COUNT])
    parts = sorted(glob.glob(os.path.join(tmpdir_path, "part-*.parquet")))
    assert len(parts) >= 1
    back = pd.concat([pd.read_parquet(p) for p in parts], ignore_index=True)
    assert len(back) == 50_000
    year = back[S.BUILD_YEAR].fillna(-1).astype("int64")    # NULL sorts last
    pairs = list(zip(year, back[S.COUNT]))
    assert all(a >= b for a, b in zip(pairs, pairs[1:]))


def test_contenders_keep_every_row_that_can_be_best(spark):
    """Ranking sees few rows, and the same ones win: ties, text, blank and NULL values."""
    from bomspark.operators import contenders
    from bomspark.sinks import checkpoint_table
    big = str(2 ** 40)
    data = [("5", "O1", "K1", "2020", "A"), ("7", "O2", "K2", "2020", "A"), ("7", "O1", "K2", "2020", "A"),
            ("9", "O1", "K3", "2019", "A"), (big, "O1", "K9", "2018", "B"), (big + "0", "O1", "K8", "2018", "B"),
            ("1", "O1", "K1", "text", "C"), (None, "O1", "K0", None, "C"), ("-3", "O1", "K1", "-5", "D"),
            (None, "O1", "K0", "-5", "D"), ("2", None, "K1", "2020.6", None), ("3", "O", "K1", "2021", None)]
    names = [S.COUNT, S.OPTION, S.KEY, S.BUILD_YEAR, S.CHILD]
    text = checkpoint_table(spark.createDataFrame(data, ", ".join(f"{n} string" for n in names)), "t")
    few = contenders(text)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, best_per_child(few).collect()), key=key) == sorted(
        map(tuple, best_per_child(text).collect()), key=key)
    assert ("5", "O1", "K1", "2020", "A") not in map(tuple, few.collect()) and few.count() < len(data)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as with very many children
    try:
        assert contenders(text).count() == len(data)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_expansion_is_joined_once_for_its_sort(spark):
    from bomspark.plans import registry
    for name in ("ordered_export", "best_per_child_expanded", "best_per_child_csv"):
        plan = registry.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "_popt" not in plan, name
