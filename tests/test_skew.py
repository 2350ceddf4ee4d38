"""Hot keys: one config / one serial holding a third of all rows.

With broadcast disabled and small skew thresholds, the joins that could meet
a hot key must be split by AQE (``SortMergeJoin(skew=true)``), and results
must equal a brute-force answer."""

import duckdb
import pytest
from pyspark.sql import functions as F

from bomspark import schemas as S
from bomspark.operators import config_engine_counts, serial_join

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_spark(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_config_is_split_in_join_back(skew_spark):
    n = 200_000
    keyed = skew_spark.range(n).select(
        F.col("id").cast("string").alias(S.ENGINE_SERIAL),
        F.concat(F.lit("O"), (F.col("id") % 97).cast("string")).alias(S.OPTION),
        F.when(F.col("id") % 3 == 0, F.lit("HOT_1"))
         .otherwise(F.concat(F.lit("C"), (F.col("id") % 5000).cast("string"), F.lit("_1")))
         .alias(S.KEY),
        F.lit(2020).alias(S.BUILD_YEAR))
    out = config_engine_counts(keyed)
    assert "SortMergeJoin(skew=true)" in final_plan(out)
    pdf = keyed.toPandas()
    expected = duckdb.sql("""
        WITH c AS (SELECT split_part(esn_config_design_config_Shop_order_num, '_', 1) AS cid,
                          COUNT(DISTINCT Engine_serial) AS n FROM pdf GROUP BY 1)
        SELECT SUM(n) AS total, COUNT(*) AS rows_out FROM pdf
        JOIN c ON split_part(esn_config_design_config_Shop_order_num, '_', 1) = c.cid""").fetchall()[0]
    got = out.agg(F.sum(S.COUNT), F.count(F.lit(1))).collect()[0]
    assert (got[0], got[1]) == (expected[0], expected[1])


def test_hot_serial_is_split_in_serial_join(skew_spark):
    n = 200_000
    opt = skew_spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string"))
         .alias(S.ENGINE_SERIAL),
        F.concat(F.lit("O"), F.col("id").cast("string")).alias(S.OPTION),
        F.lit("1").alias(S.SHOP_ORDER))
    cfg = skew_spark.range(n).select(
        F.when(F.col("id") == 0, F.lit("HOT")).otherwise(F.col("id").cast("string"))
         .alias(S.ENGINE_SERIAL),
        F.lit("DC").alias(S.DESIGN_CONFIG), F.lit(2020).alias(S.BUILD_YEAR))
    out = serial_join(opt, cfg)
    assert "SortMergeJoin(skew=true)" in final_plan(out)
    # every option row matches exactly one config row
    assert out.count() == n


def test_hot_option_is_split_in_expansion(skew_spark):
    from bomspark.operators import expand_children, latest_per_key
    n = 120_000
    rollup = skew_spark.range(n).select(
        F.lit(1).cast("long").alias(S.COUNT),
        F.when(F.col("id") % 3 == 0, F.lit("HOTOPT"))
         .otherwise(F.concat(F.lit("O"), (F.col("id") % 7000).cast("string"))).alias(S.OPTION),
        F.concat(F.lit("K"), (F.col("id") % 40000).cast("string")).alias(S.KEY),
        (F.lit(2000) + F.col("id") % 20).cast("int").alias(S.BUILD_YEAR))
    child = skew_spark.range(7000).select(
        F.concat(F.lit("O"), F.col("id").cast("string")).alias(S.OPTION_NUMBER),
        F.concat(F.lit("C"), (F.col("id") % 50).cast("string")).alias(S.CHILD)) \
        .unionByName(skew_spark.range(20).select(F.lit("HOTOPT").alias(S.OPTION_NUMBER),
                                                 F.concat(F.lit("H"), F.col("id").cast("string"))
                                                 .alias(S.CHILD)))
    out = expand_children(rollup, latest_per_key(rollup), child)
    assert "SortMergeJoin(skew=true)" in final_plan(out)
    pairs = rollup.select(S.KEY, S.OPTION).distinct()
    per_opt = child.groupBy(S.OPTION_NUMBER).count()
    expected = pairs.join(per_opt, pairs[S.OPTION] == per_opt[S.OPTION_NUMBER]) \
                    .agg(F.sum("count")).collect()[0][0]
    assert out.count() == expected


def test_hot_year_is_spread_over_export_parts(spark, tmpdir_path):
    from bomspark.sinks import export_year_ordered
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(2020)).otherwise((F.lit(1990) + F.col("id") % 30))
         .cast("int").alias(S.BUILD_YEAR),
        F.lit(7).cast("long").alias(S.COUNT),
        F.concat(F.lit("K"), F.col("id").cast("string")).alias(S.KEY))
    export_year_ordered(df, tmpdir_path, then=[S.COUNT], partitions=8)
    back = spark.read.parquet(tmpdir_path)
    per_file = back.groupBy(F.input_file_name().alias("f")).agg(
        F.count(F.lit(1)).alias("n"), F.max(S.BUILD_YEAR).alias("y"))
    hot_files = per_file.where(F.col("y") == 2020).count()
    assert hot_files >= 2                       # the hot year is not one task's file
    assert back.count() == 60_000


def test_hot_option_is_split_in_best_per_child(skew_spark):
    from bomspark.operators import best_per_child, best_per_child_from_parts, latest_per_key
    from bomspark.operators import expand_children
    rollup = skew_spark.range(20_000).select(
        F.lit(1).cast("long").alias(S.COUNT),
        F.concat(F.lit("O"), (F.col("id") % 500).cast("string")).alias(S.OPTION),
        F.concat(F.lit("K"), (F.col("id") % 4000).cast("string")).alias(S.KEY),
        (F.lit(2000) + F.col("id") % 20).cast("int").alias(S.BUILD_YEAR))
    child = skew_spark.range(150_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("O7"))
         .otherwise(F.concat(F.lit("O"), (F.col("id") % 500).cast("string"))).alias(S.OPTION_NUMBER),
        F.concat(F.lit("C"), (F.col("id") % 9000).cast("string")).alias(S.CHILD))
    latest = latest_per_key(rollup)
    out = best_per_child_from_parts(rollup, latest, child)
    assert "SortMergeJoin(skew=true)" in final_plan(out)
    ref = best_per_child(expand_children(rollup, latest, child))
    assert out.exceptAll(ref).count() == 0 and ref.exceptAll(out).count() == 0


def _key_join_lines(plan: str) -> list[str]:
    """SortMergeJoin lines whose join keys are the configuration/order key
    (the pairs x latest-row join), from the final adaptive plan."""
    final = plan.split("== Initial Plan ==")[0]
    return [ln for ln in final.splitlines() if "SortMergeJoin" in ln and "_pk#" in ln]


def _hot_key_rollup(spark, n):
    """One key holds a third of all rows, with ~30k distinct options, so it
    also holds a large share of the distinct (key, option) pairs."""
    return spark.range(n).select(
        F.lit(1).cast("long").alias(S.COUNT),
        F.concat(F.lit("O"), (F.col("id") % 90000).cast("string")).alias(S.OPTION),
        F.when(F.col("id") % 3 == 0, F.lit("HOTK_1"))
         .otherwise(F.concat(F.lit("K"), (F.col("id") % 9000).cast("string"))).alias(S.KEY),
        (F.lit(2000) + F.col("id") % 20).cast("int").alias(S.BUILD_YEAR))


def test_hot_key_is_split_in_expansion(skew_spark):
    from bomspark.operators import expand_children, latest_per_key
    rollup = _hot_key_rollup(skew_spark, 150_000)
    child = skew_spark.range(90000).select(
        F.concat(F.lit("O"), F.col("id").cast("string")).alias(S.OPTION_NUMBER),
        F.concat(F.lit("C"), (F.col("id") % 700).cast("string")).alias(S.CHILD))
    out = expand_children(rollup, latest_per_key(rollup), child)
    lines = _key_join_lines(final_plan(out))
    assert lines and all("skew=true" in ln for ln in lines), lines
    pairs = rollup.select(S.KEY, S.OPTION).distinct()
    per_opt = child.groupBy(S.OPTION_NUMBER).count()
    expected = pairs.join(per_opt, pairs[S.OPTION] == per_opt[S.OPTION_NUMBER]) \
                    .agg(F.sum("count")).collect()[0][0]
    assert out.count() == expected


def test_hot_key_is_split_in_best_per_child(skew_spark):
    from bomspark.operators import (best_per_child, best_per_child_from_parts,
                                    expand_children, latest_per_key)
    rollup = _hot_key_rollup(skew_spark, 150_000)
    child = skew_spark.range(90000).select(
        F.concat(F.lit("O"), F.col("id").cast("string")).alias(S.OPTION_NUMBER),
        F.concat(F.lit("C"), (F.col("id") % 700).cast("string")).alias(S.CHILD))
    latest = latest_per_key(rollup)
    out = best_per_child_from_parts(rollup, latest, child)
    lines = _key_join_lines(final_plan(out))
    assert lines and all("skew=true" in ln for ln in lines), lines
    ref = best_per_child(expand_children(rollup, latest, child))
    assert out.exceptAll(ref).count() == 0 and ref.exceptAll(out).count() == 0


def test_partitioned_write_groups_values_and_splits_a_hot_one(skew_spark, tmpdir_path):
    """Few files per partition value, yet a value holding a third of the rows
    is written by several tasks; every row is kept."""
    import glob
    import os
    from bomspark.sinks import write_parquet
    df = skew_spark.range(90_000).repartition(16).select(
        F.when(F.col("id") % 3 == 0, F.lit("2020_01"))
         .otherwise(F.concat(F.lit("19"), (F.col("id") % 12 + 10).cast("string"), F.lit("_02")))
         .alias("period"),
        F.concat(F.lit("K"), F.col("id").cast("string")).alias(S.KEY),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    write_parquet(df, tmpdir_path, partition_by=["period"])
    folders = glob.glob(os.path.join(tmpdir_path, "period=*"))
    files = {f: glob.glob(os.path.join(f, "*.parquet")) for f in folders}
    values = df.select("period").distinct().count()
    assert len(folders) == values
    assert len(files[os.path.join(tmpdir_path, "period=2020_01")]) >= 2
    cold = [len(v) for k, v in files.items() if not k.endswith("2020_01")]
    assert sum(cold) < 16 * (values - 1)         # not one file per task and value
    assert skew_spark.read.parquet(tmpdir_path).count() == 90_000


def test_hot_file_is_split_in_the_period_join(skew_spark, tmpdir_path):
    """Above the broadcast bound, a landing file holding most of the rows is
    split across tasks when rows meet their file's period."""
    import os
    from bomspark.sources import ingest as IG
    hdr = "design_configuration|shop_order_num|engine_serial_num|option_assembly_num|build_upfit_date\n"
    body = "".join(f"D{i % 7}|{i % 5}|S{i}|O{i % 97}|2020\n" for i in range(60_000))
    with open(os.path.join(tmpdir_path, "BOM_ESN_Option_202003150000.csv"), "w") as fh:
        fh.write(hdr + body)
    for k in range(6):
        with open(os.path.join(tmpdir_path, f"BOM_ESN_Option_20190{k + 1}150000.csv"), "w") as fh:
            fh.write(hdr + "".join(f"D|1|T{k}_{i}|O1|2019\n" for i in range(100)))
    # a name without a year: its period comes from the data, so the period
    # table is itself a (sort-merge) join output, partitioned by path
    with open(os.path.join(tmpdir_path, "bom_option_extract.csv"), "w") as fh:
        fh.write(hdr + "".join(f"D|1|X{i}|O2|2018\n" for i in range(50)))
    # AQE splits a hot partition at map-output boundaries: the big file must
    # span several input splits, as a file that size would at scale
    skew_spark.conf.set("spark.sql.files.maxPartitionBytes", "256KB")
    try:
        out = IG.ingest_bom_option(skew_spark, tmpdir_path)
        plan = final_plan(out).split("== Initial Plan ==")[0]
    finally:
        skew_spark.conf.unset("spark.sql.files.maxPartitionBytes")
    joins = [ln for ln in plan.splitlines()
             if "SortMergeJoin" in ln and "file#" in ln and "Inner" in ln]
    assert joins and all("skew=true" in ln for ln in joins), joins
    got = {r["period"]: r["n"] for r in out.groupBy("period").agg(F.count(F.lit(1)).alias("n"))
           .collect()}
    assert got == {"2020_01": 60_000, "2019_01": 600, "2018_01": 50}


def test_hot_option_is_split_in_semi_filter_of_children(skew_spark):
    from bomspark.operators import semi_filter_children
    child = skew_spark.range(150_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
         .otherwise(F.concat(F.lit("O"), (F.col("id") % 7000).cast("string"))).alias(S.OPTION_NUMBER),
        F.concat(F.lit("C"), F.col("id").cast("string")).alias(S.CHILD))
    rollup = skew_spark.range(20_000).select(
        F.lit(1).cast("long").alias(S.COUNT),
        F.when(F.col("id") % 2 == 0, F.lit("HOT"))
         .otherwise(F.concat(F.lit("O"), (F.col("id") % 3500).cast("string"))).alias(S.OPTION),
        F.concat(F.lit("K"), (F.col("id") % 9000).cast("string")).alias(S.KEY),
        F.lit(2020).alias(S.BUILD_YEAR))
    out = semi_filter_children(child, rollup)
    plan = final_plan(out).split("== Initial Plan ==")[0]
    joins = [ln for ln in plan.splitlines() if "LeftSemi" in ln]
    assert joins and all("skew=true" in ln for ln in joins), joins
    # brute force: child rows whose option occurs in the roll-up
    opts = {r[0] for r in rollup.select(S.OPTION).distinct().collect()}
    expected = child.where(F.col(S.OPTION_NUMBER).isin(list(opts))).count()
    assert out.count() == expected


def test_hot_key_is_split_in_key_option_pairs(skew_spark):
    from bomspark.operators import key_option_pairs, latest_per_key
    rollup = _hot_key_rollup(skew_spark, 150_000)
    out = key_option_pairs(rollup, latest_per_key(rollup))
    plan = final_plan(out).split("== Initial Plan ==")[0]
    joins = [ln for ln in plan.splitlines() if "LeftSemi" in ln]
    assert joins and all("skew=true" in ln for ln in joins), joins
    assert out.count() == rollup.select(S.KEY, S.OPTION).distinct().count()


def test_splittable_is_a_no_op_without_skew_join(spark):
    from bomspark.operators.joins import splittable
    df = spark.range(10)
    assert "Rebalance" in splittable(df)._jdf.queryExecution().analyzed().toString()
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert "Rebalance" not in splittable(df)._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
