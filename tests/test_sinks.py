"""CSV appends, year-wise verification and repair, audits by observation, rejects."""

import glob
import os

import pytest
from conftest import SF_SMALL, write_file
from pyspark.sql import functions as F

from bomspark import schemas as S
from bomspark import sinks as SK
from bomspark.functions import text as TX
from bomspark.operators import audit as AU
from bomspark.plans import run_audited
from bomspark.session import scratch_path
from bomspark.sources import ingest as IG


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ------------------------------------------------------------ K3: CSV tables

AB = "a string, b string"


def read(spark, path):
    return rows(spark.read.schema(AB).option("header", True).option("escape", '"').csv(path))


def test_append_to_a_clean_table_only_adds_files(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    new = spark.createDataFrame([("1", "x,y"), (None, "z")], AB)
    assert SK.append_csv(new, path) == "overwrite"            # there was none
    before = set(glob.glob(f"{path}/*.csv"))
    assert SK.append_csv(new, path) == "append"
    assert before < set(glob.glob(f"{path}/*.csv"))
    assert read(spark, path) == rows(new.unionByName(new))


def test_short_rows_are_dropped_or_padded_and_long_ones_cut(spark, tmpdir_path):
    new = spark.createDataFrame([("9", "n")], AB)
    text = 'a,b\n1,2\n3\n\n"4,4",5,6\n 7 ,"8""8"\n'
    want = {"drop": [("1", "2"), ("4,4", "5"), (" 7 ", "88"), ("9", "n")],
            "pad": [("1", "2"), ("3", None), (None, None), ("4,4", "5"), (" 7 ", "88"), ("9", "n")]}
    for rule, expected in want.items():
        path = os.path.join(tmpdir_path, rule)
        write_file(path, "part-0.csv", text)
        write_file(path, "part-1.csv", "a,b\n")
        assert SK.append_csv(new, path, short_rows=rule) == "rewrite"
        assert read(spark, path) == sorted(expected, key=str)
        assert SK.append_csv(new, path, short_rows=rule) == "append"
    assert os.listdir(tmpdir_path).sort() == ["drop", "pad"].sort()       # nothing left beside
    with pytest.raises(ValueError):
        SK.append_csv(new, path, short_rows="ignore")


def test_another_header_means_replacement_unless_it_is_not_checked(spark, tmpdir_path):
    new = spark.createDataFrame([("9", "n")], AB)
    for name, header, check, done in (("h", "a,c", True, "overwrite"), ("i", "a,c", False, "append"),
                                      ("j", "a,b,c", True, "overwrite"), ("k", "a", True, "overwrite")):
        path = os.path.join(tmpdir_path, name)
        write_file(path, "part-0.csv", header + "\n1,2\n")
        assert SK.append_csv(new, path, check_header=check) == done
        assert read(spark, path) == ([("9", "n")] if done == "overwrite" else [("1", "2"), ("9", "n")])
    path = os.path.join(tmpdir_path, "wide")                # by the padding rule the first names count
    write_file(path, "part-0.csv", "a,b,c\n1,2,3\n")
    assert SK.append_csv(new, path, short_rows="pad") == "rewrite"
    assert read(spark, path) == [("1", "2"), ("9", "n")]


# ------------------------------------------------------------ K5: years

ROWS = [(2020, "a"), (2020, "b"), (2021, "c"), (None, "d"), (2022, "e"), (2022, "e")]


def exported(spark, rows_):
    path = scratch_path(spark, "t-years")
    df = spark.createDataFrame(rows_, "build_year int, v string").select("v", "build_year")
    SK.export_by_year(df, path)
    return df, path


def test_only_failing_years_are_written_again(spark):
    df, path = exported(spark, ROWS)
    assert {r["match"] for r in SK.verify_years(df, path).collect()} == {True}
    kept = set(glob.glob(f"{path}/build_year=2021/*.parquet"))
    null = glob.glob(f"{path}/build_year=__HIVE_DEFAULT_PARTITION__/*.parquet")[0]
    os.remove(null)                                                     # a year gone
    broken = glob.glob(f"{path}/build_year=2022/*.parquet")[0]
    with open(broken, "wb") as fh:                                      # one unreadable
        fh.write(b"PAR1 not PAR1")
    crc = os.path.join(os.path.dirname(broken), f".{os.path.basename(broken)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    other = spark.createDataFrame([("x", 2020), ("y", 2020), ("s", 1999)], "v string, build_year int")
    SK.write_parquet(other, path, partition_by=["build_year"])          # other rows, a surplus year
    found = {r["year"]: tuple(r)[1:] for r in SK.repair_years(df, path).collect()}
    assert found == {2020: (2, 2, False), 2021: (1, 1, True), None: (1, 0, False),
                     2022: (2, 0, False), 1999: (0, 1, False)}
    assert set(glob.glob(f"{path}/build_year=2021/*.parquet")) == kept
    assert rows(spark.read.schema(df.schema).parquet(path)) == rows(df)
    assert {r["match"] for r in SK.verify_years(df, path).collect()} == {True}


def test_verify_without_an_export(spark):
    df, _ = exported(spark, ROWS[:3])
    got = rows(SK.verify_years(df, scratch_path(spark, "t-none")))
    assert got == [(2020, 2, 0, False), (2021, 1, 0, False)]


# ------------------------------------------------------------ A6

def test_audited_run_counts_every_stage(spark):
    from conftest import SF_SMALL
    from bomspark.sources import tables as TB
    opt, cfg, child = (f(spark, SF_SMALL) for f in (TB.bom_option, TB.bom_config,
                                                    TB.child_part_option))
    result, audit = run_audited(opt, cfg, child)
    got = {r["stage"]: r["output_rows"] for r in audit.collect()}
    for name, frame in (("bom_option", opt), ("serial_join", result.serial_joined),
                        ("keyed", result.keyed), ("rollup", result.rollup), ("latest", result.latest),
                        ("expanded", result.expanded), ("best_per_child", result.best_per_child)):
        assert got[name] == frame.count(), name


def test_audited_run_without_rows(spark):
    """Also if the optimizer leaves a stage out because it cannot have rows."""
    opt = spark.createDataFrame([("D", "1", "S1", "O1", "2020")], S.BOM_OPTION)
    cfg = spark.createDataFrame([], S.BOM_CONFIG)
    child = spark.createDataFrame([("O1", "C1")], S.CHILD_PART_OPTION)
    got = {r["stage"]: (r["input_rows"], r["output_rows"], r["pct_change"])
           for r in run_audited(opt, cfg, child)[1].collect()}
    assert got["best_per_child"] == (0, 0, None) and got["serial_join"] == (1, 0, -100.0)


# ------------------------------------------------------------ P3, F13

def test_rejects_name_what_was_missing(spark, tmpdir_path):
    child, config = (os.path.join(tmpdir_path, n) for n in ("child", "config"))
    write_file(child, "ok.csv", "option_no|child_part\n1|2\n")
    write_file(child, "a.csv", "option_no|part\n3|4\n")
    write_file(child, "b.csv", "x,y\n5,6\n")
    write_file(child, "empty.csv", "")
    write_file(config, "ok.csv", "engine_serial_num,design_config_num,build_year\n1,D,2020\n")
    write_file(config, "c.csv", "\nengine_serial_num,build_year\n2,2020\n")
    write_file(config, "empty.csv", "")
    got = IG.child_ingest(spark, child)
    assert rows(got.rows) == [("1", "2")]
    assert rows(got.rejected) == [("a.csv", "no column for: Child_Part_Number"),
                                  ("b.csv", "no column for: Option_Number, Child_Part_Number"),
                                  ("empty.csv", "empty file")]
    got = IG.config_ingest(spark, config)
    assert rows(got.rows) == [("1", "D", "2020")]
    assert rows(got.rejected) == [("c.csv", "no column for: design_config_2")]


def test_base_names(spark):
    names = {"a.csv": "a", "a.b.csv": "a.b", "a": "a", ".csv": ".csv", "a.": "a", "..": ".",
             ".a.csv": ".a", "": "", None: None}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"]: r["b"] for r in df.select("n", TX.base_name("n").alias("b")).collect()}
    assert got == names


def test_observed_counts_are_taken_while_writing(spark):
    df, obs = AU.observe_rows(spark.range(1000).where("id % 2 = 0"), "t")
    SK.write_parquet(df.withColumn("x", F.lit(1)), scratch_path(spark, "t-observed"))
    assert AU.observed_rows(obs, None) == 500


def test_files_of_several_layouts_are_written_in_one_pass(spark, tmpdir_path):
    """Fields are made of the rows behind the sort; rows without a file are left out."""
    from bomspark.sources.landing_writer import Layout, write_layouts, writing_tasks
    df = spark.createDataFrame([("a.csv", 0, 2, "x|y"), ("a.csv", 0, 1, None), ("b.csv", 1, 3, 'q"'),
                                (None, 0, 4, "z")], "file string, layout int, n int, v string")
    fields = {"id": F.concat(F.lit("N"), F.col("n").cast("string")), "value": F.col("v")}
    layouts = [Layout(["id", "value"], ["id", "value"], "|"), Layout(["value", "id"], ["v", "i"], ",")]
    out = write_layouts(df, tmpdir_path, "file", "layout", layouts, fields, ["n"], 3)
    assert sorted(tuple(r) for r in out.collect()) == [("a.csv", 2), ("b.csv", 1)]
    text = {n: open(os.path.join(tmpdir_path, n)).read() for n in sorted(os.listdir(tmpdir_path))}
    assert text == {"a.csv": 'id|value\nN1|\nN2|"x|y"\n', "b.csv": 'v,i\n"q""",N3\n'}
    assert writing_tasks(spark, 200_000_000) == 100
    assert writing_tasks(spark, 0) == spark.sparkContext.defaultParallelism


def test_option_drop_joins_its_tables_once_and_sorts_narrow_rows(spark):
    """One join for all layouts, of which orders are hashed and lines are not sorted."""
    from bomspark.sources import fixtures as FX
    plan = FX.option_rows(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort [" not in plan and "concat" not in plan


def test_period_files_are_written_without_a_sort(spark, tmpdir_path):
    """One task may hold every file: all are open, none is collected or sorted."""
    from bomspark.sources.landing_writer import write_few_files
    n = 25_000                    # several batches, each with every file
    df = spark.range(n).select(F.when(F.col("id") < n - 1, F.concat((F.col("id") % 3).cast("string"),
                                                                   F.lit(".csv"))).alias("file"), "id")
    out = write_few_files(df.coalesce(1), tmpdir_path, "file", ["id"])
    assert "Sort" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["file"]: r["rows"] for r in out.collect()} == {"0.csv": 8333, "1.csv": 8333, "2.csv": 8333}
    for i in range(3):
        lines = open(os.path.join(tmpdir_path, f"{i}.csv")).read().splitlines()
        assert lines[0] == "id" and sorted(map(int, lines[1:])) == list(range(i, n - 1, 3))


def test_option_drop_leaves_out_orders_without_status_or_date(spark, tmpdir_path):
    """Such orders have no file, except that extracts need no date."""
    from bomspark.plans import registry
    spark.createDataFrame([(1, None, "2020-01-01", "1-URGENT"), (2, "F", "2020-01-01", "1-URGENT"),
                           (3, "O", "2020-01-02", None), (4, "F", None, "1-URGENT"),
                           (5, "P", None, "1-URGENT"), (6, "P", "2020-01-01", None)],
                          "o_orderkey long, o_orderstatus string, o_orderdate string, o_orderpriority string"
                          ).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")
                                       ).write.parquet(f"{tmpdir_path}/orders.parquet")
    spark.range(1, 8).selectExpr("id as l_orderkey", "id as l_partkey", "id as l_suppkey", "1 as l_linenumber",
                                 "timestamp_ntz'2021-01-01 00:00:00' as l_shipdate", "'N' as l_returnflag"
                                 ).write.parquet(f"{tmpdir_path}/lineitem.parquet")
    got = registry.QUERIES["rename_keep"](spark, tmpdir_path).collect()
    assert sorted((r["Engine_serial"], r["shop_order_num"], r["build_year_2"]) for r in got) == [
        ("2", "1", "2021"), ("3", "1", "2021"), ("5", None, "2021")]
