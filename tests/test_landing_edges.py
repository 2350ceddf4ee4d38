"""Hand-made landing files for the edge cases the mapped tables lack."""

import os

import pytest
from conftest import write_file

from bomspark.sources import ingest as IG
from bomspark.sources import landing as LD
from bomspark.streaming import incremental_ingest, read_ingested
from bomspark import schemas as S
from bomspark.session import scratch_path


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple("" if v is None else str(v) for v in t))


# ------------------------------------------------------------ delimiter detection

def test_delimiter_majority_and_ties(spark, tmpdir_path):
    write_file(tmpdir_path, "a.csv", "x|y,z,w\n1|2,3,4\n")          # 1 pipe < 2 commas
    write_file(tmpdir_path, "b.csv", "x|y|z,w\n1|2|3,4\n")          # 2 pipes > 1 comma
    write_file(tmpdir_path, "c.csv", "x|y,z\n1|2,3\n")              # tie
    write_file(tmpdir_path, "d.csv", "single\n1\n")                 # one column: tie 0/0
    got = dict(rows(LD.landing_files(spark, tmpdir_path), "file_name", "delimiter"))
    assert got == {"a.csv": ",", "b.csv": "|", "c.csv": ",", "d.csv": ","}
    child = dict(rows(LD.landing_files(spark, tmpdir_path, pipe_on_tie=True),
                      "file_name", "delimiter"))
    assert child == {"a.csv": ",", "b.csv": "|", "c.csv": "|", "d.csv": "|"}
    df = LD.detect_delimiters(spark, tmpdir_path).select("file_name", "delimiter")
    assert dict(rows(df, "file_name", "delimiter")) == got


def test_only_csv_files_any_case(spark, tmpdir_path):
    write_file(tmpdir_path, "a.CSV", "engine_serial_num|design_config_num|build_year\n1|D|2020\n")
    write_file(tmpdir_path, "b.txt", "engine_serial_num|design_config_num|build_year\n2|D|2020\n")
    out = IG.ingest_bom_config(spark, tmpdir_path)
    assert rows(out, "Engine_serial") == [("1",)]


# ------------------------------------------------------------ quoting, BOM, case

def test_quoted_delimiters_and_doubled_quotes(spark, tmpdir_path):
    write_file(tmpdir_path, "cfg.csv",
               'engine_serial_num,design_config_num,build_year\n'
               '"1","q,r",2020\n'
               '2,"a""b",2021\n')
    out = IG.ingest_bom_config(spark, tmpdir_path)
    assert rows(out, "Engine_serial", "design_config_2", "build_year") == [
        ("1", "q,r", "2020"), ("2", "ab", "2021")]


def test_bom_and_upper_case_headers(spark, tmpdir_path):
    write_file(tmpdir_path, "cfg.csv",
               "\ufeffENGINE_SERIAL_NUM|Design_Config_Num|BUILD_YEAR\n7|DC1|2019\n")
    out = IG.ingest_bom_config(spark, tmpdir_path)
    assert rows(out, "Engine_serial", "design_config_2", "build_year") == [("7", "DC1", "2019")]


# ------------------------------------------------------------ missing columns, short/long rows

def test_option_missing_column_is_null(spark, tmpdir_path):
    write_file(tmpdir_path, "BOM_ESN_Option_202001150000.csv",
               "design_configuration|engine_serial_num|option_assembly_num|build_upfit_date\n"
               "DC1|S1|OPT1|2020\n")
    out = IG.ingest_bom_option(spark, tmpdir_path)
    assert rows(out, *S.OPTION_KEEP, "period") == [("DC1", None, "S1", "OPT1", "2020", "2020_01")]


def test_config_and_child_without_required_column_are_skipped(spark, tmpdir_path):
    cfg = os.path.join(tmpdir_path, "cfg")
    write_file(cfg, "good.csv", "engine_serial_num|design_config_num|build_year\n1|D|2020\n")
    write_file(cfg, "bad.csv", "engine_serial_num|build_year\n2|2020\n")
    assert rows(IG.ingest_bom_config(spark, cfg), "Engine_serial") == [("1",)]
    child = os.path.join(tmpdir_path, "child")
    write_file(child, "good.csv", "option_no,child_part\nO1,C1\n")
    write_file(child, "bad.csv", "option_no,part\nO2,C2\n")
    assert rows(IG.ingest_option_child(spark, child), "Option_Number") == [("O1",)]


def test_short_and_long_rows(spark, tmpdir_path):
    write_file(tmpdir_path, "cfg.csv",
               "engine_serial_num|design_config_num|build_year\n"
               "1|D1\n"                 # short: build_year NULL
               "2|D2|2020|extra|more\n")  # long: extras ignored
    out = IG.ingest_bom_config(spark, tmpdir_path)
    assert rows(out, "Engine_serial", "design_config_2", "build_year") == [
        ("1", "D1", None), ("2", "D2", "2020")]


def test_all_empty_rows_dropped_for_option_kept_for_config_and_child(spark, tmpdir_path):
    opt = os.path.join(tmpdir_path, "opt")
    write_file(opt, "BOM_ESN_Option_202001150000.csv",
               "design_configuration|shop_order_num|engine_serial_num|option_assembly_num|build_upfit_date\n"
               "  | |\t| |\n"
               "DC1|1|S1|O1|2020\n")
    assert IG.ingest_bom_option(spark, opt).count() == 1
    cfg = os.path.join(tmpdir_path, "cfg")
    write_file(cfg, "c.csv", "engine_serial_num|design_config_num|build_year\n | | \n1|D|2020\n")
    assert IG.ingest_bom_config(spark, cfg).count() == 2
    child = os.path.join(tmpdir_path, "child")
    write_file(child, "c.csv", "option_no|child_part\n |\nO1|C1\n")
    assert IG.ingest_option_child(spark, child).count() == 2


def test_blank_lines_skipped_and_leading_zeros_kept(spark, tmpdir_path):
    write_file(tmpdir_path, "cfg.csv",
               "engine_serial_num|design_config_num|build_year\n\n00123|D|2020\n\n")
    out = IG.ingest_bom_config(spark, tmpdir_path)
    assert rows(out, "Engine_serial") == [("00123",)]


def test_java_trim_of_control_chars(spark, tmpdir_path):
    write_file(tmpdir_path, "c.csv", "option_no|child_part\n\tO1 \x0b|  C1\t\n")
    out = IG.ingest_option_child(spark, tmpdir_path)
    assert rows(out, "Option_Number", "Child_Part_Number") == [("O1", "C1")]


def test_child_synonyms_last_match_wins(spark, tmpdir_path):
    write_file(tmpdir_path, "c.csv", "option_number|Rev_Option_No|child_part\nA|B|C\n")
    out = IG.ingest_option_child(spark, tmpdir_path)
    assert rows(out, "Option_Number", "Child_Part_Number") == [("B", "C")]


# ------------------------------------------------------------ periods from names / data

def test_periods_from_names_and_data(spark, tmpdir_path):
    hdr = "design_configuration|shop_order_num|engine_serial_num|option_assembly_num|build_upfit_date\n"
    write_file(tmpdir_path, "BOM_ESN_Option_202607010438.csv", hdr + "D|1|S1|O1|2026\n")
    write_file(tmpdir_path, "x_2016_03_a.csv", hdr + "D|1|S2|O1|2016\n")
    write_file(tmpdir_path, "x_a_05_b.csv", hdr + "D|1|S3|O1|\nD|1|S3|O1|built 2019-05\nD|1|S3|O1|2018\n")
    write_file(tmpdir_path, "x_a_09_b.csv", hdr + "D|1|S4|O1|2017\n")
    write_file(tmpdir_path, "x.csv", hdr + "D|1|S5|O1|n/a\n")
    write_file(tmpdir_path, "BOM_20261301.csv", hdr + "D|1|S6|O1|2026\n")
    out = IG.ingest_bom_option(spark, tmpdir_path, with_source=True)
    got = dict(rows(out.select("file_name", "period").distinct(), "file_name", "period"))
    assert got == {
        "BOM_ESN_Option_202607010438.csv": "2026_02",
        "x_2016_03_a.csv": "2016_01",
        "x_a_05_b.csv": "2019_01",       # first row holding a year, in file order
        "x_a_09_b.csv": "2017_02",
        "x.csv": "XXXX_01",
        "BOM_20261301.csv": "2026_01",   # month 13 invalid -> default 01
    }


def test_percent_encoded_names(spark, tmpdir_path):
    write_file(tmpdir_path, "BOM ESN Option 20201115.csv",
               "design_configuration|shop_order_num|engine_serial_num|option_assembly_num|build_upfit_date\n"
               "D|1|S1|O1|2020\n")
    out = IG.ingest_bom_option(spark, tmpdir_path, with_source=True)
    assert rows(out, "file_name", "period") == [("BOM ESN Option 20201115.csv", "2020_02")]


# ------------------------------------------------------------ incremental vs append

def test_incremental_ingests_each_file_once(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "landing")
    hdr = "engine_serial_num|design_config_num|build_year\n"
    write_file(land, "d1.csv", hdr + "1|D|2020\n2|D|2020\n")
    table = scratch_path(spark, "t-inc")
    ckpt = scratch_path(spark, "t-inc-ckpt")
    norm = lambda sp, paths: IG.ingest_bom_config(sp, paths)
    assert incremental_ingest(spark, land, table, ckpt, norm) == 1
    assert incremental_ingest(spark, land, table, ckpt, norm) == 0   # re-run: nothing new
    write_file(land, "d2.csv", hdr + "3|D|2021\n")
    assert incremental_ingest(spark, land, table, ckpt, norm) == 1
    out = read_ingested(spark, table, S.BOM_CONFIG)
    assert sorted(r["Engine_serial"] for r in out.collect()) == ["1", "2", "3"]


def test_append_twice_doubles(spark, tmpdir_path):
    from bomspark.sinks import append_table
    land = os.path.join(tmpdir_path, "landing")
    write_file(land, "d1.csv", "engine_serial_num|design_config_num|build_year\n1|D|2020\n")
    table = os.path.join(tmpdir_path, "table")
    df = IG.ingest_bom_config(spark, land)
    assert append_table(spark, df, table) == "overwrite"
    assert append_table(spark, df, table) == "append"
    assert spark.read.parquet(table).count() == 2


def test_lenient_csv_drops_short_rows_and_truncates_long(spark, tmpdir_path):
    path = write_file(tmpdir_path, "e.csv",
                      "a,b,c\n"
                      "1,2,3\n"
                      "4,5\n"                  # short: dropped
                      "6,7,8,9\n"              # long: truncated
                      '"x,y",z,w\n')           # quoted delimiter: 3 fields
    df = LD.read_lenient_csv(spark, path, ["a", "b", "c"])
    assert rows(df, "a", "b", "c") == [("1", "2", "3"), ("6", "7", "8"), ("x,y", "z", "w")]
    assert df.count() == 3
    assert df.select("a").count() == 3


def test_child_blank_lines_are_kept_as_empty_records(spark, tmpdir_path):
    write_file(tmpdir_path, "c.csv", "option_no|child_part\nO1|C1\n\n   \nO2|C2\n\t\n")
    out = IG.ingest_option_child(spark, tmpdir_path)
    assert rows(out, "Option_Number", "Child_Part_Number") == [
        (None, None), (None, None), (None, None), ("O1", "C1"), ("O2", "C2")]
    cfg = os.path.join(tmpdir_path, "cfg")
    write_file(cfg, "c.csv", "engine_serial_num|design_config_num|build_year\n1|D|2020\n\n  \n")
    assert IG.ingest_bom_config(spark, cfg).count() == 1    # config skips blank lines


def test_incremental_option_ingest_keeps_periods(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "landing")
    hdr = "design_configuration|shop_order_num|engine_serial_num|option_assembly_num|build_upfit_date\n"
    write_file(land, "BOM_ESN_Option_202003010000.csv", hdr + "D|1|S1|O1|2020\n")
    write_file(land, "BOM_ESN_Option_202009010000.csv", hdr + "D|1|S2|O1|2020\n")
    table = scratch_path(spark, "t-inc-opt")
    ckpt = scratch_path(spark, "t-inc-opt-ckpt")
    norm = lambda sp, paths: IG.ingest_bom_option(sp, paths)
    assert incremental_ingest(spark, land, table, ckpt, norm) == 1
    assert incremental_ingest(spark, land, table, ckpt, norm) == 0
    write_file(land, "extract_a.csv", hdr + "D|1|S3|O2|\nD|1|S3|O2|2018\n")
    assert incremental_ingest(spark, land, table, ckpt, norm) == 1
    out = spark.read.parquet(table)
    assert rows(out, "Engine_serial", "period") == [("S1", "2020_01"), ("S2", "2020_02"),
                                                    ("S3", "2018_01"), ("S3", "2018_01")]


def test_empty_folders_give_empty_typed_frames(spark, tmpdir_path):
    empty = os.path.join(tmpdir_path, "empty")
    os.makedirs(empty)
    only_empty = os.path.join(tmpdir_path, "only_empty")
    write_file(only_empty, "a.csv", "")
    for folder in (empty, only_empty):
        assert IG.ingest_bom_option(spark, folder).columns == S.OPTION_KEEP + ["period"]
        assert IG.ingest_bom_config(spark, folder).count() == 0
        assert IG.ingest_option_child(spark, folder).columns == [S.OPTION_NUMBER, S.CHILD]


def test_period_table_too_large_to_broadcast_is_joined(spark, tmpdir_path):
    """Spark's own size check decides; rows and periods are the same either way."""
    write_file(tmpdir_path, "BOM_ESN_Option_202607010438.csv",
               "design_configuration|shop_order_num|engine_serial_num|option_assembly_num|"
               "build_upfit_date\nDC1|7|00123|OPT9|2026\n")
    write_file(tmpdir_path, "x_2016_03_a.csv",
               "design_configuration,shop_order_num,engine_serial_num,option_assembly_num,"
               "build_upfit_date\nDC2,8,5,OPT1,2016\n")
    small = IG.ingest_bom_option(spark, tmpdir_path)
    assert "BroadcastExchange" in small._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = IG.ingest_bom_option(spark, tmpdir_path)
        plan = big._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan
        assert sorted(big.collect()) == sorted(small.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {(r["Engine_serial"], r["period"]) for r in small.collect()}
    assert got == {("00123", "2026_02"), ("5", "2016_01")}


def test_lists_of_oddly_named_files_read_as_their_folder_does(spark, tmpdir_path):
    """Space, percent, plus and glob characters in names mean themselves."""
    hdr = "design_configuration|shop_order_num|engine_serial_num|option_assembly_num|build_upfit_date\n"
    write_file(tmpdir_path, "BOM ESN Option 20201115.csv", hdr + "D|1|S1|O1|2020\n")
    write_file(tmpdir_path, "BOM_ESN_Option_20190301+1.csv", hdr + "D|2|S2|O2|2019\nD|3|S3|O3|\n")
    write_file(tmpdir_path, "opt_50%_2018_08.csv",
               "OPTION_ASSEMBLY_NUM,Engine_serial,DESIGN_CONFIGURATION\nO4,S4,D4\n")
    write_file(tmpdir_path, "x.csv", hdr + "D|5|S5|O5|n/a\nD|6|S6|O6|2017\n")
    write_file(tmpdir_path, "a[1]_2015.csv", hdr + "D|7|S7|O7|\n")
    write_file(tmpdir_path, "a1_2014.csv", hdr + "D|8|S8|O8|\n")
    write_file(tmpdir_path, "{a,b}*_2013.csv", hdr + "D|9|S9|O9|\n")
    folder = IG.ingest_bom_option(spark, tmpdir_path, with_source=True)
    key = lambda r: tuple("" if v is None else v for v in r)
    want = sorted(folder.collect(), key=key)
    paths = [r["path"] for r in LD.list_files(spark, tmpdir_path).collect()]
    listed = IG.ingest_bom_option(spark, paths, with_source=True)
    assert sorted(listed.collect(), key=key) == want
    one = [p for p in paths if "[1]" in p]
    assert rows(IG.ingest_bom_option(spark, one), "Engine_serial") == [("S7",)]
    assert {(r["file_name"], r["period"]) for r in want} == {
        ("BOM ESN Option 20201115.csv", "2020_02"), ("BOM_ESN_Option_20190301+1.csv", "2019_01"),
        ("opt_50%_2018_08.csv", "2018_02"), ("x.csv", "2017_01"), ("a[1]_2015.csv", "2015_01"),
        ("a1_2014.csv", "2014_01"), ("{a,b}*_2013.csv", "2013_01")}


def test_names_that_sparks_readers_skip_are_read(spark, tmpdir_path):
    hdr = "engine_serial_num|design_config_num|build_year\n"
    write_file(tmpdir_path, "a.csv", hdr + "1|D|2020\n")
    write_file(tmpdir_path, "_SUCCESS", "")
    write_file(tmpdir_path, ".a.csv.crc", "")
    write_file(tmpdir_path, "_b.csv", hdr + "2|D|2020\n")
    write_file(tmpdir_path, ".c.CSV", hdr + "3|D|2020\n")
    os.makedirs(os.path.join(tmpdir_path, "folder.csv"))
    assert rows(IG.ingest_bom_config(spark, tmpdir_path), "Engine_serial") == [("1",), ("2",), ("3",)]
    listed = [f"{tmpdir_path}/_b.csv", f"file:{tmpdir_path}/.c.CSV"]
    assert rows(IG.ingest_bom_config(spark, listed), "Engine_serial") == [("2",), ("3",)]
    assert rows(IG.ingest_bom_config(spark, f"{tmpdir_path}/[a_]*"), "Engine_serial") == [
        ("1",), ("2",)]
    with pytest.raises(FileNotFoundError):
        IG.ingest_bom_config(spark, f"{tmpdir_path}/none")


def test_quotes_switch_anywhere_in_a_field(spark, tmpdir_path):
    hdr = "engine_serial_num,design_config_num,build_year\n"
    write_file(tmpdir_path, "a.csv", hdr + 'ab"1,x"y,DC1,2020\n"q",D"",2"0"2"1\nun"closed,D,2\n'
               '"",DC2,2022\nx\x01y,D\\3,"2,0"\n')
    write_file(tmpdir_path, "b.csv", hdr.replace(",", "|") + 'p"|"q|"D|4"|2019\n')
    got = rows(IG.ingest_bom_config(spark, tmpdir_path), *S.CONFIG_HEADERS.values())
    assert got == sorted([("ab1,xy", "DC1", "2020"), ("q", "D", "2021"), ("unclosed,D,2", None, None),
                          (None, "DC2", "2022"), ("x\x01y", "D\\3", "2,0"), ("p|q", "D|4", "2019")],
                         key=lambda t: tuple("" if v is None else str(v) for v in t))


def test_blank_lines_before_a_config_header(spark, tmpdir_path):
    write_file(tmpdir_path, "a.csv", "\n \t\nengine_serial_num|design_config_num|build_year\n1|D|2020\n\n")
    assert rows(IG.ingest_bom_config(spark, tmpdir_path), "Engine_serial") == [("1",)]


def test_headers_are_trimmed_as_java_trims(spark, tmpdir_path):
    write_file(tmpdir_path, "a.csv", "\x01engine_serial_num |design_config_num|build_year\n1|D|2020\n")
    write_file(tmpdir_path, "b.csv", "\u00a0engine_serial_num|design_config_num|build_year\n2|D|2020\n")
    assert rows(IG.ingest_bom_config(spark, tmpdir_path), "Engine_serial") == [("1",)]


def test_a_header_beyond_the_bound_is_an_error(tmpdir_path, monkeypatch):
    from bomspark.sources import first_line as FL
    monkeypatch.setattr(FL, "MAX_HEADER", 10)
    path = write_file(tmpdir_path, "a.csv", "x" * 100 + "\n")
    with pytest.raises(ValueError, match="longer than 10"):
        FL.read_first_line(path)
    for text, plain, skipping in (("", None, None), ("a", "a", "a"), ("\n b\r\nc", "", " b"),
                                  ("\ufeffh\n", "h", "h"), ("\r\n\r\n", "", None), ("\n\n \n", "", None)):
        write_file(tmpdir_path, "b.csv", text)
        at = f"{tmpdir_path}/b.csv"
        assert (FL.read_first_line(at), FL.read_first_line(at, True)) == (plain, skipping)


def test_incremental_takes_late_and_oddly_named_files(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "landing")
    hdr = "engine_serial_num|design_config_num|build_year\n"
    table, ckpt = scratch_path(spark, "t-late"), scratch_path(spark, "t-late-ckpt")
    write_file(land, "new.csv", hdr + "1|D|2020\n")
    assert incremental_ingest(spark, land, table, ckpt, IG.ingest_bom_config) == 1
    late = write_file(land, "late.csv", hdr + "2|D|2020\n")
    os.utime(late, (os.path.getmtime(late) - 400 * 86400,) * 2)
    write_file(land, "a[1].csv", hdr + "3|D|2020\n")
    write_file(land, "a1.csv", hdr + "4|D|2020\n")
    incremental_ingest(spark, land, table, ckpt, IG.ingest_bom_config, max_files_per_trigger=2)
    out = read_ingested(spark, table, S.BOM_CONFIG)
    assert rows(out, "Engine_serial") == [("1",), ("2",), ("3",), ("4",)]
    write_file(land, "_x.csv", hdr + "5|D|2020\n")
    assert incremental_ingest(spark, land, table, ckpt, IG.ingest_bom_config) == 1
    assert rows(spark.read.parquet(table), "Engine_serial")[-1] == ("5",)


def test_a_batch_that_failed_is_run_again_and_counts_once(spark, tmpdir_path):
    """Whether it failed before its rows were written, or between them and the ledger."""
    from bomspark.streaming import incremental as INC
    land = os.path.join(tmpdir_path, "landing")
    hdr = "engine_serial_num|design_config_num|build_year\n"
    table, ledger = scratch_path(spark, "t-retry"), scratch_path(spark, "t-retry-ledger")
    for i in range(5):
        write_file(land, f"f{i}.csv", hdr + f"{i}|D|2020\n")
    normalize, into_batch, calls = IG.ingest_bom_config, INC._into_batch, []

    def failing(sp, paths):
        calls.append(paths)
        if len(calls) == 2:
            raise OSError("lost")
        return normalize(sp, paths)
    with pytest.raises(OSError):
        incremental_ingest(spark, land, table, ledger, failing, max_files_per_trigger=2)
    assert INC.read_ledger(spark, ledger).count() == 2

    def lost_ledger(df, path, batch_id):
        if path == ledger and batch_id == 2:
            raise OSError("lost")
        into_batch(df, path, batch_id)
    INC._into_batch = lost_ledger
    try:
        with pytest.raises(OSError):
            incremental_ingest(spark, land, table, ledger, normalize, max_files_per_trigger=2)
    finally:
        INC._into_batch = into_batch
    assert spark.read.parquet(table).count() == 5         # written, not yet in the ledger
    write_file(land, "late.csv", hdr + "9|D|2020\n")
    assert incremental_ingest(spark, land, table, ledger, normalize, max_files_per_trigger=2) == 1
    out = read_ingested(spark, table, S.BOM_CONFIG)
    assert rows(out, "Engine_serial") == [(str(i),) for i in (0, 1, 2, 3, 4, 9)]
    assert sorted(r["batch_id"] for r in INC.read_ledger(spark, ledger).collect()) == [0, 0, 1, 1, 2, 2]
    assert incremental_ingest(spark, land, table, ledger, normalize) == 0


def test_the_ledger_is_joined_not_collected(spark, tmpdir_path):
    from bomspark.streaming import incremental as INC
    write_file(tmpdir_path, "a.csv", "x\n")
    ledger = scratch_path(spark, "t-ledger")
    INC._into_batch(spark.range(1000).selectExpr("concat('file:/old/', id) AS path",
                                                 "current_timestamp() AS modificationTime"), ledger, 0)
    new = INC.new_files(spark, tmpdir_path, ledger)
    assert "LeftAnti" in new._jdf.queryExecution().executedPlan().toString()
    assert [r["path"] for r in new.collect()] == [f"file:{tmpdir_path}/a.csv"]


def test_read_ingested_hides_no_errors(spark, tmpdir_path):
    assert read_ingested(spark, f"{tmpdir_path}/none", S.BOM_CONFIG).count() == 0
    write_file(f"{tmpdir_path}/bad", "part-0.parquet", "not parquet")
    with pytest.raises(Exception):
        read_ingested(spark, f"{tmpdir_path}/bad", S.BOM_CONFIG).count()


def test_append_to_a_csv_table(spark, tmpdir_path):
    from bomspark.sinks import append_table
    df = spark.createDataFrame([("1", "a,b"), ("2", None)], "k string, v string")
    table = os.path.join(tmpdir_path, "csv")
    assert append_table(spark, df, table, "csv") == "overwrite"
    assert append_table(spark, df, table, "csv") == "append"
    assert spark.read.option("header", True).csv(table).count() == 4
    assert append_table(spark, df.select("v"), table, "csv") == "overwrite"
    bad = os.path.join(tmpdir_path, "bad")
    write_file(bad, "part-0.parquet", "not parquet")
    with pytest.raises(Exception):
        append_table(spark, df, bad)
    assert os.path.exists(f"{bad}/part-0.parquet")


def test_control_char_only_lines_are_blank_lines(spark, tmpdir_path):
    """A line of chars <= U+0020 only is blank (Java ``trim`` is empty): skipped
    for config files, one empty record (not two) for option-child files."""
    child_dir = os.path.join(tmpdir_path, "child")
    write_file(child_dir, "WC_Option_Child_1.csv",
               "option_number|child_part\nO1|C1\n\x01\n\x0b \n\x1f\t\n   \nO3|C3\n")
    child = IG.ingest_option_child(spark, child_dir).collect()
    assert len(child) == 6
    assert sum(1 for r in child if r[0] is None and r[1] is None) == 4
    cfg_dir = os.path.join(tmpdir_path, "cfg")
    write_file(cfg_dir, "BOM_ESN_Config_202001.csv",
               "engine_serial_num|design_config_num|build_year\nS1|D1|2020\n\x01\n\x0b \n"
               " \x1f\t\nS2|D2|2021\n")
    cfg = IG.ingest_bom_config(spark, cfg_dir).collect()
    assert sorted(r[0] for r in cfg) == ["S1", "S2"]


def test_option_ingest_without_period_has_the_same_rows(spark, tmpdir_path):
    hdr = "design_configuration|shop_order_num|engine_serial_num|option_assembly_num|build_upfit_date\n"
    write_file(tmpdir_path, "BOM_ESN_Option_202607010438.csv", hdr + "D|1|S1|O1|2026\n|||  |\n")
    write_file(tmpdir_path, "x.csv", hdr + "D|2|S2|O2|n/a\nD|3|S3|O3|2019\n")
    write_file(tmpdir_path, "y_a_05_b.csv", "OPTION_ASSEMBLY_NUM,Engine_serial\nO4,S4\n")
    full = IG.ingest_bom_option(spark, tmpdir_path, with_source=True)
    lean = IG.ingest_bom_option(spark, tmpdir_path, with_source=True, with_period=False)
    assert lean.columns == S.OPTION_KEEP + ["file_name"]
    key = lambda r: tuple("" if v is None else v for v in r)
    assert sorted(lean.collect(), key=key) == sorted(full.drop("period").collect(), key=key)
    # one join, with the file table: no period table
    assert lean._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
