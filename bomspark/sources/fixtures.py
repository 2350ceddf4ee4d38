"""Landing drops built from the driver's tables, for the ingest queries.

Every row of ``lineitem`` / ``orders`` / ``part`` lands in exactly one file,
so the ingest output equals the table mapping (plus the file-derived
period) and grows with the tables.  The drops deliberately mix dialects:

option drops (lineitem x orders)
  * orders not in status 'P': ``BOM_ESN_Option_yyyyMMddHHmm.csv`` by order
    date; pipe files (odd day) carry the original header names plus an
    extra column, comma files (even day) carry new names in other case and
    order.
  * orders in status 'P': ``bom_option_extract_<priority>_<range>.csv`` - no year
    in the name (year from the first data row), no month (default), and no
    ``shop_order_num`` column (NULL-filled).
config drops (orders): ``BOM_ESN_Config_yyyyMM.csv``; pipe for odd months,
  comma for even; a quoted comment field holding both delimiters; a last
  ``remark`` column left off (short row) for status 'P'.
child drops (part): ``WC_Option_Child_NN.csv`` by size; option column
  named by one of the three synonyms in varying case; pipe/comma by size.
  ``faulty`` ones name the child column ``child_no`` for sizes divisible by 7 and the
  option column ``opt_no`` for sizes divisible by 11; ``hidden`` ones put ``_`` or ``.``
  before the names of sizes 1 and 2 modulo 3.
faulty config drops name the design column ``design_no`` in May.

Folders are written once per (checkpoint root, sf dir, kind) and reused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CHILD, OPTION_KEEP, OPTION_NUMBER
from ..session import scratch_path
from .landing_writer import (Layout, write_few_files, write_landing_files, write_layouts,
                             writing_tasks)
from .tables import bom_option_rows, table

_CACHE: dict[tuple[str, str, str], str] = {}

# Headers of the generated drops.
OPTION_PIPE_HEADER = ["design_configuration", "shop_order_num", "engine_serial_num",
                      "option_assembly_num", "build_upfit_date", "plant_code"]
OPTION_COMMA_HEADER = ["OPTION_ASSEMBLY_NUM", "Engine_serial", "DESIGN_CONFIGURATION",
                       "Shop_Order_Num", "BUILD_YEAR_2"]
OPTION_EXTRACT_HEADER = ["design_configuration", "engine_serial_num", "option_assembly_num",
                         "build_upfit_date"]
OPTION_LAYOUTS = [
    Layout(["design_configuration", "shop_order_num", "engine_serial", "option_assembly_num",
            "build_year", "plant_code"], OPTION_PIPE_HEADER, "|"),
    Layout(["option_assembly_num", "engine_serial", "design_configuration", "shop_order_num",
            "build_year"], OPTION_COMMA_HEADER, ","),
    Layout(["design_configuration", "engine_serial", "option_assembly_num", "build_year"],
           OPTION_EXTRACT_HEADER, ",")]
CONFIG_HEADER = ["ENGINE_SERIAL_NUM", "Comment", "Design_Config_Num", "build_year", "remark"]
CHILD_OPTION_NAMES = ["rev_option_no", "Option_Number", "OPTION_NO"]


def _cached(spark: SparkSession, sf_dir: str, kind: str, build) -> str:
    from ..session import ensure_checkpoint_dir
    key = (ensure_checkpoint_dir(spark), sf_dir.rstrip("/"), kind)
    folder = _CACHE.get(key)
    if folder is None:
        folder = scratch_path(spark, f"landing-{kind}")
        build(folder)
        _CACHE[key] = folder
    return folder


def option_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with what decides their file.  Orders, the smaller side, are held by hash:
    a sort of the lines would be done again by file."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus",
                                              "o_orderpriority")
    return li.join(o.hint("shuffle_hash"), li["l_orderkey"] == o["o_orderkey"], "inner").drop("o_orderkey")


def option_fields() -> dict[str, F.Column]:
    """The fields of a line's row."""
    return {
        "design_configuration": F.concat(F.lit("DC"), F.col("l_suppkey").cast("string")),
        "shop_order_num": F.col("l_linenumber").cast("string"),
        "engine_serial": F.col("l_orderkey").cast("string"),
        "option_assembly_num": F.concat(F.lit("OPT"), F.col("l_partkey").cast("string")),
        "build_year": F.year("l_shipdate").cast("string"),
        "plant_code": F.col("l_returnflag"),
    }


# Row order inside a generated option file. (l_orderkey, l_linenumber) is not
# unique in the driver data, so the ship date and part/supplier complete the
# order; rows still tied share a ship date and hence the fallback year.
OPTION_FILE_ORDER = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"]


#: Order keys per extract file (and priority).
EXTRACT_KEYS = 8192


def option_file_name(monthly: bool = False) -> F.Column:
    """Landing name of a row's file (see module doc). ``monthly`` names one
    file per month (``BOM_ESN_Option_yyyyMM010000.csv``): the same rows and
    periods in about 1/30th as many files."""
    stamp = (F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("010000")) if monthly
             else F.date_format("o_orderdate", "yyyyMMddHHmm"))
    dated = F.concat(F.lit("BOM_ESN_Option_"), stamp, F.lit(".csv"))
    # by key range, spelled in letters (no year in the name): no file holds a
    # share of the rows, however many there are
    part = F.translate(F.floor(F.col("l_orderkey") / EXTRACT_KEYS).cast("string"),
                       "0123456789", "abcdefghij")
    extract = F.concat(F.lit("bom_option_extract_"), F.col("o_orderpriority"), F.lit("_"), part,
                       F.lit(".csv"))
    return F.when(F.col("o_orderstatus") == "P", extract).otherwise(dated)


def option_landing(spark: SparkSession, sf_dir: str, monthly: bool = False) -> str:
    def build(folder):
        rows = option_rows(spark, sf_dir)
        odd = (F.month if monthly else F.dayofmonth)("o_orderdate") % 2 == 1
        dated = F.col("o_orderstatus") != "P"            # orders without a status have no file
        layout = F.when(~dated, 2).when(dated & odd, 0).when(dated & ~odd, 1)
        rows = rows.select(option_file_name(monthly).alias("_file"), layout.alias("_layout"),
                           *OPTION_FILE_ORDER, "l_returnflag").where("_layout is not null")
        lines = table(spark, sf_dir, "lineitem").count()             # from Parquet's footers
        write_layouts(rows, folder, "_file", "_layout", OPTION_LAYOUTS, option_fields(),
                      OPTION_FILE_ORDER, writing_tasks(spark, lines)).count()
    return _cached(spark, sf_dir, "option-monthly" if monthly else "option", build)


def config_landing(spark: SparkSession, sf_dir: str, faulty: bool = False) -> str:
    def build(folder):
        o = table(spark, sf_dir, "orders")
        design = F.when(F.month("o_orderdate") == 5, F.lit("design_no")).otherwise(
            F.lit(CONFIG_HEADER[2])) if faulty else F.lit(CONFIG_HEADER[2])
        rows = o.select(
            F.concat(F.lit("BOM_ESN_Config_"), F.date_format("o_orderdate", "yyyyMM"),
                     F.lit(".csv")).alias("_file"),
            F.when(F.month("o_orderdate") % 2 == 1, F.lit("|")).otherwise(F.lit(",")).alias("_d"),
            F.col("o_orderkey").cast("string").alias("serial"),
            F.concat(F.col("o_orderpriority"), F.lit(", "), F.col("o_orderstatus"),
                     F.lit("|")).alias("comment"),
            F.concat(F.lit("DC"), F.col("o_custkey").cast("string")).alias("design"),
            F.year("o_orderdate").cast("string").alias("year"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("remark"),
            design.alias("_design"), "o_orderkey",
        )
        names = [F.col("_design") if n == CONFIG_HEADER[2] else F.lit(n) for n in CONFIG_HEADER]
        rows = rows.withColumn("_h", F.concat_ws("<>", *names))
        rows = rows.withColumn("_h", F.replace("_h", F.lit("<>"), F.col("_d")))
        write_landing_files(rows, folder, "_file", ["serial", "comment", "design", "year", "remark"],
                            header_col="_h", delimiter_col="_d", order_by=["o_orderkey"],
                            short_trailing=True).count()
    return _cached(spark, sf_dir, "config-faulty" if faulty else "config", build)


def child_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    opt = F.concat(F.lit("OPT"), F.col("p_partkey").cast("string"))
    size = F.col("p_size").cast("string")
    brand = p.select("p_partkey", "p_size", F.lit(0).alias("_k"), opt.alias("option"),
                     F.concat(F.col("p_brand"), F.lit("-"), size).alias("child"))
    kind = p.select("p_partkey", "p_size", F.lit(1).alias("_k"), opt.alias("option"),
                    F.concat(F.col("p_type"), F.lit("-"), size).alias("child"))
    return brand.unionByName(kind)


def child_landing(spark: SparkSession, sf_dir: str, kind: str = "child") -> str:
    """``kind``: "child", "child-faulty" or "child-hidden"."""
    def build(folder):
        rows = child_rows(spark, sf_dir)
        delim = F.when(F.col("p_size") % 2 == 0, F.lit("|")).otherwise(F.lit(","))
        syn = F.element_at(F.array(*[F.lit(n) for n in CHILD_OPTION_NAMES]),
                           (F.col("p_size") % 3 + 1).cast("int"))
        child = F.lit("child_part")
        if kind == "child-faulty":
            child = F.when(F.col("p_size") % 7 == 0, F.lit("child_no")).otherwise(child)
            syn = F.when(F.col("p_size") % 11 == 0, F.lit("opt_no")).otherwise(syn)
        header = F.concat(syn, delim, child, delim, F.lit("qty"))
        before = (F.element_at(F.array(F.lit(""), F.lit("_"), F.lit(".")),
                               (F.col("p_size") % 3 + 1).cast("int"))
                  if kind == "child-hidden" else F.lit(""))
        rows = rows.select(
            F.concat(before, F.lit("WC_Option_Child_"), F.lpad(F.col("p_size").cast("string"), 2, "0"),
                     F.lit(".csv")).alias("_file"),
            delim.alias("_d"), header.alias("_h"), "option", "child",
            F.col("p_size").cast("string").alias("qty"), "p_partkey", "_k")
        write_landing_files(rows, folder, "_file", ["option", "child", "qty"], header_col="_h",
                            delimiter_col="_d", order_by=["p_partkey", "_k"]).count()
    return _cached(spark, sf_dir, kind, build)


def option_text_table(spark: SparkSession, sf_dir: str, folder: str, flag: str) -> None:
    """A CSV table of option rows as others leave one: the lines of a return flag, whose
    build year is missing (a short row) on first order lines."""
    li = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == flag)
    rows = bom_option_rows(li).withColumn("build_year_2", F.when(
        F.col("l_linenumber") != 1, F.col("build_year_2")))
    rows = rows.withColumn("_file", F.concat(F.lit("part-"), (F.col("l_orderkey") % 8).cast("string"),
                                             F.lit(".csv")))
    write_landing_files(rows, folder, "_file", OPTION_KEEP, header=OPTION_KEEP, delimiter=",",
                        order_by=OPTION_FILE_ORDER[:2], short_trailing=True).count()


def child_text_table(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The same of child rows: the child part is missing where the size is divisible by 5."""
    rows = child_rows(spark, sf_dir).withColumn("child", F.when(
        F.col("p_size") % 5 != 0, F.col("child")))
    rows = rows.withColumn("_file", F.concat(F.lit("part-"), (F.col("p_partkey") % 4).cast("string"),
                                             F.lit(".csv")))
    write_landing_files(rows, folder, "_file", ["option", "child"],
                        header=[OPTION_NUMBER, CHILD], delimiter="|",
                        order_by=["p_partkey", "_k"], short_trailing=True).count()


def period_text_files(spark: SparkSession, rows: DataFrame, folder: str) -> None:
    """Option rows as one ``Csv_bom_esn_option_YYYY_HH.csv`` per period."""
    rows = rows.withColumn("_file", F.concat(F.lit("Csv_bom_esn_option_"), F.col("period"),
                                             F.lit(".csv")))
    write_few_files(rows, folder, "_file", OPTION_KEEP).count()
