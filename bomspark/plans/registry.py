"""Registered queries: one per operator of the inventory, each a callable
``(spark, sf_dir) -> DataFrame`` plus (where SQL can state it) a DuckDB
oracle over the same Parquet tables.

Every query reads the driver's tables (or files Spark writes from them) in
full, so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from .. import sinks as SK
from ..functions import periods as PD
from ..functions import text as TX
from ..operators import audit as AU
from ..operators import (best_per_child, best_per_child_from_parts, build_order_key,
                         config_counts, config_engine_counts, contenders, distinct_options,
                         distinct_years, engine_count_total, expand_children, key_option_pairs, latest_per_key,
                         semi_exists_keys, semi_filter_children, serial_join)
from ..session import scratch_path
from ..sources import fixtures as FX
from ..sources import ingest as IG
from ..sources import landing as LD
from ..sources import tables as TB
from ..streaming import incremental_ingest, read_ingested
from .oracle import q, q_landing

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- stage helpers

def _inputs(spark: SparkSession, sf: str):
    return (TB.bom_option(spark, sf), TB.bom_config(spark, sf), TB.child_part_option(spark, sf))


def _keyed(spark, sf):
    opt, cfg, _ = _inputs(spark, sf)
    return build_order_key(serial_join(opt, cfg))


def _rollup(spark, sf):
    """Roll-up; ``keyed`` is written once first, as in ``run_workflow``."""
    from ..sinks import checkpoint_table
    return config_engine_counts(checkpoint_table(_keyed(spark, sf), "keyed"))


def _latest(spark, sf):
    return latest_per_key(_rollup(spark, sf))


def _rollup_table(spark, sf):
    """The roll-up written once to the shared checkpoint folder, for plans
    that consume it twice (latest rows + key/option pairs): otherwise each
    branch would recompute the serial join, the distinct count and the
    join-back."""
    from ..sinks import checkpoint_table
    return checkpoint_table(_rollup(spark, sf), "rollup")


def _expanded(spark, sf):
    rollup = _rollup_table(spark, sf)
    return expand_children(rollup, latest_per_key(rollup), TB.child_part_option(spark, sf))


def _expanded_table(spark, sf):
    """The expansion written once, for plans that read it twice (a global sort samples
    its input first): otherwise its joins would run twice."""
    return SK.checkpoint_table(_expanded(spark, sf), "expanded")


# ---------------------------------------------------------------- sources

@register("parquet_scan", q("SELECT * FROM bom_option"))
def parquet_scan(spark, sf):
    """Pruned Parquet scan of lineitem mapped to option rows."""
    return TB.bom_option(spark, sf)


@register("bom_config_scan", q("SELECT * FROM bom_config"))
def bom_config_scan(spark, sf):
    return TB.bom_config(spark, sf)


@register("child_part_scan", q("SELECT * FROM child_part_option"))
def child_part_scan(spark, sf):
    """U1 (UNION ALL) of the two child mappings."""
    return TB.child_part_option(spark, sf)


# ---------------------------------------------------------------- joins / keys / rollup

@register("serial_join", q("SELECT * FROM serial_joined"))
def serial_join_q(spark, sf):
    opt, cfg, _ = _inputs(spark, sf)
    return serial_join(opt, cfg)


@register("concat_key", q("SELECT * FROM keyed"))
def concat_key_q(spark, sf):
    return _keyed(spark, sf)


@register("config_counts", q("SELECT * FROM cfg_counts"))
def config_counts_q(spark, sf):
    return config_counts(_keyed(spark, sf))


@register("config_engine_count", q("SELECT * FROM rolled"))
def config_engine_count_q(spark, sf):
    return _rollup(spark, sf)


@register("engine_count_total",
          q("SELECT CAST(COALESCE(SUM(Engine_serial_count), 0) AS BIGINT) AS engine_count_total "
            "FROM cfg_counts"))
def engine_count_total_q(spark, sf):
    return engine_count_total(config_counts(_keyed(spark, sf)))


@register("latest_per_key", q("SELECT * FROM latest_rows"))
def latest_per_key_q(spark, sf):
    return _latest(spark, sf)


@register("semi_filter_children",
          q("SELECT * FROM child_part_option WHERE Option_Number IN "
            "(SELECT option_assembly_num FROM rolled)"))
def semi_filter_children_q(spark, sf):
    return semi_filter_children(TB.child_part_option(spark, sf), _rollup(spark, sf))


@register("semi_exists_keys",
          q("SELECT * FROM latest_rows WHERE esn_config_design_config_Shop_order_num IN "
            "(SELECT esn_config_design_config_Shop_order_num FROM rolled)"))
def semi_exists_keys_q(spark, sf):
    rollup = _rollup_table(spark, sf)
    return semi_exists_keys(latest_per_key(rollup), rollup)


@register("key_option_pairs", q("SELECT * FROM key_pairs"))
def key_option_pairs_q(spark, sf):
    rollup = _rollup_table(spark, sf)
    return key_option_pairs(rollup, latest_per_key(rollup))


@register("expand_children", q("SELECT * FROM expanded_rows"))
def expand_children_q(spark, sf):
    return _expanded(spark, sf)


@register("best_per_child", q("SELECT * FROM best_rows"))
def best_per_child_q(spark, sf):
    """Flagship: best (newest, most used) configuration per child part."""
    rollup = _rollup_table(spark, sf)
    return best_per_child_from_parts(rollup, latest_per_key(rollup),
                                     TB.child_part_option(spark, sf))


@register("best_per_child_expanded", q("SELECT * FROM best_rows"))
def best_per_child_expanded_q(spark, sf):
    """The literal plan: rank the materialised expansion."""
    return best_per_child(contenders(_expanded_table(spark, sf)))


@register("distinct_options", q("SELECT DISTINCT option_assembly_num FROM rolled"))
def distinct_options_q(spark, sf):
    return distinct_options(_rollup(spark, sf))


@register("distinct_years", q("SELECT DISTINCT build_year FROM rolled ORDER BY build_year DESC"))
def distinct_years_q(spark, sf):
    return distinct_years(_rollup(spark, sf))


@register("ordered_export",
          q("SELECT * FROM expanded_rows ORDER BY build_year DESC, Engine_serial_count DESC"))
def ordered_export_q(spark, sf):
    """O2: the expansion ordered for export (global sort only at the sink)."""
    return _expanded_table(spark, sf).orderBy(F.col(S.BUILD_YEAR).desc_nulls_last(),
                                              F.col(S.COUNT).desc_nulls_last())


@register("preview",
          q("SELECT * FROM expanded_rows ORDER BY build_year DESC, Engine_serial_count DESC, "
            "esn_config_design_config_Shop_order_num, option_assembly_num, Child_Part_Number "
            "LIMIT 5"))
def preview_q(spark, sf):
    """L1: the 5-row preview (a top-k: Spark plans TakeOrderedAndProject,
    so each task keeps 5 rows and nothing is globally sorted)."""
    order = [F.col(S.BUILD_YEAR).desc_nulls_last(), F.col(S.COUNT).desc_nulls_last(),
             F.col(S.KEY).asc_nulls_last(), F.col(S.OPTION).asc_nulls_last(),
             F.col(S.CHILD).asc_nulls_last()]
    return _expanded(spark, sf).orderBy(*order).limit(5)


# ---------------------------------------------------------------- scalar functions

@register("scalar_split_part", """
SELECT p_partkey,
       SPLIT_PART(replace(p_name, ' ', '_'), '_', 1) AS first_word,
       SPLIT_PART('_' || p_brand, '_', 1) AS leading_sep,
       SPLIT_PART(p_brand, '_', 1) AS no_sep,
       SPLIT_PART(p_type || '_' || p_name, '_', 1) AS type_part
FROM part""")
def scalar_split_part_q(spark, sf):
    """F1 on text derived from ``part``: inner, leading and missing separators."""
    p = TB.table(spark, sf, "part")
    return p.select(
        "p_partkey",
        TX.split_part_first(F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))).alias("first_word"),
        TX.split_part_first(F.concat(F.lit("_"), F.col("p_brand"))).alias("leading_sep"),
        TX.split_part_first("p_brand").alias("no_sep"),
        TX.split_part_first(F.concat(F.col("p_type"), F.lit("_"), F.col("p_name"))).alias("type_part"),
    )


@register("scalar_year_cast", """
SELECT o_orderkey,
       TRY_CAST(CAST(year(o_orderdate) AS VARCHAR) || '.' || CAST(o_orderkey % 10 AS VARCHAR) AS INTEGER) AS year_decimal,
       TRY_CAST(' ' || CAST(year(o_orderdate) AS VARCHAR) || ' ' AS INTEGER) AS year_padded,
       TRY_CAST(o_orderpriority AS INTEGER) AS year_text
FROM orders""")
def scalar_year_cast_q(spark, sf):
    """lenient text -> INTEGER (rounding decimals, trimming, NULL on text)."""
    o = TB.table(spark, sf, "orders")
    y = F.year("o_orderdate").cast("string")
    return o.select(
        "o_orderkey",
        TX.year_int(F.concat(y, F.lit("."), (F.col("o_orderkey") % 10).cast("string"))).alias("year_decimal"),
        TX.year_int(F.concat(F.lit(" "), y, F.lit(" "))).alias("year_padded"),
        TX.year_int("o_orderpriority").alias("year_text"),
    )


@register("scalar_trim", r"""
SELECT p_partkey,
       regexp_replace(chr(9) || ' ' || p_name || chr(13) || chr(10), '^[\x01-\x20]+|[\x01-\x20]+$', '', 'g') AS trimmed,
       NULLIF(regexp_replace(chr(9) || p_brand || ' ', '^[\x01-\x20]+|[\x01-\x20]+$', '', 'g'), '') AS brand,
       NULLIF(regexp_replace(repeat(' ', p_size % 3) || chr(9), '^[\x01-\x20]+|[\x01-\x20]+$', '', 'g'), '') AS blank
FROM part""")
def scalar_trim_q(spark, sf):
    """Java-style trim (all chars <= U+0020) and blank -> NULL."""
    p = TB.table(spark, sf, "part")
    tab, cr, lf = F.lit("\t"), F.lit("\r"), F.lit("\n")
    return p.select(
        "p_partkey",
        TX.java_trim(F.concat(tab, F.lit(" "), F.col("p_name"), cr, lf)).alias("trimmed"),
        TX.blank_to_null(F.concat(tab, F.col("p_brand"), F.lit(" "))).alias("brand"),
        TX.blank_to_null(F.concat(F.repeat(F.lit(" "), F.col("p_size") % 3), tab)).alias("blank"),
    )


# ---------------------------------------------------------------- landing drops


# Option drop rows restated in SQL: status 'P' orders go to the no-year
# extract files (no shop_order_num column), the rest to dated files.
_OPT_LANDING = """
WITH r AS (
  SELECT 'DC' || CAST(l_suppkey AS VARCHAR) AS design_configuration,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END AS shop_order_num,
         CAST(l_orderkey AS VARCHAR) AS Engine_serial,
         'OPT' || CAST(l_partkey AS VARCHAR) AS option_assembly_num,
         CAST(year(l_shipdate) AS VARCHAR) AS build_year_2,
         o_orderstatus, o_orderpriority, o_orderdate, l_orderkey, l_linenumber,
         l_shipdate, l_partkey, l_suppkey,
         CASE WHEN o_orderstatus = 'P' THEN 'bom_option_extract_' || o_orderpriority || '_' ||
                   translate(CAST(l_orderkey // 8192 AS VARCHAR), '0123456789', 'abcdefghij') || '.csv'
              ELSE 'BOM_ESN_Option_' || strftime(o_orderdate, '%Y%m%d%H%M') || '.csv' END AS file_name,
         CASE WHEN o_orderstatus = 'P' THEN ',' WHEN day(o_orderdate) % 2 = 1 THEN '|' ELSE ',' END
           AS delimiter
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
fallback AS (
  SELECT file_name, build_year_2 AS fy
  FROM (SELECT file_name, build_year_2,
               ROW_NUMBER() OVER (PARTITION BY file_name
                                  ORDER BY l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey) AS rn
        FROM r WHERE o_orderstatus = 'P') t
  WHERE rn = 1),
files AS (
  SELECT DISTINCT r.file_name,
         CASE WHEN r.o_orderstatus = 'P' THEN f.fy ELSE strftime(r.o_orderdate, '%Y') END AS year,
         CASE WHEN r.o_orderstatus = 'P' THEN NULL ELSE strftime(r.o_orderdate, '%m') END AS month
  FROM r LEFT JOIN fallback f ON r.file_name = f.file_name),
periods AS (
  SELECT file_name, year, month,
         year || '_' || CASE WHEN CAST(COALESCE(month, '01') AS INTEGER) <= 6 THEN '01' ELSE '02' END
           AS period
  FROM files)
"""

_CFG_LANDING = """
WITH c AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS engine_serial_num,
         o_orderpriority || ', ' || o_orderstatus || '|' AS comment,
         'DC' || CAST(o_custkey AS VARCHAR) AS design_config_num,
         CAST(year(o_orderdate) AS VARCHAR) AS build_year,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS remark
  FROM orders)
"""

_CHILD_LANDING = """
WITH p AS (
  SELECT p_partkey, p_size, 'WC_Option_Child_' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '.csv' AS file_name,
         CASE p_size % 3 WHEN 0 THEN 'rev_option_no' WHEN 1 THEN 'Option_Number' ELSE 'OPTION_NO' END
           AS option_column,
         CASE WHEN p_size % 2 = 0 THEN '|' ELSE ',' END AS delimiter
  FROM part)
"""


@register("landing_scan", _OPT_LANDING + """
SELECT file_name, COUNT(*) + 1 AS lines FROM r GROUP BY file_name""")
def landing_scan_q(spark, sf):
    """Every ``*.csv`` of the option drop, with its line count."""
    drop = LD.list_drop(spark, FX.option_landing(spark, sf))
    counts = LD.lines(drop).groupBy("file").agg(F.count(F.lit(1)).alias("lines"))
    return (LD.file_rows(drop).join(counts, "file")
            .select(LD.base_of("path").alias("file_name"), "lines"))


@register("detect_delimiter", _OPT_LANDING + "SELECT DISTINCT file_name, delimiter FROM r")
def detect_delimiter_q(spark, sf):
    """Per-file delimiter from the first line (pipe only when it wins)."""
    folder = FX.option_landing(spark, sf)
    return LD.detect_delimiters(spark, folder).select("file_name", "delimiter")


@register("read_delimited", _CFG_LANDING + "SELECT * FROM c")
def read_delimited_q(spark, sf):
    """Mixed pipe/comma config drop, quoted delimiters inside a
    field, short rows (trailing field missing) NULL-padded."""
    folder = FX.config_landing(spark, sf)
    return LD.read_delimited(spark, folder).drop("_path", "_pos")


@register("short_rows", _CFG_LANDING + "SELECT engine_serial_num, remark FROM c")
def short_rows_q(spark, sf):
    """Rows missing their trailing field read as NULL, not dropped."""
    folder = FX.config_landing(spark, sf)
    return LD.read_delimited(spark, folder).select("engine_serial_num", "remark")


@register("ingest_bom_config", _CFG_LANDING + """
SELECT engine_serial_num AS Engine_serial, design_config_num AS design_config_2, build_year FROM c""")
def ingest_bom_config_q(spark, sf):
    """Config landing drop -> (Engine_serial, design_config_2, build_year)."""
    return IG.ingest_bom_config(spark, FX.config_landing(spark, sf))


@register("ingest_option_child", q("SELECT * FROM child_part_option"))
def ingest_option_child_q(spark, sf):
    """Option-child drop with header synonyms -> (Option_Number, Child_Part_Number)."""
    return IG.ingest_option_child(spark, FX.child_landing(spark, sf))


@register("header_synonyms", _CHILD_LANDING + """
SELECT DISTINCT file_name, option_column, delimiter FROM p""")
def header_synonyms_q(spark, sf):
    """Which header each option-child file's option column was found under."""
    files = IG.child_files(spark, FX.child_landing(spark, sf))
    both = F.col(f"at_{S.CHILD}").isNotNull()
    return files.select("file_name", F.when(both, F.get("names", F.col(f"at_{S.OPTION_NUMBER}")))
                        .alias("option_column"), "delimiter")


@register("ingest_bom_option", _OPT_LANDING + """
SELECT r.design_configuration, r.shop_order_num, r.Engine_serial, r.option_assembly_num,
       r.build_year_2, p.period
FROM r JOIN periods p ON r.file_name = p.file_name""")
def ingest_bom_option_q(spark, sf):
    """Option drop -> five kept columns + half-year period of the file."""
    return IG.ingest_bom_option(spark, FX.option_landing(spark, sf))


@register("ingest_bom_option_monthly", _OPT_LANDING + """
SELECT r.design_configuration, r.shop_order_num, r.Engine_serial, r.option_assembly_num,
       r.build_year_2, p.period
FROM r JOIN periods p ON r.file_name = p.file_name""")
def ingest_bom_option_monthly_q(spark, sf):
    """C3 on the same rows dropped as one file per month (fewer, larger files,
    closer to production drops): same rows and periods as ``ingest_bom_option``."""
    return IG.ingest_bom_option(spark, FX.option_landing(spark, sf, monthly=True))


@register("rename_keep", _OPT_LANDING + """
SELECT design_configuration, shop_order_num, Engine_serial, option_assembly_num, build_year_2 FROM r""")
def rename_keep_q(spark, sf):
    """Rename map + keep-list over files with differently named/ordered headers."""
    return IG.ingest_bom_option(spark, FX.option_landing(spark, sf), with_period=False)


@register("missing_columns", _OPT_LANDING + """
SELECT DISTINCT file_name, CASE WHEN o_orderstatus = 'P' THEN 'shop_order_num' ELSE '' END AS missing
FROM r""")
def missing_columns_q(spark, sf):
    """Kept columns absent from each option file's header (NULL-filled)."""
    files = IG.option_files(spark, FX.option_landing(spark, sf))
    absent = [F.when(F.col(f"at_{c}").isNull(), F.lit(c)) for c in S.OPTION_KEEP]
    return files.select("file_name", F.concat_ws(",", *absent).alias("missing"))


_REJECTED = """
SELECT 'child' AS drop_name,
       'WC_Option_Child_' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '.csv' AS file_name,
       'no column for: ' || CASE WHEN p_size % 77 = 0 THEN 'Option_Number, Child_Part_Number'
                                 WHEN p_size % 7 = 0 THEN 'Child_Part_Number'
                                 ELSE 'Option_Number' END AS reason
FROM part WHERE p_size % 7 = 0 OR p_size % 11 = 0
UNION
SELECT 'config', 'BOM_ESN_Config_' || strftime(o_orderdate, '%Y%m') || '.csv',
       'no column for: design_config_2'
FROM orders WHERE month(o_orderdate) = 5"""


@register("rejected_files", _REJECTED)
def rejected_files_q(spark, sf):
    """Files of the child and config drops that lack a column, and why they were
    skipped, as the side output of their ingests."""
    child = IG.child_ingest(spark, FX.child_landing(spark, sf, "child-faulty")).rejected
    config = IG.config_ingest(spark, FX.config_landing(spark, sf, faulty=True)).rejected
    return (child.withColumn("drop_name", F.lit("child"))
            .unionByName(config.withColumn("drop_name", F.lit("config")))
            .select("drop_name", "file_name", "reason"))


@register("rows_beside_rejects", q("""
SELECT Option_Number, Child_Part_Number
FROM child_part_option JOIN part ON Option_Number = 'OPT' || CAST(p_partkey AS VARCHAR)
WHERE p_size % 7 <> 0 AND p_size % 11 <> 0"""))
def rows_beside_rejects_q(spark, sf):
    """The rows of the child drop's other files."""
    return IG.child_ingest(spark, FX.child_landing(spark, sf, "child-faulty")).rows


@register("hidden_names", """
SELECT CASE p_size % 3 WHEN 1 THEN '_' WHEN 2 THEN '.' ELSE '' END || 'WC_Option_Child_' ||
       lpad(CAST(p_size AS VARCHAR), 2, '0') || '.csv' AS file_name, 2 * COUNT(*) AS records
FROM part GROUP BY p_size""")
def hidden_names_q(spark, sf):
    """Records per file of a drop of which most names begin with ``_`` or ``.``."""
    rows = IG.ingest_option_child(spark, FX.child_landing(spark, sf, "child-hidden"),
                                  with_source=True)
    return rows.groupBy(LD.base_of("_path").alias("file_name")).agg(
        F.count(F.lit(1)).alias("records"))


@register("filename_period", _OPT_LANDING + """
SELECT DISTINCT r.file_name,
       NULLIF(regexp_extract(r.file_name, '(19|20)\\d{2}', 0), '') AS year,
       p.month,
       CASE WHEN r.o_orderstatus = 'P' THEN NULL ELSE p.period END AS name_period
FROM r JOIN periods p ON r.file_name = p.file_name""")
def filename_period_q(spark, sf):
    """year, month and half-year period from each file name alone
    (NULL period where the name has no year)."""
    rows = FX.option_rows(spark, sf).select(FX.option_file_name().alias("file_name")).distinct()
    y, m = PD.year_from_name("file_name"), PD.month_from_name("file_name")
    return rows.select("file_name", y.alias("year"), m.alias("month"),
                       F.when(y.isNotNull(), PD.period_of(y, m)).alias("name_period"))


@register("period_fallback", _OPT_LANDING + """
SELECT file_name, year, period FROM periods WHERE file_name LIKE 'bom_option_extract_%'""")
def period_fallback_q(spark, sf):
    """F8: files without a year in the name take it from their first data row."""
    drop = LD.list_drop(spark, FX.option_landing(spark, sf))
    per = IG.file_periods(spark, IG.option_files(spark, drop), drop)
    return per.where(PD.year_from_name("file_name").isNull()).select("file_name", "year", "period")


@register("ingest_counts", _OPT_LANDING + """
SELECT p.period, COUNT(*) AS records FROM r JOIN periods p ON r.file_name = p.file_name
GROUP BY p.period""")
def ingest_counts_q(spark, sf):
    """A5: records per half-year group."""
    return IG.ingest_counts(IG.ingest_bom_option(spark, FX.option_landing(spark, sf)), "period")


@register("period_order", _OPT_LANDING + """
SELECT DISTINCT period, CAST(split_part(period, '_', 1) AS INTEGER) AS year_num,
       CAST(split_part(period, '_', 2) AS INTEGER) AS half_num
FROM periods ORDER BY year_num, half_num""")
def period_order_q(spark, sf):
    """Period groups in natural (year, half) integer order."""
    per = IG.ingest_bom_option(spark, FX.option_landing(spark, sf)).select("period").distinct()
    y, h = PD.period_parts("period")
    return per.select("period", y.alias("year_num"), h.alias("half_num")) \
              .orderBy("year_num", "half_num")


# ---------------------------------------------------------------- sinks (K1-K7), S5, S6, S8


@register("csv_roundtrip", q("SELECT * FROM keyed"))
def csv_roundtrip_q(spark, sf):
    """K1 + S4: keyed rows to header CSV and back with stated string/int
    types (serials keep leading zeros: nothing is inferred)."""
    out = scratch_path(spark, "csv-keyed")
    SK.write_csv(_keyed(spark, sf), out)
    return LD.read_typed_csv(spark, [out], S.KEYED)


@register("typed_multi_csv", q("SELECT * FROM keyed"))
def typed_multi_csv_q(spark, sf):
    """Many CSV files (one folder per build year) read as one typed
    table."""
    out = scratch_path(spark, "csv-keyed-years")
    (SK.rebalanced_for(_keyed(spark, sf), [S.BUILD_YEAR]).write.mode("overwrite")
     .partitionBy(S.BUILD_YEAR)
     .option("header", True).option("quote", '"').option("escape", '"').csv(out))
    # build_year lives in the folder names; read the files by a pattern and
    # recover it from each file's path
    schema = T.StructType([f for f in S.KEYED.fields if f.name != S.BUILD_YEAR])
    df = LD.read_typed_csv(spark, f"{out}/*/*.csv", schema)
    year = F.regexp_extract(F.col("_metadata.file_path"), S.BUILD_YEAR + r"=(\d+)", 1)
    return df.select(S.ENGINE_SERIAL, S.OPTION, S.KEY, year.cast("int").alias(S.BUILD_YEAR))


@register("csv_to_parquet", q("SELECT * FROM keyed"))
def csv_to_parquet_q(spark, sf):
    """K7: typed CSV -> ZSTD Parquet, then scanned as Parquet."""
    src = scratch_path(spark, "csv-src")
    SK.write_csv(_keyed(spark, sf), src)
    return SK.csv_to_parquet(spark, [src], S.KEYED, scratch_path(spark, "pq-from-csv"))


@register("parquet_roundtrip", q("SELECT * FROM rolled"))
def parquet_roundtrip_q(spark, sf):
    """Roll-up written as ZSTD Parquet and scanned back."""
    out = scratch_path(spark, "pq-rollup")
    SK.write_parquet(_rollup(spark, sf), out)
    return spark.read.parquet(out)


@register("year_export", q("SELECT * FROM rolled"))
def year_export_q(spark, sf):
    """Year-ordered export (range-partitioned, sorted parts),
    read back from its part files by a pattern."""
    out = scratch_path(spark, "year-export")
    SK.export_year_ordered(_rollup(spark, sf), out, then=[S.COUNT])
    return spark.read.parquet(f"{out}/*.parquet")


@register("reconcile_counts", q("""
SELECT COUNT(*) AS expected_rows, COUNT(*) AS actual_rows, TRUE AS match FROM rolled"""))
def reconcile_counts_q(spark, sf):
    """Rows exported by the year-wise export vs rows of the roll-up."""
    rollup = _rollup_table(spark, sf)
    out = scratch_path(spark, "year-export-rc")
    SK.export_year_ordered(rollup, out, then=[S.COUNT])
    return AU.reconcile(rollup, spark.read.parquet(out))


@register("half_year_partition", _OPT_LANDING + """
SELECT r.design_configuration, r.shop_order_num, r.Engine_serial, r.option_assembly_num,
       r.build_year_2, p.period
FROM r JOIN periods p ON r.file_name = p.file_name""")
def half_year_partition_q(spark, sf):
    """K4: option rows written partitioned by half-year period, read back."""
    out = scratch_path(spark, "option-by-period")
    SK.write_parquet(IG.ingest_bom_option(spark, FX.option_landing(spark, sf)), out,
                     partition_by=["period"])
    df = spark.read.parquet(out)
    return df.select(*S.OPTION_KEEP, F.col("period").cast("string").alias("period"))


@register("append_union_all", q("SELECT * FROM bom_config UNION ALL SELECT * FROM bom_config"))
def append_union_all_q(spark, sf):
    """Append to a table with the same columns (no de-duplication):
    the second load doubles every row, as the reference's re-run did."""
    out = scratch_path(spark, "config-append")
    cfg = TB.bom_config(spark, sf)
    SK.append_table(spark, cfg, out)
    SK.append_table(spark, cfg, out)
    return spark.read.parquet(out)


@register("empty_schema", q("SELECT * FROM latest_rows WHERE 1 = 0"))
def empty_schema_q(spark, sf):
    """A roll-up without rows (no build year is negative) is written,
    keeps its schema, and the next stage reads it."""
    out = scratch_path(spark, "empty-rollup")
    SK.write_parquet(_rollup(spark, sf).where(F.col(S.BUILD_YEAR) < 0), out)
    return latest_per_key(spark.read.parquet(out))


@register("lenient_csv", q("""
SELECT CAST(Engine_serial_count AS VARCHAR) AS Engine_serial_count, option_assembly_num,
       esn_config_design_config_Shop_order_num, CAST(build_year AS VARCHAR) AS build_year,
       Child_Part_Number
FROM expanded_rows"""))
def lenient_csv_q(spark, sf):
    """The expansion written as CSV and read back all-VARCHAR, leniently."""
    out = scratch_path(spark, "csv-expanded")
    SK.write_csv(_expanded(spark, sf), out)
    return LD.read_lenient_csv(spark, out, [f.name for f in S.EXPANDED.fields])


@register("best_per_child_csv", q("""
SELECT CAST(Engine_serial_count AS VARCHAR) AS Engine_serial_count, option_assembly_num,
       esn_config_design_config_Shop_order_num, CAST(build_year AS VARCHAR) AS build_year,
       Child_Part_Number
FROM best_rows"""))
def best_per_child_csv_q(spark, sf):
    """W2 as the reference ran it: rank the expansion CSV read all-VARCHAR,
    comparing year and count as integers."""
    out = scratch_path(spark, "csv-expanded-w2")
    SK.write_csv(_expanded(spark, sf), out)
    text = LD.read_lenient_csv(spark, out, [f.name for f in S.EXPANDED.fields])
    return best_per_child(contenders(SK.checkpoint_table(text, "expanded-text")))


def _damaged_export(spark, rollup):
    """A year-wise export of the roll-up whose newest year lost the options that end in 7,
    whose oldest year is gone, and which has a year -1 that it should not have."""
    out = scratch_path(spark, "year-folders")
    SK.export_by_year(rollup, out)
    ends = rollup.agg(F.max(S.BUILD_YEAR).alias("newest"), F.min(S.BUILD_YEAR).alias("oldest"))
    year = rollup.crossJoin(F.broadcast(ends))            # one row
    newest = year.where("build_year = newest").drop("newest", "oldest")
    SK.write_parquet(newest.where(~F.col(S.OPTION).endswith("7")), out, partition_by=[S.BUILD_YEAR])
    SK.write_parquet(newest.where(F.col(S.OPTION).endswith("7")).withColumn(
        S.BUILD_YEAR, F.lit(-1)), out, partition_by=[S.BUILD_YEAR])
    oldest = ends.collect()[0]["oldest"]
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/{S.BUILD_YEAR}={oldest}")
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return out


@register("year_verify", q("""
, y AS (SELECT build_year, COUNT(*) AS n, COUNT(*) FILTER (option_assembly_num LIKE '%7') AS lost
        FROM rolled GROUP BY build_year)
SELECT build_year AS year, n AS expected_rows,
       CASE WHEN build_year = (SELECT MIN(build_year) FROM y) THEN 0
            WHEN build_year = (SELECT MAX(build_year) FROM y) THEN n - lost ELSE n END AS actual_rows,
       build_year <> (SELECT MIN(build_year) FROM y)
         AND NOT (build_year = (SELECT MAX(build_year) FROM y) AND lost > 0) AS match
FROM y
UNION ALL
SELECT -1, 0, lost, FALSE FROM y WHERE build_year = (SELECT MAX(build_year) FROM y) AND lost > 0"""))
def year_verify_q(spark, sf):
    """The year-wise export verified year by year: here one year lost rows, one is
    gone and one is there that should not be."""
    rollup = _rollup_table(spark, sf)
    return SK.verify_years(rollup, _damaged_export(spark, rollup))


@register("year_repair", q("SELECT * FROM rolled"))
def year_repair_q(spark, sf):
    """K5: the damaged export with only its failing years written again, read back."""
    rollup = _rollup_table(spark, sf)
    out = _damaged_export(spark, rollup)
    SK.repair_years(rollup, out)
    return spark.read.schema(S.ROLLUP).parquet(out).select(*[f.name for f in S.ROLLUP])


_OPTION_SQL = """
SELECT 'DC' || CAST(l_suppkey AS VARCHAR) AS design_configuration,
       CAST(l_linenumber AS VARCHAR) AS shop_order_num,
       CAST(l_orderkey AS VARCHAR) AS Engine_serial,
       'OPT' || CAST(l_partkey AS VARCHAR) AS option_assembly_num,
       CAST(year(l_shipdate) AS VARCHAR) AS build_year_2
FROM lineitem"""


@register("csv_append_option", _OPTION_SQL + """
WHERE (l_returnflag = 'A' AND l_linenumber <> 1) OR l_returnflag = 'R'""")
def csv_append_option_q(spark, sf):
    """K3 by the option rule: rows are added to a CSV table that holds short rows, which
    are dropped."""
    out = scratch_path(spark, "option-text-table")
    FX.option_text_table(spark, sf, out, "A")
    new = TB.bom_option_rows(TB.table(spark, sf, "lineitem").where("l_returnflag = 'R'"))
    SK.append_csv(new.select(*S.OPTION_KEEP), out, short_rows="drop")
    return LD.read_typed_csv(spark, [out], S.BOM_OPTION)


@register("csv_append_child", q("""
SELECT Option_Number, CASE WHEN p_size % 5 <> 0 THEN Child_Part_Number END AS Child_Part_Number
FROM child_part_option JOIN part ON Option_Number = 'OPT' || CAST(p_partkey AS VARCHAR)
UNION ALL SELECT * FROM child_part_option"""))
def csv_append_child_q(spark, sf):
    """K3 by the option-child rule: short rows of the existing table are padded."""
    out = scratch_path(spark, "child-text-table")
    FX.child_text_table(spark, sf, out)
    SK.append_csv(TB.child_part_option(spark, sf), out, short_rows="pad", pipe_on_tie=True)
    return LD.read_typed_csv(spark, [out], S.CHILD_PART_OPTION)


# ---------------------------------------------------------------- audits / diagnostics

@register("stage_audit", q("""
, a AS (
  SELECT 'serial_join' AS stage, (SELECT COUNT(*) FROM bom_option) AS input_rows,
         (SELECT COUNT(*) FROM serial_joined) AS output_rows
  UNION ALL SELECT 'keyed', (SELECT COUNT(*) FROM serial_joined), (SELECT COUNT(*) FROM keyed)
  UNION ALL SELECT 'rollup', (SELECT COUNT(*) FROM keyed), (SELECT COUNT(*) FROM rolled)
  UNION ALL SELECT 'latest', (SELECT COUNT(*) FROM rolled), (SELECT COUNT(*) FROM latest_rows)
  UNION ALL SELECT 'expanded', (SELECT COUNT(*) FROM latest_rows), (SELECT COUNT(*) FROM expanded_rows)
  UNION ALL SELECT 'best_per_child', (SELECT COUNT(*) FROM expanded_rows), (SELECT COUNT(*) FROM best_rows)
  UNION ALL SELECT 'bom_option', NULL, (SELECT COUNT(*) FROM bom_option)),
s AS (
  SELECT 'TOTAL' AS stage, CAST(SUM(input_rows) AS BIGINT) AS input_rows,
         CAST(SUM(output_rows) AS BIGINT) AS output_rows
  FROM a WHERE input_rows IS NOT NULL
  UNION ALL
  SELECT 'NET', (SELECT input_rows FROM a WHERE stage = 'serial_join'),
         (SELECT output_rows FROM a WHERE stage = 'best_per_child')),
r AS (SELECT * FROM a UNION ALL SELECT * FROM s)
SELECT stage, input_rows, output_rows, output_rows - input_rows AS delta,
       CASE WHEN input_rows > 0
            THEN CAST(ROUND((output_rows - input_rows) * 100.0 / input_rows, 2) AS DOUBLE) END
         AS pct_change
FROM r"""))
def stage_audit_q(spark, sf):
    """Rows in and out of every stage, delta and percent change, observed while the
    stages are written."""
    from .workflow import run_audited
    return run_audited(*_inputs(spark, sf))[1]


@register("key_overlap", q("""
SELECT (SELECT COUNT(DISTINCT Engine_serial) FROM bom_option) AS left_keys,
       (SELECT COUNT(DISTINCT Engine_serial) FROM bom_config) AS right_keys,
       (SELECT COUNT(*) FROM (SELECT Engine_serial FROM bom_option INTERSECT
                              SELECT Engine_serial FROM bom_config)) AS common_keys,
       (SELECT COUNT(*) FROM (SELECT lower(Engine_serial) FROM bom_option INTERSECT
                              SELECT lower(Engine_serial) FROM bom_config)) AS common_keys_ignore_case"""))
def key_overlap_q(spark, sf):
    """Do option and config serials overlap (exactly / ignoring case)?"""
    return AU.key_overlap(TB.bom_option(spark, sf), TB.bom_config(spark, sf), S.ENGINE_SERIAL)


@register("key_case_examples", """
SELECT 'OPT' || CAST(p_partkey AS VARCHAR) AS left_key,
       'opt' || CAST(p_partkey AS VARCHAR) AS right_key
FROM part
WHERE p_partkey % 2 = 1 AND p_partkey IN (SELECT l_partkey FROM lineitem)
ORDER BY right_key LIMIT 3""")
def key_case_examples_q(spark, sf):
    """Example pairs of option numbers that differ only by case (the child
    side of every odd part is lower-cased)."""
    child = TB.table(spark, sf, "part").select(F.concat(
        F.when(F.col("p_partkey") % 2 == 1, "opt").otherwise("OPT"),
        F.col("p_partkey").cast("string")).alias(S.OPTION))
    return AU.key_case_examples(TB.bom_option(spark, sf), child, S.OPTION)


@register("drop_all_empty", """
SELECT 'DC' || CAST(l_suppkey AS VARCHAR) AS design_configuration,
       CAST(l_linenumber AS VARCHAR) AS shop_order_num,
       CAST(l_orderkey AS VARCHAR) AS Engine_serial,
       'OPT' || CAST(l_partkey AS VARCHAR) AS option_assembly_num,
       CAST(year(l_shipdate) AS VARCHAR) AS build_year_2
FROM lineitem WHERE l_returnflag <> 'N'""")
def drop_all_empty_q(spark, sf):
    """P5: option rows whose kept fields are all blank are dropped (here the
    fields of every 'N'-flag line are blanked with spaces/tabs first)."""
    li = TB.table(spark, sf, "lineitem")
    blank = F.col("l_returnflag") == "N"
    def field(c):
        return F.when(blank, F.lit(" \t ")).otherwise(c)
    raw = li.select(
        field(F.concat(F.lit("DC"), F.col("l_suppkey").cast("string"))).alias("design_configuration"),
        field(F.col("l_linenumber").cast("string")).alias(S.SHOP_ORDER),
        field(F.col("l_orderkey").cast("string")).alias(S.ENGINE_SERIAL),
        field(F.concat(F.lit("OPT"), F.col("l_partkey").cast("string"))).alias(S.OPTION),
        field(F.year("l_shipdate").cast("string")).alias("build_year_2"))
    cleaned = raw.select(*[TX.clean_field(c).alias(c) for c in S.OPTION_KEEP])
    return cleaned.na.drop(how="all", subset=S.OPTION_KEEP)


# ---------------------------------------------------------------- streaming

@register("incremental_ingest", _CFG_LANDING + """
SELECT engine_serial_num AS Engine_serial, design_config_num AS design_config_2, build_year FROM c""")
def incremental_ingest_q(spark, sf):
    """The config drop ingested by the file ledger, run twice:
    the second run finds no new file, so every row is present exactly once."""
    landing = FX.config_landing(spark, sf)
    table_dir = scratch_path(spark, "cfg-incremental")
    ledger = scratch_path(spark, "cfg-incremental-ledger")
    def normalizer(sp, paths):
        return IG.ingest_bom_config(sp, paths)
    incremental_ingest(spark, landing, table_dir, ledger, normalizer, max_files_per_trigger=25)
    incremental_ingest(spark, landing, table_dir, ledger, normalizer, max_files_per_trigger=25)
    return read_ingested(spark, table_dir, S.BOM_CONFIG).drop("batch_id")


@register("period_files", _OPT_LANDING + """
SELECT DISTINCT period, CAST(split_part(period, '_', 1) AS INTEGER) AS year_num,
       CAST(split_part(period, '_', 2) AS INTEGER) AS half_num
FROM periods ORDER BY year_num, half_num""")
def period_files_q(spark, sf):
    """F13/F14/O4 on real output files: list the half-year partitioned option
    output, take each data file's folder name, strip its prefix, keep the
    digits of year and half, and order the periods as integers."""
    out = scratch_path(spark, "option-period-files")
    SK.write_parquet(IG.ingest_bom_option(spark, FX.option_landing(spark, sf)), out,
                     partition_by=["period"])
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
               .option("recursiveFileLookup", True).load(out).select("path"))
    folder = F.regexp_extract(F.col("path"), r"([^/]+)/[^/]+$", 1)       # period=YYYY_HH
    label = F.regexp_replace(TX.url_decode_path(folder), r"^period=", "")
    parts = F.split(label, "_")
    year = TX.digits_only(parts.getItem(0)).try_cast("int")
    half = TX.digits_only(parts.getItem(1)).try_cast("int")
    return (listing.select(label.alias("period"), year.alias("year_num"), half.alias("half_num"))
            .distinct().orderBy("year_num", "half_num"))


@register("base_names", _OPT_LANDING + """
SELECT DISTINCT 'Csv_bom_esn_option_' || period || '.csv' AS file_name,
       'Csv_bom_esn_option_' || period AS base, CAST(split_part(period, '_', 1) AS INTEGER) AS year_num,
       CAST(split_part(period, '_', 2) AS INTEGER) AS half_num
FROM periods""")
def base_names_q(spark, sf):
    """the option ingest's files, one per period, listed: each name without its
    extension, and the integers that are left of it without its prefix."""
    out = scratch_path(spark, "period-text-files")
    FX.period_text_files(spark, IG.ingest_bom_option(spark, FX.option_landing(spark, sf)), out)
    base = TX.base_name("file_name")
    year, half = PD.period_parts(F.regexp_replace(base, "^Csv_bom_esn_option_", ""))
    return (LD.list_files(spark, out).select(LD.base_of("path").alias("file_name"))
            .select("file_name", base.alias("base"), year.alias("year_num"), half.alias("half_num")))


# ---------------------------------------------------------------- C10: the whole report


@register("workflow_report", q_landing("SELECT * FROM best_rows"))
def workflow_report_q(spark, sf):
    """Landing drops -> the three normalizers -> serial join -> key ->
    roll-up (checkpointed) -> latest -> best row per child, end to end."""
    from .workflow import run_workflow
    result = run_workflow(
        IG.ingest_bom_option(spark, FX.option_landing(spark, sf), with_period=False),
        IG.ingest_bom_config(spark, FX.config_landing(spark, sf)),
        IG.ingest_option_child(spark, FX.child_landing(spark, sf)))
    return result.best_per_child
