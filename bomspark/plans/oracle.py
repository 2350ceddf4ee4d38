"""DuckDB SQL for each registered query (the driver's correctness oracle).

The CTEs state the pipeline from its definition over the driver's tables
(counts of distinct pairs, first rows of ordered groups, membership), not the
way the Spark plans compute it.  CTE names avoid SQL keywords (``rollup``).
"""

from __future__ import annotations

BASE = """
WITH bom_option AS (
  SELECT 'DC' || CAST(l_suppkey AS VARCHAR) AS design_configuration,
         CAST(l_linenumber AS VARCHAR) AS shop_order_num,
         CAST(l_orderkey AS VARCHAR) AS Engine_serial,
         'OPT' || CAST(l_partkey AS VARCHAR) AS option_assembly_num,
         CAST(year(l_shipdate) AS VARCHAR) AS build_year_2
  FROM lineitem),
bom_config AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS Engine_serial,
         'DC' || CAST(o_custkey AS VARCHAR) AS design_config_2,
         CAST(year(o_orderdate) AS INTEGER) AS build_year
  FROM orders),
child_part_option AS (
  SELECT 'OPT' || CAST(p_partkey AS VARCHAR) AS Option_Number,
         p_brand || '-' || CAST(p_size AS VARCHAR) AS Child_Part_Number FROM part
  UNION ALL
  SELECT 'OPT' || CAST(p_partkey AS VARCHAR),
         p_type || '-' || CAST(p_size AS VARCHAR) FROM part),
serial_joined AS (
  SELECT Engine_serial, option_assembly_num, design_config_2, shop_order_num, build_year
  FROM bom_config JOIN bom_option USING (Engine_serial)),
keyed AS (
  SELECT Engine_serial, option_assembly_num,
         CASE WHEN design_config_2 IS NOT NULL AND shop_order_num IS NOT NULL
              THEN concat(design_config_2, '_', shop_order_num) END
           AS esn_config_design_config_Shop_order_num,
         build_year
  FROM serial_joined),
engines AS (
  SELECT DISTINCT string_split(esn_config_design_config_Shop_order_num, '_')[1] AS config_id,
         Engine_serial
  FROM keyed),
cfg_counts AS (
  SELECT config_id, count(Engine_serial) AS Engine_serial_count FROM engines GROUP BY config_id),
rolled AS (
  SELECT (SELECT Engine_serial_count FROM cfg_counts
          WHERE config_id = string_split(k.esn_config_design_config_Shop_order_num, '_')[1])
           AS Engine_serial_count,
         option_assembly_num, esn_config_design_config_Shop_order_num, build_year
  FROM keyed k WHERE esn_config_design_config_Shop_order_num IS NOT NULL),
latest_rows AS (
  SELECT unnest(winner) FROM (
    SELECT first(r ORDER BY r.build_year DESC NULLS LAST, r.Engine_serial_count DESC NULLS LAST,
                 r.option_assembly_num NULLS LAST) AS winner
    FROM rolled r GROUP BY r.esn_config_design_config_Shop_order_num)),
key_pairs AS (
  SELECT esn_config_design_config_Shop_order_num, option_assembly_num FROM rolled
  WHERE esn_config_design_config_Shop_order_num IN (
    SELECT esn_config_design_config_Shop_order_num FROM latest_rows)
  GROUP BY ALL),
children AS (
  SELECT esn_config_design_config_Shop_order_num, Child_Part_Number
  FROM child_part_option JOIN key_pairs ON option_assembly_num = Option_Number),
expanded_rows AS (
  SELECT Engine_serial_count, option_assembly_num, esn_config_design_config_Shop_order_num,
         build_year, Child_Part_Number
  FROM children JOIN latest_rows USING (esn_config_design_config_Shop_order_num)),
best_rows AS (
  SELECT unnest(winner) FROM (
    SELECT first(e ORDER BY e.build_year DESC NULLS LAST, e.Engine_serial_count DESC NULLS LAST,
                 e.esn_config_design_config_Shop_order_num NULLS LAST,
                 e.option_assembly_num NULLS LAST) AS winner
    FROM expanded_rows e GROUP BY e.Child_Part_Number))
"""


def q(select: str) -> str:
    """The shared CTEs followed by one final SELECT."""
    return BASE + select.strip() + "\n"


_OPTION_CTE_START = "WITH bom_option AS ("
_OPTION_CTE_END = "  FROM lineitem),"

# The option rows as they arrive through the landing drop: orders in status
# 'P' land in files without a shop_order_num column.
LANDING_OPTION_CTE = """WITH bom_option AS (
  SELECT 'DC' || CAST(l_suppkey AS VARCHAR) AS design_configuration,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END AS shop_order_num,
         CAST(l_orderkey AS VARCHAR) AS Engine_serial,
         'OPT' || CAST(l_partkey AS VARCHAR) AS option_assembly_num,
         CAST(year(l_shipdate) AS VARCHAR) AS build_year_2
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),"""


def q_landing(select: str) -> str:
    """Like ``q`` but with the option rows of the landing drop."""
    start = BASE.index(_OPTION_CTE_START)
    end = BASE.index(_OPTION_CTE_END) + len(_OPTION_CTE_END)
    return BASE[:start] + LANDING_OPTION_CTE + BASE[end:] + select.strip() + "\n"
