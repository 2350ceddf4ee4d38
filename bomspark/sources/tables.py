"""Typed scans of the driver's Parquet tables and their mapping onto the
pipeline's input tables (bom_option, bom_config, child_part_option).

The mapping is a pure projection of ``lineitem`` / ``orders`` / ``part`` so
Catalyst prunes every other column at the Parquet scan (``ReadSchema`` holds
only the referenced fields).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Plain Parquet scan of one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _txt(c: str):
    return F.col(c).cast("string")


def bom_option(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option rows: one per lineitem (serial = order, option = part)."""
    return bom_option_rows(table(spark, sf_dir, "lineitem")).select(*S.OPTION_KEEP)


def bom_option_rows(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` with the option columns."""
    return lineitem.withColumns({
        "design_configuration": F.concat(F.lit("DC"), _txt("l_suppkey")),
        S.SHOP_ORDER: _txt("l_linenumber"),
        S.ENGINE_SERIAL: _txt("l_orderkey"),
        S.OPTION: F.concat(F.lit("OPT"), _txt("l_partkey")),
        "build_year_2": F.year("l_shipdate").cast("string"),
    })


def bom_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Config rows: one per order (serial -> design config + build year)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        _txt("o_orderkey").alias(S.ENGINE_SERIAL),
        F.concat(F.lit("DC"), _txt("o_custkey")).alias(S.DESIGN_CONFIG),
        F.year("o_orderdate").cast("int").alias(S.BUILD_YEAR),
    )


def child_part_option(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option -> child rows: two children per part (brand-size, type-size)."""
    p = table(spark, sf_dir, "part")
    opt = F.concat(F.lit("OPT"), _txt("p_partkey"))
    size = _txt("p_size")
    by_brand = p.select(opt.alias(S.OPTION_NUMBER),
                        F.concat(F.col("p_brand"), F.lit("-"), size).alias(S.CHILD))
    by_type = p.select(opt.alias(S.OPTION_NUMBER),
                       F.concat(F.col("p_type"), F.lit("-"), size).alias(S.CHILD))
    return by_brand.unionByName(by_type)
