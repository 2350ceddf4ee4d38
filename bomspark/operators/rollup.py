"""Configuration key, distinct-engine counts and their join-back.

Scale notes
-----------
* ``count_distinct`` is planned as a two-level aggregate: partial
  de-duplication on (config_id, serial) before the first shuffle, then a
  partial count per config_id before the second - a hot config is
  pre-aggregated map-side instead of landing whole in one task.
* The join-back is an equi-join on ``config_id`` against a table with one row
  per config; AQE's skew join splits a hot config on the big side (see
  ``config_engine_counts``), and AQE turns it into a broadcast only when the
  measured count table is small.
* ``keyed`` is consumed twice (count and join-back) inside one job; column
  pruning makes the two branches differ, so each evaluates the serial join.
  Measured at sf0.1 this was cheaper than writing ``keyed`` out; the
  roll-up itself, which later stages read twice, is written once instead
  (``sinks.checkpoint_table``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import concat_key, split_part_first
from .joins import require_columns, splittable


def build_order_key(serial_joined: DataFrame) -> DataFrame:
    """``design_config_2 || '_' || shop_order_num`` (NULL if either is NULL).

    Output: Engine_serial, option_assembly_num, esn_config_design_config_Shop_order_num, build_year.
    """
    require_columns(serial_joined, [S.ENGINE_SERIAL, S.OPTION, S.DESIGN_CONFIG, S.SHOP_ORDER,
                                    S.BUILD_YEAR], "serial join")
    return serial_joined.select(
        S.ENGINE_SERIAL, S.OPTION,
        concat_key(S.DESIGN_CONFIG, S.SHOP_ORDER).alias(S.KEY),
        F.col(S.BUILD_YEAR).cast("int").alias(S.BUILD_YEAR),
    )


def with_config_id(keyed: DataFrame) -> DataFrame:
    """Adds ``config_id`` = text before the first '_' of the key (F1)."""
    return keyed.withColumn(S.CONFIG_ID, split_part_first(S.KEY, "_"))


def config_counts(keyed: DataFrame) -> DataFrame:
    """A1: exact ``COUNT(DISTINCT Engine_serial)`` per config_id over all rows.

    NULL serials are not counted; a NULL config_id forms its own group (as
    GROUP BY does) and is dropped later by the join-back."""
    return (with_config_id(keyed)
            .groupBy(S.CONFIG_ID)
            .agg(F.count_distinct(S.ENGINE_SERIAL).alias(S.COUNT)))


def config_engine_counts(keyed: DataFrame) -> DataFrame:
    """C6 (A1 + J2): every keyed row with its config's distinct-engine count.

    Output: Engine_serial_count, option_assembly_num, esn_config_design_config_Shop_order_num, build_year.
    Rows with a NULL key (so NULL config_id) are dropped by the inner join.
    """
    rows = with_config_id(keyed).where(F.col(S.CONFIG_ID).isNotNull())
    counts = (rows.groupBy(S.CONFIG_ID)
              .agg(F.count_distinct(S.ENGINE_SERIAL).alias(S.COUNT))
              .withColumnRenamed(S.CONFIG_ID, "_cid"))
    # The count table leaves its aggregate already hash-partitioned on the
    # config, so the join would reuse that partitioning - and AQE can only
    # split a skewed join whose *both* inputs are plain shuffle stages.  A
    # rebalance (round-robin, coalesced by AQE) of the one-row-per-config
    # count table makes the join shuffle both sides on config_id itself, so
    # a hot config on the keyed side is split across tasks
    # (SortMergeJoin(skew=true)).
    counts = splittable(counts)
    joined = rows.join(counts, rows[S.CONFIG_ID] == counts["_cid"], "inner")
    return joined.select(S.COUNT, S.OPTION, S.KEY, S.BUILD_YEAR)


def engine_count_total(counts: DataFrame) -> DataFrame:
    """A3: ``COALESCE(SUM(Engine_serial_count), 0)`` - a sum of per-config
    distinct counts (an engine in two configs counts twice), one row."""
    return counts.agg(F.coalesce(F.sum(S.COUNT), F.lit(0)).cast("long").alias("engine_count_total"))


def distinct_options(rollup: DataFrame) -> DataFrame:
    """A4: ``SELECT DISTINCT option_assembly_num``."""
    return rollup.select(S.OPTION).distinct()


def distinct_years(df: DataFrame) -> DataFrame:
    """O3: distinct build years, newest first (a tiny result)."""
    return df.select(S.BUILD_YEAR).distinct().orderBy(F.col(S.BUILD_YEAR).desc_nulls_last())
