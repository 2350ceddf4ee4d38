"""Top-1 per group (W1, W2): latest row per key, best row per child part.

``row_number() = 1`` over a window lets Spark insert a *partial*
``WindowGroupLimit`` before the shuffle, so each map task forwards at most one
row per group: a hot key that holds a third of all rows is reduced map-side
rather than sorted whole in one task.

Ties: the reference's ordering leaves the winner arbitrary (same year and
count). We append deterministic tie-break columns (ascending, NULLs last) so
results are reproducible; they only decide among rows the reference would
consider equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import year_int
from .joins import key_option_pairs, normalize_child_table, splittable


def top1_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of every ``keys`` group under ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def latest_order() -> list[Column]:
    return [F.col(S.BUILD_YEAR).desc_nulls_last(), F.col(S.COUNT).desc_nulls_last(),
            F.col(S.OPTION).asc_nulls_last()]


def latest_per_key(rollup: DataFrame) -> DataFrame:
    """Newest (then most used) row per configuration/shop-order key."""
    return top1_per_group(rollup.select(S.COUNT, S.OPTION, S.KEY, S.BUILD_YEAR), [S.KEY],
                          latest_order())


def best_order(year: Column | None = None, count: Column | None = None) -> list[Column]:
    year = F.col(S.BUILD_YEAR) if year is None else year
    count = F.col(S.COUNT) if count is None else count
    return [year.desc_nulls_last(), count.desc_nulls_last(), F.col(S.KEY).asc_nulls_last(),
            F.col(S.OPTION).asc_nulls_last()]


def best_per_child(expanded: DataFrame) -> DataFrame:
    """W2/C9 over an expansion: best row per ``Child_Part_Number``.

    Year and count are compared as integers even when the input is text (the
    lenient all-VARCHAR read): non-numeric values become NULL and sort last
    instead of aborting the query. A NULL child is one group."""
    cols = [S.COUNT, S.OPTION, S.KEY, S.BUILD_YEAR, S.CHILD]
    df = expanded.select(*cols)
    order = best_order(year_int(S.BUILD_YEAR), year_int(S.COUNT, "bigint"))
    return top1_per_group(df, [S.CHILD], order)


def contenders(expanded: DataFrame) -> DataFrame:
    """The rows of an expansion, a written table, that can be their child's best.

    Ranking sorts every row of a task, so its memory grows with the expansion.  Here each
    child's highest year and count are found first, by hash, and only the rows that have
    them are left to be ranked.  Year and count go into one number that no better row has
    less of: no winner and no row tied with it is lost.  The numbers are written, and
    broadcast if they are, as measured, below Spark's threshold; else, with as many
    children as that, all rows are left."""
    from ..sinks import checkpoint_table
    from ..sources.lines import bytes_setting
    year = F.coalesce(year_int(S.BUILD_YEAR).cast("long"), F.lit(-(1 << 31)).cast("long"))
    count = F.least(F.greatest(F.coalesce(year_int(S.COUNT, "bigint"), F.lit(0)), F.lit(0)),
                    F.lit((1 << 31) - 1))
    rank = year * F.lit(1 << 31).cast("long") + count
    best = checkpoint_table(expanded.groupBy(F.col(S.CHILD).alias("_child")).agg(
        F.max(rank).alias("_rank")), "child-best")
    size = best.agg(F.coalesce(F.sum(64 + F.coalesce(F.octet_length("_child"), F.lit(0))),
                               F.lit(0)).alias("n")).collect()[0]["n"]
    if size > bytes_setting(expanded.sparkSession, "spark.sql.autoBroadcastJoinThreshold"):
        return expanded
    same = F.col(S.CHILD).eqNullSafe(F.col("_child")) & (rank == F.col("_rank"))
    return expanded.join(F.broadcast(best), same, "left_semi")


def best_per_child_from_parts(rollup: DataFrame, latest: DataFrame, child: DataFrame) -> DataFrame:
    """C9 without materialising the expansion (same rows as
    ``best_per_child(expand_children(...))``).

    The rank of an expanded row depends only on its key's latest row, so the
    best row for a child is the best over the options that lead to it of each
    option's best key.  Plan: (latest x pairs) -> top-1 per option -> x child
    -> top-1 per child.  The fan-out join now carries one row per
    (option, child) instead of one per (key, option, child)."""
    child = normalize_child_table(child)
    pairs = key_option_pairs(rollup).select(F.col(S.KEY).alias("_pk"),
                                            F.col(S.OPTION).alias("_popt"))
    # the side with one row per join key goes on the right (buffered per key
    # by a sort-merge join); the possibly hot side is streamed and a key with
    # very many options is split by AQE
    lt = splittable(latest.select(S.COUNT, S.OPTION, S.KEY, S.BUILD_YEAR))
    per_option = top1_per_group(pairs.join(lt, pairs["_pk"] == lt[S.KEY], "inner"),
                                ["_popt"], best_order())
    # one row per option (small): a rebalance makes the join below shuffle
    # both sides on the option itself, so AQE can split a hot option on the
    # child side instead of leaving it to one task
    per_option = splittable(per_option)
    ch = child.select(F.col(S.OPTION_NUMBER).alias("_copt"), F.col(S.CHILD))
    cand = ch.join(per_option, ch["_copt"] == per_option["_popt"], "inner")
    return top1_per_group(cand.select(S.COUNT, S.OPTION, S.KEY, S.BUILD_YEAR, S.CHILD),
                          [S.CHILD], best_order())
