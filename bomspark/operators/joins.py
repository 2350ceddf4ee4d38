"""Joins of the pipeline (J1-J6) and the pre-join column checks (P10).

Every join is an equi-join on string keys and is left to Catalyst + AQE:
sort-merge by default, converted to a broadcast at run time only when the
measured shuffle size of one side is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` (a checked bound), with
AQE skew-join splitting of hot keys (one serial / one option holding a
large share of the rows).  No join here hard-codes ``broadcast()``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import year_int


def splittable(unique_side: DataFrame) -> DataFrame:
    """Let AQE split a hot key of the *other* side of the next join.

    AQE's skew-join splitting applies only when both join inputs are plain
    shuffle stages.  A side with one row per key that comes straight out of
    a window, an aggregate or a join on that key is already partitioned on
    it, so the join would reuse that partitioning and a hot key on the big
    side would be processed whole by one task.  A rebalance (round-robin,
    coalesced by AQE) of the unique side makes the join shuffle both inputs
    on the key itself.  The price is two exchanges (round-robin, then on the
    key) of the unique side, which holds at most one row per key; a keyed
    ``rebalance`` or ``repartition`` would save one but does not let AQE
    split the join.  When the session has AQE or its skew-join handling
    switched off nothing could split the join, so the frame is returned
    unchanged."""
    conf = unique_side.sparkSession.conf
    enabled = all(str(conf.get(k, "true")).lower() == "true"
                  for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"))
    return unique_side.hint("rebalance") if enabled else unique_side


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> None:
    """P10: fail fast (driver only, no job) when a join column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required column(s) {missing}; has {df.columns}")


def resolve_column(df: DataFrame, synonyms: Iterable[str]) -> str:
    """P2 (join side): first synonym matching a column, ignoring case and a
    leading byte-order mark. Raises if none matches."""
    cleaned = {c.replace("\ufeff", "").strip().lower(): c for c in reversed(df.columns)}
    for name in synonyms:
        hit = cleaned.get(name.lower())
        if hit is not None:
            return hit
    raise ValueError(f"none of {list(synonyms)} found in {df.columns}")


def normalize_child_table(child: DataFrame) -> DataFrame:
    """Child table with its option column renamed to ``Option_Number``."""
    opt = resolve_column(child, S.JOIN_OPTION_SYNONYMS)
    renamed = child.withColumnRenamed(opt, S.OPTION_NUMBER) if opt != S.OPTION_NUMBER else child
    for c in renamed.columns:
        clean = c.replace("\ufeff", "")
        if clean != c:
            renamed = renamed.withColumnRenamed(c, clean)
    return renamed


def serial_join(option: DataFrame, config: DataFrame) -> DataFrame:
    """Option rows x config rows on the serial (as text); M:N fan-out kept.

    The config's build year may arrive as text (landing files): it is cast
    leniently (F4), so '2020.0' is 2020 and stray text is NULL, never an
    ANSI cast error.

    Output: Engine_serial, option_assembly_num, design_config_2, shop_order_num, build_year.
    """
    require_columns(option, [S.ENGINE_SERIAL, S.OPTION, S.SHOP_ORDER], "option table")
    require_columns(config, [S.ENGINE_SERIAL, S.DESIGN_CONFIG, S.BUILD_YEAR], "config table")
    o = option.select(F.col(S.ENGINE_SERIAL).cast("string").alias("_serial"),
                      F.col(S.OPTION), F.col(S.SHOP_ORDER).cast("string").alias(S.SHOP_ORDER))
    c = config.select(F.col(S.ENGINE_SERIAL).cast("string").alias("_cserial"),
                      F.col(S.DESIGN_CONFIG),
                      year_int(S.BUILD_YEAR).alias(S.BUILD_YEAR))
    j = o.join(c, o["_serial"] == c["_cserial"], "inner")
    return j.select(F.col("_serial").alias(S.ENGINE_SERIAL), S.OPTION, S.DESIGN_CONFIG,
                    S.SHOP_ORDER, S.BUILD_YEAR)


def semi_filter_children(child: DataFrame, rollup: DataFrame) -> DataFrame:
    """Child rows whose option occurs in the roll-up (EXISTS / left-semi).

    The semi side is de-duplicated first (partial aggregation map-side): AQE
    can split only the left side of a semi join, so a hot option on the right
    would otherwise sit whole in one task.  The de-duplicated side comes out
    of an aggregate on the option, so ``splittable`` lets AQE split a hot
    option of the child rows.  Results are the same either way."""
    child = normalize_child_table(child)
    opts = splittable(rollup.select(F.col(S.OPTION).alias("_opt")).distinct())
    return child.join(opts, child[S.OPTION_NUMBER] == opts["_opt"], "left_semi")


def semi_exists_keys(latest: DataFrame, rollup: DataFrame) -> DataFrame:
    """Latest rows whose key exists in the roll-up (correlated EXISTS);
    the key set is de-duplicated first, as in ``semi_filter_children``."""
    keys = rollup.select(F.col(S.KEY).alias("_k")).distinct()
    return latest.join(keys, latest[S.KEY] == keys["_k"], "left_semi")


def key_option_pairs(rollup: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """Distinct (key, option) pairs of roll-up rows whose key is in ``latest``.

    ``latest`` keys are by construction a subset of the roll-up's non-NULL
    keys, so the join reduces to a NULL-key filter; pass ``latest`` to keep
    the literal EXISTS when the inputs come from elsewhere."""
    pairs = rollup.select(S.KEY, S.OPTION).where(F.col(S.KEY).isNotNull()).distinct()
    if latest is not None:
        # the key set comes out of an aggregate on the key: splittable lets
        # AQE split the pairs of a key with very many options
        keys = splittable(latest.select(F.col(S.KEY).alias("_k")).distinct())
        pairs = pairs.join(keys, pairs[S.KEY] == keys["_k"], "left_semi")
    return pairs


def expand_children(rollup: DataFrame, latest: DataFrame, child: DataFrame,
                    source_option: bool = False) -> DataFrame:
    """Latest row per key x options of that key x children of each option.

    ``option_assembly_num`` is the latest row's representative option, not the
    option that contributed the child (kept for parity); ``source_option=True``
    adds the contributing option as an extra column.  Duplicate child rows are
    kept, so the expansion multiplies exactly as the reference's does.
    """
    child = normalize_child_table(child)
    pairs = key_option_pairs(rollup).select(F.col(S.KEY).alias("_pk"),
                                            F.col(S.OPTION).alias("_popt"))
    # latest has one row per key: keep it on the right (the side a sort-merge
    # join buffers per key), stream the pairs, and let AQE split a key with
    # very many options over several tasks.
    lt = splittable(latest.select(S.COUNT, S.OPTION, S.KEY, S.BUILD_YEAR))
    lp = pairs.join(lt, pairs["_pk"] == lt[S.KEY], "inner")
    ch = child.select(F.col(S.OPTION_NUMBER).alias("_copt"), F.col(S.CHILD))
    out = lp.join(ch, lp["_popt"] == ch["_copt"], "inner")
    cols = [S.COUNT, S.OPTION, S.KEY, S.BUILD_YEAR, S.CHILD]
    if source_option:
        cols.append(F.col("_popt").alias("source_option"))
    return out.select(*cols)
