"""The whole report as one lazy plan.

option x config on serial -> key -> distinct engines per config, joined back
-> latest row per key -> expansion into child parts -> best row per child.

The reference runs the serial join and the key step once per half-year
option file and unions the results; inner join and projection distribute
over UNION ALL, so one pass over all periods gives the same rows while the
distinct count stays global.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from .. import schemas as S
from ..sinks import checkpoint_table
from ..operators.audit import observe_rows, observed_rows, stage_audit
from ..operators import (best_per_child, best_per_child_from_parts, build_order_key,
                         config_engine_counts, contenders, expand_children, latest_per_key,
                         serial_join)


@dataclass
class WorkflowResult:
    serial_joined: DataFrame
    keyed: DataFrame
    rollup: DataFrame
    latest: DataFrame
    expanded: DataFrame
    best_per_child: DataFrame


def run_workflow(option: DataFrame, config: DataFrame, child: DataFrame,
                 materialize_expansion: bool = False, checkpoint: bool = True) -> WorkflowResult:
    """Build every stage. ``best_per_child`` is computed without the full
    expansion unless ``materialize_expansion`` asks for the literal
    expand-then-rank plan (same rows).

    ``keyed`` feeds the distinct count and the join-back, and the roll-up
    three later stages: both are written once to the shared checkpoint folder
    (eager writes), whatever their size, so the serial join runs once.  With
    ``checkpoint=False`` every stage stays lazy and is recomputed by each
    of its consumers."""
    sj = serial_join(option, config)
    keyed = build_order_key(sj)
    if checkpoint:
        keyed = checkpoint_table(keyed, "keyed")
    rollup = config_engine_counts(keyed)
    if checkpoint:
        rollup = checkpoint_table(rollup, "rollup")
    latest = latest_per_key(rollup)
    expanded = expand_children(rollup, latest, child)
    best = (best_per_child(expanded) if materialize_expansion
            else best_per_child_from_parts(rollup, latest, child))
    return WorkflowResult(sj, keyed, rollup, latest, expanded, best)


#: The stage whose rows each stage consumes, in run order.
STAGE_INPUTS = {"serial_join": "bom_option", "keyed": "serial_join", "rollup": "keyed",
                "latest": "rollup", "expanded": "latest", "best_per_child": "expanded"}


def run_audited(option: DataFrame, config: DataFrame,
                child: DataFrame) -> tuple[WorkflowResult, DataFrame]:
    """Run every stage, each written once to the shared checkpoint folder, and its audit
    (A6).  The counts are observed while the stages are written; the option rows and
    the serial join, which are not written, while ``keyed`` is."""
    counts = {}

    def written(df: DataFrame, name: str) -> DataFrame:
        df, obs = observe_rows(df, name)
        table = checkpoint_table(df, name)
        counts[name] = observed_rows(obs, df)
        return table

    needed = [c for c in option.columns if c in (S.ENGINE_SERIAL, S.OPTION, S.SHOP_ORDER)]
    option, of_option = observe_rows(option.select(*needed), "bom_option")
    joined, of_joined = observe_rows(serial_join(option, config), "serial_join")
    keyed = written(build_order_key(joined), "keyed")
    counts = {"bom_option": observed_rows(of_option, option),
              "serial_join": observed_rows(of_joined, joined), **counts}
    rollup = written(config_engine_counts(keyed), "rollup")
    latest = written(latest_per_key(rollup), "latest")
    expanded = written(expand_children(rollup, latest, child), "expanded")
    best = written(best_per_child(contenders(expanded)), "best_per_child")
    return (WorkflowResult(joined, keyed, rollup, latest, expanded, best),
            stage_audit(option.sparkSession, counts, STAGE_INPUTS))


def write_outputs(result: WorkflowResult, out_dir: str) -> DataFrame:
    """Write the report's stage outputs and return their row counts.

    rollup/latest: ZSTD Parquet ordered by build year (newest first);
    expanded/best_per_child: header CSV folders.  Counts are gathered by
    ``Observation`` while each output is written - no second pass."""
    from ..sinks import export_year_ordered, write_csv

    out = out_dir.rstrip("/")
    counts = [("rollup", export_year_ordered(result.rollup, f"{out}/rollup", then=[S.COUNT],
                                             observe="rollup"), result.rollup),
              ("latest", export_year_ordered(result.latest, f"{out}/latest",
                                             observe="latest"), result.latest)]
    for name, df in (("expanded", result.expanded), ("best_per_child", result.best_per_child)):
        df, obs = observe_rows(df, name)
        write_csv(df, f"{out}/{name}")
        counts.append((name, obs, df))
    spark = result.rollup.sparkSession
    return spark.createDataFrame([(name, observed_rows(obs, df)) for name, obs, df in counts],
                                 "stage string, rows long")
