"""Audits (A2, A6, A7) and the key-overlap diagnostic.

Stage counts are ``Observation``s, gathered while a stage is written
(``plans.workflow.run_audited``): no stage is computed, or read again, to be
counted.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A2 without an extra pass: the count is filled in when ``df`` is
    written/collected (``observed_rows``)."""
    obs = Observation(f"{name}-{uuid.uuid4().hex}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def observed_rows(obs: Observation, df: DataFrame) -> int:
    """Rows that the observed ``df`` had when it was written.  Spark leaves a frame out of a
    plan whose result it knows to be empty (a join with an empty table); only then,
    as nothing was observed, they are counted."""
    try:
        return int(obs.get["rows"])
    except Py4JJavaError as error:       # there is no row of metrics to be turned into Python's
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return df.count()


def stage_audit(spark: SparkSession, counts: Mapping[str, int], inputs: Mapping[str, str],
                totals: bool = True) -> DataFrame:
    """Per stage its input and output rows, delta and percent change.

    ``counts`` has every stage's rows, ``inputs`` the stage whose rows a stage consumes,
    in run order.  With ``totals``, two summary rows follow: ``TOTAL`` (input and output
    rows summed over the stages that consume one) and ``NET`` (the first stage's
    input against the last stage's output)."""
    rows = [(name, counts[inputs[name]] if name in inputs else None, n)
            for name, n in counts.items()]
    if totals and inputs:
        order = list(inputs)
        rows.append(("TOTAL", sum(counts[inputs[n]] for n in order), sum(counts[n] for n in order)))
        rows.append(("NET", counts[inputs[order[0]]], counts[order[-1]]))
    report = spark.createDataFrame(rows, "stage string, input_rows long, output_rows long")
    delta = F.col("output_rows") - F.col("input_rows")
    pct = F.when(F.col("input_rows") > 0,
                 F.round(delta * 100.0 / F.col("input_rows"), 2).cast("double"))
    return report.select("stage", "input_rows", "output_rows", delta.alias("delta"),
                         pct.alias("pct_change"))


def reconcile(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row - expected rows, actual rows, and whether they match.
    Both counts come from one aggregation over the tagged union."""
    tagged = (expected.select(F.lit(1).alias("_e"), F.lit(0).alias("_a"))
              .unionByName(actual.select(F.lit(0).alias("_e"), F.lit(1).alias("_a"))))
    sums = tagged.agg(F.coalesce(F.sum("_e"), F.lit(0)).cast("long").alias("expected_rows"),
                      F.coalesce(F.sum("_a"), F.lit(0)).cast("long").alias("actual_rows"))
    return sums.select("expected_rows", "actual_rows",
                       (F.col("expected_rows") == F.col("actual_rows")).alias("match"))


def _sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(k, l, r): every distinct key of either table and the sides it is on.
    A tagged union is grouped by key (one shuffle, partial aggregation)."""
    def side(df: DataFrame, l: int) -> DataFrame:
        return (df.select(F.col(key).cast("string").alias("k"))
                .where(F.col("k").isNotNull())
                .select("k", F.lit(l).alias("l"), F.lit(1 - l).alias("r")))
    return (side(left, 1).unionByName(side(right, 0)).groupBy("k")
            .agg(F.max("l").alias("l"), F.max("r").alias("r")))


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Exact overlap (set intersection) of the distinct join keys of
    two tables, and of their lower-cased forms (the "keys differ only by
    case" diagnosis), as one row.  Every key is compared; the lower-cased
    forms are grouped from the distinct keys, so each table is read once."""
    folded = _sides(left, right, key).groupBy(F.lower("k").alias("k")).agg(
        F.sum("l").alias("l"), F.sum("r").alias("r"), F.sum(F.col("l") * F.col("r")).alias("both"),
        (F.max("l") * F.max("r")).alias("both_low"))
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
    return folded.agg(total("l", "left_keys"), total("r", "right_keys"),
                      total("both", "common_keys"), total("both_low", "common_keys_ignore_case"))


def key_case_examples(left: DataFrame, right: DataFrame, key: str, examples: int = 3) -> DataFrame:
    """Up to ``examples`` pairs of keys that differ only by case (the
    smallest, one pair per lower-cased form without an exact match)."""
    folded = _sides(left, right, key).groupBy(F.lower("k").alias("folded")).agg(
        F.min(F.when(F.col("l") == 1, F.col("k"))).alias("left_key"),
        F.min(F.when(F.col("r") == 1, F.col("k"))).alias("right_key"),
        F.max(F.col("l") * F.col("r")).alias("both"))
    return (folded.where("both = 0 and left_key is not null and right_key is not null")
            .orderBy("folded").limit(examples).select("left_key", "right_key"))
