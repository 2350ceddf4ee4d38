"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets whole copies of all its documents and one budget of words
for documents to take once more.  The budget is met on the source's histogram
(documents per exact size), not on documents: most of it in proportion over the
sizes, the rest by a bounded-knapsack dynamic programme over a bitset of
reachable sums.  The documents of a size are then taken in the order of a
seeded hash until the size's count is reached, so reruns agree.

Sizes are counted once into a stored table.  A source's histogram is
pre-aggregated and as long as it has distinct sizes; ranks within a size
come from counts per hash bucket, so a size (or source) with a third of all rows
is never ordered in one task.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, word_count

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = 20
#: Words of each budget left to the dynamic programme (bits of its bitset).
KNAPSACK_WORDS = 16_384
_BUCKET_BITS = 10


def fit_budget(sizes: list[int], counts: list[int], budget: int,
               knapsack: int = KNAPSACK_WORDS) -> list[int]:
    """How many documents of each size to take (at most ``counts``) so that
    their words come as near to ``budget`` as the knapsack finds."""
    taken = [0] * len(sizes)
    total = sum(s * c for s, c in zip(sizes, counts))
    order = sorted((i for i in range(len(sizes)) if sizes[i] > 0), key=lambda i: -sizes[i])
    share = max(0, budget - knapsack) / total if total else 0.0
    words, passed = 0, 0
    for i in order:                       # in proportion, larger sizes first
        passed += sizes[i] * counts[i]
        taken[i] = min(counts[i], max(0, int(share * passed - words) // sizes[i]))
        words += taken[i] * sizes[i]
    for i in order:                       # what the proportion left above the knapsack
        more = min(counts[i] - taken[i], max(0, budget - words - knapsack) // sizes[i])
        taken[i] += more
        words += more * sizes[i]
    left = budget - words
    if left <= 0:
        return taken
    limit = (1 << (2 * left + 1)) - 1     # further above than that is worse than nothing
    reach, steps = 1, []
    for i in order:
        spare, lot = min(counts[i] - taken[i], 2 * left // sizes[i]), 1
        while spare > 0 and not reach >> left & 1:      # counts in lots of 1, 2, 4, ...
            lot = min(lot, spare)
            steps.append((i, lot, reach))
            reach |= (reach << sizes[i] * lot) & limit
            spare, lot = spare - lot, lot * 2
    at = (reach & ((1 << (left + 1)) - 1)).bit_length() - 1
    above = reach >> (left + 1)
    if above and (above & -above).bit_length() < left - at:
        at = left + (above & -above).bit_length()
    for i, lot, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += lot
            at -= sizes[i] * lot
    return taken


def _key(source: Column) -> Column:
    """Source as a non-null join key."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def source_targets(per_source: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``target`` words per row of (key, source, source_size): shares of the
    total by weight (dealt in turn to the sources in code-point order, null
    last), none above ``max_copies`` times the source's size.

    With the sources in order of cap per weight, source i is capped iff the
    share left for it exceeds its cap; the level of those shares rises up
    to the first uncapped source, so its maximum is the level for all."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per_source.withColumns({
        "weight": F.get(F.lit(list(weights)), (F.row_number().over(by_name) - 1) % len(weights)),
        "cap": F.col("source_size").cast("double") * max_copies})
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    up_to = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(up_to), F.lit(0.0)))
             / F.sum("weight").over(onward))
    return (ranked.withColumn("level", level)
            .withColumn("target", F.least("cap", F.col("weight") * F.max("level").over(everything)))
            .select("key", "source_size", "target"))


def _budgets(histogram: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """(key, size, copies, more): copies of every document of the source and
    how many documents of the size are taken once more."""
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ascending=False)
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        copies = min(max_copies, math.floor(target / size)) if size else 0
        budget = max(0, math.floor(target) - copies * size) if copies < max_copies else 0
        pdf["more"] = fit_budget(pdf["size"].tolist(), pdf["n"].tolist(), budget)
        pdf["copies"] = copies
        return pdf[["key", "size", "copies", "more"]]

    return (histogram.join(targets, "key").groupBy("key")
            .applyInPandas(fit, "key string, size long, copies int, more long"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       _key(F.col(source_col).cast("string")).alias("key"),
                       word_count(F.col(text_col)).alias("size"),
                       F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("h"))


def _plan(sized: DataFrame, weights, max_copies: int) -> tuple[DataFrame, DataFrame]:
    """The sources' targets, and per (key, size, bucket) of the hash: copies,
    ``before`` documents of the size in lower buckets, and ``more``."""
    bucketed = sized.groupBy("key", "source", "size", F.shiftright("h", 64 - _BUCKET_BITS)
                             .alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    bucketed = stored(bucketed, "mix-histogram")
    per_source = bucketed.groupBy("key", "source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = stored(source_targets(per_source, weights, max_copies), "mix-targets")
    histogram = bucketed.groupBy("key", "size").agg(F.sum("n").alias("n"))
    budgets = stored(_budgets(histogram, targets, max_copies), "mix-budgets")
    lower = (Window.partitionBy("key", "size").orderBy("bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    lots = (bucketed.select("key", "size", "bucket",
                            F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("before"))
            .join(budgets, ["key", "size"]))
    return targets, lots


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights=WEIGHTS, max_copies: int = MAX_COPIES,
        seed: int = SEED) -> DataFrame:
    """One row per input row: id, size, source_size, target, ``copies`` (times
    the document is taken, 0 to ``max_copies``), taken (words).

    Null texts have size 0 and are taken with their source's whole copies.  A
    null source is a source, last in order.  Repeated rows count as often as
    they occur; which of several equal rows is taken once more makes no
    difference.  Empty input gives no rows; other columns are ignored."""
    sized = stored(_sized(docs, id_col, text_col, source_col, seed), "mix-sizes")
    targets, lots = _plan(sized, weights, max_copies)
    lot = Window.partitionBy("key", "size", "bucket").orderBy("h", "id")
    ranked = (sized.withColumn("bucket", F.shiftright("h", 64 - _BUCKET_BITS))
              .withColumn("rank", F.row_number().over(lot)))
    return (ranked.join(lots, ["key", "size", "bucket"]).join(targets, "key")
            .withColumn("copies", F.col("copies")
                        + (F.col("before") + F.col("rank") <= F.col("more")).cast("int"))
            .select(F.col("id").alias(id_col), "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", weights=WEIGHTS,
                    max_copies: int = MAX_COPIES, seed: int = SEED) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as it is taken, columns
    unchanged.  Decided per row by the highest hash taken of its source and
    size, so rows equal in id and text share one decision."""
    sized = stored(_sized(docs, id_col, text_col, source_col, seed), "mix-sizes")
    _, lots = _plan(sized, weights, max_copies)
    lot = Window.partitionBy("key", "size", "bucket").orderBy("h")
    cuts = (sized.withColumn("bucket", F.shiftright("h", 64 - _BUCKET_BITS))
            .withColumn("rank", F.row_number().over(lot)).join(lots, ["key", "size", "bucket"])
            .groupBy("key", "size").agg(F.max(F.when(
                F.col("before") + F.col("rank") <= F.col("more"), F.col("h"))).alias("cut"),
                F.first("copies").alias("copies")))
    cuts = stored(cuts.select(F.col("key").alias("__k"), F.col("size").alias("__s"),
                              F.col("cut").alias("__cut"), F.col("copies").alias("__n")), "mix-cuts")
    names = [f"__c{i}" for i in range(len(docs.columns))]
    col = dict(zip(docs.columns, names))
    rows = docs.toDF(*names).withColumns({
        "__k": _key(F.col(col[source_col]).cast("string")),
        "__s": word_count(F.col(col[text_col])),
        "__h": F.xxhash64(F.lit(seed), F.col(col[id_col]), F.col(col[text_col]))})
    times = F.col("__n") + F.coalesce(F.col("__h") <= F.col("__cut"), F.lit(False)).cast("int")
    return (rows.join(cuts, ["__k", "__s"]).where(times > 0)
            .withColumn("__i", F.explode(F.sequence(F.lit(1), times)))
            .select(*names).toDF(*docs.columns))
