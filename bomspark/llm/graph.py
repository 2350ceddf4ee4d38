"""Connected components of an edge table, by alternating star contraction.

Each round replaces the edges by stars around smaller nodes (large-star, then
small-star); the rounds needed grow with the logarithm of the longest path.
All work is joins and partial aggregations over the edge table: a node with
very many neighbours only ever meets the one row of its minimum, in a join
whose large side AQE splits (the minima are dealt anew, see ``splittable``).  Each round's edges are written to the shared
checkpoint folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.joins import splittable
from .common import scratch_path


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star over edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    large = (both.join(splittable(least), "u").where("v > u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    met = large.join(splittable(least), "u")
    return (met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns ``a``, ``b``, any
    orderable type); root is the component's smallest node.

    Self-edges, repeated edges, either orientation and null ends (dropped)
    are allowed; no edges give no rows."""
    spark = edges.sparkSession
    folder = scratch_path(spark, "llm-components")
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                       F.least("a", "b").alias("v")).distinct()
    seen, step = None, 0
    while True:
        obs = Observation(f"edges-{uuid.uuid4().hex}")
        path = f"{folder}/{step}"
        (now.observe(obs, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                     F.bit_xor(F.xxhash64("v", F.lit(1), "u")).alias("y"))
         .write.option("compression", "zstd").parquet(path))
        state = obs.get
        now = spark.read.schema(now.schema).parquet(path)
        if state == seen or not state.get("n"):
            break
        seen, step = state, step + 1
        now = _round(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
