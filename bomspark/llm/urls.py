"""URL allow/block lists: blocked Bloom filter, then an exact hash join.

A list entry is a canonical URL prefix, host and path in one string.  It fits
its host and all subdomains where the URL's path starts with the entry's path.
Per URL the candidate entries are the host suffixes and path prefixes of the
shapes (number of host labels, length of path) that the list has.  A
register-blocked Bloom filter of the list (one 64-bit block per entry, four
bits in it) passes possible candidates; only these are exploded and joined with
the list on the exact strings, which removes the false positives.  Everything
is DataFrame functions.

The filter is an array of at most ``MAX_BLOCKS`` longs (512 KB), read by a
scalar subquery; a longer list fills it up more and sends more candidates into
the join, which decides alone.  The join and its result per URL are over
distinct (host, path), pre-aggregated, so a hot host or page is one row there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import splittable

MAX_BLOCKS = 1 << 16
ENTRIES_PER_BLOCK = 6
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(key: Column, blocks: Column | int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks) if isinstance(blocks, int) else blocks)


def _bits(key: Column) -> Column:
    """Four bits of a 64-bit block, from one hash."""
    h = F.xxhash64(key, F.lit(2))
    bit = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 6 * i)
                           .bitwiseAND(F.lit(63)).cast("int")) for i in range(4)]
    return bit[0].bitwiseOR(bit[1]).bitwiseOR(bit[2]).bitwiseOR(bit[3])


def bloom_filter(entries: DataFrame, blocks: int) -> DataFrame:
    """One row, one column: the filter's blocks of ``entries.key`` in order."""
    spark = entries.sparkSession
    filled = (entries.select(_block(F.col("key"), blocks).alias("block"), _bits(F.col("key"))
                             .alias("bits")).groupBy("block").agg(F.bit_or("bits").alias("bits")))
    every = spark.range(blocks).select(F.col("id").alias("block"))
    rows = every.join(filled, "block", "left").select(
        "block", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))
    return rows.agg(F.transform(F.sort_array(F.collect_list(F.struct("block", "bits"))),
                                lambda b: b["bits"]).alias("blocks"))


def canonical_rules(rules: DataFrame) -> DataFrame:
    """Distinct (host, path, action, key, labels, path_length) of ``rules`` (host, path,
    action).  Null hosts are dropped, a null path is empty; where one entry has
    several actions, block wins."""
    return (rules.where(F.col("host").isNotNull())
            .select(F.translate("host", _UPPER, _UPPER.lower()).alias("host"),
                    F.coalesce("path", F.lit("")).alias("path"), "action")
            .groupBy("host", "path").agg(F.max("action").alias("action"))
            .withColumns({"key": F.concat("host", "path"),
                          "labels": F.size(F.split("host", r"\.", -1)),
                          "path_length": F.length("path")}))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per input row: id, host, path, rule, verdict.

    ``rules``: host, path, action (allow or block).  The longest fitting entry
    (host and path together; then the longer host) decides; without one
    ``rule`` is null and the verdict ``default``.  Null URLs and those without
    ``://`` have empty host and path, which fit only an empty entry.  Repeated
    rows and null ids keep their row.  Empty input gives no rows, an empty list
    gives every URL the default; other columns are ignored."""
    listed = canonical_rules(rules)
    blocks = max(1, min(MAX_BLOCKS, -(-listed.count() // ENTRIES_PER_BLOCK)))
    bloom = bloom_filter(listed, blocks)
    shapes = listed.agg(F.collect_set(F.struct("labels", "path_length")).alias("shapes"))
    seen = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"))
    candidates = F.transform(
        F.filter(F.col("shapes"), lambda s: (s["labels"] <= F.size("labels"))
                 & (s["path_length"] <= F.length("path"))),
        lambda s: F.struct(F.array_join(F.slice("labels", -s["labels"], s["labels"]), ".").alias("host"),
                           F.substring(F.col("path"), F.lit(1), s["path_length"]).alias("path")))
    probed = (seen.select("host", "path").distinct()
              .withColumns({"labels": F.split("host", r"\.", -1), "shapes": shapes.scalar(), "bloom": bloom.scalar()})
              .withColumn("possible", F.filter(candidates, lambda c: (
                  F.get(F.col("bloom"), _block(F.concat(c["host"], c["path"]), blocks))
                  .bitwiseAND(_bits(F.concat(c["host"], c["path"])))
                  == _bits(F.concat(c["host"], c["path"])))))
              .select("host", "path", F.explode("possible").alias("c")))
    entry = listed.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), "action",
                          "key")
    hits = (probed.join(entry, (F.col("c.host") == F.col("r_host"))
                        & (F.col("c.path") == F.col("r_path")))
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("key").alias("n"), F.length("r_host").alias("h"),
                                "key", "action")).alias("best")))
    return seen.join(splittable(hits), ["host", "path"], "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("best.key").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"))
