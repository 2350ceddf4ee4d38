"""SimHash near-duplicates with pigeonring filtering.

Fingerprints: XXH64 (seed 42) of every word shingle, majority vote per bit.
Documents whose fingerprints differ in at most ``max_bits`` bits are linked.

Search.  With tau = ``max_bits`` the 64 bits are cut into m = tau + 1
consecutive segments on a ring.  If two fingerprints differ in at most tau
bits, some segment starts a chain whose first l segments differ in at most
l * tau / m bits, for every l from 1 to m (pigeonring principle).  The first
two budgets are floor(tau/m) = 0 and floor(2*tau/m) = 1, so the start segment
is equal and one half of the next segment is equal too: these bits form the
key of an inverted list (2m keys per fingerprint, 32 bits each for tau = 2).
Pairs that meet in a list are pruned by the remaining budgets of the chain and
only then by the full Hamming distance; a pair is reported by the first list
that would accept it, never twice.

Equal fingerprints are one class throughout.  A list longer than
``max_list`` is not paired at all: its members are linked exactly through
the centres of Hamming balls instead.  Two fingerprints are at most tau apart
iff some 64-bit word is within ceil(tau/2) of one and floor(tau/2) of the
other, so each member is listed at the words of its ball and all members
of one word are tied to its smallest member of the inner ball: as many rows as
members times ball size, whatever the size of the group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import splittable
from .common import byte_texts, stored
from .graph import connected_components

SEED = 42
#: A list of n members costs n/2 pairs per member and key; beyond this the ball is cheaper.
MAX_LIST = 32
_CHUNK = 1 << 16


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a whole text (UTF-8 bytes)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - shingle + 1
    votes = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):     # bounded memory for very long texts
        part = words[at:min(n, at + _CHUNK) + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle))))
        size = len(part) - shingle + 1
        h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64, size)
        votes += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(id, fp) of every row; fp as a signed long with the fingerprint's bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([_signed(fingerprint(t, shingle)) for t in byte_texts(b, "text")],
                           pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fps], names=["id", "fp"])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, T.StructType([src.schema["id"], T.StructField("fp", T.LongType())]))


def _segments(max_bits: int) -> list[list[int]]:
    m = max_bits + 1
    return [list(map(int, part)) for part in np.array_split(np.arange(64), m)]


def _mask(bits: list[int]) -> int:
    return _signed(sum(1 << b for b in bits))


def _keys(max_bits: int) -> list[tuple[int, int]]:
    """(start segment, key mask) of every list an entry is put into."""
    segments = _segments(max_bits)
    if len(segments) == 1:
        return [(0, -1)]
    keys = []
    for i, own in enumerate(segments):
        following = segments[(i + 1) % len(segments)]
        half = len(following) // 2
        keys += [(i, _mask(own + following[:half])), (i, _mask(own + following[half:]))]
    return keys


def _chain_holds(x: Column, start: int, max_bits: int) -> Column:
    """Budgets of the chain of segments from ``start``: the first l segments of
    the xor ``x`` hold at most l * max_bits / m set bits."""
    segments = _segments(max_bits)
    m = len(segments)
    tests, bits = [], []
    for length in range(1, m + 1):
        bits = bits + segments[(start + length - 1) % m]
        budget = length * max_bits // m
        tests.append(F.bit_count(x.bitwiseAND(F.lit(_mask(bits)))) <= budget)
    return reduce(lambda a, b: a & b, tests)


def _accepting_list(x: Column, max_bits: int) -> Column:
    """Number of the first list in which a pair with xor ``x`` meets and
    survives the chain budgets; null if there is none."""
    return F.coalesce(*[
        F.when((x.bitwiseAND(F.lit(mask)) == 0) & _chain_holds(x, start, max_bits), F.lit(k))
        for k, (start, mask) in enumerate(_keys(max_bits))])


def _ball(max_bits: int) -> tuple[list[int], list[int]]:
    """Xor masks of the words within ceil(max_bits/2) bits, split into the
    inner ball (floor(max_bits/2)) and the shell around it."""
    inner, outer = max_bits // 2, (max_bits + 1) // 2
    masks = [[_mask(list(c)) for c in combinations(range(64), r)] for r in range(outer + 1)]
    return [x for r in masks[:inner + 1] for x in r], [x for r in masks[inner + 1:] for x in r]


def fingerprint_links(classes: DataFrame, max_bits: int = 2, max_list: int = MAX_LIST) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``fp``) that differ in
    at most ``max_bits`` bits; within a list longer than ``max_list`` only
    edges that keep its members connected as they are."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be from 0 to 7")
    keys = _keys(max_bits)
    entries = classes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key"))
        for k, (_, mask) in enumerate(keys)])).alias("e")).select("fp", "e.k", "e.key")
    lists = entries.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    live = stored(entries.join(splittable(lists), ["k", "key"]), "simhash-lists")
    short = live.where(F.col("n") <= max_list)
    left = short.select("k", "key", F.col("fp").alias("a"))
    right = short.select("k", "key", F.col("fp").alias("b"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    pairs = (left.join(right, ["k", "key"])
             .where((F.col("a") < F.col("b")) & (_accepting_list(x, max_bits) == F.col("k"))
                    & (F.bit_count(x) <= max_bits)).select("a", "b"))
    inner, shell = _ball(max_bits)
    crowded = live.where(F.col("n") > max_list).select("fp").distinct()

    def around(masks: list[int], is_inner: bool) -> DataFrame:
        return (crowded.select("fp", F.explode(F.lit(masks).cast("array<bigint>")).alias("mask"))
                .select(F.col("fp").bitwiseXOR(F.col("mask")).alias("word"), "fp",
                        F.lit(is_inner).alias("inner")))

    at = around(inner, True)
    if shell:
        at = at.unionByName(around(shell, False))
    centre = (at.groupBy("word").agg(F.min(F.when(F.col("inner"), F.col("fp"))).alias("b"),
                                     F.count(F.lit(1)).alias("n")).where("n > 1 and b is not null"))
    tied = at.join(centre, "word").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(tied).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 2, max_list: int = MAX_LIST) -> DataFrame:
    """One row per input row: id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links.

    Null, empty and wordless texts have fingerprint zero and are linked like
    any other.  Repeated rows (or ids) each keep their row.  A null id gets a
    component like any other row but never names one, unless no member has an
    id (null then).  Empty input gives no rows; other columns are ignored."""
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = stored(fps.groupBy("fp").agg(F.min("id").alias("first")), "fingerprint-classes")
    roots = connected_components(fingerprint_links(classes, max_bits, max_list))
    named = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of = stored(named.join(splittable(least), "root").select("fp", "component_id"), "fingerprint-components")
    return fps.join(of, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = 3, max_bits: int = 2, max_list: int = MAX_LIST) -> DataFrame:
    """The rows of ``docs`` less near-duplicates, columns unchanged: of each component
    of rows one stays, the one with the smallest id (nulls last; of rows with one
    id, any).

    Rows are compared by their texts alone: equal texts without an id are one group,
    and different texts under one id are not.  Null, empty and wordless texts are
    one group.  Empty input gives no rows; further columns may have any names."""
    names = [f"__c{i}" for i in range(len(docs.columns))]
    rows = stored(docs.toDF(*names).withColumn("__row", F.monotonically_increasing_id()),
                  "numbered-rows")
    own, text = (names[docs.columns.index(c)] for c in (id_col, text_col))
    fps = stored(fingerprints(rows, "__row", text, shingle).withColumnRenamed("id", "row"),
                 "row-fingerprints")
    order = F.struct(F.col(own).isNull().alias("no_id"), F.col(own).alias("id"), "__row")
    first = fps.join(rows.select("__row", order.alias("order")), F.col("row") == F.col("__row"))
    classes = stored(first.groupBy("fp").agg(F.min("order").alias("order")), "row-classes")
    roots = connected_components(fingerprint_links(classes.select("fp"), max_bits, max_list))
    named = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "order", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("order").alias("order"))
    of = stored(named.select("fp", "root").join(splittable(least), "root").select(
        "fp", F.col("order.__row").alias("stays")), "row-components")
    # the rows that go are fewer than those that stay
    gone = stored(fps.join(of, "fp").where("row <> stays").select("row"), "rows-gone")
    return rows.join(gone, F.col("__row") == F.col("row"), "left_anti").drop("__row").toDF(
        *docs.columns)
