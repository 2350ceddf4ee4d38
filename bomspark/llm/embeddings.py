"""Embedding near-duplicates by a pivot-permutation index.

A bounded, documented sample of the vectors gives ``pivots`` reference points,
chosen to lie apart.  Every vector is described by its ``nearest`` closest
pivots; their order is not used.  Two similar vectors share pivots; the inverted lists are kept per pair
of pivots, so vectors meet in a list iff they share at least two of theirs.  In
a list all pairs are verified by the exact cosine in double precision; a
pair counts in the list of the two smallest pivots it shares and in no
other.  The number of pivots grows with the square root of the table (``index_size``), so
a list, and with it the work per vector, stays about as long in a larger table.

Vectors of different widths never link: each width has pivots of its own, and the width
is a part of a list's key.  Equal vectors are one class with a count.  A list longer than ``block`` is
split into blocks whose pairs are tasks of their own.  Tasks give each member's
number of links and one edge that ties it to its group, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import splittable
from .common import pieces_of, single_threaded_tasks, stored
from .graph import connected_components

#: For up to _FEW vectors; see ``index_size``.  Pivots' numbers take 16 bits.
PIVOTS = 256
NEAREST = 7
_FEW, _MOST_DOUBLED = 1 << 18, 7
THRESHOLD = 0.9
#: Vectors of the sample that pivots are chosen from.
PIVOT_SAMPLE = 4096
BLOCK = 2048
_APART = 0.6


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    return (F.coalesce(F.size(vector) > 0, F.lit(False)) & F.coalesce(finite, F.lit(False))
            & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False)))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def choose_pivots(sample: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Up to ``pivots`` sample vectors that lie apart, then further ones, then
    seeded random directions."""
    chosen, n = np.empty((pivots, sample.shape[1])), 0
    for x in sample:
        if n < pivots and (chosen[:n] @ x < _APART).all():
            chosen[n] = x
            n += 1
    if n < pivots:
        chosen[n:] = unit(np.random.default_rng(7).normal(size=(pivots - n, sample.shape[1])))
    return chosen


def index_size(vectors: int) -> tuple[int, int]:
    """Pivots, and how many of them describe a vector, for a table of so many different
    vectors.  A table four times as large has twice the pivots, and so lists about as long;
    one more of them describes a vector, which keeps the recall (README).  From 4 G vectors
    on there are no more pivots; longer lists are split, not cut."""
    doubled = 0
    while doubled < _MOST_DOUBLED and vectors > _FEW << 2 * doubled:
        doubled += 1
    return PIVOTS << doubled, NEAREST + doubled


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def pivots_for(width: int, pivots: int = PIVOTS, nearest: int = NEAREST) -> int:
    """Fewer pivots in few dimensions, where similar vectors would else have others near."""
    return min(pivots, max(nearest + 1, 4 * width))


def _index(classes: DataFrame, sample: dict[int, np.ndarray], pivots: int,
           nearest: int) -> DataFrame:
    """(cid, first, n, vector, width, vec, perm): a number per class, its components as
    bytes and its nearest pivots' numbers in ascending order, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, at, points = TaskContext.get().partitionId() << 33, 0, {}
        for b in pieces_of(batches, 4096):
            widths = np.diff(b.column(0).offsets.to_numpy())
            flat = b.column(0).flatten().to_numpy(zero_copy_only=False)
            begin = np.concatenate([[0], np.cumsum(widths)])
            vec, perm = np.empty(b.num_rows, object), np.empty(b.num_rows, object)
            for width in np.unique(widths).tolist():
                rows = np.flatnonzero(widths == width)
                x = flat[begin[rows][:, None] + np.arange(width)]
                if width not in points:
                    points[width] = choose_pivots(sample.get(width, np.empty((0, width))),
                                                  pivots_for(width, pivots, nearest))
                score = unit(x) @ points[width].T
                near = np.sort(np.argpartition(-score, nearest - 1, axis=1)[:, :nearest], axis=1)
                for i, v, q in zip(rows.tolist(), x, near.astype("<u2")):
                    vec[i], perm[i] = v.tobytes(), q.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(base + at, base + at + b.num_rows), pa.int64()), b.column(1),
                 b.column(2), b.column(0), pa.array(widths, pa.int32()),
                 pa.array(vec, pa.binary()), pa.array(perm, pa.binary())],
                names=["cid", "first", "n", "vector", "width", "vec", "perm"])
            at += b.num_rows

    kind, first = classes.schema["vector"].dataType, classes.schema["first"].dataType
    return classes.select("vector", "first", "n").mapInArrow(
        run, f"cid long, first {first.simpleString()}, n long, vector {kind.simpleString()}, "
             "width int, vec binary, perm binary")


def _verify(same: bool, x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray,
            key: int, pivots: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (into x, into y) linked in this list."""
    hit = x @ y.T >= threshold
    if same:
        hit = np.triu(hit, 1)
    r, c = np.nonzero(hit)
    keep = []
    for at in range(0, len(r), 1 << 16):      # the list of the two smallest shared pivots owns a pair
        a, b = px[r[at:at + (1 << 16)]], py[c[at:at + (1 << 16)]]
        shared = (a[:, :, None] == b[:, None, :]).any(axis=2)
        one = shared.argmax(axis=1)
        row = np.arange(len(a))
        low = a[row, one].astype(np.int64)
        shared[row, one] = False
        keep.append(low * pivots + a[row, shared.argmax(axis=1)] == key)
    own = np.concatenate(keep) if keep else np.zeros(0, bool)
    return r[own], c[own]


def _ties(n: int, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Smallest member of each member's group under the links (r, c)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[r], label[c])
        before = label.copy()
        np.minimum.at(label, r, low)
        np.minimum.at(label, c, low)
        label = label[label]
        if (label == before).all():
            return label


def _by_width(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of batches in order of width, by width."""
    for b in batches:
        widths = b.column("width").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(widths)) + 1).tolist(), b.num_rows]
        for a, z in zip(cuts, cuts[1:]):
            if a < z:
                yield int(widths[a]), b.slice(a, z - a)


def vector_links(index: DataFrame, dtype: str, pivots: int = PIVOTS,
                 nearest: int = NEAREST, threshold: float = THRESHOLD,
                 block: int = BLOCK) -> DataFrame:
    """(cid, links, peer) from every list: vectors linked to the class there
    (copies counted), and a class that it is connected with."""
    perm = F.col("perm")

    def pivot(i: int) -> Column:
        low = F.conv(F.hex(F.substring(perm, 2 * i + 1, 1)), 16, 10).cast("long")
        return low + 256 * F.conv(F.hex(F.substring(perm, 2 * i + 2, 1)), 16, 10).cast("long")

    keys = [F.col(f"p{i}") * pivots + F.col(f"p{j}")
            for i in range(nearest) for j in range(i + 1, nearest)]
    entries = (index.withColumns({f"p{i}": pivot(i) for i in range(nearest)})
               .select("cid", "n", "width", "vec", "perm", F.explode(F.array(*keys)).alias("key")))
    lists = (index.withColumns({f"p{i}": pivot(i) for i in range(nearest)})
             .select("width", F.explode(F.array(*keys)).alias("key")).groupBy("width", "key")
             .agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    parts = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")
    task = F.when(F.col("t") < F.col("own"), F.struct(F.col("t").alias("i"), F.col("own").alias("j"),
                                                      F.lit(1).alias("side")))
    task = task.otherwise(F.struct(F.col("own").alias("i"), F.col("t").alias("j"),
                                   F.lit(0).alias("side")))
    dealt = (entries.join(stored(lists, "pivot-lists").withColumn("parts", parts), ["width", "key"])
             .withColumn("own", own)
             .withColumn("t", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("task", task)
             .select("key", "task.i", "task.j", "task.side", "cid", "n", "vec", "perm", "width")
             .repartition("width", "key", "i", "j")
             .sortWithinPartitions("width", "key", "i", "j", "side"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = now = None
        for width, b in _by_width(batches):
            new = [b.column(k).to_numpy(zero_copy_only=False) for k in range(6)]
            new += [unit(_matrix(b.column(6), dtype, width)), _matrix(b.column(7), "<u2", nearest)]
            if held is not None and width != now:
                yield from _lists(held, [0, len(held[0])])
                held = None
            now = width
            held = new if held is None else [np.concatenate(z) for z in zip(held, new)]
            key, i, j = held[:3]
            cut = np.flatnonzero((np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
            if len(cut):                 # the last list may go on in the next batch
                yield from _lists(held, [0, *cut])
                held = [z[cut[-1]:] for z in held]
        if held is not None:
            yield from _lists(held, [0, len(held[0])])

    def _lists(rows: list[np.ndarray], bounds: list[int]) -> Iterator[pa.RecordBatch]:
        found = []
        for a, z in zip(bounds, bounds[1:]):
            key, i, j, side, cid, n, x, p = (col[a:z] for col in rows)
            same, half = i[0] == j[0], int((side == 0).sum())
            first, second = (slice(None), slice(None)) if same else (slice(0, half), slice(half, None))
            r, c = _verify(same, x[first], x[second], p[first], p[second], int(key[0]), pivots,
                           threshold)
            if len(r):
                c = c if same else c + half
                links = (np.bincount(r, n[c], len(cid)) + np.bincount(c, n[r], len(cid)))
                at = np.flatnonzero(links)
                found.append((cid[at], links[at].astype(np.int64),
                              cid[_ties(len(cid), r, c)][at]))
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(z), pa.int64()) for z in zip(*found)],
                names=["cid", "links", "peer"])

    return dealt.mapInArrow(run, "cid long, links long, peer long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, pivots: int | None = None,
                    nearest: int | None = None, block: int = BLOCK) -> DataFrame:
    """One row per input row: id, n_links (other rows linked directly),
    component_id (smallest id reachable, itself included), kept.  ``pivots`` and
    ``nearest`` are by default those of ``index_size``.

    Null, empty and zero vectors and those with null or non-finite components
    link with nothing and are components of their own; vectors of different lengths do
    not link with each other.  Repeated rows are linked with each other.  A
    null id is never kept and names no component (null if no member has an id).
    Empty input gives no rows; other columns are ignored."""
    single_threaded_tasks(vectors.sparkSession)
    src = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    src = src.withColumn("ok", usable(F.col("vector")))
    kind = src.schema["vector"].dataType.simpleString()
    if kind not in ("array<float>", "array<double>"):
        src = src.withColumn("vector", F.col("vector").cast("array<double>"))
        kind = "array<double>"
    alone = [F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
             F.col("id").isNotNull().alias("kept")]
    fits = F.col("ok")
    classes = stored(src.where(fits).groupBy("vector").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), "vector-classes")
    fitting = index_size(classes.count())
    pivots, nearest = pivots or fitting[0], nearest or fitting[1]
    of_width: dict[int, list] = {}
    for r in classes.select("vector").orderBy(F.xxhash64("vector")).limit(PIVOT_SAMPLE).collect():
        of_width.setdefault(len(r["vector"]), []).append(r["vector"])
    sample = {w: unit(np.array(v, np.float64)) for w, v in of_width.items()}
    index = stored(_index(classes, sample, pivots, nearest), "pivot-index")
    dtype = "<f4" if kind == "array<float>" else "<f8"
    links = stored(vector_links(index, dtype, pivots, nearest, threshold, block), "vector-links")
    roots = connected_components(links.select(F.col("cid").alias("a"), F.col("peer").alias("b")))
    named = (index.select("cid", "first", "n", "vector")
             .join(links.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left")
             .join(roots, F.col("cid") == F.col("node"), "left")
             .withColumn("root", F.coalesce("root", "cid")))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    known = named.join(splittable(least), "root").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    linked = src.where(fits).join(known, "vector").select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
    return linked.unionByName(src.where(~fits)
                              .select(F.col("id").alias(id_col), *alone))
