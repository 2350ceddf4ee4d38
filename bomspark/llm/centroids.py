"""Centroid clustering on integer vectors, filtered by n-simplex projection.

Components are made integers, so sums, means and distances are exact and a run does
not depend on how rows are dealt to tasks.  Each vector's distances to a few pivots
are computed once and kept as the coordinates of an apex over the simplex that the
pivots span: projection onto their flat, and height above it.  Between two
vectors the distance of the apexes is a lower bound, and the same with one
height turned downwards an upper bound.  In every round a centroid is compared
exactly, in integers, only with the vectors whose lower bound to it does not
exceed their least upper bound.

Tasks return sums per centroid, in limbs that Spark adds up; only the centroids
go to the driver and to the tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces_of, single_threaded_tasks, stored

SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
#: Pivots of the simplex: the first centroids and as many vectors after them.
PIVOTS = 16
#: Bits of the limbs that sums are taken apart into.
_LIMB = 30
#: Bounds are widened by this share of the squared distances that they came from.
_SLACK = 1e-6
#: A pivot lower than this share of its distance above the others' flat is left out.
_FLAT = 1e-3
_BATCH = 4096


def usable(vector: Column, width: int) -> Column:
    """Exactly ``width`` components, none null or non-finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == width) & fine, F.lit(False))


def _small(width: int) -> int:
    """Components up to this have squared distances that fit 64 bits; larger ones are
    computed with Python's integers."""
    return math.isqrt((1 << 60) // max(width, 1))


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of rows of vectors, exactly; Python's integers if some are
    large."""
    x = x.astype(np.float64)
    if not x.size or np.abs(x).max() <= _small(x.shape[1]) / scale:
        return np.floor(x * scale).astype(np.int64)
    out = np.empty(x.shape, object)
    out.flat = [scale * int(v) if abs(v) >= 2.0 ** 53 else math.floor(v * scale)
                for v in x.ravel().tolist()]
    return out


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to ``c``."""
    d = x - c
    return (d * d).sum(axis=1)


class Simplex:
    """The pivots' simplex and the apex of a vector over it.

    Coordinates come from distances alone: with the first pivot as origin and the
    triangular factor of the others' inner products as base, the projection solves
    a triangular system and the height is what is left of the distance."""

    def __init__(self, pivots: np.ndarray):
        keep, rows = [0], []
        origin = pivots[0]
        for i in range(1, len(pivots)):
            far = self._apart(pivots[i], origin)
            with np.errstate(all="ignore"):
                inner = np.array([(far + self._apart(pivots[j], origin)
                                   - self._apart(pivots[i], pivots[j])) / 2 for j in keep[1:]])
                row = self._solve(rows, inner)
                height = far - float(row @ row)
            if far > 0 and np.isfinite(height) and height > far * _FLAT ** 2:
                keep.append(i)
                rows.append(np.append(row, math.sqrt(height)))
        self.pivots = [pivots[i] for i in keep]
        n = len(rows)
        self.base = np.zeros((n, n))
        for i, r in enumerate(rows):
            self.base[i, :len(r)] = r
        self.inverse = np.linalg.inv(self.base) if n else self.base
        self.far = np.array([self._apart(p, origin) for p in self.pivots[1:]])

    @staticmethod
    def _apart(a: np.ndarray, b: np.ndarray) -> float:
        d = sum(int(x) * int(x) for x in (a - b).tolist())
        return float(d) if d < 1 << 1000 else float("inf")

    @staticmethod
    def _solve(rows: list[np.ndarray], b: np.ndarray) -> np.ndarray:
        y = np.zeros(len(rows))
        for i, r in enumerate(rows):
            y[i] = (b[i] - r[:i] @ y[:i]) / r[i]
        return y

    def apexes(self, x: np.ndarray) -> np.ndarray:
        """(distance to the origin squared, projection..., height) per row; not a
        number where that is out of range."""
        with np.errstate(all="ignore"):
            d = np.stack([np.array([float(v) if v < 1 << 1000 else np.inf
                                    for v in distances(x, p).tolist()]) for p in self.pivots], 1)
            y = ((d[:, :1] + self.far - d[:, 1:]) / 2) @ self.inverse.T
            height = np.sqrt(np.maximum(d[:, 0] - (y * y).sum(axis=1), 0))
            return np.column_stack([d[:, 0], y, height])


def candidates(apex: np.ndarray, of_centroids: np.ndarray) -> np.ndarray:
    """Which centroids (columns) each vector (row) has to be compared with."""
    with np.errstate(all="ignore"):
        square = apex[:, :1] + of_centroids[:, 0]
        flat = 2 * apex[:, 1:-1] @ of_centroids[:, 1:-1].T
        height = 2 * apex[:, -1:] * of_centroids[:, -1]
        slack = square * _SLACK + 1
        lower, upper = square - flat - height - slack, square - flat + height + slack
        beyond = lower > upper.min(axis=1, keepdims=True)
    return ~beyond         # a bound that is not a number rules nothing out


def nearest(x: np.ndarray, apex: np.ndarray, centroids: np.ndarray,
            of_centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid (the smaller of equals), its squared
    distance, and how many exact distances that took."""
    near = candidates(apex, of_centroids)
    number = np.full(len(x), -1)
    least = np.zeros(len(x), x.dtype if x.dtype == centroids.dtype else object)
    for k, c in enumerate(centroids):
        rows = np.flatnonzero(near[:, k])
        if len(rows):
            d = distances(x[rows], c)
            better = (number[rows] < 0) | (d < least[rows])
            rows = rows[better]
            number[rows], least[rows] = k, d[better]
    return number, least, int(near.sum())


def _as_limbs(value: int) -> list[int]:
    sign, value = (-1, -value) if value < 0 else (1, value)
    out = []
    while value:
        out.append(sign * (value & ((1 << _LIMB) - 1)))
        value >>= _LIMB
    return out


def _common(*parts: np.ndarray) -> list[np.ndarray]:
    """Python's integers everywhere if anywhere."""
    big = any(p.dtype == object for p in parts)
    return [p.astype(object) if big else p for p in parts]


class Model:
    """What tasks are given: the centroids and the simplex (bounded by their
    numbers, not by the rows)."""

    def __init__(self, centroids: list[list[int]], simplex: Simplex, scale: int):
        large = any(abs(v) > _small(len(c)) for c in centroids for v in c)
        self.centroids = np.array(centroids, object if large else np.int64)
        self.apexes = simplex.apexes(self.centroids)
        self.scale = scale

    def assign(self, vectors: np.ndarray, apex: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        x, c = _common(integers(vectors, self.scale), self.centroids)
        return x, *nearest(x, apex, c, self.apexes)


def _rows(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _with_apexes(vectors: DataFrame, simplex: Simplex, scale: int) -> DataFrame:
    kind = vectors.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, _BATCH):
            x, *pivots = _common(integers(_rows(b.column(1), b.num_rows), scale), *simplex.pivots)
            own = Simplex.__new__(Simplex)
            own.__dict__.update(simplex.__dict__, pivots=pivots)
            apex = own.apexes(x)
            at = pa.array(np.arange(b.num_rows + 1) * apex.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1),
                 pa.ListArray.from_arrays(at, pa.array(apex.ravel(), pa.float64()))],
                names=["id", "vector", "apex"])

    id_type = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {id_type}, vector {kind}, apex array<double>")


def _sums(table: DataFrame, model: Model) -> DataFrame:
    """(cluster, component, limb, value): sums of the vectors of each centroid, and
    as the last component how many they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in pieces_of(batches, _BATCH):
            x, number, _, _ = model.assign(_rows(b.column(0), b.num_rows),
                                           _rows(b.column(1), b.num_rows))
            for k in np.unique(number).tolist():
                own = x[number == k]
                part = np.append(own.sum(axis=0).astype(object), len(own))
                total[k] = total[k] + part if k in total else part
        out = [(k, i, j, limb) for k, sums in total.items() for i, v in enumerate(sums)
               for j, limb in enumerate(_as_limbs(int(v)))]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int32(),
                                                            pa.int64()))],
                names=["cluster", "component", "limb", "value"])

    return (table.select("vector", "apex")
            .mapInArrow(run, "cluster int, component int, limb int, value long")
            .groupBy("cluster", "component", "limb").agg(F.sum("value").alias("value")))


def _moved(table: DataFrame, centroids: list[list[int]], model: Model) -> list[list[int]]:
    """The centroids after a round; an empty one stays."""
    width = len(centroids[0])
    sums = {}
    for r in _sums(table, model).collect():      # centroids x components x a few limbs
        at = sums.setdefault(r["cluster"], [0] * (width + 1))
        at[r["component"]] += r["value"] << _LIMB * r["limb"]
    return [[v // sums[k][-1] for v in sums[k][:-1]] if k in sums else c
            for k, c in enumerate(centroids)]


def _assigned(table: DataFrame, model: Model, id_col: str) -> DataFrame:
    id_type = table.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches, _BATCH):
            _, number, least, _ = model.assign(_rows(b.column(1), b.num_rows),
                                               _rows(b.column(2), b.num_rows))
            least = [v if v < 1 << 63 else None for v in least.tolist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(number, pa.int32()), pa.array(least, pa.int64())],
                names=["id", "cluster", "distance"])

    return (table.select("id", "vector", "apex")
            .mapInArrow(run, f"id {id_type}, cluster int, distance long"))


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
            width: int = 64, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS,
            seed: int = SEED, pivots: int = PIVOTS) -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, distance) of every usable vector, and the final centroids.

    The first centroids are the vectors with the smallest hex SHA-256 of
    ``seed:id``, in that order (equal hashes by their components; a null id is
    hashed as nothing).  Every round assigns each vector to the nearest centroid
    and moves each centroid that has vectors to their floored mean; at the end
    vectors are assigned once more.

    Vectors that are null, of another width, or hold null or non-finite components
    are left out.  Repeated rows count as often as they are there; with fewer
    vectors than ``clusters`` there is a centroid per vector; an empty table gives
    no rows and no centroids.  Other columns are ignored.  A squared distance that
    does not fit a long is null (it is compared exactly nevertheless)."""
    single_threaded_tasks(vectors.sparkSession)
    src = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    if src.schema["vector"].dataType.simpleString() not in ("array<float>", "array<double>"):
        src = src.withColumn("vector", F.col("vector").cast("array<double>"))
    src = src.where(usable(F.col("vector"), width))
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = (src.select("vector", F.sha2(label, 256).alias("h")).orderBy("h", "vector")
             .limit(max(clusters, pivots)).collect())
    if not first:
        empty = src.select(F.col("id").alias(id_col), F.lit(None).cast("int").alias("cluster"),
                           F.lit(None).cast("long").alias("distance"))
        return empty, []
    start = integers(np.array([r["vector"] for r in first], np.float64), scale)
    simplex = Simplex(start[:pivots])
    centroids = [[int(v) for v in c] for c in start[:clusters]]
    table = stored(_with_apexes(src, simplex, scale), "apexes")
    for _ in range(rounds):
        model = Model(centroids, _widened(simplex, centroids), scale)
        moved = _moved(table, centroids, model)
        if moved == centroids:          # every further round would give the same again
            break
        centroids = moved
    final = _assigned(table, Model(centroids, _widened(simplex, centroids), scale), id_col)
    return stored(final, "clusters").withColumnRenamed("id", id_col), centroids


def _widened(simplex: Simplex, centroids: list[list[int]]) -> Simplex:
    """The simplex with pivots of the kind of integers that the centroids need."""
    if all(abs(v) <= _small(len(c)) for c in centroids for v in c):
        return simplex
    own = Simplex.__new__(Simplex)
    own.__dict__.update(simplex.__dict__, pivots=[p.astype(object) for p in simplex.pivots])
    return own


def report(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with the sums of distances of each row's cluster and of all, and
    the SHA-256 of its centroid's components joined by commas.  A sum that does not
    fit a long is null, and so are sums over null distances."""
    whole = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    known = F.count("distance") == F.count(F.lit(1))
    sums = {r["cluster"]: r["s"] for r in          # one row per centroid
            assigned.groupBy("cluster").agg(F.when(known, wide).alias("s")).collect()}
    total = None if None in sums.values() else sum(sums.values())

    def fit(v) -> Column:
        return F.lit(None if v is None or v >= 1 << 63 else int(v)).cast("long")

    def pick(values: list[Column], kind: str) -> Column:
        at = F.col("cluster") + 1
        return F.element_at(F.array(*values), at) if values else F.lit(None).cast(kind)
    return assigned.withColumns({
        "cluster_inertia": pick([fit(sums.get(k)) for k in range(len(whole))], "long"),
        "inertia": fit(total),
        "centroid_sha256": pick([F.lit(h) for h in whole], "string")})
