"""Centroid clustering: against plain Lloyd rounds in Python's integers."""

import hashlib
import math

import numpy as np
import pytest

from bomspark.llm import centroids as C
from bomspark.llm import queries

VECTORS = "vec_id long, embedding array<double>"
FIELDS = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def floors(v, scale=1024):
    return [scale * int(x) if abs(x) >= 2.0 ** 60 else math.floor(scale * x) for x in v]


def plain(rows, width, clusters=8, rounds=10, seed=3):
    """(id, *FIELDS) per usable row, as sorted text."""
    kept = [(i, floors(map(float, v))) for i, v in rows if v is not None and len(v) == width
            and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    first = sorted(kept, key=lambda r: (hashlib.sha256(
        f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [r[1] for r in first[:clusters]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        of = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), (c, _) in zip(kept, of) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    of = assign()
    def fit(x):
        return x if x is not None and x < 1 << 63 else None
    def total(ds):
        return None if any(fit(d) is None for d in ds) else sum(ds)
    return sorted(repr((i, k, fit(d), fit(total([e for j, e in of if j == k])),
                        fit(total([e for _, e in of])), hashlib.sha256(
                            ",".join(map(str, centroids[k])).encode()).hexdigest()))
                  for (i, _), (k, d) in zip(kept, of))


def clustered(frame, **given):
    got = C.report(*C.cluster(frame, **given))
    return sorted(repr((r["vec_id"], *(r[f] for f in FIELDS))) for r in got.collect())


def test_query_on_the_given_table(spark):
    from conftest import SF_SMALL
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
            .select("vec_id", "embedding").collect()]
    got = queries.centroid_clustering(spark, SF_SMALL)
    assert sorted(repr((r["vec_id"], *(r[f] for f in FIELDS))) for r in got.collect()) \
        == plain(rows, 64)


@pytest.mark.parametrize("spread", [0.01, 1.0, 1e6, 1e30])
def test_blobs_ties_copies_and_sizes(spark, spread):
    """Planted groups with repeated vectors; components of any size are exact."""
    rnd = np.random.default_rng(4)
    middle = rnd.normal(size=(5, 6)) * spread
    rows = [(i, (middle[i % 5] + rnd.normal(size=6) * spread / 20).tolist()) for i in range(120)]
    rows += [(500 + i, rows[0][1]) for i in range(60)]       # a third of all are copies
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)
    assert clustered(frame, width=6, clusters=4) == plain(rows, 6, clusters=4)


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    rows = [(i, [float(i % 3), 0.0]) for i in range(30)] + [(99, [1.0, 0.0])] * 5
    frame = spark.createDataFrame(rows, VECTORS)
    assert clustered(frame, width=2) == plain(rows, 2)


def test_unusable_vectors_null_ids_and_few_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [0.0, 0.0]), (None, [0.5, -0.5]), (8, [-0.0001, 0.3]), (8, [-0.0001, 0.3])]
    frame = spark.createDataFrame(rows, VECTORS)
    assert clustered(frame, width=2) == plain(rows, 2)
    assert len(plain(rows, 2)) == 4
    none = C.report(*C.cluster(frame.where("vec_id < 7"), width=2))
    assert none.collect() == [] and none.columns == ["vec_id", *FIELDS]
    assert clustered(spark.createDataFrame([], VECTORS)) == []


def test_other_kinds_of_numbers_and_clashing_columns(spark):
    rows = [(i, [float(i % 7), float(i * i % 11)]) for i in range(40)]
    frame = spark.createDataFrame(rows, VECTORS)
    other = frame.selectExpr("vec_id", "CAST(embedding AS array<int>) AS embedding", "1 AS id",
                             "2 AS vector", "3 AS cluster", "4 AS distance")
    assert clustered(other, width=2) == plain(rows, 2)
    named = frame.selectExpr("vec_id AS v", "CAST(embedding AS array<float>) AS x")
    got = C.cluster(named, "v", "x", width=2)[0]
    assert got.columns == ["v", "cluster", "distance"] and got.count() == 40


def test_bounds_hold_and_prune():
    """Every true distance lies between the apexes' bounds; on groups that lie apart
    most exact distances are saved, and the nearest centroid is never ruled out."""
    rnd = np.random.default_rng(5)
    middle = rnd.normal(size=(8, 64))
    x = C.integers(middle[rnd.integers(0, 8, 2000)] + rnd.normal(size=(2000, 64)) / 10, 1024)
    centroids = C.integers(middle, 1024)
    for pivots in (x[:16], centroids, x[:1], np.vstack([x[:3], x[:3], 2 * x[:1] - x[1:2]])):
        simplex = C.Simplex(pivots)
        a, c = simplex.apexes(x), simplex.apexes(centroids)
        true = np.stack([C.distances(x, k) for k in centroids], 1).astype(float)
        square = a[:, :1] + c[:, 0] - 2 * a[:, 1:-1] @ c[:, 1:-1].T
        height = 2 * a[:, -1:] * c[:, -1]
        assert (square - height <= true + 1e-6 * true.max()).all()
        assert (true <= square + height + 1e-6 * true.max()).all()
        near = C.candidates(a, c)
        assert near[np.arange(2000), true.argmin(axis=1)].all()
        number, least, compared = C.nearest(x, a, centroids, c)
        assert (number == true.argmin(axis=1)).all() and (least == true.min(axis=1)).all()
        assert compared == near.sum()
        if len(pivots) >= 8 and len(simplex.pivots) == len(pivots):
            assert compared < 0.4 * near.size


def test_limbs_add_up():
    for v in (0, 1, -1, 2 ** 30, -2 ** 95 + 7, 3 ** 200):
        assert sum(x << C._LIMB * i for i, x in enumerate(C._as_limbs(v))) == v
