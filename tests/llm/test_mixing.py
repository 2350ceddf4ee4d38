import itertools
import random

import pytest
from helpers import documents
from pyspark.sql import functions as F

from bomspark.llm import mixing


def test_budget_is_met_when_it_can_be():
    rng = random.Random(1)
    for _ in range(200):
        sizes = rng.sample(range(1, 30), rng.randint(1, 4))
        counts = [rng.randint(1, 3) for _ in sizes]
        budget = rng.randint(0, sum(s * c for s, c in zip(sizes, counts)))
        best = min(abs(budget - sum(k * s for k, s in zip(ks, sizes))) for ks in itertools.product(
            *(range(c + 1) for c in counts)))
        got = mixing.fit_budget(sizes, counts, budget, knapsack=1000)
        assert all(0 <= k <= c for k, c in zip(got, counts))
        assert abs(budget - sum(k * s for k, s in zip(got, sizes))) == best
    sizes, counts = list(range(1, 900)), [rng.randint(1, 40) for _ in range(899)]
    budget = sum(s * c for s, c in zip(sizes, counts)) * 2 // 3 + 1
    got = mixing.fit_budget(sizes, counts, budget)
    assert sum(k * s for k, s in zip(got, sizes)) == budget
    share = [k / c for k, c in zip(got, counts) if c > 20]
    assert 0.5 < sum(share) / len(share) < 0.8     # documents of all sizes are taken


def plain_targets(sizes):
    """Excess over three times a source's size goes to the others by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 3 * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_mix_against_plain_targets(spark, seed):
    rng = random.Random(seed)
    sources = ["b", "a", "Z", "é", "zz", None, "c"][:rng.randint(1, 7)]
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 17, 40, 90]))), None,
             rng.choice(sources + sources[:1] * 8)) for i in range(600)]
    rows += [(1000, None, None, "a"), (None, "x y z", None, "a"), rows[3], rows[3], (1001, "w " * 5000, None, "a")]
    table = documents(spark, rows).withColumn("target", F.lit("x")).withColumn("size", F.lit("x"))
    got = mixing.mix(table).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = plain_targets(sizes)
    source_of = {i: s for i, _, _, s in rows}
    taken, seen = dict.fromkeys(sizes, 0), set()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        s = source_of[r.doc_id]
        assert (r.source_size, round(r.target, 6)) == (sizes[s], round(want[s], 6))
        taken[s] += r.taken
        seen.add((s, r.size))
    for s in sizes:        # to the word, or within half of a huge document
        assert abs(taken[s] - want[s]) <= (1 if (s, 1) in seen and (s, 5000) not in seen else 2500)
    again = mixing.mix(table.repartition(5))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, got)) == sorted(map(key, again.collect()))


def test_mixed_documents_take_what_mix_says(spark):
    rng = random.Random(7)
    rows = [(i, f"t{i} " + "w " * rng.choice([1, 5, 30]), "en", rng.choice("aaabc")) for i in range(300)]
    table = documents(spark, rows)
    want = {r.doc_id: r.copies for r in mixing.mix(table).collect() if r.copies}
    got = mixing.mixed_documents(table)
    assert got.columns == table.columns
    assert {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()} == want


def test_empty(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mixed_documents(documents(spark, [])).count() == 0
    nothing = mixing.mix(documents(spark, [(1, None), (2, "")])).collect()
    assert [(r["size"], r.target, r.taken) for r in nothing] == [(0, 0.0, 0)] * 2
