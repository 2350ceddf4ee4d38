import random

import pytest
import xxhash
from helpers import documents, union_find
from pyspark.sql import functions as F

from bomspark.llm import simhash
from bomspark.llm.graph import connected_components


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_is_the_contract(spark):
    rng = random.Random(4)
    words = ["The", "of", "É", "é", "x\u00a0y", "straße", "İ"]
    texts = [rng.choice([" ", "\t", "\x0b"]).join(rng.choice(words) for _ in range(n))
             for n in (0, 1, 2, 3, 4, 5, 9, 200, 3000)] + [None, "", " \n ", "A"]
    for t in texts:
        assert simhash.fingerprint(None if t is None else t.encode()) == plain_fingerprint(t)
    got = {r.id: r.fp & (1 << 64) - 1
           for r in simhash.fingerprints(documents(spark, list(enumerate(texts)))).collect()}
    assert got == {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    one = spark.createDataFrame([("über of x",)], "t string").select(F.xxhash64("t")).first()[0]
    assert one & (1 << 64) - 1 == simhash.fingerprint("über of x".encode())


def groups_of(rng, n):
    """Fingerprints in chains and clouds around centres, and lone ones."""
    out = set()
    for _ in range(n):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 3, 12, 60])):
            out.add(x)
            y = x
            for _ in range(rng.choice([1, 2, 3, 4])):
                y ^= 1 << rng.randrange(64)
            if rng.random() < 0.4:
                x = y
            out.add(y)
    return sorted(out)


@pytest.mark.parametrize("bits,longest", [(0, 32), (1, 32), (2, 32), (2, 3), (2, 1), (3, 4), (4, 32)])
def test_links_connect_what_is_near(spark, bits, longest):
    rng = random.Random(bits * 10 + longest)
    fps = [x - (1 << 64) if x >> 63 else x for x in groups_of(rng, 12)]
    mask = (1 << 64) - 1
    near = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:]
            if bin((a ^ b) & mask).count("1") <= bits]
    table = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = [tuple(r) for r in simhash.fingerprint_links(table, bits, longest).collect()]
    allowed = {frozenset(p) for p in near}
    assert all(frozenset(p) in allowed for p in got)
    if longest == 32 and bits < 3:
        assert len(got) == len(set(map(frozenset, got)))
    assert union_find(fps, got) == union_find(fps, near)


def test_near_duplicates_with_odd_rows(spark):
    rng = random.Random(9)
    body = " ".join(f"w{rng.randrange(400)}" for _ in range(900))
    rows = [(10, body), (5, body), (7, body.replace("w3 ", "w4 ", 1)), (20, "other words here at all"),
            (30, None), (29, ""), (31, " \t"), (None, body), (20, "other words here at all"),
            (None, "alone with no id")]
    table = documents(spark, rows).withColumn("component_id", F.lit("x")).withColumn("fp", F.lit(0))
    got = simhash.near_duplicates(table).collect()
    assert len(got) == len(rows)
    fps = [plain_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i)
             if bin(fps[i] ^ fps[j]).count("1") <= 2]
    root = union_find(range(len(rows)), pairs)
    want = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in root if root[j] == root[i] and rows[j][0] is not None]
        want.append((str(doc_id), f"{fps[i]:016x}", str(min(ids, default=None))))
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == sorted(want)
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_one_per_group(spark):
    """By their texts: unrelated texts under one id both stay, equal ones without an id are
    one group; the smallest id stays, one without an id only beside others of its kind."""
    rows = [(4, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (9, "q r s t"), (None, "a b c d e"),
            (1, "one two three four"), (1, "cinq six sept huit"), (None, "p o i u"), (None, "p o i u"),
            (7, None), (6, ""), (None, " ")]
    frame = documents(spark, rows).selectExpr("*", "1 AS row", "2 AS fp", "3 AS __row", "4 AS id")
    got = simhash.one_per_group(frame)
    assert got.columns == frame.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted([
        ("2", "a b c d e"), ("9", "q r s t"), ("1", "one two three four"),
        ("1", "cinq six sept huit"), ("None", "p o i u"), ("6", "")])
    assert simhash.one_per_group(documents(spark, [])).collect() == []


def test_a_star_is_split_among_tasks(spark):
    """A node with very many neighbours: AQE splits both joins of a round."""
    from bomspark.llm import graph
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        edges = spark.range(1, 60_001, 1, 8).selectExpr("id AS u", "0L AS v")
        found = graph._round(edges)
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert "SortMergeJoin" in plan and "skew=true" in plan


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    for n, m in ((1, 0), (30, 20), (200, 150), (50, 400)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        edges += [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2050)]
        frame = spark.createDataFrame(edges + [(None, 3), (5, 5)], "a long, b long")
        got = {r.node: r.root for r in connected_components(frame).collect()}
        nodes = {x for e in edges if e[0] != e[1] for x in e}
        assert got == union_find(nodes, [e for e in edges if e[0] != e[1]])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
