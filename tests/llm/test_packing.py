import random
import zlib

import numpy as np
import pytest
from helpers import documents
from pyspark.sql import functions as F

from bomspark.llm import packing
from bomspark.llm.queries import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    return lambda x: t.encode(x, add_special_tokens=False).ids


def test_ids_equal_the_tokenizer_on_odd_texts(reference):
    rng = random.Random(1)
    alpha = "ab'std re  \t\n\r\xa0\x85\x1c’“é²½1 9!.,-_　中́😀ǆ"
    texts = ["".join(rng.choice(alpha) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["I'll we've it''s  x   \n\n y  ", "<|endoftext|> a", "", " ", "x" * 5000]
    own = packing.TokenIds(PATH)
    for x in texts:
        assert own.of(x) == np.asarray(reference(x), "<u4").tobytes(), repr(x)


def test_special_tokens_and_very_long_runs(reference):
    own = packing.TokenIds(PATH)
    assert np.frombuffer(own.of("x <|endoftext|> y"), "<u4").tolist() == [87, 220, 50256, 331]
    for x in (" " * 1_000_001 + "end", "\n" * 1_200_000, "a" + "\t" * 1_000_000):
        assert own.of(x) == np.asarray(reference(x), "<u4").tobytes()


def check(rows, docs, reference, capacity=1024):
    """Every piece is right and every sequence is gapless and not over-full."""
    want = {}
    for doc_id, text in docs:
        ids = reference(text or "") + [2]
        cut = (len(ids) - 1) % capacity + 1 if len(ids) > capacity else len(ids)
        bounds = [0, *range(cut, len(ids), capacity), len(ids)]
        for k, (a, z) in enumerate(zip(bounds, bounds[1:])):
            crc = zlib.crc32(np.asarray(ids[a:z], "<u4").tobytes())
            want.setdefault((doc_id, k, a, z - a, crc), 0)
            want[(doc_id, k, a, z - a, crc)] += 1
    got, by_sequence = {}, {}
    for r in rows:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        got[key] = got.get(key, 0) + 1
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pieces_and_sequences(spark, reference):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "erbleing", "of", "é", "x9"]) for _ in range(rng.choice(
        [0, 1, 30, 300, 1200, 2500]))) for _ in range(120)]
    docs = [(i, t) for i, t in enumerate(texts)]
    docs += [(None, "no id"), (7, None), (8, ""), (3, texts[3]), (3, texts[3]), (500, "ab " * 30000)]
    table = documents(spark, docs).withColumn("length", F.lit("clash")).withColumn(
        "sequence_id", F.lit(1))
    rows = packing.pack(table, PATH).collect()
    made = check(rows, docs, reference)
    total = sum(r.length for r in rows)
    assert made <= 1.1 * total / 1024 + 2


def test_sequences_hold_the_ids(spark, reference):
    docs = [(i, "the of and " * (50 * i)) for i in range(12)]
    packed = packing.pack(documents(spark, docs), PATH, with_ids=True, capacity=256)
    rows = packed.collect()
    check(rows, docs, reference, 256)
    held = {r.sequence_id: r.input_ids for r in packing.sequences(packed).collect()}
    for r in rows:
        assert held[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == r.input_ids


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), PATH).count() == 0


def test_best_fit_keeps_few_bins_and_fills_the_fullest():
    p = packing.BestFit(10, open_bins=2)
    assert p.place(6) == (0, 0) and p.place(7) == (1, 0)
    assert p.place(3) == (1, 7)          # 3 fits both; the fuller one takes it
    assert p.place(5) == (2, 0)          # sequence 1 is full, so two are open
    assert p.place(9) == (3, 0)          # a third: sequence 0 (fullest, 4 free) closes
    assert p.open == 2 and p.place(5) == (2, 5)


def test_best_fit_against_a_plain_search():
    rng = random.Random(3)
    for bins in (1, 3, 50):
        p, open_, made = packing.BestFit(64, bins), {}, 0
        for _ in range(800):
            n = rng.randint(1, 64)
            number, offset = p.place(n)
            fits = [f for f in open_.values() if f >= n]
            if fits:
                assert 64 - offset == min(fits) == open_[number]
            else:
                assert offset == 0 and number == made
                made += 1
                if len(open_) == bins:
                    gone = min(open_.values())
                    held = {x for f in p.by_free for x in f}
                    out = [x for x in open_ if open_[x] == gone and x not in held]
                    del open_[out[0]]
                open_[number] = 64
            open_[number] -= n
            if not open_[number]:
                del open_[number]
            assert p.open == len(open_) <= bins
