import gzip
import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, StringStartsWith

from bomspark.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def plain(rows):
    first = {}
    data = [(i, (h or "").encode()) for i, _, h in rows]
    for i, b in data:
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, b in data:
        to = first.get(b)
        again = to is not None and i != to
        out.append((str(i), len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response",
                    to if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    rng = random.Random(5)
    long = "é\r\n\r\nWARC/1.1\r\n" * 40
    texts = ["", None, "short", "x" * 99, "y" * 100, long, "HTTP/1.1 200 OK\r\n\r\n" + "z" * 200,
             "q" * 3_000_000]
    rows = [(i, rng.choice(["http://a/%41 é", None, "u\r\nWARC-Type: response", ""]), rng.choice(texts))
            for i in range(80)]
    rows += [(None, "n", long), (None, "n", None), rows[5], (-4, "neg", "y" * 100), (2**62, "big", long)]
    frame = pages(spark, rows).withColumn("record_type", F.lit("x")).withColumn("payload", F.lit(1))
    got = warc.round_trip(frame.repartition(4)).collect()
    assert sorted(((str(r[0]), *r[1:]) for r in got), key=str) == plain(rows)
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_payloads_without_a_numbered_page_are_responses(spark):
    rows = [(None, "a", "k" * 150), (None, "b", "k" * 150)]
    got = warc.round_trip(pages(spark, rows)).collect()
    assert [(r.record_type, r.refers_to) for r in got] == [("response", None)] * 2


@pytest.fixture()
def archive(spark, tmpdir_path):
    rows = [(i, f"http://h{i % 3}/p", ("same" if i % 2 else f"own{i}") * 100) for i in range(30)]
    path = f"file://{tmpdir_path}/warc"
    warc.write_archives(pages(spark, rows).repartition(3), path)
    return rows, path


def test_files_are_plain_warc(archive):
    rows, path = archive
    names = os.listdir(path[7:])
    assert len(names) == 3 and all(n.endswith(".warc.gz") for n in names)
    text = b"".join(gzip.open(f"{path[7:]}/{n}").read() for n in names)
    assert text.count(b"WARC/1.1\r\nWARC-Type: warcinfo") == 3
    assert text.count(b"WARC-Type: response") == 16 and text.count(b"WARC-Type: revisit") == 14


def test_predicates_are_pushed_and_right(spark, archive):
    rows, path = archive
    back = warc.read_archives(spark, path)
    revisit = back.where((F.col("record_type") == "revisit") & (F.col("page_id") > 5))
    assert {r.page_id for r in revisit.collect()} == {i for i in range(7, 30, 2)}
    assert revisit.where("refers_to = 1 and payload is null and payload_length = 400").count() == 12
    assert back.where(F.col("target_uri").startswith("http://h1")).count() == 10
    assert back.where("page_id in (3, 4)").count() == 2
    plan = back.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"\bFilter\b", plan)
    slim = warc.read_archives(spark, path, payload="false").where("record_type = 'response'")
    assert slim.count() == 16 and slim.where("payload is not null").count() == 0


def test_only_header_tests_are_taken(tmp_path):
    r = warc.WarcReader({"path": f"file://{tmp_path}"})
    left = list(r.pushFilters([EqualTo(("record_type",), "response"), In(("page_id",), (1, 2)),
                               GreaterThan(("page_id",), 0), EqualTo(("payload",), b""),
                               IsNotNull(("record_id",)), StringStartsWith(("target_uri",), "http")]))
    assert [type(f).__name__ for f in left] == ["GreaterThan", "EqualTo"]
    assert r.wanted({"warc-type": "revisit", "warc-record-id": warc.record_id(1),
                     "warc-target-uri": "http://x"}) is None
    assert r.wanted({"warc-type": "response", "warc-record-id": warc.record_id(1),
                     "warc-target-uri": "http://x"}) is True


def records(tmp_path, data):
    (tmp_path / "a.warc").write_bytes(data)
    r = warc.WarcReader({"path": f"file://{tmp_path}"})
    return [row for p in r.partitions() for b in r.read(p) for row in b.to_pylist()]


def test_other_writers_files_are_read(tmp_path):
    one = warc.record_bytes("response", warc.record_id(3), "http://a/%41 é", "ab", 5, None, b"hello")
    odd = (b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x>\r\nX: a\r\n b\r\n"
           b"Content-Length: 9\r\n\r\n\r\n\r\nWARC/\r\n\r\n")
    for data in (one + odd + one, gzip.compress(one) + gzip.compress(odd) + gzip.compress(one),
                 gzip.compress(one) + warc.member(odd) + gzip.compress(one)):
        got = records(tmp_path, data)
        assert [r["record_type"] for r in got] == ["response", "resource", "response"]
        assert got[0]["payload"] == b"hello" and got[0]["target_uri"] == "http://a/%41 é"
        assert got[1]["payload"] == b"\r\n\r\nWARC/" and got[1]["page_id"] is None
    with pytest.raises(ValueError):
        records(tmp_path, one[:-12])
    with pytest.raises(ValueError):
        records(tmp_path, gzip.compress(one)[:-20])


def test_one_gzip_member_may_hold_several_records(tmp_path):
    bulk = os.urandom(300_000)
    one = warc.record_bytes("response", warc.record_id(3), "http://a", "ab", 5, None, b"hello")
    odd = (b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 300000\r\n\r\n" + bulk + b"\r\n\r\n")
    data = gzip.compress(one + odd + one) + gzip.compress(odd + b"\r\n") + warc.member(one)
    got = records(tmp_path, data)
    assert [r["record_type"] for r in got] == ["response", "resource", "response", "resource", "response"]
    assert got[1]["payload"] == got[3]["payload"] == bulk and got[2]["payload"] == b"hello"
    r = warc.WarcReader({"path": f"file://{tmp_path}"})
    list(r.pushFilters([EqualTo(("record_type",), "response")]))
    rows = [x for p in r.partitions() for b in r.read(p) for x in b.to_pylist()]
    assert [x["payload"] for x in rows] == [b"hello"] * 3


def test_skipped_records_are_not_inflated(tmp_path, monkeypatch):
    bulk = os.urandom(2_000_000)
    data = warc.member(warc.record_bytes("response", warc.record_id(1), "u", "d", len(bulk), None, bulk)) * 3
    (tmp_path / "a.warc.gz").write_bytes(data)
    r = warc.WarcReader({"path": f"file://{tmp_path}"})
    list(r.pushFilters([EqualTo(("record_type",), "revisit")]))
    seen = []
    real = warc.zlib.decompressobj

    class Counting:
        def __init__(self, *a):
            self.d = real(*a)

        def decompress(self, data, limit=0):
            out = self.d.decompress(data, limit)
            seen.append(len(out))
            return out

        def __getattr__(self, name):
            return getattr(self.d, name)
    monkeypatch.setattr(warc.zlib, "decompressobj", Counting)
    assert [b for p in r.partitions() for b in r.read(p)] == []
    assert sum(seen) < 20_000


def test_an_aborted_write_leaves_no_files(tmp_path):
    import pyarrow as pa
    w = warc.WarcWriter({"path": f"file://{tmp_path}"})
    batch = pa.RecordBatch.from_pylist([{"page_id": 1, "url": "u", "payload": b"x", "payload_digest": "d",
                                         "record_type": "response", "refers_to": None}])
    message = w.write(iter([batch]))
    r = warc.WarcReader({"path": f"file://{tmp_path}"})
    assert [p.paths for p in r.partitions()] == [[]]      # not there before the commit
    w.abort([message, None])
    assert [p.paths for p in r.partitions()] == [[]] and not any(f for _, _, f in os.walk(tmp_path))
