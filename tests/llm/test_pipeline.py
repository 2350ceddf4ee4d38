import os
import subprocess
import sys

import pytest
from helpers import documents, union_find
from test_packing import check
from test_simhash import plain_fingerprint
from test_text_ops import plain_statistics

import corpus_pipeline
from bomspark.llm import langid, mixing, quality
from bomspark.llm.queries import tokenizer_path

SMALL = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        after = stage(spark, docs, SMALL)
        if name != "best-fit packing":
            assert after.columns == docs.columns, name
        rows = after.collect()
        if name == "quality rules":
            kept = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
            want = {r.doc_id for r in before if r.doc_id in kept}
            assert {r.doc_id for r in rows} == want
            for r in rows:
                n, _, symbols, _, repeated = plain_statistics(r.text)
                assert n >= 20 and 100 * repeated <= 30 * n and symbols <= 0.1 * n
        elif name == "language ID":
            named = {r.doc_id for r in langid.identify(docs).where("lang_pred != 'und' and score >= 0.5")
                     .collect()}
            assert {r.doc_id for r in rows} == named
        elif name == "SimHash near-dedup":
            fps = [plain_fingerprint(r.text) for r in before]
            pairs = [(i, j) for i in range(len(fps)) for j in range(i)
                     if bin(fps[i] ^ fps[j]).count("1") <= 2]
            root = union_find(range(len(fps)), pairs)
            want = {min(before[j].doc_id for j in root if root[j] == k) for k in set(root.values())}
            assert sorted(r.doc_id for r in rows) == sorted(want)
        elif name == "mixing to target weights":
            want = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies}
            got = {}
            for r in rows:
                got[r.doc_id] = got.get(r.doc_id, 0) + 1
            assert got == want
        else:
            from tokenizers import Tokenizer
            t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
            check(rows, [(r.doc_id, r.text) for r in before],
                  lambda x: t.encode(x, add_special_tokens=False).ids)
        docs = spark.createDataFrame(rows, after.schema)


def test_run_equals_the_stages(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert rows and {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(
        rows[0].asDict())
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).toArrow())
    kept = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[k] for k in kept) for r in rows) == sorted(
        tuple(r[k] for k in kept) for r in docs.collect())


@pytest.mark.parametrize("rows", [[], [(1, None), (None, ""), (2, "short")]])
def test_stages_on_odd_tables(spark, rows):
    docs = documents(spark, rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() >= 0


def test_entry_without_the_subpackage():
    code = ("import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
            "q = e.queries(); assert 'best_per_child' in q and 'pipeline' not in q; "
            "assert not any(k.startswith('op') and k[2].isdigit() for k in q); e.oracle_sql()")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
