import re
from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline as C
from logweave.llm import credentials, mixing, packing, quality, simhash
from logweave.llm.queries import ORACLE_SQL, QUERIES
from oracle import compare
import public_tokenizers
import pytest
from test_tokens import check_packing

SF = "/root/testdata/sf0.001"


def test_stages_step_by_step(spark):
    """Each stage against the operator's decisions on the same input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = [docs]
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, got[-1], SF)
        assert out.columns == docs.columns
        got.append(spark.createDataFrame(out.collect(), out.schema))
    kept = {r.doc_id for r in quality.score_quality(docs, quality.fit_quality(docs, labels)).collect() if r.predicted}
    assert {r.doc_id for r in got[1].collect()} == kept
    least = {r.component_id for r in simhash.near_duplicates(got[1]).collect()}
    assert {r.doc_id for r in got[2].collect()} == least and got[2].count() == len(least)
    spans = {r.doc_id: r.spans for r in credentials.find_secrets(got[2]).collect()}
    before = {r.doc_id: r for r in got[2].collect()}
    for r in got[3].collect():
        assert (r.text == before[r.doc_id].text) == (spans[r.doc_id] == "")
    taken = {r.doc_id: r.taken for r in mixing.mix(got[3]).collect()}
    words = Counter()
    for r in got[4].collect():
        words[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert +words == +Counter(taken)
    rows = C.STAGES[-1][1](spark, got[4], SF).collect()
    check_packing(rows, 4096)
    pieces = packing.token_pieces(got[4], public_tokenizers.path(C.TOKENIZER)).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, rows)) == sorted(map(key, pieces))


def test_run_is_the_stages_in_order(spark):
    rows = C.run(spark, SF).collect()
    assert rows and check_packing(rows, 4096) == -(-sum(r.length for r in rows) // 4096)


def test_empty_documents(spark, empty):
    docs = empty
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracles(spark, name):
    r = compare(spark, name, QUERIES[name], ORACLE_SQL[name], SF)
    assert r["ok"] and r["spark_rows"] == r["duck_rows"], r


def test_registered():
    names = entry.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
