import random
from collections import defaultdict

import pytest
import xxhash
from logweave.llm import simhash as S
from logweave.llm.components import components


def brute(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def union(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in linked:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in nodes}


def close(marks, bits=2):
    marks = sorted(marks)
    return [(a, b) for i, a in enumerate(marks) for b in marks[:i] if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= bits]


def test_against_brute_force(docs):
    rows = docs.collect()
    got = S.near_duplicates(docs).collect()
    assert sorted((r.doc_id or -1, r.fingerprint) for r in got) == sorted((r.doc_id or -1, f"{brute(r.text):016x}") for r in rows)
    ids = defaultdict(list)
    for r in rows:
        ids[brute(r.text)].append(r.doc_id)
    root = union(ids, close(ids))
    least = defaultdict(list)
    for mark, of in ids.items():
        least[root[mark]] += [i for i in of if i is not None]
    for r in got:
        assert r.component_id == min(least[root[int(r.fingerprint, 16)]], default=None)


@pytest.mark.parametrize("limit", [1, 4, 10 ** 6])
@pytest.mark.parametrize("bits", [1, 2])
def test_dense_cluster_with_and_without_long_lists(spark, limit, bits):
    rng = random.Random(5)
    x, marks = rng.getrandbits(64), set()
    for _ in range(150):
        for _ in range(rng.randint(1, 3)):
            x ^= 1 << rng.randrange(64)
        marks.add(x)
    marks = {m - (1 << 64) if m >> 63 else m for m in marks | {rng.getrandbits(64) for _ in range(30)}}
    want = union(marks, close(marks, bits))
    df = spark.createDataFrame([(m,) for m in marks], "_fp long")
    assert {r._fp: r._group for r in S.groups(df, bits, list_limit=limit).collect()} == want


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.u: r.v for r in components(df).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}


def test_one_of_each(docs, empty):
    kept = S.one_of_each(docs)
    assert kept.columns == docs.columns
    of = {r.fingerprint: r.component_id for r in S.near_duplicates(docs).collect()}
    rows = kept.collect()
    marks = {brute(r.text) for r in docs.collect()}
    assert len(rows) == len(set(union(marks, close(marks)).values()))
    for r in rows:
        assert r.doc_id == of[f"{brute(r.text):016x}"]
    assert S.one_of_each(empty).count() == 0 and S.near_duplicates(empty).count() == 0


def test_components_of_odd_edges(spark):
    rows = [(1, 2), (2, 1), (2, 3), (5, 5), (None, 1), (7, None), (9, 8), (9, 8)]
    edges = spark.createDataFrame([(*r, "x") for r in rows], "u long, v long, other string")
    assert sorted(map(tuple, components(edges).collect())) == [(2, 1), (3, 1), (9, 8)]
    assert components(edges.limit(0)).collect() == []
