import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from logweave.llm import mixing as X


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def waterfill(sizes, weights=(5, 2, 1), cap=3.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in held]
        if not free:
            return held
        level = (total - sum(held.values())) / sum(w[s] for s in free)
        over = [s for s in free if w[s] * level > cap * sizes[s]]
        if not over:
            return held | {s: w[s] * level for s in free}
        held |= {s: cap * sizes[s] for s in over}


def test_against_brute_force(docs):
    rows, got = docs.collect(), X.mix(docs, rows_per_bucket=8).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += size(r.text)
    want = waterfill(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert math.floor(t) - 3 <= taken[s] <= t + 1e-6
    # the order of the keys decides: at most one key of a source is cut inside
    key = lambda i: int(hashlib.md5(("42" if i is None else f"42|{i}").encode()).hexdigest()[:15], 16)
    of = defaultdict(list)
    for r in got:
        if r.size:
            of[r.source].append((key(r.doc_id), r.taken / r.size))
    for shares in of.values():
        shares = [x for _, x in sorted(shares)]
        assert shares == sorted(shares, reverse=True)


def test_reruns_and_bucket_sizes_agree(docs):
    runs = [sorted(map(str, X.mix(docs.repartition(n), rows_per_bucket=b).collect())) for n, b in ((2, 4), (5, 1000))]
    assert runs[0] == runs[1]


def test_mixed_documents_hold_the_taken_words(docs, empty):
    mixed = X.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got, want = Counter(), Counter()
    for r in mixed.collect():
        got[r.doc_id, r.source] += size(r.text)
        assert r.n_chars is None or r.n_chars == len(r.text) or r.doc_id in (9008, 9006, None)
    for r in X.mix(docs).collect():
        want[r.doc_id, r.source] += r.taken
    assert +got == +want
    assert X.mix(empty).count() == 0 and X.mixed_documents(empty).count() == 0


def test_sources_without_words(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, None, "b"), (3, "x y z", "c")], "doc_id long, text string, source string")
    got = {r.source: (r.target, r.taken) for r in X.mix(df).collect()}
    assert got == {"a": (0.0, 0), "b": (0.0, 0), "c": (3.0, 3)}
    assert all(r.taken == 0 for r in X.mix(df.where("source <> 'c'")).collect())
