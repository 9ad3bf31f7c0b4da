import hashlib
import statistics

from logweave.llm import minhash as M


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edits_and_estimates(spark):
    sf = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = {r.doc_id: r for r in M.op5_fingerprints(spark, sf).collect()}
    assert len(got) == len(rows)
    off, prints = [], {}
    for i, (doc_id, text) in enumerate(rows):
        after, k, r = rows[(i + 1) % len(rows)][1], len(text) // 4, got[doc_id]
        edited = text[:len(text) - k] + after[:k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        off += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, after)]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert len(r.fingerprint) == len(r.edited_fingerprint) == M.BINS
        assert prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
    assert abs(statistics.mean(off)) < 0.02 and statistics.pstdev(off) < 0.05 and max(map(abs, off)) < 0.2


def test_sparse_bins_are_filled_alike(spark):
    df = spark.createDataFrame([("a b c d e f g",), ("a b c d e f g h",), ("x",)], "t string")
    values = [r[0] for r in df.select(M.bin_values(M.shingle_hashes(df.t))).collect()]
    assert all(len(v) == M.BINS and None not in v for v in values)
    assert len(set(values[0])) == 3 and len(set(values[1])) == 4 and len(set(values[2])) == 1
    assert sum(a == b for a, b in zip(values[0], values[1])) / M.BINS > 0.55  # similarity 3/4


def test_odd_rows(spark, docs, empty):
    rows = M.fingerprint_documents(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[9001].fingerprint == by[9002].fingerprint == by[9003].fingerprint
    assert by[9001].near_next == 1.0 and by[9003].near_next == 0.0
    assert len({r.near_next for r in rows if r.doc_id == 9009 and r.n_chars == 14}) == 1
    assert M.fingerprint_documents(empty).count() == 0
    single = M.fingerprint_documents(docs.where("doc_id = 9004")).first()
    assert single.near_next == 1.0 and single.near_edited == 1.0
