import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from logweave.llm import packing as P
from logweave.llm import tokens as T
from tokenizers import Tokenizer

WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = ["<|endoftext|>", "a<|endoftext|>b", "<|ENDOFTEXT|> x", "X'S 'S it's", "<|startoftext|><|endoftext|>", "", " \n", "ﬁ K Å İ ΣΑΣ ß"]


def texts(n=4000):
    rng = random.Random(1)
    letters = "abcXYZ'sted 09.,!-<|>endoftext\t\n\r\x0b\x0c\x1c\x85\xa0é̀\u0301ÀßñΣςİıK我 ſ\u2028\u3000"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_segments_encode_like_whole_texts(name):
    path = public_tokenizers.path(name)
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts(), add_special_tokens=False)]
    enc, raw = T.SegmentEncoder(path), [t.encode() for t in texts()]
    assert enc.splits == (name[0] == "w")
    assert enc.lengths(raw) == list(map(len, want))
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.id_bytes(raw)] == want
    assert enc.lengths(raw) == list(map(len, want))  # from the memory of segments


def test_sentencepiece():
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    want = sentencepiece.SentencePieceProcessor(model_file=path).encode(texts(200))
    assert T.SegmentEncoder(path).lengths([t.encode() for t in texts(200)]) == list(map(len, want))


def test_byte_batches():
    items = [b"x" * n for n in (3, 3, 3, 50, 1)]
    batches = list(T.byte_batches(items, limit=6))
    assert [len(b) for b in batches] == [2, 1, 1, 1] and sum(batches, []) == items


def test_counts(docs, empty):
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(Tokenizer.from_file(WORD).encode(r.text or "", add_special_tokens=False).ids))
                  for r in docs.collect())
    got = T.count_tokens(docs, WORD).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert T.count_tokens(empty, WORD).count() == 0


def check_packing(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("group_rows", [7, 50_000])
def test_packing_round_trip(docs, empty, group_rows):
    rows = P.pack(docs, WORD, capacity=512, group_rows=group_rows).collect()
    n = check_packing(rows, 512)
    tokenizer, want = Tokenizer.from_file(WORD), []
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 512)):
            part = ids[start:start + 512]
            want.append((r.doc_id or -1, piece, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    assert n <= -(-sum(w[3] for w in want) // 512) + 2
    assert P.pack(empty, WORD).count() == 0


def fewest(lengths, capacity):
    """Exact bin count by search."""
    best = [len(lengths)]
    lengths = sorted(lengths, reverse=True)

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for b in {bins[j]: j for j in range(len(bins)) if bins[j] + lengths[i] <= capacity}.values():
            place(i + 1, bins[:b] + [bins[b] + lengths[i]] + bins[b + 1:])
        place(i + 1, bins + [lengths[i]])
    place(0, [])
    return best[0]


def test_bounds_and_best_fit():
    rng = np.random.default_rng(0)
    for _ in range(60):
        lengths = rng.integers(1, 21, rng.integers(1, 10))
        bins = P.best_fit_decreasing(lengths, 20)
        assert np.bincount(bins, lengths).max() <= 20
        exact = fewest(lengths.tolist(), 20)
        assert P.lower_bound(lengths, 20) <= exact <= bins.max() + 1
    assert P.lower_bound(np.array([11] * 9), 20) == 9          # halves: one bin each, the sum says 5
    assert P.lower_bound(np.array([7] * 8), 20) == 4           # two to a bin, the sum says 3


def test_exchange_across_groups(spark):
    rows = [(i, 0, 0, 1 + (i * 7919) % 4096, 0, i) for i in range(3000)]
    df = spark.createDataFrame(rows, P.PIECE_SCHEMA)
    few = check_packing(P.pack_pieces(df, group_rows=150).collect(), 4096)
    one = check_packing(P.pack_pieces(df, group_rows=10 ** 6).collect(), 4096)
    lengths = np.array([r[3] for r in rows])
    apart = sum(P.best_fit_decreasing(lengths[i::20], 4096).max() + 1 for i in range(20))
    assert one <= few <= 1.02 * one and few < apart


def test_groups_stay_bounded_where_nothing_pairs_up(spark, monkeypatch):
    largest, cut = [], P.cut_lineage

    def spy(df):
        out = cut(df)
        if "sequence_id" in out.columns:
            group = out.groupBy((out.sequence_id.bitwiseAND((1 << 56) - 1) / (1 << 28)).cast("long").alias("g")).count()
            largest.append(group.agg({"count": "max"}).first()[0] or 0)
        return out

    monkeypatch.setattr(P, "cut_lineage", spy)
    df = spark.range(200_000).selectExpr("id doc_id", "0 piece", "0L start", "2100L length", "0L ids_crc32", "id _deal")
    rows = P.pack_pieces(df, group_rows=2000).select("doc_id", "sequence_id").distinct()
    assert rows.count() == rows.select("doc_id").distinct().count() == rows.select("sequence_id").distinct().count() == 200_000
    assert max(largest) <= 1.2 * 2000


def encodes_like(path, own):
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(own, add_special_tokens=False)]
    enc, raw = T.SegmentEncoder(path), [t.encode() for t in own]
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.id_bytes(raw)] == want
    assert enc.lengths(raw) == list(map(len, want))
    return enc


def test_capitals_without_a_composed_form():
    pairs = ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a"]
    enc = encodes_like(WORD, [*pairs, *(f"An {p}amas, A{p}B Z" for p in pairs), "H\u0331amas"])
    assert enc.lowers and enc.ascii_pieces


def test_tokenizer_that_keeps_case_or_cuts_otherwise(tmp_path):
    from tokenizers import models, normalizers, pre_tokenizers
    vocab = {c: i for i, c in enumerate("".join(map(chr, range(33, 127))))} | {"AB": 200, "ab": 201, "12": 202, "b1": 203}
    merges = [("A", "B"), ("a", "b"), ("1", "2"), ("b", "1")]
    for name, normalizer in (("cased", None), ("lowered", normalizers.Lowercase())):
        tokenizer = Tokenizer(models.BPE(vocab=vocab, merges=merges))
        tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        if normalizer:
            tokenizer.normalizer = normalizer
        path = str(tmp_path / f"{name}.json")
        tokenizer.save(path)
        enc = encodes_like(path, ["AB ab aB", "x12 ab1 b12", "Ab, c1"])
        assert enc.splits and enc.lowers == (name == "lowered") and not enc.ascii_pieces
