"""What a packing worker holds is bounded, and nothing stays between tasks."""

import public_tokenizers
import pyarrow as pa
from logweave.llm import packing as P
from logweave.llm import tokens as T

PATH = public_tokenizers.path("word_bpe_49k.json")


def cut(texts):
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    return [tuple(r.values()) for b in P._cut(iter([batch]), PATH, 4096, 1) for r in b.to_pylist()]


def test_texts_are_encoded_by_slices_and_forgotten(monkeypatch):
    texts = [f"word{i} and {i * 7} " * (1 + i % 9) for i in range(300)] + [None, "", "x " * 9000]
    whole = cut(texts)
    enc, sizes = T.encoder(PATH), []
    encode = enc.id_bytes
    monkeypatch.setattr(enc, "id_bytes", lambda group: sizes.append(sum(map(len, group))) or encode(group))
    monkeypatch.setattr(P, "BATCH_BYTES", 2000)
    monkeypatch.setattr(T, "MEMO_IDS", 50)
    assert cut(texts) == whole
    assert len(sizes) > 10 and all(n <= 2000 for n in sizes[:-1]) and sizes[-1] == 18000
    assert not enc.ids and not enc.pieces


def test_slices_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"a": [1, None, 3, 4], "t": ["ab", None, "c" * 9, "d"]})
    assert list(T.slices(batch, 3)) == [([1, None], [b"ab", b""]), ([3], [b"c" * 9]), ([4], [b"d"])]


def test_accented_words_go_by_pieces_and_have_the_librarys_ids(monkeypatch):
    enc = T.SegmentEncoder(PATH)
    simple = [f"{a}{c}{b}" for c in T.LETTERS for a in ("", "x", "É", "'s", "9") for b in ("", "Y", "ü", "...", "'ll", "7")]
    simple += ["4575803494779329", "26.243.41.137", "***", "ÉEAUQUE!!", "ENTSTÖ", "ßSß"]
    other = ["é", "ȩ́x", "J̌", "İx", "ΟΣ", "½", "a b", "中文", "x<|y", "<|endoftext|>é"]
    texts = [" ".join(simple[i:i + 50]) + "  \n" for i in range(0, len(simple), 50)] + ["", " ", " \t".join(simple[:9] + other)]
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert enc.simple
    asked, encode = [], enc._encode
    monkeypatch.setattr(enc, "_encode", lambda words: asked.extend(words) or encode(words))
    got = enc.id_bytes([t.encode() for t in texts])
    assert got == [T._packed(ids) for ids in want]
    assert sorted(asked) == sorted(w for o in other for w in T.SegmentEncoder.segments(enc, o.encode()) for w in [w.decode()])
    assert not set(asked) & set(simple)
