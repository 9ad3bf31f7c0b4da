"""Token counts (operator 9) and the shared segment encoder.

Texts are counted inside Arrow functions: no text is shuffled and only lengths leave
the workers. A tokenizer that drops white space cannot form a token across it, so a
text is split there (that is what keeps very long texts bounded), each distinct
segment is encoded once per worker, and the segments still unknown are handed to the
library in batches of about equal bytes. Whether the split is safe is tried on the
tokenizer itself; where it is not, and for sentencepiece models, whole texts are
encoded, in batches balanced by bytes. Only segments of pure ASCII are lowered early, and
only where a trial shows that case does not count: the library composes characters before
it lowers them, so other segments go to it as they are.

Defined cases: null text counts as empty (0 bytes, 0 tokens); rows with equal ids are
counted one by one; a null id is returned as null; an empty table gives an empty
result; other columns of the table are not read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import cached_property, partial
from itertools import product
from string import ascii_letters, ascii_lowercase, digits, punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .common import table

COUNT_SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
BATCH_BYTES = 1 << 20
#: Bound on each worker's memory of encoded segments; it is emptied when full.
MEMO_ENTRIES = 1_000_000
#: The same for segments with their ids, which take some 250 bytes each.
MEMO_IDS = 400_000
LONGEST_KEPT = 64

#: Letters beyond ASCII that may stand in words taken by pieces: composed ones, whose lower case is one character.
LETTERS = [c for c in map(chr, range(0xC0, 0x180)) if c.isalpha() and len(c.lower()) == 1]
#: The printed character of each byte in byte-level vocabularies.
_PRINTED = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
BYTE_LEVEL = _PRINTED | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def piece_rule(letters: str = "") -> re.Pattern:
    """The pre-tokenizer's rule for printable ASCII in lower case and more letters; used only where a trial on the tokenizer holds."""
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{letters}]+|[0-9]|[^\sa-z0-9{letters}]+")


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_file=path)
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_batches(items: Iterable, size=len, limit: int = BATCH_BYTES) -> Iterator[list]:
    """Lists of consecutive items of about ``limit`` bytes; a longer item goes alone."""
    batch, held = [], 0
    for item in items:
        n = size(item)
        if batch and held + n > limit:
            yield batch
            batch, held = [], 0
        batch.append(item)
        held += n
    if batch:
        yield batch


class SegmentEncoder:
    """Encodes texts as the library does, without added special tokens."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.sentencepiece = path.endswith(".model")
        self.splits = not self.sentencepiece and self._drops_white_space()
        self.lowers = self.splits and self._ignores_case()
        self.counts: dict[bytes, int] = {}
        self.ids: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.model = None if self.sentencepiece else self.tokenizer.model
        self.rule = piece_rule()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        if self.sentencepiece:
            return self.tokenizer.encode(texts, num_threads=1)
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _lengths(self, texts: list[str]) -> list[int]:
        if self.sentencepiece:
            return list(map(len, self._encode(texts)))
        return list(map(len, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)))

    def _drops_white_space(self) -> bool:
        gaps = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "  \n "]
        whole = self._encode([f"{g}Ab,{g}c1{g}" for g in gaps])
        parts = self._encode(["Ab,", "c1"])
        return all(x == parts[0] + parts[1] for x in whole)

    def _ignores_case(self) -> bool:
        words = [*map("".join, product(ascii_letters, repeat=2)), ascii_letters, "X'S", "I'LL", "A1B", "NaN-Ab.C"]
        return self._encode(words) == self._encode([w.lower() for w in words])

    @cached_property
    def ascii_pieces(self) -> bool:
        """Whether the pieces by ``piece_rule`` have the library's ids."""
        words = [*map("".join, product(ascii_lowercase + digits + punctuation, repeat=2)), "it's", "we'll've", "x'sted",
                 "a1b22c", "''s'", "'re9", "foo-bar_baz!!", "(a.b)'d", "internationalization", "x.y's1"]
        return all(_packed(ids) == self._by_pieces(w) for w, ids in zip(words, self._encode(words)) if "<|" not in w)

    @cached_property
    def simple(self) -> re.Pattern | None:
        """What words taken by pieces are made of: printable ASCII and those of ``LETTERS`` whose trial on the tokenizer holds."""
        if not self.ascii_pieces:
            return None
        small = sorted({c.lower() for c in LETTERS} & set(LETTERS))
        self.rule = piece_rule("".join(small))
        cases = [c for c in LETTERS if self.lowers or c in small]
        ways = "{0}", "{0}{0}", "a{0}", "{0}a", "st{0}ng", "{0}1", "1{0}", "{0}.", ".{0}", "{0}'s", "'s{0}", "{0}'ll{0}", "e{0}\u00e9\u00fc{0}n"
        words = [w.format(c) for c in cases for w in ways]
        right = [_packed(ids) == self._by_pieces(w.lower()) for w, ids in zip(words, self._encode(words))]
        failed = {c.lower() for i, c in enumerate(cases) if not all(right[i * len(ways):(i + 1) * len(ways)])}
        self.rule = piece_rule("".join(c for c in small if c not in failed))
        self.pieces.clear()
        letters = "".join(c for c in cases if c.lower() not in failed)
        return re.compile(rf"[!-@\[-~{'A-Z' if self.lowers else ''}{letters}]+")

    def _by_pieces(self, word: str) -> bytes:
        return b"".join([self.pieces.get(p) or self._piece(p) for p in self.rule.findall(word)])

    def segments(self, text: bytes) -> list[bytes]:
        """Runs between ASCII white space; ASCII ones lowered unless a special string may be there."""
        if not self.lowers or b"<|" in text:
            return text.split()
        if text.isascii():
            return text.lower().split()
        return [s.lower() if s.isascii() else s for s in text.split()]

    def lengths(self, texts: list[bytes]) -> list[int]:
        if not self.splits:
            return [n for b in byte_batches(texts) for n in self._lengths([t.decode() for t in b])]
        known, split = self.counts, [self.segments(t) for t in texts]
        if len(known) > MEMO_ENTRIES:
            known.clear()
        new = {s for segments in split for s in segments if s not in known}
        long = {}
        for batch in byte_batches(new):
            for s, n in zip(batch, self._lengths([s.decode() for s in batch])):
                (known if len(s) <= LONGEST_KEPT else long)[s] = n
        if not long:
            return [sum(map(known.__getitem__, segments)) for segments in split]
        return [sum(known[s] if s in known else long[s] for s in segments) for segments in split]

    def id_bytes(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        if not self.splits:
            return [_packed(ids) for b in byte_batches(texts) for ids in self._encode([t.decode() for t in b])]
        known = self.ids
        if len(known) > MEMO_IDS:
            self.forget_ids()
        # each distinct segment is looked up once; "" has no ids
        distinct, codes, counts = coded_segments(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
        segments = distinct.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        parts = list(map(known.get, segments))
        missed = [i for i, ids in enumerate(parts) if ids is None]
        keys = [self._key(segments[i]) for i in missed]
        long, rest = {b"": b""}, []
        simple = self.simple
        for s in {s for s in keys if s and s not in known}:
            into = known if len(s) <= LONGEST_KEPT else long
            word = s.decode()
            if simple and "<|" not in word and simple.fullmatch(word):
                into[s] = self._by_pieces(word.lower())
            else:
                rest.append(s)
        for batch in byte_batches(rest):
            for s, ids in zip(batch, self._encode([s.decode() for s in batch])):
                (known if len(s) <= LONGEST_KEPT else long)[s] = _packed(ids)
        for i, s in zip(missed, keys):
            parts[i] = known[s] if s in known else long[s]
        return _strung(parts, codes, counts)

    def _key(self, segment: bytes) -> bytes:
        return segment.lower() if self.lowers and segment.isascii() and b"<|" not in segment else segment

    def forget_ids(self) -> None:
        self.ids.clear()
        self.pieces.clear()

    def _piece(self, piece: str) -> bytes:
        printed = piece if piece.isascii() else "".join([BYTE_LEVEL[b] for b in piece.encode()])
        ids = _packed([t.id for t in self.model.tokenize(printed)])
        if len(piece) <= LONGEST_KEPT:
            self.pieces[piece] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(4, "little") for i in ids])


def coded_segments(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct runs between ASCII white space, each run by its number there, and how many runs each text has.

    There may be an empty run before leading and after trailing white space."""
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), split.value_lengths().to_numpy()


def _strung(parts: list[bytes], codes: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The parts named by the next ``counts[i]`` codes, strung together, for each i; parts hold whole 32-bit numbers."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    starts, taken = np.cumsum(sizes) - sizes, sizes[codes]
    ends = np.cumsum(taken)
    at = np.repeat(starts[codes] - ends + taken, taken)
    at += np.arange(len(at))
    strung = np.frombuffer(b"".join(parts), "<u4")[at].tobytes()
    bounds = (4 * np.r_[0, ends][np.r_[0, np.cumsum(counts)]]).tolist()
    return [strung[a:b] for a, b in zip(bounds, bounds[1:])]


_ENCODERS: dict[str, SegmentEncoder] = {}


def encoder(path: str) -> SegmentEncoder:
    """One encoder for each worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = SegmentEncoder(path)
    return _ENCODERS[path]


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts) of some rows at a time, up to ``limit`` bytes of text (a longer text alone)."""
    at = 0
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
    while at < batch.num_rows:
        end, held = at, 0
        while end < batch.num_rows and (end == at or held + sizes[end] <= limit):
            held += sizes[end]
            end += 1
        part = batch.slice(at, end - at)
        yield part.column(0).cast(pa.int64()).to_pylist(), utf8(part.column(1))
        at = end


def _count(batches: Iterator[pa.RecordBatch], path: str, limit: int) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for batch in batches:
        texts = utf8(batch.column(1))
        counts = [n for group in byte_batches(texts, limit=8 * BATCH_BYTES) for n in enc.lengths(group)]
        yield pa.RecordBatch.from_arrays([
            batch.column(0).cast(pa.int64()), pa.array(list(map(len, texts)), pa.int64()), pa.array(counts, pa.int64()),
            pa.array([n > limit for n in counts], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; ``path`` names a .json or .model file."""
    return docs.select("doc_id", "text").mapInArrow(partial(_count, path=path, limit=limit), COUNT_SCHEMA)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
