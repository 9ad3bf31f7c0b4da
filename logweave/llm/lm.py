"""LM scoring (operator 2): hashed maximum-entropy model with a class-factored softmax.

P(token | history) = P(class | history) * P(unit | class, history) * P(token | unit). Both of the first
factors are softmaxes over 64 outcomes whose features are the last token, the last two, and the tokens
two and three back alone (skip features), hashed into weight rows; the second factor's features are
hashed together with the class. So context prefers one word of a class to another. The most
frequent tokens are units of their own, 48 to a class, words of like endings side by side; the other
head tokens and all tail tokens share units by their ending. Inside such a unit the model's features are the
tokens themselves, whose maximum-entropy weights are the logarithms of their (for tail
tokens: discounted) counts; the discount is the share of a tail unit for tokens never seen in training.

Training: token counts of all training documents are summed by Spark. Then, over all
training documents in ``rounds`` disjoint parts, every task makes gradient updates on its
documents from the round's common weights; the rows of weights are averaged by how
often each task met them, in a shuffle that sums block by block, and are the next
round's start. Only model parameters of a stated size meet on the driver.

Scoring: head tokens (a bounded broadcast table) are scored in numpy batches; the tokens
of the open-ended tail leave the task as one row per document and token and meet the
table of counts in a join. Texts are never shuffled. Tasks work on slices of texts of
bounded bytes.

The probabilities of all known tokens and of "unknown" (split by ending) sum to one; they are kept as logarithms
throughout, without a floor.

Defined cases: null text is empty (one end token); null ids are never learned from and
count as held out; without training text every class and unit is equally likely and every token
unknown; rows with equal ids are scored one by one; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import id_crc_mod, table
from .tokens import byte_batches, coded_segments, slices, utf8

FOLDS, HELD_OUT = 7, 2
END = b"\n"              # no word holds a line break
HEAD = 1 << 16           # tokens in the broadcast table
CLASSES = 64
WIDTH = 64               # units of a class: single tokens, then other head tokens and tail tokens by ending
SINGLES, ENDINGS = 48, 8
ROWS = 1 << 14           # hashed weight rows of each of the two softmaxes
BLOCK = 256              # weight rows summed together
CHUNK = 1 << 13          # tokens of one numpy batch when scoring
STEP = 1 << 15           # tokens of one gradient update
TASK_TOKENS = 2_000_000  # tokens of a training task, about
SLICE = 1 << 20          # bytes of text scored together
FLUSH = 400_000          # distinct tokens a task counts before it hands them on
HELD = 1 << 10           # rows of logits worked at a time, so that they stay in a core's cache
FAN = 32                 # rows added at a time
HISTORY = 3
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(id_crc_mod(doc_id, FOLDS) == HELD_OUT, F.lit(True))


# ------------------------------------------------------------------ counts
def _words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct lower-cased words, each word of the texts by its number there, and how many words each text has."""
    words, codes, counts = coded_segments(pc.ascii_lower(pa.array(texts, pa.large_binary()).cast(pa.large_string())))
    kept = pc.not_equal(words, "").to_numpy(zero_copy_only=False)[codes]
    owner = np.repeat(np.arange(len(texts)), counts)
    return words, codes[kept], np.bincount(owner[kept], minlength=len(texts))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, times, merged = [], [], 0

    def merge() -> None:
        coded = pa.concat_arrays(words).dictionary_encode()
        c = np.bincount(coded.indices.to_numpy(), np.concatenate(times), len(coded.dictionary)).astype(np.int64)
        words[:], times[:] = [coded.dictionary], [c]

    def out() -> pa.RecordBatch:
        merge()
        batch = pa.RecordBatch.from_arrays([words[0].cast(pa.string()), pa.array(times[0])], ["token", "c"])
        words.clear()
        times.clear()
        return batch

    for batch in batches:
        for texts in byte_batches(utf8(batch.column(0)), limit=SLICE):
            found, codes, _ = _words(texts)
            words += [found, pa.array([END], pa.large_binary()).cast(pa.large_string())]
            times += [np.bincount(codes, minlength=len(found)), [len(texts)]]
            if sum(map(len, words)) - merged > FLUSH:
                merge()
                merged = len(words[0])
                if merged > FLUSH:
                    yield out()
                    merged = 0
    if words:
        yield out()


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, c) over all rows of the single text column; the end token is a line break."""
    return texts.mapInArrow(_counts, "token string, c bigint").where("c > 0").groupBy("token").agg(F.sum("c").alias("c"))


#: Endings are told apart into so many buckets, ``ENDINGS`` to a class.
BUCKETS = CLASSES * ENDINGS


def ending_bucket(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % BUCKETS


def _bucket_column(token: Column) -> Column:
    return (F.crc32(F.substring(token.cast("binary"), -2, 2)) % BUCKETS).cast("int")


def shared_unit(bucket: int | np.ndarray, tail: bool) -> int | np.ndarray:
    """The unit (class * WIDTH + place) of an ending bucket's head or tail tokens."""
    return bucket // ENDINGS * WIDTH + SINGLES + ENDINGS * tail + bucket % ENDINGS


# ------------------------------------------------------------------ model
@dataclass
class Model:
    """Parameters of a stated size: head table, statistics of units, hashed weights."""
    total: int                      # N
    distinct: int                   # V
    head: dict[bytes, int]
    head_count: np.ndarray
    discount: float
    tail_words: np.ndarray          # V of each bucket's tail tokens
    tail_tokens: np.ndarray         # N of them
    class_bias: np.ndarray = field(default=None)
    unit_bias: np.ndarray = field(default=None)
    weights: np.ndarray = field(default=None)     # rows of the classes' softmax, then of the units'

    def prepare(self) -> None:
        """Derive units, priors and the tokens' shares of their units."""
        words = list(self.head)
        units = np.array([shared_unit(ending_bucket(w), False) for w in words], np.int64)
        single = sorted(range(min(len(words), CLASSES * SINGLES)), key=lambda i: words[i][::-1])
        for place, i in enumerate(single):
            units[i] = place // SINGLES * WIDTH + place % SINGLES
        self.head_unit = units
        mass = np.bincount(units, self.head_count, CLASSES * WIDTH)
        mass[shared_unit(np.arange(BUCKETS), True)] = self.tail_tokens
        grid = mass.reshape(CLASSES, WIDTH) + 0.5
        self.class_bias = np.log(grid.sum(axis=1) / grid.sum()).astype(np.float32)
        self.unit_bias = np.log(grid / grid.sum(axis=1, keepdims=True)).astype(np.float32)
        self.log_share = np.log10(self.head_count / mass[units]) if words else np.zeros(0)
        # a tail unit without tokens is all "unknown"
        empty = self.tail_tokens == 0
        self.log_tail_total = np.log10(np.where(empty, 1, self.tail_tokens))
        self.log_unknown = np.log10(np.where(empty, 1, self.discount * self.tail_words))
        self.weights = np.zeros((2 * ROWS, WIDTH), np.float32)

    def biases(self) -> np.ndarray:
        """Of the classes, then of the units of each class."""
        return np.concatenate([self.class_bias[None], self.unit_bias])


def fit_head(counts: DataFrame) -> Model:
    """The head table and the statistics of the tail's buckets; what is collected is bounded by ``HEAD``."""
    by_size = counts.groupBy(F.floor(F.log2("c")).cast("int").alias("b")).agg(
        F.count("*").alias("n"), F.sum("c").alias("s"), F.count_if(F.col("c") == 1).alias("n1"),
        F.count_if(F.col("c") == 2).alias("n2")).collect()
    distinct, total = sum(r.n for r in by_size), sum(r.s for r in by_size)
    above, least = 0, 1
    for r in sorted(by_size, key=lambda r: -r.b):
        above, least = above + r.n, 1 << r.b
        if above >= HEAD:
            break
    top = counts.where(F.col("c") >= least).orderBy(F.col("c").desc(), "token").limit(HEAD).collect()
    n1, n2 = sum(r.n1 for r in by_size), sum(r.n2 for r in by_size)
    discount = min(0.9, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5
    words, tokens = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.groupBy(_bucket_column(F.col("token")).alias("k")).agg(F.count("*").alias("n"), F.sum("c").alias("s")).collect():
        words[r.k], tokens[r.k] = r.n, r.s
    for r in top:  # what is left of all tokens is the tail
        k = ending_bucket(r.token.encode())
        words[k] -= 1
        tokens[k] -= r.c
    model = Model(total, distinct, {r.token.encode(): i for i, r in enumerate(top)},
                  np.array([r.c for r in top], np.float64), discount, words, tokens)
    model.prepare()
    return model


# ------------------------------------------------------------------ numpy batches
@cache
def _endings() -> np.ndarray:
    """The ending bucket of any two last bytes, then of any single one."""
    one, two = [bytes([a]) for a in range(256)], [bytes([a, b]) for a in range(256) for b in range(256)]
    return np.array([ending_bucket(w) for w in two + one])


class Reader:
    """Turns texts into symbols: head tokens by number, tail tokens by ending bucket, a gap between documents."""

    def __init__(self, model: Model):
        self.model = model
        self.gap = len(model.head) + BUCKETS
        self.head = pa.array(list(model.head), pa.large_binary()).cast(pa.large_string())
        self.units = np.concatenate([model.head_unit, shared_unit(np.arange(BUCKETS), True)]).astype(np.int64)
        self.endings = _endings()

    def buckets(self, words: pa.Array) -> np.ndarray:
        """The ending bucket of each word; that of an empty one, which no text has, is of no meaning."""
        offset, data = words.buffers()[1:]
        ends = np.frombuffer(offset, np.int64)[words.offset:words.offset + len(words) + 1]
        if ends[-1] == 0:
            return np.zeros(len(words), np.int64)
        letters = np.frombuffer(data, np.uint8)
        last, before = (letters[np.maximum(ends[1:] - i, 0)].astype(np.int64) for i in (1, 2))
        return self.endings[last + np.where(np.diff(ends) < 2, 1 << 16, before << 8)]

    def numbered(self, words: pa.Array) -> np.ndarray:
        """The symbol of each word."""
        symbols = pc.fill_null(pc.index_in(words, value_set=self.head), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        tail = np.flatnonzero(symbols < 0)
        symbols[tail] = len(self.head) + self.buckets(words.take(pa.array(tail)))
        return symbols

    def symbols(self, words: list[bytes]) -> np.ndarray:
        """Of one document, the end token included."""
        return self.numbered(pa.array([*words, END], pa.large_binary()).cast(pa.large_string()))

    def read(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct words, the end last; all tokens of the texts by their number there, and their symbols; tokens of each text."""
        words, codes, counts = _words(texts)
        codes = np.insert(codes, np.cumsum(counts), len(words)).astype(np.int64)
        words = pa.concat_arrays([words, pa.array([END], pa.large_binary()).cast(pa.large_string())])
        symbols = self.numbered(words)
        return words, codes, symbols[codes], counts + 1

    def documents(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The symbols of each text, the end token included."""
        for some in byte_batches(texts, limit=SLICE):
            _, _, symbols, counts = self.read(some)
            yield from np.split(symbols, np.cumsum(counts)[:-1])

    def targets(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, place in it) of each symbol."""
        return np.divmod(self.units[symbols], WIDTH)


def chunks(documents: Iterator[np.ndarray], gap: int, size: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(symbols with history, places of the targets, document of each target), of bounded length."""
    parts, owners, held = [], [], 0
    pad = np.full(HISTORY, gap, np.int64)

    def out():
        symbols = np.concatenate(parts)
        owner = np.concatenate(owners)
        place = np.flatnonzero(owner >= 0)
        return symbols, place, owner[place]

    for d, symbols in enumerate(documents):
        for at in range(0, len(symbols), size):
            part = symbols[at:at + size]
            parts += [pad if at == 0 else symbols[at - HISTORY:at], part]
            owners += [np.full(HISTORY, -1), np.full(len(part), d)]
            held += len(part)
            if held >= size:
                yield out()
                parts, owners, held = [], [], 0
    if held:
        yield out()


def features(symbols: np.ndarray, place: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """(features, 2 x targets) weight rows: last token, last two, the ones two and three back; for the class of each target,
    then, hashed with its class, for its unit."""
    one, two, three = (symbols[place - i].astype(np.uint64) + np.uint64(1) for i in (1, 2, 3))
    shift, spread = np.uint64(65 - ROWS.bit_length()), np.uint64(0x9E3779B97F4A7C15)
    own = (classes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    n = len(place)
    rows = np.empty((len(_MULTIPLIERS), 2 * n), np.uint64)
    for i, (key, m) in enumerate(zip((one, one * np.uint64(1_000_003) + two, two, three), _MULTIPLIERS)):
        rows[i, :n] = key * np.uint64(m) + np.uint64(i + 1)
        np.bitwise_xor(rows[i, :n], own, out=rows[i, n:])
    rows *= spread
    rows >>= shift
    rows[:, n:] += np.uint64(ROWS)
    return rows.view(np.int64)


def _joined(join: np.ufunc, start: np.ndarray, own: np.ndarray, table: np.ndarray, rows: np.ndarray,
            out: np.ndarray | None) -> Iterator[tuple[slice, np.ndarray]]:
    """In blocks of ``HELD`` rows: the own row of ``start`` with a row of ``table`` for each feature, added or multiplied."""
    room, part = np.empty((2, HELD, WIDTH), np.float32)
    for at in range(0, len(own), HELD):
        places = slice(at, min(at + HELD, len(own)))
        n = places.stop - at
        held = room[:n] if out is None else out[places]
        start.take(own[places], axis=0, out=held, mode="clip")  # no index is outside; "raise" would copy
        for r in rows:
            table.take(r[places], axis=0, out=part[:n], mode="clip")
            join(held, part[:n], out=held)
        yield places, held


def _reach(weights: np.ndarray) -> float:
    return float(max(weights.max(), -weights.min()))


def _logits(model: Model, weights: np.ndarray, rows: np.ndarray, classes: np.ndarray, out: np.ndarray | None = None,
            part: slice = slice(None)) -> Iterator[tuple[slice, np.ndarray]]:
    """(2 x targets, 64), or a part of it, in blocks of ``HELD`` rows: of the classes, then of the units of each target's class.

    They are lessened by the greatest of a row where weights are so large that exponentials might not fit; elsewhere
    a row's greatest logit is between -65 and 60, as the biases are logarithms of 64 shares."""
    own = np.r_[np.zeros_like(classes), classes + 1][part]
    large = len(rows) * _reach(weights) > 60
    for places, logits in _joined(np.add, model.biases(), own, weights, rows[:, part], out):
        if large:
            logits -= logits.max(axis=1, keepdims=True)
        yield places, logits


class Powers:
    """Exponentials of weights, kept beside them: a logit's exponential is the product of those of its bias and weights."""

    def __init__(self, model: Model, weights: np.ndarray):
        biases = model.biases()
        self.weights, self.powers, self.biases = weights, np.empty_like(weights), np.exp(biases)
        self.renew(slice(None))
        self.reach, self.most = _reach(weights), min(60, 85 + float(biases.min()))

    def renew(self, places: slice) -> None:
        """After a change of these rows of weights; what does not fit is not used."""
        with np.errstate(over="ignore"):
            np.exp(self.weights[places], out=self.powers[places])

    def fit(self, n: int) -> bool:
        """Whether products of ``n`` rows and a bias are surely normal numbers."""
        if n * self.reach > self.most:  # ``reach`` may be a bound
            self.reach = _reach(self.weights)
        return n * self.reach <= self.most


def _shares(model: Model, powers: Powers, rows: np.ndarray, classes: np.ndarray, out: np.ndarray | None = None,
            part: slice = slice(None)) -> Iterator[tuple[slice, np.ndarray]]:
    """Exponentials of ``_logits``."""
    own = np.r_[np.zeros_like(classes), classes + 1][part]
    yield from _joined(np.multiply, powers.biases, own, powers.powers, rows[:, part], out)


def log_probabilities(model: Model, weights: np.ndarray, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Natural logarithms of the same shape."""
    out = np.empty((2 * len(classes), WIDTH), np.float32)
    for _, logits in _logits(model, weights, rows, classes, out):
        logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return out


_ONES = np.ones(WIDTH, np.float32)


def target_log_probability(model: Model, weights: np.ndarray, rows: np.ndarray, classes: np.ndarray, units: np.ndarray,
                           powers: Powers | None = None) -> np.ndarray:
    """Natural logarithm of each target's class and unit together; ``powers`` are those of the weights."""
    wanted, both = np.r_[classes, units], np.empty(2 * len(classes))
    wanted += WIDTH * (np.arange(len(wanted)) % HELD)  # place in the block
    if powers is not None and powers.fit(len(rows)):
        for places, shares in _shares(model, powers, rows, classes):
            own = shares.ravel().take(wanted[places])
            both[places] = np.log(own, dtype=np.float64) - np.log(shares @ _ONES, dtype=np.float64)
    else:
        for places, logits in _logits(model, weights, rows, classes):
            own = logits.ravel().take(wanted[places]).astype(np.float64)
            np.exp(logits, out=logits)
            both[places] = own - np.log(logits @ _ONES, dtype=np.float64)
    return both[:len(classes)] + both[len(classes):]


def _errors(model: Model, weights: np.ndarray, rows: np.ndarray, classes: np.ndarray, units: np.ndarray,
            powers: Powers | None = None, out: np.ndarray | None = None, part: slice = slice(None)) -> np.ndarray:
    """Probabilities less one at the targets, or a part of these rows; ``powers`` are those of the weights."""
    wanted = np.r_[classes, units][part]
    out = np.empty((len(wanted), WIDTH), np.float32) if out is None else out[:len(wanted)]
    wanted += WIDTH * (np.arange(len(wanted)) % HELD)  # place in the block
    ready = powers is not None and powers.fit(len(rows))
    blocks = _shares(model, powers, rows, classes, out, part) if ready else _logits(model, weights, rows, classes, out, part)
    for places, shares in blocks:
        if not ready:
            np.exp(shares, out=shares)
        shares *= (1 / (shares @ _ONES))[:, None]
        shares.reshape(-1)[wanted[places]] -= 1.0
    return out


def sums_by_key(values: np.ndarray, places: np.ndarray, keys: np.ndarray, out: np.ndarray) -> None:
    """``out[k]`` becomes the sum of ``values[places[i]]`` over all i with ``keys[i] == k``; the keys rise.

    Up to ``FAN`` rows of a key are added at a time, in blocks of sums that stay in the cache; the sums of a key are added in turn."""
    out[:] = 0
    total, room = np.empty((2, HELD, WIDTH), np.float32)
    while len(keys):
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        length = np.diff(np.r_[first, len(keys)])
        parts = -(-length // FAN)
        begin = np.repeat(first - FAN * (np.cumsum(parts) - parts), parts) + FAN * np.arange(parts.sum())
        size = np.minimum(np.repeat(first + length, parts) - begin, FAN)
        met = np.repeat(keys[first], parts)
        several = np.repeat(parts > 1, parts)
        slot = np.cumsum(several) - 1
        pieces = np.empty((int(several.sum()), WIDTH), np.float32)
        order = np.argsort((FAN - size).astype(np.uint16), kind="stable")  # longest first
        for at in range(0, len(order), HELD):
            some = order[at:at + HELD]
            start, held, shorter = begin[some], total[:len(some)], -size[some]
            values.take(places[start], axis=0, out=held, mode="clip")
            for j, n in enumerate(np.searchsorted(shorter, -np.arange(1, -int(shorter[0]))).tolist(), 1):  # those of more than j rows
                values.take(places[start[:n] + j], axis=0, out=room[:n], mode="clip")
                np.add(held[:n], room[:n], out=held[:n])
            out[met[some]] = held  # the next turn writes keys of several parts again
            again = np.flatnonzero(several[some])
            pieces[slot[some[again]]] = held[again]
        values, places, keys = pieces, np.arange(len(pieces)), met[several]


def _train(batches: Iterator[pa.RecordBatch], shared, rate: float) -> Iterator[pa.RecordBatch]:
    """Gradient updates on this task's documents; the changed rows and how often they were met, by block."""
    model = shared.value
    reader = Reader(model)
    weights, squares = model.weights.copy(), np.ones(model.weights.shape, np.float32)
    powers = Powers(model, weights)
    met, gradient, room = np.zeros(2 * ROWS, np.int64), np.empty((ROWS, WIDTH), np.float32), np.empty((2 * STEP, WIDTH), np.float32)
    documents = (d for batch in batches for d in reader.documents(utf8(batch.column(0))))
    for symbols, place, _ in chunks(documents, reader.gap, STEP):
        classes, units = reader.targets(symbols[place])
        rows = features(symbols, place, classes)
        n = len(classes)
        # tokens of like history side by side: their rows of weights, and of errors, are then near each other
        order = np.argsort(rows[1, :n].astype(np.uint16), kind="stable")
        order = order[np.argsort(rows[0, order].astype(np.uint16), kind="stable")]
        classes, units, rows = classes[order], units[order], rows[:, np.r_[order, order + n]]
        for first, part in (0, slice(0, n)), (ROWS, slice(n, 2 * n)):  # the softmaxes share no weights
            error = _errors(model, weights, rows, classes, units, powers, room, part)
            every = rows[:, part].ravel()
            order = np.argsort(every.astype(np.uint16), kind="stable")
            sums_by_key(error, order % n, every[order] - first, gradient)
            for at in range(0, ROWS, BLOCK):
                places = slice(first + at, first + at + BLOCK)
                g, s = gradient[at:at + BLOCK], squares[places]
                s += g * g
                g /= np.sqrt(s)
                g *= rate
                weights[places] -= g
                powers.renew(places)
            met += np.bincount(every, minlength=2 * ROWS)
        powers.reach += rate  # no weight changes by more
    weights -= model.weights
    for at in range(0, 2 * ROWS, BLOCK):
        n = met[at:at + BLOCK]
        if n.any():
            yield pa.RecordBatch.from_arrays([
                pa.array([at], pa.int32()), pa.array([n.tobytes()], pa.binary()),
                pa.array([weights[at:at + BLOCK].tobytes()], pa.binary())], ["block", "met", "change"])


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of equal blocks come together in one task and are summed as they stream in."""
    sums: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for block, met, change in zip(*(c.to_pylist() for c in batch.columns)):
            n = np.frombuffer(met, np.int64)
            part = np.frombuffer(change, np.float32).reshape(BLOCK, WIDTH) * n[:, None].astype(np.float64)
            if block in sums:
                sums[block][0] += n
                sums[block][1] += part
            else:
                sums[block] = [n.copy(), part]
    for block, (n, total) in sums.items():
        mean = (total / np.maximum(n, 1)[:, None]).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([mean.tobytes()], pa.binary())], ["block", "mean"])


def fit_weights(training: DataFrame, model: Model, part: Column, rounds: int = 2, rate: float = 0.5) -> Model:
    """``training`` has the text column; ``part`` deals its rows into ``rounds`` disjoint parts.

    Every task sends its weights, so small partitions are put together until a task has some ``TASK_TOKENS``."""
    spark = training.sparkSession
    tasks = max(1, -(-model.total // (rounds * TASK_TOKENS)))
    for r in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        changes = training.where(part == r).select("text").coalesce(tasks).mapInArrow(
            partial(_train, shared=shared, rate=rate), "block int, met binary, change binary")
        means = changes.repartition(2 * ROWS // BLOCK // 4, "block").mapInArrow(_average, "block int, mean binary")
        for row in means.toLocalIterator():
            model.weights[row.block:row.block + BLOCK] += np.frombuffer(row.mean, np.float32).reshape(BLOCK, -1)
        shared.unpersist()
    return model


# ------------------------------------------------------------------ scoring
_PARTS = ("row bigint, doc_id bigint, token string, tf bigint, unknown double, "
          "n_tokens bigint, n_known bigint, base double, score double")


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Of each document one row with what the head decides, and one row per distinct tail token."""
    model = shared.value
    reader, n_head, powers = Reader(model), len(model.head), Powers(model, model.weights)
    log_count = np.log10(model.head_count + 1)
    context = TaskContext.get()
    row = (context.partitionId() if context else 0) << 40
    to_ten = 1 / np.log(10)
    for ids, texts in (x for batch in batches for x in slices(batch, SLICE)):
        words, codes, all_symbols, n = reader.read(texts)
        ends = np.cumsum(n)
        symbols = np.split(all_symbols, ends[:-1])
        total = np.zeros(len(texts))
        for part, place, owner in chunks(iter(symbols), reader.gap):
            target = part[place]
            classes, units = reader.targets(target)
            log_p = target_log_probability(model, model.weights, features(part, place, classes), classes, units, powers) * to_ten
            tail = target >= n_head
            log_p[~tail] += model.log_share[target[~tail]]
            log_p[tail] -= model.log_tail_total[target[tail] - n_head]
            total += np.bincount(owner, log_p, len(texts))
        of, in_head = np.repeat(np.arange(len(texts)), n), all_symbols < n_head
        known = np.bincount(of[in_head], minlength=len(texts))
        base = np.bincount(of[in_head], log_count[all_symbols[in_head]], len(texts))
        rows = np.arange(row, row + len(texts))
        row += len(texts)
        yield pa.RecordBatch.from_arrays([
            pa.array(rows), pa.array(ids, pa.int64()), pa.array([f"\n{r}" for r in rows.tolist()]),
            *(pa.nulls(len(rows), t) for t in (pa.int64(), pa.float64())), pa.array(n), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(total)],
            _PARTS_NAMES)
        pairs, tf = np.unique(of[~in_head] * len(words) + codes[~in_head], return_counts=True)
        of, word = np.divmod(pairs, len(words))
        tokens = words.take(pa.array(word))
        unknown = model.log_unknown[reader.buckets(tokens)]
        nothing = [pa.nulls(len(pairs), t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())]
        yield pa.RecordBatch.from_arrays([
            pa.array(rows[of]), pa.nulls(len(pairs), pa.int64()), tokens.cast(pa.string()),
            pa.array(tf, pa.int64()), pa.array(unknown, pa.float64()), *nothing], _PARTS_NAMES)


_PARTS_NAMES = [x.split()[0] for x in _PARTS.split(", ")]


def score_documents(docs: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    parts = docs.select("doc_id", "text").mapInArrow(partial(_score, shared=shared), _PARTS)
    met = parts.join(counts, "token", "left")
    c = F.col("c")
    of_tail = F.when(c.isNotNull(), F.log10(c - F.lit(model.discount))).otherwise(F.col("unknown"))
    summed = met.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + F.coalesce(F.sum(F.when(c.isNotNull(), F.col("tf"))), F.lit(0))).alias("n_known"),
        (F.max("base") + F.coalesce(F.sum(F.col("tf") * F.log10(c + 1)), F.lit(0.0))).alias("_base"),
        (F.max("score") + F.coalesce(F.sum(F.col("tf") * of_tail), F.lit(0.0))).alias("score"))
    per_token = F.log10(F.lit(float(model.total + model.distinct + 1)))
    return summed.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.total).cast("bigint").alias("train_tokens"),
                         (F.col("_base") - F.col("n_tokens") * per_token).alias("base_score"), "score")


def fit(docs: DataFrame, rounds: int = 2) -> tuple[DataFrame, Model]:
    training = docs.where(~held_out())
    counts = cut_lineage(token_counts(training.select("text")))
    part = F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / FOLDS) % rounds
    return counts, fit_weights(training, fit_head(counts), part, rounds)


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts, model = fit(docs)
    return score_documents(docs, counts, model)
