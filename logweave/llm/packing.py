"""Best-fit packing (operator 8): bound-certified repacking of documents into sequences.

Documents are tokenized where they are read; only piece rows (id, place, length,
checksum) go on. The pieces are dealt at random into groups of a bounded number of
rows and each group is packed by best-fit decreasing. Lower bounds from dual feasible
functions certify a group's bin count. Each group closes its fullest bins, as long as they waste no
more than an eighth of a bin in all, and gives the documents of its emptiest bins to the exchange,
but no more bins than ``LOOSE`` times the root of their number: what randomly dealt groups differ by.
A group whose count is above its bound gives up more, the wider the gap, up to half of its bins. Exchanged documents are
dealt into groups of the same size and packed again, until one group is left or a round
saves no bins; then all are closed.

Every round's rows are checkpointed, so a lost executor repeats one round's work at
most. A group never holds more than ``group_rows`` pieces on average, whatever the input.

Defined cases: null text is an empty document (one end id); rows with equal ids are
packed one by one; a null id is returned as null; an empty table gives an empty
result; other columns are not read. Ties are broken by id, piece and checksum.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import table
from .tokens import BATCH_BYTES, encoder, slices

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, _deal bigint"
PACKED_SCHEMA = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
                 "sequence_id bigint, offset bigint, _closed boolean, _deal bigint")
LOOSE = 4  # bins that a certified group may give up, times the root of its bins


# ------------------------------------------------------------------ pieces
def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    enc, end = encoder(path), end_id.to_bytes(4, "little")
    context = TaskContext.get()
    deal = (context.partitionId() if context else 0) << 40
    try:
        for ids, texts in (x for batch in batches for x in slices(batch, BATCH_BYTES)):
            rows: list[list] = [[], [], [], [], [], []]
            for doc_id, packed in zip(ids, enc.id_bytes(texts)):
                packed += end
                for piece, start in enumerate(range(0, len(packed) // 4, capacity)):
                    part = packed[4 * start:4 * (start + capacity)]
                    for column, value in zip(rows, (doc_id, piece, start, len(part) // 4, zlib.crc32(part), deal)):
                        column.append(value)
                    deal += 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "_deal"])
    finally:
        enc.forget_ids()  # a worker that waits for its next task holds no segments


def token_pieces(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """One row per piece of at most ``capacity`` ids; ``_deal`` numbers the rows."""
    cut = partial(_cut, path=path, capacity=capacity, end_id=end_id)
    return docs.select("doc_id", "text").mapInArrow(cut, PIECE_SCHEMA)


# ------------------------------------------------------------------ one group
def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item. Open bins are kept by free room; a bit mask finds the tightest that fits."""
    bins = np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, opened = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            held = by_room[room]
            b = held.pop()
            if not held:
                mask ^= 1 << room
        else:
            room, b = capacity, opened
            opened += 1
        bins[i] = b
        left = room - n
        if left:
            by_room[left].append(b)
            mask |= 1 << left
    return bins


def lower_bound(lengths: np.ndarray, capacity: int, rounds: int = 40) -> int:
    """The best of three families of dual feasible functions, evaluated on the length histogram."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    # thresholding: over capacity - a counts as a whole bin, under a as nothing
    n_upto, s_upto = np.cumsum(count), np.cumsum(count * size)
    a = np.arange(1, capacity // 2 + 1)
    whole = n_upto[capacity] - n_upto[capacity - a]
    weight = s_upto[capacity - a] - s_upto[a - 1]
    best = max(best, int((whole - (-weight // capacity)).max()))
    # rounding: x -> floor((k + 1) x / capacity) / k, multiples of capacity / (k + 1) unchanged
    for k in range(1, rounds + 1):
        scaled = size * (k + 1)
        value = np.where(scaled % capacity == 0, scaled * k, (scaled // capacity) * capacity * (k + 1))
        best = max(best, -(-int((count * value).sum()) // (capacity * k * (k + 1))))
    return best


def _packer(capacity: int, level: int, last: bool):
    def pack_group(key, group):
        return _pack_group(key[0].as_py(), group, capacity, level, last)
    return pack_group


def _pack_group(number: int, group: pa.Table, capacity: int, level: int, last: bool) -> pa.Table:
    group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                           ("ids_crc32", "ascending"), ("_deal", "ascending")])
    lengths = group["length"].to_numpy()
    bins = best_fit_decreasing(lengths, capacity)
    n_bins = int(bins.max()) + 1
    fill = np.bincount(bins, weights=lengths, minlength=n_bins).astype(np.int64)
    gap = n_bins - lower_bound(lengths, capacity)
    released = np.zeros(n_bins, bool)
    if not last:
        fullest = np.argsort(-fill, kind="stable")
        waste = np.cumsum(capacity - fill[fullest])
        # bins past an eighth of a bin of waste, a bounded number; a gap gives up some more to repack with
        given = max(min(int((waste > capacity // 8).sum()), int(np.ceil(LOOSE * np.sqrt(n_bins)))),
                    min(8 * gap, n_bins // 2))
        given = fullest[n_bins - min(given, n_bins):]
        released[given[fill[given] < capacity]] = True
    # offsets: running sum inside each bin
    order = np.argsort(bins, kind="stable")
    before = np.cumsum(lengths[order]) - lengths[order]
    first = np.r_[True, np.diff(bins[order]) > 0]
    offsets = np.empty(len(bins), np.int64)
    offsets[order] = before - np.repeat(before[first], np.diff(np.r_[np.flatnonzero(first), len(bins)]))
    sequence = (np.int64(level) << 56) + (np.int64(number) << 28) + bins
    return pa.table({
        **{c: group[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")},
        "sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(offsets, pa.int64()),
        "_closed": pa.array(~released[bins], pa.bool_()), "_deal": group["_deal"]})


# ------------------------------------------------------------------ rounds
def pack_pieces(pieces: DataFrame, capacity: int = 4096, group_rows: int = 50_000) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), gapless in each sequence."""
    pool, done, level, loose = cut_lineage(pieces), [], 0, None
    n = pool.count()
    while True:
        groups = max(1, -(-n // group_rows))
        last = groups == 1
        dealt = pool.withColumn("_group", F.pmod(F.xxhash64("_deal", F.lit(level)), F.lit(groups)))
        packed = cut_lineage(dealt.groupBy("_group").applyInArrow(_packer(capacity, level, last), PACKED_SCHEMA))
        if last:
            done.append(packed)
            break
        opens = F.col("offset") == 0  # one row of each bin
        r = packed.agg(F.count_if(opens).alias("bins"), F.count_if(opens & ~F.col("_closed")).alias("loose"),
                       F.count_if(~F.col("_closed")).alias("n")).first()
        if loose is not None and r.bins >= loose:
            done.append(pool)  # nothing saved: as the round before had them
            break
        done.append(packed.where("_closed"))
        pool, level, loose, n = packed.where(~F.col("_closed")), level + 1, r.loose, r.n
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("_closed", "_deal")


def pack(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, group_rows: int = 50_000) -> DataFrame:
    return pack_pieces(token_pieces(docs, path, capacity, end_id), capacity, group_rows)


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
