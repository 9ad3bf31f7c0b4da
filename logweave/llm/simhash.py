"""SimHash near-duplicates (operator 3): byte-position inverted index with count filtering.

Each text gets a 64-bit fingerprint in one Arrow pass. Fingerprints that differ in at
most d bits agree in at least 8 - d of their 8 positional bytes, so of any d + w positions
they share some w: the index keeps a posting list for every w-subset of the first d + w
positions and its bytes. Pairs of a list are tallied (shared positional bytes), those
below the guaranteed minimum are dropped, and the rest are verified bit by bit. A
pair is tallied in the first list that both share, so no pair is made twice.

A posting list longer than ``list_limit`` makes no pairs. Its members are linked exactly and
in linear work instead: two fingerprints differ in at most two bits if and only if they
meet after at most one flipped bit each, so every member sends itself and its 64 one-bit
variants, and those who meet are joined to the least of them.

Only distinct fingerprints are indexed: copies are one entry. Components come from
``components``; nothing is gathered on the driver.

Defined cases: null text is empty; a text without words has fingerprint zero and is linked
like any other; fewer than three words are one shingle; null ids take part and are never
the least id unless all are null; an empty table gives an empty result. Other columns are
not read (op) or kept (``one_of_each``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..session import cut_lineage
from .components import components
from .common import table
from .tokens import utf8

CHUNK = 1 << 15  # shingles whose bits are counted at once


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of every shingle, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    first, last = starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(first, last)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], width: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8(batch.column(batch.num_columns - 1))
        marks = np.fromiter((fingerprint(t, width, seed) for t in texts), np.uint64, len(texts)).view(np.int64)
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(marks)], [*batch.schema.names[:-1], "_fp"])


def fingerprints(rows: DataFrame, text: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """``rows`` with its column ``text`` replaced by the fingerprint ``_fp`` (a signed long)."""
    names = [c for c in rows.columns if c != text]
    fields = rows.select(*names).schema.add("_fp", LongType())
    return rows.select(*names, F.col(text).cast("string")).mapInArrow(partial(_fingerprints, width=width, seed=seed), fields)


def _byte(x: Column, position: int) -> Column:
    return F.shiftrightunsigned(x, 8 * position).bitwiseAND(F.lit(255))


def _list_key(x: Column, subset: tuple[int, ...]) -> Column:
    mask = sum(255 << (8 * p) for p in subset)
    return x.bitwiseAND(F.lit(mask if mask < 1 << 63 else mask - (1 << 64)))


def links(distinct: DataFrame, max_bits: int = 2, width: int = 4, list_limit: int = 32) -> DataFrame:
    """(u, v) fingerprint links that connect whatever is within ``max_bits`` (1 or 2), transitively."""
    if not 1 <= max_bits <= 2:
        raise ValueError("max_bits is 1 or 2")
    minimum = 8 - max_bits
    subsets = list(combinations(range(max_bits + width), width))
    postings = distinct.select("_fp", F.posexplode(F.array(*[_list_key(F.col("_fp"), s) for s in subsets])).alias("_subset", "_bytes"))
    # a list's length is a sum that combines before the shuffle; its members meet that one row, and a long list's are split
    lengths = postings.groupBy("_subset", "_bytes").agg(F.count("*").alias("_n")).where("_n > 1")
    sized = cut_lineage(postings.join(lengths, ["_subset", "_bytes"]))
    lists = sized.where(F.col("_n") <= list_limit).groupBy("_subset", "_bytes").agg(F.array_sort(F.collect_list("_fp")).alias("_all"))
    pairs = lists.select("_subset", F.posexplode("_all").alias("_i", "u"), "_all").select(
        "_subset", "u", F.explode(F.expr("slice(_all, _i + 2, size(_all))")).alias("v"))
    same = [(_byte(F.col("u"), p) == _byte(F.col("v"), p)) for p in range(8)]
    tally = sum((s.cast("int") for s in same[1:]), same[0].cast("int"))
    # the first list that both are in: no earlier subset agrees in all its positions
    differ = F.col("u").bitwiseXOR(F.col("v"))
    first = F.lit(len(subsets))
    for i in reversed(range(len(subsets))):
        first = F.when(_list_key(differ, subsets[i]) == 0, F.lit(i)).otherwise(first)
    counted = pairs.where(first == F.col("_subset")).withColumn("_shared", tally).where(F.col("_shared") >= minimum)
    verified = counted.where(F.bit_count(differ) <= max_bits).select("u", "v")
    # long lists: meet after at most one flipped bit each
    hot = sized.where(F.col("_n") > list_limit).select("_fp").distinct()
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.col("_fp").bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), b)))
    if max_bits == 1:
        other = hot.select(F.col("_fp").alias("v"))
        return verified.unionByName(hot.select(F.col("_fp").alias("u"), F.explode(flips).alias("v")).join(other, "v").select("u", "v"))
    meet = hot.select("_fp", F.explode(F.concat(F.array("_fp"), flips)).alias("_key"))
    met = meet.groupBy("_key").agg(F.min("_fp").alias("v"), F.max("_fp").alias("_top")).where(F.col("v") != F.col("_top"))
    star = meet.join(met.select("_key", "v"), "_key").where(F.col("_fp") != F.col("v")).select(F.col("_fp").alias("u"), "v")
    return verified.unionByName(star)


def groups(marked: DataFrame, max_bits: int = 2, **how) -> DataFrame:
    """(_fp, _group): every distinct fingerprint and the least fingerprint reachable from it."""
    distinct = cut_lineage(marked.select("_fp").distinct())
    found = components(links(distinct, max_bits, **how))
    return distinct.join(found.select(F.col("u").alias("_fp"), F.col("v").alias("_root")), "_fp", "left").select(
        "_fp", F.coalesce("_root", "_fp").alias("_group"))


def near_duplicates(docs: DataFrame, max_bits: int = 2, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    marked = cut_lineage(fingerprints(docs.select("doc_id", "text"), width=shingle))
    of_mark = cut_lineage(groups(marked, max_bits))
    least = marked.groupBy("_fp").agg(F.min("doc_id").alias("_least"))
    named = of_mark.join(least, "_fp").groupBy("_group").agg(F.min("_least").alias("component_id"))
    by_mark = of_mark.join(named, "_group").select("_fp", "component_id")
    return marked.join(by_mark, "_fp").select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, max_bits: int = 2, shingle: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the least id (null last), then row hash."""
    row = docs.select(F.struct("*").alias("_row")).select(
        "_row", F.coalesce("_row.doc_id", F.lit(0)).alias("_id"),
        F.xxhash64(F.to_json("_row"), F.col("_row.doc_id").isNull()).alias("_h"))
    marked = cut_lineage(fingerprints(row.select("_id", "_h", F.col("_row.doc_id").isNull().alias("_last"),
                                                 F.col("_row.text").alias("text")), width=shingle))
    of_mark = cut_lineage(groups(marked, max_bits))
    best = marked.groupBy("_fp").agg(F.min(F.struct("_last", "_id", "_h")).alias("_best"))
    stay = of_mark.join(best, "_fp").groupBy("_group").agg(F.min("_best").alias("_best")).select("_best._id", "_best._h")
    # rows that agree in every column count once
    return row.join(stay, ["_id", "_h"]).groupBy("_id", "_h").agg(F.first("_row").alias("_row")).select("_row.*")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
