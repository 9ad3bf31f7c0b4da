"""Document fingerprints (operator 5): one-permutation MinHash, in DataFrame operations only.

A text's five-word shingles are hashed once; the top bits of a hash choose its bin and
each bin keeps its smallest hash. An empty bin takes the value of a bin chosen by its own
sequence of hashes, the first non-empty one (optimal densification), so equal sets agree in
every bin. Of each value the low four bits are stored, packed into 64-bit words; the share of equal
bins is corrected for the 1/16 of unequal values that agree by chance.

Fingerprints are made row by row from array functions. Pairing a document with its
successor needs no window over all rows: a narrow table of keys is numbered by
range partitions, and only the leading quarter that an edit needs of a text is sent
to the document before it.

Defined cases: null text is empty; texts of one to four words are one shingle; two empty
sets have likeness 1, an empty and a non-empty one 0. Documents follow each other by
id (null first), then by a hash of the text; rows that agree in id and text have the
same successor, the next distinct one; a single document follows itself. An empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.indexing import with_row_id
from ..session import cut_lineage
from .common import GAP, lower_az, table, text_or_empty

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
LOW_BITS = 4
PER_WORD = 64 // LOW_BITS
PROBES = 8


def let(value: Column, body) -> Column:
    """``body`` of ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def shingle_hashes(text: Column, width: int = SHINGLE) -> Column:
    words = F.filter(F.split(lower_az(text), GAP, -1), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - width)
        many = F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))
        few = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(h) >= width, many).otherwise(few)

    return let(hashes, shingles)


def _bin(x: Column) -> Column:
    """0..BINS-1, ascending in the signed order of the hash."""
    return F.shiftright(x, 64 - BIN_BITS).cast("int") + BINS // 2


def bin_values(hashes: Column) -> Column:
    """array of BINS hashes, every bin filled; null for an empty set."""

    def minima(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1))))

    def with_holes(m: Column) -> Column:
        hole = F.lit(None).cast("bigint")
        runs = F.transform(m, lambda x, i: F.concat(
            F.array_repeat(hole, _bin(x) - F.coalesce(_bin(F.get(m, i - 1)), F.lit(-1)) - 1), F.array(x)))
        tail = F.array_repeat(hole, F.lit(BINS - 1) - _bin(F.element_at(m, -1)))
        return F.concat(F.flatten(runs), tail)

    def fill(m: Column) -> Column:
        def densified(d: Column) -> Column:
            def value(x: Column, j: Column) -> Column:
                probes = [F.get(d, F.pmod(F.xxhash64(j, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(PROBES)]
                nearest = F.array_min(F.transform(m, lambda y: F.struct(F.xxhash64(j, _bin(y)).alias("h"), y.alias("y"))))
                return F.coalesce(x, *probes, nearest["y"])
            return F.transform(d, lambda x, j: value(x, j))
        return let(with_holes(m), densified)

    filled = let(let(F.sort_array(hashes), minima), fill)
    return F.when(F.size(hashes) > 0, filled)


def packed_words(values: Column) -> Column:
    """array<bigint> of the low bits of all bins; null for an empty set.

    A value is hashed once more with its bin's number, so that one value copied to many
    bins agrees with another by chance in 1/16 of them and not in all or none.
    """
    def word(v: Column, w: Column) -> Column:
        return F.aggregate(F.slice(v, w * PER_WORD + 1, F.lit(PER_WORD)), F.lit(0).cast("bigint"),
                           lambda acc, x: F.shiftleft(acc, LOW_BITS).bitwiseOR(x.bitwiseAND(F.lit((1 << LOW_BITS) - 1))))
    own = F.transform(values, lambda x, j: F.xxhash64(x, j))
    return let(own, lambda v: F.when(v.isNotNull(), F.transform(
        F.sequence(F.lit(0), F.lit(BINS // PER_WORD - 1)), lambda w: word(v, w))))


def fingerprint_words(text: Column) -> Column:
    return packed_words(let(shingle_hashes(text), bin_values))


def as_hex(words: Column) -> Column:
    """The packed bits as hex, a digit for each bin; all digits ``0`` and a mark for an empty set."""
    digits = F.array_join(F.transform(words, lambda w: F.lpad(F.lower(F.hex(w)), 16, "0")), "")
    return F.coalesce(digits, F.lit("-" + "0" * (BINS - 1)))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two packed fingerprints, corrected for chance agreement."""
    ones = F.lit(0x1111111111111111)

    def unequal(x: Column) -> Column:
        folded = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseOR(
            F.shiftrightunsigned(x, 3))
        return F.bit_count(folded.bitwiseAND(ones))

    n_unequal = F.aggregate(F.zip_with(a, b, lambda x, y: unequal(x.bitwiseXOR(y))), F.lit(0), lambda acc, n: acc + n)
    chance = 1.0 / (1 << LOW_BITS)
    share = 1.0 - n_unequal / F.lit(float(BINS))
    corrected = F.greatest(F.lit(0.0), (share - chance) / (1.0 - chance))
    both_empty = F.when(a.isNull() & b.isNull(), F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(a.isNotNull() & b.isNotNull(), corrected).otherwise(both_empty)


def _keyed(docs: DataFrame) -> DataFrame:
    """(_text, _id, _h): the last two are never null and name a distinct (id, text)."""
    return docs.select("doc_id", text_or_empty().alias("_text")).select(
        "_text", F.coalesce("doc_id", F.lit(0)).alias("_id"), F.xxhash64("_text", F.col("doc_id").isNull()).alias("_h"))


def successors(docs: DataFrame) -> DataFrame:
    """One row per distinct (id, text): its key (_id, _h), whether the id is known, its length _n,
    and its successor's key (_next_id, _next_h)."""
    text = text_or_empty()
    keys = docs.select(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.xxhash64(text, F.col("doc_id").isNull()).alias("_h"),
                       F.col("doc_id").isNotNull().alias("_known"), F.length(text).cast("bigint").alias("_n")).distinct()
    ranked = cut_lineage(with_row_id(keys, ["_known", "_id", "_h"], out="_rank"))
    n = ranked.count()
    after = ranked.select(F.col("_id").alias("_next_id"), F.col("_h").alias("_next_h"),
                          F.pmod(F.col("_rank") - 1, F.lit(max(n, 1))).alias("_rank"))
    return ranked.join(after, "_rank").drop("_rank")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    # texts are dealt out by key once, and read twice: as successors and as documents
    keyed = _keyed(docs)
    pairs = cut_lineage(successors(docs))
    # the successor sends as much of its beginning as the edit replaces
    wanted = pairs.select(F.col("_id").alias("_to_id"), F.col("_h").alias("_to_h"), "_known", F.col("_next_id").alias("_id"),
                          F.col("_next_h").alias("_h"), F.floor(F.col("_n") / 4).cast("int").alias("_k"))
    heads = keyed.join(wanted, ["_id", "_h"]).select(
        F.col("_to_id").alias("_id"), F.col("_to_h").alias("_h"), "_known",
        F.col("_text").substr(F.lit(1), F.col("_k")).alias("_head")).groupBy("_id", "_h").agg(
        F.first("_head").alias("_head"), F.first("_known").alias("_known"))
    n = F.length("_text")
    edited = F.concat(F.col("_text").substr(F.lit(1), n - F.floor(n / 4).cast("int")), F.col("_head"))
    rows = keyed.join(heads, ["_id", "_h"]).select(
        F.when(F.col("_known"), F.col("_id")).alias("doc_id"), "_id", "_h", n.cast("bigint").alias("n_chars"), F.sha2(edited.cast("binary"), 256).alias("edited_sha256"),
        fingerprint_words(F.col("_text")).alias("_words"), fingerprint_words(edited).alias("_edited"))
    rows = cut_lineage(rows)
    by_key = rows.groupBy(F.col("_id").alias("_next_id"), F.col("_h").alias("_next_h")).agg(F.first("_words", ignorenulls=False).alias("_next"))
    joined = rows.join(pairs.drop("_n", "_known"), ["_id", "_h"]).join(by_key, ["_next_id", "_next_h"])
    return joined.select("doc_id", "n_chars", "edited_sha256", as_hex(F.col("_words")).alias("fingerprint"),
                         as_hex(F.col("_edited")).alias("edited_fingerprint"),
                         likeness(F.col("_words"), F.col("_edited")).alias("near_edited"),
                         likeness(F.col("_words"), F.col("_next")).alias("near_next"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
