"""Feature operators: position dictionaries, ordinal/one-hot encoding, term weights
(A8, J1, J4, V1-V9).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, OneHotEncoder, Tokenizer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import HASH_RANGE
from .indexing import with_row_id
from .linalg import sparse_vector
from .parsing import tokens

#: Width of hashed term vectors, the class default of the original's estimator.
HASH_WIDTH = 1 << 20
#: A position's part of the dictionary is broadcast up to this many values and bytes; a larger one is joined by shuffle.
BROADCAST_VALUES, BROADCAST_BYTES = 200_000, 16 << 20
#: Up to this many strings of a position are looked up in a literal list, without a join.
LITERAL_VALUES = 32


# --------------------------------------------------------------------------- A8
def category_dictionary(df: DataFrame, col: str = "cats") -> DataFrame:
    """Distinct (position, value) pairs numbered 0.. in (position, value) order."""
    pairs = (df.select(F.posexplode(col).alias("position", "value"))
             .where(F.col("value").isNotNull()).distinct())
    return with_row_id(pairs, ["position", "value"], out="idx").select("position", "value", "idx")


# --------------------------------------------------------------------------- J1/V6
def encode_ordinal(df: DataFrame, dictionary: DataFrame, col: str = "cats", out: str = "features",
                   default: float = 0.0, n_positions: int | None = None,
                   vector: bool = False) -> DataFrame:
    """Replace each category by its dictionary index; unseen -> ``default``.

    The dictionary's values are counted per position first. A few strings are found in a literal list, in the same
    projection; otherwise there is one left join per position: one of few values is broadcast, so that no row is shuffled by
    a column of few values, which would put all rows into as few tasks; one of many values is joined by shuffle, where AQE
    splits a hot value's partition.
    """
    sizes = {r["position"]: (r["n"], r["bytes"] or 0) for r in dictionary.groupBy("position").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col("value").cast("string"))).alias("bytes")).collect()}
    if n_positions is None:
        n_positions = max((p for p in sizes if p is not None), default=-1) + 1
    cur = df
    idx_cols = []
    lists = _literal_lists(dictionary, [p for p, (n, _) in sizes.items() if p is not None and n <= LITERAL_VALUES])
    joined = [i for i in range(n_positions) if i in sizes and i not in lists]
    for i in range(n_positions):
        if i not in joined:
            values, numbers = lists.get(i, ([], []))
            at = F.array_position(F.lit(values), F.get(F.col(col), i)).cast("int") - 1
            idx_cols.append(F.coalesce(F.get(F.lit(numbers), at), F.lit(float(default))) if values else F.lit(float(default)))
            continue
        d = dictionary.where(F.col("position") == i).select(
            F.col("value").alias(f"_v{i}"), F.col("idx").cast("double").alias(f"_i{i}"))
        n, size = sizes.get(i, (0, 0))
        if n <= BROADCAST_VALUES and size <= BROADCAST_BYTES:
            d = F.broadcast(d)
        cur = cur.join(d, F.get(F.col(col), i) == F.col(f"_v{i}"), "left").drop(f"_v{i}")
        idx_cols.append(F.coalesce(F.col(f"_i{i}"), F.lit(float(default))))
    cur = cur.withColumn(out, F.array(*idx_cols)).drop(*[f"_i{i}" for i in joined])
    return cur.withColumn(out, array_to_vector(out)) if vector else cur


def _literal_lists(dictionary: DataFrame, positions: list[int]) -> dict[int, tuple[list[str], list[float]]]:
    """Values and indices of positions whose values are distinct strings that survive the way over the driver."""
    if not positions or dict(dictionary.dtypes)["value"] != "string":
        return {}
    lists: dict[int, tuple[list[str], list[float]]] = {}
    for r in dictionary.where(F.col("position").isin(positions) & F.col("value").isNotNull() & F.col("idx").isNotNull()).collect():
        values, numbers = lists.setdefault(r["position"], ([], []))
        values.append(r["value"])
        numbers.append(float(r["idx"]))
    return {p: x for p, x in lists.items() if len(set(x[0])) == len(x[0]) and not any("\ufffd" in v for v in x[0])}


# --------------------------------------------------------------------------- V7
def encode_one_hot(df: DataFrame, dictionary: DataFrame, col: str = "cats",
                   out: str = "features") -> DataFrame:
    """True one-hot: one block per position, one slot per known value plus one
    trailing slot for values unseen in the dictionary; blocks assembled into one
    sparse vector."""
    # one row per position: first global index and number of values
    sizes = {r["position"]: (r["lo"], r["n"]) for r in dictionary.groupBy("position").agg(
        F.min("idx").alias("lo"), F.count(F.lit(1)).alias("n")).collect()}
    n_positions = max(sizes) + 1
    enc = encode_ordinal(df, dictionary, col, "_ord", default=-1.0, n_positions=n_positions)
    parts = [f"_p{i}" for i in range(n_positions)]
    for i, p in enumerate(parts):
        lo, n = sizes.get(i, (0, 0))
        o = F.col("_ord")[i]
        enc = enc.withColumn(p, F.when(o >= 0, o - F.lit(float(lo))).otherwise(F.lit(float(n))))
    # the encoder learns each block's size from one row holding the largest local index
    size_row = df.sparkSession.createDataFrame(
        [tuple(float(max(sizes.get(i, (0, 1))[1] - 1, 0)) for i in range(n_positions))], parts)
    model = OneHotEncoder(inputCols=parts, outputCols=[p + "_v" for p in parts], dropLast=False,
                          handleInvalid="keep").fit(size_row)
    asm = VectorAssembler(inputCols=[p + "_v" for p in parts], outputCol=out)
    return asm.transform(model.transform(enc)).drop("_ord", *parts, *[p + "_v" for p in parts])


# --------------------------------------------------------------------------- V8
def combine_features(df: DataFrame, cats: str = "cats_idx", nums: str = "nums",
                     out: str = "features", mode: str = "concat") -> DataFrame:
    """Join categorical and numeric arrays (``concat``), or add them position-wise (``add``)."""
    if mode == "concat":
        return df.withColumn(out, F.concat(F.col(cats).cast("array<double>"), F.col(nums).cast("array<double>")))
    if mode == "add":
        return df.withColumn(out, F.zip_with(cats, nums, lambda a, b: F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0))))
    raise ValueError(mode)


# --------------------------------------------------------------------------- tokens
def words(text: str = "text") -> F.Column:
    """The words of ``parsing.tokens`` without the empty ones: what term weights count."""
    return F.filter(tokens(text), lambda w: w != "")


def tokenizer(input_col: str = "text", output_col: str = "words") -> Tokenizer:
    """The estimator whose rule ``parsing.tokens`` states as an expression."""
    return Tokenizer(inputCol=input_col, outputCol=output_col)


# --------------------------------------------------------------------------- V2/V3/V4
def term_freq(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Exact (doc, term, tf) long form. Counts are combined before the shuffle, so an id
    with very many rows (or a null id) is no single task, and no text is shuffled."""
    return (df.select(doc, F.explode(words(text)).alias("term"))
            .groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf")))


def term_dictionary(tf: DataFrame) -> DataFrame:
    """(term, term_index): the distinct terms numbered 0.. in order, whatever their number; no list on the driver."""
    return with_row_id(tf.select("term").distinct(), ["term"], out="term_index").select("term", "term_index")


def count_vectors(tf: DataFrame, terms: DataFrame, doc: str = "doc_id", out: str = "features") -> DataFrame:
    """(row_id, doc, features): a sparse vector of exact counts per document over an indexed vocabulary, terms outside it left out."""
    size = terms.count()
    items = F.collect_list(F.struct(F.col("term_index").cast("int").alias("j"), F.col("tf").cast("double").alias("x")))
    vectors = tf.join(terms, "term").groupBy(doc).agg(items.alias("_e")).select(doc, sparse_vector(F.col("_e"), size).alias(out))
    return with_row_id(vectors, [doc])


def idf_fit(tf: DataFrame, n_docs: int, min_doc_freq: int = 0) -> DataFrame:
    """(term, df, idf) with ``idf = ln((N+1)/(df+1))``; terms under ``min_doc_freq`` get 0.

    ``tf`` has one row per (doc, term), so document frequency is a plain count
    (partial + final aggregation per term). ``n_docs`` counts every document,
    also those without a single token, as Spark's IDF does.
    """
    dfreq = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(F.lit(float(n_docs + 1)) / (F.col("df") + 1))
    return dfreq.select("term", "df",
                        F.when(F.col("df") >= min_doc_freq, idf).otherwise(F.lit(0.0)).alias("idf"))


def idf_apply(tf: DataFrame, model: DataFrame) -> DataFrame:
    """tf-idf weight per (doc, term); a term unseen when fitting gets weight 0."""
    return (tf.join(model.select("term", "idf"), "term", "left")
            .withColumn("tfidf", F.col("tf") * F.coalesce(F.col("idf"), F.lit(0.0))))


# --------------------------------------------------------------------------- J4/F6/D1
def term_scores(tfidf: DataFrame) -> DataFrame:
    """Distinct (term, score) pairs with a positive score."""
    return tfidf.where(F.col("tfidf") > 0).select("term", F.col("tfidf").alias("score")).distinct()


# --------------------------------------------------------------------------- V1/V5/V9
def hashing_tf(df: DataFrame, words_col: str = "words", out: str = "tf",
               num_features: int = HASH_WIDTH) -> DataFrame:
    return HashingTF(inputCol=words_col, outputCol=out, numFeatures=num_features).transform(df)


def term_index(term: str, num_features: int = HASH_WIDTH) -> int:
    return HashingTF(numFeatures=num_features).indexOf(term)


def hash_slot(term: F.Column, num_features: int = HASH_WIDTH) -> F.Column:
    """Hashing-trick slot of a term as a native expression: 60 bits of its md5 modulo the
    width, the same in any SQL engine. It is not the slot ``ml.feature.HashingTF`` picks;
    use ``hashing_tf`` when the slots must line up with an ML pipeline."""
    if num_features > HASH_RANGE:
        raise ValueError("more slots than hash values")
    return F.pmod(F.conv(F.substring(F.md5(term), 1, 15), 16, 10).cast("bigint"), F.lit(num_features))


def hashed_term_freq(df: DataFrame, doc: str = "doc_id", text: str = "text",
                     num_features: int = HASH_WIDTH) -> DataFrame:
    """Hashed TF in long form (doc, slot, tf), slots from ``hash_slot``: a sparse
    term-count vector per document, kept as rows so it can be joined and grouped."""
    return (df.select(doc, F.explode(words(text)).alias("_t"))
            .select(doc, hash_slot(F.col("_t"), num_features).alias("slot"))
            .groupBy(doc, "slot").agg(F.count(F.lit(1)).alias("tf")))


def text_pipeline(text: str = "text", num_features: int = 500_000, min_doc_freq: int = 0,
                  out: str = "features") -> Pipeline:
    """tokenise -> hashed TF -> IDF, fitted on training and reused on test."""
    return Pipeline(stages=[
        tokenizer(text, "_words"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol=out, minDocFreq=min_doc_freq),
    ])


def positions(df: DataFrame, cols: Sequence[str], out: str = "cats") -> DataFrame:
    """Pack categorical columns as one ``array<string>`` (position = column order)."""
    return df.withColumn(out, F.array(*[F.col(c).cast("string") for c in cols]))
