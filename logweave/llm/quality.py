"""Quality classifier (operator 1): histogram gradient-boosted trees over document statistics.

A whole text becomes a few dozen numbers (lengths, shares of character classes, entropy,
repetition of words, pairs and lines, function words) in an Arrow function; id, source,
language and labels are no inputs. The trees are fitted on a bounded sample of the
labelled documents (``max_rows``, chosen by hash of the id): only the sample's statistics, a few
MB, reach the driver, where gradients are summed in histograms. The fitted trees are
complete binary trees flattened into three arrays, which the workers walk for all rows
of a batch at once. Texts are never shuffled: the sample's ids are bounded and broadcast.

Defined cases: null text is empty and gets a score like any other text; labels that are
null or of null ids are not learned from; several labels of one id are all learned from;
without labelled rows every score is 0.5, with one class only it is near that class. A null
id is never learned from and counts as held out. An empty table gives an empty result;
other columns are not read (op) or kept (``keep_good``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_crc_mod, table
from .tokens import utf8

FOLDS = 5
THRESHOLD = 0.3

# Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the of and to in a is that it for on was as with be by are this from or an at "
    "der die und das den von zu mit ist im auf für nicht ein eine "
    "le la les de des et un une est que en dans pour qui du "
    "el los las y por con una del se no es").split()
_FUNCTION = tuple({w.encode() for w in FUNCTION_WORDS})

_CLASS = np.zeros(256, np.int64)  # 0 other control
_CLASS[[32]] = 1
_CLASS[[10, 13]] = 2
_CLASS[48:58] = 3
_CLASS[65:91] = 4
_CLASS[97:123] = 5
_CLASS[[ord(c) for c in ".,;:!?"]] = 6
_CLASS[[ord(c) for c in "'\"()-"]] = 7
_CLASS[[ord(c) for c in "#$%&*+/<=>@[]\\^_`{}~"]] = 8
_CLASS[ord("|")] = 9
_CLASS[128:] = 10
N_CLASSES = 11


def statistics(text: bytes) -> list[float]:
    """The document statistics, in a fixed order; all zero where a text has nothing to count."""
    n = len(text)
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    classes = np.bincount(_CLASS, weights=by_byte, minlength=N_CLASSES) / max(n, 1)
    p = by_byte[by_byte > 0] / max(n, 1)
    entropy = float(-(p * np.log2(p)).sum()) if n else 0.0
    words = text.lower().split()
    m = len(words)
    lengths = np.fromiter(map(len, words), np.int64, m)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split(b"\n") if x.strip()]
    line_counts = Counter(lines)
    k = len(lines)
    line_lengths = np.fromiter(map(len, lines), np.int64, k)
    m1, k1 = max(m, 1), max(k, 1)
    starts = text.split()
    return [
        np.log1p(n), np.log1p(m), np.log1p(k), *classes.tolist(), entropy,
        float(lengths.mean()) if m else 0.0, float(lengths.std()) if m else 0.0, float(lengths.max()) if m else 0.0,
        float((lengths >= 12).sum()) / m1, float((lengths <= 2).sum()) / m1,
        len(counts) / m1, max(counts.values(), default=0) / m1, pairs / max(m - 1, 1),
        sum(counts[w] for w in _FUNCTION) / m1,
        sum(w[-1:] in b".!?" for w in words) / m1, sum(w[:1].isupper() for w in starts) / m1,
        sum(not w.isalpha() for w in words) / m1,
        1.0 - len(line_counts) / k1, max(line_counts.values(), default=0) / k1,
        float(line_lengths.mean()) if k else 0.0, float(line_lengths.std()) if k else 0.0,
        float((line_lengths < 30).sum()) / k1,
    ]


def statistics_of(column: pa.Array) -> np.ndarray:
    rows = [statistics(t) for t in utf8(column)]
    return np.array(rows, np.float32).reshape(len(rows), N_STATISTICS)


N_STATISTICS = len(statistics(b""))


# ------------------------------------------------------------------ trees
@dataclass
class Trees:
    """Complete trees of one depth: inner nodes in level order, leaves left to right."""
    base: float
    feature: np.ndarray    # (trees, 2**depth - 1) int
    threshold: np.ndarray  # (trees, 2**depth - 1) float32; right if value > threshold
    leaf: np.ndarray       # (trees, 2**depth) float64

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        depth = (inner + 1).bit_length() - 1
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - inner]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def fit_trees(x: np.ndarray, y: np.ndarray, n_trees: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64,
              l2: float = 1.0, min_rows: int = 10) -> Trees:
    """Boost logistic loss; every split is the best of the summed histograms of its node."""
    n, width = x.shape
    inner, leaves = 2 ** depth - 1, 2 ** depth
    if not n:
        return Trees(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, leaves)))
    rate_of_ones = np.clip(y.mean(), 0.5 / (n + 1), 1 - 0.5 / (n + 1))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32)) for f in range(width)]
    code = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)  # value > e[c-1]
    base = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    margin = np.full(n, base)
    features, thresholds, values = [], [], []
    for _ in range(n_trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, here = 2 ** level - 1, 2 ** level
            best = np.full(here, 1e-6)
            cut = np.full(here, bins)
            at = node - first
            for f in range(width):
                cell = at * bins + code[:, f]
                hist = [np.bincount(cell, w, here * bins).reshape(here, bins) for w in (g, h, None)]
                left = [np.cumsum(a, axis=1)[:, :-1] for a in hist]
                total = [a.sum(axis=1, keepdims=True) for a in hist]
                right = [t - a for t, a in zip(total, left)]
                gain = left[0] ** 2 / (left[1] + l2) + right[0] ** 2 / (right[1] + l2) - total[0] ** 2 / (total[1] + l2)
                gain[(left[2] < min_rows) | (right[2] < min_rows)] = 0.0
                c = gain.argmax(axis=1)
                won = gain[np.arange(here), c]
                for i in np.flatnonzero(won > best):
                    best[i], cut[i] = won[i], c[i]
                    feature[first + i], threshold[first + i] = f, edges[f][c[i]]
            node = 2 * node + 1 + (code[np.arange(n), feature[node]] > cut[at])
        where = node - inner
        leaf = rate * np.bincount(where, g, leaves) / (np.bincount(where, h, leaves) + l2)
        margin += leaf[where]
        features.append(feature)
        thresholds.append(threshold)
        values.append(leaf)
    return Trees(base, np.array(features), np.array(thresholds), np.array(values))


# ------------------------------------------------------------------ on Spark
def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(id_crc_mod(doc_id, FOLDS) == 0, F.lit(True))


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = statistics_of(batch.column(4))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([r.tobytes() for r in x], pa.binary())], ["_order", "_id", "label", "_h", "x"])


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, **how) -> Trees:
    """Fit on at most ``max_rows`` labelled documents that are not held out; equal texts of one id and label count once."""
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select(
        F.col("doc_id").alias("_id"), (F.col("quality") == 1).cast("double").alias("label"),
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).alias("_order"))
    n = usable.count()
    if n > max_rows:
        usable = usable.where(F.col("_order") < int((1 << 30) * 1.1 * max_rows / n)).orderBy("_order", "_id", "label").limit(max_rows)
    texts = docs.select(F.col("doc_id").alias("_id"), "text")
    types = dict(usable.dtypes)
    met = texts.join(F.broadcast(usable), "_id").select("_order", "_id", "label", F.xxhash64("text").alias("_h"), "text").mapInArrow(
        _sample_rows, f"_order bigint, _id {types['_id']}, label double, _h bigint, x binary")
    # an id may stand in many rows: the bound holds for what is collected, not only for the labels
    rows = met.groupBy("_order", "_id", "label", "_h").agg(F.first("x").alias("x")).orderBy("_order", "_id", "label", "_h").limit(max_rows).select("label", "x").toArrow()
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float32).reshape(-1, N_STATISTICS)
    y = rows["label"].to_numpy()
    order = np.lexsort((*x.T, y))  # the same trees in whatever order the rows arrive
    return fit_trees(x[order], y[order], **how)


def _scores(batches: Iterator[pa.RecordBatch], trees: Trees) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p = trees.probability(statistics_of(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], ["doc_id", "score"])


def score_quality(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    scored = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(partial(_scores, trees=trees), "doc_id bigint, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _good(batches: Iterator[pa.RecordBatch], trees: Trees, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p = trees.probability(statistics_of(batch.column(batch.schema.get_field_index("text"))))
        yield batch.filter(pa.array(p >= threshold))


def keep_good(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, all columns kept."""
    return docs.mapInArrow(partial(_good, trees=trees, threshold=threshold), docs.schema)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
