"""The corpus pipeline: quality, near-duplicates, secrets, mixing, packing.

Every stage works on all that the stage before it kept, and its decisions take effect:

1. ``quality_classifier``: rows that the classifier rejects go.
2. ``simhash_near_dedup``: of each near-duplicate group one row stays.
3. ``secret_scan``: reported spans are replaced in the text; every row stays.
4. ``source_mixing``: rows are repeated, kept or left out so that each source meets its target.
5. ``best_fit_packing``: the rows' token pieces get a sequence and an offset.

All but the last return the columns of their input. ``run`` writes every stage's result as
Parquet into the shared folder of ``spark.checkpoint.dir`` and reads it again for the next,
so a lost executor costs one stage's work at most. Empty tables, null and repeated rows and
extra columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from logweave.llm import credentials, mixing, packing, quality, simhash
from logweave.llm.common import table
from logweave.session import ensure_checkpoint_dir

TOKENIZER = "word_bpe_49k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return credentials.hide_secrets(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: No SQL form: trees, fingerprints and tokenizer ids are beyond it; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
