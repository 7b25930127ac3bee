"""From raw documents to token ids: filter, deduplicate, decontaminate, pseudonymise, encode.

Each stage is written as Parquet to the shared folder and read again, so a lost executor
costs a re-read, and each stage works on all that the one before kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opinara.llm import byte_bpe, decontaminate, order_minhash, pseudonyms, pu_toxicity
from opinara.llm.catalog import PSEUDONYM_KEY
from opinara.session import configure, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity."""
    labels = configure(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return pu_toxicity.drop_toxic(docs, pu_toxicity.train(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    configure(spark)
    return order_minhash.drop_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.decontaminate(docs, configure(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_persons(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values replaced by pseudonyms of their format."""
    configure(spark)
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of ids and decoded text."""
    configure(spark)
    return byte_bpe.encode_documents(
        docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_benchmark),
    ("pseudonyms", hide_persons),
    ("byte_bpe", encode),
]

#: The first stages learn a model and align texts; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
