"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. Null texts, repeated rows and empty tables are handled as the
operators of ``visitlens.llm`` say.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm import exact_dedup, language, mixing, near_dups, pieces
from visitlens.llm.common import remainder, table
from visitlens.session import shared_folder


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those far from all of them or without letters go."""
    model = language.fit(docs, remainder(F.col("doc_id"), 4) != 2)
    kept = language.identify(docs, model).where(~F.col("rejected"))
    return kept.select("doc.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts, the one with the largest doc_id."""
    return exact_dedup.keep_one_each(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near-duplicates, the one with the smallest doc_id."""
    return near_dups.keep_one_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, repeated as often as it takes them."""
    return mixing.mix_rows(docs, mixing.quality_weights(table(spark, sf_dir, "labels")))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document of the mix the number and hash of its piece ids, and the hash of their decoded text."""
    return pieces.digest(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("known_language", known_language),
    ("without_copies", without_copies),
    ("without_near_copies", without_near_copies),
    ("mixed", mixed),
    ("tokenized", tokenized),
]

#: Language models and near-duplicates have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/pipeline-{name}-{uuid4()}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
