"""The corpus pipeline: stages over the documents, each written and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegrid.llm import language, minhash, mixing, piece_sampling, quality
from tidegrid.llm.common import new_folder, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned decision list reject go."""
    return quality.keep_clean(docs, table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those whose language the model can't tell."""
    return language.keep_identified(docs, language.learn(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the least id stays."""
    return minhash.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: rows may go, or come twice."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of the mixed documents: doc_id, n_pieces, pieces, lossless."""
    return piece_sampling.sample_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("language_id", language_id), ("near_dedup", near_dedup), ("mix_sources", mix_sources), ("encode", encode),
]

#: Learned models and sampled segmentations have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
