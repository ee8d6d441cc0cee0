"""From raw documents to packed training sequences: each stage works on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.llm import near_dups, packing, quality, repeats, toxicity
from tablewarden.llm.common import documents, scratch
from tablewarden.llm.labelled import score_column

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more."""
    return docs.filter(score_column(quality.fit_quality(docs, _labels(spark, sf_dir))) >= 0.3)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5."""
    return docs.filter(score_column(toxicity.fit_toxicity(docs, _labels(spark, sf_dir))) < 0.5)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more): the one of the smallest doc_id."""
    return near_dups.keep_one(docs, size=5, threshold=0.8)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 200 bytes or more that stand more than once; n_chars is counted anew."""
    return repeats.remove_repeats(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece of every document, with its sequence and offset."""
    return packing.pack_texts(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_dups", near_dup_stage),
    ("repeats", repeats_stage),
    ("packing", packing_stage),
]

#: The stages learn, hash and pack: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
