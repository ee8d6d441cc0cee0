"""The thin opN_ queries: each applies its operator to the whole of `documents` and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, conversations, fingerprints, licenses, media, near_dups, packing, pii, quality, repeats, token_counts, toxicity
from .common import documents
from .labelled import scored, verdict

Query = Callable[[SparkSession, str], DataFrame]


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(documents(spark, sf_dir))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_texts(documents(spark, sf_dir), *bpe.default_vocabulary())


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", F.size("spans").cast("long").alias("n_spans"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_texts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edit: 40 code points from a third of the text on become its last 20."""
    trees = token_counts.build_trees(documents(spark, sf_dir), *bpe.default_vocabulary())
    third = F.floor(F.char_length("text") / 3)
    edits = trees.withColumns({"lo": third, "hi": third + 40, "new": F.expr("right(text, 20)")})
    return token_counts.edit_trees(edits, *bpe.default_vocabulary(), trees=False)


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.read_media(media.store_texts(documents(spark, sf_dir)))


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.near_duplicates(documents(spark, sf_dir), size=2, threshold=0.8)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return verdict(scored(docs, quality.fit_quality(docs, labels)), 0.3)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest_kept(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return verdict(scored(docs, toxicity.fit_toxicity(docs, labels)), 0.5)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_texts(documents(spark, sf_dir), *paths, public_tokenizers.PATTERN)


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.audit_conversations(conversations.damage(talks), dropped="dropped")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest_private(documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    found = [op1_fingerprints, op2_bpe, op3_licenses, op4_packing, op5_token_counts, op6_media, op7_near_dups, op8_quality, op9_repeats, op10_toxicity, op11_alignment, op12_conversations, op13_pii]
    return {f.__name__: f for f in found}
