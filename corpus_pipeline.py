"""The corpus pipeline: quality rules, near duplicates, repeated passages, source mix, token ids.

Each stage works on all rows of the stage before. ``run`` writes what a stage keeps to the shared folder and reads it
again, so a lost executor costs no more than a stage.

Every stage takes null or empty texts (no words: the base rules reject them), null ids (never a copy of another row),
rows that repeat an id (rows of their own unless id and text agree; those are treated alike), ties as its operator states,
texts of any length, and an empty table (no rows). Columns beside those of documents pass through the first four stages,
whatever their names.
"""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import bpe, jaccard_join, mixing, quality_rules, substring_dedup
from daybook.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or meet a learned rule go."""
    return quality_rules.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a similarity of 0.8 over five-word shingles, the smallest id stays."""
    return jaccard_join.without_near_copies(docs, shingle=5, num=80, den=100)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier document (or earlier in the same) are cut out; n_chars follows the text."""
    rows, spans = substring_dedup.without_repeats(docs)
    n_chars = F.when(F.size(spans) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return rows.withColumn("n_chars", n_chars).select(*[F.col(f"`{c}`") for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: rows repeat up to three times, or go."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with digests of the ids and of the decoded text."""
    return bpe.encoded(docs.select("doc_id", "source", "text"), "text", public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("mixing", source_mix),
    ("bpe", token_ids),
]

# Learned rules, rolling hashes and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(lambda docs, stage: staged(stage[1](spark, docs, sf_dir), f"pipeline-{stage[0]}"), STAGES, table(spark, sf_dir, "documents"))
