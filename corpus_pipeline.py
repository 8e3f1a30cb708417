"""A training corpus from raw documents: filter, deduplicate twice, redact, pack.

Each stage is an operator of ``salesmart.llm`` over everything the stage before
kept.  ``run`` writes each stage's result as a Parquet table in the shared
folder and reads it back as the next one's input, so a lost executor repeats
part of one stage only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from salesmart.llm.common import importable, land, table
from salesmart.llm.exact_dedup import exact_dedup
from salesmart.llm.packing import harmonic_pack
from salesmart.llm.quality import quality_filter
from salesmart.llm.secret_scan import redact_secrets
from salesmart.llm.simhash import near_dedup

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(fn: Stage) -> Stage:
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        return fn(spark, docs, sf_dir)

    return run_stage


def _length(docs: DataFrame) -> str | None:
    return "n_chars" if "n_chars" in docs.columns else None


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their failing lines.

    Null and empty texts go; texts of any length are judged whole; repeated rows, null ids and further columns stay as
    they are; an empty table stays empty.
    """
    return quality_filter(docs, length_col=_length(docs))


@stage
def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id.

    Null and empty texts are equal; a null id loses to any other; of rows that repeat the kept id one stays; texts of any
    length are digested whole; further columns stay; an empty table stays empty.
    """
    return exact_dedup(docs)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near texts, the one with the smallest id.

    Texts without a word are one component; null ids are chosen last, ties by the order of landing; texts of any length
    are read whole; further columns stay; an empty table stays empty.
    """
    return near_dedup(docs)


@stage
def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts.

    Null, empty and clean texts stay as they are, as do all rows, repeated ones too, and further columns; overlapping
    secrets become one mask; texts of any length are scanned whole; an empty table stays empty.
    """
    return redact_secrets(docs, length_col=_length(docs))


@stage
def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the training sequences.

    A null or empty text is its end id alone; repeated rows are packed as often as they occur, null ids stay null; texts
    of any length are cut into as many pieces as they need; further columns are not read; an empty table gives none.
    """
    return harmonic_pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scan", secret_redaction),
    ("packing", sequence_packing),
]

# Fingerprints, the randomness battery and tokens have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = land(step(spark, docs, sf_dir), name)
    return docs
