"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import bpe, divergence, exact_dedup, langid, manifest, oracles, packing, quality, secret_scan, simhash, substring_dedup
from salesmart.llm.chat import format_chats
from salesmart.llm.common import importable, table
from salesmart.llm.html_main import extract_main
from salesmart.llm.url_filter import Rule, judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE["op3_exact_dedup"] = oracles.EXACT_DEDUP


@query
def op4_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.harmonic_pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


ORACLE["op10_quality_rules"] = oracles.quality()


URL_RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


ORACLE["op8_url_filter"] = oracles.url_filter(URL_RULES)


@query
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main(table(spark, sf_dir, "pages"))


@query
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.substring_report(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


ORACLE["op11_substring_dedup"] = oracles.SUBSTRING_DEDUP


RECORD = ["doc_id", "source", "lang", "n_chars", "text"]


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", oracles.UPPER, oracles.UPPER.lower())
    tampered = manifest.record_digest([lowered if c == "text" else F.col(c) for c in RECORD])
    given = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, tampered)
    return manifest.manifest_audit(table(spark, sf_dir, "documents"), RECORD, "doc_id", given)


ORACLE["op12_merkle_manifest"] = oracles.MERKLE_MANIFEST


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


ORACLE["op13_source_divergence"] = oracles.SOURCE_DIVERGENCE
