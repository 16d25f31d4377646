"""Queries of the training-data operators, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import readers
from . import bpe, exact_dedup, mixing, pii, quality, simhash, sql, substring_dedup, suffix_dedup, token_counts, url_filters


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir), shingle=3, distance=2, similarity=None)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(_documents(spark, sf_dir))


#: The rules of op3.
URL_RULES = [url_filters.Rule("net/", "block"), url_filters.Rule("example.net/en/", "allow"), url_filters.Rule("example.com/de/", "block"), url_filters.Rule("org/fr/", "allow")]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judged(readers.spread(spark.read.parquet(f"{sf_dir}/pages.parquet")), URL_RULES)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_documents(spark, sf_dir))


def vocabulary() -> str:
    """The vocabulary file of op6, as the installed package of public tokenizers places it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(_documents(spark, sf_dir), vocabulary())


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_documents(spark, sf_dir))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    import public_tokenizers

    return token_counts.by_lines(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(_documents(spark, sf_dir))


def queries() -> dict:
    return {f.__name__: f for f in (op1_simhash, op2_substring_dedup, op3_url_filters, op4_quality_rules, op5_mixing, op6_bpe, op7_pii, op8_exact_dedup, op9_token_counts, op10_suffix_dedup)}


def oracle_sql() -> dict:
    return {"op5_mixing": sql.MIXING, "op8_exact_dedup": sql.EXACT_DEDUP}
