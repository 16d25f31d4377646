"""Pipeline over documents: quality rules, exact dedup, near-dedup, mixing of sources, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns what goes on; all but the last return the columns of documents. ``run`` writes each
stage's rows to the shared folder and reads them again for the next, so that a lost executor repeats one stage at most; what a stage
leaves there otherwise, and the rows of the stage before, are deleted. Empty tables pass through all stages; columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import bpe, exact_dedup, mixing, quality, simhash
from corpusmill.llm.queries import vocabulary
from corpusmill.llm.shared import dropped, scratch, staged
from corpusmill.sources.readers import spread


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the base rules nor a rule learned from ``labels``. Null, empty and blank texts go; rows without an id are judged by their text."""
    return quality.kept_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the longest, then of smallest id, null ids last; of rows with one id and one text, one."""
    return exact_dedup.first_copies(docs)


def far_apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of smallest id: fingerprints within two bits, or sets of five-word shingles of a similarity of 0.8 or more.

    Documents without an id stay; of documents that share an id, all stay or go.
    """
    return simhash.representatives(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once for each time round; where a block ends within a document, the words taken of it. A null source is a source."""
    return mixing.taken_rows(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the decoded text for each row."""
    return bpe.encoded(docs, vocabulary())


STAGES = [("quality_rules", good_quality), ("exact_dedup", first_copies), ("simhash_dedup", far_apart), ("source_mix", source_mix), ("bpe", encoded)]

#: XXH64 fingerprints, BPE merges and a learned list have no SQL form; each stage is tested against brute force on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for name, stage in STAGES[:-1]:
        with scratch() as tables:
            after = tables.keep(staged(stage(spark, docs, sf_dir), name))
        dropped(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}


