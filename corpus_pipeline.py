"""Documents to training records: five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.llm import decontam, mixing, quality, simhash
from tallybridge.llm import queries as Q
from tallybridge.llm.common import all_columns, clear_of, in_fold, stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality votes accept. Null and empty texts score the share of good ones
    among all allowed labelled rows, whatever the size of the input, and stay if that reaches THRESHOLD."""
    score = clear_of(docs, "score")
    scored = quality.score_quality(docs, table(spark, sf_dir, "labels"), allowed=~in_fold("doc_id", 4, 2), score_column=score)
    return scored.filter(F.col(score) >= quality.THRESHOLD).select(*all_columns(docs))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; equal rows are one."""
    return simhash.one_of_each(docs, shingle=3, max_bits=2)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), window=decontam.WINDOW)
    hit_id, hit_hash = clear_of(docs, "hit_id"), clear_of(docs, "hit_hash")
    hit = found.filter("contaminated").select(F.col("doc_id").alias(hit_id), F.col("text_hash").alias(hit_hash)).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(hit_id)) & (F.xxhash64(F.col("text").cast("string")) == F.col(hit_hash))
    return docs.join(stored(hit, "contaminated"), same, "left_anti")


def mixed_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say: those of a domain that is short of its share come
    once or more often, those of a domain that has too much may go."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"), Q.TARGETS, domain=Q.domain())


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records of all that is left, and what reading them back says of each."""
    return Q.token_records(spark, docs)


STAGES = [
    ("quality", good_quality),
    ("near copies", one_of_near_copies),
    ("benchmark", without_benchmark),
    ("mixing", mixed_to_targets),
    ("token records", token_records),
]

# Votes, fingerprints, rates and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
