"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet into the shared folder and reads back for the next one.  All
stages but the last return the columns of the documents they got.  NULLs, empty
texts, repeated rows and empty tables have the results that the operators
define; rows pass with all their columns, whatever these are called.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from freightlake.llm import bpe, decontaminate, line_dedup, minhash, quality  # noqa: E402
from freightlake.llm.common import read_table, stage  # noqa: E402
from freightlake.llm.queries import vocabulary  # noqa: E402
from freightlake.session import apply_conf  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the later places of repeated three-line windows."""
    return line_dedup.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.keep_one(docs, words=5, threshold=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of the text, their number, and digests of ids and of what
    they decode to."""
    return bpe.encode(docs, *vocabulary(), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: SQL cannot express the sketches and the tokeniser; tests compare the stages
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_conf(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
