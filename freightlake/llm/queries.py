"""Registered queries of the text operators: each applies one operator, with
its production parameters, to the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlake.llm import (
    align,
    bpe,
    byte_cnn,
    decontaminate,
    laesa,
    licenses,
    line_dedup,
    minhash,
    quality,
    sharding,
    simhash,
    toxicity,
    url_filter,
)
from freightlake.llm.common import read_table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def vocabulary() -> tuple[str, str]:
    """Path of the ranks file and pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir)).drop("text")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each contaminated document and benchmark item."""
    found = decontaminate.matches(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"), shared=None)
    return found.drop("t1", "t2")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir), counts=True)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(documents(spark, sf_dir), words=3, threshold=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_cnn.quality(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), *vocabulary())


def op10_hash_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(documents(spark, sf_dir), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align.align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                       public_tokenizers.path("piece_bpe_32k.model"))


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), words=4, radius=4)


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return laesa.cluster(read_table(spark, sf_dir, "embeddings"), k=40, rounds=5)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_benchmark_decontamination": op2_benchmark_decontamination,
        "op3_line_dedup": op3_line_dedup,
        "op4_license_scan": op4_license_scan,
        "op5_minhash_near_dedup": op5_minhash_near_dedup,
        "op6_toxicity": op6_toxicity,
        "op7_url_filter": op7_url_filter,
        "op8_quality_classifier": op8_quality_classifier,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_hash_ring_shards": op10_hash_ring_shards,
        "op11_tokenizer_alignment": op11_tokenizer_alignment,
        "op12_simhash_near_dedup": op12_simhash_near_dedup,
        "op13_centroid_clustering": op13_centroid_clustering,
        "pipeline": pipeline,
    }


def oracle_queries() -> dict[str, str]:
    return {
        "op1_quality_rules": quality.ORACLE,
        "op3_line_dedup": line_dedup.ORACLE,
        "op4_license_scan": licenses.oracle(),
        "op5_minhash_near_dedup": minhash.ORACLE,
        "op13_centroid_clustering": laesa.oracle(),
    }
