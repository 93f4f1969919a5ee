"""Registered queries of the operators in this package, and the SQL twins that exist."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwise.llm import (
    decontaminate,
    langid,
    license,
    lines,
    minhash,
    mixing,
    periodic,
    ppm,
    quality,
    tokens,
    toxicity,
    warc,
    whiten,
)
from cartwise.llm import text as tx


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(_table(spark, sf_dir, "documents"), tx.fold("doc_id", 7) != 2)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), tx.fold("doc_id", 4) != 2
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), tx.fold("doc_id", 3) != 1
    )


def op4_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_digests(_table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(_table(spark, sf_dir, "documents")).drop("spans")


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=85)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_by_source(_table(spark, sf_dir, "documents"))


def op10_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(_table(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"), tx.fold("doc_id", 5) != 0)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lm_scoring,
        op2_quality_classifier,
        op3_toxicity,
        op4_warc_transactions,
        op5_decontamination,
        op6_license_scan,
        op7_minhash_dedup,
        op8_token_counts,
        op9_source_mixing,
        op10_line_frequency,
        op11_periodic_runs,
        op12_language_id,
        op13_embedding_whitening,
    )
}
ORACLES: dict[str, str] = {
    "op7_minhash_dedup": minhash.ORACLE,
    "op9_source_mixing": mixing.ORACLE,
    "op10_line_frequency": lines.ORACLE,
}
