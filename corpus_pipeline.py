"""The corpus pipeline: five stages from raw documents to a weighted mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as
Parquet and reads again as the next stage's documents. All stages but the last return the
columns of ``documents``; the last adds ``mix_copies``, how often the mix takes a document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import decontaminate, lines, minhash, mixing, toxicity
from cartwise.llm import text as tx
from cartwise.session import materialize, settled


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that too many documents of a source share go; rejected documents go."""
    return lines.clean(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.7 or more go; learned from this stage's input."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, tx.fold("doc_id", 3) != 1)
    return docs.where(toxicity.toxic_score(model)("text") < 0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id.

    Rows are told apart by where they stand, so that repeated rows and null ids are documents
    like any other: by file and position if ``docs`` is a table as ``run`` reads it, and by
    their number in a written copy if it has no files.
    """
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    try:
        whole = docs.select(every, F.struct("_metadata.file_path", "_metadata.row_index").alias("row"))
    except AnalysisException:
        whole = materialize(docs.select(every, F.monotonically_increasing_id().alias("row")), "rows")
    known = whole.select(
        F.struct(F.col("doc.doc_id").isNull().alias("none"), F.col("doc.doc_id").alias("id"), "row").alias("key"),
        F.col("doc.text").alias("text"),
    )

    def gone() -> DataFrame:
        groups = minhash.near_duplicates(known, size=5, percent=80, id_column="key")
        return groups.where("not kept").select(F.col("key.row").alias("row"))

    kept = whole.join(settled(spark, gone, "gone"), "row", "left_anti")
    return kept.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy or an edited copy of a benchmark item go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix of sources takes, with the number of copies."""
    return mixing.select_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("drop_toxic", drop_toxic),
    ("drop_near_duplicates", drop_near_duplicates),
    ("drop_leaks", drop_leaks),
    ("mix_sources", mix_sources),
]

#: Learned models and hashes decide; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of a folder; only the last stage's table remains."""

    def staged() -> DataFrame:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, stage in STAGES[:-1]:
            docs = settled(spark, lambda: stage(spark, docs, sf_dir), name)
        return STAGES[-1][1](spark, docs, sf_dir)

    return settled(spark, staged, STAGES[-1][0])
