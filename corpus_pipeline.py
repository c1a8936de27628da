"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; a runner
may write it as Parquet and hand what it reads back to the next stage. All but
the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textkiln.llm import line_dedup, mixing, neardup, packing, quality_rules


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the cascade reject go."""
    return quality_rules.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them only."""
    return line_dedup.dedup_lines(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, 0.8)."""
    return neardup.keep_one(docs, words=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated as the mixture says; no document is lost."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, placed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules_stage),
    ("line dedup", line_dedup_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: Union-find and packing have no SQL form; tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows kept before the next."""
    from textkiln.llm.frames import reliable

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = reliable(docs)
    return docs
