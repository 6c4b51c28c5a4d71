"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as a Parquet table in the shared folder and rereads it as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statlens.llm import decontaminate, exact_dedup, language_id, packing, simhash_dedup
from statlens.llm.common import read_table, staged
from statlens.llm.queries import page_document


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go."""
    web = language_id.web_evidence(read_table(spark, sf_dir, "pages"), page_document())
    return language_id.drop_unidentified(spark, docs, web)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays."""
    return exact_dedup.drop_exact_duplicates(spark, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts joined by SimHash links, the row with the smallest id stays."""
    return simhash_dedup.drop_near_duplicates(spark, docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go."""
    return decontaminate.drop_contaminated(spark, docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces and their places in sequences."""
    return packing.packed_documents(spark, docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontaminate", decontaminated),
    ("best_fit_packing", packed),
]

#: SQL cannot express the stages; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
