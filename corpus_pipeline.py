"""The corpus pipeline: five stages from raw documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before kept; its result is
written as Parquet and read again as the next one's input. All but the last keep the columns of
``documents``. Rows without ``doc_id`` go in the first stage, as later stages name documents by it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import language_id, near_duplicates, packing, quality_rules, suffix_dedup
from feedloom.llm.common import table
from feedloom.session import materialise

#: Share of its letters that a document's language must have.
LEAST_SHARE = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that too many texts of their host share."""
    return quality_rules.cleaned(docs.filter("doc_id IS NOT NULL"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of one recognised language, which becomes their ``lang``; learned from the given ones.

    Texts without a letter go, and those in which no language has half of the letters.
    """
    found = language_id.identify(docs).filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE))
    found = found.groupBy(F.col("doc_id").alias("__id")).agg(F.min(F.struct("lang_pred", "score")).alias("__found"))
    return docs.join(found, docs["doc_id"] == F.col("__id")).withColumn("lang", F.col("__found.lang_pred")).select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, the one of smallest id, in one row.

    30 bands of 5 coordinates miss a pair at a similarity of 0.8 with a chance of 7e-6.
    """
    found = near_duplicates.near_duplicates(docs, percent=80, bands=30, rows=5)
    kept = docs.join(found.filter("kept").select(F.col("doc_id").alias("__id")), docs["doc_id"] == F.col("__id"), "left_semi")
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates(["doc_id"])


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages that an earlier one, or an earlier place, holds already."""
    return suffix_dedup.without_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents with their ids, and the sequence and place that each is packed to."""
    return packing.pack_documents(docs, with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("suffix_dedup", repeat_stage),
    ("best_fit_packing", packing_stage),
]

#: Language, similarity search and packing are beyond SQL; the tests compare every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents", "*")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
