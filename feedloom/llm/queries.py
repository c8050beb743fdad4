"""The registered queries of the corpus operators and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import language_id, lm_scoring, near_duplicates, neighbours, packing, quality_classifier, quality_rules, ranked_search, sentencepiece_codec, spelling_variants, suffix_dedup, token_files, url_filter
from feedloom.llm.common import documents, remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir, "doc_id", "text"))


@query("op6_line_frequency", quality_rules.ORACLE)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir, "doc_id", "text", "source")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op5_url_filter")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.verdicts(table(spark, sf_dir, "pages", "page_id", "url"))


@query("op7_near_duplicates")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    held_out = remainder("doc_id", 5) == 0
    return language_id.identify(docs, ~held_out).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    held_out = remainder("doc_id", 4) == 2
    found = quality_classifier.classify(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op9_multi_index_hashing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


@query("op3_suffix_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(documents(spark, sf_dir, "doc_id", "text"))


@query("op4_context_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder("doc_id", 10) == 0
    found = lm_scoring.scored(documents(spark, sf_dir, "doc_id", "text"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(documents(spark, sf_dir, "doc_id", "text"))


@query("op11_token_blocks")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op12_ranked_search", ranked_search.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling_variants.variants(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
