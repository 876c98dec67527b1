"""The registered queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (conversation_repair, decontamination, hard_negatives, html_extraction, jaccard_join, license_scan,
                          oracles, packing, quality_classifier, quality_rules, simhash, suffix_dedup, token_output, url_filter)
from tidemark.llm.common import table
from tidemark.session import new_path


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.classes(table(spark, folder, "documents"))


def op2_token_output(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "token-ids")
    token_output.write(table(spark, folder, "documents"), path)
    return token_output.digest(spark, path)


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.extracted(table(spark, folder, "pages"))


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_classifier.scored(docs, quality_classifier.fitted(docs, table(spark, folder, "labels")))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(table(spark, folder, "documents"), labels=table(spark, folder, "labels"))


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, folder, "documents"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scanned(table(spark, folder, "documents"))


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages, labels = table(spark, folder, "pages"), table(spark, folder, "labels")
    judged = url_filter.filtered(pages, url_filter.labelled_outcomes(pages, labels))
    return judged.withColumn("reputation", F.round("reputation", 9))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    seventh = F.col("vec_id") % 7 == 0
    label = F.when(seventh, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.taking_part(table(spark, folder, "embeddings"), label=label)
    return hard_negatives.mined(rows, F.col("id") % 100 == 0)


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.digests(conversation_repair.damaged(table(spark, folder, "conversations")))


def op13_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.joined(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_token_output, op3_html_extraction, op4_quality_classifier, op5_quality_rules,
    op6_best_fit_packing, op7_benchmark_decontamination, op8_suffix_dedup, op9_license_scan, op10_url_filter,
    op11_hard_negatives, op12_conversation_repair, op13_jaccard_join)}
ORACLES = oracles.ORACLES
