"""A training-corpus pipeline over ``documents``: each stage is a function (spark, docs, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, packing, quality_rules, simhash, suffix_dedup
from tidemark.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the fertility bands reject go."""
    return quality_rules.kept(docs, labels=table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of exact and near copies the document of the smallest id stays."""
    return simhash.deduplicated(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that stand elsewhere before are cut out; n_chars follows."""
    cut = suffix_dedup.deduplicated(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words come from benchmark items to a twentieth or more go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the sequences they are packed in."""
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", passage_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's result is written to the shared folder and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
