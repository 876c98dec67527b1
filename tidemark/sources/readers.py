"""Readers: parquet, CSV, JSON lines, labelled text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import LABELS, clean_sentence, sentiment_label, strip
from tidemark.operators.cleaning import require_columns


def parquet(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """A parquet folder or glob; ``merge`` unites files by column name."""
    return spark.read.option("mergeSchema", merge).parquet(path)


def csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV with a header, read with a declared schema."""
    return spark.read.csv(path, header=True, schema=schema)


def portfolio(spark: SparkSession, path: str) -> DataFrame:
    """A user's holdings from parquet (by extension) or CSV; the three columns must be there."""
    if path.lower().rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(path)
    else:
        df = spark.read.csv(path, header=True)
    df = require_columns(df, ["ticker", "shares", "avg_cost"])
    return df.select("ticker", F.col("shares").cast("double").alias("shares"),
                     F.col("avg_cost").cast("double").alias("avg_cost"))


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One file or a folder of shards; lines that do not parse are skipped."""
    return spark.read.json(path, schema=schema, mode="DROPMALFORMED")


def labelled_lines(lines: DataFrame, column: str = "value", source: str = "phrases") -> DataFrame:
    """``text@label`` rows, cut at the last ``@``; an unknown label is neutral."""
    line = strip(F.col(column))
    parts = lines.filter(line.contains("@")).select(
        F.regexp_extract(line, r"(?s)^(.*)@([^@]*)$", 1).alias("text"),
        F.lower(F.trim(F.regexp_extract(line, r"(?s)^(.*)@([^@]*)$", 2))).alias("name"))
    label = F.lit(None).cast("int")
    for word, code in LABELS.items():
        label = F.when(F.col("name") == word, F.lit(code)).otherwise(label)
    return parts.select(clean_sentence(F.col("text")).alias("text"),
                        F.coalesce(label, F.lit(LABELS["neutral"])).alias("label"),
                        F.lit(source).alias("source"))


def text_lines(spark: SparkSession, path: str, source: str = "phrases") -> DataFrame:
    return labelled_lines(spark.read.text(path), source=source)


def labelled_table(df: DataFrame, source: str = "calls") -> DataFrame:
    """Labelled rows whose text and label columns go by one of several names; empty texts go."""
    text = next((c for c in ("transcript", "text", "segment") if c in df.columns), None)
    label = next((c for c in ("sentiment", "label") if c in df.columns), None)
    if text is None:
        raise ValueError("no text column")
    value = F.col(label) if label else F.lit("neutral")
    return df.filter(F.length(text) > 0).select(
        clean_sentence(F.col(text)).alias("text"), sentiment_label(value).alias("label"),
        F.lit(source).alias("source"))
