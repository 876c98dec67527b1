"""Unions and comparisons of row sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cleaning import new_york_hours
from tidemark.operators.ranking import keep_first


def corporate_actions(dividends: DataFrame, splits: DataFrame) -> DataFrame:
    cash = dividends.select(F.lit("dividend").alias("action_type"), "ticker", "event_date", "cash_amount")
    cuts = splits.select(F.lit("split").alias("action_type"), "ticker", "event_date", "split_from", "split_to")
    return cash.unionByName(cuts, allowMissingColumns=True)


def tickers_with_actions(dividends: DataFrame, splits: DataFrame) -> DataFrame:
    return dividends.select("ticker").union(splits.select("ticker")).distinct()


def combine_calendars(historic: DataFrame, future: DataFrame) -> DataFrame:
    """One row per exchange and date, the historic one where both have it."""
    ranked = historic.withColumn("priority_", F.lit(0)).unionByName(
        future.withColumn("priority_", F.lit(1)), allowMissingColumns=True)
    return new_york_hours(keep_first(ranked, ["exchange", "date"], ["priority_"]).drop("priority_"))


def row_counts(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(*sorted(df.columns)).agg(F.count(F.lit(1)).alias(name))


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: are both multisets equal (column order aside), and do they share a row."""
    if set(left.columns) != set(right.columns):
        return left.sparkSession.range(1).select(F.lit(False).alias("equal"), F.lit(False).alias("overlap"))
    cols = sorted(left.columns)
    # A tagged union counts each distinct row once per side, so NULLs compare equal and copies combine early.
    both = left.select(*cols, F.lit(1).alias("l_"), F.lit(0).alias("r_")).unionByName(
        right.select(*cols, F.lit(0).alias("l_"), F.lit(1).alias("r_")))
    counts = both.groupBy(*cols).agg(F.sum("l_").alias("l_"), F.sum("r_").alias("r_"))
    return counts.agg(
        F.coalesce(F.bool_and(F.col("l_") == F.col("r_")), F.lit(True)).alias("equal"),
        F.coalesce(F.bool_or((F.col("l_") > 0) & (F.col("r_") > 0)), F.lit(False)).alias("overlap"))
