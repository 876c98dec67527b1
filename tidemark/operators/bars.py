"""Period bars and plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import period_label


def period_bars(prices: DataFrame, unit: str) -> DataFrame:
    """OHLCV per ticker and calendar week (from Monday) or month: one shuffle, combined map-side."""
    period = F.date_trunc(unit, "date").cast("date").alias(unit)
    return prices.groupBy("ticker", period).agg(
        F.min_by("open", "date").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "date").alias("close"),
        F.sum("volume").alias("volume"),
        F.max_by("vwap", "date").alias("vwap"))


def labelled_periods(prices: DataFrame, unit: str, column: str = "close") -> DataFrame:
    """Last value of a column per period label (2024-01 by month, 2024-05 by Monday week)."""
    return prices.groupBy("ticker", period_label(F.col("date"), unit).alias(unit)).agg(
        F.max_by(column, "date").alias("val"))


# The aggregate names a request slot may hold.
AGGREGATES = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}


def slot_aggregate(df: DataFrame, name: str, column: str, by: Sequence[str] = ()) -> DataFrame:
    """One named aggregate over one column; ``none`` projects the column."""
    if name == "none":
        return df.select(*by, column)
    return df.groupBy(*by).agg(AGGREGATES[name](column).alias(f"{name}_{column}"))


def grouped(df: DataFrame, by: Sequence[str], aggregates: dict[str, tuple[str, str]],
            having: Column | None = None) -> DataFrame:
    """group by / aggregate / having of a request: {output: (aggregate, column)}."""
    out = df.groupBy(*by).agg(*[AGGREGATES[a](c).alias(n) for n, (a, c) in aggregates.items()])
    return out.filter(having) if having is not None else out


def date_span(df: DataFrame, day: str = "date") -> DataFrame:
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def shares_of_total(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts per group with the share of all rows."""
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(*by, "n", (F.col("n") / total).alias("share"))


def true_rate(flag: Column) -> Column:
    """Share of true among the non-NULL values."""
    return F.avg(flag.cast("int"))
