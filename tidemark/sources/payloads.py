"""Landed API payloads to typed rows: one input row per page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cleaning import dated_dividends, dated_splits, drop_nested, ensure_columns


def _items(pages: DataFrame) -> DataFrame:
    return pages.select("ticker", F.explode("results").alias("item")).select("ticker", "item.*")


def daily_bars(pages: DataFrame) -> DataFrame:
    """results[t, o, h, l, c, v, vw, n] to bars; t is epoch milliseconds, dated in UTC."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("t") / 86_400_000).cast("int"))
    return _items(pages).select(
        day.alias("date"), "ticker", F.col("o").alias("open"), F.col("h").alias("high"), F.col("l").alias("low"),
        F.col("c").alias("close"), F.col("v").alias("volume"), F.col("vw").alias("vwap"), F.col("n").alias("transactions"))


def dividends(pages: DataFrame) -> DataFrame:
    kinds = {"ticker": "str", "declaration_date": "date", "ex_dividend_date": "date", "pay_date": "date",
             "record_date": "date", "cash_amount": "float"}
    return dated_dividends(ensure_columns(drop_nested(_items(pages)), kinds))


def splits(pages: DataFrame) -> DataFrame:
    kinds = {"ticker": "str", "execution_date": "date", "split_from": "float", "split_to": "float"}
    return dated_splits(ensure_columns(drop_nested(_items(pages)), kinds))


def ticker_reference(pages: DataFrame) -> DataFrame:
    """One object per ticker: its scalar fields, under the ticker that was asked for."""
    fields = [f for f in pages.schema["results"].dataType.fieldNames() if f != "ticker"]
    flat = pages.filter(F.col("results").isNotNull()).select("ticker", *[f"results.`{f}`" for f in fields])
    return drop_nested(flat)


def market_status(items: DataFrame, exchanges=("nyse", "nasdaq")) -> DataFrame:
    """Upcoming sessions of the known exchanges; anything but ``closed`` counts as open."""
    exchange = F.lower("exchange")
    return items.filter(exchange.isin(list(exchanges))).select(
        exchange.alias("exchange"),
        F.try_to_date(F.col("date"), "yyyy-MM-dd").alias("date"),
        (F.lower(F.coalesce("status", F.lit(""))) != "closed").alias("is_open"),
        F.try_to_timestamp("open").cast("timestamp_ntz").alias("market_open_utc"),
        F.try_to_timestamp("close").cast("timestamp_ntz").alias("market_close_utc"))
