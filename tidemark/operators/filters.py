"""Row filters: tickers, holdings, time ranges, generic comparisons."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import month_bounds, within, year_bounds

PORTFOLIO_WORDS = {"my_portfolio", "my_holdings"}


def means_portfolio(assets: Sequence[str]) -> bool:
    return any(a.lower().strip().replace(" ", "_") in PORTFOLIO_WORDS for a in assets)


def for_tickers(df: DataFrame, assets: Sequence[str] | None, portfolio: DataFrame | None = None) -> DataFrame:
    """Rows of the named tickers; "my portfolio" means the holdings; no names means all."""
    if not assets:
        return df
    if means_portfolio(assets):
        return in_portfolio(df, portfolio)
    return df.filter(F.col("ticker").isin([a.upper() for a in assets]))


def in_portfolio(df: DataFrame, portfolio: DataFrame) -> DataFrame:
    return df.join(portfolio.select("ticker"), "ticker", "left_semi")


def in_year(df: DataFrame, year: int, day: str = "date") -> DataFrame:
    return df.filter(within(F.col(day), *year_bounds(year)))


def in_month(df: DataFrame, year: int, month: int, day: str = "date") -> DataFrame:
    return df.filter(within(F.col(day), *month_bounds(year, month)))


def between(df: DataFrame, low: dt.date | None, high: dt.date | None, day: str = "date") -> DataFrame:
    return df.filter(within(F.col(day), low, high))


def compare(field: str, op: str, value: object) -> Column:
    """One declared comparison as a predicate on literals, never as SQL text."""
    col = F.col(field)
    match op.upper():
        case "=":
            return col == value
        case "!=":
            return col != value
        case ">":
            return col > value
        case "<":
            return col < value
        case ">=":
            return col >= value
        case "<=":
            return col <= value
        case "IN":
            return col.isin(list(value))
        case "NOT IN":
            return ~col.isin(list(value))
        case "LIKE":
            return col.like(value)
        case "ILIKE":
            return col.ilike(value)
        case "BETWEEN":
            low, high = value
            return col.between(low, high)
    raise ValueError(f"unknown operator {op!r}")


def apply_filters(df: DataFrame, filters: Sequence[dict]) -> DataFrame:
    tests = [compare(f["field"], f.get("op", "="), f["value"]) for f in filters]
    return df.filter(functools.reduce(lambda a, b: a & b, tests)) if tests else df


def in_universe(df: DataFrame, tickers: DataFrame, sectors: Sequence[str] | None = None,
                industries: Sequence[str] | None = None, exchange: str | None = None) -> DataFrame:
    """Rows whose ticker is in the chosen sectors, industries and exchange."""
    chosen = tickers
    if sectors:
        chosen = chosen.filter(F.col("sector").isin(list(sectors)))
    if industries:
        chosen = chosen.filter(F.col("industry").isin(list(industries)))
    if exchange:
        chosen = chosen.filter(F.upper("exchange") == exchange.upper())
    return df.join(chosen.select("ticker"), "ticker", "left_semi")


def on_day(df: DataFrame, day: dt.date | None, column: str = "date") -> DataFrame:
    """Rows of one day; every day when none is given."""
    return df if day is None else df.filter(F.col(column) == F.lit(day))


def in_sector_list(tickers: DataFrame, sectors: Sequence[str] | None) -> DataFrame:
    return tickers if not sectors else tickers.filter(F.col("sector").isin(list(sectors)))
