"""The implemented metrics: tables and arguments in, (ticker, date, value) rows out.

Period metrics need only the first close of the period and its extremes, so they are one map-side combined
aggregation per ticker, with no window.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions.numbers import best_growth, growth, ratio
from tidemark.operators import joins, series
from tidemark.operators.filters import between, for_tickers, in_month, in_year
from tidemark.plans import views


@dataclass(frozen=True)
class Tables:
    """The core tables a metric may read."""

    prices_daily: DataFrame
    dividends: DataFrame | None = None
    splits: DataFrame | None = None
    tickers: DataFrame | None = None
    portfolio: DataFrame | None = None
    trading_calendar: DataFrame | None = None


# Arguments used when a request gives none.
DEFAULTS = {"year": 2024, "month": 1, "start": dt.date(2024, 1, 1), "end": dt.date(2024, 12, 31), "window": 30}

Assets = Sequence[str] | None


def price_field(t: Tables, field: str, assets: Assets = None, start=None, end=None) -> DataFrame:
    if field not in schema.PRICE_FIELDS:
        raise ValueError(f"{field!r} is not a price field")
    rows = between(for_tickers(t.prices_daily, assets, t.portfolio), start, end)
    return rows.select("ticker", "date", field)


def daily_return(t: Tables, assets: Assets = None, start=None, end=None) -> DataFrame:
    """The date filter follows the lag, so the first day of a range still has its return."""
    rets = series.daily_returns(for_tickers(t.prices_daily, assets, t.portfolio))
    return between(rets, start, end).select("ticker", "date", F.col("ret").alias("daily_return"))


def _first_growth(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("ticker").agg(
        F.max("date").alias("as_of_date"),
        best_growth(F.col("close"), F.min_by("close", "date")).alias(name))


def _end_growth(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("ticker").agg(
        F.max("date").alias("as_of_date"),
        growth(F.max_by("close", "date"), F.min_by("close", "date")).alias(name))


def ytd_return(t: Tables, assets: Assets = None, year: int = DEFAULTS["year"], exact: bool = False) -> DataFrame:
    """Best close of the year over its first close - 1; ``exact`` takes the last close instead."""
    rows = in_year(for_tickers(t.prices_daily, assets, t.portfolio), year)
    return (_end_growth if exact else _first_growth)(rows, "ytd_return")


def mtd_return(t: Tables, assets: Assets = None, year: int = DEFAULTS["year"], month: int = DEFAULTS["month"],
               exact: bool = False) -> DataFrame:
    rows = in_month(for_tickers(t.prices_daily, assets, t.portfolio), year, month)
    return (_end_growth if exact else _first_growth)(rows, "mtd_return")


def period_return(t: Tables, assets: Assets = None, start=DEFAULTS["start"], end=DEFAULTS["end"],
                  exact: bool = False) -> DataFrame:
    rows = between(for_tickers(t.prices_daily, assets, t.portfolio), start, end)
    return (_end_growth if exact else _first_growth)(rows, "period_return")


def range_return(t: Tables, assets: Assets = None, start=DEFAULTS["start"], end=DEFAULTS["end"]) -> DataFrame:
    """Highest over lowest close of the range - 1."""
    rows = between(for_tickers(t.prices_daily, assets, t.portfolio), start, end)
    return rows.groupBy("ticker").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
        growth(F.max("close"), F.min("close")).alias("period_return"))


def dividend_yield_ttm(t: Tables, assets: Assets = None, start=None, end=None) -> DataFrame:
    rows = views.dividend_yield_ttm(for_tickers(t.prices_daily, assets, t.portfolio), t.dividends)
    return between(rows, start, end).select("ticker", "date", "dividend_yield_ttm")


def dividend_amount(t: Tables, assets: Assets = None, start=None, end=None) -> DataFrame:
    rows = for_tickers(t.dividends, assets, t.portfolio).select(
        "ticker", F.col("event_date").alias("date"), F.col("cash_amount").alias("dividend_amount"))
    return between(rows, start, end)


def total_return(t: Tables, assets: Assets = None, start=DEFAULTS["start"], end=DEFAULTS["end"],
                 exact: bool = False) -> DataFrame:
    """(highest close + dividends) over lowest close - 1; ``exact``: last close over first close."""
    rows = between(for_tickers(t.prices_daily, assets, t.portfolio), start, end).select("ticker", "date", "close")
    cash = joins.with_dividends(rows, between(t.dividends, start, end, "event_date"))
    top = F.max_by("close", "date") if exact else F.max("close")
    bottom = F.min_by("close", "date") if exact else F.min("close")
    return cash.groupBy("ticker").agg(
        F.max("date").alias("as_of_date"), growth(top + F.sum("cash_amount"), bottom).alias("total_return"))


def _range_returns(t: Tables, assets: Assets, start, end) -> DataFrame:
    return between(series.daily_returns(for_tickers(t.prices_daily, assets, t.portfolio)), start, end)


def rolling_volatility(t: Tables, assets: Assets = None, start=DEFAULTS["start"], end=DEFAULTS["end"],
                       window: int = DEFAULTS["window"]) -> DataFrame:
    """Population deviation over window + 1 rows within the range."""
    return series.rolling_volatility(_range_returns(t, assets, start, end), window).select(
        "ticker", "date", "rolling_vol")


def rolling_return(t: Tables, assets: Assets = None, start=DEFAULTS["start"], end=DEFAULTS["end"],
                   window: int = DEFAULTS["window"]) -> DataFrame:
    return series.rolling_return(_range_returns(t, assets, start, end), window).select(
        "ticker", "date", "rolling_ret")


def portfolio_value(t: Tables) -> DataFrame:
    held = joins.holdings_at_last_close(t.portfolio, t.prices_daily)
    return held.select("ticker", "shares", "avg_cost", "last_close",
                       (F.col("shares") * F.col("last_close")).alias("market_value"),
                       (F.col("shares") * (F.col("last_close") - F.col("avg_cost"))).alias("unrealized_pnl"))


def _price(field: str):
    def run(t: Tables, **args) -> DataFrame:
        return price_field(t, field, **args)
    return run


METRICS = {name: _price(name) for name in schema.PRICE_FIELDS} | {
    "daily_return": daily_return,
    "ytd_return": ytd_return,
    "mtd_return": mtd_return,
    "period_return": period_return,
    "dividend_yield_ttm": dividend_yield_ttm,
    "dividend_amount": dividend_amount,
    "total_return_price_plus_dividends": total_return,
    "rolling_volatility": rolling_volatility,
    "rolling_return": rolling_return,
    "portfolio_value": portfolio_value,
}


def metric(name: str, tables: Tables, **args) -> DataFrame:
    """A metric by name; an unknown name raises."""
    from tidemark.plans.declared import DECLARED  # the second registry builds on this module
    run = METRICS.get(name) or DECLARED.get(name)
    if run is None:
        raise ValueError(f"unknown metric {name!r}")
    return run(tables, **args)


def sector_average_return(t: Tables, start, end, sector: str | None = None) -> DataFrame:
    """Average daily return per sector over a range; the first bar of the range has none."""
    members = t.tickers.select("ticker", "sector")
    if sector is not None:
        members = members.filter(F.col("sector") == sector)
    rows = between(t.prices_daily, start, end).join(members, "ticker")
    rets = rows.withColumn("ret", ratio(F.col("close"), F.lag("close").over(series.by_date())) - 1)
    return rets.filter(F.col("ret").isNotNull()).groupBy("sector").agg(F.avg("ret").alias("avg_daily_return"))
