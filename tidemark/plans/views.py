"""The eight analytic views, each a lazy function of core tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio
from tidemark.operators import bars, joins, series, sets

prices_enriched = joins.enriched
daily_returns = series.daily_returns
corporate_actions = sets.corporate_actions


def daily_returns_open_days(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """Returns between consecutive bars, kept on days the NYSE was open."""
    return joins.on_open_days(daily_returns(prices), calendar, "nyse").select("date", "ticker", "ret")


def prices_weekly(prices: DataFrame) -> DataFrame:
    return bars.period_bars(prices, "week")


def prices_monthly(prices: DataFrame) -> DataFrame:
    return bars.period_bars(prices, "month")


def adjusted_prices_splits(prices: DataFrame, splits: DataFrame) -> DataFrame:
    """Close times the running split factor, as the original view defines it (log10 inside exp)."""
    bars_ = series.cumulative_split_factor(series.split_factors(prices, splits))
    return bars_.select("ticker", "date", "close",
                        (F.col("close") * F.col("cum_adj_factor")).alias("close_adj_splits"), "cum_adj_factor")


def adjusted_prices_splits_exact(prices: DataFrame, splits: DataFrame) -> DataFrame:
    """Close times the product of the factors of later splits: the usual back adjustment."""
    bars_ = series.later_split_factor(series.split_factors(prices, splits))
    return bars_.select("ticker", "date", "close",
                        (F.col("close") * F.col("later_factor")).alias("close_adj_splits_exact"), "later_factor")


def dividend_yield_ttm(prices: DataFrame, dividends: DataFrame) -> DataFrame:
    """Dividend cash of the last 365 days (both ends counted) over close."""
    cash = joins.with_dividends(prices.select("ticker", "date", "close"), dividends)
    summed = series.trailing_sum(cash, "cash_amount", 365, "cash_ttm")
    return summed.select("date", "ticker", "close", "cash_ttm",
                         F.when(F.col("close") > 0, ratio(F.col("cash_ttm"), F.col("close")))
                         .alias("dividend_yield_ttm"))


def register(spark, tables: dict[str, DataFrame]) -> list[str]:
    """Registers core tables and the views they allow as temporary views; returns the names."""
    named = {f"core_{name}": df for name, df in tables.items()}
    prices, tickers = tables["prices_daily"], tables["tickers"]
    dividends, splits, calendar = tables["dividends"], tables["splits"], tables["trading_calendar"]
    named |= {
        "views_prices_enriched": prices_enriched(prices, tickers),
        "views_daily_returns": daily_returns(prices),
        "views_daily_returns_open_days": daily_returns_open_days(prices, calendar),
        "views_prices_weekly": prices_weekly(prices),
        "views_prices_monthly": prices_monthly(prices),
        "views_corporate_actions": corporate_actions(dividends, splits),
        "views_adjusted_prices_splits": adjusted_prices_splits(prices, splits),
        "views_dividend_yield_ttm": dividend_yield_ttm(prices, dividends),
    }
    for name, df in named.items():
        df.createOrReplaceTempView(name)
    return sorted(named)
