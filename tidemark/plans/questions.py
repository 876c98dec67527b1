"""The question-level queries: each answers one kind of user question."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio
from tidemark.operators import joins, series
from tidemark.operators.filters import between, for_tickers, in_sector_list, on_day
from tidemark.operators.ranking import top, top_per_group
from tidemark.plans import metrics, views
from tidemark.plans.metrics import Tables

OHLCV = ["open", "high", "low", "close", "volume", "vwap", "transactions"]


def first_day_bar(prices: DataFrame, assets=None) -> DataFrame:
    return joins.edge_bars(for_tickers(prices, assets), "first", OHLCV)


def latest_close_volume(prices: DataFrame, assets=None) -> DataFrame:
    return joins.edge_bars(for_tickers(prices, assets), "last", ["close", "volume"])


def window_returns(prices: DataFrame, rows=(7, 30), assets=None) -> DataFrame:
    return series.lagged_returns(for_tickers(prices, assets), rows)


def sector_day(prices: DataFrame, tickers: DataFrame, sectors=None, day=None) -> DataFrame:
    """Average close and total volume per sector and day."""
    members = in_sector_list(tickers, sectors).select("ticker", "sector")
    return on_day(prices, day).join(members, "ticker").groupBy("sector", "date").agg(
        F.avg("close").alias("avg_close"), F.sum("volume").alias("total_volume"))


def was_open(calendar: DataFrame, exchange: str, day=None) -> DataFrame:
    return on_day(calendar, day).filter(F.col("exchange") == exchange).select("date", "is_open")


def actions_by_date(dividends: DataFrame, splits: DataFrame, assets=None) -> DataFrame:
    return for_tickers(views.corporate_actions(dividends, splits), assets).orderBy("ticker", "event_date")


def top_gainers(prices: DataFrame, day, k: int = 10) -> DataFrame:
    """Lag over the history up to the day, then the day's best returns."""
    rets = series.daily_returns(between(prices, None, day))
    return top(rets.filter(F.col("date") == F.lit(day)), "ret", k, ["ticker"]).select("ticker", "date", "ret")


def top_gainers_each_day(prices: DataFrame, k: int = 10) -> DataFrame:
    rets = series.daily_returns(prices).filter(F.col("ret").isNotNull())
    return top_per_group(rets, ["date"], "ret", k, ["ticker"])


def average_close(prices: DataFrame, start, end, assets=None) -> DataFrame:
    return between(for_tickers(prices, assets), start, end).groupBy("ticker").agg(F.avg("close").alias("avg_close"))


def closes_with_dividends(prices: DataFrame, dividends: DataFrame, start=None, end=None, assets=None) -> DataFrame:
    rows = between(for_tickers(prices, assets), start, end).select("ticker", "date", "close")
    return joins.with_dividends(rows, between(dividends, start, end, "event_date")).select(
        "date", "ticker", "close", "cash_amount")


def closes_with_splits(prices: DataFrame, splits: DataFrame, start=None, end=None, assets=None) -> DataFrame:
    rows = between(for_tickers(prices, assets), start, end).select("ticker", "date", "close")
    return joins.with_split_factor(rows, between(splits, start, end, "event_date")).select(
        "date", "ticker", "close", "split_factor")


def cumulative_ytd(prices: DataFrame, assets=None) -> DataFrame:
    rets = series.daily_returns(for_tickers(prices, assets))
    return series.cumulative_by_year(rets).select("ticker", "date", "cum_ret_ytd")


def sector_members_on(prices: DataFrame, tickers: DataFrame, sectors=None, day=None) -> DataFrame:
    members = in_sector_list(tickers, sectors).select("ticker", "sector")
    return on_day(prices, day).join(members, "ticker").select("date", "sector", "ticker").distinct()


def daily_return_on(prices: DataFrame, day, assets=None) -> DataFrame:
    rets = series.daily_returns(between(for_tickers(prices, assets), None, day))
    return rets.filter(F.col("date") == F.lit(day)).select("ticker", "date", F.col("ret").alias("daily_return"))


def dividend_history(dividends: DataFrame, start=None, end=None, assets=None) -> DataFrame:
    rows = between(for_tickers(dividends, assets), start, end, "ex_dividend_date")
    return rows.select("ticker", "ex_dividend_date", "cash_amount").orderBy("ticker", "ex_dividend_date")


def split_history(splits: DataFrame, start=None, end=None, assets=None) -> DataFrame:
    rows = between(for_tickers(splits, assets), start, end, "event_date")
    return rows.select("ticker", "event_date", ratio(F.col("split_to"), F.col("split_from")).alias("ratio")).orderBy(
        "ticker", "event_date")


def portfolio_total(t: Tables, as_of) -> DataFrame:
    return joins.positions(t.portfolio, t.prices_daily, as_of).agg(F.sum("position_value").alias("portfolio_value"))


def top_positions(t: Tables, as_of, k: int) -> DataFrame:
    return top(joins.positions(t.portfolio, t.prices_daily, as_of), "position_value", k, ["ticker"])


def sector_allocation(t: Tables, as_of) -> DataFrame:
    held = joins.positions(t.portfolio, t.prices_daily, as_of)
    return (held.join(t.tickers.select("ticker", "sector"), "ticker").groupBy("sector")
            .agg(F.sum("position_value").alias("sector_value")).orderBy(F.desc("sector_value"), "sector"))


def latest_price_and_ytd(t: Tables, year: int, assets=None) -> DataFrame:
    rows = for_tickers(t.prices_daily, assets, t.portfolio)
    latest = rows.groupBy("ticker").agg(F.max("date").alias("latest_date"),
                                        F.max_by("close", "date").alias("latest_price"))
    ytd = metrics.ytd_return(t, assets, year).select("ticker", "ytd_return")
    return latest.join(ytd, "ticker", "left")


def dividend_cash(dividends: DataFrame, start=None, end=None, assets=None) -> DataFrame:
    rows = between(for_tickers(dividends, assets), start, end, "event_date")
    return rows.groupBy("ticker").agg(F.sum("cash_amount").alias("div_cash"))

