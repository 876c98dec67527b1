"""Metrics the request contract names without defining: textbook definitions, per ticker, by date."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.numbers import growth, ratio
from tidemark.functions.staging import landed
from tidemark.operators import bars, comovement, joins, series
from tidemark.operators.filters import between, for_tickers
from tidemark.operators.ranking import top
from tidemark.plans import metrics, views
from tidemark.plans.metrics import Assets, Tables

TRADING_DAYS = 252


def _prices(t: Tables, assets: Assets = None) -> DataFrame:
    return for_tickers(t.prices_daily, assets, t.portfolio)


def _returns(t: Tables, assets: Assets = None) -> DataFrame:
    return series.daily_returns(_prices(t, assets))


def bar_return(t: Tables, unit: str, assets: Assets = None) -> DataFrame:
    closes = bars.period_bars(_prices(t, assets), unit)
    prev = F.lag("close").over(series.by_date(day=unit))
    return closes.select("ticker", F.col(unit).alias("date"), growth(F.col("close"), prev).alias(f"{unit}ly_return"))


def cumulative_return(t: Tables, assets: Assets = None) -> DataFrame:
    rows = series.first_last_close(_prices(t, assets))
    return rows.select("ticker", "date", growth(F.col("close"), F.col("first_close")).alias("cumulative_return"))


def rolling(t: Tables, aggregate: str, name: str, size: int = 30, unit: str = "trading_days",
            assets: Assets = None) -> DataFrame:
    rows = _prices(t, assets).select("ticker", "date", "close")
    return series.windowed(rows, aggregate, "close", size, unit, name).select("ticker", "date", name)


def zscore(t: Tables, size: int = 30, assets: Assets = None) -> DataFrame:
    rows = _prices(t, assets).select("ticker", "date", "close")
    w = series.last_rows(size - 1)
    score = ratio(F.col("close") - F.avg("close").over(w), F.stddev_samp("close").over(w))
    return rows.select("ticker", "date", score.alias("zscore"))


def ema(t: Tables, size: int = 30, assets: Assets = None) -> DataFrame:
    """Recursive exponential mean with weight 2 / (size + 1).

    The recursion needs a ticker's series in order; one group is at most one row per calendar day.
    """
    alpha = 2.0 / (size + 1)

    def smooth(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date")
        return pdf.assign(ema=pdf["close"].ewm(alpha=alpha, adjust=False).mean())[["ticker", "date", "ema"]]

    rows = _prices(t, assets).select("ticker", "date", "close")
    return rows.groupBy("ticker").applyInPandas(smooth, "ticker string, date date, ema double")


def drawdown(t: Tables, assets: Assets = None) -> DataFrame:
    rows = _prices(t, assets)
    peak = F.max("close").over(series.so_far())
    return rows.select("ticker", "date", growth(F.col("close"), peak).alias("drawdown"))


def max_drawdown(t: Tables, assets: Assets = None) -> DataFrame:
    return drawdown(t, assets).groupBy("ticker").agg(F.min("drawdown").alias("max_drawdown"))


def return_statistics(t: Tables, assets: Assets = None) -> DataFrame:
    """Variance, annualised volatility, Sharpe and Sortino ratios in one aggregation."""
    ret = F.col("ret")
    down = F.sqrt(F.avg(F.when(ret.isNotNull(), F.pow(F.least(ret, F.lit(0.0)), F.lit(2)))))
    return _returns(t, assets).groupBy("ticker").agg(
        F.var_samp(ret).alias("variance"),
        (F.stddev_samp(ret) * math.sqrt(TRADING_DAYS)).alias("volatility_annualized"),
        ratio(F.avg(ret), F.stddev_samp(ret)).alias("sharpe_ratio"),
        ratio(F.avg(ret), down).alias("sortino_ratio"))


def _statistic(name: str):
    return lambda t, assets=None: return_statistics(t, assets).select("ticker", name)


def benchmark_statistics(t: Tables, benchmark: str | None = None, assets: Assets = None) -> DataFrame:
    rets = _returns(t)
    return comovement.against(for_tickers(rets, assets, t.portfolio), comovement.benchmark_returns(rets, benchmark))


def _against(name: str, column: str | None = None):
    return lambda t, benchmark=None, assets=None: benchmark_statistics(t, benchmark, assets).select(
        "ticker", F.col(column or name).alias(name))


def correlation_matrix(t: Tables, assets: Assets = None) -> DataFrame:
    return comovement.correlation_matrix(_returns(t, assets))


def pair_statistics(t: Tables, assets: Assets = None) -> DataFrame:
    return comovement.pair_statistics(_returns(t, assets))


def price_moves(t: Tables, assets: Assets = None) -> DataFrame:
    """Change, percent change and the day's high - low."""
    prev = F.lag("close").over(series.by_date())
    return _prices(t, assets).select(
        "ticker", "date", (F.col("close") - prev).alias("price_change"),
        (growth(F.col("close"), prev) * 100).alias("percent_change"),
        (F.col("high") - F.col("low")).alias("spread"))


def _move(name: str):
    return lambda t, assets=None: price_moves(t, assets).select("ticker", "date", name)


def portfolio_summary(t: Tables) -> DataFrame:
    """Total value, cost, profit and return of the holdings."""
    held = metrics.portfolio_value(t)
    cost = F.sum(F.col("shares") * F.col("avg_cost"))
    return held.agg(F.sum("market_value").alias("market_value"), cost.alias("cost"),
                    F.sum("unrealized_pnl").alias("portfolio_pnl"),
                    ratio(F.sum("unrealized_pnl"), cost).alias("portfolio_return"))


def portfolio_income(t: Tables) -> DataFrame:
    """Profit with dividend cash received on today's holdings included."""
    cash = t.dividends.groupBy("ticker").agg(F.sum("cash_amount").alias("per_share"))
    held = metrics.portfolio_value(t).join(cash, "ticker", "left")
    received = F.col("shares") * F.coalesce("per_share", F.lit(0.0))
    return held.agg(F.sum("unrealized_pnl").alias("portfolio_pnl"), F.sum(received).alias("cash_flows"),
                    F.sum(F.col("unrealized_pnl") + received).alias("pnl_with_cash_flows"))


def weights(t: Tables) -> DataFrame:
    """Share of each holding in the portfolio's market value."""
    held = metrics.portfolio_value(t).select("ticker", "market_value")
    total = metrics.portfolio_value(t).agg(F.sum("market_value")).scalar()
    return held.select("ticker", ratio(F.col("market_value"), total).alias("weight"))


def weighted_returns(t: Tables) -> DataFrame:
    """date, ticker, ret, weight and the portfolio's return of that date.

    Bars and holdings are read once and landed with each bar's return and its holding's value; the weights need the total of
    these values. A date's window holds one row per holding."""
    last = F.max_by("close", "date").over(W.partitionBy("ticker"))
    bars = t.prices_daily.select(
        "ticker", "date", growth(F.col("close"), F.lag("close").over(series.by_date())).alias("ret"), last.alias("last"),
        (F.row_number().over(series.by_date()) == 1).alias("once"))
    held = landed(bars.join(t.portfolio, "ticker").select(
        "date", "ticker", "ret", (F.col("shares") * F.col("last")).alias("market_value"), "once"), "held")
    total = held.filter("once").agg(F.sum("market_value").alias("total")).first()["total"]  # one number
    rows = held.filter("ret is not null").select("date", "ticker", "ret", ratio(F.col("market_value"), F.lit(total)).alias("weight"))
    return rows.withColumn("port", F.sum(F.col("weight") * F.col("ret")).over(W.partitionBy("date")))


def portfolio_volatility(t: Tables) -> DataFrame:
    daily = weighted_returns(t).groupBy("date").agg(F.first("port").alias("port"))
    return daily.agg(F.stddev_samp("port").alias("portfolio_volatility"))


def contribution_to_return(t: Tables) -> DataFrame:
    """Weight times the ticker's return over its whole history."""
    own = _prices(t).groupBy("ticker").agg(
        growth(F.max_by("close", "date"), F.min_by("close", "date")).alias("ret"))
    return weights(t).join(own, "ticker").select(
        "ticker", "weight", (F.col("weight") * F.col("ret")).alias("contribution_to_return"))


def contribution_to_risk(t: Tables) -> DataFrame:
    """Weight times covariance with the portfolio, over the portfolio's variance (on the ticker's dates)."""
    return weighted_returns(t).groupBy("ticker").agg(
        ratio(F.max("weight") * F.covar_samp("ret", "port"), F.var_samp("port")).alias("contribution_to_risk"))


def calendar_filtered(t: Tables, only_open_days: bool = False, exclude_holidays: bool = False,
                      exchange: str | None = None) -> DataFrame:
    """Bars on open days; or bars without the weekdays an exchange was closed."""
    rows = t.prices_daily
    if only_open_days:
        rows = joins.on_open_days(rows, t.trading_calendar, exchange)
    if exclude_holidays:
        closed = t.trading_calendar.filter(~F.col("is_open") & (F.weekday("date") < 5))
        if exchange:
            closed = closed.filter(F.col("exchange") == exchange)
        rows = rows.join(closed.select("date"), "date", "left_anti")
    return rows


def close_series(t: Tables, assets: Assets = None, adjust_for_splits: bool = False,
                 adjust_for_dividends: bool = False, benchmark: str | None = None,
                 percent_format: bool = False) -> DataFrame:
    """ticker, date, value under a request's options.

    With adjustments the value is the price (plus dividend cash so far); ``percent_format`` turns it into
    percent growth since the first bar; a benchmark's series is added under its own ticker.
    """
    rows = _prices(t, assets).select("ticker", "date", "close")
    if benchmark:
        rows = rows.unionByName(t.prices_daily.filter(F.col("ticker") == benchmark.upper())
                                .select("ticker", "date", "close")).distinct()
    value = F.col("close")
    if adjust_for_splits:
        rows = views.adjusted_prices_splits_exact(rows, t.splits).select(
            "ticker", "date", F.col("close_adj_splits_exact").alias("close"))
    if adjust_for_dividends:
        rows = joins.with_dividends(rows, t.dividends)
        value = value + F.sum("cash_amount").over(series.so_far())
    rows = rows.select("ticker", "date", value.alias("value"))
    if percent_format:
        first = F.first("value").over(series.so_far())
        rows = rows.select("ticker", "date", (growth(F.col("value"), first) * 100).alias("value"))
    return rows


def ranked_assets(t: Tables, name: str, k: int, descending: bool = True, threshold: float | None = None,
                  universe: DataFrame | None = None, **args) -> DataFrame:
    """rank_assets and screen_universe: the k best tickers by a one-row-per-ticker metric."""
    rows = metrics.metric(name, t, **args)
    column = [c for c in rows.columns if c not in ("ticker", "date", "as_of_date")][0]
    rows = rows.filter(F.col(column).isNotNull())
    if threshold is not None:
        rows = rows.filter(F.col(column) >= threshold if descending else F.col(column) <= threshold)
    if universe is not None:
        rows = rows.join(universe.select("ticker"), "ticker", "left_semi")
    return top(rows.select("ticker", F.col(column).alias("value")), "value", k, ["ticker"], descending)


def compare_assets(t: Tables, start, end, assets: Assets = None, benchmark: str | None = None) -> DataFrame:
    """Return over a range per ticker, its volatility, and the difference to the benchmark's return."""
    ends = metrics.period_return(t, assets, start, end, exact=True).select("ticker", "period_return")
    rets = between(_returns(t, assets), start, end)
    risk = rets.groupBy("ticker").agg(F.stddev_samp("ret").alias("volatility"))
    out = ends.join(risk, "ticker")
    if benchmark:
        bench = metrics.period_return(t, [benchmark], start, end, exact=True).select("period_return").scalar()
        out = out.withColumn("excess_return", F.col("period_return") - bench)
    return out


DECLARED = {
    "weekly_return": lambda t, assets=None: bar_return(t, "week", assets),
    "monthly_return": lambda t, assets=None: bar_return(t, "month", assets),
    "cumulative_return": cumulative_return,
    "rolling_std": lambda t, **a: rolling(t, "stddev_samp", "rolling_std", **a),
    "rolling_mean": lambda t, **a: rolling(t, "avg", "rolling_mean", **a),
    "moving_average": lambda t, **a: rolling(t, "avg", "moving_average", **a),
    "ema": ema,
    "zscore": zscore,
    "drawdown": drawdown,
    "max_drawdown": max_drawdown,
    "volatility_annualized": _statistic("volatility_annualized"),
    "variance": _statistic("variance"),
    "sharpe_ratio": _statistic("sharpe_ratio"),
    "sortino_ratio": _statistic("sortino_ratio"),
    "beta": _against("beta"),
    "beta_to_benchmark": _against("beta_to_benchmark", "beta"),
    "alpha": _against("alpha"),
    "tracking_error": _against("tracking_error"),
    "information_ratio": _against("information_ratio"),
    "correlation": lambda t, assets=None: pair_statistics(t, assets).select("a", "b", "correlation"),
    "covariance": lambda t, assets=None: pair_statistics(t, assets).select("a", "b", "covariance"),
    "correlation_matrix": correlation_matrix,
    "dividend_yield": metrics.dividend_yield_ttm,
    "ttm_dividend_yield": metrics.dividend_yield_ttm,
    "price_change": _move("price_change"),
    "percent_change": _move("percent_change"),
    "spread": _move("spread"),
    "portfolio_pnl": lambda t: portfolio_summary(t).select("portfolio_pnl"),
    "portfolio_return": lambda t: portfolio_summary(t).select("portfolio_return"),
    "portfolio_volatility": portfolio_volatility,
    "contribution_to_return": contribution_to_return,
    "contribution_to_risk": contribution_to_risk,
}
