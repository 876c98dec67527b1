"""Implemented and declared metrics over the market tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import comovement, filters, joins, ranking, series
from tidemark.plans import declared, metrics
from tidemark.registry import query
from tidemark.registry.market import rounded, tables
from tidemark.registry.oracle import snap, sql

D = dt.date


def _metric(m, name: str, **args):
    return metrics.metric(name, tables(m), **args)


# --- implemented metrics ---------------------------------------------------------------------------------

for _number, _field in enumerate(["close", "open", "high", "low", "volume", "vwap"], start=1):
    _shown = "round(vwap, 6) vwap" if _field == "vwap" else _field

    @query(f"met{_number}_{_field}", sql(f"""
        select ticker, date, {_shown} from prices_daily where ticker in (select ticker from portfolio)"""))
    def _(m, field=_field):
        df = _metric(m, field, assets=["my_holdings"])
        return rounded(df, 6, "vwap") if field == "vwap" else df


@query("met7_daily_return", sql("""
    select ticker, date, round(ret, 8) daily_return from daily_returns where year(date) = 1998"""))
def _(m):
    return rounded(_metric(m, "daily_return", start=D(1998, 1, 1), end=D(1998, 12, 31)), 8, "daily_return")


@query("met8_ytd_return", sql("""
    select ticker, max(date) as_of_date, round(max(close / first_close - 1), 8) ytd_return from (
      select *, first_value(close) over (partition by ticker order by date rows unbounded preceding) first_close
      from prices_daily where year(date) = 1998) group by 1"""))
def _(m):
    return rounded(_metric(m, "ytd_return", year=1998), 8, "ytd_return")


@query("met8_ytd_return_portfolio", sql("""
    select ticker, max(date) as_of_date, round(max(close / first_close - 1), 8) ytd_return from (
      select *, first_value(close) over (partition by ticker order by date rows unbounded preceding) first_close
      from prices_daily where year(date) = 1999 and ticker in (select ticker from portfolio)) group by 1"""))
def _(m):
    return rounded(_metric(m, "ytd_return", assets=["my_portfolio"], year=1999), 8, "ytd_return")


@query("met8_ytd_return_exact", sql("""
    select ticker, max(date) as_of_date, round(arg_max(close, date) / arg_min(close, date) - 1, 8) ytd_return
    from prices_daily where year(date) = 1998 group by 1"""))
def _(m):
    return rounded(_metric(m, "ytd_return", year=1998, exact=True), 8, "ytd_return")


@query("met9_mtd_return", sql("""
    select ticker, max(date) as_of_date, round(max(close) / arg_min(close, date) - 1, 8) mtd_return
    from prices_daily where year(date) = 1998 and month(date) = 5 group by 1"""))
def _(m):
    return rounded(_metric(m, "mtd_return", year=1998, month=5), 8, "mtd_return")


@query("met9_mtd_return_exact", sql("""
    select ticker, max(date) as_of_date, round(arg_max(close, date) / arg_min(close, date) - 1, 8) mtd_return
    from prices_daily where year(date) = 1998 and month(date) = 5 group by 1"""))
def _(m):
    return rounded(_metric(m, "mtd_return", year=1998, month=5, exact=True), 8, "mtd_return")


@query("met10_period_return", sql("""
    select ticker, max(date) as_of_date, round(max(close) / arg_min(close, date) - 1, 8) period_return
    from prices_daily where date between '1996-02-10' and '2000-08-20' group by 1"""))
def _(m):
    return rounded(_metric(m, "period_return", start=D(1996, 2, 10), end=D(2000, 8, 20)), 8, "period_return")


@query("met10_period_return_exact", sql("""
    select ticker, max(date) as_of_date, round(arg_max(close, date) / arg_min(close, date) - 1, 8) period_return
    from prices_daily where date between '1996-02-10' and '2000-08-20' group by 1"""))
def _(m):
    return rounded(_metric(m, "period_return", start=D(1996, 2, 10), end=D(2000, 8, 20), exact=True), 8, "period_return")


@query("met10b_range_return", sql("""
    select ticker, min(date) start_date, max(date) end_date, round(max(close) / min(close) - 1, 8) period_return
    from prices_daily where date between '1997-01-01' and '1997-06-30' group by 1"""))
def _(m):
    return rounded(metrics.range_return(tables(m), None, D(1997, 1, 1), D(1997, 6, 30)), 8, "period_return")


@query("met11_dividend_yield_ttm", sql("""
    select ticker, date, round(dividend_yield_ttm, 9) dividend_yield_ttm from ttm_yields where year(date) = 1999"""))
def _(m):
    df = _metric(m, "dividend_yield_ttm", start=D(1999, 1, 1), end=D(1999, 12, 31))
    return rounded(df, 9, "dividend_yield_ttm")


@query("met12_dividend_amount", sql("""
    select ticker, event_date as date, cash_amount dividend_amount from dividends where year(event_date) = 1997"""))
def _(m):
    return _metric(m, "dividend_amount", start=D(1997, 1, 1), end=D(1997, 12, 31))


_TOTAL = """
    select ticker, max(date) as_of_date, round(({top} + sum(cash)) / {bottom} - 1, 8) total_return from (
      select p.*, coalesce(d.cash_amount, 0) cash from prices_daily p
      left join dividends d on p.ticker = d.ticker and p.date = d.event_date
      where p.date between '1998-01-01' and '1998-12-31') group by 1"""


@query("met13_total_return", sql(_TOTAL.format(top="max(close)", bottom="min(close)")))
def _(m):
    df = _metric(m, "total_return_price_plus_dividends", start=D(1998, 1, 1), end=D(1998, 12, 31))
    return rounded(df, 8, "total_return")


@query("met13_total_return_exact", sql(_TOTAL.format(top="arg_max(close, date)", bottom="arg_min(close, date)")))
def _(m):
    df = _metric(m, "total_return_price_plus_dividends", start=D(1998, 1, 1), end=D(1998, 12, 31), exact=True)
    return rounded(df, 8, "total_return")


@query("met14_rolling_volatility", sql("""
    select ticker, date, round(stddev_pop(ret) over (partition by ticker order by date
      rows between 30 preceding and current row), 8) rolling_vol
    from daily_returns where date between '1997-01-01' and '1999-12-31'"""))
def _(m):
    return rounded(_metric(m, "rolling_volatility", start=D(1997, 1, 1), end=D(1999, 12, 31)), 8, "rolling_vol")


@query("met15_rolling_return", sql("""
    select ticker, date, round(exp(sum(ln(1 + ret)) over (partition by ticker order by date
      rows between 30 preceding and current row)) - 1, 7) rolling_ret
    from daily_returns where date between '1997-01-01' and '1999-12-31'"""))
def _(m):
    return rounded(_metric(m, "rolling_return", start=D(1997, 1, 1), end=D(1999, 12, 31)), 7, "rolling_ret")


@query("met16_portfolio_value", sql("""
    select ticker, shares, avg_cost, last_close, round(market_value, 4) market_value,
      round(unrealized_pnl, 4) unrealized_pnl from held_values"""))
def _(m):
    return rounded(_metric(m, "portfolio_value"), 4, "market_value", "unrealized_pnl")


# --- declared metrics ------------------------------------------------------------------------------------

for _unit in ("week", "month"):
    @query(f"dec1_{_unit}ly_return", sql(f"""
        select ticker, {_unit} as date,
          round(close / lag(close) over (partition by ticker order by {_unit}) - 1, 8) {_unit}ly_return
        from prices_{_unit}ly"""))
    def _(m, unit=_unit):
        return rounded(_metric(m, f"{unit}ly_return"), 8, f"{unit}ly_return")


@query("dec2_cumulative_return", sql("""
    select ticker, date, round(close / first_value(close) over (partition by ticker order by date) - 1, 8)
      cumulative_return from prices_daily"""))
def _(m):
    return rounded(_metric(m, "cumulative_return"), 8, "cumulative_return")


@query("dec3_rolling_statistics", sql("""
    select ticker, date, round(avg(close) over w, 5) rolling_mean, round(stddev_samp(close) over w, 5) rolling_std,
      round(avg(close) over (partition by ticker order by date rows between 4 preceding and current row), 5) moving_average
    from prices_daily window w as (partition by ticker order by date rows between 29 preceding and current row)"""))
def _(m):
    t = tables(m)
    rows = t.prices_daily.select("ticker", "date", "close")
    rows = series.windowed(rows, "avg", "close", 30, "trading_days", "rolling_mean")
    rows = series.windowed(rows, "stddev_samp", "close", 30, "trading_days", "rolling_std")
    rows = series.windowed(rows, "avg", "close", 5, "trading_days", "moving_average")
    return rounded(rows.drop("close"), 5, "rolling_mean", "rolling_std", "moving_average")


@query("dec4_ema", sql("""
    with numbered as (select ticker, date, close, row_number() over (partition by ticker order by date) rn from prices_daily),
    smooth as (
      select ticker, date, close ema, rn from numbered where rn = 1
      union all
      select n.ticker, n.date, n.close * (2.0::double / 31) + s.ema * (1 - 2.0::double / 31), n.rn
      from smooth s join numbered n on n.ticker = s.ticker and n.rn = s.rn + 1)
    select ticker, date, round(ema, 5) ema from smooth"""))
def _(m):
    return rounded(_metric(m, "ema"), 5, "ema")


@query("dec5_zscore", sql("""
    select ticker, date, round((close - avg(close) over w) / nullif(stddev_samp(close) over w, 0), 6) zscore
    from prices_daily window w as (partition by ticker order by date rows between 29 preceding and current row)"""))
def _(m):
    return rounded(_metric(m, "zscore"), 6, "zscore")


@query("dec6_drawdown", sql("""
    select ticker, date, round(close / max(close) over (partition by ticker order by date) - 1, 8) drawdown
    from prices_daily"""))
def _(m):
    return rounded(_metric(m, "drawdown"), 8, "drawdown")


@query("dec6_max_drawdown", sql("""
    select ticker, round(min(dd), 8) max_drawdown from (
      select ticker, close / max(close) over (partition by ticker order by date) - 1 dd from prices_daily) group by 1"""))
def _(m):
    return rounded(_metric(m, "max_drawdown"), 8, "max_drawdown")


_STATS = """
    select ticker, round(var_samp(ret), 6) variance, round(stddev_samp(ret) * sqrt(252), 6) volatility_annualized,
      round(avg(ret) / stddev_samp(ret), 7) sharpe_ratio,
      round(avg(ret) / sqrt(avg(case when ret is not null then least(ret, 0) * least(ret, 0) end)), 7) sortino_ratio
    from daily_returns group by 1"""


@query("dec7_dec10_return_statistics", sql(_STATS))
def _(m):
    df = declared.return_statistics(tables(m))
    return rounded(rounded(df, 6, "variance", "volatility_annualized"), 7, "sharpe_ratio", "sortino_ratio")


_BENCH = """
    with b as (select date, avg(ret) bench from daily_returns group by 1),
    j as (select ticker, ret, bench from daily_returns join b using (date) where ret is not null and bench is not null)
    select ticker, count(*) as days, {cols} from j group by 1"""


@query("dec8_beta_alpha", sql(_BENCH.format(
    cols="round(regr_slope(ret, bench), 6) beta, round(regr_intercept(ret, bench), 6) alpha")))
def _(m):
    df = declared.benchmark_statistics(tables(m)).select("ticker", "days", "beta", "alpha")
    return rounded(df, 6, "beta", "alpha")


@query("dec8_beta_to_one_ticker", sql("""
    with b as (select date, ret bench from daily_returns where ticker = 'S16'),
    j as (select ticker, ret, bench from daily_returns join b using (date) where ret is not null and bench is not null)
    select ticker, round(case when count(*) > 1 then regr_slope(ret, bench) end, 6) beta_to_benchmark from j group by 1"""))
def _(m):
    return rounded(_metric(m, "beta_to_benchmark", benchmark="s16"), 6, "beta_to_benchmark")


@query("dec9_tracking_error", sql(_BENCH.format(
    cols="round(stddev_samp(ret - bench), 6) tracking_error,"
         " round(avg(ret - bench) / stddev_samp(ret - bench), 6) information_ratio")))
def _(m):
    df = declared.benchmark_statistics(tables(m)).select("ticker", "days", "tracking_error", "information_ratio")
    return rounded(df, 6, "tracking_error", "information_ratio")


_PAIRS = """
    with p as (select x.ticker a, y.ticker b, x.ret ra, y.ret rb from daily_returns x
      join daily_returns y on x.date = y.date and x.ticker < y.ticker where x.ret is not null and y.ret is not null),
    s as (select a, b, count(*) n, corr(ra, rb) correlation, covar_samp(ra, rb) covariance from p group by 1, 2)"""


@query("dec11_pair_statistics", sql(_PAIRS + """
    select a, b, n, round(case when n > 2 then correlation end, 6) correlation,
      round(case when n > 1 then covariance end, 5) covariance from s"""))
def _(m):
    df = declared.pair_statistics(tables(m))
    return df.select("a", "b", "n", F.when(F.col("n") > 2, snap(F.col("correlation"), 6)).alias("correlation"),
                     snap(F.col("covariance"), 5).alias("covariance"))


@query("dec11_correlation_matrix", sql(_PAIRS + """
    select a, b, round(correlation, 6) correlation from s where n > 2
    union all select b, a, round(correlation, 6) from s where n > 2
    union all select distinct ticker, ticker, 1.0::double from daily_returns where ret is not null"""))
def _(m):
    rets = series.daily_returns(m.prices_daily)
    packed = comovement.packed_returns(rets)  # every ticker with a return is in it
    pairs = comovement.pair_statistics(rets, packed=packed).filter(F.col("n") > 2).select("a", "b", "correlation")
    own = packed.select("ticker").distinct().select(
        F.col("ticker").alias("a"), F.col("ticker").alias("b"), F.lit(1.0).alias("correlation"))
    return rounded(comovement.mirrored(pairs).union(own), 6, "correlation")


@query("dec11_close_pairs_of_a_sector", sql(_PAIRS + """
    , t as (select ticker from tickers where sector = 'EUROPE')
    select a, b, n, round(correlation, 6) correlation from s
    where a in (from t) and b in (from t) and n >= 10 and correlation >= 0.0501"""))
def _(m):
    europe = m.tickers.filter(F.col("sector") == "EUROPE")
    df = comovement.pair_statistics(series.daily_returns(m.prices_daily), assets=europe, least=0.0501, least_days=10)
    return rounded(df.select("a", "b", "n", "correlation"), 6, "correlation")


@query("dec12_dividend_yield", sql("""
    select ticker, max(date) as date, round(arg_max(dividend_yield_ttm, date), 9) dividend_yield from ttm_yields group by 1"""))
def _(m):
    rows = _metric(m, "ttm_dividend_yield")
    return rows.groupBy("ticker").agg(F.max("date").alias("date"),
                                      snap(F.max_by("dividend_yield_ttm", "date"), 9).alias("dividend_yield"))


@query("dec13_price_moves", sql("""
    select ticker, date, round(close - lag(close) over w, 6) price_change,
      round((close / lag(close) over w - 1) * 100, 6) percent_change, round(high - low, 6) spread
    from prices_daily window w as (partition by ticker order by date)"""))
def _(m):
    return rounded(declared.price_moves(tables(m)), 6, "price_change", "percent_change", "spread")


@query("dec14_portfolio_pnl", sql("""
    select round(sum(market_value), 3) market_value, round(sum(shares * avg_cost), 3) as cost,
      round(sum(unrealized_pnl), 3) portfolio_pnl,
      round(sum(unrealized_pnl) / sum(shares * avg_cost), 9) portfolio_return from held_values"""))
def _(m):
    df = declared.portfolio_summary(tables(m))
    return rounded(rounded(df, 3, "market_value", "cost", "portfolio_pnl"), 9, "portfolio_return")


_WEIGHTED = """
    with weighted as (select ticker, market_value / (select sum(market_value) from held_values) weight from held_values),
    r as (select ticker, date, ret, weight from daily_returns join weighted using (ticker) where ret is not null),
    p as (select date, sum(weight * ret) port from r group by 1)"""


@query("dec15_portfolio_volatility", sql(_WEIGHTED + " select round(stddev_samp(port), 8) portfolio_volatility from p"))
def _(m):
    return rounded(_metric(m, "portfolio_volatility"), 8, "portfolio_volatility")


@query("dec16_contribution_to_risk", sql(_WEIGHTED + """
    select ticker, round(max(weight) * covar_samp(ret, port) / var_samp(port), 7) contribution_to_risk
    from r join p using (date) group by 1"""))
def _(m):
    return rounded(_metric(m, "contribution_to_risk"), 7, "contribution_to_risk")


@query("dec16_contribution_to_return", sql(_WEIGHTED + """
    select ticker, round(weight, 9) weight, round(weight * (last / first - 1), 8) contribution_to_return
    from weighted join (select ticker, arg_min(close, date) first, arg_max(close, date) last from prices_daily group by 1)
    using (ticker)"""))
def _(m):
    return rounded(rounded(_metric(m, "contribution_to_return"), 9, "weight"), 8, "contribution_to_return")


@query("dec17_only_open_days", sql("""
    select date, ticker, close from prices_daily
    where date in (select date from trading_calendar where is_open and exchange = 'nasdaq')"""))
def _(m):
    return declared.calendar_filtered(tables(m), only_open_days=True, exchange="nasdaq").select("date", "ticker", "close")


@query("dec17_exclude_holidays", sql("""
    select date, count(*) n from prices_daily where strftime(date, '%m-%d') not in ('01-01', '07-04', '12-25')
      or dayofweek(date) in (0, 6) group by 1"""))
def _(m):
    rows = declared.calendar_filtered(tables(m), exclude_holidays=True)
    return rows.groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@query("dec18_adjusted_for_splits_and_dividends", sql("""
    select ticker, date, round(close * f + sum(coalesce(cash_amount, 0)) over (partition by ticker order by date
      rows unbounded preceding), 5) as value
    from (select ticker, date, close, coalesce(product(factor) over (partition by ticker order by date
      rows between 1 following and unbounded following), 1) f from bars_with_factor)
    left join (select ticker, event_date as date, cash_amount from dividends) v using (ticker, date)"""))
def _(m):
    df = declared.close_series(tables(m), adjust_for_splits=True, adjust_for_dividends=True)
    return rounded(df, 5, "value")


@query("dec18_percent_with_benchmark", sql("""
    select ticker, date, round((close / first_value(close) over (partition by ticker order by date) - 1) * 100, 6) as value
    from prices_daily where ticker in (select ticker from portfolio union select 'S16')"""))
def _(m):
    df = declared.close_series(tables(m), ["my_portfolio"], benchmark="S16", percent_format=True)
    return rounded(df, 6, "value")


@query("dec18_include_cash_flows", sql("""
    with c as (select ticker, sum(cash_amount) per_share from dividends group by 1)
    select round(sum(unrealized_pnl), 3) portfolio_pnl, round(sum(shares * coalesce(per_share, 0)), 3) cash_flows,
      round(sum(unrealized_pnl + shares * coalesce(per_share, 0)), 3) pnl_with_cash_flows
    from held_values left join c using (ticker)"""))
def _(m):
    return rounded(declared.portfolio_income(tables(m)), 3, "portfolio_pnl", "cash_flows", "pnl_with_cash_flows")


@query("dec19_window_units", sql("""
    select ticker, date,
      round(avg(close) over (partition by ticker order by date range between interval 9 days preceding and current row), 5) days10,
      round(avg(close) over (partition by ticker order by date range between interval 13 days preceding and current row), 5) weeks2,
      months3 from prices_daily join (
        select p.ticker, p.date, round(avg(x.close), 5) months3 from prices_daily p join prices_daily x on x.ticker = p.ticker
          and x.date <= p.date and x.date >= p.date - interval 4 months and (x.date > p.date - interval 2 months or
            (year(x.date) * 12 + month(x.date), day(x.date)) > (year(p.date) * 12 + month(p.date) - 3, day(p.date)))
        group by 1, 2) using (ticker, date)"""))
def _(m):
    rows = m.prices_daily.select("ticker", "date", "close")
    for size, unit in ((10, "days"), (2, "weeks"), (3, "months")):
        rows = series.windowed(rows, "avg", "close", size, unit, f"{unit}{size}")
    return rounded(rows.drop("close"), 5, "days10", "weeks2", "months3")


@query("dec20_universe", sql("""
    select date, ticker, close from prices_daily where ticker in (
      select ticker from tickers where sector in ('ASIA', 'AFRICA') and exchange = 'NYSE' and industry != 'CHINA')"""))
def _(m):
    rows = filters.in_universe(m.prices_daily, m.tickers.filter(F.col("industry") != "CHINA"), ["ASIA", "AFRICA"], exchange="nyse")
    return rows.select("date", "ticker", "close")


@query("dec20_universe_counts", sql("""
    select count(distinct ticker) tickers, count(*) n from prices_daily join tickers using (ticker)
    where industry in ('CHINA', 'GERMANY', 'BRAZIL')"""))
def _(m):
    rows = filters.in_universe(m.prices_daily, m.tickers, industries=["CHINA", "GERMANY", "BRAZIL"])
    return rows.agg(F.countDistinct("ticker").alias("tickers"), F.count(F.lit(1)).alias("n"))


@query("dec21_rank_assets", sql("""
    select ticker, round(max(close) / arg_min(close, date) - 1, 8) as value from prices_daily where year(date) = 1999
    group by 1 order by max(close) / arg_min(close, date) - 1 desc, ticker limit 10"""))
def _(m):
    return rounded(declared.ranked_assets(tables(m), "ytd_return", 10, year=1999), 8, "value")


@query("dec21_screen_universe", sql("""
    select ticker, round(v, 8) as value from (
      select ticker, min(dd) v from (
        select ticker, close / max(close) over (partition by ticker order by date) - 1 dd from prices_daily) group by 1)
    where v <= -0.5 and ticker in (select ticker from tickers where sector = 'EUROPE') order by v, ticker limit 5"""))
def _(m):
    df = declared.ranked_assets(tables(m), "max_drawdown", 5, descending=False, threshold=-0.5,
                                universe=m.tickers.filter(F.col("sector") == "EUROPE"))
    return rounded(df, 8, "value")


@query("dec21_compare_assets", sql("""
    with e as (select ticker, arg_max(close, date) / arg_min(close, date) - 1 pr from prices_daily
      where date between '1998-01-01' and '1999-12-31' group by 1),
    v as (select ticker, stddev_samp(ret) vol from daily_returns where date between '1998-01-01' and '1999-12-31' group by 1)
    select ticker, round(pr, 8) period_return, round(vol, 8) volatility,
      round(pr - (select pr from e where ticker = 'S16'), 8) excess_return from e join v using (ticker)"""))
def _(m):
    df = declared.compare_assets(tables(m), D(1998, 1, 1), D(1999, 12, 31), benchmark="S16")
    return rounded(df, 8, "period_return", "volatility", "excess_return")


@query("dec21_pairs_by_sector", sql("""
    with firsts as (select sector, ticker, row_number() over (partition by sector order by ticker) rk
      from tickers),
    w as (select x.ticker a, y.ticker b from firsts x join firsts y on x.sector = y.sector and x.rk = 1 and y.rk > 1),
    j as (select a, b, x.ret ra, y.ret rb from w join daily_returns x on x.ticker = a
      join daily_returns y on y.ticker = b and y.date = x.date where x.ret is not null and y.ret is not null)
    select a, b, count(*) n, round(case when count(*) > 2 then corr(ra, rb) end, 6) correlation,
      round(avg(ra - rb), 6) mean_spread from j group by 1, 2"""))
def _(m):
    # The first ticker of each sector against the sector's others.
    lead = m.tickers.groupBy("sector").agg(F.min("ticker").alias("a"))
    wanted = m.tickers.join(lead, "sector").filter(F.col("ticker") != F.col("a")).select("a", F.col("ticker").alias("b"))
    df = comovement.pairs(series.daily_returns(m.prices_daily), wanted)
    return df.select("a", "b", "n", F.when(F.col("n") > 2, snap(F.col("correlation"), 6)).alias("correlation"),
                     snap(F.col("mean_spread"), 6).alias("mean_spread"))
