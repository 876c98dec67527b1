"""The question-level queries over the market tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import bars, filters, joins
from tidemark.operators.cleaning import core_ref_tickers
from tidemark.plans import metrics, questions, views
from tidemark.registry import query
from tidemark.registry.market import rounded, tables
from tidemark.registry.oracle import sql

D = dt.date


@query("qry1_first_day_ohlcv", sql("""
    select ticker, min(date) as date, arg_min(open, date) open, arg_min(high, date) high, arg_min(low, date) low,
      arg_min(close, date) as close, arg_min(volume, date) volume from prices_daily group by 1"""))
def _(m):
    return questions.first_day_bar(m.prices_daily).drop("vwap", "transactions")


@query("qry2_latest_close_volume", sql("""
    select p.ticker, p.date, p.close, p.volume from prices_daily p
    join (select ticker, max(date) md from prices_daily group by 1) x on p.ticker = x.ticker and p.date = x.md"""))
def _(m):
    return questions.latest_close_volume(m.prices_daily)


@query("qry3_7_and_30_row_returns", sql("""
    select date, ticker, close, round(close / nullif(lag(close, 7) over w, 0) - 1, 8) r7,
      round(close / nullif(lag(close, 30) over w, 0) - 1, 8) r30
    from prices_daily window w as (partition by ticker order by date)"""))
def _(m):
    return rounded(questions.window_returns(m.prices_daily, (7, 30)), 8, "r7", "r30")


@query("qry4_sector_on_day", sql("""
    select sector, date, round(avg(close), 6) avg_close, cast(sum(volume) as bigint) total_volume
    from prices_daily join tickers using (ticker) where sector = 'ASIA' and date = '1998-06-15' group by 1, 2"""))
def _(m):
    return rounded(questions.sector_day(m.prices_daily, m.tickers, ["ASIA"], D(1998, 6, 15)), 6, "avg_close")


@query("qry5_weekly_bar", sql("""
    select * exclude (vwap) from prices_weekly where week = '1998-06-15'"""))
def _(m):
    # The week's own days are enough, and they prune the scan.
    rows = filters.between(m.prices_daily, D(1998, 6, 15), D(1998, 6, 21))
    return bars.period_bars(rows, "week").drop("vwap")


@query("qry6_monthly_bar", sql("select * exclude (vwap) from prices_monthly where month = '2000-02-01'"))
def _(m):
    return bars.period_bars(filters.in_month(m.prices_daily, 2000, 2), "month").drop("vwap")


@query("qry7_exchange_open", sql("""
    select date, is_open from trading_calendar where exchange = 'nyse'"""))
def _(m):
    return questions.was_open(m.trading_calendar, "nyse")


@query("qry8_dividend_yield_series", sql("""
    select ticker, date, round(dividend_yield_ttm, 9) dividend_yield_ttm from ttm_yields
    where ticker in (select ticker from portfolio)"""))
def _(m):
    rows = metrics.dividend_yield_ttm(tables(m), ["my portfolio"]).orderBy("ticker", "date")
    return rounded(rows, 9, "dividend_yield_ttm")


@query("qry9_corporate_actions_by_date", sql("select * from corporate_actions"))
def _(m):
    return questions.actions_by_date(m.dividends, m.splits)


@query("qry10_split_adjusted_series", sql("""
    select ticker, date, round(close * cum_adj_factor, 6) close_adj_splits from adjusted_prices
    where ticker in ('S1', 'S2', 'S16')"""))
def _(m):
    rows = filters.for_tickers(m.prices_daily, ["S1", "S2", "S16"])
    df = views.adjusted_prices_splits(rows, filters.for_tickers(m.splits, ["S1", "S2", "S16"]))
    return rounded(df.select("ticker", "date", "close_adj_splits"), 6, "close_adj_splits")


@query("qry11_top_gainers", sql("""
    select ticker, date, round(ret, 8) ret from daily_returns where date = '2000-11-01'
    order by ret desc nulls last, ticker limit 10"""))
def _(m):
    return rounded(questions.top_gainers(m.prices_daily, D(2000, 11, 1), 10), 8, "ret")


@query("qry12_average_close_in_range", sql("""
    select ticker, round(sum(close) / count(*), 6) avg_close from prices_daily
    where date >= '1999-03-01' and date < '1999-09-01' group by 1"""))
def _(m):
    return rounded(questions.average_close(m.prices_daily, D(1999, 3, 1), D(1999, 8, 31)), 6, "avg_close")


@query("qry13_closes_with_dividends", sql("""
    select p.date, p.ticker, p.close, coalesce(d.cash_amount, 0) cash_amount from prices_daily p
    left join dividends d on d.ticker = p.ticker and d.event_date = p.date where year(p.date) = 2000"""))
def _(m):
    return questions.closes_with_dividends(m.prices_daily, m.dividends, D(2000, 1, 1), D(2000, 12, 31))


@query("qry14_closes_with_splits", sql("""
    select p.date, p.ticker, p.close, s.split_from / s.split_to split_factor from prices_daily p
    left join splits s on s.ticker = p.ticker and s.event_date = p.date where year(p.date) = 2000"""))
def _(m):
    return questions.closes_with_splits(m.prices_daily, m.splits, D(2000, 1, 1), D(2000, 12, 31))


@query("qry15_cumulative_ytd_series", sql("""
    select ticker, date, round(exp(sum(ln(1 + ret)) over (partition by ticker, date_trunc('year', date) order by date
      rows unbounded preceding)) - 1, 7) cum_ret_ytd from daily_returns where ticker in ('S5', 'S16')"""))
def _(m):
    return rounded(questions.cumulative_ytd(m.prices_daily, ["S5", "S16"]), 7, "cum_ret_ytd")


@query("qry16_company_profile", sql("""
    select ticker, name, t.sector, exchange, company_name, r.industry, market, primary_exchange
    from tickers t left join ref_tickers r using (ticker)"""))
def _(m):
    return joins.company_profile(m.tickers, core_ref_tickers(m.ref_tickers))


@query("qry17_sector_members_traded", sql("""
    select distinct date, sector, ticker from prices_daily join tickers using (ticker)
    where date between '2001-01-01' and '2001-03-31'"""))
def _(m):
    rows = filters.between(m.prices_daily, D(2001, 1, 1), D(2001, 3, 31))
    return questions.sector_members_on(rows, m.tickers)


@query("qry18_latest_price_as_of", sql("""
    select ticker, date, close from prices_daily where date <= '1997-10-10'
    qualify row_number() over (partition by ticker order by date desc) = 1"""))
def _(m):
    return joins.edge_bars(filters.between(m.prices_daily, None, D(1997, 10, 10)), "last", ["close"])


@query("qry19_daily_return_on_day", sql("""
    select ticker, date, round(ret, 8) daily_return from daily_returns where date = '2001-05-21'"""))
def _(m):
    return rounded(questions.daily_return_on(m.prices_daily, D(2001, 5, 21)), 8, "daily_return")


@query("qry20_return_between_dates", sql("""
    select ticker, min(date) start_date, max(date) end_date, round(max(close) / min(close) - 1, 8) period_return
    from prices_daily where date between '1995-06-01' and '1998-05-31' and ticker in ('S1', 'S2', 'S3') group by 1"""))
def _(m):
    return rounded(metrics.range_return(tables(m), ["s1", "s2", "s3"], D(1995, 6, 1), D(1998, 5, 31)), 8, "period_return")


@query("qry21_ytd_return", sql("""
    select ticker, max(date) as_of_date, round(max(close) / arg_min(close, date) - 1, 8) ytd_return
    from prices_daily where year(date) = 2000 group by 1"""))
def _(m):
    return rounded(metrics.ytd_return(tables(m), year=2000), 8, "ytd_return")


@query("qry22_sector_average_return", sql("""
    with r as (select sector, close / lag(close) over (partition by ticker order by date) - 1 ret
      from prices_daily join tickers using (ticker) where date between '1999-01-01' and '2000-12-31')
    select sector, round(avg(ret), 8) avg_daily_return from r where ret is not null and sector = 'EUROPE' group by 1"""))
def _(m):
    df = metrics.sector_average_return(tables(m), D(1999, 1, 1), D(2000, 12, 31), "EUROPE")
    return rounded(df, 8, "avg_daily_return")


@query("qry23_dividend_history", sql("""
    select ticker, ex_dividend_date, cash_amount from dividends
    where ex_dividend_date between '1997-01-01' and '1998-12-31'"""))
def _(m):
    return questions.dividend_history(m.dividends, D(1997, 1, 1), D(1998, 12, 31))


@query("qry24_split_history", sql("select ticker, event_date, split_to / split_from ratio from splits"))
def _(m):
    return questions.split_history(m.splits)


@query("qry25_portfolio_value", sql("""
    select round(sum(shares * close), 4) portfolio_value from portfolio join prices_daily using (ticker)
    where date = (select max(date) from prices_daily where date <= '1998-08-01')"""))
def _(m):
    return rounded(questions.portfolio_total(tables(m), D(1998, 8, 1)), 4, "portfolio_value")


@query("qry26_top_positions", sql("""
    select ticker, shares, close price, round(shares * close, 4) position_value
    from portfolio join prices_daily using (ticker)
    where date = (select max(date) from prices_daily where date <= '1999-04-07')
    order by shares * close desc, ticker limit 10"""))
def _(m):
    return rounded(questions.top_positions(tables(m), D(1999, 4, 7), 10), 4, "position_value")


@query("qry27_sector_allocation", sql("""
    select sector, round(sum(shares * close), 4) sector_value
    from portfolio join prices_daily using (ticker) join tickers using (ticker)
    where date = (select max(date) from prices_daily where date <= '1999-04-07') group by 1"""))
def _(m):
    return rounded(questions.sector_allocation(tables(m), D(1999, 4, 7)), 4, "sector_value")


@query("qry28_latest_price_and_ytd", sql("""
    select ticker, latest_date, latest_price, round(ytd_return, 8) ytd_return from (
      select ticker, max(date) latest_date, arg_max(close, date) latest_price from prices_daily group by 1)
    left join (select ticker, max(close) / arg_min(close, date) - 1 ytd_return from prices_daily
      where year(date) = 1996 group by 1) using (ticker)"""))
def _(m):
    return rounded(questions.latest_price_and_ytd(tables(m), 1996), 8, "ytd_return")
