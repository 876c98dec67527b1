"""Core tables, views, joins, aggregates, windows, top-k and sets over the market tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.numbers import growth
from tidemark.functions.staging import dealt
from tidemark.operators import bars, filters, joins, ranking, series, sets
from tidemark.plans import metrics, questions, views
from tidemark.plans.metrics import Tables
from tidemark.registry import query
from tidemark.registry.oracle import define, snap, sql

D = dt.date


def tables(m) -> Tables:
    return Tables(m.prices_daily, m.dividends, m.splits, m.tickers, m.portfolio, m.trading_calendar)


def rounded(df, digits: int, *names: str):
    return df.withColumns({n: snap(F.col(n), digits) for n in names})


# --- views -----------------------------------------------------------------------------------------------

@query("view1_prices_enriched", sql("""
    select date, ticker, open, high, low, close, volume, round(vwap, 6) vwap, transactions, name, sector, exchange
    from prices_daily left join tickers using (ticker)"""))
def _(m):
    return rounded(views.prices_enriched(m.prices_daily, m.tickers), 6, "vwap")


@query("view2_daily_returns", sql("select date, ticker, round(ret, 8) ret from daily_returns"))
def _(m):
    return rounded(views.daily_returns(m.prices_daily), 8, "ret")


@query("view3_daily_returns_open_days", sql("""
    select date, ticker, round(ret, 8) ret from daily_returns
    where date in (select date from trading_calendar where exchange = 'nyse' and is_open)"""))
def _(m):
    return rounded(views.daily_returns_open_days(m.prices_daily, m.trading_calendar), 8, "ret")


@query("view4_prices_weekly", sql("select * replace (round(vwap, 6) as vwap) from prices_weekly"))
def _(m):
    return rounded(views.prices_weekly(m.prices_daily), 6, "vwap")


@query("view5_prices_monthly", sql("select * replace (round(vwap, 6) as vwap) from prices_monthly"))
def _(m):
    return rounded(views.prices_monthly(m.prices_daily), 6, "vwap")


@query("view6_corporate_actions", sql("select * from corporate_actions"))
def _(m):
    return views.corporate_actions(m.dividends, m.splits)


@query("view7_adjusted_prices_splits", sql("""
    select ticker, date, close, round(close * cum_adj_factor, 6) close_adj_splits,
      round(cum_adj_factor, 9) cum_adj_factor from adjusted_prices"""))
def _(m):
    df = views.adjusted_prices_splits(m.prices_daily, m.splits)
    return rounded(rounded(df, 6, "close_adj_splits"), 9, "cum_adj_factor")


@query("view7_adjusted_prices_splits_exact", sql("""
    select ticker, date, close, round(close * f, 6) close_adj_splits_exact, round(f, 9) later_factor from (
      select *, coalesce(product(factor) over (partition by ticker order by date
        rows between 1 following and unbounded following), 1) f from bars_with_factor)"""))
def _(m):
    df = views.adjusted_prices_splits_exact(m.prices_daily, m.splits)
    return rounded(rounded(df, 6, "close_adj_splits_exact"), 9, "later_factor")


@query("view8_dividend_yield_ttm", sql("""
    select date, ticker, close, round(cash_ttm, 6) cash_ttm, round(dividend_yield_ttm, 9) dividend_yield_ttm
    from ttm_yields"""))
def _(m):
    df = views.dividend_yield_ttm(m.prices_daily, m.dividends)
    return rounded(rounded(df, 6, "cash_ttm"), 9, "dividend_yield_ttm")


# --- filters ---------------------------------------------------------------------------------------------

@query("flt1_ticker_list", sql("select date, ticker, close from prices_daily where ticker in ('S1', 'S7', 'S42')"))
def _(m):
    return filters.for_tickers(m.prices_daily, ["s1", "S7", "s42"]).select("date", "ticker", "close")


@query("flt2_in_portfolio", sql("""
    select date, ticker, close from prices_daily where ticker in (select ticker from portfolio)"""))
def _(m):
    return filters.for_tickers(m.prices_daily, ["My Portfolio"], m.portfolio).select("date", "ticker", "close")


@query("flt3_year", sql("select date, ticker, close from prices_daily where year(date) = 1998"))
def _(m):
    return filters.in_year(m.prices_daily, 1998).select("date", "ticker", "close")


@query("flt4_between_dates", sql("""
    select date, ticker, close from prices_daily where date >= '1997-03-15' and date <= '1997-11-20'"""))
def _(m):
    return filters.between(m.prices_daily, D(1997, 3, 15), D(1997, 11, 20)).select("date", "ticker", "close")


@query("flt4_open_ended", sql("select date, ticker, close from prices_daily where date >= '2000-06-01'"))
def _(m):
    return filters.between(m.prices_daily, D(2000, 6, 1), None).select("date", "ticker", "close")


@query("flt5_year_month", sql("""
    select date, ticker, close from prices_daily where year(date) = 1999 and month(date) = 12"""))
def _(m):
    return filters.in_month(m.prices_daily, 1999, 12).select("date", "ticker", "close")


@query("flt6_generic_filters", sql("""
    select date, ticker, name, sector, close from prices_daily join tickers using (ticker)
    where sector in ('ASIA', 'EUROPE') and industry not in ('CHINA', 'FRANCE') and name like 'Supplier%'
      and exchange ilike 'ny%' and date between '1996-01-01' and '1999-12-31' and close > 1000 and close <= 50000
      and volume != 13"""))
def _(m):
    rows = m.prices_daily.join(m.tickers, "ticker")
    return filters.apply_filters(rows, [
        {"field": "sector", "op": "IN", "value": ["ASIA", "EUROPE"]},
        {"field": "industry", "op": "NOT IN", "value": ["CHINA", "FRANCE"]},
        {"field": "name", "op": "LIKE", "value": "Supplier%"},
        {"field": "exchange", "op": "ILIKE", "value": "ny%"},
        {"field": "date", "op": "BETWEEN", "value": [D(1996, 1, 1), D(1999, 12, 31)]},
        {"field": "close", "op": ">", "value": 1000.0},
        {"field": "close", "op": "<=", "value": 50000.0},
        {"field": "volume", "op": "!=", "value": 13},
    ]).select("date", "ticker", "name", "sector", "close")


@query("flt7_point_lookup", sql("select * exclude (vwap) from prices_daily where ticker = 'S16' and date >= '2001-10-01'"))
def _(m):
    rows = filters.for_tickers(m.prices_daily, ["S16"])
    return rows.filter(filters.compare("date", ">=", D(2001, 10, 1))).drop("vwap")


@query("flt8_not_null_computed", sql("select date, ticker, round(ret, 8) ret from daily_returns where ret is not null"))
def _(m):
    return rounded(series.daily_returns(m.prices_daily).filter(F.col("ret").isNotNull()), 8, "ret")


@query("flt9_filter_after_window", sql("""
    select ticker, date, round(close / lag(close) over (partition by ticker order by date) - 1, 8) daily_return
    from prices_daily where date <= '1998-06-15' qualify date = '1998-06-15'"""))
def _(m):
    return rounded(questions.daily_return_on(m.prices_daily, D(1998, 6, 15)), 8, "daily_return")


_AS_OF = D(2000, 3, 15)
_RANGES = {
    "all": ({}, "true"),
    "year": ({"value": 1999}, "date between '1999-01-01' and '1999-12-31'"),
    "month": ({"value": "1999-02"}, "date between '1999-02-01' and '1999-02-28'"),
    "between_dates": ({"start": D(1999, 5, 1), "end": None}, "date >= '1999-05-01'"),
    "trailing": ({"value": 12}, "date between '1999-03-16' and '2000-03-15'"),
    "last_n_days": ({"value": 30}, "date between '2000-02-14' and '2000-03-15'"),
    "ytd": ({}, "date between '2000-01-01' and '2000-03-15'"),
    "mtd": ({}, "date between '2000-03-01' and '2000-03-15'"),
    "since_inception": ({}, "date <= '2000-03-15'"),
}


@query("flt10_declared_ranges", sql(" union all ".join(
    f"select '{kind}' range_type, ticker, count(*) n, max(date) last_date from prices_daily where {test} group by 2"
    for kind, (_, test) in _RANGES.items())))
def _(m):
    from tidemark.functions.dates import range_bounds, within
    spans = [(kind, *range_bounds(kind, _AS_OF, **args)) for kind, (args, _) in _RANGES.items()]
    hits = F.filter(F.array(*[F.when(within(F.col("date"), lo, hi), kind) for kind, lo, hi in spans]),
                    lambda x: x.isNotNull())
    rows = m.prices_daily.select("ticker", "date", F.explode(hits).alias("range_type"))
    return rows.groupBy("range_type", "ticker").agg(F.count(F.lit(1)).alias("n"), F.max("date").alias("last_date"))


# --- joins -----------------------------------------------------------------------------------------------

@query("join1_prices_left_tickers", sql("""
    select sector, exchange, count(*) n, max(close) top_close from prices_daily left join tickers using (ticker)
    group by 1, 2"""))
def _(m):
    return joins.enriched(m.prices_daily, m.tickers).groupBy("sector", "exchange").agg(
        F.count(F.lit(1)).alias("n"), F.max("close").alias("top_close"))


@query("join2_prices_with_dividends", sql("""
    select p.date, p.ticker, p.close, coalesce(d.cash_amount, 0) cash_amount
    from prices_daily p left join dividends d on d.ticker = p.ticker and d.event_date = p.date"""))
def _(m):
    return joins.with_dividends(m.prices_daily, m.dividends).select("date", "ticker", "close", "cash_amount")


@query("join3_prices_with_splits", sql("""
    select p.date, p.ticker, p.close,
      case when s.split_from > 0 and s.split_to > 0 then s.split_from / s.split_to end split_factor
    from prices_daily p left join splits s on s.ticker = p.ticker and s.event_date = p.date"""))
def _(m):
    return joins.with_split_factor(m.prices_daily, m.splits).select("date", "ticker", "close", "split_factor")


@query("join4_returns_on_nyse_open_days", sql("""
    select r.date, count(*) n, round(avg(ret), 8) avg_ret from daily_returns r join trading_calendar c
    on c.exchange = 'nyse' and c.date = r.date and c.is_open group by 1"""))
def _(m):
    rows = joins.on_open_days(series.daily_returns(m.prices_daily), m.trading_calendar, "nyse")
    return rows.groupBy("date").agg(F.count(F.lit(1)).alias("n"), snap(F.avg("ret"), 8).alias("avg_ret"))


@query("join5_prices_on_any_open_day", sql("""
    select date, ticker, close from prices_daily
    where date in (select date from trading_calendar where is_open)"""))
def _(m):
    return joins.on_open_days(m.prices_daily, m.trading_calendar).select("date", "ticker", "close")


@query("join6_prices_in_sector", sql("""
    select date, ticker, close, sector from prices_daily join tickers using (ticker) where sector = 'ASIA'"""))
def _(m):
    return joins.in_sector(m.prices_daily, m.tickers, "ASIA").select("date", "ticker", "close", "sector")


@query("join7_company_profile", sql("""
    select t.ticker, t.name, t.sector, t.exchange, r.company_name, r.industry, r.market, r.primary_exchange
    from tickers t left join ref_tickers r using (ticker)"""))
def _(m):
    from tidemark.operators.cleaning import core_ref_tickers
    return joins.company_profile(m.tickers, core_ref_tickers(m.ref_tickers))


@query("join8_first_trading_day", sql("""
    select p.* exclude (vwap) from prices_daily p join (select ticker, min(date) d0 from prices_daily group by 1) d
    on p.ticker = d.ticker and p.date = d.d0"""))
def _(m):
    return questions.first_day_bar(m.prices_daily).drop("vwap")


@query("join9_portfolio_latest_price", sql("select ticker, shares, avg_cost, last_close from held_values"))
def _(m):
    return joins.holdings_at_last_close(m.portfolio, m.prices_daily).select(
        "ticker", "shares", "avg_cost", "last_close")


@query("join10_positions_on_market_date", sql("""
    select ticker, shares, close price, round(shares * close, 4) position_value
    from portfolio join prices_daily using (ticker)
    where date = (select max(date) from prices_daily where date <= '1999-07-04')"""))
def _(m):
    return rounded(joins.positions(m.portfolio, m.prices_daily, D(1999, 7, 4)), 4, "position_value")


@query("join11_positions_by_sector", sql("""
    select ticker, sector, round(shares * close, 4) position_value
    from portfolio join prices_daily using (ticker) join tickers using (ticker)
    where date = (select max(date) from prices_daily where date <= '2000-01-09')"""))
def _(m):
    held = joins.positions(m.portfolio, m.prices_daily, D(2000, 1, 9)).join(m.tickers, "ticker")
    return rounded(held.select("ticker", "sector", "position_value"), 4, "position_value")


@query("join12_latest_price_left_ytd", sql("""
    select ticker, latest_date, latest_price, round(ytd_return, 8) ytd_return from (
      select ticker, max(date) latest_date, arg_max(close, date) latest_price from prices_daily group by 1)
    left join (
      select ticker, max(close) / arg_min(close, date) - 1 ytd_return from prices_daily
      where year(date) = 2001 group by 1) using (ticker)"""))
def _(m):
    return rounded(questions.latest_price_and_ytd(tables(m), 2001), 8, "ytd_return")


def _orders_as_requests(m):
    """One request per distinct (order, ticker): the ticker's last bar at the order date. Lines are dealt by order first: nearly
    all are distinct, and no task should hold those of a whole file."""
    table = m.table("lineitem")
    lines = dealt(table.select("l_orderkey", "l_suppkey"), table.count(), "l_orderkey").select("l_orderkey", F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker"))
    dates = m.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("as_of"))
    return lines.join(dates, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("request_id"), "ticker", "as_of").distinct()


define("asked", """
select distinct l_orderkey request_id, concat('S', cast(l_suppkey as varchar(20))) ticker,
  cast(o_orderdate as date) as_of from lineitem join orders on l_orderkey = o_orderkey""")


@query("join13_as_of_close", sql("""
    select a.request_id, a.ticker, a.as_of, p.date, p.close
    from asked a asof left join prices_daily p on a.ticker = p.ticker and a.as_of >= p.date"""))
def _(m):
    return joins.as_of(_orders_as_requests(m), m.prices_daily)


@query("join14_neighbour_trading_days", sql("""
    select o_orderkey, date, (select max(c.date) from open_days c where c.date <= o.date) last_trading_day,
      (select min(c.date) from open_days c where c.date > o.date) next_trading_day
    from order_days o""".replace("open_days", "(select distinct date from trading_calendar where is_open)").replace(
        "order_days", "(select o_orderkey, cast(o_orderdate as date) as date from orders)")))
def _(m):
    days = m.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return joins.neighbour_open_days(days, m.trading_calendar)


@query("join15_in_subquery", sql("""
    select ticker, event_date, cash_amount from dividends where ticker in (select ticker from portfolio)"""))
def _(m):
    return filters.in_portfolio(m.dividends, m.portfolio).select("ticker", "event_date", "cash_amount")


@query("join16_not_landed", sql("""
    select ticker, sector from tickers where ticker not in (select ticker from portfolio)"""))
def _(m):
    return m.tickers.join(m.portfolio, "ticker", "left_anti").select("ticker", "sector")


@query("join17_range_join", sql("""
    select request_id, a.ticker, count(*) bars, min(close) low_close, max(close) high_close
    from asked a join prices_daily p on a.ticker = p.ticker and p.date between a.as_of and a.as_of + 60
    group by 1, 2"""))
def _(m):
    asked = _orders_as_requests(m).select("request_id", "ticker", F.col("as_of").alias("start"),
                                          F.date_add("as_of", 60).alias("end"))
    return joins.range_join(asked, m.prices_daily.select("ticker", "date", "close")).groupBy("request_id", "ticker").agg(
        F.count(F.lit(1)).alias("bars"), F.min("close").alias("low_close"), F.max("close").alias("high_close"))


@query("join18_declared_joins", sql("""
    select p.ticker, p.date, p.close, d.cash_amount from prices_daily p
    full join (select ticker, event_date as date, cash_amount from dividends) d
    on p.ticker = d.ticker and p.date = d.date"""))
def _(m):
    cash = m.dividends.select("ticker", F.col("event_date").alias("date"), "cash_amount")
    return joins.declared(m.prices_daily.select("ticker", "date", "close"), cash, "ticker AND date", "full")


@query("join18_declared_relation", sql("""
    select p.ticker, p.date, p.close, s.split_to from prices_daily p
    left join splits s on p.ticker = s.ticker and p.date = s.event_date"""))
def _(m):
    return joins.related("prices_daily", m.prices_daily, "splits", m.splits).select(
        "ticker", "date", "close", "split_to")


# --- aggregates ------------------------------------------------------------------------------------------

@query("agg1_weekly_volume", sql("select week, cast(sum(volume) as bigint) volume, count(*) n from prices_weekly group by 1"))
def _(m):
    return bars.period_bars(m.prices_daily, "week").groupBy("week").agg(
        F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("n"))


@query("agg2_monthly_range", sql("select month, max(high) high, min(low) low from prices_monthly group by 1"))
def _(m):
    return bars.period_bars(m.prices_daily, "month").groupBy("month").agg(
        F.max("high").alias("high"), F.min("low").alias("low"))


@query("agg3_bar_lookup", sql("""
    select ticker, week as period, open, close from prices_weekly where ticker = 'S16'
    union all select ticker, month, open, close from prices_monthly where ticker = 'S16'"""))
def _(m):
    rows = filters.for_tickers(m.prices_daily, ["S16"])
    week = bars.period_bars(rows, "week").select("ticker", F.col("week").alias("period"), "open", "close")
    return week.union(bars.period_bars(rows, "month").select("ticker", "month", "open", "close"))


@query("agg4_sector_day", sql("""
    select sector, date, round(avg(close), 6) avg_close, cast(sum(volume) as bigint) total_volume
    from prices_daily join tickers using (ticker) group by 1, 2"""))
def _(m):
    return rounded(questions.sector_day(m.prices_daily, m.tickers), 6, "avg_close")


@query("agg5_average_close", sql("""
    select ticker, round(avg(close), 6) avg_close from prices_daily
    where date between '1997-01-01' and '1999-06-30' group by 1"""))
def _(m):
    return rounded(questions.average_close(m.prices_daily, D(1997, 1, 1), D(1999, 6, 30)), 6, "avg_close")


@query("agg6_sector_average_return", sql("""
    with r as (select sector, close / lag(close) over (partition by ticker order by date) - 1 ret
      from prices_daily join tickers using (ticker) where date between '1998-01-01' and '1998-12-31')
    select sector, round(avg(ret), 8) avg_daily_return from r where ret is not null group by 1"""))
def _(m):
    df = metrics.sector_average_return(tables(m), D(1998, 1, 1), D(1998, 12, 31))
    return rounded(df, 8, "avg_daily_return")


@query("agg7_portfolio_total", sql("""
    select round(sum(shares * close), 4) portfolio_value from portfolio join prices_daily using (ticker)
    where date = (select max(date) from prices_daily where date <= '2000-12-31')"""))
def _(m):
    return rounded(questions.portfolio_total(tables(m), D(2000, 12, 31)), 4, "portfolio_value")


@query("agg8_sector_allocation", sql("""
    select sector, round(sum(shares * close), 4) sector_value from portfolio join prices_daily using (ticker)
    join tickers using (ticker)
    where date = (select max(date) from prices_daily where date <= '2000-12-31') group by 1"""))
def _(m):
    return rounded(questions.sector_allocation(tables(m), D(2000, 12, 31)), 4, "sector_value")


@query("agg9_dividend_cash", sql("""
    select ticker, round(sum(cash_amount), 6) div_cash from dividends
    where event_date between '1996-07-01' and '2000-06-30' group by 1"""))
def _(m):
    return rounded(questions.dividend_cash(m.dividends, D(1996, 7, 1), D(2000, 6, 30)), 6, "div_cash")


@query("agg10_distinct_values", sql("""
    select 'sector_date' kind, sector a, cast(date as varchar) b from (
      select distinct sector, date from prices_daily join tickers using (ticker))
    union all select 'ticker_week', ticker, cast(week as varchar) from (select distinct ticker, week from prices_weekly)
    union all select 'ticker_month', ticker, cast(month as varchar) from (select distinct ticker, month from prices_monthly)"""))
def _(m):
    pairs = [
        ("sector_date", joins.enriched(m.prices_daily, m.tickers).select("sector", "date")),
        ("ticker_week", m.prices_daily.select("ticker", F.date_trunc("week", "date").cast("date"))),
        ("ticker_month", m.prices_daily.select("ticker", F.trunc("date", "month"))),
    ]
    parts = [df.toDF("a", "b").distinct().select(F.lit(kind).alias("kind"), "a", F.col("b").cast("string").alias("b"))
             for kind, df in pairs]
    return parts[0].union(parts[1]).union(parts[2])


@query("agg11_slot_aggregates", sql("""
    select sector, round(avg(close), 6) avg_close, cast(sum(volume) as bigint) sum_volume, min(low) min_low,
      max(high) max_high, count(close) count_close from prices_daily join tickers using (ticker) group by 1"""))
def _(m):
    rows = joins.enriched(m.prices_daily, m.tickers)
    wanted = [("avg", "close"), ("sum", "volume"), ("min", "low"), ("max", "high"), ("count", "close")]
    out = bars.grouped(rows, ["sector"], {f"{a}_{c}": (a, c) for a, c in wanted})
    return rounded(out, 6, "avg_close")


@query("agg12_date_span", sql("select min(date) min_date, max(date) max_date from prices_daily"))
def _(m):
    return bars.date_span(m.prices_daily)


@query("agg13_share_by_sector", sql("""
    select sector, count(*) n, round(count(*) / (select count(*) from prices_daily), 9) share
    from prices_daily join tickers using (ticker) group by 1"""))
def _(m):
    return rounded(bars.shares_of_total(joins.enriched(m.prices_daily, m.tickers), ["sector"]), 9, "share")


@query("agg14_mean_of_flags", sql("""
    select ticker, round(avg(cast(ret > 0 as int)), 9) up_rate from daily_returns group by 1"""))
def _(m):
    return series.daily_returns(m.prices_daily).groupBy("ticker").agg(
        snap(bars.true_rate(F.col("ret") > 0), 9).alias("up_rate"))


@query("agg15_group_having", sql("""
    select ticker, year(date) as year, count(close) n, max(close) top_close from prices_daily
    group by 1, 2 having count(close) >= 70"""))
def _(m):
    rows = m.prices_daily.withColumn("year", F.year("date").cast("long"))
    return bars.grouped(rows, ["ticker", "year"], {"n": ("count", "close"), "top_close": ("max", "close")},
                        F.col("n") >= 70)


@query("agg16_period_labels", sql("""
    select ticker, strftime(date, '%Y-%W') as period, arg_max(close, date) val from prices_daily group by 1, 2
    union all select ticker, strftime(date, '%Y-%m'), arg_max(close, date) from prices_daily group by 1, 2"""))
def _(m):
    week = bars.labelled_periods(m.prices_daily, "week").withColumnRenamed("week", "period")
    return week.union(bars.labelled_periods(m.prices_daily, "month"))


# --- windows ---------------------------------------------------------------------------------------------

@query("win1_daily_return", sql("select ticker, count(ret) n, round(max(ret), 8) best from daily_returns group by 1"))
def _(m):
    return series.daily_returns(m.prices_daily).groupBy("ticker").agg(
        F.count("ret").alias("n"), snap(F.max("ret"), 8).alias("best"))


@query("win2_lagged_returns", sql("""
    select date, ticker, close, round(close / lag(close, 7) over w - 1, 8) r7,
      round(close / lag(close, 30) over w - 1, 8) r30
    from prices_daily window w as (partition by ticker order by date)"""))
def _(m):
    return rounded(questions.window_returns(m.prices_daily), 8, "r7", "r30")


_FIRST_LAST = sql("""
    select date, ticker, close, first_value(close) over (partition by ticker order by date) first_close,
      last_value(close) over (partition by ticker order by date
        range between unbounded preceding and unbounded following) last_close
    from prices_daily where year(date) = 1997""")


@query("win3_first_close_of_period", _FIRST_LAST)
def _(m):
    return series.first_last_close(filters.in_year(m.prices_daily, 1997))


@query("win4_first_value_default_frame", sql("""
    select ticker, date, round(close / first_value(close) over (partition by ticker order by date) - 1, 8) since_first
    from prices_daily"""))
def _(m):
    rows = series.first_last_close(m.prices_daily)
    return rows.select("ticker", "date", snap(growth(F.col("close"), F.col("first_close")), 8).alias("since_first"))


@query("win5_last_value_whole_series", sql("""
    select p.ticker, p.date, round(l.close / p.close - 1, 8) to_last from prices_daily p
    join (select ticker, arg_max(close, date) as close from prices_daily group by 1) l on p.ticker = l.ticker"""))
def _(m):
    rows = series.first_last_close(m.prices_daily)
    return rows.select("ticker", "date", snap(growth(F.col("last_close"), F.col("close")), 8).alias("to_last"))


@query("win6_rolling_deviation", sql("""
    select ticker, date, round(stddev_pop(ret) over (partition by ticker order by date
      rows between 20 preceding and current row), 8) rolling_vol from daily_returns"""))
def _(m):
    rows = series.rolling_volatility(series.daily_returns(m.prices_daily), 20)
    return rounded(rows.select("ticker", "date", "rolling_vol"), 8, "rolling_vol")


@query("win7_rolling_compound_return", sql("""
    select ticker, date, round(exp(sum(ln(1 + ret)) over (partition by ticker order by date
      rows between 20 preceding and current row)) - 1, 7) rolling_ret from daily_returns"""))
def _(m):
    rows = series.rolling_return(series.daily_returns(m.prices_daily), 20)
    return rounded(rows.select("ticker", "date", "rolling_ret"), 7, "rolling_ret")


@query("win8_cumulative_by_year", sql("""
    select ticker, date, round(exp(sum(ln(1 + ret)) over (partition by ticker, year(date) order by date
      rows unbounded preceding)) - 1, 7) cum_ret_ytd from daily_returns"""))
def _(m):
    return rounded(questions.cumulative_ytd(m.prices_daily), 7, "cum_ret_ytd")


@query("win9_trailing_cash", sql("select ticker, date, round(cash_ttm, 6) cash_ttm from ttm_yields"))
def _(m):
    rows = joins.with_dividends(m.prices_daily, m.dividends)
    return rounded(series.trailing_sum(rows, "cash_amount", 365, "cash_ttm").select("ticker", "date", "cash_ttm"), 6, "cash_ttm")


@query("win10_running_split_factor", sql("select ticker, date, round(cum_adj_factor, 9) cum_adj_factor from adjusted_prices"))
def _(m):
    rows = series.cumulative_split_factor(series.split_factors(m.prices_daily, m.splits))
    return rounded(rows.select("ticker", "date", "cum_adj_factor"), 9, "cum_adj_factor")


@query("win11_keep_first", sql("""
    select l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice from lineitem
    qualify row_number() over (partition by l_suppkey
      order by l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) = 1"""))
def _(m):
    rows = m.table("lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return ranking.keep_first(rows, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"])


# --- top-k and sets --------------------------------------------------------------------------------------

@query("top1_gainers_on_day", sql("""
    select ticker, date, round(ret, 8) ret from daily_returns where date = '1999-09-15'
    order by ret desc nulls last, ticker limit 10"""))
def _(m):
    return rounded(questions.top_gainers(m.prices_daily, D(1999, 9, 15)), 8, "ret")


@query("top2_gainers_each_day", sql("""
    select date, ticker, round(ret, 8) ret, rank from (
      select *, row_number() over (partition by date order by ret desc, ticker) rank from daily_returns
      where ret is not null) where rank <= 10"""))
def _(m):
    return rounded(questions.top_gainers_each_day(m.prices_daily).select("date", "ticker", "ret", F.col("rank").cast("long").alias("rank")), 8, "ret")


@query("top3_positions", sql("""
    select ticker, shares, close price, round(shares * close, 4) position_value
    from portfolio join prices_daily using (ticker)
    where date = (select max(date) from prices_daily where date <= '2000-12-31')
    order by shares * close desc, ticker limit 5"""))
def _(m):
    return rounded(questions.top_positions(tables(m), D(2000, 12, 31), 5), 4, "position_value")


@query("top4_latest_row_before", sql("""
    select ticker, max(date) as date, arg_max(close, date) as close from prices_daily where date <= '1998-04-01' group by 1"""))
def _(m):
    return joins.edge_bars(filters.between(m.prices_daily, None, D(1998, 4, 1)), "last", ["close"])


@query("top5_ordered_series", sql("select date, ticker, round(dividend_yield_ttm, 9) dividend_yield_ttm from ttm_yields where ticker in ('S3', 'S4')"))
def _(m):
    rows = metrics.dividend_yield_ttm(tables(m), ["S3", "S4"]).orderBy("ticker", "date")
    return rounded(rows.select("date", "ticker", "dividend_yield_ttm"), 9, "dividend_yield_ttm")


@query("top6_ranking_per_sector", sql("""
    select sector, ticker, round(total, 6) total, rank from (
      select sector, ticker, total, row_number() over (partition by sector order by total, ticker) rank from (
        select sector, ticker, sum(cash_amount) total from dividends join tickers using (ticker) group by 1, 2))
    where rank <= 3"""))
def _(m):
    cash = m.dividends.join(m.tickers, "ticker").groupBy("sector", "ticker").agg(snap(F.sum("cash_amount"), 6).alias("total"))
    return ranking.top_per_group(cash, ["sector"], "total", 3, ["ticker"], descending=False).withColumn(
        "rank", F.col("rank").cast("long"))


@query("set1_union_all_actions", sql("""
    select action_type, count(*) n, round(sum(cash_amount), 6) cash, sum(split_to) split_to
    from corporate_actions group by 1"""))
def _(m):
    return sets.corporate_actions(m.dividends, m.splits).groupBy("action_type").agg(
        F.count(F.lit(1)).alias("n"), snap(F.sum("cash_amount"), 6).alias("cash"), F.sum("split_to").alias("split_to"))


@query("set2_tickers_with_actions", sql("select ticker from dividends union select ticker from splits"))
def _(m):
    return sets.tickers_with_actions(m.dividends, m.splits)


@query("set3_combined_calendar", sql("""
    with hist as (select exchange, date, is_open, market_open_utc, market_close_utc from trading_calendar where date < '2000-01-01'),
    fut as (select exchange, date, not is_open is_open, market_open_utc, market_close_utc from trading_calendar where date >= '1999-06-01')
    select exchange, date, is_open,
      strftime(timezone('America/New_York', timezone('UTC', market_open_utc)), '%Y-%m-%d %H:%M') open_ny,
      strftime(timezone('America/New_York', timezone('UTC', market_close_utc)), '%Y-%m-%d %H:%M') close_ny
    from (select * from hist union all
      select * from fut where (exchange, date) not in (select (exchange, date) from hist))"""))
def _(m):
    cal = m.trading_calendar.select("exchange", "date", "is_open", "market_open_utc", "market_close_utc")
    historic = cal.filter(F.col("date") < F.lit(D(2000, 1, 1)))
    future = cal.filter(F.col("date") >= F.lit(D(1999, 6, 1))).withColumn("is_open", ~F.col("is_open"))
    return sets.combine_calendars(historic, future).select(
        "exchange", "date", "is_open", F.date_format("market_open_ny", "yyyy-MM-dd HH:mm").alias("open_ny"),
        F.date_format("market_close_ny", "yyyy-MM-dd HH:mm").alias("close_ny"))


@query("set5_overlap", sql("""
    select exists (select ticker, event_date from dividends intersect select ticker, event_date from splits) overlap"""))
def _(m):
    return sets.same_rows(m.dividends.select("ticker", "event_date"), m.splits.select("ticker", "event_date")).select("overlap")


@query("set6_equality", sql("""
    select true equal_to_itself, (select count(*) from dividends) = (select count(*) from splits) equal_to_other"""))
def _(m):
    a = m.dividends.select("ticker", "event_date")
    same = sets.same_rows(a, a.select("event_date", "ticker")).select(F.col("equal").alias("equal_to_itself"))
    other = sets.same_rows(a, m.splits.select("ticker", "event_date")).select("equal").scalar()
    return same.withColumn("equal_to_other", other)
