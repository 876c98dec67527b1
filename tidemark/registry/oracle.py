"""SQL of the core tables for the checks: ``sql(body)`` puts the tables a body names in front of it."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rounding edge of snap: away from exact halves, where the last bit of a sum would decide.
SNAP_EDGE = 0.4637

TABLES: dict[str, str] = {
    "prices_daily": """
select d as date, ticker, open, high, low, close, volume, vwap, transactions from (
  select cast(l_shipdate as date) d, concat('S', cast(l_suppkey as varchar(20))) ticker,
    max(case when rn_a = 1 then px end) open, max(px) high, min(px) low,
    max(case when rn_d = 1 then px end) close, cast(sum(l_quantity) as bigint) volume,
    sum(l_extendedprice) / sum(l_quantity) vwap, count(*) transactions
  from (select *, l_extendedprice / l_quantity px,
      row_number() over (partition by l_suppkey, l_shipdate
        order by l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) rn_a,
      row_number() over (partition by l_suppkey, l_shipdate
        order by l_orderkey desc, l_linenumber desc, l_partkey desc, l_extendedprice desc, l_quantity desc) rn_d
    from lineitem) t
  group by 1, 2) u""",
    "dividends": """
select ticker, coalesce(pay_date, ex_dividend_date) event_date, ex_dividend_date, pay_date, record_date, cash_amount
from (
  select concat('S', cast(l_suppkey as varchar(20))) ticker, cast(l_shipdate as date) ex_dividend_date,
    case when max(l_quantity) > 40 then cast(l_shipdate as date) end pay_date,
    cast(l_shipdate as date) record_date, round(sum(l_tax) * 10, 4) cash_amount
  from lineitem where l_returnflag = 'R' and l_linenumber = 1 group by l_suppkey, l_shipdate) t""",
    "splits": """
select concat('S', cast(l_suppkey as varchar(20))) ticker, cast(l_shipdate as date) event_date,
  cast(l_shipdate as date) execution_date, cast(1 as double) split_from,
  cast(2 + max(l_partkey) % 3 as double) split_to
from lineitem where l_linenumber = 7 and l_discount >= 0.09 group by l_suppkey, l_shipdate""",
    "tickers": """
select concat('S', cast(s_suppkey as varchar(20))) ticker, s_name as name, r_name sector, n_name industry,
  case when s_suppkey % 2 = 0 then 'NYSE' else 'NASDAQ' end exchange
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "ref_tickers": """
select concat('S', cast(s_suppkey as varchar(20))) ticker, concat(s_name, ' Corp') company_name,
  n_name industry, cast(null as varchar) sector, 'us' locale, 'stocks' market,
  case when s_suppkey % 2 = 0 then 'XNYS' else 'XNAS' end primary_exchange
from supplier join nation on s_nationkey = n_nationkey where s_acctbal > 0""",
    "portfolio": """
select concat('S', cast(s_suppkey as varchar(20))) ticker, cast(10 + s_suppkey as double) shares,
  cast(1000 + s_suppkey * 7 as double) avg_cost
from supplier where s_acctbal > 5000""",
    "trading_calendar": """
select e.exchange, d.date,
  (dayofweek(d.date) between 1 and 5 and strftime(d.date, '%m-%d') not in ('01-01', '07-04', '12-25'))
    or (dayofweek(d.date) = 6 and e.exchange = 'nasdaq') is_open,
  d.date + interval '14 hours 30 minutes' market_open_utc, d.date + interval '21 hours' market_close_utc
from (select distinct cast(l_shipdate as date) as date from lineitem) d
cross join (select 'nyse' exchange union all select 'nasdaq') e""",
    "daily_returns": """
select date, ticker, close / nullif(lag(close) over (partition by ticker order by date), 0) - 1 ret
from prices_daily""",
    "prices_weekly": """
select ticker, cast(date_trunc('week', date) as date) as week, arg_min(open, date) open, max(high) high,
  min(low) low, arg_max(close, date) as close, cast(sum(volume) as bigint) volume, arg_max(vwap, date) vwap
from prices_daily group by 1, 2""",
    "prices_monthly": """
select ticker, cast(date_trunc('month', date) as date) as month, arg_min(open, date) open, max(high) high,
  min(low) low, arg_max(close, date) as close, cast(sum(volume) as bigint) volume, arg_max(vwap, date) vwap
from prices_daily group by 1, 2""",
    "corporate_actions": """
select 'dividend' action_type, ticker, event_date, cash_amount, cast(null as double) split_from,
  cast(null as double) split_to from dividends
union all
select 'split', ticker, event_date, null, split_from, split_to from splits""",
    "ttm_yields": """
select date, ticker, close, cash_ttm, case when close > 0 then cash_ttm / close end dividend_yield_ttm from (
  select date, ticker, close, sum(coalesce(cash_amount, 0)) over (partition by ticker order by date
    range between interval 365 days preceding and current row) cash_ttm
  from prices_daily left join (select ticker, event_date as date, cash_amount from dividends) v
  using (ticker, date)) t""",
    "bars_with_factor": """
select ticker, date, close, coalesce(f, 1.0) factor from prices_daily left join (
  select ticker, event_date as date,
    case when split_from > 0 and split_to > 0 then split_from / split_to else 1.0 end f from splits) s
using (ticker, date)""",
    "adjusted_prices": """
select ticker, date, close, exp(sum(case when factor > 0 then log10(factor) else 0 end) over (
  partition by ticker order by date rows unbounded preceding)) cum_adj_factor from bars_with_factor""",
    "held_values": """
select ticker, shares, avg_cost, last_close, shares * last_close market_value,
  shares * (last_close - avg_cost) unrealized_pnl
from portfolio join (select ticker, arg_max(close, date) last_close from prices_daily group by 1) l using (ticker)""",
}


def _needed(body: str, found: list[str]) -> None:
    for name, text in TABLES.items():
        if name not in found and re.search(rf"\b{name}\b", body) and text != body:
            _needed(text, found)
            found.append(name)


def define(name: str, text: str) -> None:
    """Adds a table the bodies after this call may name."""
    TABLES[name] = text


def snap(x: Column, digits: int) -> Column:
    """Rounds to a decimal grid by one scaled floor.

    Sums of doubles differ in their last bit with the order of rows. Exact decimal halves are common in
    prices, so the edge between two grid points lies a little off the half.
    """
    scale = float(10 ** digits)
    return F.floor(x * scale + SNAP_EDGE) / scale


def _snapped(text: str) -> str:
    """Spells round(x, d) as the scaled floor of ``snap``."""
    while (at := text.find("round(")) >= 0:
        depth, commas, i = 1, [], at + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(text[i], 0)
            if text[i] == "," and depth == 1:
                commas.append(i)
            i += 1
        x, digits = text[at + 6:commas[-1]], text[commas[-1] + 1:i - 1].strip()
        text = f"{text[:at]}(floor(({x}) * 1e{digits} + {SNAP_EDGE}) / 1e{digits}){text[i:]}"
    return text


def sql(body: str) -> str:
    """The body with a WITH clause of every core table it names; a body may start with its own WITH."""
    body = _snapped(body.strip())
    own = body.lower().startswith("with ")
    found: list[str] = []
    _needed(body, found)
    if not found:
        return body
    tables = ",\n".join(f"{name} as ({TABLES[name].strip()})" for name in found)
    return f"with recursive {tables}" + (",\n" + body[5:] if own else "\n" + body)
