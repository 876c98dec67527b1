"""Declared types of the core tables, how they relate, and the entity dictionary."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L, _B, _DT, _TS = (
    T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType(), T.DateType(), T.TimestampNTZType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TICKERS = _struct(ticker=_S, name=_S, sector=_S, exchange=_S, longname=_S, industry=_S, city=_S,
                  state=_S, country=_S)
PRICES_DAILY = _struct(date=_DT, ticker=_S, open=_D, high=_D, low=_D, close=_D, volume=_L, vwap=_D,
                       transactions=_L)
DIVIDENDS = _struct(ticker=_S, event_date=_DT, ex_dividend_date=_DT, pay_date=_DT, record_date=_DT,
                    cash_amount=_D)
SPLITS = _struct(ticker=_S, event_date=_DT, execution_date=_DT, split_from=_D, split_to=_D)
REF_TICKERS = _struct(ticker=_S, company_name=_S, industry=_S, sector=_S, locale=_S, market=_S,
                      primary_exchange=_S)
TRADING_CALENDAR = _struct(exchange=_S, date=_DT, is_open=_B, market_open_utc=_TS,
                           market_close_utc=_TS, market_open_ny=_TS, market_close_ny=_TS)
PORTFOLIO = _struct(ticker=_S, shares=_D, avg_cost=_D)
CORPUS = T.StructType([
    T.StructField("id", _S), T.StructField("split", _S), T.StructField("question", _S),
    T.StructField("sql", _S), T.StructField("intents", T.ArrayType(_S)),
    T.StructField("tables", T.ArrayType(_S)),
])

# Landed payloads: one row per API page.
BARS_PAYLOAD = T.StructType([
    T.StructField("ticker", _S),
    T.StructField("results", T.ArrayType(_struct(t=_L, o=_D, h=_D, l=_D, c=_D, v=_D, vw=_D, n=_L))),
])
DIVIDENDS_PAYLOAD = T.StructType([
    T.StructField("ticker", _S),
    T.StructField("results", T.ArrayType(_struct(
        declaration_date=_S, ex_dividend_date=_S, pay_date=_S, record_date=_S, cash_amount=_S))),
])
SPLITS_PAYLOAD = T.StructType([
    T.StructField("ticker", _S),
    T.StructField("results", T.ArrayType(_struct(execution_date=_S, split_from=_S, split_to=_S))),
])
STATUS_PAYLOAD = _struct(exchange=_S, date=_S, status=_S, open=_S, close=_S)

# One request: what to compute, for which assets, over which time. Arguments are read as text: models write 1998 or "1998".
REQUEST = T.StructType([
    T.StructField("intent", _S),
    T.StructField("entities", T.StructType([
        T.StructField("assets", T.ArrayType(_S)), T.StructField("benchmark", _S)])),
    T.StructField("metric", T.StructType([
        T.StructField("name", _S), T.StructField("type", _S),
        T.StructField("arguments", T.StructType([
            T.StructField(name, _S) for name in ("year", "month", "start_date", "end_date", "window", "window_unit")]))])),
    T.StructField("time", T.StructType([
        T.StructField("range", T.StructType([
            T.StructField("type", _S), T.StructField("value", _S),
            T.StructField("start", _S), T.StructField("end", _S)]))])),
    T.StructField("filters", T.ArrayType(_struct(field=_S, op=_S, value=_S))),
    T.StructField("output", _struct(format=_S)),
])

CORE = {
    "tickers": TICKERS,
    "prices_daily": PRICES_DAILY,
    "dividends": DIVIDENDS,
    "splits": SPLITS,
    "ref_tickers": REF_TICKERS,
    "trading_calendar": TRADING_CALENDAR,
    "portfolio": PORTFOLIO,
}

# Primary keys. (ticker, date) bounds a ticker's series by the number of calendar days.
KEYS = {
    "tickers": ["ticker"],
    "prices_daily": ["ticker", "date"],
    "trading_calendar": ["exchange", "date"],
    "portfolio": ["ticker"],
}

# Default joins: (left, right) -> (pairs of columns, how).
RELATIONS = {
    ("prices_daily", "tickers"): ([("ticker", "ticker")], "left"),
    ("prices_daily", "dividends"): ([("ticker", "ticker"), ("date", "event_date")], "left"),
    ("prices_daily", "splits"): ([("ticker", "ticker"), ("date", "event_date")], "left"),
    ("prices_daily", "trading_calendar"): ([("date", "date")], "left"),
    ("prices_daily", "portfolio"): ([("ticker", "ticker")], "inner"),
    ("tickers", "ref_tickers"): ([("ticker", "ticker")], "left"),
}

# Which table a metric reads, and the metric an intent means when it names none.
PRICE_FIELDS = ["close", "open", "high", "low", "volume", "vwap"]
INTENT_METRIC = {
    "get_price": "close",
    "get_last_price": "close",
    "get_return": "daily_return",
    "get_ytd_return": "ytd_return",
    "get_mtd_return": "mtd_return",
    "get_dividends": "dividend_amount",
    "evaluate_portfolio": "portfolio_value",
    "portfolio_performance": "portfolio_value",
    "rolling_stat": "rolling_volatility",
}
