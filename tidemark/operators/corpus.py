"""Question/SQL corpora: drawing parameters, writing pairs, keeping those with rows, splitting."""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.staging import landed
from tidemark.functions.text import identifier_tokens, tokens
from tidemark.operators.ranking import first_of_each_text, seeded_hash, split_by_share


@dataclass(frozen=True)
class Template:
    """One kind of question. ``needs`` names the rows that must exist for its query to return any."""

    intent: str
    question: str
    sql: str
    needs: str
    tables: tuple[str, ...] = ("core.prices_daily",)


_SERIES = "select date, ticker, close / lag(close) over (partition by ticker order by date) - 1 as ret from core.prices_daily"
_HELD = ("select p.ticker, p.shares, d.close as price, p.shares * d.close as position_value from portfolio p "
         "join core.prices_daily d on d.ticker = p.ticker where d.date = "
         "(select max(date) from core.prices_daily where date <= '{day}')")
_BOTH = ("core.prices_daily", "core.tickers")
_HOLD = ("portfolio", "core.prices_daily")

# The kinds of questions and how each is worded.
TEMPLATES = (
    Template("point_lookup", "Show OHLCV for {ticker} on its first trading day.",
             "select * from core.prices_daily where ticker = '{ticker}' order by date limit 1", "ticker"),
    Template("latest_point", "Latest close and volume for {ticker}.",
             "select date, close, volume from core.prices_daily where ticker = '{ticker}' order by date desc limit 1", "ticker"),
    Template("delta_window", "7-day and 30-day returns for {ticker}.",
             "select date, ticker, close, close / lag(close, 7) over w - 1 as r7, close / lag(close, 30) over w - 1 as r30 "
             "from core.prices_daily where ticker = '{ticker}' window w as (order by date)", "ticker"),
    Template("sector_on_date", "Average close and total volume for sector {sector} on {day}.",
             "select avg(p.close) as avg_close, sum(p.volume) as total_volume from core.prices_daily p "
             "join core.tickers t on t.ticker = p.ticker where t.sector = '{sector}' and p.date = '{day}'", "always", _BOTH),
    Template("resample_weekly", "Weekly OHLCV for {ticker} in week {day}.",
             "select * from views.prices_weekly where ticker = '{ticker}' and week = date_trunc('week', date '{day}')",
             "ticker_week", ("views.prices_weekly",)),
    Template("resample_monthly", "Monthly OHLCV for {ticker} in {day}.",
             "select * from views.prices_monthly where ticker = '{ticker}' and month = date_trunc('month', date '{day}')",
             "ticker_month", ("views.prices_monthly",)),
    Template("calendar_filter", "Was NYSE open on {day}?",
             "select is_open from core.trading_calendar where exchange = 'nyse' and date = '{day}'", "calendar_day",
             ("core.trading_calendar",)),
    Template("dividend_yield", "Dividend yield TTM time series for {ticker}.",
             "select date, dividend_yield_ttm from views.dividend_yield_ttm where ticker = '{ticker}' order by date",
             "ticker", ("views.dividend_yield_ttm",)),
    Template("corporate_actions", "Corporate actions for {ticker} ordered by date.",
             "select * from views.corporate_actions where ticker = '{ticker}' order by event_date", "actions",
             ("views.corporate_actions",)),
    Template("adjusted_price", "Split-adjusted close series for {ticker}.",
             "select date, close_adj_splits from views.adjusted_prices_splits where ticker = '{ticker}' order by date",
             "ticker", ("views.adjusted_prices_splits",)),
    Template("top_k_gainers", "Top {k} gainers by daily return on {day}.",
             f"with r as ({_SERIES} where date <= '{{day}}') select ticker, ret from r where date = '{{day}}' "
             "order by ret desc limit {k}", "day"),
    Template("avg_between_dates", "Average close for {ticker} from {start} to {end}.",
             "select avg(close) as avg_close from core.prices_daily where ticker = '{ticker}' "
             "and date between '{start}' and '{end}'", "always"),
    Template("join_dividends", "Close price and dividend cash for {ticker} between {start} and {end}.",
             "select p.date, p.close, coalesce(d.cash_amount, 0) as cash_amount from core.prices_daily p "
             "left join core.dividends d on d.ticker = p.ticker and d.event_date = p.date "
             "where p.ticker = '{ticker}' and p.date between '{start}' and '{end}'", "ticker_range",
             ("core.prices_daily", "core.dividends")),
    Template("join_splits", "Close price and split factors for {ticker} between {start} and {end}.",
             "select p.date, p.close, s.split_from / s.split_to as split_factor from core.prices_daily p "
             "left join core.splits s on s.ticker = p.ticker and s.event_date = p.date "
             "where p.ticker = '{ticker}' and p.date between '{start}' and '{end}'", "ticker_range",
             ("core.prices_daily", "core.splits")),
    Template("ytd", "Year-to-date cumulative return for {ticker}.",
             f"with r as ({_SERIES} where ticker = '{{ticker}}') select date, exp(sum(ln(1 + ret)) over "
             "(partition by year(date) order by date)) - 1 as cum_ret_ytd from r", "ticker"),
    Template("profile", "Company profile for {ticker} including sector and exchange.",
             "select t.*, r.company_name from core.tickers t left join core.ref_tickers r on r.ticker = t.ticker "
             "where t.ticker = '{ticker}'", "always", ("core.tickers", "core.ref_tickers")),
    Template("membership", "Tickers in sector {sector} that traded on {day}.",
             "select distinct p.ticker from core.prices_daily p join core.tickers t on t.ticker = p.ticker "
             "where p.date = '{day}' and t.sector = '{sector}'", "sector_day", _BOTH),
    Template("latest_price", "What was the latest closing price of {ticker} as of {day}?",
             "select ticker, date, close from core.prices_daily where ticker = '{ticker}' and date <= '{day}' "
             "order by date desc limit 1", "ticker_before"),
    Template("daily_return", "What was the daily return of {ticker} on {day}?",
             f"with daily_returns as ({_SERIES} where ticker = '{{ticker}}') select * from daily_returns where date = '{{day}}'",
             "ticker_day"),
    Template("range_return", "What was the return of {ticker} between {start} and {end}?",
             "select ticker, max(close) / min(close) - 1 as period_return from core.prices_daily "
             "where ticker = '{ticker}' and date between '{start}' and '{end}' group by ticker", "ticker_range"),
    Template("ytd_return", "What is the year-to-date return of {ticker} for {year}?",
             "select ticker, max(close) / min_by(close, date) - 1 as ytd_return from core.prices_daily "
             "where ticker = '{ticker}' and extract(year from date) = {year} group by ticker", "ticker_year"),
    Template("sector_aggregate", "What was the average return for the {sector} sector between {start} and {end}?",
             f"with r as ({_SERIES} where date between '{{start}}' and '{{end}}') select avg(ret) as avg_daily_return "
             "from r join core.tickers t on t.ticker = r.ticker where t.sector = '{sector}'", "always", _BOTH),
    Template("dividends_history", "Show the dividend history for {ticker} between {start} and {end}.",
             "select ticker, ex_dividend_date, cash_amount from core.dividends where ticker = '{ticker}' "
             "and ex_dividend_date between '{start}' and '{end}'", "dividends_range", ("core.dividends",)),
    Template("splits_history", "Show the split history for {ticker} between {start} and {end}.",
             "select ticker, event_date, split_to / split_from as ratio from core.splits where ticker = '{ticker}' "
             "and event_date between '{start}' and '{end}'", "splits_range", ("core.splits",)),
    Template("portfolio_value_latest", "What is the total value of my portfolio as of {day}?",
             f"select sum(position_value) as portfolio_value from ({_HELD})", "always", _HOLD),
    Template("portfolio_top_k", "Show the top {k} positions in my portfolio by market value as of {day}.",
             f"{_HELD} order by position_value desc limit {{k}}", "held_day", _HOLD),
    Template("portfolio_sector_breakdown", "What is my portfolio sector allocation by value as of {day}?",
             f"select t.sector, sum(h.position_value) as sector_value from ({_HELD}) h "
             "join core.tickers t on t.ticker = h.ticker group by t.sector", "held_day", (*_HOLD, "core.tickers")),
    Template("latest_price_and_ytd", "What is the latest price and the year-to-date return of {ticker} for {year}?",
             "select ticker, max(date) as latest_date, max_by(close, date) as latest_price, "
             "max(close) filter (where extract(year from date) = {year}) as best from core.prices_daily "
             "where ticker = '{ticker}' group by ticker", "ticker"),
)
PARAMETERS = ("ticker", "sector", "day", "start", "end", "year", "k")
TOP_K = (5, 10, 20)


def uniform(seed: int, salt: str, *cols: str) -> Column:
    """A repeatable whole number from 0 to 2**32 - 1."""
    digest = F.md5(F.concat(F.lit(f"{seed}{salt}"), *[F.col(c).cast("string") for c in cols]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


#: Rows that a list of values is repeated to, at least, so that draws of a short list meet many keys.
_LIST_ROWS = 1024


def _lists(tickers: DataFrame, days: DataFrame) -> DataFrame:
    """Landed: name, value, at for the tickers, sectors and days that a draw picks from, each list numbered from 0 in a
    pseudo-random order. A list is a market's: a window over it is bounded."""
    listed = functools.reduce(DataFrame.union, [
        rows.select(F.lit(name).alias("name"), F.col(column).cast("string").alias("value"))
        for name, rows, column in (("ticker", tickers, "ticker"), ("sector", tickers, "sector"), ("day", days, "date"))])
    listed = listed.filter("value is not null").distinct()  # a draw never lands on a missing value
    order = W.partitionBy("name").orderBy(F.md5("value"), "value")
    return landed(listed.withColumn("at", F.row_number().over(order) - 1), "lists")


def draws(spark, tickers: DataFrame, days: DataFrame, per_template: int, seed: int) -> DataFrame:
    """``per_template`` rows per template with pseudo-random parameters from the catalog and the days.

    A draw is five numbers, one for each thing it picks; all picks of all draws meet the lists in one equi join.
    """
    listed = _lists(tickers, days)
    size = {r["name"]: r["n"] for r in listed.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}  # three rows
    picks = {"ticker": "ticker", "sector": "sector", "day": "day", "one": "day", "two": "day"}
    times = {name: -(-_LIST_ROWS // size.get(name, 1)) for name in picks.values()}
    rows = spark.range(len(TEMPLATES) * per_template if len(size) == 3 else 0).select(
        F.floor(F.col("id") / per_template).cast("int").alias("template"), (F.col("id") % per_template).alias("draw"))
    asked = rows.withColumn("pick", F.explode(F.array(*[F.struct(
        F.lit(pick).alias("pick"), F.lit(name).alias("name"),
        (uniform(seed, pick, "template", "draw") % (size.get(name, 1) * times[name])).alias("at")) for pick, name in picks.items()])))
    again = F.lit(0)
    for name, n in times.items():
        again = F.when(F.col("name") == name, n - 1).otherwise(again)
    spread = listed.withColumn("time", F.explode(F.sequence(F.lit(0), again)))
    n = F.lit(0)
    for name in times:
        n = F.when(F.col("name") == name, size.get(name, 1)).otherwise(n)
    spread = spread.select("name", (F.col("at") + F.col("time") * n).cast("long").alias("at"), "value")
    met = asked.select("template", "draw", "pick.*").join(spread, ["name", "at"])
    picked = met.groupBy("template", "draw").agg(*[F.max(F.when(F.col("pick") == p, F.col("value"))).alias(p) for p in picks])
    k = F.element_at(F.array(*[F.lit(n) for n in TOP_K]), (uniform(seed, "k", "template", "draw") % len(TOP_K) + 1).cast("int"))
    day, one, two = (F.to_date(p) for p in ("day", "one", "two"))
    return picked.select("template", "draw", "ticker", "sector", day.alias("day"), F.least(one, two).alias("start"),
                         F.greatest(one, two).alias("end"), F.year(day).alias("year"), k.alias("k"))


def _filled(pattern: Column) -> Column:
    for name in PARAMETERS:
        pattern = F.replace(pattern, F.lit("{" + name + "}"), F.col(name).cast("string"))
    return pattern


def pairs(drawn: DataFrame) -> DataFrame:
    """Writes question and SQL of each draw; the templates are a literal array, looked up by number."""
    known = F.array(*[F.struct(F.lit(t.intent).alias("intent"), F.lit(t.question).alias("question"),
                               F.lit(t.sql).alias("sql"), F.lit(t.needs).alias("needs"),
                               F.array(*[F.lit(x) for x in t.tables]).alias("tables")) for t in TEMPLATES])
    rows = drawn.withColumn("t_", F.element_at(known, F.col("template") + 1))
    return rows.select(*drawn.columns, F.col("t_.intent").alias("intent"), _filled(F.col("t_.question")).alias("question"),
                       _filled(F.col("t_.sql")).alias("sql"), F.col("t_.needs").alias("needs"),
                       F.col("t_.tables").alias("tables"))


#: Needs that ask for an event of the ticker within a range.
_RANGED = ("ticker_range", "dividends_range", "splits_range")
_LAST = "last"


def _key(need: Column | str, k1: Column | str, k2: Column | str = "", before: Column | None = None, mask: Column | None = None) -> Column:
    text = lambda c: (F.lit(c) if isinstance(c, str) else c).cast("string")
    return F.struct(text(need).alias("need"), text(k1).alias("k1"), text(k2).alias("k2"),
                    (F.lit(None) if before is None else before).cast("date").alias("before"),
                    (F.lit(None) if mask is None else mask).cast("long").alias("mask"))


def typed_keys(prices: DataFrame, dividends: DataFrame, splits: DataFrame, tickers: DataFrame, portfolio: DataFrame,
               calendar: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """What exists, as one table of typed keys: need, k1, k2, before, mask. With ``wanted`` (need, k1, k2) only those keys, and
    no others are aggregated.

    Bars, dividends and splits are first one row per ticker and month: a mask of the days with an event, and the last one.
    From that row come the keys of single days, weeks, months and years, and for ranges a key for every month from the
    ticker's first to its last event, with the last event before it and its own mask, and one key for all later months.
    """
    events = functools.reduce(DataFrame.union, [
        rows.select(F.lit(need).alias("need"), "ticker", F.col(day).alias("date"))
        for need, rows, day in zip(_RANGED, (prices, dividends, splits), ("date", "ex_dividend_date", "event_date"))])
    months = events.groupBy("need", "ticker", F.trunc("date", "month").alias("month")).agg(
        F.bit_or(F.expr("shiftleft(1L, day(date) - 1)")).alias("mask"), F.max("date").alias("last"))
    in_order = W.partitionBy("need", "ticker").orderBy("month")
    rows = (months.withColumns({"before": F.lag("last").over(in_order), "next": F.lead("month").over(in_order)})
            .join(tickers.select("ticker", "sector"), "ticker", "left")
            .join(portfolio.select("ticker").distinct().withColumn("held", F.lit(True)), "ticker", "left"))
    need, ticker, month, last = (F.col(c) for c in ("need", "ticker", "month", "last"))
    nothing = F.array().cast("array<struct<need:string,k1:string,k2:string,before:date,mask:bigint>>")
    dates = F.expr("transform(filter(sequence(0, 30), i -> shiftright(mask, i) & 1 = 1), i -> date_add(month, i))")
    each = lambda key: F.coalesce(F.transform(dates, key), nothing)
    of_bars = F.concat(
        F.array(_key("ticker", ticker), _key("ticker_month", ticker, month), _key("ticker_year", ticker, F.year("month"))),
        each(lambda d: _key("ticker_day", ticker, d)), each(lambda d: _key("ticker_week", ticker, F.trunc(d, "week"))),
        each(lambda d: _key("day", d)), each(lambda d: _key("sector_day", F.col("sector"), d)),
        F.when(F.col("held"), each(lambda d: _key("held_day", d))).otherwise(nothing))
    spine = F.when(F.col("next").isNull(), F.array(month)).otherwise(
        F.sequence(month, F.add_months("next", -1), F.expr("interval 1 month")))
    own = F.when(month.isNull(), nothing).otherwise(F.concat(
        F.transform(spine, lambda m: _key(need, ticker, m, F.when(m == month, F.col("before")).otherwise(last),
                                          F.when(m == month, F.col("mask")).otherwise(F.lit(0)))),
        F.when(F.col("next").isNull(), F.array(_key(need, ticker, _LAST, last))).otherwise(nothing)))
    of_kind = F.when(need == _RANGED[0], of_bars).otherwise(F.array(_key("actions", ticker)))
    keys = rows.select(F.inline(F.concat(of_kind, own)))
    open_days = calendar.filter("exchange = 'nyse'").select(F.inline(F.array(_key("calendar_day", F.col("date")))))
    keys = keys.union(open_days)
    if wanted is not None:
        keys = keys.join(wanted, ["need", "k1", "k2"], "left_semi")
    return keys.groupBy("need", "k1", "k2").agg(F.max("before").alias("before"), F.max("mask").alias("mask"))


def answerable(rows: DataFrame, prices: DataFrame, dividends: DataFrame, splits: DataFrame, tickers: DataFrame,
               portfolio: DataFrame, calendar: DataFrame) -> DataFrame:
    """Keeps the pairs whose query returns rows, by one join of what each pair needs with the typed keys that exist.

    A pair that needs an event within a range looks up two keys, its last month and the time after all events; one of the
    two holds at most.
    """
    need, day, end = F.col("needs"), F.col("day"), F.col("end")
    ticker = F.col("ticker")
    ask = lambda kind, k1, k2="": F.array(_key(kind, k1, k2))
    asked = F.array(_key("", F.xxhash64(*rows.columns)))  # meets nothing, and no other pair
    for kind, keys in {
        "ticker": ask("ticker", ticker), "ticker_day": ask("ticker_day", ticker, day),
        "ticker_week": ask("ticker_week", ticker, F.trunc("day", "week")),
        "ticker_month": ask("ticker_month", ticker, F.trunc("day", "month")), "ticker_year": ask("ticker_year", ticker, F.col("year")),
        "calendar_day": ask("calendar_day", day), "day": ask("day", day), "sector_day": ask("sector_day", F.col("sector"), day),
        "held_day": ask("held_day", day), "actions": ask("actions", ticker),
        "ticker_before": F.array(_key(_RANGED[0], ticker, F.trunc("day", "month")), _key(_RANGED[0], ticker, _LAST)),
        **{kind: F.array(_key(kind, ticker, F.trunc("end", "month")), _key(kind, ticker, _LAST)) for kind in _RANGED},
    }.items():
        asked = F.when(need == kind, keys).otherwise(asked)
    until = need == "ticker_before"
    looked = landed(rows.withColumns({
        "key_": F.explode(asked), "low_": F.when(until, F.lit("0001-01-01").cast("date")).otherwise(F.col("start")),
        "high_": F.when(until, day).otherwise(end)}), "looked-up")
    wanted = looked.select("key_.need", "key_.k1", "key_.k2").distinct()
    known = typed_keys(prices, dividends, splits, tickers, portfolio, calendar, wanted).toDF("n_", "a_", "b_", "before_", "mask_")
    found = looked.join(known, (F.col("key_.need") == F.col("n_")) & (F.col("key_.k1") == F.col("a_"))
                        & (F.col("key_.k2") == F.col("b_")), "left")
    month = F.trunc("high_", "month")
    in_month = F.expr("shiftright(mask_ & (shiftleft(1L, day(high_)) - 1), "
                      "if(low_ >= trunc(high_, 'month'), day(low_) - 1, 0)) <> 0 and low_ <= high_")
    earlier = (F.col("before_") < month) & (F.col("before_") >= F.col("low_"))
    in_range = F.when(F.col("b_") == _LAST, earlier).otherwise(in_month | earlier)
    good = F.when(need == "always", True).when(need.isin("ticker_before", *_RANGED), in_range).otherwise(F.col("n_").isNotNull())
    return found.filter(F.coalesce(good, F.lit(False))).select(*rows.columns)


def distinct_pairs(rows: DataFrame) -> DataFrame:
    """One pair per SQL text: the first drawn."""
    return first_of_each_text(rows, "sql", ["template", "draw"])


def train_val_test(rows: DataFrame, seed: int = 321, key: str = "id") -> DataFrame:
    return split_by_share(rows, {"train": 0.8, "val": 0.1, "test": 0.1}, seed, key)


def metadata(rows: DataFrame) -> DataFrame:
    """Pairs per split and intent, per split and per intent in all, from one small cube of counts."""
    counts = rows.groupBy("split", "intent").agg(F.count(F.lit(1)).alias("n"))
    return counts.cube("split", "intent").agg(F.sum("n").alias("n")).select(
        F.coalesce("split", F.lit("all")).alias("split"), F.coalesce("intent", F.lit("all")).alias("intent"), "n")


def sql_training_text(question: Column, sql: Column) -> Column:
    return F.concat(F.lit("### Question:\n"), question, F.lit("\n\n### SQL:\n"), sql)


def request_training_text(question: Column, request: Column) -> Column:
    return F.concat(F.lit("Question: "), question, F.lit("\nIR:\n"), F.to_json(request))


def token_counts(text: DataFrame, column: str) -> DataFrame:
    return text.select(F.explode(tokens(F.col(column))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def schema_tokens(columns: DataFrame) -> DataFrame:
    """Words of every table.column name."""
    return columns.select("table_name", "column_name", F.explode(F.concat(
        identifier_tokens(F.col("table_name")), identifier_tokens(F.col("column_name")))).alias("token"))


def synthetic_portfolio(tickers: DataFrame, size: int = 30, seed: int = 42) -> DataFrame:
    """Pseudo-random holdings: whole shares from 5 to 500, cost from 20 to 400."""
    chosen = tickers.select("ticker").distinct().orderBy(seeded_hash(seed, "ticker"), "ticker").limit(size)
    shares = (uniform(seed, "shares", "ticker") % 496 + 5).cast("double")
    cost = uniform(seed, "cost", "ticker") / float(2 ** 32) * 380 + 20
    return chosen.select("ticker", shares.alias("shares"), cost.alias("avg_cost"))
