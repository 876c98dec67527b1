"""Joins beyond a plain equi join: as-of, range, calendar and declared joins.

No side is forced to broadcast. Spark compares each side's size with
``spark.sql.autoBroadcastJoinThreshold`` at planning time and again at run time (adaptive execution), and
otherwise sorts and merges, splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions.numbers import ratio
from tidemark.operators.series import by_date


def enriched(prices: DataFrame, tickers: DataFrame) -> DataFrame:
    return prices.join(tickers.select("ticker", "name", "sector", "exchange"), "ticker", "left").select(
        "date", "ticker", "open", "high", "low", "close", "volume", "vwap", "transactions", "name", "sector",
        "exchange")


def with_dividends(prices: DataFrame, dividends: DataFrame) -> DataFrame:
    """Bars with the dividend cash of their own date, 0 without one; several dividends fan out."""
    cash = dividends.select("ticker", F.col("event_date").alias("date"), "cash_amount")
    return (prices.join(cash, ["ticker", "date"], "left")
            .withColumn("cash_amount", F.coalesce("cash_amount", F.lit(0.0))))


def with_split_factor(prices: DataFrame, splits: DataFrame) -> DataFrame:
    """Bars with split_from / split_to of their own date, NULL without a valid split."""
    valid = (F.col("split_from") > 0) & (F.col("split_to") > 0)
    factor = splits.select("ticker", F.col("event_date").alias("date"),
                           F.when(valid, ratio(F.col("split_from"), F.col("split_to"))).alias("split_factor"))
    return prices.join(factor, ["ticker", "date"], "left")


def on_open_days(df: DataFrame, calendar: DataFrame, exchange: str | None = None) -> DataFrame:
    """Rows on days an exchange (any exchange, when none is named) was open."""
    days = calendar.filter("is_open")
    if exchange:
        days = days.filter(F.col("exchange") == exchange)
    return df.join(days.select("date"), "date", "left_semi")


def in_sector(prices: DataFrame, tickers: DataFrame, sector: str) -> DataFrame:
    return prices.join(tickers.filter(F.col("sector") == sector).select("ticker", "sector"), "ticker")


def company_profile(tickers: DataFrame, ref_tickers: DataFrame) -> DataFrame:
    ref = ref_tickers.select("ticker", "company_name", F.col("industry").alias("ref_industry"), "market",
                             "primary_exchange")
    return tickers.select("ticker", "name", "sector", "exchange").join(ref, "ticker", "left").select(
        "ticker", "name", "sector", "exchange", "company_name", F.col("ref_industry").alias("industry"), "market",
        "primary_exchange")


def edge_bars(prices: DataFrame, edge: str = "last", columns: Sequence[str] = ("close", "volume")) -> DataFrame:
    """Each ticker's first or last bar in one aggregation, without joining back."""
    pick = F.max_by if edge == "last" else F.min_by
    day = F.max("date") if edge == "last" else F.min("date")
    return prices.groupBy("ticker").agg(day.alias("date"), *[pick(c, "date").alias(c) for c in columns])


def holdings_at_last_close(portfolio: DataFrame, prices: DataFrame) -> DataFrame:
    last = prices.groupBy("ticker").agg(F.max_by("close", "date").alias("last_close"))
    return portfolio.join(last, "ticker")


def prices_on_market_date(prices: DataFrame, as_of) -> DataFrame:
    """ticker, price on the last market date at or before ``as_of``."""
    last = prices.filter(F.col("date") <= F.lit(as_of)).agg(F.max("date")).scalar()
    return prices.filter(F.col("date") == last).select("ticker", F.col("close").alias("price"))


def positions(portfolio: DataFrame, prices: DataFrame, as_of) -> DataFrame:
    return (portfolio.join(prices_on_market_date(prices, as_of), "ticker")
            .select("ticker", "shares", "price", (F.col("shares") * F.col("price")).alias("position_value")))


def as_of(requests: DataFrame, bars: DataFrame, day: str = "as_of", value: str = "close") -> DataFrame:
    """Each request's last bar at or before its day; NULLs where there is none.

    Bars become intervals [date, next date). An interval is listed under every month it touches, so a
    request meets only the bars around its own month: equi joins throughout, work linear in the
    requests however many fall on one ticker. The open interval after a ticker's last bar is one row
    per ticker, joined by itself.
    """
    closed = (bars.select("ticker", "date", value, F.lead("date").over(by_date()).alias("until"))
              .filter(F.col("until").isNotNull())
              .withColumn("month", F.explode(F.sequence(
                  F.trunc("date", "month"), F.trunc(F.date_sub("until", 1), "month"),
                  F.expr("interval 1 month"))))
              .select(F.col("ticker").alias("b_ticker"), "month", F.col("date").alias("b_date"), "until",
                      F.col(value).alias("b_value")))
    last = bars.groupBy("ticker").agg(F.max("date").alias("last_date"), F.max_by(value, "date").alias("last_value"))
    asked = requests.join(last, "ticker", "left")
    hit = ((F.col("ticker") == F.col("b_ticker")) & (F.trunc(day, "month") == F.col("month"))
           & (F.col(day) >= F.col("b_date")) & (F.col(day) < F.col("until")))
    after_last = F.col(day) >= F.col("last_date")
    return (asked.join(closed, hit, "left")
            .withColumn("date", F.when(after_last, F.col("last_date")).otherwise(F.col("b_date")))
            .withColumn(value, F.when(after_last, F.col("last_value")).otherwise(F.col("b_value")))
            .select(*requests.columns, "date", value))


def range_join(requests: DataFrame, bars: DataFrame, start: str = "start", end: str = "end",
               on: Sequence[str] = ("ticker",), parts: int | None = None) -> DataFrame:
    """Requests with the bars of their ticker (or other columns in common) dated within [start, end].

    Both sides carry a month number, so a request is compared only with bars of the months it covers, and
    a much asked ticker spreads over its months. Spark sizes tasks by what they read; where they return many
    times that, ``parts`` keeps so many of them.
    """
    def month(day: str) -> Column:
        return F.year(day) * 12 + F.month(day)

    asked = requests.withColumn("month_", F.explode(F.sequence(month(start), month(end))))
    dated = bars.withColumn("month_", month("date"))
    if parts:
        asked, dated = (side.repartition(parts, *on, "month_") for side in (asked, dated))
    return (asked.join(dated, [*on, "month_"])
            .filter(F.col("date").between(F.col(start), F.col(end))).drop("month_"))


def neighbour_open_days(days: DataFrame, calendar: DataFrame, day: str = "date") -> DataFrame:
    """For each day: the last open day at or before it and the next open day after it.

    Both come from the sorted list of open days carried along a calendar spine, one row per date.
    """
    open_days = calendar.filter("is_open").select(F.col("date").alias("open_day")).distinct()
    # Each open day opens an interval that ends before the following one; months split the key.
    # The list holds one row per date of the calendar, so a single ordered window is bounded.
    ordered = open_days.withColumn("all_", F.lit(0)).withColumn(
        "following", F.lead("open_day").over(by_date(["all_"], "open_day"))).drop("all_")
    spread = ordered.filter(F.col("following").isNotNull()).withColumn("month", F.explode(F.sequence(
        F.trunc("open_day", "month"), F.trunc(F.date_sub("following", 1), "month"), F.expr("interval 1 month"))))
    first_open = open_days.agg(F.min("open_day")).scalar()
    last_open = open_days.agg(F.max("open_day")).scalar()
    d = F.col(day)
    hit = (F.trunc(d, "month") == F.col("month")) & (d >= F.col("open_day")) & (d < F.col("following"))
    return (days.join(spread, hit, "left")
            .withColumn("last_trading_day", F.when(d >= last_open, last_open).otherwise(F.col("open_day")))
            .withColumn("next_trading_day", F.when(d < first_open, first_open).otherwise(F.col("following")))
            .select(*days.columns, "last_trading_day", "next_trading_day"))


def declared(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """A request's explicit join: keys written as "a" or "a AND b"."""
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unknown join type {how!r}")
    keys = [k.strip() for k in on.replace(" and ", " AND ").split(" AND ")]
    return left.join(right, keys, how)


def related(name_left: str, left: DataFrame, name_right: str, right: DataFrame) -> DataFrame:
    """Two core tables joined by their declared relation."""
    pairs, how = schema.RELATIONS[(name_left, name_right)]
    renamed = right
    for a, b in pairs:
        if a != b:
            renamed = renamed.withColumnRenamed(b, a)
    keys = [a for a, _ in pairs]
    clash = [c for c in renamed.columns if c in left.columns and c not in keys]
    return left.join(renamed.withColumnsRenamed({c: f"{name_right}_{c}" for c in clash}), keys, how)
