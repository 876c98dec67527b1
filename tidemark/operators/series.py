"""Per-ticker time series: lags, running and rolling windows.

Every window here is partitioned by ticker (and a period or a request where one is given) over a table
keyed by (ticker, date). A partition therefore holds at most one row per calendar day, whatever the
table's size: a century of bars is some 25 000 rows. All columns of one call share one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.numbers import growth, ratio

SERIES = ["ticker"]


def by_date(keys: Sequence[str] = SERIES, day: str = "date") -> WindowSpec:
    return W.partitionBy(*keys).orderBy(day)


def so_far(keys: Sequence[str] = SERIES, day: str = "date") -> WindowSpec:
    return by_date(keys, day).rowsBetween(W.unboundedPreceding, W.currentRow)


def last_rows(preceding: int, keys: Sequence[str] = SERIES, day: str = "date") -> WindowSpec:
    """The current row and ``preceding`` rows before it: preceding + 1 rows."""
    return by_date(keys, day).rowsBetween(-preceding, W.currentRow)


def daily_returns(prices: DataFrame) -> DataFrame:
    return prices.select(
        "date", "ticker", growth(F.col("close"), F.lag("close").over(by_date())).alias("ret"))


def lagged_returns(prices: DataFrame, rows: Sequence[int]) -> DataFrame:
    """close / close n rows earlier - 1, one column r<n> per n."""
    return prices.select("date", "ticker", "close", *[
        growth(F.col("close"), F.lag("close", n).over(by_date())).alias(f"r{n}") for n in rows])


def first_last_close(prices: DataFrame) -> DataFrame:
    """Each row with the first close so far and the series' last close."""
    whole = by_date().rangeBetween(W.unboundedPreceding, W.unboundedFollowing)
    return prices.select("date", "ticker", "close",
                         F.first("close").over(so_far()).alias("first_close"),
                         F.last("close").over(whole).alias("last_close"))


def log_return(ret: Column) -> Column:
    """ln(1 + ret), NULL for returns of -100 % or less."""
    factor = 1 + ret
    return F.when(factor > 0, F.ln(factor))


def compounded(ret: Column, window: WindowSpec) -> Column:
    """exp(sum(ln(1 + ret))) - 1 over a window; returns of -100 % or less are left out."""
    return F.exp(F.sum(log_return(ret)).over(window)) - 1


def rolling_volatility(returns: DataFrame, preceding: int, keys: Sequence[str] = SERIES) -> DataFrame:
    return returns.withColumn("rolling_vol", F.stddev_pop("ret").over(last_rows(preceding, keys)))


def rolling_return(returns: DataFrame, preceding: int, keys: Sequence[str] = SERIES) -> DataFrame:
    return returns.withColumn("rolling_ret", compounded(F.col("ret"), last_rows(preceding, keys)))


def cumulative_by_year(returns: DataFrame) -> DataFrame:
    """Compounded return since the start of each calendar year."""
    dated = returns.withColumn("year", F.year("date"))
    return dated.withColumn("cum_ret_ytd", compounded(F.col("ret"), so_far(["ticker", "year"]))).drop("year")


def trailing_sum(df: DataFrame, value: str, days: int, name: str) -> DataFrame:
    """Sum of ``value`` over dates from ``days`` days back to the row's own date, both included."""
    frame = (f"sum({value}) over (partition by ticker order by date "
             f"range between interval {int(days)} days preceding and current row)")
    return df.withColumn(name, F.expr(frame))


def windowed(df: DataFrame, aggregate: str, value: str, size: int, unit: str, name: str) -> DataFrame:
    """An aggregate over the last ``size`` units: rows for trading days, a date range otherwise.

    Months are counted by a calendar code in which a month has 31 days, so that the last n months are a range of whole
    numbers: the dates after the same day n months before.
    """
    if unit == "trading_days":
        col = getattr(F, aggregate)(value).over(last_rows(size - 1))
        return df.withColumn(name, col)
    if unit == "months":
        code = ((F.year("date") * 12 + F.month("date")) * 31 + F.dayofmonth("date")).cast("long")
        frame = W.partitionBy(*SERIES).orderBy(code).rangeBetween(1 - 31 * int(size), W.currentRow)
        return df.withColumn(name, getattr(F, aggregate)(value).over(frame))
    span = {"days": f"{int(size) - 1} days", "weeks": f"{7 * int(size) - 1} days"}[unit]
    frame = (f"{aggregate}({value}) over (partition by ticker order by date "
             f"range between interval {span} preceding and current row)")
    return df.withColumn(name, F.expr(frame))


def split_factors(prices: DataFrame, splits: DataFrame) -> DataFrame:
    """Bars with the split factor of their own date, 1 where there is none."""
    valid = (F.col("split_from") > 0) & (F.col("split_to") > 0)
    factors = splits.select("ticker", F.col("event_date").alias("date"),
                            F.when(valid, ratio(F.col("split_from"), F.col("split_to")))
                            .otherwise(1.0).alias("factor"))
    return (prices.select("ticker", "date", "close").join(factors, ["ticker", "date"], "left")
            .withColumn("factor", F.coalesce("factor", F.lit(1.0))))


def cumulative_split_factor(bars: DataFrame) -> DataFrame:
    """Running factor exp(sum(log10(factor))): base 10 inside, natural outside, kept as defined."""
    logs = F.sum(F.when(F.col("factor") > 0, F.log10("factor")).otherwise(0.0)).over(so_far())
    return bars.withColumn("cum_adj_factor", F.exp(logs))


def later_split_factor(bars: DataFrame) -> DataFrame:
    """Product of the factors of splits after the row's date."""
    later = by_date().rowsBetween(1, W.unboundedFollowing)
    logs = F.coalesce(F.sum(F.when(F.col("factor") > 0, F.ln("factor"))).over(later), F.lit(0.0))
    return bars.withColumn("later_factor", F.exp(logs))
