"""Core market tables derived from a star schema of shipped lines.

A supplier plays a ticker, a shipped line plays a trade. Lines are combined to one bar per supplier and
day with aggregates only, so a supplier that holds much of the table shrinks map-side.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio, to_long
from tidemark.operators.cleaning import core_calendar, new_york_hours

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


class Market:
    """The driver's tables and the core tables built on them, all lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _lines(self) -> DataFrame:
        return self.table("lineitem").withColumn("date", F.to_date("l_shipdate"))

    @staticmethod
    def _ticker(key: str):
        return F.concat(F.lit("S"), F.col(key).cast("string"))

    @cached_property
    def prices_daily(self) -> DataFrame:
        price = ratio(F.col("l_extendedprice"), F.col("l_quantity"))
        order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
        bars = self._lines.groupBy("l_suppkey", "date").agg(
            F.min(order).alias("first"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max(order).alias("last"),
            to_long(F.sum("l_quantity")).alias("volume"),
            ratio(F.sum("l_extendedprice"), F.sum("l_quantity")).alias("vwap"),
            F.count(F.lit(1)).alias("transactions"))
        open_, close = (ratio(F.col(f"{edge}.l_extendedprice"), F.col(f"{edge}.l_quantity")) for edge in ("first", "last"))
        return bars.select("date", self._ticker("l_suppkey").alias("ticker"), open_.alias("open"), "high", "low",
                           close.alias("close"), "volume", "vwap", "transactions")

    @cached_property
    def raw_dividends(self) -> DataFrame:
        lines = self._lines.filter((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1))
        paid = F.when(F.max("l_quantity") > 40, F.col("date"))
        return lines.groupBy("l_suppkey", "date").agg(
            paid.alias("pay_date"), F.round(F.sum("l_tax") * 10, 4).alias("cash_amount")).select(
            self._ticker("l_suppkey").alias("ticker"), F.lit(None).cast("date").alias("declaration_date"),
            F.col("date").alias("ex_dividend_date"), "pay_date", F.col("date").alias("record_date"),
            "cash_amount")

    @cached_property
    def dividends(self) -> DataFrame:
        return self.raw_dividends.select(
            "ticker", F.coalesce("pay_date", "ex_dividend_date").alias("event_date"), "ex_dividend_date",
            "pay_date", "record_date", "cash_amount")

    @cached_property
    def splits(self) -> DataFrame:
        lines = self._lines.filter((F.col("l_linenumber") == 7) & (F.col("l_discount") >= 0.09))
        return lines.groupBy("l_suppkey", "date").agg(
            (2 + F.max("l_partkey") % 3).cast("double").alias("split_to")).select(
            self._ticker("l_suppkey").alias("ticker"), F.col("date").alias("event_date"),
            F.col("date").alias("execution_date"), F.lit(1.0).alias("split_from"), "split_to")

    @cached_property
    def raw_catalog(self) -> DataFrame:
        """A catalog as it would be landed: mixed-case headers, untrimmed values."""
        places = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return self.table("supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.when(F.col("s_suppkey") % 2 == 0, "Nyse").otherwise("Nasdaq").alias("Exchange"),
            F.concat(F.lit(" s"), F.col("s_suppkey").cast("string"), F.lit(" ")).alias("Symbol"),
            F.col("s_name").alias("Shortname"),
            F.concat(F.col("s_name"), F.lit(" Inc.")).alias("Longname"),
            F.col("r_name").alias("Sector"), F.col("n_name").alias("Industry"),
            F.concat(F.lit("  "), F.col("n_name")).alias("City"), F.lit(None).cast("string").alias("State"),
            F.col("n_name").alias("Country"))

    @cached_property
    def tickers(self) -> DataFrame:
        places = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return self.table("supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
            self._ticker("s_suppkey").alias("ticker"), F.col("s_name").alias("name"),
            F.col("r_name").alias("sector"), F.col("n_name").alias("industry"),
            F.when(F.col("s_suppkey") % 2 == 0, "NYSE").otherwise("NASDAQ").alias("exchange"))

    @cached_property
    def ref_tickers(self) -> DataFrame:
        """Reference rows exist for suppliers with a positive balance only."""
        return self.table("supplier").filter(F.col("s_acctbal") > 0).join(
            self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
            self._ticker("s_suppkey").alias("ticker"),
            F.concat(F.col("s_name"), F.lit(" Corp")).alias("name"), F.col("n_name").alias("industry"),
            F.lit("us").alias("locale"), F.lit("stocks").alias("market"),
            F.when(F.col("s_suppkey") % 2 == 0, "XNYS").otherwise("XNAS").alias("primary_exchange"))

    @cached_property
    def portfolio(self) -> DataFrame:
        """Holdings: the suppliers with a balance above 5000."""
        key = F.col("s_suppkey").cast("double")
        return self.table("supplier").filter(F.col("s_acctbal") > 5000).select(
            self._ticker("s_suppkey").alias("ticker"), (key + 10).alias("shares"),
            (key * 7 + 1000).alias("avg_cost"))

    @cached_property
    def trading_calendar(self) -> DataFrame:
        """Every trade date for two exchanges, open on weekdays but three holidays, nasdaq also on Saturday."""
        days = self._lines.select("date").distinct()
        weekday = F.weekday("date")
        holiday = F.date_format("date", "MM-dd").isin("01-01", "07-04", "12-25")
        raw = days.select(F.explode(F.array(F.lit("NYSE"), F.lit("NASDAQ"))).alias("exchange"), "date").select(
            "exchange", "date",
            (((weekday < 5) & ~holiday) | ((weekday == 5) & (F.col("exchange") == "NASDAQ"))).alias("is_open"),
            (F.col("date").cast("timestamp_ntz") + F.expr("interval 14 hours 30 minutes")).alias("market_open_utc"),
            (F.col("date").cast("timestamp_ntz") + F.expr("interval 21 hours")).alias("market_close_utc"))
        return core_calendar(new_york_hours(raw))
