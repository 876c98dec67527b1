"""Chat logs: messages(conv_id, turn, role, text) where ``turn`` orders a conversation."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import strip

# Words that send a message to the market data side.
FINANCE_WORDS = (
    "ytd", "year-to-date", "return", "performance", "price", "closing price", "close price", "portfolio",
    "holdings", "positions", "pnl", "p&l", "volatility", "sharpe", "beta", "dividend", "dividends",
    "dividend yield", "yield",
)
SPEAKERS = {"user": "human", "assistant": "ai", "bot": "ai"}
TITLE_LENGTH, REPLY_LENGTH = 30, 2000
TRUNCATED = "... [Response truncated]"


def messages(log: DataFrame, conversation: int | None = None) -> DataFrame:
    rows = log if conversation is None else log.filter(F.col("conv_id") == conversation)
    return rows.orderBy("conv_id", "turn")


def by_activity(log: DataFrame, time: str = "turn") -> DataFrame:
    """Conversations, the most recently active first."""
    return log.groupBy("conv_id").agg(F.max(time).alias("last_activity"), F.count(F.lit(1)).alias("messages")).orderBy(
        F.desc("last_activity"), "conv_id")


def history(log: DataFrame) -> DataFrame:
    """Non-blank messages of the two speakers as rows, trimmed, in order; other roles go."""
    who = F.lit(None).cast("string")
    for role, speaker in SPEAKERS.items():
        who = F.when(F.col("role") == role, speaker).otherwise(who)
    rows = log.select("conv_id", "turn", who.alias("speaker"), strip(F.col("text")).alias("content"))
    return rows.filter((F.col("content") != "") & F.col("speaker").isNotNull())


def titles(log: DataFrame) -> DataFrame:
    """Start of the first user message, once a conversation has a pair of messages."""
    talk = log.filter(F.col("role").isin(*SPEAKERS))
    asked = F.when(F.col("role") == "user", F.col("turn"))
    first = talk.groupBy("conv_id").agg(F.min_by("text", asked).alias("text"), F.count(F.lit(1)).alias("messages"))
    short = F.substring("text", 1, TITLE_LENGTH)
    title = F.when(F.length("text") > TITLE_LENGTH, F.concat(short, F.lit("..."))).otherwise(F.col("text"))
    return first.select("conv_id", F.when((F.col("messages") >= 2) & F.col("text").isNotNull(), title)
                        .otherwise("New Chat").alias("title"))


def truncated(text: Column) -> Column:
    return F.when(F.length(text) > REPLY_LENGTH,
                  F.concat(F.substring(text, 1, REPLY_LENGTH), F.lit(TRUNCATED))).otherwise(text)


def is_financial(text: Column, words=FINANCE_WORDS) -> Column:
    """Does the message name a finance word, anywhere and in any case."""
    low = F.lower(text)
    return functools.reduce(lambda a, b: a | b, [low.contains(w) for w in words])


def without(df: DataFrame, gone: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rows whose key is not in ``gone``: deletes a chat's rows from any table that carries its key."""
    return df.join(gone.select(key), key, "left_anti")


def files_newest_first(files: DataFrame, time: str) -> DataFrame:
    return files.orderBy(F.desc(time))
