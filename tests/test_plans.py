"""What the plans must look like: pruned scans, no window where an aggregate does, no forced broadcast."""

import datetime as dt

import pytest

from tidemark.operators import ranking, series
from tidemark.plans import metrics
from tidemark.plans.metrics import Tables
from tidemark.sources import sinks

D = dt.date


@pytest.fixture(scope="module")
def landed(spark, market, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed") / "prices")
    sinks.by_ticker(market.prices_daily, path)
    return Tables(spark.read.parquet(path), portfolio=market.portfolio)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ytd_reads_two_columns_of_its_tickers_and_year(landed):
    text = plan(metrics.ytd_return(landed, ["S1"], 1998))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "ReadSchema: struct<date:date,close:double>" in scan
    assert "PartitionFilters: [isnotnull(ticker" in scan and "= S1" in scan
    assert "GreaterThanOrEqual(date,1998-01-01)" in scan and "LessThanOrEqual(date,1998-12-31)" in scan
    assert "Window" not in text and text.count("Exchange hashpartitioning") == 1


def test_ticker_filter_passes_the_window(landed):
    text = plan(metrics.daily_return(landed, ["S1"], D(1998, 1, 1), D(1998, 12, 31)))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "= S1" in scan and "1998" not in scan  # the date filter must stay behind the lag


def test_series_columns_share_one_shuffle(landed):
    df = series.rolling_return(series.rolling_volatility(series.daily_returns(landed.prices_daily), 20), 20)
    assert plan(df).count("Exchange hashpartitioning(ticker") == 1


def test_keep_first_combines_before_the_shuffle(spark):
    text = plan(ranking.keep_first(spark.range(10).selectExpr("id % 3 k", "id"), ["k"], ["id"]))
    assert "partial_min_by" in text and "Window" not in text


def test_top_per_group_limits_before_the_shuffle(spark):
    rows = spark.range(10).selectExpr("id % 3 k", "id v")
    assert plan(ranking.top_per_group(rows, ["k"], "v", 2, [])).count("WindowGroupLimit") == 2


def test_answerable_pairs_take_one_join_with_keys(spark, tmp_path):
    """One scan of each table, and a handful of exchanges whatever the number of needs."""
    from tidemark.operators import corpus

    kinds = {"prices": "ticker string, date date", "dividends": "ticker string, ex_dividend_date date", "splits": "ticker string, event_date date",
             "tickers": "ticker string, sector string", "portfolio": "ticker string", "calendar": "exchange string, date date",
             "rows": "draw int, needs string, ticker string, sector string, day date, start date, end date, year int"}
    tables = {}
    for name, kind in kinds.items():
        spark.createDataFrame([], kind).write.parquet(str(tmp_path / name))
        tables[name] = spark.read.schema(kind).parquet(str(tmp_path / name))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(corpus.answerable(tables.pop("rows"), *tables.values()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("FileScan") == 7 and text.count("Exchange hashpartitioning") <= 10, text


def test_nothing_is_keyed_by_a_text(spark):
    rows = spark.createDataFrame([("a", 1)], "text string, row long")
    text = plan(ranking.first_of_each_text(rows, "text", ["row"]))
    assert "partial_min" in text and "SortAggregate" not in text and "hashpartitioning(text" not in text
