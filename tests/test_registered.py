"""Registered queries against their SQL at the smallest scale; TIDEMARK_ALL=1 runs every one of them."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry
import check
from tidemark.sources.star import TABLES

from .conftest import SMALL

SAMPLE = ["view2_daily_returns", "view8_dividend_yield_ttm", "join13_as_of_close", "join14_neighbour_trading_days",
          "agg16_period_labels", "top6_ranking_per_sector", "met8_ytd_return_portfolio", "met14_rolling_volatility",
          "dec8_beta_alpha", "dec16_contribution_to_risk", "qry26_top_positions", "src9_daily_bar_payload",
          "snk1_partition_per_ticker", "inc2_load_summary", "prj9_core_ref_tickers", "req4_sql_slots",
          "req5_question_hints", "evl4_corpus_rates", "txt5_distinct_hits", "sen5_stratified_split", "cht4_titles"]
NAMES = list(entry.queries()) if os.environ.get("TIDEMARK_ALL") else SAMPLE


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_rows_match_the_sql(spark, connection, name):
    text, good = check.compare(spark, connection, name, entry.queries()[name], entry.oracle_sql().get(name), SMALL)
    assert good, text


def test_entry(spark):
    assert entry.entry(spark).columns == ["ticker", "as_of_date", "ytd_return"]


def test_every_check_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
