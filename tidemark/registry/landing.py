"""Sources, sinks, incremental loads, catalog helpers and core projections."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import cleaning
from tidemark.plans import views
from tidemark.registry import query
from tidemark.registry.market import rounded, tables
from tidemark.registry.oracle import define, sql
from tidemark.session import new_path
from tidemark.sources import payloads, readers, sinks

D = dt.date

_BARS = "select date, ticker, open, high, low, close, volume, transactions from prices_daily"
_BAR_COLUMNS = ["date", "ticker", "open", "high", "low", "close", "volume", "transactions"]
_ACTIONS = "select ticker, event_date, ex_dividend_date, pay_date, record_date, cash_amount from dividends"


def _bar_pages(m):
    """Bars packed the way a price API returns them: a JSON page per ticker and year (at most 366 bars)."""
    millis = F.unix_date("date").cast("long") * 86_400_000 + 43_200_000
    item = F.struct(millis.alias("t"), F.col("open").alias("o"), F.col("high").alias("h"), F.col("low").alias("l"),
                    F.col("close").alias("c"), F.col("volume").cast("double").alias("v"), F.col("vwap").alias("vw"),
                    F.col("transactions").alias("n"))
    return m.prices_daily.groupBy("ticker", F.year("date").alias("year")).agg(
        F.to_json(F.struct(F.collect_list(item).alias("results"))).alias("body")).select("ticker", "body")


def _action_pages(df, item):
    return df.groupBy("ticker", F.year("event_date").alias("year")).agg(F.collect_list(item).alias("results"))


def _round_trip(m, label, write):
    path = new_path(m.spark, label)
    write(path)
    return path


# --- sources ---------------------------------------------------------------------------------------------

@query("src1_scan_parquet", "select l_shipdate, l_suppkey, l_quantity, l_extendedprice from lineitem")
def _(m):
    return readers.parquet(m.spark, f"{m.folder}/lineitem.parquet").select(
        "l_shipdate", "l_suppkey", "l_quantity", "l_extendedprice")


@query("src2_union_by_name", sql("""
    select ticker, event_date, cash_amount, cast(null as double) split_to from dividends
    union all select ticker, event_date, null, split_to from splits"""))
def _(m):
    path = new_path(m.spark, "union")
    m.dividends.select("ticker", "event_date", "cash_amount").write.parquet(f"{path}/a")
    m.splits.select("split_to", "event_date", "ticker").write.parquet(f"{path}/b")
    return readers.parquet(m.spark, f"{path}/*", merge=True).select("ticker", "event_date", "cash_amount", "split_to")


@query("src3_read_csv", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def _(m):
    path = _round_trip(m, "csv", lambda p: m.table("supplier").write.csv(p, header=True))
    return readers.csv(m.spark, path, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")


@query("src4_read_portfolio", sql("select ticker, shares, avg_cost from portfolio"))
def _(m):
    extra = m.portfolio.withColumn("note", F.lit("x"))
    path = _round_trip(m, "holdings", lambda p: extra.write.csv(f"{p}.csv", header=True))
    return readers.portfolio(m.spark, f"{path}.csv")


@query("src4_read_portfolio_parquet", sql("select ticker, shares, avg_cost from portfolio"))
def _(m):
    path = _round_trip(m, "holdings", lambda p: m.portfolio.write.parquet(f"{p}.parquet"))
    return readers.portfolio(m.spark, f"{path}.parquet")


@query("src5_read_json_lines", "select event_id, user_id, event_type, value from events where event_type != 'error'")
def _(m):
    # Lines of error events are cut short on the way, and are skipped on reading.
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    lines = m.table("events").select(
        F.when(F.col("event_type") == "error", F.expr("left(to_json(struct(event_id)), 8)")).otherwise(line))
    path = _round_trip(m, "lines", lambda p: lines.write.text(p))
    return readers.json_lines(m.spark, path, "event_id long, user_id long, event_type string, value double").filter(
        F.col("event_id").isNotNull())


@query("src6_read_shards", "select conv_id, turn, role, text from conversations")
def _(m):
    path = _round_trip(m, "shards", lambda p: sinks.json_shards(m.table("conversations"), p, 100))
    return readers.json_lines(m.spark, path, m.table("conversations").schema)


define("label_lines", """
select doc_id, text, case when toxic = 1 then 'negative' when quality = 1 then 'positive' else 'mixed' end word
from documents join labels using (doc_id)""")


@query("src7_labelled_lines", sql("""
    select md5(regexp_replace(replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), chr(8203), ''), '\\s+', ' ', 'g')) text_md5,
      case word when 'negative' then 0 when 'positive' then 2 else 1 end as label from label_lines"""))
def _(m):
    word = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("mixed")
    lines = m.table("documents").join(m.table("labels"), "doc_id").select(
        F.concat(F.col("text"), F.lit("@"), word).alias("value"))
    return readers.labelled_lines(lines).select(F.md5("text").alias("text_md5"), "label")


@query("src8_labelled_table", sql("""
    select md5(regexp_replace(replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), chr(8203), ''), '\\s+', ' ', 'g')) text_md5,
      case word when 'negative' then 0 when 'positive' then 2 else 1 end as label, 'calls' source from label_lines"""))
def _(m):
    word = F.when(F.col("toxic") == 1, "Negative").when(F.col("quality") == 1, " positive").otherwise("mixed")
    table = m.table("documents").join(m.table("labels"), "doc_id").select(
        F.col("text").alias("segment"), word.alias("sentiment"))
    return readers.labelled_table(table).select(F.md5("text").alias("text_md5"), "label", "source")


@query("src9_daily_bar_payload", sql(_BARS))
def _(m):
    path = _round_trip(m, "bars", lambda p: _bar_pages(m).write.parquet(p))
    pages = m.spark.read.parquet(path).select("ticker", F.from_json(
        "body", schema.BARS_PAYLOAD["results"].dataType.simpleString().join(["struct<results:", ">"])).alias("b"))
    bars = payloads.daily_bars(pages.select("ticker", "b.results"))
    return cleaning.core_prices(bars).select(*_BAR_COLUMNS)


@query("src10_splits_payload", sql("select ticker, event_date, execution_date, split_from, split_to from splits"))
def _(m):
    item = F.struct(F.col("execution_date").cast("string").alias("execution_date"),
                    F.col("split_from").cast("string").alias("split_from"),
                    F.col("split_to").cast("string").alias("split_to"), F.array(F.lit("x")).alias("tags"))
    return payloads.splits(_action_pages(m.splits, item))


@query("src11_dividends_payload", sql(_ACTIONS))
def _(m):
    item = F.struct(*[F.col(c).cast("string").alias(c) for c in
                      ("declaration_date", "ex_dividend_date", "pay_date", "record_date", "cash_amount")])
    raw = m.raw_dividends.withColumn("event_date", F.col("ex_dividend_date"))
    return payloads.dividends(_action_pages(raw, item)).drop("declaration_date")


@query("src12_ticker_reference_payload", sql("""
    select ticker, company_name, industry, sector, locale, market, primary_exchange from ref_tickers"""))
def _(m):
    pages = m.ref_tickers.select(F.lower("ticker").alias("ticker"), F.struct(
        F.lit("ignored").alias("ticker"), "name", "industry", "locale", "market", "primary_exchange",
        F.struct(F.lit("x").alias("url")).alias("branding")).alias("results"))
    return cleaning.core_ref_tickers(payloads.ticker_reference(pages))


@query("src13_market_status_payload", sql("""
    select exchange, date, is_open, strftime(date + interval '14 hours 30 minutes', '%Y-%m-%d %H:%M') open_utc
    from trading_calendar where exchange = 'nasdaq'"""))
def _(m):
    cal = m.trading_calendar
    items = cal.select(
        F.when(F.col("exchange") == "nasdaq", "NASDAQ").otherwise("OTC").alias("exchange"),
        F.col("date").cast("string").alias("date"), F.when(F.col("is_open"), "early-close").otherwise("Closed").alias("status"),
        F.concat(F.col("date").cast("string"), F.lit("T14:30:00")).alias("open"), F.lit("unknown").alias("close"))
    return payloads.market_status(items).select(
        "exchange", "date", "is_open", F.date_format("market_open_utc", "yyyy-MM-dd HH:mm").alias("open_utc"))


# --- sinks and incremental loads -------------------------------------------------------------------------

@query("snk1_partition_per_ticker", sql(_BARS.replace("close,", "case when ticker = 'S1' then close + 1 else close end as close,")))
def _(m):
    path = new_path(m.spark, "by-ticker")
    sinks.by_ticker(m.prices_daily, path)
    fixed = m.prices_daily.filter(F.col("ticker") == "S1").withColumn("close", F.col("close") + 1)
    sinks.by_ticker(fixed, path)  # replaces the one ticker's folder only
    return m.spark.read.parquet(path).select(*_BAR_COLUMNS)


@query("snk2_single_parquet", sql("select ticker, name, sector, industry, exchange from tickers"))
def _(m):
    path = _round_trip(m, "catalog", lambda p: sinks.parquet(m.tickers, p))
    return m.spark.read.parquet(path)


@query("snk3_csv_column_order", "select doc_id, md5(text) text_md5, lang from documents")
def _(m):
    path = _round_trip(m, "texts", lambda p: sinks.csv(m.table("documents"), p, ["doc_id", "lang", "text"]))
    back = m.spark.read.csv(path, header=True, schema="doc_id long, lang string, text string", multiLine=True, escape='"')
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang")


@query("snk4_json_shards", "select event_id, event_type, value from events")
def _(m):
    rows = m.table("events").select("event_id", "event_type", "value")
    path = _round_trip(m, "json", lambda p: sinks.json_shards(rows, p, 1000))
    return readers.json_lines(m.spark, path, rows.schema)


@query("snk5_json_splits", "select event_type split, event_id, user_id from events")
def _(m):
    rows = m.table("events").select(F.col("event_type").alias("split"), "event_id", "user_id")
    path = _round_trip(m, "splits", lambda p: sinks.json_splits(rows, p))
    return m.spark.read.json(path, schema="event_id long, user_id long, split string")


@query("snk6_create_table_as", sql("select ticker, shares, avg_cost from portfolio"))
def _(m):
    return sinks.table_from_file(m.spark, m.portfolio, "user_portfolio", new_path(m.spark, "portfolio"))


#: Each view: the checks' table of the same rows, the column of its dates, a column of values.
_VIEWS = {
    "prices_enriched": ("prices_daily left join (select ticker, sector from tickers) using (ticker)", "date", "vwap"),
    "daily_returns": ("daily_returns", "date", "ret"),
    "daily_returns_open_days": (
        "(select * from daily_returns where date in (select date from trading_calendar where is_open and exchange = 'nyse'))",
        "date", "ret"),
    "prices_weekly": ("prices_weekly", "week", "close"), "prices_monthly": ("prices_monthly", "month", "volume"),
    "corporate_actions": ("corporate_actions", "event_date", "cash_amount"),
    "adjusted_prices_splits": ("(select *, close * cum_adj_factor close_adj_splits from adjusted_prices)", "date", "close_adj_splits"),
    "dividend_yield_ttm": ("ttm_yields", "date", "dividend_yield_ttm"),
}


def _of_views(prefix: str, oracle: bool) -> str:
    return "\nunion all\n".join(
        f"select '{name}' as name, ticker, count(*) n, min({day}) as first, max({day}) as last, "
        f"{f'round(max({value}), 6)' if oracle else f'max({value})'} as best from {body if oracle else prefix + name} group by ticker"
        for name, (body, day, value) in _VIEWS.items())


@query("snk7_register_views", sql(_of_views("", True)))
def _(m):
    t = tables(m)
    views.register(m.spark, {"prices_daily": t.prices_daily, "tickers": t.tickers, "dividends": t.dividends,
                             "splits": t.splits, "trading_calendar": t.trading_calendar, "portfolio": t.portfolio})
    return rounded(m.spark.sql(_of_views("views_", False)), 6, "best")


@query("snk8_register_frame", sql("select ticker, shares * avg_cost as cost from portfolio"))
def _(m):
    sinks.register({"portfolio": m.portfolio}, "my_")
    return m.spark.sql("select ticker, shares * avg_cost cost from my_portfolio")


@query("inc1_skip_landed", sql("select ticker from tickers where ticker not in (select ticker from splits where split_to = 4)"))
def _(m):
    path = _round_trip(m, "landed", lambda p: sinks.by_ticker(m.splits.filter("split_to = 4"), p))
    return sinks.not_landed(cleaning.ticker_list(m.raw_catalog), m.spark.read.parquet(path))


@query("inc2_load_summary", sql("""
    with s as (select ticker, case when ticker in (select ticker from splits where split_to = 4) then 'skipped'
      when ticker in (select ticker from splits where split_to = 3) then 'created' else 'failed' end status from tickers)
    select status, count(*) n from s group by 1 union all select 'total', count(*) from s"""))
def _(m):
    before, after = m.splits.filter("split_to = 4"), m.splits.filter("split_to >= 3")
    return sinks.load_summary(m.tickers, before, after)


_LISTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
           "embeddings", "pages", "benchmark", "labels", "conversations")


@query("cat1_list_columns", """
    select table_name, column_name, ordinal_position - 1 as position, n from information_schema.columns
    join (""" + " union all ".join(f"select '{t}' table_name, count(*) n from {t}" for t in _LISTED) + """)
    using (table_name)""")
def _(m):
    listed = sinks.columns_of(m.spark, {n: m.table(n) for n in _LISTED}).select("table_name", "column_name", "position")
    counts = [m.table(n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n")) for n in _LISTED]
    return listed.join(functools.reduce(lambda a, b: a.union(b), counts), "table_name")


@query("cat2_numeric_columns", """
    select count(*) n, min(l_quantity) min_quantity, max(l_discount) max_discount, max(l_orderkey) max_orderkey from lineitem""")
def _(m):
    lines = m.table("lineitem")
    numeric = lines.select(*sinks.numeric_columns(lines))
    return numeric.agg(F.count(F.lit(1)).alias("n"), F.min("l_quantity").alias("min_quantity"),
                       F.max("l_discount").alias("max_discount"), F.max("l_orderkey").alias("max_orderkey"))


# --- projections -----------------------------------------------------------------------------------------

@query("prj1_clean_catalog", sql("""
    select ticker, upper(exchange) exchange, name shortname, concat(name, ' Inc.') longname, sector, industry,
      industry city, cast(null as varchar) state, industry country from tickers"""))
def _(m):
    return cleaning.clean_catalog(m.raw_catalog)


@query("prj2_ensure_columns", """
    select l_orderkey::varchar as k, cast(l_shipdate as date) as day, l_quantity as qty,
      case when l_returnflag = 'R' then cast(l_linenumber as bigint) end as line, cast(null as double) missing
    from lineitem""")
def _(m):
    raw = m.table("lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_shipdate").cast("string").alias("day"),
        F.col("l_quantity").cast("string").alias("qty"),
        F.when(F.col("l_returnflag") == "R", F.col("l_linenumber").cast("string")).otherwise("n/a").alias("line"),
        F.lit("gone").alias("other"))
    return cleaning.ensure_columns(raw, {"k": "str", "day": "date", "qty": "float", "line": "int", "missing": "float"})


@query("prj3_drop_nested", "select vec_id, label from embeddings")
def _(m):
    return cleaning.drop_nested(m.table("embeddings"))


@query("prj4_ticker_list", sql("select ticker from tickers"))
def _(m):
    return cleaning.ticker_list(m.raw_catalog)


@query("prj5_core_prices", sql(_BARS.replace("volume,", "cast(volume + 1 as bigint) volume,")))
def _(m):
    raw = m.prices_daily.withColumns({"ticker": F.lower("ticker"), "date": F.col("date").cast("string"),
                                      "volume": F.col("volume") + 0.6, "close": F.col("close").cast("string")})
    return cleaning.core_prices(raw).select(*_BAR_COLUMNS)


@query("prj6_core_dividends", sql(_ACTIONS))
def _(m):
    return cleaning.core_dividends(m.raw_dividends.withColumn("ticker", F.lower("ticker")))


@query("prj6_dated_dividends", sql("""
    select ticker, pay_date event_date, pay_date from dividends where pay_date is not null"""))
def _(m):
    gone = m.raw_dividends.withColumns({"ex_dividend_date": F.lit(None).cast("date"), "record_date": F.lit(None).cast("date")})
    return cleaning.dated_dividends(gone).select("ticker", "event_date", "pay_date")


@query("prj7_core_splits", sql("select * from splits"))
def _(m):
    return cleaning.core_splits(m.splits.drop("event_date").withColumn("ticker", F.lower("ticker")))


@query("prj8_core_tickers", sql("""
    select ticker, name, sector, upper(exchange[1]) || lower(exchange[2:]) exchange, industry from tickers"""))
def _(m):
    raw = m.raw_catalog.withColumnRenamed("Symbol", "ticker").withColumn("ticker", F.trim("ticker"))
    return cleaning.core_tickers(cleaning.normalize_headers(raw)).select(
        "ticker", "name", "sector", "exchange", "industry")


@query("prj8_core_calendar", sql("select exchange, date, is_open from trading_calendar"))
def _(m):
    raw = m.trading_calendar.select(F.upper("exchange").alias("exchange"), F.col("date").cast("string").alias("date"),
                                    F.col("is_open").cast("string").alias("is_open"))
    return cleaning.core_calendar(raw).select("exchange", "date", "is_open")


@query("prj9_core_ref_tickers", sql("select * from ref_tickers"))
def _(m):
    return cleaning.core_ref_tickers(m.ref_tickers)


@query("prj10_portfolio_headers", sql("select ticker, shares, avg_cost from portfolio"))
def _(m):
    raw = m.portfolio.select(F.col("avg_cost").alias("Average Cost"), F.col("ticker").alias("SYMBOL"),
                             F.col("shares").alias("Position Size"), F.lit(1).alias("note"))
    return cleaning.normalize_portfolio(raw)


@query("prj11_new_york_hours", sql("""
    select exchange, date, strftime(timezone('America/New_York', timezone('UTC', market_open_utc)), '%H:%M') open_ny,
      strftime(timezone('America/New_York', timezone('UTC', market_close_utc)), '%H:%M') close_ny from trading_calendar"""))
def _(m):
    cal = m.trading_calendar.drop("market_open_ny", "market_close_ny")
    return cleaning.new_york_hours(cal).select(
        "exchange", "date", F.date_format("market_open_ny", "HH:mm").alias("open_ny"),
        F.date_format("market_close_ny", "HH:mm").alias("close_ny"))


@query("prj12_headers", "select n_name as nation_name, n_regionkey as region_key from nation")
def _(m):
    raw = m.table("nation").select(F.col("n_name").alias("Nation Name"), F.col("n_regionkey").alias("Region KEY"))
    return cleaning.normalize_headers(raw)


@query("prj13_name_lookup", sql("""
    select ticker, coalesce(n, ticker) as name, lower(coalesce(n, ticker)) name_key, coalesce(s, 'Unknown') sector from (
      select ticker, case when exchange = 'NYSE' then name end n, case when industry != 'CHINA' then sector end s from tickers)"""))
def _(m):
    holes = m.tickers.withColumns({"name": F.when(F.col("exchange") == "NYSE", F.col("name")),
                                   "sector": F.when(F.col("industry") != "CHINA", F.col("sector"))})
    return cleaning.name_lookup(holes)


@query("prj13_sector_members", sql("select distinct sector, ticker from tickers"))
def _(m):
    return cleaning.sector_members(m.tickers)
