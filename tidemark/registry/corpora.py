"""Requests, question/SQL corpora and their scores over texts derived from the market tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import slots
from tidemark.functions.dates import phrase_range
from tidemark.functions.staging import landed, once
from tidemark.functions.text import identifier_tokens, normalize_sql, tokens
from tidemark.operators import corpus, ranking, scoring
from tidemark.plans import requests
from tidemark.registry import query
from tidemark.registry.market import rounded, tables
from tidemark.registry.oracle import define, snap, sql


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- texts: every form filled for every (ticker, year) with bars -------------------------------------------

SQL_FORMS = (
    "SELECT ticker, date, close FROM core.prices_daily WHERE ticker = '{T}' AND EXTRACT(year FROM date) = {Y};",
    "WITH p AS (SELECT ticker, date, close, FIRST_VALUE(close) OVER (PARTITION BY ticker ORDER BY date) AS first_close_ytd\n"
    "  FROM core.prices_daily WHERE ticker = '{T}' AND EXTRACT( year FROM date ) = {Y}) SELECT MAX(close / first_close_ytd - 1) AS ytd_return FROM p",
    "select avg(p.close) from core.prices_daily p where p.ticker in ('{T}', 'S1', '{T}') and p.date between '{A}' and '{B}'",
    "SELECT ticker, STDDEV_POP(ret) OVER (ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS rolling_vol\n"
    "FROM views.daily_returns WHERE ticker = '{T}' AND date BETWEEN DATE '{A}' AND DATE '{B}'",
    "select date, dividend_yield_ttm from views.dividend_yield_ttm where ticker='{T}' order by date desc limit 12",
    "SELECT * FROM portfolio port JOIN x ON port.ticker = x.ticker WHERE unrealized_pnl > 0",
    "select `close`, volume, date  from core.prices_daily where date >= '{A}' and date <= '{B}' order by date",
    "SELECT * FROM views.corporate_actions WHERE ticker IN ('{T}','S2') ORDER BY event_date",
    "select count(ticker) as n, max(date) from core.tickers t;",
    "SELECT ret FROM views.daily_returns r WHERE r.ticker = '{T}'",
)
QUESTIONS = (
    "What was the daily return of ABC on {A}?",
    "Average close for sector technology from {A} to {B} on NASDAQ",
    "Top 10 gainers by daily return on {A}",
    "7-day and 30-day returns for XYZ",
    "Was NYSE open on {A}?",
    "List the sector energy trading holdings, last 5d please",
    "Volume of {T} in {Y}, in sector basic goods and chemicals",
    "How did my portfolio do",
)


def _spans(m):
    return m.prices_daily.groupBy("ticker", F.year("date").alias("y")).agg(
        F.min("date").alias("a"), F.max("date").alias("b"))


def _filled(m, forms, name):
    listed = F.array(*[F.struct(F.lit(i).alias("n"), F.lit(f).alias("s")) for i, f in enumerate(forms)])
    rows = _spans(m).withColumn("f", F.explode(listed))
    text = F.col("f.s")
    for mark, col in (("{T}", "ticker"), ("{Y}", "y"), ("{A}", "a"), ("{B}", "b")):
        text = F.replace(text, F.lit(mark), F.col(col).cast("string"))
    return rows.select(F.concat_ws("-", "ticker", F.col("y").cast("string"), F.col("f.n").cast("string")).alias("id"),
                       F.col("f.n").alias("n"), "ticker", "y", text.alias(name))


define("spans", "select ticker, year(date) y, min(date) a, max(date) b from prices_daily group by 1, 2")
for _name, _forms, _column in (("sql_texts", SQL_FORMS, "sql"), ("question_texts", QUESTIONS, "question")):
    define(_name, f"""
select ticker || '-' || y || '-' || n id, n, ticker, y,
  replace(replace(replace(replace(s, '{{T}}', ticker), '{{Y}}', y::varchar), '{{A}}', a::varchar), '{{B}}', b::varchar) {_column}
from spans cross join (values {", ".join(f"({i}, {_literal(f)})" for i, f in enumerate(_forms))}) f(n, s)""")


# --- model text and requests -------------------------------------------------------------------------------

KINDS = ("close", "open", "high", "low", "volume", "vwap", "daily_return", "ytd_return", "mtd_return", "period_return",
         "total_return_price_plus_dividends", "rolling_volatility", "rolling_return", "dividend_yield_ttm",
         "dividend_amount", "portfolio_value", "magic_number")


def _model_texts(m, orders=None):
    """One model output per order: a JSON request between other words, some of them cut short."""
    key = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    end = F.date_add(day, 90).cast("string")
    assets = F.when(key % 50 == 7, F.array(F.lit("My Portfolio"))).when(
        key % 500 == 0, F.array().cast("array<string>")).otherwise(F.array(
            F.concat(F.lit("S"), (F.col("o_custkey") % 100).cast("string")),
            F.concat(F.lit("s"), (key % 97).cast("string"))))
    metric = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (key % len(KINDS) + 1).cast("int"))
    args = F.struct(F.year(day).alias("year"), F.month(day).alias("month"), day.cast("string").alias("start_date"),
                    end.alias("end_date"), F.lit(10).alias("window"))
    later = F.struct(F.lit("date").alias("field"), F.lit(">=").alias("op"), F.date_add(day, 30).cast("string").alias("value"))
    dear = F.struct(F.lit("volume").alias("field"), F.lit(">").alias("op"), F.lit("20").alias("value"))
    filters = F.when(key % 10 == 1, F.array(later)).when(key % 10 == 2, F.array(later, dear))
    request = F.struct(
        F.lit("compute_metric").alias("intent"), F.struct(assets.alias("assets")).alias("entities"),
        F.struct(metric.alias("name"), args.alias("arguments")).alias("metric"),
        F.struct(F.struct(F.lit("between_dates").alias("type"), day.cast("string").alias("start"),
                          end.alias("end")).alias("range")).alias("time"), filters.alias("filters"))
    body = F.to_json(request)
    text = F.when(key % 40 == 3, F.concat(F.lit("IR: "), F.expr("left(x, length(x) - 1)"))).otherwise(
        F.concat(F.lit("Sure } here: "), F.col("x"), F.lit(' and {"other": 1}')))
    orders = m.table("orders") if orders is None else orders
    return orders.withColumn("x", body).select(key.alias("request_id"), text.alias("text"))


_kinds = ", ".join(f"'{k}'" for k in KINDS)
define("model_requests", f"""
select o_orderkey request_id, ([{_kinds}])[o_orderkey % {len(KINDS)} + 1] metric, cast(o_orderdate as date) d0,
  cast(o_orderdate as date) + 90 d1,
  case when o_orderkey % 50 = 7 then ['My Portfolio'] when o_orderkey % 500 = 0 then [] else
    ['S' || (o_custkey % 100), 's' || (o_orderkey % 97)] end assets
from orders where o_orderkey % 40 != 3""")


@query("req2_parse_model_text", sql("""
    select o_orderkey request_id, metric, assets[1] first_asset, cast(len(assets) as bigint) assets,
      cast(year(d0) as bigint) as year, d0::varchar as start
    from orders left join model_requests on request_id = o_orderkey"""))
def _(m):
    r = requests.parsed(_model_texts(m))
    return r.select("request_id", F.col("request.metric.name").alias("metric"),
                    F.try_element_at("request.entities.assets", F.lit(1)).alias("first_asset"),
                    F.size("request.entities.assets").cast("long").alias("assets"),
                    F.col("request.metric.arguments.year").cast("long").alias("year"),
                    F.col("request.time.range.start").alias("start"))


@query("req2_parse_leniently", sql("""
    select event_id, cast(user_id as varchar) as value from events"""))
def _(m):
    # The balanced block is no JSON, the shortest one is.
    text = F.concat(F.lit('{not json {"time": {"range": {"value": "'), F.col("user_id").cast("string"), F.lit('"}}} }'))
    shortest = F.concat(F.lit('{"intent": "'), F.col("user_id").cast("string"), F.lit('"} {'))
    rows = m.table("events").select("event_id", F.when(F.col("event_type") == "click", shortest).otherwise(shortest).alias("text"))
    r = requests.parsed(rows, lenient=True)
    return r.select("event_id", F.col("request.intent").alias("value"))


def _evaluated(m):
    # the file of orders may be one split; reading a text is the costly part, so orders are dealt before
    parts = int(m.spark.conf.get("spark.sql.shuffle.partitions"))
    texts = _model_texts(m, m.table("orders").repartition(parts, "o_orderkey"))
    flat = landed(requests.flat_requests(requests.parsed(texts).filter(F.col("request").isNotNull())), "flat")
    return flat, requests.evaluate(flat, tables(m))


define("requested", """
select distinct request_id, metric, ticker,
  case metric when 'ytd_return' then date_trunc('year', d0) when 'mtd_return' then date_trunc('month', d0) else d0 end::date lo,
  case metric when 'ytd_return' then date_trunc('year', d0) + interval 1 year - interval 1 day
    when 'mtd_return' then last_day(d0) else d1 end::date hi from (
  select r.*, upper(a) ticker from (select *, unnest(assets) a from model_requests) r where a != 'My Portfolio'
  union all select r.*, p.ticker from (select *, unnest(assets) a from model_requests) r, portfolio p where a = 'My Portfolio'
  union all select r.*, '' a, t.ticker from model_requests r, (select distinct ticker from prices_daily
    union select ticker from dividends) t
    where len(assets) = 0 and metric in ('close', 'open', 'high', 'low', 'volume', 'vwap', 'daily_return',
      'dividend_yield_ttm', 'dividend_amount'))""")
define("evaluated", """
select q.request_id, metric, q.ticker, date, case metric when 'close' then close when 'open' then open when 'high' then high
  when 'low' then low when 'volume' then volume else vwap end as value
from requested q join prices_daily p on p.ticker = q.ticker and date between lo and hi
where metric in ('close', 'open', 'high', 'low', 'volume', 'vwap') and (q.request_id % 10 not in (1, 2) or date >= lo + 30)
  and (q.request_id % 10 != 2 or volume > 20)
union all
select q.request_id, metric, q.ticker, r.date, ret from requested q join daily_returns r on r.ticker = q.ticker and r.date between lo and hi
join prices_daily p on p.ticker = r.ticker and p.date = r.date
where metric = 'daily_return' and (q.request_id % 10 not in (1, 2) or r.date >= lo + 30) and (q.request_id % 10 != 2 or volume > 20)
union all
select q.request_id, metric, q.ticker, max(date), max(close) / arg_min(close, date) - 1
from requested q join prices_daily p on p.ticker = q.ticker and date between lo and hi
where metric in ('ytd_return', 'mtd_return', 'period_return') group by 1, 2, 3
union all
select q.request_id, metric, q.ticker, max(date), (max(close) + sum(coalesce(cash_amount, 0))) / min(close) - 1
from requested q join prices_daily p on p.ticker = q.ticker and date between lo and hi
left join dividends v on v.ticker = p.ticker and v.event_date = p.date
where metric = 'total_return_price_plus_dividends' group by 1, 2, 3
union all
select q.request_id, metric, q.ticker, date, case metric when 'rolling_volatility' then stddev_pop(ret) over w
  else exp(sum(ln(1 + ret)) over w) - 1 end
from requested q join daily_returns p on p.ticker = q.ticker and date between lo and hi
where metric in ('rolling_volatility', 'rolling_return')
window w as (partition by q.request_id, q.ticker order by date rows between 10 preceding and current row)
union all
select q.request_id, metric, q.ticker, r.date, dividend_yield_ttm
from requested q join ttm_yields r on r.ticker = q.ticker and r.date between lo and hi
join prices_daily p on p.ticker = r.ticker and p.date = r.date
where metric = 'dividend_yield_ttm' and (q.request_id % 10 not in (1, 2) or r.date >= lo + 30) and (q.request_id % 10 != 2 or volume > 20)
union all
select q.request_id, metric, q.ticker, event_date, cash_amount
from requested q join dividends p on p.ticker = q.ticker and event_date between lo and hi where metric = 'dividend_amount'
  and (q.request_id % 10 != 1 or event_date >= lo + 30) and q.request_id % 10 != 2
union all
select request_id, metric, ticker, null, shares * last_close from model_requests, held_values where metric = 'portfolio_value'""")


@query("req1_batch_evaluation", sql("select request_id, metric, ticker, date, round(value, 6) as value from evaluated"))
def _(m):
    return rounded(_evaluated(m)[1], 6, "value")


@query("req1_rejected_requests", sql(f"""
    select request_id, metric, case when metric = 'magic_number' then 'unknown metric' when len(assets) = 0
      and metric in {requests.TEMPLATE_METRICS} then 'no assets' else 'unclear filter' end as reason
    from model_requests where metric = 'magic_number' or len(assets) = 0 and metric in {requests.TEMPLATE_METRICS}
      or metric = 'dividend_amount' and request_id % 10 = 2
    union all select o_orderkey, null, 'no request' from orders where o_orderkey % 40 = 3"""))
def _(m):
    return requests.rejected(requests.flat_requests(requests.parsed(_model_texts(m))))


@query("fmt1_answers", sql("""
    with c as (select request_id, count(*) n, min(metric) metric from evaluated group by 1),
    words as (select request_id, n, metric, case metric when 'ytd_return' then 'year-to-date return'
      when 'close' then 'closing price' when 'dividend_yield_ttm' then 'dividend yield (TTM)'
      else replace(metric, '_', ' ') end said from c),
    lines as (select e.*, w.n, w.said, t.name as company,
      case when value is null then 'None' when e.metric like '%return%' or e.metric like '%yield%'
        then printf('%.2f%%', value * 100) else printf('%.4f', value) end shown
      from (select * replace (round(value, 4) as value) from evaluated) e join words w using (request_id) left join tickers t using (ticker))
    select request_id, cast(case when n = 1 then 0 else 1 end as bigint) part, ticker, date,
      case when n = 1 then 'The ' || said || ' for ' || coalesce(company, ticker) || ' is ' || shown || '.'
        else '- ' || coalesce(company, ticker) || ': ' || shown end line from lines
    union all select request_id, 0, null, null, 'The ' || said || ' for your portfolio are:' from words
      where n > 1
    union all select request_id, 0, null, null, 'There is no data available for this query.' from model_requests
      where request_id not in (select request_id from c)"""))
def _(m):
    flat, values = _evaluated(m)
    # the values are evaluated for the lines, and without their numbers to count them, which costs less than to write and read them
    # both engines settle ties of the last printed digit in their own way, so the check rounds before printing
    lines = requests.answer_lines(flat, rounded(values, 4, "value"), m.tickers)
    return lines.withColumn("part", F.col("part").cast("long"))


# --- SQL and question text -----------------------------------------------------------------------------------

_FLAT = r"regexp_replace(trim(sql), '\s+', ' ', 'g')"


define("sql_requests", rf"""
    with f as (select id, sql_flat s, lower(sql_flat) l,
        list_filter(regexp_extract_all(sql_flat, '(?i)\bFROM\s+([a-zA-Z0-9_\.]+)', 1), lambda x: true) froms
      from (select id, {_FLAT} sql_flat from sql_texts)),
    g as (select id, s, l, coalesce(list_filter(froms, lambda x: regexp_matches(x, '^(core|views|ext)\.') or x = 'portfolio')[1], froms[1]) base_table,
      case when l like '%ytd_return%' or l like '%first_close_ytd%' then 'ytd_return' when l like '%rolling_vol%' then 'rolling_volatility'
        when l like '%dividend_yield_ttm%' then 'dividend_yield_ttm' when l like '%portfolio%' and l like '%unrealized_pnl%' then 'portfolio_value'
        when l like '%daily_returns%' then 'daily_return' else 'close' end metric_name,
      cast(nullif(regexp_extract(s, '(?i)EXTRACT\s*\(\s*year\s+FROM\s+[^)]+\)\s*=\s*(\d{{4}})', 1), '') as bigint) y,
      nullif(regexp_extract(s, '(?i)date\s+BETWEEN\s+(?:DATE\s*)?''([^'']+)''\s+AND\s+(?:DATE\s*)?''([^'']+)''', 1), '') b1,
      nullif(regexp_extract(s, '(?i)date\s+BETWEEN\s+(?:DATE\s*)?''([^'']+)''\s+AND\s+(?:DATE\s*)?''([^'']+)''', 2), '') b2,
      cast(nullif(regexp_extract(s, '(?i)ROWS\s+BETWEEN\s+(\d+)\s+PRECEDING', 1), '') as bigint) w,
      nullif(regexp_extract(s, '(?i)ticker\s*=\s*''([^'']+)''', 1), '') one,
      regexp_extract_all(regexp_extract(s, '(?i)ticker\s+IN\s*\(([^)]+)\)', 1), '''([^'']*)''', 1) many from f)
    select id, base_table, metric_name, y time_year, case when y is null then b1 end time_start, case when y is null then b2 end time_end,
      case when y is not null then 'year' when b1 is not null then 'between_dates' else 'all' end time_type,
      case when metric_name = 'ytd_return' then y end arg_year,
      case when metric_name = 'rolling_volatility' then w end arg_window, case when metric_name = 'rolling_volatility' then b1 end arg_start,
      case when metric_name = 'rolling_volatility' then b2 end arg_end,
      case metric_name when 'close' then 'price' when 'daily_return' then 'return' when 'ytd_return' then 'return'
        when 'rolling_volatility' then 'risk' when 'dividend_yield_ttm' then 'corporate_action' else 'portfolio' end metric_type,
      case metric_name when 'ytd_return' then 'get_ytd_return' when 'rolling_volatility' then 'rolling_stat'
        when 'dividend_yield_ttm' then 'get_dividends' when 'portfolio_value' then 'evaluate_portfolio' when 'daily_return' then 'get_return'
        else case when base_table like '%corporate_actions%' then 'get_corporate_actions' when base_table like '%prices%' then 'get_price'
          else 'compute_metric' end end intent,
      list_filter(listed, lambda x, i: list_position(listed, x) = i) assets
    from (select *, list_concat(case when one is null then [] else [one] end, many) listed from g)""")


@query("req3_sql_to_request", sql("""
    select * exclude (assets, arg_end), array_to_string(list_sort(assets), ',') assets from sql_requests"""))
def _(m):
    df = requests.from_sql(_filled(m, SQL_FORMS, "sql"))
    return df.select("id", "base_table", "metric_name", F.col("time_year").cast("long").alias("time_year"), "time_start", "time_end",
                     "time_type", F.col("arg_year").cast("long").alias("arg_year"), F.col("arg_window").cast("long").alias("arg_window"),
                     "arg_start", "metric_type", "intent", F.array_join(F.array_sort("assets"), ",").alias("assets"))


@query("req4_sql_slots", sql(r"""
    with x as (select id, lower(regexp_replace(trim(sql), ';+$', '')) s from sql_texts),
    h as (select id, s, regexp_replace(regexp_extract(s, '(?s)select\s+(.*?)\s+from\s', 1), '["`]', '', 'g') head,
      nullif(regexp_extract(s, '\bfrom\s+([a-z0-9_\.]+)', 1), '') from_table from x),
    c as (select *, regexp_extract(from_table, '([^.]*)$', 1) short,
      regexp_extract(head, '(?:avg|sum|min|max|count)\s*\(\s*(?:([a-z0-9_]+)\.)?([a-z0-9_]+)\s*\)', 1) ct,
      regexp_extract(head, '(?:avg|sum|min|max|count)\s*\(\s*(?:([a-z0-9_]+)\.)?([a-z0-9_]+)\s*\)', 2) cc,
      nullif(regexp_extract(s, 'where\s+.*?ticker\s*=\s*''([^'']+)''', 1), '') ticker,
      regexp_extract(s, 'ticker\s+in\s*\(([^)]+)\)', 1) tin from h)
    select id, from_table, ticker,
      case when regexp_matches(s, '\bavg\s*\(') then 'avg' when regexp_matches(s, '\bsum\s*\(') then 'sum'
        when regexp_matches(s, '\bmin\s*\(') then 'min' when regexp_matches(s, '\bmax\s*\(') then 'max'
        when regexp_matches(s, '\bcount\s*\(') then 'count' else 'none' end agg,
      case when cc != '' then coalesce(nullif(ct, ''), short) || '.' || cc
        when regexp_matches(head, '[a-z0-9_]+\.[a-z0-9_]+') then regexp_extract(head, '[a-z0-9_]+\.[a-z0-9_]+')
        else short || '.' || nullif(regexp_extract(head, '\b([a-z0-9_]+)\b', 1), '') end sel_col,
      case when ticker is null and tin != '' then array_to_string(list_transform(string_split(tin, ','), lambda t: trim(trim(t), '''')), ',') end tickers,
      nullif(coalesce(nullif(regexp_extract(s, 'date\s+between\s*''([0-9\-]+)''\s+and\s*''([0-9\-]+)''', 1), ''),
        regexp_extract(s, 'date\s*>=\s*''([0-9\-]+)''', 1)), '') date_from,
      nullif(coalesce(nullif(regexp_extract(s, 'date\s+between\s*''([0-9\-]+)''\s+and\s*''([0-9\-]+)''', 2), ''),
        regexp_extract(s, 'date\s*<=\s*''([0-9\-]+)''', 1)), '') date_to,
      cast(nullif(regexp_extract(s, '\blimit\s+(\d+)', 1), '') as bigint) top_k,
      nullif(regexp_extract(s, 'order\s+by\s+([a-z0-9_\.]+)\s*(asc|desc)?', 1), '') order_col,
      case when regexp_matches(s, 'order\s+by\s+[a-z0-9_\.]+')
        then coalesce(nullif(regexp_extract(s, 'order\s+by\s+([a-z0-9_\.]+)\s*(asc|desc)?', 2), ''), 'asc') end order_dir
    from c"""))
def _(m):
    out = slots.sql_slots(F.col("sql"))
    df = _filled(m, SQL_FORMS, "sql").select("id", *[c.alias(n) for n, c in out.items()])
    return df.withColumns({"tickers": F.when(F.col("tickers").isNotNull(), F.array_join("tickers", ",")),
                           "top_k": F.col("top_k").cast("long")})


@query("req5_question_hints", sql(r"""
    with q as (select id, question q, lower(question) l,
      regexp_extract_all(question, '(20[0-9]{2}-[01][0-9]-[0-3][0-9])', 1) ds,
      list_filter(regexp_extract_all(question, '\b([A-Z]{1,5})\b', 1), lambda w: lower(w) not in ('nyse', 'nasdaq', 'amex')) caps,
      regexp_extract_all(lower(question), '(\d+)\s*[- ]?\s*day', 1) w1, regexp_extract_all(lower(question), '\b(\d+)\s*d\b', 1) w2
      from question_texts)
    select id, ds[1] period_dt, ds[1] date_from, ds[2] date_to,
      case when len(ds) = 1 and regexp_matches(l, '\b(on|for)\b') then ds[1] end date_eq,
      cast(nullif(regexp_extract(q, '\b([0-9]{1,3})\b', 1), '') as bigint) top_k, caps[1] ticker,
      case when l like '%technology%' then 'technology' when l like '%energy%' then 'energy'
        else nullif(trim(regexp_extract(l, 'sector\s+([a-z ]+)', 1)), '') end sector,
      case when l like '%nyse%' then 'nyse' when l like '%nasdaq%' then 'nasdaq' end exchange,
      nullif(array_to_string(case when len(w1) > 0 then w1 else w2 end, ','), '') ret_windows from q"""))
def _(m):
    hints = slots.question_hints(F.col("question"))
    df = _filled(m, QUESTIONS, "question").select("id", *[c.alias(n) for n, c in hints.items()])
    return df.withColumns({"ret_windows": F.when(F.col("ret_windows").isNotNull(), F.array_join("ret_windows", ",")),
                           "top_k": F.col("top_k").cast("long")})


PHRASES = ("Today", "yesterday ", "this week", "last week", "this month", "last month", "YTD", "year to date", "this year",
           "last year", "last quarter", "last 10 days", "last 1 day", "last 3 months", "last 2 years", "this quarter")


@query("req6_time_phrases", sql("""
    with d as (select distinct cast(o_orderdate as date) t from orders),
    p as (select t, unnest([""" + ", ".join(_literal(p) for p in PHRASES) + """]) phrase from d),
    k as (select t, phrase, lower(trim(phrase)) k, date_trunc('week', t)::date w, date_trunc('month', t)::date mo,
      date_trunc('year', t)::date y, date_trunc('quarter', t)::date q from p)
    select t as today, phrase,
      case k when 'today' then t when 'yesterday' then t - 1 when 'this week' then w when 'last week' then w - 7
        when 'this month' then mo when 'last month' then (mo - interval 1 month)::date when 'ytd' then y when 'year to date' then y
        when 'this year' then y when 'last year' then (y - interval 1 year)::date when 'last quarter' then (q - interval 3 month)::date
        when 'last 10 days' then t - 10 when 'last 1 day' then t - 1 when 'last 3 months' then (t - interval 3 month)::date
        when 'last 2 years' then (t - interval 2 year)::date end as start_date,
      case k when 'yesterday' then t - 1 when 'last week' then w - 1 when 'last month' then mo - 1 when 'last year' then y - 1
        when 'last quarter' then q - 1 when 'this quarter' then null else t end as end_date from k"""))
def _(m):
    days = m.table("orders").select(F.to_date("o_orderdate").alias("today")).distinct()
    rows = days.withColumn("phrase", F.explode(F.array(*[F.lit(p) for p in PHRASES])))
    span = phrase_range(F.col("phrase"), F.col("today"))
    return rows.withColumn("s", span).select("today", "phrase", F.col("s.start").alias("start_date"), F.col("s.end").alias("end_date"))


_WORD_KINDS = {"click": "column", "view": "metric", "error": "time", "purchase": "layer"}


def _phrases_sql() -> str:
    rows = [f"({_literal(kind)}, {_literal(p)}, {_literal(c)})" for kind, words in slots.VOCABULARIES.items()
            for p, c in slots.vocabulary(words).items()]
    return "(values " + ", ".join(rows) + ") v(kind, phrase, canonical)"


@query("req7_synonyms", sql(f"""
    with v as (select *, row_number() over (partition by kind order by phrase) - 1 pos, count(*) over (partition by kind) n
      from {_phrases_sql()}),
    e as (select event_id, user_id, case event_type when 'click' then 'column' when 'view' then 'metric' when 'error' then 'time'
      when 'purchase' then 'layer' end kind from events)
    select e.event_id, canonical from e left join v on v.kind = e.kind and v.pos = (e.event_id + e.user_id) % (v.n + 1)"""))
def _(m):
    # Each event says one phrase of its kind's vocabulary, and now and then an unknown one.
    said, found = F.lit(None).cast("string"), F.lit(None).cast("string")
    at = F.col("event_id") + F.col("user_id")
    for event_type, kind in _WORD_KINDS.items():
        phrases = sorted(slots.vocabulary(slots.VOCABULARIES[kind]), key=lambda p: p.encode())
        spoken = F.get(F.array(*[F.lit(p) for p in [*phrases, "no such phrase"]]), (at % (len(phrases) + 1)).cast("int"))
        here = F.col("event_type") == event_type
        said = F.when(here, F.concat(F.lit(" "), F.upper(spoken))).otherwise(said)
    rows = m.table("events").withColumn("said", said)
    for event_type, kind in _WORD_KINDS.items():
        found = F.when(F.col("event_type") == event_type, slots.canonical(F.col("said"), kind)).otherwise(found)
    return rows.select("event_id", found.alias("canonical"))


@query("req8_ticker_aliases", sql("""
    with n as (select ticker, lower(name) || case exchange when 'NYSE' then ', inc.' else ' corporation' end l, lower(name) bare, exchange
      from tickers)
    select ticker, array_to_string(list_sort(list_distinct(
      case when exchange = 'NYSE' then [ticker, lower(ticker), l, bare || ',', bare] else [ticker, lower(ticker), l, bare] end)), '|') aliases
    from n"""))
def _(m):
    name = F.concat("name", F.when(F.col("exchange") == "NYSE", ", Inc.").otherwise(" Corporation"))
    return m.tickers.select("ticker", F.array_join(slots.ticker_aliases(F.col("ticker"), name), "|").alias("aliases"))


LINK_COLUMNS = [(f"core.{t}.{f.name}", [*t.split("_"), *f.name.split("_")]) for t, s in schema.CORE.items() for f in s]
_TOKENS = r"list_filter(string_split_regex(regexp_replace(lower({0}), '([,.;:()\[\]=<>+\-*/%''])', ' \1 ', 'g'), '\s+'), lambda x: x != '')"
_LINKS = ", ".join(f"({i}, {_literal(n)}, [{', '.join(_literal(w) for w in words)}])" for i, (n, words) in enumerate(LINK_COLUMNS))


@query("req9_schema_linking", sql(f"""
    with q as (select id, {_TOKENS.format('question')} toks from question_texts),
    c as (select * from (values {_LINKS}) c(pos, name, words)),
    s as (select id, name, pos, len(list_filter(words, lambda w: list_contains(toks, w))) score from q cross join c)
    select id, cast(row_number() over (partition by id order by score desc, pos desc) as bigint) rank, name as column_name,
      cast(score as bigint) score from s qualify rank <= 8"""))
def _(m):
    known = F.array_intersect(tokens(F.col("question")), F.array(*[F.lit(w) for w in slots.schema_words(LINK_COLUMNS)]))
    linked = slots.linked_columns(F.col("known"), LINK_COLUMNS, 8)
    rows = once(_filled(m, QUESTIONS, "question"), known=known).select("id", F.posexplode(linked).alias("at", "c"))
    return rows.select("id", (F.col("at") + 1).cast("long").alias("rank"), F.col("c.name").alias("column_name"),
                       F.col("c.score").cast("long").alias("score"))


@query("req10_token_counts", sql(f"""
    select token, count(*) n from (select unnest({_TOKENS.format('question')}) token from question_texts) group by 1"""))
def _(m):
    return corpus.token_counts(_filled(m, QUESTIONS, "question"), "question")


@query("req10_document_tokens", sql(f"""
    select token, count(*) n from (select unnest({_TOKENS.format('text')}) token from documents) group by 1"""))
def _(m):
    return corpus.token_counts(m.table("documents"), "text")


@query("req10_identifier_tokens", r"""
    select p_partkey, array_to_string(list_filter(string_split_regex(lower(replace(regexp_replace(
      replace(p_type, ' ', '_') || 'SizeClass', '([a-z0-9])([A-Z])', '\1 \2', 'g'), '_', ' ')), '\s+'), lambda x: x != ''), ' ') words from part""")
def _(m):
    name = F.concat(F.replace("p_type", F.lit(" "), F.lit("_")), F.lit("SizeClass"))
    return m.table("part").select("p_partkey", F.array_join(identifier_tokens(name), " ").alias("words"))


@query("req11_normalized_sql", sql(r"""
    with f as (select id, lower(replace(regexp_replace(regexp_replace(trim(sql), ';+$', ''), '\s+', ' ', 'g'), '`', '"')) s from sql_texts),
    p as (select id, s, regexp_extract(s, '^(.*?)(select\s+)([^;]+?)(\s+from\s+)(.*)$', ['a', 'b', 'c', 'd', 'e']) g from f)
    select id, trim(case when g.b != '' then g.a || g.b || array_to_string(list_sort(list_transform(string_split(g.c, ','), lambda x: trim(x))), ', ')
      || g.d || g.e else s end) norm from p"""))
def _(m):
    return _filled(m, SQL_FORMS, "sql").select("id", normalize_sql(F.col("sql")).alias("norm"))


# --- corpora -----------------------------------------------------------------------------------------------

PER_TEMPLATE, SEED = 750, 321


def _drawn(m):
    days = m.prices_daily.select("date").distinct()
    return corpus.draws(m.spark, m.tickers, days, PER_TEMPLATE, SEED)


def _unit(salt: str) -> str:
    return f"(('0x' || substr(md5('{SEED}{salt}' || template || draw), 1, 8))::bigint)"


def _pick(name: str, source: str) -> str:
    return (f"(select {name}_v v, row_number() over (order by md5({name}_v::varchar), {name}_v) - 1 pos, count(*) over () n "
            f"from (select distinct {source} {name}_v from {{}}))")


define("draw_rows", f"""
select template, draw, t.v ticker, s.v sector, d.v as day, least(o.v, w.v) as start, greatest(o.v, w.v) as finish,
  year(d.v) y, ([5, 10, 20])[{_unit('k')} % 3 + 1] k
from (select i // {PER_TEMPLATE} template, i % {PER_TEMPLATE} draw from range({len(corpus.TEMPLATES) * PER_TEMPLATE}) r(i)) g
join {_pick('t', 'ticker').format('tickers')} t on t.pos = {_unit('ticker')} % t.n
join {_pick('s', 'sector').format('tickers')} s on s.pos = {_unit('sector')} % s.n
join {_pick('d', 'date').format('prices_daily')} d on d.pos = {_unit('day')} % d.n
join {_pick('o', 'date').format('prices_daily')} o on o.pos = {_unit('one')} % o.n
join {_pick('w', 'date').format('prices_daily')} w on w.pos = {_unit('two')} % w.n""")
_fill = "s"
for _mark, _column in (("ticker", "ticker"), ("sector", "sector"), ("day", "day"), ("start", "start"), ("end", "finish"), ("year", "y"), ("k", "k")):
    _fill = f"replace({_fill}, '{{{_mark}}}', r.{_column}::varchar)"
_templates = ", ".join(f"({i}, {_literal(t.intent)}, {_literal(t.question)}, {_literal(t.sql)}, {_literal(t.needs)})"
                       for i, t in enumerate(corpus.TEMPLATES))
define("pair_rows", f"""
select r.*, intent, needs, {_fill.replace('(s,', '(q,', 1)} question, {_fill} sql from draw_rows r
join (values {_templates}) t(pos, intent, q, s, needs) on t.pos = r.template""")
define("good_pairs", """
select * from pair_rows r where case needs when 'always' then true
  when 'ticker' then ticker in (select ticker from prices_daily)
  when 'ticker_day' then (ticker, day) in (select (ticker, date) from prices_daily)
  when 'ticker_week' then (ticker, date_trunc('week', day)) in (select (ticker, date_trunc('week', date)) from prices_daily)
  when 'ticker_month' then (ticker, date_trunc('month', day)) in (select (ticker, date_trunc('month', date)) from prices_daily)
  when 'ticker_year' then (ticker, y) in (select (ticker, year(date)) from prices_daily)
  when 'day' then day in (select date from prices_daily)
  when 'calendar_day' then day in (select date from trading_calendar where exchange = 'nyse')
  when 'sector_day' then (sector, day) in (select (sector, date) from prices_daily join tickers using (ticker))
  when 'held_day' then day in (select date from prices_daily join portfolio using (ticker))
  when 'actions' then ticker in (select ticker from corporate_actions)
  when 'ticker_before' then exists (select 1 from prices_daily p where p.ticker = r.ticker and p.date <= r.day)
  when 'ticker_range' then exists (select 1 from prices_daily p where p.ticker = r.ticker and p.date between r.start and r.finish)
  when 'dividends_range' then exists (select 1 from dividends p where p.ticker = r.ticker and p.ex_dividend_date between r.start and r.finish)
  when 'splits_range' then exists (select 1 from splits p where p.ticker = r.ticker and p.event_date between r.start and r.finish) end""")
define("kept_pairs", """
select *, lpad(template::varchar, 3, '0') || '-' || lpad(draw::varchar, 6, '0') id from good_pairs
qualify row_number() over (partition by sql order by template, draw) = 1""")


def _good(m):
    return corpus.answerable(corpus.pairs(_drawn(m)), m.prices_daily, m.dividends, m.splits, m.tickers, m.portfolio, m.trading_calendar)


def _kept(m):
    row_id = F.format_string("%03d-%06d", "template", "draw")
    return landed(corpus.distinct_pairs(_good(m)).withColumn("id", row_id), "kept-pairs")  # ranks read the pairs several times


@query("req12_generated_pairs", sql("select template, draw, intent, question, sql from pair_rows"))
def _(m):
    df = corpus.pairs(_drawn(m)).select("template", "draw", "intent", "question", "sql")
    return df.withColumn("template", F.col("template").cast("long"))


@query("req13_answerable_pairs", sql("select template, draw from good_pairs"))
def _(m):
    return _good(m).select(F.col("template").cast("long").alias("template"), "draw")


@query("req14_distinct_and_split", sql(f"""
    select id, case when rn <= floor(n * 0.8) then 'train' when rn <= floor(n * 0.9) then 'val' else 'test' end split from (
      select id, row_number() over (order by md5('{SEED}' || id), id) rn, count(*) over () n from kept_pairs)"""))
def _(m):
    return corpus.train_val_test(_kept(m), SEED).select("id", "split")


@query("req15_fixed_size_splits", sql("""
    with r as (select o_orderkey, row_number() over (order by md5('42' || o_orderkey), o_orderkey) - 1 rk from orders),
    s as (select *, case when rk < 8000 then 'train' when rk < 9500 then 'val' else 'test' end split,
      case when rk < 8000 then rk when rk < 9500 then rk - 8000 else rk - 9500 end pos from r where rk < 10000)
    select o_orderkey, split, cast(pos // 1000 as bigint) shard, case when split = 'train' then printf('train_%02d_%06d', pos // 1000, pos % 1000)
      else split || printf('_%06d', pos) end id from s"""))
def _(m):
    rows = m.table("orders").select("o_orderkey")
    df = ranking.split_by_size(rows, {"train": 8000, "val": 1500, "test": 500}, 42, "o_orderkey", 1000)
    return df.select("o_orderkey", "split", F.col("shard").cast("long").alias("shard"), "id")


@query("req16_metadata", sql(f"""
    with s as (select intent, case when rn <= floor(n * 0.8) then 'train' when rn <= floor(n * 0.9) then 'val' else 'test' end split from (
      select id, intent, row_number() over (order by md5('{SEED}' || id), id) rn, count(*) over () n from kept_pairs))
    select coalesce(split, 'all') split, coalesce(intent, 'all') intent, count(*) n from s group by cube (s.split, s.intent)"""))
def _(m):
    return corpus.metadata(corpus.train_val_test(_kept(m), SEED))


@query("req17_seeded_sample", "select doc_id from documents order by md5('42' || doc_id), doc_id limit 100")
def _(m):
    return ranking.sample_rows(m.table("documents").select("doc_id"), 100, 42, "doc_id")


@query("req18_training_texts", sql("""
    select q.id, '### Question:' || chr(10) || question || chr(10) || chr(10) || '### SQL:' || chr(10) || s.sql as text
    from question_texts q join sql_texts s using (id)"""))
def _(m):
    both = _filled(m, QUESTIONS, "question").select("id", "question").join(_filled(m, SQL_FORMS, "sql").select("id", "sql"), "id")
    return both.select("id", corpus.sql_training_text(F.col("question"), F.col("sql")).alias("text"))


def _object(**fields: str) -> str:
    """SQL of a JSON object that leaves out null fields."""
    listed = ", ".join(f"""'"{name}":' || {value}""" for name, value in fields.items())
    return f"'{{' || array_to_string(list_filter([{listed}], lambda x: x is not null), ',') || '}}'"


def _quoted(value: str) -> str:
    return f"""('"' || {value} || '"')"""


_SPAN = _object(type=_quoted("time_type"), value=_quoted("time_year"), start=_quoted("time_start"), end=_quoted("time_end"))
define("request_texts", "select id, intent, metric_name, " + _object(range=_SPAN) + " as span, " + _object(
    intent=_quoted("intent"),
    entities=_object(assets="('[' || array_to_string(list_transform(assets, lambda x: " + _quoted("x") + "), ',') || ']')"),
    metric=_object(name=_quoted("metric_name"), type=_quoted("metric_type"), arguments=_object(
        year="arg_year", start_date=_quoted("arg_start"), end_date=_quoted("arg_end"), window="arg_window",
        window_unit="case when arg_window is not null then '\"trading_days\"' end")),
    time=_object(range=_SPAN), filters="'[]'", output="""'{"format":"table"}'""") + " as request from sql_requests")


@query("req18_request_training_texts", sql("""
    select id, 'Question: ' || s.sql || chr(10) || 'IR:' || chr(10) || request as text
    from sql_texts s join request_texts using (id)"""))
def _(m):
    rows = requests.from_sql(_filled(m, SQL_FORMS, "sql"))
    return rows.select("id", corpus.request_training_text(F.col("sql"), requests.as_request(rows)).alias("text"))


@query("req19_synthetic_portfolio", sql("""
    with c as (select ticker from tickers order by md5('42' || ticker), ticker limit 30)
    select ticker, cast(('0x' || substr(md5('42shares' || ticker), 1, 8))::bigint % 496 + 5 as double) shares,
      round((('0x' || substr(md5('42cost' || ticker), 1, 8))::bigint / 4294967296.0::double) * 380 + 20, 6) avg_cost from c"""))
def _(m):
    return rounded(corpus.synthetic_portfolio(m.tickers), 6, "avg_cost")


# --- scores --------------------------------------------------------------------------------------------------

def _request_pairs(m):
    """Gold: the request of each SQL text. Prediction: the request of the next form for the same ticker and year; of several
    that fall on one form, that of the first form."""
    rows = requests.from_sql(_filled(m, SQL_FORMS, "sql"))
    gold = rows.select("ticker", "y", "n", requests.as_request(rows).alias("gold"))
    shift = F.when(F.col("n") % 3 == 0, (F.col("n") + 9) % 10).otherwise(F.col("n"))
    pred = rows.select("ticker", "y", shift.alias("n"), F.col("n").alias("from"), requests.as_request(rows).alias("pred"))
    first = pred.groupBy("ticker", "y", "n").agg(F.min_by("pred", "from").alias("pred"))
    return gold.join(first, ["ticker", "y", "n"], "left")


@query("evl1_request_scores", sql("""
    with r as (select ticker, y, n, r.* from sql_texts join request_texts r using (id)),
    p as (select ticker, y, case when n % 3 = 0 then (n + 9) % 10 else n end n, arg_min(request, n) request,
      arg_min(intent, n) intent, arg_min(metric_name, n) metric_name, arg_min(span, n) span from r group by 1, 2, 3)
    select count(*) as rows, round(avg(coalesce(r.request = p.request, false)::int), 9) exact,
      round(avg(coalesce(r.intent = p.intent, false)::int), 9) intent,
      round(avg(coalesce(r.metric_name = p.metric_name, false)::int), 9) metric,
      round(avg(coalesce(r.span = p.span, false)::int), 9) as time
    from r left join p on r.ticker = p.ticker and r.y = p.y and r.n = p.n"""))
def _(m):
    return rounded(scoring.request_scores(_request_pairs(m)), 9, "exact", "intent", "metric", "time")


@query("evl1_metric_accuracy", sql("""
    with g as (select (o_orderkey % 3 <> 0 or o_orderpriority = o_orderstatus)::int i, (o_orderkey % 4 <> 0)::int m,
      (o_orderkey % 5 <> 0)::int t from orders)
    select count(*) as rows, round(avg(i * m * t), 9) exact, round(avg(i), 9) intent, round(avg(m), 9) metric, round(avg(t), 9) as time
    from g"""))
def _(m):
    def request(intent, name, time):
        return F.struct(intent.alias("intent"), F.struct(name.alias("name")).alias("metric"), time.alias("time"))
    key, first, other = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    pred = request(F.when(key % 3 == 0, other).otherwise(first), F.when(key % 4 != 0, other),  # every field differs elsewhere
                   F.when(key % 5 == 0, "year").otherwise("all"))
    pairs = m.table("orders").select(request(first, other, F.lit("all")).alias("gold"), pred.alias("pred"))
    return rounded(scoring.request_scores(pairs), 9, "exact", "intent", "metric", "time")


@query("evl2_asset_scores", sql("""
    with a as (select event_id, case when user_id % 5 = 0 then [] else ['S' || (user_id % 4), 'S' || (user_id % 6), 'S1'] end g,
      case when user_id % 10 = 0 then [] else ['S' || (event_id % 4), 'S1'] end p from events),
    d as (select list_distinct(g) g, list_distinct(p) p from a),
    s as (select len(list_intersect(g, p)) h, len(g) g, len(p) p from d where len(g) + len(p) > 0)
    select round(avg(coalesce(h / nullif(p, 0)::double, 0)), 9) "precision", round(avg(coalesce(h / nullif(g, 0)::double, 0)), 9) recall,
      round(avg(2 * h / (g + p)::double), 9) f1 from s"""))
def _(m):
    def s(col, n):
        return F.concat(F.lit("S"), (F.col(col) % n).cast("string"))
    empty = F.array().cast("array<string>")
    pairs = m.table("events").select(
        F.when(F.col("user_id") % 5 == 0, empty).otherwise(F.array(s("user_id", 4), s("user_id", 6), F.lit("S1"))).alias("gold_assets"),
        F.when(F.col("user_id") % 10 == 0, empty).otherwise(F.array(s("event_id", 4), F.lit("S1"))).alias("pred_assets"))
    return rounded(scoring.asset_scores(pairs), 9, "precision", "recall", "f1")


def _stored_results(m):
    """Results stored per example (order): its lines, and a prediction that changes some lines."""
    lines = m.table("lineitem").select(F.col("l_orderkey").alias("example"), "l_partkey", "l_quantity")
    changed = F.when(F.col("l_partkey") % 7 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    return lines, lines.withColumn("l_quantity", changed)


define("stored_matches", """
with g as (select l_orderkey example, l_partkey k, l_quantity q, count(*) n from lineitem group by 1, 2, 3),
p as (select l_orderkey example, l_partkey k, case when l_partkey % 7 = 0 then l_quantity + 1 else l_quantity end q, count(*) n
  from lineitem group by 1, 2, 3),
j as (select coalesce(g.example, p.example) example, coalesce(g.n, 0) gn, coalesce(p.n, 0) pn
  from g full join p on g.example = p.example and g.k = p.k and g.q = p.q)
select example, bool_and(gn = pn) equal, bool_or(gn > 0 and pn > 0) overlap from j group by 1""")


@query("evl3_result_matches", sql("select example, equal, overlap from stored_matches"))
def _(m):
    return scoring.result_matches(*_stored_results(m), ["l_partkey", "l_quantity"])


@query("evl3_execution_rates", sql("""
    with e as (select o_orderkey example, o_orderkey % 11 != 0 ran_gold, o_orderkey % 13 != 0 ran_pred from orders)
    select count(*) as rows, round(avg(ran_pred::int), 9) execution,
      round(avg((ran_gold and ran_pred and coalesce(equal, true))::int), 9) result_match,
      round(avg((ran_gold and ran_pred and coalesce(overlap, false))::int), 9) partial_match
    from e left join stored_matches using (example)"""))
def _(m):
    key = F.col("o_orderkey")
    examples = m.table("orders").select(key.alias("example"), (key % 11 != 0).alias("ran_gold"), (key % 13 != 0).alias("ran_pred"))
    matches = scoring.result_matches(*_stored_results(m), ["l_partkey", "l_quantity"])
    return rounded(scoring.execution_rates(examples, matches), 9, "execution", "result_match", "partial_match")


@query("evl4_corpus_rates", sql("""
    with e as (select n intent, ticker, y, (y + n) % 5 != 0 ran_gold, (y + n) % 3 != 0 equal from sql_texts)
    select intent, count(*) as rows, round(avg(((y % 2 = 0)::int)), 9) exact,
      round(coalesce(avg(case when ran_gold then equal::int end), 0), 9) execution, round(avg(ran_gold::int), 9) coverage,
      cast(coalesce(sum(case when ran_gold then 1 - equal::int end), 0) as bigint) failures from e group by 1"""))
def _(m):
    # Odd years predict another statement, even years the same one written differently.
    shift = F.col("y") + F.col("n")
    same = F.concat(F.lit("  "), F.upper("sql"), F.lit(" ;"))
    rows = _filled(m, SQL_FORMS, "sql").select(
        F.col("n").alias("intent"), F.col("sql").alias("sql_gold"),
        F.when(F.col("y") % 2 == 0, F.regexp_replace(F.regexp_replace(same, r"\s*;+\s*;?$", ";"), " ", "  ")).otherwise(F.lit("select 1")).alias("sql_pred"),
        (shift % 5 != 0).alias("ran_gold"), (shift % 3 != 0).alias("equal"))
    return rounded(scoring.corpus_rates(rows, ["intent"]), 9, "exact", "execution", "coverage")


@query("evl5_text_matches", """
    select conv_id, turn, lower(trim(text)) = lower(trim(case when turn % 2 = 0 then '  ' || lower(text) else text || '.' end)) exact
    from conversations""")
def _(m):
    other = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("  "), F.lower("text"))).otherwise(F.concat("text", F.lit(".")))
    return m.table("conversations").select("conv_id", "turn", scoring.text_match(F.col("text"), other).alias("exact"))


@query("evl5_structural_matches", sql("select id, n != 4 as same from sql_texts"))
def _(m):
    other = F.concat(F.lit("-- a note\n"), F.replace(F.upper("sql"), F.lit(" FROM"), F.lit(" /* x */\n  FROM")),
                     F.when(F.col("n") == 4, " offset 1").otherwise(""))
    return _filled(m, SQL_FORMS, "sql").select("id", scoring.structural_match(F.col("sql"), other).alias("same"))


@query("evl5_cosine", sql("""
    select a.vec_id, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 9) similarity
    from embeddings a join embeddings b on b.vec_id = a.vec_id + 1"""))
def _(m):
    rows = m.table("embeddings")
    after = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return rows.join(after, "vec_id").select("vec_id", snap(scoring.cosine(F.col("embedding"), F.col("next")), 9).alias("similarity"))
