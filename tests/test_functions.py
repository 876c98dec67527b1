import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import dates, slots, text

D = dt.date


def one(spark, col, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("kind, args, want", [
    ("all", {}, (None, None)),
    ("year", {"value": 2023}, (D(2023, 1, 1), D(2023, 12, 31))),
    ("month", {"value": "2024-02"}, (D(2024, 2, 1), D(2024, 2, 29))),
    ("month", {"value": 2023, "month": 12}, (D(2023, 12, 1), D(2023, 12, 31))),
    ("last_n_days", {"value": "30"}, (D(2024, 3, 1), D(2024, 3, 31))),
    ("trailing", {"value": 1}, (D(2024, 3, 1), D(2024, 3, 31))),
    ("ytd", {}, (D(2024, 1, 1), D(2024, 3, 31))),
    ("mtd", {}, (D(2024, 3, 1), D(2024, 3, 31))),
    ("since_inception", {}, (None, D(2024, 3, 31))),
])
def test_range_bounds(kind, args, want):
    assert dates.range_bounds(kind, D(2024, 3, 31), **args) == want


def test_unknown_range():
    with pytest.raises(ValueError):
        dates.range_bounds("fortnight", D(2024, 1, 1))


@given(st.dates(D(1990, 1, 1), D(2090, 1, 1)), st.integers(-400, 400))
def test_month_shift_keeps_or_clamps_the_day(day, months):
    out = dates.shift_months(day, months)
    assert (out.year * 12 + out.month) - (day.year * 12 + day.month) == months
    assert out.day == min(day.day, dates.month_bounds(out.year, out.month)[1].day)


@pytest.mark.parametrize("phrase, today, want", [
    ("last quarter", D(2024, 2, 10), (D(2023, 10, 1), D(2023, 12, 31))),
    ("last 1 month", D(2024, 3, 31), (D(2024, 2, 29), D(2024, 3, 31))),
    ("last 2 years please", D(2024, 2, 29), (D(2022, 2, 28), D(2024, 2, 29))),
    (" Last Week", D(2024, 1, 1), (D(2023, 12, 25), D(2023, 12, 31))),
    ("this week", D(2024, 1, 7), (D(2024, 1, 1), D(2024, 1, 7))),
    ("last month", D(2024, 1, 31), (D(2023, 12, 1), D(2023, 12, 31))),
    ("next week", D(2024, 1, 31), None),
    ("over the last 5 days", D(2024, 1, 31), None),
])
def test_phrases(spark, phrase, today, want):
    got = one(spark, dates.phrase_range(F.col("p"), F.col("t")), p=phrase, t=today)
    assert (got and tuple(got)) == want


def test_week_label_before_the_first_monday(spark):
    assert one(spark, dates.period_label(F.col("d"), "week"), d=D(2023, 1, 1)) == "2023-00"
    assert one(spark, dates.period_label(F.col("d"), "week"), d=D(2024, 1, 1)) == "2024-01"


def test_text_cleaning(spark):
    assert one(spark, text.clean_document(F.col("t")), t=" a\r\n\n\n\nb \t c\n") == "a\n\nb c"
    assert one(spark, text.clean_sentence(F.col("t")), t="\t a​b \n c ") == "ab c"


def test_labels(spark):
    for value, want in [(" Positive", 2), ("NEGATIVE", 0), ("neutral", 1), ("odd", 1), ("2", 2), (None, 1)]:
        row = spark.createDataFrame([(value,)], "v string")
        assert row.select(text.sentiment_label(F.col("v"))).first()[0] == want


def test_marks_are_tokens(spark):
    assert one(spark, text.tokens(F.col("t")), t="Close>=5, (ret)") == ["close", ">", "=", "5", ",", "(", "ret", ")"]
    assert one(spark, text.identifier_tokens(F.col("t")), t="closeAdj_splits") == ["close", "adj", "splits"]


def test_sql_key(spark):
    assert one(spark, text.normalize_sql(F.col("t")), t=" SELECT b,  a\nFROM `t` ;; ") == 'select a, b from "t"'
    assert one(spark, text.normalize_sql(F.col("t")), t="drop it;") == "drop it"


def test_between_with_and_without_the_word(spark):
    for sql in ("x.date BETWEEN '2024-01-01' AND '2024-02-01'", "date between DATE '2024-01-01' and DATE '2024-02-01'"):
        fields = slots.request_fields(F.col("t"))
        assert one(spark, F.array(fields["start"], fields["end"]), t=sql) == ["2024-01-01", "2024-02-01"]


def told(spark, columns, text):
    """The values of named columns over one text, without those that are NULL."""
    row = spark.createDataFrame([(text,)], "t string").select(F.struct(*[c.alias(n) for n, c in columns.items()])).first()[0]
    return {name: value for name, value in row.asDict().items() if value is not None}


@pytest.mark.parametrize("sql, expected", [
    ("SELECT AVG(p.Close) FROM core.prices p WHERE p.ticker IN ('ab', \"c\" ) AND date BETWEEN '2024-01-02' AND '2024-02-03';;",
     {"agg": "avg", "from_table": "core.prices", "sel_col": "p.close", "tickers": ["ab", "c"], "date_from": "2024-01-02",
      "date_to": "2024-02-03"}),
    ("select max(volume), count(ticker) from core.prices where x = 1 and ticker = 'ab' and ticker in ('c') order by day_desc limit 7",
     {"agg": "max", "from_table": "core.prices", "sel_col": "prices.volume", "ticker": "ab", "top_k": 7, "order_col": "day_desc",
      "order_dir": "asc"}),
    ("select `close`, t.x from a where date >= '2024-01-02' order by close desc, t.x asc",
     {"agg": "none", "from_table": "a", "sel_col": "t.x", "date_from": "2024-01-02", "order_col": "close", "order_dir": "desc"}),
    ("select close from a join b on 1 = 1 where date <= '2024-01-02' and date >= '2023-01-02'",
     {"agg": "none", "from_table": "a", "sel_col": "a.close", "date_from": "2023-01-02", "date_to": "2024-01-02"}),
    ("select sum(x) over (order by d), row_number() over (order by e desc) from t",
     {"agg": "sum", "from_table": "t", "sel_col": "t.x", "order_col": "d", "order_dir": "asc"}),
    ("select * from t", {"agg": "none", "from_table": "t"}),
    ("select 1", {"agg": "none"}), ("", {"agg": "none"}), (None, {"agg": "none"}),
])
def test_sql_slots_by_hand(spark, sql, expected):
    assert told(spark, slots.sql_slots(F.col("t")), sql) == expected


@pytest.mark.parametrize("question, expected", [
    ("Top 5 of NYSE technology stocks like AB on 2024-01-02 10:30:00?",
     {"period_dt": "2024-01-02 10:30:00", "date_from": "2024-01-02", "date_eq": "2024-01-02", "top_k": 5, "ticker": "AB",
      "sector": "technology", "exchange": "nyse"}),
    ("return of ABC from 2024-01-02\nto 2024-02-03, then 2024-03-04",
     {"period_dt": "2024-01-02", "date_from": "2024-01-02", "date_to": "2024-02-03", "top_k": 1, "ticker": "ABC"}),
    ("7-day and 30 day returns, 90d", {"top_k": 7, "ret_windows": [7, 30]}),
    ("20d and 5 d change since 2024-01-02", {"period_dt": "2024-01-02", "date_from": "2024-01-02", "ret_windows": [20, 5], "top_k": 5}),
    ("sector  space travel, real estate and energy", {"sector": "energy"}),
    ("the sector space travel!", {"sector": "space travel"}), ("the sector  ", {}),
    ("TOOLONG names only", {}), ("", {}), (None, {}),
])
def test_question_hints_by_hand(spark, question, expected):
    assert told(spark, slots.question_hints(F.col("t")), question) == expected


@pytest.mark.parametrize("sql, expected", [
    ("SELECT ticker FROM x, (SELECT 1 FROM Views.a), (SELECT 1 FROM views.b) WHERE ticker = 'AB' AND ticker IN ('C', 'AB', D,'')",
     {"metric_name": "close", "base_table": "views.b", "assets": ["AB", "C", ""]}),
    ("SELECT max(rolling_volume) FROM portfolio_old, (SELECT 1 FROM portfolio) WHERE extract( YEAR from d ) = 2024",
     {"metric_name": "rolling_volatility", "base_table": "portfolio", "year": 2024, "assets": []}),
    ("select unrealized_pnl, daily_returns from portfolio", {"metric_name": "portfolio_value", "base_table": "portfolio", "assets": []}),
    ("select first_close_mtd, portfolio from a", {"metric_name": "mtd_return", "base_table": "a", "assets": []}),
    ("select avg(c) over (rows between 19 preceding and current row) rolling_ret from a where date between DATE '2024-01-02' and '2024-02-03'",
     {"metric_name": "rolling_return", "base_table": "a", "window": 19, "start": "2024-01-02", "end": "2024-02-03", "assets": []}),
    ("", {"metric_name": "close", "assets": []}), (None, {"metric_name": "close", "assets": []}),
])
def test_request_fields_by_hand(spark, sql, expected):
    assert told(spark, slots.request_fields(F.col("t")), sql) == expected


@pytest.mark.parametrize("name, table, kind, intent", [
    ("ytd_return", "views.prices", "return", "get_ytd_return"), ("portfolio_value", "x", "portfolio", "evaluate_portfolio"),
    ("close", "core.prices_daily", "price", "get_price"), ("close", "views.corporate_actions", "price", "get_corporate_actions"),
    ("drawdown", "x", "risk", "compute_metric"), ("unknown", None, "descriptive", "compute_metric"),
])
def test_metric_words_by_hand(spark, name, table, kind, intent):
    row = spark.createDataFrame([(name, table)], "n string, t string").select(
        slots.metric_type(F.col("n")), slots.metric_intent(F.col("n"), F.col("t"))).first()
    assert list(row) == [kind, intent]


def test_vocabulary_means_itself(spark):
    assert one(spark, slots.canonical(F.col("t"), "layer"), t=" Precio de cierre ") == "price"
    assert one(spark, slots.canonical(F.col("t"), "metric"), t="ytd_return") == "ytd_return"
    assert one(spark, slots.canonical(F.col("t"), "time"), t="someday") is None


def test_shared_folder_is_named_on_a_cluster():
    from types import SimpleNamespace

    from tidemark.session import shared_folder

    def session(master, folder=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: folder), sparkContext=SimpleNamespace(master=master))

    assert shared_folder(session("spark://host:7077", "/shared/")) == "/shared"
    assert shared_folder(session("local[8]")) == shared_folder(session("local"))
    with pytest.raises(ValueError):
        shared_folder(session("spark://host:7077"))
