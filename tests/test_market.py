import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import bars, comovement, joins, series, sets
from tidemark.plans import declared, metrics, views
from tidemark.plans.metrics import Tables

D = dt.date
DAYS = [D(2024, 1, d) for d in (2, 3, 4, 5, 8)]


def prices(spark, **closes):
    rows = [(day, t, c, c, c, c, 10, c, 1) for t, cs in closes.items() for day, c in zip(DAYS, cs)]
    return spark.createDataFrame(rows, schema.PRICES_DAILY)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_returns_with_zero_and_missing_close(spark):
    df = series.daily_returns(prices(spark, A=[10.0, 0.0, 5.0, None, 6.0], B=[4.0]))
    assert rows(df.filter("ticker = 'A'"), "date", "ret") == [
        (DAYS[0], None), (DAYS[1], -1.0), (DAYS[2], None), (DAYS[3], None), (DAYS[4], None)]
    assert rows(df.filter("ticker = 'B'"), "ret") == [(None,)]


def test_yield_is_null_without_a_price_and_repeats_for_two_dividends(spark):
    paid = spark.createDataFrame([("A", DAYS[0], DAYS[0], None, None, 1.0), ("A", DAYS[0], DAYS[0], None, None, 2.0),
                                  ("A", D(2024, 1, 6), D(2024, 1, 6), None, None, 9.0)], schema.DIVIDENDS)
    df = views.dividend_yield_ttm(prices(spark, A=[10.0, 0.0]), paid)
    assert rows(df, "date", "cash_ttm", "dividend_yield_ttm") == [
        (DAYS[0], 3.0, 0.3), (DAYS[0], 3.0, 0.3), (DAYS[1], 3.0, None)]


def test_trailing_year_counts_both_ends(spark):
    data = [("A", D(2023, 1, 1), 1.0), ("A", D(2024, 1, 1), 2.0), ("A", D(2024, 1, 2), 4.0)]
    df = series.trailing_sum(spark.createDataFrame(data, "ticker string, date date, v double"), "v", 365, "s")
    assert rows(df, "date", "s") == [(D(2023, 1, 1), 1.0), (D(2024, 1, 1), 3.0), (D(2024, 1, 2), 6.0)]


def test_split_factors(spark):
    cut = spark.createDataFrame([("A", DAYS[2], DAYS[2], 1.0, 4.0), ("A", DAYS[1], DAYS[1], 0.0, 4.0)], schema.SPLITS)
    base = prices(spark, A=[8.0, 8.0, 2.0])
    kept = dict(rows(views.adjusted_prices_splits(base, cut), "date", "cum_adj_factor"))
    assert kept[DAYS[1]] == 1.0 and math.isclose(kept[DAYS[2]], math.exp(math.log10(0.25)))
    exact = dict(rows(views.adjusted_prices_splits_exact(base, cut), "date", "close_adj_splits_exact"))
    assert exact[DAYS[0]] == pytest.approx(2.0) and exact[DAYS[2]] == pytest.approx(2.0)


def test_period_metrics_use_the_best_close_and_exact_ones_the_last(spark):
    t = Tables(prices(spark, A=[10.0, 15.0, 12.0]))
    assert rows(metrics.ytd_return(t, ["a"], 2024), "as_of_date", "ytd_return") == [(DAYS[2], 0.5)]
    assert metrics.ytd_return(t, ["A"], 2024, exact=True).first()["ytd_return"] == pytest.approx(0.2)
    assert metrics.ytd_return(t, ["A"], 2023).count() == 0


def test_negative_first_close_keeps_the_maximum(spark):
    t = Tables(prices(spark, A=[-2.0, -4.0, 1.0]))
    assert metrics.ytd_return(t, None, 2024).first()["ytd_return"] == pytest.approx(1.0)


def test_unknown_metric_raises(spark):
    with pytest.raises(ValueError):
        metrics.metric("magic", Tables(prices(spark, A=[1.0])))


def test_rolling_frame_is_one_row_longer_than_its_number(spark):
    rets = spark.createDataFrame([(d, "A", float(i)) for i, d in enumerate(DAYS)], "date date, ticker string, ret double")
    vol = dict(rows(series.rolling_volatility(rets, 1), "date", "rolling_vol"))
    assert vol[DAYS[0]] == 0.0 and vol[DAYS[4]] == pytest.approx(0.5)


def test_bars_do_not_depend_on_row_order(spark):
    df = prices(spark, A=[3.0, 1.0, 4.0, 2.0, 9.0]).orderBy(F.desc("date"))
    assert rows(bars.period_bars(df, "week"), "week", "open", "close", "high", "low") == [
        (D(2024, 1, 1), 3.0, 2.0, 4.0, 1.0), (D(2024, 1, 8), 9.0, 9.0, 9.0, 9.0)]


def test_as_of_over_gaps_and_before_the_first_bar(spark):
    data = [("A", D(2023, 1, 5), 1.0), ("A", D(2023, 7, 1), 2.0), ("B", D(2023, 3, 1), 7.0)]
    book = spark.createDataFrame(data, "ticker string, date date, close double")
    asked = [(1, "A", D(2023, 1, 4)), (2, "A", D(2023, 1, 5)), (3, "A", D(2023, 6, 30)), (4, "A", D(2030, 1, 1)),
             (5, "B", D(2023, 3, 1)), (6, "C", D(2023, 3, 1))]
    out = joins.as_of(spark.createDataFrame(asked, "id int, ticker string, as_of date"), book)
    assert dict(rows(out, "id", "close")) == {1: None, 2: 1.0, 3: 1.0, 4: 2.0, 5: 7.0, 6: None}


def test_as_of_matches_brute_force_with_a_hot_ticker(spark):
    days = [D(2020, 1, 1) + dt.timedelta(days=7 * i) for i in range(150)]
    data = [(t, d, float(i)) for t in ("HOT", "X") for i, d in enumerate(days) if (i + len(t)) % 4]
    asked = [(i, "HOT" if i % 3 else "X", D(2019, 12, 20) + dt.timedelta(days=i)) for i in range(1200)]
    out = joins.as_of(spark.createDataFrame(asked, "id int, ticker string, as_of date"),
                      spark.createDataFrame(data, "ticker string, date date, close double"))
    for i, ticker, day, found, _ in out.select("id", "ticker", "as_of", "date", "close").collect():
        assert found == max((d for t, d, _ in data if t == ticker and d <= day), default=None)


def test_range_join_across_years(spark):
    asked = spark.createDataFrame([(1, "A", D(2022, 12, 31), D(2024, 1, 2)), (2, "A", D(2024, 1, 3), D(2024, 1, 3))],
                                  "id int, ticker string, start date, end date")
    out = joins.range_join(asked, prices(spark, A=[1.0, 2.0, 3.0]).select("ticker", "date", "close"))
    assert rows(out, "id", "close") == [(1, 1.0), (2, 2.0)]


def test_open_days_do_not_double_rows(spark):
    cal = spark.createDataFrame([(e, d, True, None, None, None, None) for e in ("nyse", "nasdaq") for d in DAYS[:2]],
                                schema.TRADING_CALENDAR)
    assert joins.on_open_days(prices(spark, A=[1.0, 2.0, 3.0]), cal).count() == 2


def test_historic_calendar_wins_and_hours_follow_daylight_saving(spark):
    def cal(day, is_open):
        at = dt.datetime.combine(day, dt.time(14, 30))
        return spark.createDataFrame([("nyse", day, is_open, at, at)],
                                     "exchange string, date date, is_open boolean, market_open_utc timestamp_ntz, market_close_utc timestamp_ntz")
    both = sets.combine_calendars(cal(D(2024, 3, 8), True).union(cal(D(2024, 3, 11), True)), cal(D(2024, 3, 8), False))
    got = rows(both.withColumn("h", F.date_format("market_open_ny", "HH:mm")), "date", "is_open", "h")
    assert got == [(D(2024, 3, 8), True, "09:30"), (D(2024, 3, 11), True, "10:30")]


def test_row_sets(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    b = spark.createDataFrame([(None, 1), ("x", 2)], "b string, a int")
    assert tuple(sets.same_rows(a, b).first()) == (False, True)
    assert tuple(sets.same_rows(a, a.select("b", "a")).first()) == (True, True)
    assert tuple(sets.same_rows(a.limit(0), a.limit(0)).first()) == (True, False)


def test_pair_statistics_do_not_depend_on_tiles(spark, market):
    rets = series.daily_returns(market.prices_daily)
    one = {(r.a, r.b): r for r in comovement.pair_statistics(rets, 1).collect()}
    many = {(r.a, r.b): r for r in comovement.pair_statistics(rets, 4).collect()}
    assert one.keys() == many.keys() and len(one) == 45
    for key, r in one.items():
        assert r.n == many[key].n
        assert r.covariance is None or r.covariance == pytest.approx(many[key].covariance)


def test_a_pair_leaves_its_tiles_once_whatever_the_years(spark):
    """Rows per pair and year filled the disk: the pairs of a task's tiles are emitted once and never shuffled."""
    data = [(D(year, 1, day), t, float((year * day * k) % 11)) for year in range(2000, 2006) for day in range(1, 9)
            for k, t in enumerate("ABCDE", 2) if (day + k) % 4] + [(None, "A", 1.0), (None, "B", 2.0), (D(2000, 1, 1), None, 3.0)]
    rets = spark.createDataFrame(data, "date date, ticker string, ret double")
    found = comovement.pair_statistics(rets, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Aggregate" not in plan.split("MapInArrow")[0]
    by = {}
    for day, t, r in data:
        by.setdefault(t, {})[day] = r
    for r in found.collect():
        common = [(by[r.a][d], by[r.b][d]) for d in by[r.a].keys() & by[r.b].keys()]
        a, b = (sum(c) / len(common) for c in zip(*common))
        cov = sum((x - a) * (y - b) for x, y in common)
        size = math.sqrt(sum((x - a) ** 2 for x, _ in common) * sum((y - b) ** 2 for _, y in common))
        assert (r.n, r.correlation, r.covariance) == (
            len(common), pytest.approx(cov / size), pytest.approx(cov / (len(common) - 1)))
    assert found.count() == 10 and comovement.pair_statistics(rets, 2, least_days=37).count() < 10
    with pytest.raises(Exception, match="two returns of one date"):
        comovement.pair_statistics(rets.union(rets), 1).collect()


def test_tiles_are_sent_once_whatever_their_number(spark):
    """A copy of each ticker's year for every pair of tiles filled the disk, and bars were made again to count tickers."""
    rets = spark.createDataFrame([(D(2000 + y, 1, d), t, float(((y + 1) * d * k) % 11)) for y in range(2) for d in range(1, 6)
                                  for k, t in enumerate("ABCDEFGH", 2)], "date date, ticker string, ret double")
    found = comovement.pair_statistics(series.daily_returns(rets.withColumnRenamed("ret", "close")), 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan and found.count() == 28
    shuffled = [line for line in plan.splitlines() if "Exchange" in line]
    assert shuffled and all("tile" in line for line in shuffled)  # one row of a ticker and year, to its tile


def test_the_matrix_makes_its_returns_once(spark):
    """The diagonal made all bars and returns again; a ticker without a name is on it, too."""
    rets = spark.createDataFrame([(D(2000, 1, d), t, float(d * k % 11)) for d in range(1, 6) for k, t in ((2, "A"), (3, "B"), (4, None))]
                                 + [(D(2000, 1, 1), "C", None)], "date date, ticker string, ret double")
    found = comovement.correlation_matrix(rets)
    assert "ExistingRDD" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(((r.a, r.b) for r in found.collect()), key=str) == sorted(
        [("A", "A"), ("A", "B"), ("B", "A"), ("B", "B"), (None, None)], key=str)


def test_every_declared_metric_runs(market):
    t = Tables(market.prices_daily, market.dividends, market.splits, market.tickers, market.portfolio, market.trading_calendar)
    for name in declared.DECLARED:
        assert metrics.metric(name, t).columns, name
