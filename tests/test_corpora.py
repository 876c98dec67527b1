import collections
import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import staging
from tidemark.operators import cleaning, conversations, corpus, documents, ranking, scoring, sentiment
from tidemark.plans import requests
from tidemark.plans.metrics import Tables
from tidemark.registry import load
from tidemark.registry import market as registered
from tidemark.sources import payloads, readers, sinks

D = dt.date


# --- ranks and splits --------------------------------------------------------------------------------------

def test_ranks_are_exact_with_a_third_of_rows_in_one_group(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 10)
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("g"))
    out = ranking.ranked(rows.withColumn("h", F.md5(F.col("id").cast("string"))), "h", ["g"], ["id"]).collect()
    by_group = collections.defaultdict(list)
    for r in out:
        by_group[r.g].append((r.h, r.id, r["rank"], r.group_rows))
    for members in by_group.values():
        members.sort()
        assert [m[2] for m in members] == list(range(len(members)))
        assert {m[3] for m in members} == {len(members)}


def test_keep_first_takes_the_first_of_a_hot_key(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"), (1000 - F.col("id")).alias("row"))
    out = ranking.keep_first(rows, ["text"], ["row"])
    assert out.filter("text = 'same'").first()["row"] == 1 and out.count() == 667


def test_stratified_shares(spark):
    rows = spark.range(200).select(F.col("id").cast("string").alias("id"), (F.col("id") % 2).alias("label"))
    got = {(r.label, r.split): r["count"] for r in sentiment.stratified_split(rows).groupBy("label", "split").count().collect()}
    assert got == {(g, s): n for g in (0, 1) for s, n in (("train", 70), ("val", 15), ("test", 15))}


def test_top_puts_missing_values_last_and_breaks_ties(spark):
    rows = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None), ("d", 2.0)], "k string, v double")
    assert [r.k for r in ranking.top(rows, "v", 4, ["k"]).collect()] == ["d", "a", "b", "c"]
    assert [r.k for r in ranking.top(rows, "v", 4, ["k"], descending=False).collect()] == ["a", "b", "d", "c"]


# --- documents ---------------------------------------------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab. \n", max_size=400), st.integers(8, 60))
def test_chunks_cover_the_text(text, size):
    overlap = size // 3
    chunks = documents.chunk_text(text, size, overlap)
    end = 0
    for start, chunk in chunks:
        # Every chunk stands where it says, ends after the one before, and nothing but space lies between the two.
        assert 0 < len(chunk) <= size and chunk == chunk.strip() and text[start:start + len(chunk)] == chunk
        assert not text[end:start].strip() and end - start <= overlap
        end = max(end, start + len(chunk))
    assert not text[end:].strip()


def test_chunks_leave_the_worker_in_small_batches(spark):
    """All chunks of a batch of documents were held at once, as one column of lists: memory grew with the documents."""
    texts = [None, "", "  ", "one. two. three", "word " * 9000, "x" * 4000, "one. two. three"]
    data = [(i % 5 or None, t) for i, t in enumerate(texts)]
    found = documents.chunks(spark.createDataFrame(data, "k long, text string").coalesce(1), "k", size=7, overlap=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
    assert found.dtypes == [("k", "bigint"), ("chunk_no", "int"), ("chunk", "string"), ("chunk_start", "bigint")]
    wanted = [(k, no, c, at) for k, t in data for no, (at, c) in enumerate(documents.chunk_text(t or "", 7, 2))]
    assert len(wanted) > 3 * documents.CHUNK_ROWS
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, wanted))


def test_chunks_of_a_paragraph_repeat_its_tail():
    text = " ".join(f"word{i}" for i in range(40))
    chunks = [chunk for _, chunk in documents.chunk_text(text, 60, 20)]
    for left, right in zip(chunks, chunks[1:]):
        assert left.split()[-1] in right.split()[:3]
    assert documents.chunk_text("", 10, 2) == [] and documents.chunk_text("  x ", 10, 2) == [(2, "x")]


def test_what_queries_open_leaves_in_bounded_batches():
    """Every vector that 512 queries send to all rings was held at once: 512 times the rings."""
    rng = np.random.default_rng(3)
    rings = documents.Rings(rng.normal(size=(8, 4)))
    rings.measured([(c, r, 4, 0.0, 9.0) for c in range(8) for r in range(40)], 4)
    vectors = rng.normal(size=(300, 4))
    asked = pd.DataFrame({"query_id": np.arange(300), "vector": list(vectors), "limit": np.nan})
    early = list(documents._visits(rings, 3, False)(iter([asked])))
    late = list(documents._visits(rings, 3, True)(iter([asked])))
    assert max(map(len, early + late)) <= documents.BLOCK_ROWS < 300 * 320 and len(early[0]) > 0
    every = pd.concat(early + late)
    assert len(every) == 300 * 320 and not every.duplicated(["query_id", "cell", "ring"]).any()
    assert all((v == vectors[q]).all() for q, v in zip(every["query_id"], every["vector"]))


@pytest.mark.parametrize("n", [3, 8, 9, 700])
def test_closest_of_a_block_by_distance_and_id(n):
    """Copies of one vector tie with all of a block: they are measured some at a time and settled by id."""
    rng = np.random.default_rng(n)
    items = rng.integers(0, 3, (n, 3)).astype(float)
    asked, ids = np.concatenate([rng.integers(0, 3, (300, 3)), np.full((40, 3), np.nan)]).astype(float), rng.permutation(n) + 10
    found = documents._hits(np.arange(340) + 5, asked, ids, items, 8)
    for q in range(300):
        wanted = sorted((float(np.sqrt(((v - asked[q]) ** 2).sum())), int(i)) for v, i in zip(items, ids))[:8]
        mine = found[found["query_id"] == q + 5]
        assert list(zip(mine["distance"], mine["item_id"])) == wanted
    assert (found["query_id"] >= 305).sum() == (40 * n if n <= 8 else 0)


def test_nearest_is_exact_with_ties(spark, monkeypatch):
    monkeypatch.setattr(documents, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(1)
    grid = rng.integers(0, 3, (90, 3)).astype(float)
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(grid)], "item_id long, vector array<double>")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(grid[:40])], "query_id long, vector array<double>")
    got = collections.defaultdict(list)
    for r in documents.nearest(asked, items, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.item_id)
    for q in range(40):
        want = sorted(range(90), key=lambda i: (np.sqrt(((grid[i] - grid[q]) ** 2).sum()), i))[:5]
        assert got[q] == want


def test_distinct_hits_and_context(spark):
    hits = spark.createDataFrame([(1, 5, 0.1, 1), (1, 6, 0.2, 2), (1, 7, 0.3, 3)], "query_id long, item_id long, distance double, rank int")
    texts = spark.createDataFrame([(5, "a"), (6, "a"), (7, "b")], "item_id long, text string")
    kept = documents.distinct_hits(hits, texts, 2)
    assert documents.context(kept).first()["context"] == "a\n\n---\n\nb"


def test_question_rows(spark):
    data = [(1, " ", "Report.PDF", None, "q", "a"), (2, None, None, "http://x/y/Z.pdf?v=1", "q", "a"), (3, None, None, None, "q", "a"),
            (4, "Bad.pdf", None, None, "q", "a"), (5, "ok", None, None, None, "a")]
    df = spark.createDataFrame(data, "id int, doc_name string, doc string, url string, query string, label string")
    out = documents.question_answer_rows(df, spark.createDataFrame([("bad",)], "doc string"), "http://b/")
    assert sorted((r.id, r.doc, r.url) for r in out.collect()) == [
        (1, "Report.PDF", "http://b/Report.PDF"), (2, "Z", "http://x/y/Z.pdf?v=1"), (5, "ok", "http://b/ok.pdf")]
    assert documents.question_answers(out).count() == 2


# --- sentiment and conversations -----------------------------------------------------------------------------

def test_labelled_lines(spark):
    lines = spark.createDataFrame([("a@b @positive",), ("no label",), ("x@Odd",), (" ​y @ NEGATIVE ",)], "value string")
    got = sorted((r.text, r.label) for r in readers.labelled_lines(lines).collect())
    assert got == [("a@b", 2), ("x", 1), ("y", 0)]


def test_report_of_a_class_never_predicted(spark):
    rows = spark.createDataFrame([(0, 0), (1, 0), (1, 1), (2, 1)], "y_true int, y_pred int")
    got = {r.name: r for r in sentiment.report(rows).collect()}
    assert (got["2"].precision, got["2"].recall, got["2"].f1, got["2"].support) == (0.0, 0.0, 0.0, 1)
    assert got["accuracy"].f1 == 0.5 and got["macro avg"].recall == pytest.approx(0.5)


def test_chat_titles_and_history(spark):
    log = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "x" * 31), (1, 2, "assistant", " "), (2, 0, "user", "short")],
                                "conv_id long, turn long, role string, text string")
    assert {r.conv_id: r.title for r in conversations.titles(log).collect()} == {1: "x" * 30 + "...", 2: "New Chat"}
    assert sorted(r.turn for r in conversations.history(log).filter("conv_id = 1").collect()) == [1]
    assert one_bool(spark, "What is the YIELD?") and not one_bool(spark, "hello AAPL")


def one_bool(spark, message):
    return spark.createDataFrame([(message,)], "t string").select(conversations.is_financial(F.col("t"))).first()[0]


# --- requests and scores -------------------------------------------------------------------------------------

def test_model_text(spark):
    data = [(1, 'x {"intent": "get_price", "metric": {"name": "open"}} {'), (2, "no block"), (3, '{"a": {broken}'), (4, '{bad} {"intent": "i"}')]
    df = spark.createDataFrame(data, "id int, text string")
    strict = {r.id: r.request and r.request.intent for r in requests.parsed(df).collect()}
    assert strict == {1: "get_price", 2: None, 3: None, 4: None}


def test_intent_gives_the_metric_and_defaults_apply(spark):
    df = spark.createDataFrame([(1, '{"intent": "get_ytd_return", "entities": {"assets": ["A"]}}')], "request_id long, text string")
    row = requests.flat_requests(requests.parsed(df)).first()
    assert (row.metric, row.low, row.high, row.window) == ("ytd_return", D(2024, 1, 1), D(2024, 12, 31), 30)


def test_evaluation_of_every_request_kind(spark):
    prices = spark.createDataFrame([(D(2024, 1, d), t, c, c, c, c, 1, c, 1) for t in "AB" for d, c in ((2, 4.0), (3, 8.0), (9, 2.0))],
                                   schema.PRICES_DAILY)
    paid = spark.createDataFrame([("A", D(2024, 1, 6), D(2024, 1, 6), None, None, 1.5)], schema.DIVIDENDS)
    held = spark.createDataFrame([("B", 3.0, 1.0)], schema.PORTFOLIO)
    asked = [(1, "close", ["a"], None, D(2024, 1, 2)), (2, "close", [], D(2024, 1, 9), None), (3, "period_return", ["My Portfolio"], D(2024, 1, 1), D(2024, 12, 31)),
             (4, "dividend_amount", ["A"], None, None), (5, "portfolio_value", ["A"], None, None), (6, "magic", ["A"], None, None),
             (7, "close", ["A"], D(2030, 1, 1), D(2029, 1, 1)), (8, "rolling_volatility", ["A"], D(2024, 1, 1), D(2024, 12, 31))]
    table = spark.createDataFrame([(*a, 1) for a in asked], "request_id long, metric string, assets array<string>, low date, high date, window int")
    t = Tables(prices, paid, portfolio=held)
    got = sorted((r.request_id, r.ticker, r.value) for r in requests.evaluate(table, t).filter("request_id < 8").collect())
    assert got == [(1, "A", 4.0), (2, "A", 2.0), (2, "B", 2.0), (3, "B", 1.0), (4, "A", 1.5), (5, "B", 6.0)]
    rolled = {r.date.day: r.value for r in requests.evaluate(table, t).filter("request_id = 8").collect()}
    assert rolled == {2: None, 3: 0.0, 9: pytest.approx(0.875)}
    why = {r.request_id: r.reason for r in requests.rejected(table).collect()}
    assert why == {6: "unknown metric", 7: "start after end"}
    names = spark.createDataFrame([("A", "Ay Inc")], "ticker string, name string")
    lines = {(r.request_id, r.part): r.line for r in requests.answer_lines(table, requests.evaluate(table, t), names).collect() if r.request_id != 8}
    assert lines[(1, 0)] == "The closing price for Ay Inc is 4.0000."
    assert lines[(3, 0)] == "The period return for B is 100.00%."
    assert lines[(2, 0)] == "The closing price for your portfolio are:"
    assert lines[(7, 0)] == "There is no data available for this query."


def test_result_matches(spark):
    gold = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (2, "b", None)], "example int, k string, v int")
    pred = spark.createDataFrame([(1, "a", 1), (2, "b", None)], "example int, k string, v int")
    got = {r.example: (r.equal, r.overlap) for r in scoring.result_matches(gold, pred, ["k", "v"]).collect()}
    assert got == {1: (False, True), 2: (True, True)}


# --- sources -------------------------------------------------------------------------------------------------

def test_missing_and_bad_columns(spark):
    df = spark.createDataFrame([("2024-01-05", "x", "7.9"), ("05/01/2024", "1e3", None)], "day string, n string, i string")
    out = cleaning.ensure_columns(df, {"day": "date", "n": "float", "i": "int", "gone": "date"}).collect()
    assert [tuple(r) for r in out] == [(D(2024, 1, 5), None, 7, None), (None, 1000.0, None, None)]


def test_required_columns(spark):
    with pytest.raises(ValueError):
        cleaning.normalize_portfolio(spark.createDataFrame([("A", 1)], "Symbol string, Qty int"))
    with pytest.raises(ValueError):
        cleaning.ticker_list(spark.createDataFrame([("A",)], "code string"))
    good = cleaning.normalize_portfolio(spark.createDataFrame([("A", 1, 2.0)], ["Stock", "Position Size", "avg_cost"]))
    assert good.columns == ["ticker", "shares", "avg_cost"]


def test_payload_items_without_dates_go(spark):
    page = [("A", [(None, "2024-01-02", None, None, "0.5"), (None, None, None, None, "1")]), ("B", None)]
    out = payloads.dividends(spark.createDataFrame(page, schema.DIVIDENDS_PAYLOAD)).collect()
    assert [(r.ticker, r.event_date, r.cash_amount) for r in out] == [("A", D(2024, 1, 2), 0.5)]


def test_partition_writes_and_incremental_load(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.createDataFrame([("A", D(2024, 1, 2), 1.0), ("B", D(2024, 1, 2), 2.0)], "ticker string, date date, close double")
    sinks.by_ticker(rows, path)
    sinks.by_ticker(rows.filter("ticker = 'A'").withColumn("close", F.lit(9.0)), path)
    back = {r.ticker: r.close for r in spark.read.parquet(path).collect()}
    assert back == {"A": 9.0, "B": 2.0}
    wanted = spark.createDataFrame([("A",), ("C",)], "ticker string")
    assert [r.ticker for r in sinks.not_landed(wanted, spark.read.parquet(path)).collect()] == ["C"]


def test_a_ticker_is_one_file_written_beside_others(spark, tmp_path):
    """A file for each ticker and year, all by one task of a small table, took most of the load's time."""
    path = str(tmp_path / "p")
    data = [(f"T{i}", D(year, 1, 2), float(i)) for i in range(24) for year in range(2000, 2005)] + [(None, D(2000, 1, 2), 1.0), ("T1", None, 2.0)]
    sinks.by_ticker(spark.createDataFrame(data, "ticker string, date date, close double"), path)
    folders = list((tmp_path / "p").glob("ticker=*"))
    files = [f.name for folder in folders for f in folder.glob("*.parquet")]
    assert len(folders) == len(files) == 25
    assert len({name.split("-")[1] for name in files}) > 1  # the number of the task
    back = [tuple(r) for r in spark.read.parquet(path).select("ticker", "date", "close").collect()]
    assert sorted(map(str, back)) == sorted(map(str, data))


def test_broken_json_lines_are_skipped(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "1", "sql": "s"}\n{"id": "2"\n\n{"id": "3", "sql": "t"}\n')
    assert sorted(r.id for r in readers.json_lines(spark, str(tmp_path), "id string, sql string").collect()) == ["1", "3"]


def test_draws_never_land_on_missing_values(spark):
    from tidemark.operators import corpus
    tickers = spark.createDataFrame([("A", "x"), ("B", None), ("C", "y")], "ticker string, sector string")
    days = spark.createDataFrame([(D(2024, 1, 2),), (None,), (D(2024, 1, 3),)], "date date")
    assert corpus.draws(spark, tickers, days, 50, 1).count() == 50 * len(corpus.TEMPLATES)


def test_negative_rolling_windows_are_rejected(spark):
    rows = spark.createDataFrame([(1, "rolling_volatility", -3, ["A"]), (2, "rolling_volatility", 5, ["A"]), (3, "close", -3, ["A"]), (4, None, 1, ["A"])],
                                 "request_id long, metric string, window int, assets array<string>")
    assert sorted(r.request_id for r in requests.rejected(rows).collect()) == [1, 4]


def test_filters_text_arguments_and_reasons(spark):
    prices = spark.createDataFrame([(D(y, 1, d), "A", c, c, c, c, 1, c, 1) for y, d, c in ((1998, 2, 4.0), (1998, 3, 8.0), (2024, 2, 2.0))],
                                   schema.PRICES_DAILY)
    one = '"entities": {"assets": ["A"]}'
    texts = [
        (1, '{"metric": {"name": "close"}, %s, "filters": [{"field": "close", "op": ">", "value": 5}]}' % one),
        (2, '{"metric": {"name": "ytd_return", "arguments": {"year": "1998"}}, %s}' % one),
        (3, '{"metric": {"name": "close"}, %s, "filters": [{"field": "date", "op": "between", "value": ["1998-01-03", "2023-01-01"]}]}' % one),
        (4, '{"metric": {"name": "close"}, %s, "filters": [{"field": "close", "op": "IN", "value": [4, 2]}, {"field": "ticker", "op": "LIKE", "value": "A%%"}]}' % one),
        (5, '{"metric": {"name": "close"}, %s, "filters": [{"field": "colour", "value": "red"}]}' % one),
        (6, '{"metric": {"name": "ytd_return", "arguments": {"year": "soon"}}, %s}' % one),
        (7, '{"metric": {"name": "ytd_return"}}'), (8, "words only"),
        (9, '{"metric": {"name": "ytd_return", "arguments": {"year": 1998}}, %s, "filters": [{"field": "close", "op": ">", "value": 5}]}' % one)]
    flat = requests.flat_requests(requests.parsed(spark.createDataFrame(texts, "request_id long, text string")))
    got = sorted((r.request_id, r.value) for r in requests.evaluate(flat, Tables(prices)).collect())
    assert got == [(1, 8.0), (2, 1.0), (3, 8.0), (4, 2.0), (4, 4.0), (9, 1.0)]
    assert {r.request_id: r.reason for r in requests.rejected(flat).collect()} == {
        5: "unclear filter", 6: "unreadable argument", 7: "no assets", 8: "no request"}


def test_requests_for_many_tickers_are_landed_without_their_tickers(spark, monkeypatch):
    days = (D(2024, 1, 2), D(2024, 2, 3), D(2024, 3, 9))
    prices = spark.createDataFrame([(d, f"T{i}", c, c, c, c, i, c, 1) for i in range(60) for d, c in zip(days, (4.0, 8.0, 2.0))],
                                   schema.PRICES_DAILY)
    held = spark.createDataFrame([(f"T{i}", 1.0, 1.0) for i in (*range(50), 3)], schema.PORTFOLIO)
    year = (D(2024, 1, 1), D(2024, 12, 31))
    asked = [(i, "close", [], *year) for i in range(40)] + [(i, "ytd_return", ["My Portfolio"], *year) for i in range(40, 80)] + [
        (80, "rolling_return", ["my holdings", "my portfolio"], D(2024, 2, 1), D(2024, 12, 31)),
        (81, "close", ["*", "t7", "x"], *year), (82, "close", ["T7", "t7", None], *year), (82, "close", ["T7"], *year),
        (None, "close", ["t1"], *year), (83, "volume", ["My Portfolio"], *year), (83, "volume", ["t59", "t1"], *year)]
    table = spark.createDataFrame([(*a, 5) for a in asked], "request_id long, metric string, assets array<string>, low date, high date, window int")
    rows = {}

    def landed(df, label):
        out = staging.landed(df, label)
        rows[label] = max(rows.get(label, 0), out.count())
        return out

    monkeypatch.setattr(requests, "landed", landed)
    got = requests.evaluate(table, Tables(prices, portfolio=held)).collect()
    assert len(got) == len({(r.request_id, r.metric, r.ticker, r.date) for r in got})
    assert collections.Counter(r.request_id for r in got) == {
        **{i: 180 for i in range(40)}, **{i: 50 for i in range(40, 80)}, 80: 100, 81: 180, 82: 3, None: 3, 83: 153}
    assert {r.value for r in got if 40 <= (r.request_id or 0) < 80} == {1.0}
    assert {(r.date.month, round(r.value, 9)) for r in got if r.request_id == 80} == {(2, 1.0), (3, -0.5)}
    assert max(rows["asked"], rows["requests"]) < 40 * 60  # one row per request and ticker would be 4400


def test_date_filters_become_the_range_and_others_stay(spark):
    days = [D(2024, 1, d) for d in range(1, 10)]
    prices = spark.createDataFrame([(d, "A", *[float(d.day)] * 4, d.day, 1.0, 1) for d in days], schema.PRICES_DAILY)
    kept = {(">=", "2024-01-04"): range(4, 10), (">", "2024-01-04"): range(5, 10), ("<=", "2024-01-04"): range(1, 5),
            (" < ", "2024-01-04"): range(1, 4), (None, "2024-01-04"): range(4, 5), ("!=", "2024-01-04"): [1, 2, 3, 5, 6, 7, 8, 9],
            (">=", "2024-1-4"): [], (">=", "2024-01"): range(1, 10), ("<", "2024-01-05x"): range(1, 6), (">", "2025-01-01"): []}
    close = ("close", "<", "6")
    asked = [(i, "close", ["A"], [("date", *f), *([close] if i >= 20 else [])]) for n in (0, 20) for i, f in enumerate(kept, n)]
    table = spark.createDataFrame(asked, "request_id long, metric string, assets array<string>, filters array<struct<field:string,op:string,value:string>>")
    got = collections.defaultdict(list)
    for r in requests.evaluate(table, Tables(prices)).collect():
        got[r.request_id].append(r.date.day)
    for i, wanted in enumerate(kept.values()):
        assert sorted(got[i]) == list(wanted)
        assert sorted(got[20 + i]) == [d for d in wanted if d < 6]


def test_printed_values_equal_formatted_ones(spark):
    halves = [k / 20000 for k in range(-60, 60)]
    data = [*halves, 0.0, -0.0, -1e-9, 1.00015, 2.675, 1e10 + 0.12345, 123456.78905, 99999999.99995, -0.99995, 1e18, 1e300, float("nan"), float("inf"),
            float("-inf"), None, 0.07, 12.3456, -7.00004999]
    df = spark.createDataFrame([(x,) for x in data], "x double")
    for digits in (2, 4):
        for r in df.select("x", requests._fixed(F.col("x"), digits).alias("a"), F.format_string(f"%.{digits}f", F.bround("x", digits)).alias("b")).collect():
            assert r.a == r.b, r


def test_answers_read_the_texts_once(spark, tmp_path):
    when = dt.datetime(1998, 1, 5)
    tables = {
        "region": ([(0, "R")], "r_regionkey int, r_name string"), "nation": ([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(k, f"Supplier {k}", 0, 9000.0) for k in (1, 2)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "orders": ([(k, 1, when) for k in (17, 34, 357)], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "lineitem": ([(1, 1, s, 1, 2.0, 10.0, 0.0, 0.0, "N", when) for s in (1, 2)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp")}
    for name, (data, kind) in tables.items():
        spark.createDataFrame(data, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = load()[0]["fmt1_answers"](spark, str(tmp_path))
    assert "python" not in lines._jdf.queryExecution().toString().lower()
    assert sorted((r.request_id, r.part, r.line) for r in lines.collect()) == [
        (17, 0, "The closing price for Supplier 1 is 5.0000."), (34, 0, "The closing price for Supplier 1 is 5.0000."),
        (357, 0, "The closing price for your portfolio are:"), (357, 1, "- Supplier 1: 5.0000"), (357, 1, "- Supplier 2: 5.0000")]


def test_portfolio_in_a_request_stands_alone(spark):
    bars = spark.createDataFrame([("A", D(2024, 1, 2), 1.0), ("B", D(2024, 1, 2), 2.0)], "ticker string, date date, close double")
    held = spark.createDataFrame([("B", 1.0, 1.0)], "ticker string, shares double, avg_cost double")
    asked = spark.createDataFrame([(1, "close", ["My Portfolio", "A"]), (2, "close", ["a"])],
                                  "request_id long, metric string, assets array<string>")
    got = requests._asked(asked, Tables(bars, portfolio=held)).collect()
    assert sorted((r.request_id, r.ticker) for r in got) == [(1, "B"), (2, "A")]


def test_shared_folder_must_be_set_on_a_cluster():
    from tidemark import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Fake:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})()

    with pytest.raises(ValueError):
        session.shared_folder(Fake())


# --- answerable pairs, texts and neighbours at scale -------------------------------------------------------------

def test_answerable_pairs_match_brute_force(spark):
    """Every need, with days before, within, between and after a ticker's events."""
    from tidemark.operators import corpus

    rng = np.random.default_rng(4)
    day = lambda n: D(1999, 11, 20) + dt.timedelta(days=int(n))
    bars = {("A", day(n)) for n in rng.integers(0, 400, 25)} | {("B", day(n)) for n in rng.integers(100, 140, 9)} | {("C", day(300))}
    paid = {("A", day(n)) for n in rng.integers(0, 400, 4)} | {("D", day(31))}
    split = {("B", day(n)) for n in rng.integers(0, 400, 3)}
    sector = {"A": "x", "B": "y", "C": "x", "E": "z"}
    tables = (spark.createDataFrame(sorted(bars), "ticker string, date date"),
              spark.createDataFrame(sorted(paid), "ticker string, ex_dividend_date date"),
              spark.createDataFrame(sorted(split), "ticker string, event_date date"),
              spark.createDataFrame(list(sector.items()), "ticker string, sector string"),
              spark.createDataFrame([("B",), ("B",)], "ticker string"),
              spark.createDataFrame([("nyse", day(n)) for n in range(0, 400, 3)] + [("nasdaq", day(1))], "exchange string, date date"))
    needs = ("always", "ticker", "ticker_day", "ticker_week", "ticker_month", "ticker_year", "calendar_day", "day", "sector_day",
             "held_day", "actions", "ticker_before", "ticker_range", "dividends_range", "splits_range", "unheard_of")
    rows = []
    for n in range(4000):
        a, b = sorted(rng.integers(-60, 480, 2).tolist())
        d = day(rng.integers(-40, 440))
        b = a if n % 7 == 0 else min(b, a + int(rng.integers(0, 60))) if n % 2 else b
        rows.append((n, needs[n % len(needs)], "ABCDE"[n // 3 % 5], "xyzw"[n // 5 % 4], d, day(a), day(b), d.year))

    def holds(need, ticker, sect, d, start, end, year):
        inside = lambda events: any(t == ticker and start <= e <= end for t, e in events)
        mine = [e for t, e in bars if t == ticker]
        monday = lambda x: x - dt.timedelta(days=x.weekday())
        return {"always": True, "ticker": bool(mine), "ticker_day": d in mine, "ticker_week": monday(d) in map(monday, mine),
                "ticker_month": (d.year, d.month) in [(e.year, e.month) for e in mine], "ticker_year": year in [e.year for e in mine],
                "calendar_day": (d - D(1999, 11, 20)).days in range(0, 400, 3), "day": d in [e for _, e in bars],
                "sector_day": any(e == d and sector.get(t) == sect for t, e in bars), "held_day": ("B", d) in bars,
                "actions": ticker in {t for t, _ in paid | split}, "ticker_before": any(e <= d for e in mine),
                "ticker_range": inside(bars), "dividends_range": inside(paid), "splits_range": inside(split)}.get(need, False)

    frame = spark.createDataFrame(rows, "draw int, needs string, ticker string, sector string, day date, start date, end date, year int")
    got = [r.draw for r in corpus.answerable(frame, *tables).collect()]
    want = [r[0] for r in rows if holds(*r[1:])]
    assert sorted(got) == want and 1000 < len(want) < 3500
    assert corpus.answerable(frame, *[t.limit(0) for t in tables]).filter("needs <> 'always'").count() == 0


def test_draws_of_nothing(spark):
    from tidemark.operators import corpus

    tickers = spark.createDataFrame([("A", "x"), ("B", None)], "ticker string, sector string")
    days = spark.createDataFrame([(D(2000, 1, 3),), (None,)], "date date")
    drawn = corpus.draws(spark, tickers, days, 5, 1).collect()
    assert len(drawn) == 5 * len(corpus.TEMPLATES) and {r.sector for r in drawn} == {"x"} and {r.start for r in drawn} == {D(2000, 1, 3)}
    assert corpus.draws(spark, tickers, days.limit(0), 5, 1).count() == 0


def test_far_rings_stay_closed(spark, monkeypatch):
    """Exact with ties and many equal vectors, while most of the rings are never opened."""
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 50, (12, 6))
    vectors = np.concatenate([c + np.round(rng.normal(0, 1, (40, 6)), 1) for c in centres] + [np.zeros((150, 6))])
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "item_id long, vector array<double>")
    queries = items.filter("item_id % 9 = 0").select(F.col("item_id").alias("query_id"), "vector")
    opened = []
    first = documents.Rings.first
    monkeypatch.setattr(documents.Rings, "first", lambda self, bounds, k: opened.append(bounds.shape) or first(self, bounds, k))
    got = collections.defaultdict(list)
    for r in documents.nearest(queries, items, 5, block_rows=16).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.item_id)
    for q in range(0, len(vectors), 9):
        away = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        assert got[q] == np.lexsort((np.arange(len(vectors)), away))[:5].tolist()
    rings, ringed = documents._ringed(items, 16, len(vectors))
    assert ringed.count() == len(vectors) == rings.rows.sum() and len(rings.rows) > 20
    bounds = rings.bounds(vectors[::9])
    limit = np.sort(np.sqrt(((vectors[::9][:, None] - vectors) ** 2).sum(2)), axis=1)[:, 4]
    assert (bounds <= limit[:, None]).mean() < 0.3


@pytest.mark.parametrize("spread, shelf", [(0.0, 1 << 16), (0.0, 64), (40.0, 64), (40.0, 1 << 16)])
def test_a_query_meets_neighbouring_rings_once(spark, monkeypatch, spread, shelf):
    """Vectors without structure open most rings, and a query's vector went to each of these by itself."""
    monkeypatch.setattr(documents, "RING_ROWS", shelf)
    rng = np.random.default_rng(5)
    vectors = np.concatenate([c + rng.normal(0, 1, (50, 12)) for c in rng.normal(0, spread, (6, 12))] + [np.ones((90, 12))])
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "item_id long, vector array<double>")
    queries = items.filter("item_id % 3 = 0").select(F.col("item_id").alias("query_id"), "vector")
    sent, meet = [], documents._meet

    def counted(*args):
        sent.append(next(a for a in args if "query_id" in getattr(a, "columns", ())).count())
        return meet(*args)

    monkeypatch.setattr(documents, "_meet", counted)
    got = collections.defaultdict(list)
    for r in documents.nearest(queries, items, 5, block_rows=16).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.item_id, r.distance))
    for q in range(0, len(vectors), 3):
        away = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        first = np.lexsort((np.arange(len(vectors)), away))[:5]
        assert [i for i, _ in got[q]] == first.tolist() and [d for _, d in got[q]] == pytest.approx(away[first].tolist())
    shelves = 1 if shelf > len(vectors) else 2 * len(vectors) // shelf + 1
    assert sum(sent) <= shelves * 130


def test_first_of_each_text(spark):
    rows = [("a", 0, 5), ("a", 0, 3), ("b", 1, 1), ("a", 1, 0), (None, 0, 1), (None, None, 9), ("b", 1, 1), ("c", 0, None), ("c", 0, 2)]
    frame = spark.createDataFrame(rows, "text string, part int, row int")
    out = ranking.first_of_each_text(frame, "text", ["part", "row"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("a", 0, 3), ("b", 1, 1), ("c", 0, None), (None, None, 9)], key=str)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and not any("hashpartitioning(text" in line for line in text.splitlines())


def test_last_months_start_after_the_same_day(spark):
    from tidemark.operators import series

    days = [D(2020, 1, 30), D(2020, 1, 31), D(2020, 2, 29), D(2020, 3, 1), D(2020, 3, 30), D(2020, 3, 31), D(2021, 3, 31)]
    frame = spark.createDataFrame([("A", d, 1.0) for d in days], "ticker string, date date, close double")
    got = {r.date: r.n for r in series.windowed(frame, "sum", "close", 1, "months", "n").collect()}
    assert got == {days[0]: 1, days[1]: 2, days[2]: 3, days[3]: 2, days[4]: 2, days[5]: 3, days[6]: 1}
    assert "interval" not in str(series.windowed(frame, "sum", "close", 2, "months", "n")._jdf.queryExecution().executedPlan())


def test_only_keys_that_pairs_ask_for_are_aggregated(spark, market):
    tables = (market.prices_daily, market.dividends, market.splits, market.tickers, market.portfolio, market.trading_calendar)
    every = {r[:3]: r[3:] for r in corpus.typed_keys(*tables).collect()}
    asked = sorted(k for k in every if None not in k)[::97]
    wanted = spark.createDataFrame([*asked, ("ticker", "no such", "")], "need string, k1 string, k2 string")
    assert {r[:3]: r[3:] for r in corpus.typed_keys(*tables, wanted).collect()} == {k: every[k] for k in asked}


def test_requests_of_lines_are_dealt_over_tasks_of_bounded_size(market, monkeypatch):
    monkeypatch.setattr(staging, "PART_ROWS", 100)
    asked = registered._orders_as_requests(market)
    sizes = [len(x) for x in asked.rdd.glom().collect()]
    lines = market.table("lineitem")
    want = lines.join(market.table("orders"), lines.l_orderkey == F.col("o_orderkey")).select(
        "l_orderkey", F.concat(F.lit("S"), F.col("l_suppkey").cast("string")), F.to_date("o_orderdate")).distinct()
    assert sorted(asked.collect()) == sorted(want.collect()) and max(sizes) < 300


def test_texts_come_to_the_hits_that_stay(spark):
    hits = spark.createDataFrame([(1, 5, 0.0, 1), (1, 6, 1.0, 2), (1, 7, 2.0, 3)], "query_id long, item_id long, distance double, rank int")
    texts = spark.createDataFrame([(5, "a"), (6, "a"), (7, None), (7, None)], "item_id long, text string")
    kept = documents.distinct_hits(hits, texts, 2)
    assert sorted(map(tuple, kept.select("item_id", "text", "rank").collect())) == [(5, "a", 1), (7, None, 2)]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    carried = [line for line in plan.splitlines() if "min_by(" in line]
    assert carried and not any("text" in line for line in carried)


def test_results_stay_in_place_for_their_lines(spark, monkeypatch):
    """Every result was shuffled and sorted to learn whether its request has others, where Spark would not send that list."""
    results = spark.createDataFrame(
        [(1, "close", "A", D(2000, 1, 3), 1.5), (2, "close", "A", D(2000, 1, 3), 1.5), (2, "close", "B", D(2000, 1, 4), None),
         (3, "close", None, None, 2.0), (None, "close", "A", D(2000, 1, 3), 9.0)],
        "request_id long, metric string, ticker string, date date, value double")
    asked = spark.createDataFrame([(1,), (2,), (3,), (4,)], "request_id long")
    names = spark.createDataFrame([("A", "Ay"), ("B", "")], "ticker string, name string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = requests.answer_lines(asked, results, names)
        text = lines._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(staging, "HELD_ROWS", 0, raising=False)
        many = requests.answer_lines(asked, results, names)
        want = [(1, 0, "A", "The closing price for Ay is 1.5000."), (2, 0, None, "The closing price for your portfolio are:"),
                (2, 1, "A", "- Ay: 1.5000"), (2, 1, "B", "- B: None"), (3, 0, None, None),
                (4, 0, None, "There is no data available for this query.")]
        for found in (lines, many):
            assert sorted(((r.request_id, r.part, r.ticker, r.line) for r in found.collect()), key=str) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("BroadcastHashJoin") == 2 and text.count("SortMergeJoin") == 1  # one list of requests without results
