"""Renames, coercions and typed projections from raw tables to core tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema
from tidemark.functions.numbers import to_long

# Portfolio header aliases.
PORTFOLIO_ALIASES = {
    "symbol": "ticker", "asset": "ticker", "stock": "ticker",
    "quantity": "shares", "qty": "shares", "position": "shares", "position_size": "shares",
    "avgcost": "avg_cost", "average_cost": "avg_cost", "costbasis": "avg_cost",
    "averageprice": "avg_cost", "avg_price": "avg_cost",
}


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower().replace(" ", "_") for name in df.columns])


def clean_catalog(df: DataFrame) -> DataFrame:
    """Lower-case names, Symbol as ticker, trimmed strings, upper-case ticker and exchange."""
    df = df.withColumnsRenamed({
        "Exchange": "exchange", "Symbol": "ticker", "Shortname": "shortname", "Longname": "longname",
        "Sector": "sector", "Industry": "industry", "City": "city", "State": "state",
        "Country": "country"})
    out = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            col = F.trim(col)
            if field.name in ("ticker", "exchange"):
                col = F.upper(col)
        out.append(col.alias(field.name))
    return df.select(*out)


def _coerced(col: Column, kind: str) -> Column:
    if kind == "date":
        return F.try_to_date(F.substring(F.trim(col.cast("string")), 1, 10), "yyyy-MM-dd")
    if kind == "float":
        return col.cast("string").try_cast("double")
    if kind == "int":
        return col.cast("string").try_cast("double").try_cast("long")
    return col.cast("string")


def ensure_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Exactly the named columns; absent ones NULL, values that do not convert NULL."""
    have = set(df.columns)
    return df.select(*[
        (_coerced(F.col(name), kind) if name in have else _coerced(F.lit(None).cast("string"), kind)).alias(name)
        for name, kind in kinds.items()])


def drop_nested(df: DataFrame) -> DataFrame:
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.drop(*[f.name for f in df.schema if isinstance(f.dataType, nested)])


def ticker_list(catalog: DataFrame) -> DataFrame:
    """The catalog's tickers, from ``Symbol`` or else ``ticker``."""
    for name in ("Symbol", "ticker"):
        if name in catalog.columns:
            return catalog.select(F.upper(F.trim(F.col(name).cast("string"))).alias("ticker"))
    raise ValueError("catalog has neither a Symbol nor a ticker column")


def _typed(df: DataFrame, target: T.StructType, **exprs: Column) -> DataFrame:
    """Projects to a declared schema: given expressions, else same-named columns, else NULL."""
    have = set(df.columns)
    out = []
    for field in target:
        col = exprs.get(field.name)
        if col is None:
            col = F.col(field.name) if field.name in have else F.lit(None)
        out.append(col.cast(field.dataType).alias(field.name))
    return df.select(*out)


def core_prices(raw: DataFrame) -> DataFrame:
    return _typed(raw, schema.PRICES_DAILY, ticker=F.upper("ticker"), date=F.col("date").cast("date"),
                  volume=to_long(F.col("volume")), transactions=to_long(F.col("transactions")))


def _first_present(df: DataFrame, *names: str) -> Column:
    return F.coalesce(*[F.col(n).cast("date") for n in names if n in df.columns])


def core_dividends(raw: DataFrame) -> DataFrame:
    when = _first_present(raw, "event_date", "pay_date", "ex_dividend_date", "record_date", "declaration_date")
    return _typed(raw, schema.DIVIDENDS, ticker=F.upper("ticker"), event_date=when)


def core_splits(raw: DataFrame) -> DataFrame:
    when = _first_present(raw, "event_date", "execution_date")
    return _typed(raw, schema.SPLITS, ticker=F.upper("ticker"), event_date=when)


def dated_dividends(raw: DataFrame) -> DataFrame:
    """Event date is the first of pay, ex, record and declaration date; undated rows go."""
    event = F.coalesce("pay_date", "ex_dividend_date", "record_date", "declaration_date")
    return raw.withColumn("event_date", event).filter(F.col("event_date").isNotNull()).select(
        "ticker", "event_date", "declaration_date", "ex_dividend_date", "pay_date", "record_date", "cash_amount")


def dated_splits(raw: DataFrame) -> DataFrame:
    return (raw.withColumn("event_date", F.col("execution_date"))
            .filter(F.col("event_date").isNotNull())
            .select("ticker", "event_date", "execution_date", "split_from", "split_to"))


def core_tickers(catalog: DataFrame) -> DataFrame:
    name = "shortname" if "shortname" in catalog.columns else "name"
    return _typed(catalog, schema.TICKERS, ticker=F.upper("ticker"), name=F.col(name))


def core_ref_tickers(raw: DataFrame) -> DataFrame:
    """Optional columns become NULL; the company name may arrive as ``company_name`` or ``name``."""
    raw = raw.toDF(*[c.lower() for c in raw.columns])
    company = next((F.col(c) for c in ("company_name", "name") if c in raw.columns), F.lit(None))
    return _typed(raw, schema.REF_TICKERS, ticker=F.upper("ticker"), company_name=company)


def core_calendar(raw: DataFrame) -> DataFrame:
    return _typed(raw, schema.TRADING_CALENDAR, exchange=F.lower("exchange"))


def normalize_portfolio(df: DataFrame) -> DataFrame:
    df = normalize_headers(df)
    df = df.withColumnsRenamed({k: v for k, v in PORTFOLIO_ALIASES.items() if k in df.columns})
    return require_columns(df, ["ticker", "shares", "avg_cost"])


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*names)


def new_york_hours(calendar: DataFrame) -> DataFrame:
    """Adds New York wall-clock columns to UTC session hours."""
    def local(name: str) -> Column:
        return F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), F.col(name).cast("timestamp_ntz"))

    return (calendar.withColumn("market_open_ny", local("market_open_utc"))
            .withColumn("market_close_ny", local("market_close_utc")))


def name_lookup(catalog: DataFrame) -> DataFrame:
    """ticker, name (the ticker where missing), sector (``Unknown`` where missing), lower-cased name."""
    name = F.coalesce("name", "ticker")
    return catalog.select("ticker", name.alias("name"), F.lower(name).alias("name_key"),
                          F.coalesce("sector", F.lit("Unknown")).alias("sector"))


def sector_members(catalog: DataFrame) -> DataFrame:
    """sector -> tickers in long form, so that a huge sector stays many rows."""
    return name_lookup(catalog).select("sector", "ticker").distinct()
