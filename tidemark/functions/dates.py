"""Date predicates, period labels, relative phrases."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_bounds(year: int) -> tuple[dt.date, dt.date]:
    return dt.date(year, 1, 1), dt.date(year, 12, 31)


def month_bounds(year: int, month: int) -> tuple[dt.date, dt.date]:
    first = dt.date(year, month, 1)
    after = dt.date(year + month // 12, month % 12 + 1, 1)
    return first, after - dt.timedelta(days=1)


def shift_months(day: dt.date, months: int) -> dt.date:
    """Calendar month shift; the day is clamped to the target month's length."""
    index = day.year * 12 + day.month - 1 + months
    _, last = month_bounds(index // 12, index % 12 + 1)
    return last.replace(day=min(day.day, last.day))


def range_bounds(kind: str, as_of: dt.date | None = None, value: int | str | None = None,
                 start: dt.date | None = None, end: dt.date | None = None,
                 month: int | None = None) -> tuple[dt.date | None, dt.date | None]:
    """The inclusive bounds of a declared time range; None means open."""
    if kind in ("all", None):
        return None, None
    if kind == "year":
        return year_bounds(int(value))
    if kind == "month":
        if month is None:
            year, month = (int(part) for part in str(value).split("-")[:2])
            return month_bounds(year, month)
        return month_bounds(int(value), month)
    if kind == "between_dates":
        return start, end
    if kind == "since_inception":
        return None, as_of
    if as_of is None:
        raise ValueError(f"range {kind!r} needs an as-of date")
    if kind == "last_n_days":
        return as_of - dt.timedelta(days=int(value)), as_of
    if kind == "trailing":
        return shift_months(as_of, -int(value)) + dt.timedelta(days=1), as_of
    if kind == "ytd":
        return as_of.replace(month=1, day=1), as_of
    if kind == "mtd":
        return as_of.replace(day=1), as_of
    raise ValueError(f"unknown time range {kind!r}")


def within(day: Column, low: dt.date | None, high: dt.date | None) -> Column:
    """low <= day <= high with either end open, as a predicate the scan can use."""
    test = F.lit(True)
    if low is not None:
        test = day >= F.lit(low)
    if high is not None:
        test = (test & (day <= F.lit(high))) if low is not None else day <= F.lit(high)
    return test


def monday_week(day: Column) -> Column:
    """Week number of the year, weeks starting on Monday, days before the first Monday in week 00."""
    return F.floor((F.dayofyear(day) - 1 + 7 - F.weekday(day)) / 7)


def period_label(day: Column, unit: str) -> Column:
    if unit == "month":
        return F.date_format(day, "yyyy-MM")
    return F.concat(F.date_format(day, "yyyy"), F.lit("-"), F.lpad(monday_week(day).cast("string"), 2, "0"))


def phrase_range(phrase: Column, today: Column) -> Column:
    """struct(start, end) of a relative time phrase; NULL when it is not one."""
    p = F.lower(F.trim(phrase))

    def span(start: Column, end: Column) -> Column:
        return F.struct(start.cast("date").alias("start"), end.cast("date").alias("end"))

    week = F.date_trunc("week", today).cast("date")
    month = F.trunc(today, "month")
    year = F.trunc(today, "year")
    quarter = F.trunc(today, "quarter")

    def count(unit: str) -> Column:
        return F.regexp_extract(p, rf"^last\s+(\d+)\s+{unit}s?", 1).try_cast("int")

    days, months, years = count("day"), count("month"), count("year")
    return (
        F.when(p == "today", span(today, today))
        .when(p == "yesterday", span(F.date_sub(today, 1), F.date_sub(today, 1)))
        .when(p == "this week", span(week, today))
        .when(p == "last week", span(F.date_sub(week, 7), F.date_sub(week, 1)))
        .when(p == "this month", span(month, today))
        .when(p == "last month", span(F.add_months(month, -1), F.date_sub(month, 1)))
        .when(p.isin("this year", "year to date", "ytd"), span(year, today))
        .when(p == "last year", span(F.add_months(year, -12), F.date_sub(year, 1)))
        .when(p == "last quarter", span(F.add_months(quarter, -3), F.date_sub(quarter, 1)))
        .when(days.isNotNull(), span(F.date_sub(today, days), today))
        .when(months.isNotNull(), span(F.add_months(today, -months), today))
        .when(years.isNotNull(), span(F.add_months(today, -years * 12), today))
    )
