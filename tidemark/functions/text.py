"""Text cleaning, tokens, hashes and label maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label scale of the sentiment corpus.
LABELS = {"negative": 0, "neutral": 1, "positive": 2}

# Marks that are tokens of their own.
TOKEN_MARKS = ",.;:()[]=<>+-*/%'"


def strip(text: Column) -> Column:
    """Trims every kind of whitespace, not only spaces."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def clean_document(text: Column) -> Column:
    """LF line ends, at most one blank line in a row, single spaces, no outer whitespace."""
    text = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    text = F.regexp_replace(text, r"[ \t]+", " ")
    return strip(text)


def clean_sentence(text: Column) -> Column:
    """Outer whitespace first, then zero-width spaces, then runs of whitespace to one space."""
    text = F.replace(strip(text), F.lit("​"), F.lit(""))
    return F.regexp_replace(text, r"\s+", " ")


def sentiment_label(value: Column) -> Column:
    """Names map to the scale, whole numbers pass, anything else is neutral."""
    name = F.lower(F.trim(value.cast("string")))
    labelled = F.when(name.rlike(r"^-?\d+$"), name.try_cast("int"))
    for word, code in LABELS.items():
        labelled = labelled.when(name == word, F.lit(code))
    return labelled.otherwise(F.lit(LABELS["neutral"]))


def content_id(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


def tokens(text: Column) -> Column:
    """Lower-cased words and marks, in order."""
    marks = "([" + "".join("\\" + m for m in TOKEN_MARKS) + "])"
    spaced = F.regexp_replace(F.lower(text), marks, " $1 ")
    return F.filter(F.split(spaced, r"\s+"), lambda t: t != "")


def identifier_tokens(name: Column) -> Column:
    """Words of a camelCase or snake_case identifier."""
    spaced = F.regexp_replace(name, r"([a-z0-9])([A-Z])", "$1 $2")
    return F.filter(F.split(F.lower(F.replace(spaced, F.lit("_"), F.lit(" "))), r"\s+"), lambda t: t != "")


def table_lines(rows: Column) -> Column:
    """array<array<string>> to lines of cells joined by a bar, missing cells empty."""
    return F.transform(rows, lambda r: F.array_join(
        F.transform(r, lambda cell: F.coalesce(cell, F.lit(""))), " | "))


def normalize_sql(sql: Column) -> Column:
    """A comparison key for SQL text: squeezed, lower-cased, first select list sorted.

    The result is for comparing only. Commas inside calls split too, and literals lose case.
    """
    flat = F.regexp_replace(F.regexp_replace(strip(sql), ";+$", ""), r"\s+", " ")
    flat = F.lower(F.replace(flat, F.lit("`"), F.lit('"')))
    pattern = r"^(.*?)(select\s+)([^;]+?)(\s+from\s+)(.*)$"
    columns = F.array_sort(F.transform(
        F.split(F.regexp_extract(flat, pattern, 3), ","), lambda c: F.trim(c)))
    rebuilt = F.concat(
        F.regexp_extract(flat, pattern, 1), F.regexp_extract(flat, pattern, 2),
        F.array_join(columns, ", "),
        F.regexp_extract(flat, pattern, 4), F.regexp_extract(flat, pattern, 5))
    return F.trim(F.when(flat.rlike(pattern), rebuilt).otherwise(flat))
