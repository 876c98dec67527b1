"""Computing an expensive column, or a table that several branches read, once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import new_path


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that later expressions read instead of repeating.

    Spark merges neighbouring projections, which pastes a regex or a JSON parse into every place that uses
    it. A generator of exactly one row is a step it does not merge across.
    """
    fields = [col.alias(name) for name, col in columns.items()]
    return df.select(*[c for c in df.columns if c not in columns], F.inline(F.array(F.struct(*fields))))


def landed(df: DataFrame, label: str) -> DataFrame:
    """The table, written to the shared folder and read back: its branches read columns of files, not its plan."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a narrow table that every executor may hold whole.
HELD_ROWS = 1 << 19


def held(df: DataFrame, label: str) -> DataFrame:
    """The table, landed, and held whole by the tasks that join it where its rows are counted to be few; a join with a table of
    very many rows then leaves these in place, whatever size Spark would send by itself."""
    table = landed(df, label)
    return F.broadcast(table) if table.count() <= HELD_ROWS else table


#: Rows that one task takes of what ``dealt`` deals, about.
PART_ROWS = 500_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """The rows dealt by their keys over the session's shuffle partitions, or over as many as leave some ``PART_ROWS`` of ``rows``
    in each, so that what a task holds does not grow with the table."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(parts, -(-rows // PART_ROWS)), *keys)
