"""Writers, incremental loads and catalog helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def by_ticker(df: DataFrame, path: str) -> None:
    """One folder per ticker; only folders of tickers in ``df`` are replaced.

    A ticker's rows, one a day, meet before the write and are one file. The files cost more than their bytes, so the tickers
    are dealt over all shuffle partitions, which small tables would otherwise be joined to one of.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(parts, "ticker").write.partitionBy("ticker").mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """CSV with a header and a fixed column order; quotes and line breaks in text survive."""
    df.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def json_shards(df: DataFrame, path: str, shard_rows: int = 10_000) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", shard_rows).json(path)


def json_splits(df: DataFrame, path: str, column: str = "split") -> None:
    """One folder of JSON lines per split, in one pass."""
    df.write.mode("overwrite").partitionBy(column).json(path)


def table_from_file(spark: SparkSession, df: DataFrame, name: str, path: str) -> DataFrame:
    """Writes a copy and registers it under a name: create table as select."""
    parquet(df, path)
    landed = spark.read.parquet(path)
    landed.createOrReplaceTempView(name)
    return spark.table(name)


def register(tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in tables]


def not_landed(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Tickers of ``expected`` without a row in ``landed``."""
    return expected.select("ticker").distinct().join(landed.select("ticker"), "ticker", "left_anti")


def load_summary(expected: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """How many tickers were created, skipped (there before) or failed, and the total."""
    def keys(df: DataFrame, flag: str) -> DataFrame:
        return df.select("ticker").distinct().withColumn(flag, F.lit(True))

    status = (F.when(F.col("was"), "skipped").when(F.col("is_"), "created").otherwise("failed"))
    rows = (expected.select("ticker").distinct().join(keys(before, "was"), "ticker", "left")
            .join(keys(after, "is_"), "ticker", "left").select(status.alias("status")))
    return rows.withColumn("status", F.explode(F.array("status", F.lit("total")))).groupBy("status").agg(
        F.count(F.lit(1)).alias("n"))


def columns_of(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Table, column, type and position of every column; schemas only, no data is read."""
    rows = [(name, f.name, f.dataType.simpleString(), i)
            for name, df in tables.items() for i, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, position int")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
