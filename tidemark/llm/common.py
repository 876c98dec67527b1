"""Helpers shared by the corpus operators: columns, words, Arrow batches, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys of rows without an id start here.
UNNAMED = 1 << 62
T = TypeVar("T")
#: What this worker holds from batch to batch, by name.
_HELD: dict[str, object] = {}
#: Lower-cases A-Z and turns every ASCII byte that is no letter or digit into a space; bytes of other characters stay.
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def alnum_words(text: bytes) -> list[bytes]:
    """Lower-cased words of letters, digits and non-ASCII characters."""
    return text.translate(ALNUM).split()


def byte_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    values = batch.column(column)
    if not pa.types.is_binary(values.type):
        values = values.cast(pa.binary())
    return [v or b"" for v in values.to_pylist()]


def key_of(row_id: Column, *text: Column) -> Column:
    """A row's id; a null one is replaced by a number from 2**62 up that its text gives, so that it sorts behind ids and
    joins by equality."""
    return F.coalesce(row_id.cast("long"), F.shiftrightunsigned(F.xxhash64(*text), 2) + UNNAMED)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared folder and read back: its lineage ends there and its work is done once."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``stored`` wrote, once all that reads them is written itself."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def held(name: str, make: Callable[[], T]) -> T:
    """What a worker keeps from batch to batch, such as a vocabulary and the words it has met. A worker serves one operator
    after another and holds for one at a time: under another name, what was held before goes."""
    if name not in _HELD:
        _HELD.clear()
        pa.default_memory_pool().release_unused()
        _HELD[name] = make()
    return _HELD[name]


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, to bound what a task holds beside them."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def partitions(df: DataFrame, least: int = 1) -> int:
    """Partitions for a keyed exchange: the session's setting, so that a cluster's own value decides."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def batch_of(columns: Sequence, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type)
                                       for c, f in zip(columns, schema, strict=True)], schema=schema)
