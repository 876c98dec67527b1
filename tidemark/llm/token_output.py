"""Token-id output: concatenated id arrays whose document boundaries are Elias-Fano coded.

Documents are range-partitioned by id, so partition (shard) p holds smaller ids than p + 1, and each shard is cut into
segments of whole documents. A segment is one row of a Parquet table in a folder that all machines see:

    shard int, segment int, begin long, tokens long, docs int, width int, base long, ids binary, ends binary, keys binary

``begin`` is the number of the shard's tokens before the segment, ``ids`` the concatenation of the documents' ids, little-endian, ``width`` bytes each (2 where the vocabulary
allows). ``ends`` is the Elias-Fano code of the documents' ends, counted in tokens from the segment's begin; ``keys``
that of doc_id - ``base``. Code: 8-byte header (count, low bits), low bits packed, high parts in unary, and the place of
every 64th one bit, from which ``select`` starts; some 2 + log2(tokens / docs) bits a document instead of 64.
Shards' begins are a running sum over one row for each shard.

Defined results: null text is empty and has the end id only; repeated doc_ids stand beside each other in the order of
their texts; documents without an id come first and are the ``docs`` that ``keys`` lacks; an empty table gives an empty folder table; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import byte_texts, partitions, slices
from tidemark.llm.tokens import encoder, public_path

#: Tokens after which a segment is closed; a longer document has a segment of its own.
SEGMENT_TOKENS = 1 << 20
SELECT_EVERY = 64
SEGMENTS = ("shard int, segment int, begin long, tokens long, docs int, width int, base long, ids binary, ends binary, "
            "keys binary")


def ef_encode(values: np.ndarray) -> bytes:
    """Elias-Fano code of non-decreasing, non-negative numbers."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    top = int(values[-1]) + 1 if n else 1
    low = max(0, (top // max(n, 1)).bit_length() - 1)
    bits = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    high[ones] = 1
    return (struct.pack("<II", n, low) + np.packbits(bits.ravel(), bitorder="little").tobytes()
            + ones[::SELECT_EVERY].astype("<u4").tobytes() + np.packbits(high, bitorder="little").tobytes())


class EliasFano:
    """Reads a code in place: ``select(i)`` is the i-th value, ``all()`` every one."""

    def __init__(self, code: bytes):
        self.n, self.low = struct.unpack_from("<II", code)
        at = 8 + -(-self.n * self.low // 8)
        self.lows = np.frombuffer(code, np.uint8, at - 8, 8)
        hints = -(-self.n // SELECT_EVERY)
        self.hints = np.frombuffer(code, "<u4", hints, at)
        self.high = np.frombuffer(code, np.uint8, -1, at + 4 * hints)

    def _low(self, i: int) -> int:
        first, last = i * self.low, (i + 1) * self.low
        word = int.from_bytes(self.lows[first // 8: -(-last // 8)].tobytes(), "little")
        return word >> (first % 8) & ((1 << self.low) - 1)

    def select(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.hints[i // SELECT_EVERY]), i % SELECT_EVERY
        byte = place // 8
        bits = int(self.high[byte]) >> place % 8 << place % 8
        while left >= bits.bit_count():
            left -= bits.bit_count()
            byte += 1
            bits = int(self.high[byte])
        for _ in range(left):
            bits &= bits - 1
        one = byte * 8 + (bits & -bits).bit_length() - 1
        return one - i << self.low | self._low(i)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n].astype(np.uint64)
        high = ones - np.arange(self.n, dtype=np.uint64)
        bits = np.unpackbits(self.lows, bitorder="little")[: self.n * self.low].reshape(self.n, self.low)
        low = bits.astype(np.uint64) @ (np.uint64(1) << np.arange(self.low, dtype=np.uint64)) if self.low else 0
        return high << np.uint64(self.low) | low


def write(docs: DataFrame, path: str, end_id: int = 2, vocabulary: Callable[[], str] = public_path,
          id_column: str = "doc_id", text_column: str = "text", segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encodes and writes all documents in ascending order of their ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = encoder(vocabulary())
        end = np.asarray([end_id], coder.type).tobytes()
        shard, segment, begin = TaskContext.get().partitionId(), 0, 0
        ids: list[bytes] = []
        keys: list[int] = []
        size = 0

        def row() -> pa.RecordBatch:
            ends = np.cumsum([len(x) // coder.width for x in ids])
            named = [k for k in keys if k is not None]  # null ids sort first
            base = named[0] if named else 0
            values = [shard, segment, begin, int(ends[-1]), len(keys), coder.width, base, b"".join(ids), ef_encode(ends),
                      ef_encode(np.asarray([k - base for k in named]))]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)],
                                              names=[f.split()[0] for f in SEGMENTS.split(", ")])

        for batch in slices(batches, 500):
            for key, coded in zip(batch.column("doc_id").to_pylist(), coder.encode(byte_texts(batch, "text"))):
                if keys and size + len(coded) > segment_tokens * coder.width:
                    yield row()
                    segment, begin, size, ids, keys = segment + 1, begin + size // coder.width, 0, [], []
                ids.append(coded + end)
                keys.append(key)
                size += len(coded) + len(end)
        if keys:
            yield row()

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    ordered = chosen.repartitionByRange(partitions(docs), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, SEGMENTS).write.parquet(f"{path}/segments")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit)."""
    return _documents(spark, path, "doc_id long, start long, n_tokens long, ids binary")


def digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32 of its ids as unsigned 32-bit integers."""
    return _documents(spark, path, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    segments = spark.read.schema(SEGMENTS).parquet(f"{path}/segments")
    shards = segments.groupBy("shard").agg(F.sum("tokens").alias("n"))  # one row a shard: no more than partitions
    begins = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    crc = "ids_crc32" in schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            for row in batch.to_pylist():
                ends = EliasFano(row["ends"]).all().astype(np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                named = EliasFano(row["keys"]).all().astype(np.int64) + row["base"]
                unnamed = len(ends) - len(named)
                keys = pa.array(np.concatenate((np.zeros(unnamed, np.int64), named)), mask=np.arange(len(ends)) < unnamed)
                ids = np.frombuffer(row["ids"], "<u2" if row["width"] == 2 else "<u4").astype("<u4")
                parts = [ids[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
                last = (pa.array([zlib.crc32(p) for p in parts], pa.int64()) if crc
                        else pa.array([p.tobytes() for p in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(starts + row["begin"]), pa.array(ends - starts), last],
                    names=[f.split()[0] for f in schema.split(", ")])

    placed = segments.join(F.broadcast(begins), "shard").withColumn("begin", F.col("begin") + F.col("before"))
    return placed.select("width", "base", "ids", "ends", "keys", "begin").mapInArrow(run, schema)
