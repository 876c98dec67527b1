"""Hard-negative mining by a secondary sort.

Every anchor is scored against every row by the integer inner product of their vectors. Anchors are read in blocks of
bounded size, sent to the tasks that scan the rows; a task keeps, for each anchor, only what can still be among the first:
its best rows of the same label, then for each positive the best rows inside the positive's window. What is left travels
under keys that pack (anchor, descending score, id) in 24 bytes. ``repartition`` by anchor and ``sortWithinPartitions`` by
the key (the DataFrame form of ``repartitionAndSortWithinPartitions``) bring each anchor's rows in order; a streaming
iterator opens a window at every positive it meets and emits the negatives that follow, holding a handful of windows and
never an anchor's rows.

Defined results: rows without an id, label or vector, or with a null, NaN or infinite component, take no part; an empty
vector scores 0 with all, and of vectors of unlike length the shorter one counts as filled up with zeros; of rows that share
an id the one of the smallest label, then vector, takes part; ties go to the smaller id; a positive without rows in its
window, and an anchor without positives, gives no rows; an empty table gives none; other columns are ignored. Scores are
exact up to 64 bits; vectors that could exceed them raise an error, as no long could hold the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, stored

POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: Bytes of anchors' vectors, and anchors, in a block: what is sent to tasks at once.
BLOCK_BYTES, BLOCK_ROWS = 16_000_000, 32_768
#: Scores that a task computes at once.
SCORES = 1 << 20
#: Tasks for each core that scan the rows: the more rows a task sees, the less it passes on.
SCANS = 4
FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
KEYED = "anchor_id long, key binary, positive boolean"
_FLIP = np.uint64(1 << 63)


def packed(anchor: np.ndarray, score: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Keys of 24 bytes whose byte order is by anchor, then score from the highest, then id."""
    parts = [anchor.astype(np.int64).view(np.uint64) ^ _FLIP, ~(score.astype(np.int64).view(np.uint64) ^ _FLIP),
             row.astype(np.int64).view(np.uint64) ^ _FLIP]
    return np.stack(parts, axis=1).astype(">u8")


def unpacked(keys: pa.Array) -> tuple[list[int], list[int], list[int]]:
    both = np.frombuffer(b"".join(keys.to_pylist()), ">u8").reshape(-1, 3).astype(np.uint64)
    return tuple(x.view(np.int64).tolist() for x in (both[:, 0] ^ _FLIP, ~both[:, 1] ^ _FLIP, both[:, 2] ^ _FLIP))


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """The least and the highest score that lie within ``low`` to ``high`` hundredths of a positive's."""
    return -(-low * score // 100), high * score // 100


def vectors(column: pa.Array, width: int | None = None) -> np.ndarray:
    """A list column as a matrix of floor(256 x), shorter rows filled up with zeros and longer ones cut at ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    flat = np.floor(256.0 * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    width = int(lengths.max(initial=0)) if width is None else width
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row[at < width], at[at < width]] = flat[at < width]
    return out


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued rows, as longs."""
    most = x.shape[1] * float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0))
    if most < 2.0 ** 53:
        return (x @ y.T).astype(np.int64)
    if most < 2.0 ** 62:
        return x.astype(np.int64) @ y.astype(np.int64).T
    raise ValueError("a score of these vectors may exceed 64 bits")


class _First:
    """The first ``most`` entries of each group in order of falling score, then id."""

    def __init__(self, groups: int, most: int, floor: np.ndarray | None = None):
        self.most = most
        self.group = self.score = self.row = np.zeros(0, np.int64)
        #: The least score that can still be among a group's first.
        self.floor = np.full(groups, np.iinfo(np.int64).min) if floor is None else floor.copy()

    def add(self, group: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        group, score, row = (np.concatenate(x) for x in ((self.group, group), (self.score, score), (self.row, row)))
        order = np.lexsort((row, -score, group))
        group, score, row = group[order], score[order], row[order]
        at = np.arange(len(group))
        start = np.maximum.accumulate(np.where(np.concatenate(([True], group[1:] != group[:-1]))[:len(group)], at, 0))
        keep = at - start < self.most
        full = at - start == self.most - 1
        self.floor[group[full]] = score[full]
        self.group, self.score, self.row = group[keep], score[keep], row[keep]


def _blocks(batches: Iterator[pa.RecordBatch], width: int, anchors: int) -> Iterator[tuple]:
    """Ids, labels and vectors of rows, few at first so that floors rise early."""
    rows = 64
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows)
            yield (part.column("id").to_numpy(), part.column("label").to_numpy(), vectors(part.column("vector"), width))
            at += rows
            rows = min(2 * rows, max(64, SCORES // max(1, anchors)))


def _keyed(anchors: np.ndarray, first: _First, per: int) -> Iterator[pa.RecordBatch]:
    """A task's entries; one that is in several windows of an anchor goes once."""
    entries = np.unique(np.stack([first.group // per, first.score, first.row], axis=1), axis=0)
    if len(entries):
        keys = packed(anchors[entries[:, 0]], entries[:, 1], entries[:, 2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchors[entries[:, 0]]), pa.array([k.tobytes() for k in keys], pa.binary()),
             pa.array(np.zeros(len(keys), bool))], names=["anchor_id", "key", "positive"])


def _same_label(sent, most: int):
    """Each task's best rows of each anchor's label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, matrix = sent.value
        of_label = {label: np.flatnonzero(labels == label) for label in np.unique(labels).tolist()}
        first = _First(len(ids), most)
        for row, label, x in _blocks(batches, matrix.shape[1], len(ids)):
            for value in np.unique(label).tolist():
                anchors = of_label.get(value)
                if anchors is None:
                    continue
                mine = label == value
                score = products(x[mine], matrix[anchors])
                good = (score >= first.floor[anchors]) & (row[mine][:, None] != ids[anchors])
                at, anchor = np.nonzero(good)
                first.add(anchors[anchor], score[at, anchor], row[mine][at])
        yield from _keyed(ids, first, 1)

    return run


def _in_windows(sent, most: int):
    """Each task's best rows of other labels in each window of each anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, matrix, lows, highs = sent.value
        per = lows.shape[1]
        first = _First(len(ids) * per, most, lows.reshape(-1))
        for row, label, x in _blocks(batches, matrix.shape[1], len(ids)):
            score = products(x, matrix)
            other = label[:, None] != labels
            found = []
            for w in range(per):
                at, anchor = np.nonzero(other & (score >= first.floor[w::per]) & (score <= highs[:, w]))
                found.append((anchor * per + w, score[at, anchor], row[at]))
            first.add(*(np.concatenate(c) for c in zip(*found)))
        yield from _keyed(ids, first, per)

    return run


def _in_order(keyed: DataFrame) -> DataFrame:
    """The secondary sort: an anchor's rows in one partition, in the order of their keys."""
    return keyed.repartition(partitions(keyed), "anchor_id").sortWithinPartitions("key").select("key", "positive")


def _opening(most: int):
    """The first rows of each anchor, as positives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for batch in batches:
            keep = []
            anchors = unpacked(batch.column("key"))[0]
            for anchor in anchors:
                last, n = (last, n + 1) if anchor == last else (anchor, 1)
                keep.append(n <= most)
            part = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, k in zip(anchors, keep) if k], pa.int64()), part.column("key"),
                 pa.array([True] * part.num_rows, pa.bool_())], names=["anchor_id", "key", "positive"])

    return run


def _emitting(most: int, low: int, high: int):
    """The streaming iterator: a positive opens its window, later rows of other labels fall into the open ones. A window of
    a positive that scores 0 reaches only rows of score 0, which may stand before it: the first of those are remembered."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        last, opened, zeros = None, [], []
        for batch in batches:
            for anchor, score, row, positive in zip(*unpacked(batch.column("key")), batch.column("positive").to_pylist()):
                if anchor != last:
                    last, opened, zeros = anchor, [], []
                if positive:
                    opened.append([row, score, *window(score, low, high), 0])
                    for other in zeros if score == 0 else ():
                        opened[-1][4] += 1
                        yield anchor, row, opened[-1][4], other, score, 0
                    continue
                if score == 0 and len(zeros) < most:
                    zeros.append(row)
                for one in opened:
                    if one[2] <= score <= one[3] and one[4] < most:
                        one[4] += 1
                        yield anchor, one[0], one[4], row, one[1], score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for one in rows(batches):
            held.append(one)
            if len(held) == 10_000:
                yield _found(held)
                held = []
        yield _found(held)

    return run


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 6
    names = [f.split() for f in FOUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if t == "int" else pa.int64())
                                       for c, (_, t) in zip(columns, names)], names=[n for n, _ in names])


def taking_part(rows: DataFrame, id_column: str = "vec_id", label: Column | str = "label",
                vector_column: str = "embedding") -> DataFrame:
    """id, label and vector of the rows that take part, each id once."""
    label = F.col(label) if isinstance(label, str) else label
    shown = rows.select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"),
                        F.col(vector_column).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    shown = shown.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    again = stored(shown.groupBy("id").count().where("count > 1").select("id"), "repeated-ids")
    if again.isEmpty():
        return shown
    once = (shown.join(again, "id").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("one"))
            .select("id", "one.label", "one.vector"))
    return shown.join(again, "id", "left_anti").union(once)


def mined(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
          high: int = HIGH, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` as ``taking_part`` gives them; ``anchors`` is a condition on them. For each anchor and each of its first
    ``positives`` rows of the same label, the first ``negatives`` rows of other labels whose score lies within ``low`` to
    ``high`` hundredths of the positive's: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Blocks of anchors, at most ``block_rows`` and ``BLOCK_BYTES``, are done one after the other; the rows are never shuffled,
    and each block's result is written before the next begins."""
    if not 0 <= low <= high < 100:
        raise ValueError("windows lie between 0 and 100 hundredths, below the positive")
    spark = rows.sparkSession
    queries = rows.where(anchors)
    n, width = queries.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not n:
        return spark.createDataFrame([], FOUND)
    blocks = -(-n // max(1, min(block_rows, BLOCK_BYTES // (8 * max(1, width)))))
    scanned = rows.coalesce(SCANS * spark.sparkContext.defaultParallelism)
    results = []
    for block in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow()
        if not mine.num_rows:
            continue
        ids, labels = (mine.column(c).to_numpy().astype(np.int64) for c in ("id", "label"))
        matrix = vectors(mine.column("vector"))
        sent = spark.sparkContext.broadcast((ids, labels, matrix))
        close = _in_order(scanned.mapInArrow(_same_label(sent, positives), KEYED))
        opening = stored(close.mapInArrow(_opening(positives), KEYED), "positives")
        lows, highs = _windows(opening.select("key").toArrow(), ids, positives, low, high)  # a few rows an anchor of the block
        more = spark.sparkContext.broadcast((ids, labels, matrix, lows, highs))
        inside = scanned.mapInArrow(_in_windows(more, negatives), KEYED)
        found = _in_order(inside.union(opening)).mapInArrow(_emitting(negatives, low, high), FOUND)
        results.append(stored(found, "hard-negatives"))
        sent.destroy()
        more.destroy()
    out = results[0]
    for other in results[1:]:
        out = out.union(other)
    return out


def _windows(opening: pa.Table, ids: np.ndarray, positives: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and highest scores of each anchor's windows; where it has fewer positives, windows that hold nothing."""
    lows = np.full((len(ids), positives), np.iinfo(np.int64).max)
    highs = np.full((len(ids), positives), np.iinfo(np.int64).min)
    place = {a: i for i, a in enumerate(ids.tolist())}
    filled = [0] * len(ids)
    for anchor, score, _ in zip(*unpacked(opening.column("key").combine_chunks())) if opening.num_rows else ():
        at = place[anchor]
        lows[at, filled[at]], highs[at, filled[at]] = window(score, low, high)
        filled[at] += 1
    return lows, highs
