"""SimHash near-duplicates over a hierarchical index in Gray order.

*Fingerprints.* One pass over whole texts: a bit is 1 if it is set in over half of the XXH64 values of the features.

*Candidates.* The 64 bits are cut into ``bits + shared`` blocks; two fingerprints within ``bits`` differences agree on
``shared`` blocks at least, so each distinct fingerprint is dealt once to every choice of ``shared`` blocks and meets all
its partners in some bucket. A bucket that holds more than ``CELL`` fingerprints is split into chunks by hash, and each
pair of chunks is a cell of its own; no bucket is capped or dropped.

*Index.* Within a cell fingerprints are sorted by Gray rank. Runs of ``FAN`` make a node that keeps the bits all of them
share; runs of nodes make the level above, up to a root. A search goes down with pairs of nodes: the differences in bits
that both nodes share are accumulated from level to level, each level adding only the bits it newly fixes, and a pair
beyond the limit is dropped with everything below it. Pairs whose members already hang together are dropped too, so a
dense group costs a spanning forest and not all its pairs.

*Classes.* The forests' links go through ``components``. Only links between different fingerprints are ever made; equal
ones are one node, formed by an aggregate that combines before the shuffle.

Defined results: null, empty or blank texts have fingerprint zero and are linked like any other; fewer words than a
shingle are one shingle; rows without an id are linked like any other, and a group of such rows alone has a null
component; ``deduplicated`` keeps one row of each group, that of the smallest id (of texts that share it, one; rows with an
id before rows without), also of rows that repeat each other; an id with several texts stands for several documents there,
for one in ``classes``; an empty table gives no rows; extra columns pass through ``deduplicated`` and are ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import UNNAMED, byte_texts, key_of, partitions, slices, stored
from tidemark.llm.components import components

SEED, WIDTH, BITS, SHARED = 42, 4, 4, 2
FAN = 8
#: Fingerprints of a cell at most, about.
CELL = 4096
#: Pairs of nodes that are opened at once: bounds a search's memory.
OPEN = 1 << 14
#: Rows of whole cells that a worker indexes together.
TOGETHER = 1 << 17


def _shingles(words: list[bytes], width: int) -> list:
    joined = b" ".join(words)
    view = memoryview(joined)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = max(1, len(words) - width + 1)
    return [view[a:b] for a, b in zip(starts[:last].tolist(), ends[min(width, len(words)) - 1:].tolist())]


def hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included; of all words together if there are fewer; none without words."""
    from xxhash import xxh64_intdigest

    if not words:
        return np.zeros(0, np.uint64)
    parts = _shingles(words, width)
    return np.fromiter((xxh64_intdigest(p, SEED) for p in parts), np.uint64, len(parts))


#: A byte's bits, the lowest first, as eight bytes in a row.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]


def majority(values: np.ndarray) -> int:
    """The fingerprint of 64-bit values, as a signed number."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(values), 1 << 14):
        part = values[at:at + (1 << 14)]
        lanes = SPREAD[np.ascontiguousarray(part).view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(lanes, np.arange(0, len(part), 255), axis=0)  # 255 ones fill a lane's byte
        counts += sums.view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(values), bitorder="little").view("<i8")[0])


def _text_hash(text_column: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text_column), F.lit(""))))


def fingerprints(docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, fp (signed long) and text_hash per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            fps = [majority(hashes(text.lower().split(), width)) for text in byte_texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fps, pa.int64()), batch.column("text_hash")],
                names=["doc_id", "fp", "text_hash"])

    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"),
                       _text_hash(text_column).alias("text_hash")
                       ).mapInArrow(run, "doc_id long, fp long, text_hash binary")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of 64-bit codes in Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Levels of nodes over cells of fingerprints; ``forest`` finds links within cells."""

    def __init__(self, cells: np.ndarray, codes: np.ndarray):
        """``cells`` numbers each code's cell."""
        self.order = np.lexsort((gray_rank(codes), cells))
        cell, ones = cells[self.order], codes[self.order]
        some = ones
        self.ones, self.mask, self.first, self.begin = [ones], [np.full(len(ones), ~np.uint64(0))], [], [np.arange(len(ones))]
        while len(cell) > 1 and (cell[1:] == cell[:-1]).any():
            new_cell = np.concatenate(([True], cell[1:] != cell[:-1]))
            at = np.arange(len(cell))
            in_cell = at - np.maximum.accumulate(np.where(new_cell, at, 0))
            starts = np.flatnonzero(in_cell % FAN == 0)
            ones, some = np.bitwise_and.reduceat(ones, starts), np.bitwise_or.reduceat(some, starts)
            self.ones.append(ones)
            self.mask.append(~(ones ^ some))
            self.first.append(np.append(starts, len(cell)))
            self.begin.append(self.begin[-1][starts])
            cell = cell[starts]
        self.label = np.arange(len(self.order))

    def _join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Unites the ends of pairs; gives the positions of the pairs that did it, a forest."""
        used = []
        left = np.arange(len(a))
        while len(left):
            x, y = self.label[a[left]], self.label[b[left]]
            left = left[x != y]
            if not len(left):
                break
            x, y = self.label[a[left]], self.label[b[left]]
            high, low = np.maximum(x, y), np.minimum(x, y)
            _, once = np.unique(high, return_index=True)  # each class but the least joins one smaller class
            used.append(left[once])
            self.label[high[once]] = low[once]
            while True:
                jumped = self.label[self.label]
                if (jumped == self.label).all():
                    break
                self.label = jumped
        return np.concatenate(used) if used else np.zeros(0, np.int64)

    def _apart(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of nodes hold members of different classes."""
        low = np.minimum.reduceat(self.label, self.begin[level])
        high = np.maximum.reduceat(self.label, self.begin[level])
        return np.minimum(low[a], low[b]) != np.maximum(high[a], high[b])

    def _near(self, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of pairs of members within ``bits`` differences, and the differences; pairs of nodes whose members are of
        one class when they are opened are left out."""
        top = len(self.ones) - 1
        roots = np.arange(len(self.ones[top]))
        shared = self.mask[top]
        stack = [(top, roots[at:at + OPEN], roots[at:at + OPEN], np.zeros(len(roots[at:at + OPEN]), np.uint8),
                  shared[at:at + OPEN]) for at in range(0, len(roots), OPEN)]
        while stack:
            level, a, b, sofar, fixed = stack.pop()
            if level == 0:
                ends = a != b
                yield a[ends], b[ends], sofar[ends]
                continue
            keep = self._apart(level, a, b)
            a, b, sofar, fixed = a[keep], b[keep], sofar[keep], fixed[keep]
            if len(a) > OPEN:  # what lies under this block is done before the rest is opened
                stack.append((level, a[OPEN:], b[OPEN:], sofar[OPEN:], fixed[OPEN:]))
            stack.append((level - 1, *self._opened(level, a[:OPEN], b[:OPEN], sofar[:OPEN], fixed[:OPEN], bits)))

    def forest(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links within ``bits`` differences (positions in the given order, differences) that tie classes together."""
        found: list[tuple] = []
        for a, b, differ in self._near(bits):
            by = np.argsort(differ, kind="stable")
            tie = by[self._join(a[by], b[by])]
            found.append((a[tie], b[tie], differ[tie]))
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        a, b, d = (np.concatenate(x) for x in zip(*found))
        return self.order[a], self.order[b], d

    def _opened(self, level: int, a: np.ndarray, b: np.ndarray, sofar: np.ndarray, fixed: np.ndarray, bits: int):
        """The child pairs of node pairs that stay within the limit, with their accumulated differences."""
        first, ones, mask = self.first[level - 1], self.ones[level - 1], self.mask[level - 1]
        n_a, n_b = first[a + 1] - first[a], first[b + 1] - first[b]
        times = n_a * n_b
        pair = np.repeat(np.arange(len(a)), times)
        within = np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times)
        wide = n_b[pair]
        x, y = first[a[pair]] + within // wide, first[b[pair]] + within % wide
        keep = (a[pair] != b[pair]) | (x <= y)
        x, y, pair = x[keep], y[keep], pair[keep]
        known = mask[x] & mask[y]
        fresh = known & ~fixed[pair]
        differ = sofar[pair] + np.bitwise_count((ones[x] ^ ones[y]) & fresh)
        keep = differ <= bits
        return x[keep], y[keep], differ[keep], known[keep]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(nodes: DataFrame, bits: int = BITS, shared: int = SHARED, passes: tuple[int, ...] | None = None,
          cell: int = CELL) -> DataFrame:
    """``nodes`` has fp and node (long), each fp once. Gives a, b: links that hold together, bucket by bucket, all that lie
    within ``bits`` of each other. ``passes`` are limits searched one after the other, so that links of few differences
    come first (default: all at once)."""
    limits = passes or (bits,)
    n_blocks = bits + shared
    edges = [64 * i // n_blocks for i in range(n_blocks + 1)]
    block = [sum(1 << i for i in range(a, b)) for a, b in zip(edges, edges[1:])]
    masks = [sum(block[i] for i in chosen) for chosen in combinations(range(n_blocks), shared)]
    keys = F.array(*[F.xxhash64(F.lit(0), F.lit(n), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for n, m in enumerate(masks)])
    return _held_together(nodes.select("fp", "node", F.explode(keys).alias("bucket")), limits, cell)


def _held_together(routed: DataFrame, limits: tuple[int, ...], cell: int) -> DataFrame:
    """Links (a, b) within each bucket of rows fp, node, bucket."""
    # equal hashes of different buckets would only put more fingerprints into one cell
    heavy = routed.groupBy("bucket").count().where(F.col("count") > cell).select(
        "bucket", F.ceil(F.col("count") / cell).cast("int").alias("chunks"))
    chunk = F.pmod(F.hash("fp", "node"), F.col("chunks"))
    spread = F.when(F.col("chunks").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("chunks") - 1),
                    lambda other: F.least(chunk, other).cast("bigint") * (1 << 20) + F.greatest(chunk, other)))
    dealt = (routed.join(heavy, "bucket", "left").select(*routed.columns, F.explode(spread).alias("part"))
             .repartition(partitions(routed), "bucket", "part").sortWithinPartitions("bucket", "part"))

    def search(table: pa.Table) -> Iterator[pa.RecordBatch]:
        bucket, part = table.column("bucket").to_numpy(), table.column("part").to_numpy()
        fp, node = table.column("fp").to_numpy(), table.column("node").to_numpy()
        new = np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])))
        cells = np.cumsum(new) - 1
        many = np.bincount(cells)[cells] > 1
        cells, fp, node = cells[many], fp[many], node[many]
        if len(fp):
            index = GrayIndex(cells, fp.view(np.uint64))
            got = [index.forest(limit) for limit in limits]
            a, b = (node[np.concatenate([g[i] for g in got])] for i in range(2))
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < TOGETHER:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            bucket, part = table.column("bucket").to_numpy(), table.column("part").to_numpy()
            starts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])) + 1
            if len(starts):
                yield from search(table.slice(0, int(starts[-1])))
                table = table.slice(int(starts[-1]))
            held, rows = table.to_batches(), table.num_rows
        if rows:
            yield from search(pa.Table.from_batches(held).combine_chunks())

    return dealt.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, width: int = WIDTH, bits: int = BITS, shared: int = SHARED, id_column: str = "doc_id",
            text_column: str = "text") -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id it is linked to)."""
    known = stored(fingerprints(docs, width, id_column, text_column).select("doc_id", "fp"), "fingerprints")
    least = known.groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes = stored(least.select("fp", key_of(F.col("least"), F.col("fp")).alias("node"), F.col("least").isNull().alias("unnamed")),
                   "nodes")
    tied = components(links(nodes, bits, shared))
    root = F.coalesce("root", "node")
    named = (nodes.join(tied, "node", "left")
             .select("fp", F.when(~(F.col("unnamed") & (root >= UNNAMED)), root).alias("component_id")))
    return known.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                          "component_id")


def deduplicated(docs: DataFrame, width: int = WIDTH, bits: int = BITS, shared: int = SHARED, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """One document of each class, the one of the smallest id, with all its columns; the others go. Texts are shuffled once,
    to meet the keys of the rows that stay."""
    known = stored(fingerprints(docs, width, id_column, text_column), "fingerprints")
    least = known.groupBy("fp").agg(F.min("doc_id").alias("least"))
    # of several fingerprints with one id, one has the id as its number
    bearer = least.where("least is not null").groupBy("least").agg(F.min("fp").alias("fp")).select("fp", F.lit(True).alias("bears"))
    nodes = stored(least.join(bearer, "fp", "left").select(
        "fp", key_of(F.when(F.col("bears"), F.col("least")), F.col("fp")).alias("node")), "nodes")
    tied = components(links(nodes, bits, shared))
    rooted = nodes.join(tied, "node", "left").select("fp", F.coalesce("root", "node").alias("root"))
    text_hash, key = _text_hash(text_column), ["key", "text_hash"]
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    stays = known.join(rooted, "fp").groupBy("root").agg(first).select("first.doc_id", "first.text_hash")
    stays = stays.select(key_of(F.col("doc_id"), F.col("text_hash")).alias("key"), "text_hash")
    rows = known.groupBy(key_of(F.col("doc_id"), F.col("text_hash")).alias("key"), "text_hash").agg(F.count("*").alias("n"))
    stays = stored(rows.join(stays, key), "stays")
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    keyed = docs.select(row.alias("row"), key_of(F.col(id_column), text_hash).alias("key"), text_hash.alias("text_hash"))
    left = keyed.join(stays.where("n = 1"), key, "left_semi")
    again = stays.where("n > 1")
    if not again.isEmpty():  # rows that repeat each other
        left = left.union(keyed.join(again, key, "left_semi").dropDuplicates(key))
    return left.select([F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
