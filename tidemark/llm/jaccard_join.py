"""N-gram Jaccard join: all documents whose sets of word shingles are alike, in size-banded tiles with bitmap signatures.

*Sets.* A document's set is its distinct shingles, as 64-bit hashes in a sorted array. Documents of equal sets are one class,
formed by an aggregate that combines before the shuffle.

*Rows that may meet.* Shingles are put in one order for all: by how often their counter was met in the whole corpus, the
rarest first, then by hash. Two sets that are alike share one of their first shingles, ``size - ceil(0.8 size) + 1`` of each,
whatever the order; as common passages come last, only documents without enough rare shingles of their own meet in large
groups. The counters are a table of fixed size; they decide the order, not the result.

*Cells.* Classes that share a first shingle make a cell; of cells with the same classes (told by their count and two sums
of hashes) one is kept, and a cell above ``CELL`` rows is dealt as pairs of chunks. In a cell rows are sorted by size, and a row meets only those whose size is at most 5/4 of its own. Of each pair the hashed bitmaps,
one to two bits a shingle, bound the intersection from above: the sizes' sum less the differing bits, halved; of two widths
the wider is folded. Pairs that the bound
leaves tie their classes to one block; pairs already in one class of the cell are left out, as blocks need no more.

*Tiles.* No link joins two blocks. A block's classes come once more, with their arrays: a small block is one tile, a large
one is cut in tiles of two neighbouring size bands (of a factor of 5/4) and two chunks, so that every pair meets in one tile.
There rows are sorted by size and meet those of up to 5/4 of it; bitmaps as wide as the tile's sets bound the intersection
again, and what is left is counted exactly on the sorted arrays. A tile gives a forest of its links and the number of links
of each class, never its pairs. Texts are not shuffled: a table of fixed size tells which of them may be asked for.

Two hashes of 64 bits stand for two shingles; equal sets are told by 128 bits.

Defined results: null, empty and blank texts have an empty set and are linked with nothing, each its own component; fewer
words than a shingle are one shingle; rows that repeat each other are linked like other copies; an id with several texts
stands for several documents; rows without an id are linked like any other, and a component of such rows alone is null; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import UNNAMED, byte_texts, discard, key_of, partitions, slices, stored
from tidemark.llm.components import components

WIDTH = 5
#: Similarity as a fraction, and with it the band factor 5/4.
ALIKE, OF = 4, 5
#: Counters of shingles (a power of two), and the parts in which tasks hand them on.
COUNTERS, PARTS = 1 << 20, 64
CELL = 4096
#: Cells up to this size are searched together, larger ones one by one.
SMALL = 64
#: Rows of whole cells that a worker searches together; pairs made at once, and words of bitmaps compared at once.
TOGETHER, PAIRS, COMPARED = 1 << 14, 1 << 17, 1 << 20
#: Shingles of a chunk of a block, about; the band of tiles that are whole blocks.
CHUNK, WHOLE = 1 << 20, -2
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX[1]
    x ^= x >> np.uint64(29)
    x *= _MIX[2]
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Hashes of a text's shingles of lower-cased words, repeats included; of all words if there are fewer; none without."""
    from xxhash import xxh3_64_intdigest

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    out = np.full(n, min(width, len(words)), np.uint64)
    for at in range(min(width, len(words))):
        out = out * _MIX[0] + each[at:at + n]
    return mixed(out)


def counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def counted_slots(frame: DataFrame, hashes) -> np.ndarray:
    """How often each counter's hashes come in a table: ``COUNTERS`` numbers, whatever the table. ``hashes`` reads them from
    a batch."""
    size = COUNTERS // PARTS

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in slices(batches, 500):
            total += np.bincount(counter(hashes(batch)), minlength=COUNTERS)
        if total.any():
            yield handed(range(PARTS), [total[p * size:(p + 1) * size] for p in range(PARTS)])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                totals[part] = totals.get(part, 0) + np.frombuffer(zlib.decompress(packed), np.int64)
        if totals:
            yield handed(list(totals), list(totals.values()))

    def handed(parts, counts: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array(
            [zlib.compress(c.tobytes(), 1) for c in counts], pa.binary())], names=["part", "counts"])

    schema = "part int, counts binary"
    sums = (frame.mapInArrow(counted, schema).repartition(min(PARTS, partitions(frame)), "part").mapInArrow(summed, schema))
    out = np.zeros((PARTS, size), np.int64)
    for row in sums.collect():  # PARTS rows of fixed size
        out[row.part] = np.frombuffer(zlib.decompress(row.counts), np.int64)
    return np.minimum(out.reshape(-1), np.iinfo(np.uint32).max).astype(np.uint32)


def shingle_counts(docs: DataFrame, width: int = WIDTH, text_column: str = "text") -> np.ndarray:
    """How often each counter's shingles come in the whole corpus."""
    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *(shingles(t, width) for t in byte_texts(batch, "text"))])

    return counted_slots(docs.select(F.col(text_column).alias("text")), hashes)


def words_for(n: int) -> int:
    """Words of 64 bits in the bitmap of a set of n: a power of two, one to two bits a shingle."""
    return 1 << max(0, (n - 1).bit_length() - 6)


def bitmap(hashes: np.ndarray, words: int) -> np.ndarray:
    """A set's hashed bitmap of ``words`` times 64 bits (a power of two)."""
    bits = np.zeros(words * 64, np.uint8)
    bits[(hashes & np.uint64(words * 64 - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


class Bitmaps:
    """Bitmaps of unlike widths; a wider one is folded to the width of the other."""

    def __init__(self, packed: list[bytes]):
        self.packed = packed
        self.words = np.array([len(p) // 8 for p in packed])
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def of_width(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of this width and of twice as much, folded, and each row's place among them."""
        if words not in self.folded:
            place = np.zeros(len(self.packed), np.int64)
            parts, at = [], 0
            for times in (1, 2):
                rows = np.flatnonzero(self.words == words * times)
                place[rows] = at + np.arange(len(rows))
                at += len(rows)
                wide = np.frombuffer(b"".join([self.packed[r] for r in rows.tolist()]), np.uint64).reshape(len(rows), times, words)
                parts.append(np.bitwise_or.reduce(wide, axis=1))
            self.folded[words] = np.concatenate(parts), place
        return self.folded[words]

    def differing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Differing bits of pairs whose sizes are within the factor, so that widths are within two."""
        out = np.zeros(len(a), np.int64)
        least = np.minimum(self.words[a], self.words[b])
        for words in np.unique(least).tolist():
            bits, place = self.of_width(words)
            mine = np.flatnonzero(least == words)
            step = max(1, COMPARED // words)
            for at in range(0, len(mine), step):
                some = mine[at:at + step]
                out[some] = np.bitwise_count(bits[place[a[some]]] ^ bits[place[b[some]]]).sum(1, dtype=np.int64)
        return out


def first_shingles(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Those of a sorted set, first in the common order, of which two sets that are alike share one. Sets of three or fewer
    are alike only to equal ones."""
    n = len(hashes)
    if n < ALIKE:
        return hashes[:0]
    order = np.lexsort((hashes, counts[counter(hashes)]))
    return hashes[order[:n + ALIKE * n // -OF + 1]]


def _known(docs: DataFrame, sent, width: int, id_column: str, text_column: str) -> DataFrame:
    """Per row: doc_id, text_hash, n, digest (null for the empty set), first (shingles), bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            n, digest, first, bits = [], [], [], []
            for text in byte_texts(batch, "text"):
                own = np.unique(shingles(text, width))
                n.append(len(own))
                digest.append(hashlib.md5(own.tobytes(), usedforsecurity=False).digest() if len(own) else None)
                first.append(first_shingles(own, sent.value).view(np.int64))
                bits.append(bitmap(own, words_for(len(own))).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(first, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                names=["doc_id", "text_hash", "n", "digest", "first", "bits"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), _text_hash(text_column).alias("text_hash"),
                       F.col(text_column).alias("text")
                       ).mapInArrow(run, "doc_id long, text_hash binary, n long, digest binary, first array<long>, bits binary")


def _text_hash(text_column: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text_column), F.lit(""))))


def _classes(known: DataFrame) -> DataFrame:
    """Per set: digest, node (a number of its own: its smallest id, or a hash where that is null or another set's too), least
    (the smallest id), one (the text's hash of that row), copies, n, first, bits."""
    one = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("one")
    sets = stored(known.where("n > 0").groupBy("digest").agg(
        one, F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("n", "first", "bits")]
    ).select("digest", F.col("one.doc_id").alias("least"), F.col("one.text_hash").alias("one"), "copies", "n", "first", "bits"), "sets")
    hashed = F.shiftrightunsigned(F.xxhash64("digest"), 2) + UNNAMED
    shared = stored(sets.groupBy("least").count().where("least is not null and count > 1")
                    .select("least", F.lit(True).alias("shared")), "shared-ids")
    if shared.isEmpty():
        return sets.withColumn("node", F.coalesce("least", hashed))
    node = F.when(F.col("least").isNull() | F.col("shared").isNotNull(), hashed).otherwise(F.col("least"))
    return stored(sets.join(shared, "least", "left").withColumn("node", node).drop("shared"), "classes")


def _met(classes: DataFrame) -> DataFrame:
    """Stored: token, rows, node for every first shingle that two classes or more share."""
    tokens = classes.select("node", F.explode("first").alias("token"))
    often = tokens.groupBy("token").agg(F.count("*").alias("rows")).where("rows > 1")
    return stored(tokens.join(often, "token"), "met")


def _sharing(met: DataFrame, classes: DataFrame, cell: int) -> DataFrame:
    """Rows of cells: token, part, node, n, bits, one cell for each set of classes that meet."""
    number = F.xxhash64("node")
    sums = met.groupBy("token", "rows").agg(F.bit_xor(number).alias("x"), F.sum(number.bitwiseAND(F.lit((1 << 31) - 1))).alias("y"))
    one = sums.groupBy("rows", "x", "y").agg(F.min("token").alias("token")).select("token")
    met = met.join(one, "token").join(classes.select("node", "n", "bits"), "node")
    chunks = F.ceil(F.col("rows") / cell).cast("long")
    mine = F.pmod(F.xxhash64("node"), chunks)
    parts = F.when(F.col("rows") <= cell, F.array(F.lit(0).cast("long"))).otherwise(F.transform(
        F.sequence(F.lit(0).cast("long"), chunks - 1), lambda other: F.least(mine, other) * (1 << 24) + F.greatest(mine, other)))
    return met.select("token", F.explode(parts).alias("part"), "node", "n", "bits")


def bound_passes(n: np.ndarray, m: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Whether sets of n and m shingles whose bitmaps differ in so many bits may be alike: the intersection is at most
    (n + m - differ) / 2, and the union what is left of n + m."""
    return OF * (n + m - differ) >= ALIKE * (n + m + differ)


class Forest:
    """Classes of rows that pairs unite, and the pairs that did."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            apart = self.label[a] != self.label[b]
            a, b = a[apart], b[apart]
            if not len(a):
                return
            x, y = self.label[a], self.label[b]
            high, once = np.unique(np.maximum(x, y), return_index=True)  # each class but the least joins one smaller class
            self.links.append((a[once], b[once]))
            self.label[high] = np.minimum(x, y)[once]
            while True:
                jumped = self.label[self.label]
                if (jumped == self.label).all():
                    break
                self.label = jumped

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate([none, *x]) for x in zip(*self.links)) if self.links else (none, none)


def tied(cell: np.ndarray, n: np.ndarray, bits: Bitmaps) -> tuple[np.ndarray, np.ndarray]:
    """A forest over all pairs of rows of one cell whose sizes and bitmaps let them be alike. Rows are sorted by cell, then
    size."""
    forest = Forest(len(cell))
    starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    ends = np.append(starts[1:], len(cell))
    scale = int(n.max(initial=0)) * 2 + 2
    key = np.repeat(np.arange(len(starts)), ends - starts) * scale
    last = np.searchsorted(key + n, key + OF * n // ALIKE, "right")  # of the rows that are not too large
    big = ends - starts > SMALL

    def test(a: np.ndarray, b: np.ndarray) -> None:
        apart = forest.label[a] != forest.label[b]
        a, b = a[apart], b[apart]
        good = bound_passes(n[a], n[b], bits.differing(a, b))
        forest.unite(a[good], b[good])

    rows = np.flatnonzero(~np.repeat(big, ends - starts))
    times = last[rows] - rows - 1
    upto = np.cumsum(times)
    at = 0
    while at < len(rows):
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
        a = np.repeat(rows[at:stop], times[at:stop])
        begin = np.cumsum(times[at:stop]) - times[at:stop]
        test(a, a + 1 + np.arange(len(a)) - np.repeat(begin, times[at:stop]))
        at = stop
    for start, end in zip(starts[big].tolist(), ends[big].tolist()):
        every = np.arange(start, end)
        main = None
        for row in range(start, end):  # of two classes at least one is not that of ``main``
            if main is not None and forest.label[row] == forest.label[main]:
                continue
            near = every[(OF * n[start:end] >= ALIKE * n[row]) & (ALIKE * n[start:end] <= OF * n[row])]
            test(np.full(len(near), row), near)
            if main is None:
                labels, sizes = np.unique(forest.label[start:end], return_counts=True)
                main = start + int(np.flatnonzero(forest.label[start:end] == labels[sizes.argmax()])[0])
    return forest.pairs()


def _blocks(sharing: DataFrame) -> DataFrame:
    """Links a, b that hold together all classes that may be alike."""
    dealt = sharing.repartition(partitions(sharing), "token", "part").sortWithinPartitions("token", "part", "n")

    def searched(table: pa.Table) -> pa.RecordBatch:
        token, part, node, n = (table.column(c).to_numpy() for c in ("token", "part", "node", "n"))
        cell = np.cumsum(np.concatenate(([False], (token[1:] != token[:-1]) | (part[1:] != part[:-1]))))
        a, b = tied(cell, n, Bitmaps(table.column("bits").to_pylist()))
        links = np.unique(np.stack([np.maximum(node[a], node[b]), np.minimum(node[a], node[b])], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ("token", "part"), TOGETHER):
            yield searched(table)

    return dealt.mapInArrow(run, "a long, b long")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], rows: int) -> Iterator[pa.Table]:
    """Tables of whole groups of sorted rows, of about so many rows or one larger group."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        new = np.zeros(table.num_rows - 1, bool)
        for key in keys:
            values = table.column(key).to_numpy()
            new |= values[1:] != values[:-1]
        starts = np.flatnonzero(new) + 1
        if len(starts):
            yield table.slice(0, int(starts[-1]))
            table = table.slice(int(starts[-1]))
        held, n = table.to_batches(), table.num_rows
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _arrays(docs: DataFrame, members: DataFrame, width: int, id_column: str, text_column: str) -> DataFrame:
    """``members`` with their sorted shingles, read again from one text of each class. Texts whose key has an empty slot are
    left alone before anything is shuffled."""
    key = ["key", "text_hash"]
    asked = members.select(key_of(F.col("least"), F.col("one")).alias("key"), F.col("one").alias("text_hash"), "root", "node",
                           "copies", "n")
    slot = F.xxhash64(*key).alias("slot")
    sent = docs.sparkSession.sparkContext.broadcast(counted_slots(
        asked.select(slot), lambda batch: batch.column("slot").to_numpy().view(np.uint64)) > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(sent.value[counter(batch.column("slot").to_numpy().view(np.uint64))]))
            for part in slices([some], 200):
                sets = [np.unique(shingles(t, width)).tobytes() for t in byte_texts(part, "text")]
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("text_hash"), pa.array(sets, pa.binary())],
                                                 names=["key", "text_hash", "shingles"])

    text_hash = _text_hash(text_column)
    texts = docs.select(key_of(F.col(id_column), text_hash).alias("key"), text_hash.alias("text_hash"),
                        F.col(text_column).alias("text")).select(*key, slot, "text")
    found = texts.mapInArrow(run, "key long, text_hash binary, shingles binary")
    return found.dropDuplicates(key).join(asked, key)  # rows that repeat each other are read once


def _tiled(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of tiles: root, band, i, j (the tile), own (the row's band), at (its chunk), node, copies, shingles. ``sizes`` has
    the number of chunks of each block; a block of one chunk is one tile."""
    # steps of a little over 5/4: a size up to 5/4 of one's own lies in the same band or the next
    band = F.floor(F.log("n") / (math.log(OF / ALIKE) * (1 + 1e-9))).cast("int")
    rows = members.join(sizes, "root").withColumns(
        {"own": band, "at": F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")})
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    place = lambda b, i, j: F.struct(b.alias("band"), i.alias("i"), j.alias("j"))
    left = F.transform(every, lambda j: place(F.col("own"), F.col("at"), j))
    right = F.transform(every, lambda i: place(F.col("own"), i, F.col("at")))
    lower = F.transform(every, lambda i: place(F.col("own") - 1, i, F.col("at")))
    whole = F.array(place(F.lit(WHOLE), F.lit(0), F.lit(0)))
    tiles = F.when(F.col("chunks") == 1, whole).otherwise(F.array_union(F.array_union(left, right), lower))
    return rows.select("root", F.explode(tiles).alias("tile"), "own", "at", "node", "copies", "shingles").select(
        "root", "tile.band", "tile.i", "tile.j", "own", "at", "node", "copies", "shingles")


def links_of_tile(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each set of ``left``, those of ``right`` (positions; the later ones where both hold it) that are alike to it."""
    n = np.array([len(s) for s in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
    ends = np.cumsum(n)
    words = 2 * words_for(int(n.max()))
    right = right[np.argsort(n[right], kind="stable")]
    bits = {int(r): bitmap(sets[r], words) for r in {*left.tolist(), *right.tolist()}}
    others = np.stack([bits[r] for r in right.tolist()]) if len(right) else np.zeros((0, words), np.uint64)
    listed = [ids[ends[r] - n[r]:ends[r]] for r in right.tolist()]
    mark = np.zeros(int(ends[-1]), np.int8)
    both = {*left.tolist()} & {*right.tolist()}
    place = {r: i for i, r in enumerate(right.tolist())}
    for a in left.tolist():
        low, high = np.searchsorted(n[right], [-(-ALIKE * n[a] // OF), OF * n[a] // ALIKE + 1])
        near = np.arange(low, high)
        if a in both:  # a pair of two sets of both sides is met from its earlier one
            near = near[(near > place[a]) | ~np.isin(right[near], left)] if len(both) < len(right) else near[near > place[a]]
        differ = np.bitwise_count(others[near] ^ bits[a]).sum(1, dtype=np.int64)
        near = near[bound_passes(n[a], n[right[near]], differ)]
        if not len(near):
            continue
        own = ids[ends[a] - n[a]:ends[a]]
        mark[own] = 1
        sizes = n[right[near]]
        shared = np.add.reduceat(mark[np.concatenate([listed[i] for i in near.tolist()])], np.cumsum(sizes) - sizes, dtype=np.int64)
        mark[own] = 0
        good = OF * shared >= ALIKE * (n[a] + sizes - shared)
        yield a, right[near[good]]


def _linked(tiles: DataFrame) -> DataFrame:
    """Of each tile: links a, b that hold its classes together, and rows a, links (b null), the links of class a."""
    keys = ("root", "band", "i", "j")
    dealt = tiles.repartition(partitions(tiles), *keys).sortWithinPartitions(*keys)

    def searched(table: pa.Table) -> pa.RecordBatch:
        band, i, j = (table.column(c)[0].as_py() for c in keys[1:])
        own, at, node, copies = (table.column(c).to_numpy() for c in ("own", "at", "node", "copies"))
        left = np.flatnonzero((band == WHOLE) | (own == band) & (at == i))
        right = np.flatnonzero((band == WHOLE) | (own == band + 1) & (at == j) | (own == band) & (at == j) & (j >= i))
        forest, n_links = Forest(len(own)), np.zeros(len(own), np.int64)
        if len(left) and len(right) and len(np.union1d(left, right)) > 1:
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            for a, others in links_of_tile(sets, left, right):
                n_links[a] += copies[others].sum()
                n_links[others] += copies[a]
                forest.unite(np.full(len(others), a), others)
        a, b = forest.pairs()
        some = np.flatnonzero(n_links)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([node[a], node[some]])), pa.array([*node[b].tolist(), *[None] * len(some)], pa.int64()),
             pa.array(np.concatenate([np.zeros(len(a), np.int64), n_links[some]]))], names=["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys, 1):
            starts = [0]
            columns = [table.column(c).to_numpy() for c in keys]
            new = np.zeros(max(0, table.num_rows - 1), bool)
            for c in columns:
                new |= c[1:] != c[:-1]
            starts += (np.flatnonzero(new) + 1).tolist()
            for start, end in zip(starts, [*starts[1:], table.num_rows]):
                yield searched(table.slice(start, end - start))

    return dealt.mapInArrow(run, "a long, b long, links long")


def joined(docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text", cell: int = CELL,
           chunk: int = CHUNK) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest id reachable by links of a similarity of 0.8 or more),
    n_links (documents it is linked to itself)."""
    sent = docs.sparkSession.sparkContext.broadcast(shingle_counts(docs, width, text_column))
    known = stored(_known(docs, sent, width, id_column, text_column), "shingle-sets")
    sent.destroy()
    classes = _classes(known)
    met = _met(classes)
    links = stored(_blocks(_sharing(met, classes, cell)), "block-links")
    discard(met)
    blocks = components(links)
    roots = stored(blocks.union(blocks.select("root", "root").distinct()), "blocks")  # roots are not listed as nodes
    members = stored(classes.select("node", "least", "one", "copies", "n").join(roots, "node"), "members")
    sizes = members.groupBy("root").agg(F.ceil(F.sum("n") / chunk).cast("int").alias("chunks"))
    found = stored(_linked(_tiled(_arrays(docs, members, width, id_column, text_column), sizes)), "links")
    ties = components(found.where("b is not null").select("a", "b"))
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    named = (classes.select("digest", "node", "least", "copies").join(ties, "node", "left").join(counts, "node", "left")
             .select("digest", "least", F.coalesce("root", "node").alias("root"),
                     (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    named = stored(named, "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    each = named.join(least, "root").select("digest", "component_id", "n_links")
    shown = known.select("doc_id", "n", "digest").join(each, "digest", "left")
    return shown.select("doc_id", F.col("n").alias("n_shingles"),
                        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
