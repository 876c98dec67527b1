"""Best-fit packing of token sequences into bins of a fixed size, improved by swap-based local search.

Texts become pieces in one pass; only the pieces' lengths go on. They are dealt by a hash of document and piece into
groups of about ``GROUP`` pieces, so a hot source or a group of copies spreads evenly, and each group is packed by
itself: best fit with the longest first, then a local search that moves one or two pieces, or swaps them for one,
between any two bins with room whenever the sum of squared fills grows, until no step helps. Short pieces leave less than
a bin of waste to a group; where all are a quarter to a half of a sequence, some bins cannot be filled.

Defined results: null text is empty and has the end id only; longer documents are cut into whole-size pieces and a
rest; equal lengths are told apart by document and piece; repeated doc_ids are packed as they stand; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_texts, partitions, slices, stored
from tidemark.llm.tokens import encoder, public_path

SIZE = 4096
#: Pieces of one group, about: what one task packs at once.
GROUP = 20_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


def pieces(docs: DataFrame, size: int = SIZE, end_id: int = 1, vocabulary: Callable[[], str] = public_path,
           id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per piece of a document's ids and end id: doc_id, piece, start, length, ids_crc32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary())
        end = np.asarray([end_id], coder.type).tobytes()
        for batch in slices(batches, 500):
            rows = []
            for key, coded in zip(batch.column("doc_id").to_pylist(), coder.encode(byte_texts(batch, "text"))):
                ids = np.frombuffer(coded + end, coder.type).astype("<u4")
                for n, at in enumerate(range(0, len(ids), size)):
                    part = ids[at:at + size]
                    rows.append((key, n, at, len(part), zlib.crc32(part)))
            columns = list(zip(*rows)) if rows else [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=[f.split()[0] for f in PIECES.split(", ")])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
                       ).mapInArrow(run, PIECES)


def best_fit(lengths: Sequence[int], size: int = SIZE) -> list[list[int]]:
    """Bins of indexes: the longest first, each into the fullest bin that still has room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect.bisect_left(rooms, lengths[i])
        if at == len(rooms):
            b, room = len(bins), size
            bins.append([])
        else:
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
        bins[b].append(i)
        room -= lengths[i]
        if room:
            if not by_room[room]:
                bisect.insort(rooms, room)
            by_room[room].append(b)
    return bins


class _Search:
    """All bins with room under local search: a move of one or two pieces, or a swap of them for one, from a bin into one at
    least as full. A step's gain is half the growth of the sum of squared fills, always positive, so the search ends.

    What a bin can give, each piece and each sum of two, lies in one table sorted by length, so a bin looks only at what
    would fill it further. A full bin neither gives nor takes and leaves the table."""

    def __init__(self, bins: list[list[int]], lengths: Sequence[int], size: int):
        self.bins, self.lengths, self.size = bins, lengths, size
        self.fill = np.asarray([sum(lengths[i] for i in b) for b in bins], np.int64)
        offers = [self._offers(b) for b in np.flatnonzero(self.fill < size).tolist()]
        self.value = np.concatenate([np.zeros(0, np.int64), *(v for v, _ in offers)])
        self.owner = np.concatenate([np.zeros(0, np.int64), *(o for _, o in offers)])
        by = np.argsort(self.value, kind="stable")
        self.value, self.owner = self.value[by], self.owner[by]

    def _offers(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """The different lengths that bin b can give."""
        own = np.asarray([self.lengths[i] for i in self.bins[b]], np.int64)
        x, y = np.triu_indices(len(own), 1)
        values = np.unique(np.concatenate((own, own[x] + own[y])))
        return values, np.full(len(values), b, np.int64)

    def _taken(self, a: int, value: int) -> list[int]:
        """One piece of bin a of this length, or else two."""
        seen: dict[int, int] = {}
        for i in self.bins[a]:
            if self.lengths[i] == value:
                return [i]
        for i in self.bins[a]:
            if value - self.lengths[i] in seen:
                return [seen[value - self.lengths[i]], i]
            seen[self.lengths[i]] = i
        raise ValueError("no such pieces")

    def step(self, b: int) -> bool:
        """The best move or swap that makes b fuller at the cost of a bin that is no fuller."""
        room, best = self.size - int(self.fill[b]), (0, 0, 0, None)
        firsts: dict[int, int] = {self.lengths[k]: k for k in reversed(self.bins[b])}
        for given, k in [(0, None), *firsts.items()]:
            low, high = np.searchsorted(self.value, (given + best[0], given + room), "right")
            if low < high:
                owner = self.owner[low:high]
                good = np.flatnonzero((self.fill[owner] <= self.fill[b]) & (owner != b))
                if len(good):
                    at = low + int(good[-1])
                    best = (int(self.value[at]) - given, int(self.owner[at]), int(self.value[at]), k)
                    if best[0] == room:
                        break
        gain, a, value, k = best
        if not gain:
            return False
        taken = self._taken(a, value)
        self.bins[a] = [i for i in self.bins[a] if i not in taken] + ([] if k is None else [k])
        self.bins[b] = [i for i in self.bins[b] if i != k] + taken
        self.fill[a] -= gain
        self.fill[b] += gain
        stay = (self.owner != a) & (self.owner != b)
        value, owner = self.value[stay], self.owner[stay]
        fresh = [self._offers(c) for c in (a, b) if self.fill[c] < self.size]
        new_value, new_owner = (np.concatenate(x) for x in zip(*fresh))
        by = np.argsort(new_value, kind="stable")
        at = np.searchsorted(value, new_value[by])
        self.value, self.owner = np.insert(value, at, new_value[by]), np.insert(owner, at, new_owner[by])
        return True

    def run(self, underfull: int | None = None) -> list[list[int]]:
        """Passes over all bins with room, or only so many of the emptiest, the fullest first, until no step helps."""
        moved = True
        while moved:
            moved = False
            takers = sorted(np.flatnonzero(self.fill < self.size).tolist(), key=lambda b: (-self.fill[b], b))
            for b in takers[-underfull:] if underfull else takers:
                while 0 < self.fill[b] < self.size and self.step(b):
                    moved = True
        return [b for b in self.bins if b]


def pack(lengths: Sequence[int], size: int = SIZE) -> list[list[int]]:
    """Bins of indexes: best fit, then local search."""
    return _Search(best_fit(lengths, size), lengths, size).run()


def packed(docs: DataFrame, size: int = SIZE, end_id: int = 1, vocabulary: Callable[[], str] = public_path,
           group: int = GROUP, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. The pieces are written once to the
    shared folder, so that texts are encoded once; their number gives the number of groups."""
    cut = stored(pieces(docs, size, end_id, vocabulary, id_column, text_column), "pieces")
    groups = max(1, round(cut.count() / group))
    keyed = cut.withColumn("bundle", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            bundles = batch.column("bundle").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(bundles)) + 1).tolist(), len(bundles)]
            for a, b in zip(edges, edges[1:]):
                if b > a:
                    if current is not None and bundles[a] != current:
                        yield placed(held, current)
                        held = []
                    current = int(bundles[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield placed(held, current)

    def placed(parts: list[pa.RecordBatch], bundle: int) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        lengths = rows.column("length").to_pylist()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for n, members in enumerate(pack(lengths, size)):
            at = 0
            for i in members:
                sequence[i], offset[i] = bundle << 32 | n, at
                at += lengths[i]
        names = [f.split()[0] for f in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([rows.column(n) for n in names] + [pa.array(sequence), pa.array(offset)],
                                          names=[*names, "sequence_id", "offset"])

    dealt = keyed.repartition(min(groups, 4 * partitions(docs)), "bundle")
    return dealt.sortWithinPartitions("bundle", "doc_id", "piece", "start", "ids_crc32").mapInArrow(run, PACKED)
