"""Suffix-array deduplication of passages: strings of ``LENGTH`` bytes that start in more than one place.

*Anchors.* Every window of ``LENGTH`` bytes has as its anchor the 32-byte string in it with the least hash, the last of
equal ones. Equal windows have equal anchors at equal places, so windows need to meet only where anchors are equal. A
maximal run of windows with one anchor is a strip, some 85 bytes apart; strips are what is shuffled, as two hashes (the
anchor's and the strip's content).

*Whole strips.* Strips whose anchor occurs once are done: nothing in them repeats. Strips with equal content repeat as a
whole. Both follow from aggregates that combine before the shuffle, so a group of copies, however large, becomes one row.

*Suffix order.* What is left, one strip of each content whose anchor has several contents, is sent with its bytes.
A task sorts the suffixes of its strips, cut at ``LENGTH`` bytes, by prefix doubling. In that order, ties by place, each
window's previous and next smaller positions are found by pointer jumping; the longer of its common prefixes with the two is
its longest previous factor. A window whose factor reaches ``LENGTH`` stands earlier too; the factor's source is then the
earlier occurrence, and the first of such a chain the passage's first. Anchors with more than ``HOT`` contents are not gathered: their windows go, hashed
to 128 bits, through an aggregate instead.

``first`` keeps the first occurrence (by id, then place; in one document an occurrence that overlaps the first one stays);
otherwise every occurrence goes.

Defined results: null text is empty; texts shorter than ``LENGTH`` have no window and stay; matches never cross documents;
rows that repeat id and text are copies of each other, and ``first`` cuts them alike, as the first of them; rows that repeat
an id with another text are documents of their own; rows without an id are known by their text and come last in order;
an empty table gives no rows; other columns pass through ``deduplicated`` and are ignored elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_texts, held, key_of, partitions, slices, stored

LENGTH, ANCHOR = 200, 32
HOT = 2048
#: Bytes of strips that a task sorts together, but for a single anchor's, which are at most HOT strips.
TOGETHER = 600_000
#: Windows of a text that are hashed at once.
CHUNK = 1 << 20
_BITS = 21
#: Bits of a strip's number of windows in its place; a strip has at most ``length - ANCHOR + 1``.
_PLACE = 20
_BASE = 0x9E3779B97F4A7C15 | 1
_KEY = ["doc_id", "tag"]
STRIPS = "doc_id long, tag int, place long, anchor long, content long"


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, as many as a chunk has bytes."""
    n = CHUNK + 2 * length
    return held(f"powers for {length}", lambda: tuple(
        np.multiply.accumulate(np.array([1] + [base] * n, np.uint64)) for base in (_BASE, pow(_BASE, -1, 1 << 64))))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def strips(text: bytes, length: int = LENGTH) -> Iterator[tuple[int, int, int]]:
    """(first window, number of windows, hash of their anchor) of each strip of a text."""
    up, down = _powers(length)
    width = length - ANCHOR + 1
    for begin in range(0, len(text) - length + 1, CHUNK):
        data = np.frombuffer(text, np.uint8, min(CHUNK + length - 1, len(text) - begin), begin)
        n = len(data)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(data * up[:n], out=total[1:])
        hashes = _mixed((total[ANCHOR:] - total[:-ANCHOR]) * down[:n - ANCHOR + 1])
        places = np.arange(len(hashes), dtype=np.uint64)
        least = (hashes >> np.uint64(_BITS) << np.uint64(_BITS)) | (np.uint64((1 << _BITS) - 1) - places)
        size = 1
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < width:
            least = np.minimum(least[:size - width], least[width - size:])
        at = (np.uint64((1 << _BITS) - 1) - (least & np.uint64((1 << _BITS) - 1))).astype(np.int64)
        starts = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        counts = np.diff(np.append(starts, len(at)))
        yield from zip((starts + begin).tolist(), counts.tolist(), hashes[at[starts]].view(np.int64).tolist())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _stripped(docs: DataFrame, length: int) -> DataFrame:
    """Every strip of every text: place is its first window << 20 | number of windows - 1."""
    from xxhash import xxh3_64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            ids, tags, places, anchors, contents = [], [], [], [], []
            for key, tag, text in zip(batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(),
                                      byte_texts(batch, "text")):
                view, before = memoryview(text), len(places)
                for start, count, anchor in strips(text, length):
                    places.append(start << _PLACE | count - 1)
                    anchors.append(anchor)
                    contents.append(_signed(xxh3_64_intdigest(view[start:start + count + length - 1])))
                ids += [key] * (len(places) - before)
                tags += [tag] * (len(places) - before)
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((ids, tags, places, anchors, contents), kinds)],
                                             names=[f.split()[0] for f in STRIPS.split(", ")])

    return docs.mapInArrow(run, STRIPS)


class Suffixes:
    """The suffixes of some bytes, cut at ``length``, ranked by prefix doubling; equal ranks are equal strings. The ranks of
    every doubling are kept: they give common prefixes."""

    def __init__(self, data: np.ndarray, length: int = LENGTH):
        self.n, self.length = len(data), length
        self.data = np.concatenate([data, np.zeros(length, np.uint8)])
        if length < 8:
            first, size = 1, 1
        else:
            first, size = 8, 8
        rank = np.zeros(self.n, np.uint64)
        for shift in range(first):
            rank = rank << np.uint64(8) | self.data[shift:shift + self.n].astype(np.uint64)
        #: (bytes compared, rank of each position), for ever longer strings.
        self.levels = [(size, self._dense(rank))]
        while size < length:
            step = min(size, length - size)
            rank = self.levels[-1][1].astype(np.uint64)
            behind = np.zeros(self.n, np.uint64)
            behind[:max(0, self.n - step)] = rank[step:]
            size += step
            self.levels.append((size, self._dense(rank << np.uint64(32) | behind)))

    def _dense(self, keys: np.ndarray) -> np.ndarray:
        order = np.argsort(keys)
        new = np.concatenate(([0], keys[order[1:]] != keys[order[:-1]])).astype(np.uint32)
        out = np.empty(self.n, np.uint32)
        out[order] = np.cumsum(new, dtype=np.uint32)
        return out

    @property
    def rank(self) -> np.ndarray:
        return self.levels[-1][1]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of pairs of different positions, at most ``length``."""
        out = np.zeros(len(a), np.int64)
        whole = self.rank[a] == self.rank[b]
        out[whole] = self.length
        left = np.flatnonzero(~whole)
        x, y, same = a[left], b[left], np.zeros(len(left), np.int64)
        for size, rank in reversed(self.levels[:-1]):  # what is common is a sum of such sizes and less than the least
            for _ in range(2):  # the last doubling may be of part of a size
                at, to = np.minimum(x + same, self.n - 1), np.minimum(y + same, self.n - 1)
                good = (x + same < self.n) & (y + same < self.n) & (same + size <= self.length) & (rank[at] == rank[to])
                same += size * good
        running = np.ones(len(left), bool)
        for _ in range(min(8, self.length) - 1):
            running &= (same < self.length) & (self.data[np.minimum(x + same, len(self.data) - 1)]
                                              == self.data[np.minimum(y + same, len(self.data) - 1)])
            same += running
        out[left] = np.minimum(same, self.length)
        return out


def smaller_before(values: np.ndarray) -> np.ndarray:
    """For each place of a list the nearest place before it that holds a smaller value, -1 if none; by pointer jumping."""
    before = np.arange(len(values)) - 1
    while True:
        far = np.flatnonzero((before >= 0) & (values[before] > values))
        if not len(far):
            return before
        before[far] = before[before[far]]


def previous_factors(suffixes: Suffixes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of some positions, in rising order: the length of its longest previous factor, at most ``suffixes.length``,
    and the (index of the) earlier position that it stands at, -1 if there is none."""
    order = np.argsort(suffixes.rank[at], kind="stable")  # ties by position
    before = smaller_before(order)
    behind = len(order) - 1 - smaller_before(order[::-1])[::-1]
    length, source = np.zeros(len(at), np.int64), np.full(len(at), -1)
    for near, there in ((before, before >= 0), (behind, behind < len(order))):
        mine, other = order[there], order[near[there]]
        shared = suffixes.common(at[mine], at[other])
        longer = shared > length[mine]
        length[mine[longer]], source[mine[longer]] = shared[longer], other[longer]
    return length, source


def repeated_windows(pieces: list[bytes], counts: list[int], keys: list, starts: list[int], first: bool,
                     length: int = LENGTH) -> list[tuple[int, int, int]]:
    """Of strips in order of their places: (strip, first window, number of windows) that repeat: a window whose longest
    previous factor reaches ``length``, and with it, unless the first occurrence stays, the window it stands at."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    counts = np.asarray(counts)
    strip = np.repeat(np.arange(len(pieces)), counts)
    within = np.arange(len(strip)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(np.cumsum(sizes) - sizes, counts) + within
    factor, source = previous_factors(Suffixes(data, length), at)
    again = factor >= length
    gone = again.copy()
    if first:
        lead = np.where(again, source, np.arange(len(at)))
        while True:  # the first of the chain
            jumped = lead[lead]
            if (jumped == lead).all():
                break
            lead = jumped
        place = np.asarray(starts)[strip] + within
        names = {}
        owner = np.array([names.setdefault(k, len(names)) for k in keys])[strip]
        gone &= (owner != owner[lead]) | (place >= place[lead] + length)
    else:
        gone[source[again]] = True
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0])).astype(np.int8)))
    out = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        while a < b:  # a run of windows may go on into the next strip
            n = min(b - a, int(counts[strip[a]] - within[a]))
            out.append((int(strip[a]), int(within[a]), n))
            a += n
    return out


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The documents with their key: the id, and a hash that tells texts of one id apart."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(F.col(id_column).cast("long").alias("id"), key_of(F.col(id_column), text).alias("doc_id"),
                       F.hash(text).alias("tag"), text.alias("text"))


def _split(docs: DataFrame, first: bool, length: int, whole: bool) -> tuple[DataFrame, DataFrame]:
    """Texts with strips that may repeat (all texts if ``whole``; others then have null parts), and the spans to remove:
    doc_id, tag, start, windows."""
    strip = stored(_stripped(docs, length), "strips")
    often = stored(strip.groupBy("anchor").count().where("count > 1").select("anchor"), "often")
    met = stored(strip.join(often, "anchor", "left_semi"), "met")
    contents = stored(met.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(F.struct(*_KEY, "place")).alias("one")),
                      "contents")
    several = contents.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    one = contents.join(several, "anchor").select("anchor", "one.*", (F.col("kinds") > HOT).alias("hot"))
    start = F.shiftright("place", _PLACE).cast("int")
    windows = (F.col("place").bitwiseAND(F.lit((1 << _PLACE) - 1)) + 1).cast("int")
    copies = met.join(contents.where("n > 1").select("anchor", "content", "one"), ["anchor", "content"])
    if first:
        apart = ((F.col("doc_id") != F.col("one.doc_id")) | (F.col("tag") != F.col("one.tag"))
                 | (start >= F.shiftright("one.place", _PLACE) + length))
        repeat = ((F.col("doc_id") == F.col("one.doc_id")) & (F.col("tag") == F.col("one.tag"))
                  & (F.col("place") == F.col("one.place")))
        copies = copies.where(apart & ~repeat)
    certain = stored(copies.select(*_KEY, start.alias("start"), windows.alias("windows")), "certain")
    parts = (one.select(*_KEY, F.struct(start.alias("start"), windows.alias("windows"), "anchor", "hot").alias("part"))
             .union(certain.groupBy(*_KEY).agg(F.lit(None).cast("struct<start:int,windows:int,anchor:bigint,hot:boolean>")
                                               .alias("part"))))
    asked = parts.groupBy(*_KEY).agg(F.collect_set("part").alias("parts"))  # a document's own strips, however many rows repeat it
    texts = stored(docs.join(asked, _KEY, "left" if whole else "inner"), "texts")

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            rows = [(key, tag, p["start"], p["windows"], p["anchor"], p["hot"],
                     text[p["start"]:p["start"] + p["windows"] + length - 1])
                    for key, tag, text, parts in zip(batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(),
                                                     byte_texts(batch, "text"), batch.column("parts").to_pylist())
                    for p in parts]
            columns = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=["doc_id", "tag", "start", "windows", "anchor", "hot", "bytes"])

    schema = "doc_id long, tag int, start int, windows int, anchor long, hot boolean, bytes binary"
    pieces = stored(texts.where(F.size("parts") > 0).select(*_KEY, "text", "parts")
                    .mapInArrow(cut_out, schema), "pieces")
    span = "doc_id long, tag int, start int, windows int"
    cold = (pieces.where("not hot").repartition(partitions(docs), "anchor")
            .sortWithinPartitions("anchor", *_KEY, "start").mapInArrow(_sorted_spans(first, length), span))
    hashed = pieces.where("hot").mapInArrow(_hashed_windows(length), "doc_id long, tag int, start int, high long, low long")
    alike = hashed.groupBy("high", "low").agg(F.count("*").alias("n"), F.min(F.struct(*_KEY, "start")).alias("one")).where("n > 1")
    hot = hashed.join(alike, ["high", "low"])
    if first:
        hot = hot.where((F.col("doc_id") != F.col("one.doc_id")) | (F.col("tag") != F.col("one.tag"))
                        | (F.col("start") >= F.col("one.start") + length))
    hot = hot.select(*_KEY, "start", F.lit(1).alias("windows"))
    return texts, certain.union(cold).union(hot)


def _sorted_spans(first: bool, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, anchor = 0, None

        def spans() -> pa.RecordBatch:
            keys, starts, counts, pieces = ([r[k] for r in held] for k in range(4))
            found = repeated_windows(pieces, counts, keys, starts, first, length)
            rows = [(*keys[s], starts[s] + a, n) for s, a, n in found]
            columns = list(zip(*rows)) if rows else [[]] * 4
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                              names=["doc_id", "tag", "start", "windows"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("anchor", "doc_id", "tag", "start", "windows", "bytes")]
            for name, key, tag, start, windows, piece in zip(*columns):
                if name != anchor and size > TOGETHER:
                    yield spans()
                    held, size = [], 0
                anchor = name
                held.append(((key, tag), start, windows, piece))
                size += len(piece)
        if held:
            yield spans()

    return run


def _hashed_windows(length: int):
    from xxhash import xxh3_128_digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            ids, tags, places, digests = [], [], [], []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "tag", "start", "windows", "bytes")]
            for key, tag, start, windows, piece in zip(*columns):
                view = memoryview(piece)
                digests += [xxh3_128_digest(view[i:i + length]) for i in range(windows)]
                places += range(start, start + windows)
                ids += [key] * windows
                tags += [tag] * windows
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(tags, pa.int32()), pa.array(places, pa.int32()),
                 pa.array(both[:, 0]), pa.array(both[:, 1])], names=["doc_id", "tag", "start", "high", "low"])

    return run


def removed_runs(spans: list[dict], length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the spans' windows cover."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["start"] + s["windows"] + length - 1) for s in spans):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs


def _kept(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for start, end in runs:
        out.append(text[at:start])
        at = end
    return b"".join([*out, text[at:]])


def _whole_characters(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs, drawn in to whole UTF-8 characters."""
    out = []
    for start, end in runs:
        while start < end and text[start] & 0xC0 == 0x80:
            start += 1
        while start < end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        out.append((start, end))
    return out


def digests(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document, every occurrence removed: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    keyed = _keyed(docs, id_column, text_column)
    texts, spans = _split(keyed, False, length, whole=False)
    listed = spans.groupBy(*_KEY).agg(F.collect_set(F.struct("start", "windows")).alias("spans"))
    found = texts.select(*_KEY, "text").join(listed, _KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            rows = []
            for text, spans in zip(byte_texts(batch, "text"), batch.column("spans").to_pylist()):
                runs = removed_runs(spans, length)
                rows.append((sum(b - a for a, b in runs), len(runs), hashlib.sha256(_kept(text, runs)).hexdigest()))
            columns = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tag"), pa.array(columns[0], pa.int64()),
                 pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
                names=["doc_id", "tag", "removed", "runs", "sha"])

    cut = found.mapInArrow(run, "doc_id long, tag int, removed long, runs long, sha string")
    cut = cut.dropDuplicates(_KEY)  # rows that repeat id and text were cut alike
    all_docs = keyed.select("id", *_KEY, F.octet_length("text").cast("long").alias("n_bytes"),
                            F.sha2(F.col("text"), 256).alias("own"))
    zero = F.lit(0).cast("long")
    return all_docs.join(cut, _KEY, "left").select(
        F.col("id").alias("doc_id"), "n_bytes", F.coalesce("removed", zero).alias("n_removed"), F.coalesce("runs", zero).alias("n_spans"),
        F.coalesce("sha", "own").alias("kept_sha256"))


def deduplicated(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents without later copies of passages, the first one kept, in whole characters; all columns. Documents
    that nothing remains of go."""
    names = docs.columns
    inner = [c for c in names if c not in (id_column, text_column)]
    keyed = docs.select(key_of(F.col(id_column), F.coalesce(F.col(text_column), F.lit(""))).alias("doc_id"),
                        F.hash(F.coalesce(F.col(text_column), F.lit(""))).alias("tag"),
                        F.coalesce(F.col(text_column), F.lit("")).alias("text"), F.struct(
                            F.col(id_column).alias("id"), F.col(text_column).isNull().alias("null_text"),
                            *[F.col(c).alias(f"c{i}") for i, c in enumerate(inner)]).alias("row"))
    texts, spans = _split(keyed, True, length, whole=True)
    listed = spans.groupBy(*_KEY).agg(F.collect_set(F.struct("start", "windows")).alias("spans"))
    touched = texts.where("parts is not null").drop("parts").join(listed, _KEY, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            kept, keep = [], []
            for text, spans in zip(byte_texts(batch, "text"), batch.column("spans").to_pylist()):
                rest = _kept(text, _whole_characters(text, removed_runs(spans or [], length)))
                kept.append(rest.decode("utf-8", "replace"))
                keep.append(not spans or bool(rest.strip()))
            out = batch.drop_columns(["spans"]).set_column(batch.schema.get_field_index("text"), "text",
                                                           pa.array(kept, pa.string()))
            yield out.filter(pa.array(keep, pa.bool_()))

    plain = texts.where("parts is null").drop("parts")
    cut = touched.mapInArrow(run, plain.schema)
    shown = plain.union(cut.select(*plain.columns))
    return shown.select([
        F.col("row.id").alias(c) if c == id_column
        else F.when(~F.col("row.null_text"), F.col("text")).alias(c) if c == text_column
        else F.col(f"row.c{inner.index(c)}").alias(c) for c in names])
