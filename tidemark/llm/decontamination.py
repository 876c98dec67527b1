"""Benchmark decontamination: a generalised suffix automaton of the test items' words.

Items are dealt to blocks of bounded size. A task builds a block's automaton; it goes to the executors, training tokens
stream through it while the longest matching length is tracked, and it goes again before the next block comes: neither the
driver nor a worker ever holds two. A place where the length reaches the window hits the window's words; an item shorter than
the window is one window by itself. Documents are never shuffled while there is one block, so neither a hot source nor a group
of copies gathers in a task; with several, the hits of the few documents that have any are united by document. Runs of words
that no item has cannot match and are skipped whole.

``hits`` counts, ``clean`` drops documents hit to a share of their words, ``cut`` removes the hit spans: every span of
``longest`` words or more, and all spans of a document hit to the share.

Defined results: null or wordless documents have no words, hits or items and are clean; items without words are ignored, and
those without an id hit words but are not counted or named; repeated items and rows count once in n_items; without items
nothing is hit; ``cut`` leaves a null text null.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import alnum_words, byte_texts, held, key_of, slices, stored

WINDOW = 13
#: The words of ``alnum_words`` in place.
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Bytes of item text in one automaton: what a block may take in a worker, whatever the number of items.
BLOCK_BYTES = 1_000_000
#: Words of a hit span that ``cut`` removes from any document.
LONGEST = 50
SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class SuffixAutomaton:
    """States of all substrings of the items' word sequences, with the items of each window."""

    def __init__(self, items: Sequence[tuple[object, bytes]], window: int = WINDOW):
        self.window, self.vocabulary = window, {}
        self.step, self.link, self.length = [{}], [-1], [0]
        self.items: dict[int, set] = {}
        self.whole: dict[int, list[tuple[int, object]]] = {}
        sequences = []
        for item, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in alnum_words(text)]
            if words:
                sequences.append((item, words))
                last = 0
                for word in words:
                    last = self._extend(last, word)
        self.shortest = min([window, *(len(w) for _, w in sequences)])
        for item, words in sequences:
            state = matched = 0
            for word in words:
                state, matched = self.advance(state, matched, word)
                if matched >= window:
                    self.items.setdefault(self.at_window(state), set()).update([item] if item is not None else [])
            if len(words) < window:
                self.whole.setdefault(state, []).append((len(words), item))
        self.next_whole = self._chain()

    def _copy(self, state: int, length: int) -> int:
        self.step.append(dict(self.step[state]))
        self.link.append(self.link[state])
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The state for ``state`` + ``word`` alone, taken out of ``target``, which also has longer words."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._copy(target, self.length[state] + 1)
        self.link[target] = copy
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:
            return self._split(last, word, self.step[last][word])
        new = len(self.step)
        self.step.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        while last >= 0 and word not in self.step[last]:
            self.step[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word, self.step[last][word])
        return new

    def _chain(self) -> list[int]:
        """For each state, the nearest on its way of suffix links, itself included, that is a whole short item."""
        nearest = [-1] * len(self.step)
        for state in sorted(range(len(self.step)), key=self.length.__getitem__):
            nearest[state] = state if state in self.whole else nearest[self.link[state]] if state else -1
        return nearest

    def advance(self, state: int, matched: int, word: int) -> tuple[int, int]:
        while state and word not in self.step[state]:
            state = self.link[state]
            matched = self.length[state]
        target = self.step[state].get(word)
        return (0, 0) if target is None else (target, matched + 1)

    def at_window(self, state: int) -> int:
        """The state of the last ``window`` words."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit spans of words (start, end), unmerged, in order of their ends; and the items that occur."""
        known = np.fromiter(map(self.vocabulary.get, words, [0] * len(words)), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known != 0, [0])).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.shortest
        found, items = [], set()
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            state = matched = 0
            for at, word in enumerate(known[start:end].tolist(), start):
                state, matched = self.advance(state, matched, word)
                if matched >= self.window:
                    found.append((at + 1 - self.window, at + 1))
                    items |= self.items[self.at_window(state)]
                near = self.next_whole[state]
                while near >= 0:
                    for length, item in self.whole[near]:
                        if length <= matched:
                            found.append((at + 1 - length, at + 1))
                            items.update([item] if item is not None else [])
                    near = self.next_whole[self.link[near]]
        return found, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _dealt(benchmark: DataFrame, id_column: str, text_column: str, block_bytes: int) -> tuple[DataFrame, int]:
    """The items with their block, and the number of blocks."""
    sized = benchmark.select(F.col(id_column).alias("item_id"), F.col(text_column).alias("text")).where("text is not null").distinct()
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    return sized.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), blocks


class _Machine:
    """A block's automaton as a task built it; a worker unpacks it once, and forgets the one before."""

    def __init__(self, items: DataFrame, window: int):
        name = self.name = f"machine {uuid.uuid4().hex}"

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = [r for b in batches for r in zip(b.column("item_id").to_pylist(), byte_texts(b, "text"))]
            built = held(name, lambda: SuffixAutomaton(rows, window))
            packed = zlib.compress(pickle.dumps(built, pickle.HIGHEST_PROTOCOL), 1)
            yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary()), pa.array([True])], names=["machine", "one"])

        row = items.coalesce(1).mapInArrow(build, "machine binary, one boolean").first()
        packed = bytes(row["machine"]) if row else zlib.compress(pickle.dumps(SuffixAutomaton([], window)))
        self.sent = items.sparkSession.sparkContext.broadcast(packed)

    def __call__(self) -> SuffixAutomaton:
        return held(self.name, lambda: pickle.loads(zlib.decompress(self.sent.value)))


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int, id_column: str, text_column: str, judge,
            schema) -> DataFrame:
    """``judge`` maps a batch of documents, its words and its (merged spans, items) to a batch of ``schema``. The batches have
    the columns of ``docs``."""
    dealt, blocks = _dealt(benchmark, "item_id", "text", block_bytes)
    if blocks == 1:
        machine = _Machine(dealt.select("item_id", "text"), window)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 1000):
                words = [alnum_words(t) for t in byte_texts(batch, text_column)]
                found = [machine().spans(w) for w in words]
                yield judge(batch, words, [(merged(s), sorted(map(str, i))) for s, i in found])

        return docs.mapInArrow(run, schema)
    text_hash = F.unhex(F.md5(F.coalesce(F.col(text_column), F.lit(""))))
    key = key_of(F.col(id_column), text_hash)
    found = None
    for block in range(blocks):
        machine = _Machine(dealt.where(F.col("block") == block).select("item_id", "text"), window)
        some = stored(docs.select(key.alias("key"), text_hash.alias("hash"), F.col(text_column).alias("text"))
                      .mapInArrow(_hit_rows(machine), "key long, hash binary, spans array<array<int>>, items array<string>"), "hits")
        machine.sent.destroy()
        found = some if found is None else found.union(some)
    united = found.groupBy("key", "hash").agg(F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"),
                                              F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    joined = docs.select(row.alias("row"), key.alias("key"), text_hash.alias("hash")).join(united, ["key", "hash"], "left")
    names = docs.columns

    def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            own = pa.RecordBatch.from_arrays(batch.column("row").flatten(), names=names)
            words = [alnum_words(t) for t in byte_texts(own, text_column)]
            rows = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
            yield judge(own, words, [(merged([tuple(s) for s in spans or []]), items or []) for spans, items in rows])

    return joined.select("row", "spans", "items").mapInArrow(run_joined, schema)


def _hit_rows(machine: _Machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            found = [machine().spans(alnum_words(t)) for t in byte_texts(batch, "text")]
            some = [i for i, (spans, _) in enumerate(found) if spans]
            out = batch.select(["key", "hash"]).take(pa.array(some, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array([merged(found[i][0]) for i in some], pa.list_(pa.list_(pa.int32()))),
                 pa.array([sorted(map(str, found[i][1])) for i in some], pa.list_(pa.string()))],
                names=["key", "hash", "spans", "items"])

    return run


def _hit(spans: list[tuple[int, int]]) -> int:
    return sum(e - s for s, e in spans)


def hits(docs: DataFrame, benchmark: DataFrame, share: float = 0.05, window: int = WINDOW, id_column: str = "doc_id",
         text_column: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (hit words reach the share)."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    types = [pa.int64()] * 3 + [pa.string(), pa.bool_()]
    inverse = round(1 / share)

    def judge(batch: pa.RecordBatch, words: list, found: list) -> pa.RecordBatch:
        rows = [(len(w), _hit(spans), len(items), hashlib.sha256(",".join(items).encode()).hexdigest(),
                 0 < _hit(spans) and inverse * _hit(spans) >= len(w)) for w, (spans, items) in zip(words, found)]
        columns = list(zip(*rows)) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id")] + [pa.array(c, t) for c, t in zip(columns, types)], names=names)

    shown = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return _judged(shown, benchmark, window, block_bytes, "doc_id", "text", judge, SCHEMA)


def clean(docs: DataFrame, benchmark: DataFrame, share: float = 0.05, window: int = WINDOW, text_column: str = "text",
          id_column: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents whose hit words stay under the share of their words; all columns."""
    inverse = round(1 / share)

    def judge(batch: pa.RecordBatch, words: list, found: list) -> pa.RecordBatch:
        return batch.filter(pa.array([not (0 < _hit(spans) and inverse * _hit(spans) >= len(w))
                                      for w, (spans, _) in zip(words, found)], pa.bool_()))

    return _judged(docs, benchmark, window, block_bytes, id_column, text_column, judge, docs.schema)


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text less some merged spans of words, each with the space and signs up to the word behind it."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, last = [], 0
    for start, end in spans:
        out.append(text[last:at[start][0]])
        last = at[end][0] if end < len(at) else len(text)
    return b"".join([*out, text[last:]])


def cut(docs: DataFrame, benchmark: DataFrame, share: float = 0.05, longest: int = LONGEST, window: int = WINDOW,
        text_column: str = "text", id_column: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without the hit spans beyond a limit; all rows and columns."""
    inverse = round(1 / share)

    def judge(batch: pa.RecordBatch, words: list, found: list) -> pa.RecordBatch:
        texts = batch.column(text_column).to_pylist()
        for i, (own, (spans, _)) in enumerate(zip(words, found)):
            over = spans if inverse * _hit(spans) >= len(own) else [s for s in spans if s[1] - s[0] >= longest]
            if over:
                texts[i] = without_spans(texts[i].encode(), over).decode()
        at = batch.schema.get_field_index(text_column)
        return batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return _judged(docs, benchmark, window, block_bytes, id_column, text_column, judge, docs.schema)
