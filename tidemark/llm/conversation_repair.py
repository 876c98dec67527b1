"""Repair of conversation structure by a persistent audit DP.

A conversation's rows are read in order. For each of four ends that a repaired prefix may have (nothing, a system turn, a
user turn, an assistant turn) the search keeps the cheapest edits that lead there; ties go to the ASCII-least audit, the
string of the edits' initials. Audits share their beginnings: an audit is a tail of fewer than ``LINK`` edits behind a linked
node, a node holds ``LINK`` edits, the rolling hash of all edits up to it, and its binary-lifting ancestors. Two audits are
compared by searching their longest common prefix: both are lifted to one depth, then down from the highest ancestors whose
hashes differ. Equal hashes are believed only after the nodes below them were compared.

Two audits of one cost that reach the same end of the same rows are never a prefix of one another (inserted turns cost), so
the smaller one stays the smaller whatever follows, and one audit for each end is enough.

The search reads a row's role and faults only, so texts are not shuffled for it; in a second pass each conversation's audit
comes before its rows, sorted within partitions, and is applied to them as they stream by. A conversation is held by nobody:
the first pass keeps its audits (a byte an edit, about, for each end), the second one the audit it applies.

Defined results: rows are taken by turn (nulls first), then role, then the text's md5; a null role or text counts as one space, and a
null conversation is one of its own; an empty role has no initial, cannot be kept, and breaks order; rows that repeat each
other are duplicates after the first; rows that share a turn are all taken; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions

#: Edits in a node of a linked audit.
LINK = 64
KEEP, REROLE, DELETE, INSERT = b"K", b"R", b"D", b"I"
#: Costs of the edits, and of a truncated row that stays (fixed values of the contract).
COST_REROLE, COST_DELETE, COST_INSERT, COST_TRUNCATED = 1, 2, 5, 5
FOLLOWS = ("su", "ua", "au")
_PRIME, _BASE = (1 << 61) - 1, 0x1F3D5B79A8C6E42
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_BLANKS = " \t\n\x0b\f\r"


class Node:
    """``LINK`` edits behind all those of the node above."""

    __slots__ = ("edits", "depth", "hash", "ups")

    def __init__(self, above: Node | None, edits: bytes):
        from xxhash import xxh3_64_intdigest

        self.edits = edits
        self.depth = above.depth + 1 if above else 1
        self.hash = ((above.hash if above else 1) * _BASE + xxh3_64_intdigest(edits)) % _PRIME
        self.ups = [above] if above else []
        while self.ups and len(self.ups[-1].ups) >= len(self.ups):  # the ancestor 2**k above, for each k
            self.ups.append(self.ups[-1].ups[len(self.ups) - 1])

    def lifted(self, depth: int) -> Node:
        node = self
        while node.depth > depth:
            step = (node.depth - depth).bit_length() - 1
            node = node.ups[step]
        return node


def same_edits(a: Node | None, b: Node | None) -> bool:
    """Whether two nodes of one depth hold the same edits, themselves and above."""
    while a is not b:
        if a.edits != b.edits:
            return False
        a, b = (a.ups[0], b.ups[0]) if a.ups else (None, None)
    return True


def _chunks(node: Node | None) -> list[bytes]:
    out = []
    while node:
        out.append(node.edits)
        node = node.ups[0] if node.ups else None
    return out[::-1]


def written(node: Node | None, tail: bytes) -> bytes:
    return b"".join(_chunks(node)) + tail


def less(a: tuple, b: tuple) -> bool:
    """Whether one audit (node, tail) comes before another in byte order."""
    (x, tail), (y, other) = a, b
    if x is y:
        return tail < other
    depth = min(x.depth if x else 0, y.depth if y else 0)
    low, high = (x.lifted(depth), y.lifted(depth)) if depth else (None, None)
    if low is high or (low.hash == high.hash and same_edits(low, high)):
        rest = [t if (n.depth if n else 0) == depth else n.lifted(depth + 1).edits for n, t in ((x, tail), (y, other))]
        return rest[0] < rest[1]
    if low.hash != high.hash:
        for step in range(len(low.ups) - 1, -1, -1):
            if step < len(low.ups) and low.ups[step] is not high.ups[step] and low.ups[step].hash != high.ups[step].hash:
                low, high = low.ups[step], high.ups[step]
        above = (low.ups[0], high.ups[0]) if low.ups else (None, None)
        if same_edits(*above) and low.edits != high.edits:
            return low.edits < high.edits
    return written(*a) < written(*b)  # hashes that met by chance


class Search:
    """The cheapest edits of the rows so far, for each end: (cost, node, tail) or None."""

    def __init__(self):
        self.best: list[tuple | None] = [(0, None, b""), None, None, None]
        self._inserted()

    def _offer(self, best: list, end: int, one: tuple | None, cost: int, edit: bytes) -> None:
        if one is None:
            return
        have, cost = best[end], one[0] + cost
        if have is None or cost < have[0] or (cost == have[0] and less((one[1], one[2] + edit), have[1:])):
            best[end] = (cost, one[1], one[2] + edit)

    def _inserted(self) -> None:
        """Ends reached by inserting turns; full tails become nodes."""
        best = self.best
        self._sealed()
        for end in (NOTHING, SYSTEM, ASSISTANT):
            self._offer(best, USER, best[end], COST_INSERT, INSERT)
        self._sealed()
        self._offer(best, ASSISTANT, best[USER], COST_INSERT, INSERT)
        self._sealed()

    def _sealed(self) -> None:
        for end, one in enumerate(self.best):
            if one and len(one[2]) == LINK:
                self.best[end] = (one[0], Node(one[1], one[2]), b"")

    def row(self, initial: str, delete: bool, truncated: bool) -> None:
        old, new = self.best, [None] * 4
        for end in range(4):
            self._offer(new, end, old[end], COST_DELETE, DELETE)
        if not delete:
            extra = COST_TRUNCATED if truncated else 0
            if initial == "s":
                self._offer(new, SYSTEM, old[NOTHING], extra, KEEP)
            for end, to, name in ((NOTHING, USER, "u"), (SYSTEM, USER, "u"), (ASSISTANT, USER, "u"), (USER, ASSISTANT, "a")):
                if initial == name:
                    self._offer(new, to, old[end], extra, KEEP)
                self._offer(new, to, old[end], extra + COST_REROLE, REROLE)
        self.best = new
        self._inserted()

    def result(self) -> tuple[int, bytes]:
        nothing, assistant = self.best[NOTHING], self.best[ASSISTANT]
        one = min((x for x in (nothing, assistant) if x), key=lambda x: x[0])
        if nothing and assistant and nothing[0] == assistant[0]:
            one = nothing if less(nothing[1:], assistant[1:]) else assistant
        return one[0], written(*one[1:])


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text of a table with known damage, and dropped: by crc32(conv:turn) modulo 20, 0 drops a row, 1
    empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes it the user's. Dropped rows stay, marked, so that every
    conversation remains known. Nulls count as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(conv), F.lit(":"), space(turn))) % 20
    shown = F.when(kind == 1, "").when(kind == 2, F.translate(space(text), ".!?", "")).otherwise(space(text))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                       F.when(kind == 4, "user").otherwise(space(role)).alias("role"), shown.alias("text"),
                       (kind == 0).alias("dropped"), F.explode(copies).alias("copy")).drop("copy")


def _faulty(rows: DataFrame) -> DataFrame:
    """What the search reads of a row: conv_id, turn, role, digest of the text, blank, ended, seen (role and text came at an
    earlier turn), dropped. Rows that repeat each other at one turn are told apart as they stream by."""
    body = F.rtrim("text", F.lit(_BLANKS))
    narrow = rows.select("conv_id", "turn", "role", F.unhex(F.md5("text")).alias("digest"),
                         (body == "").alias("blank"),
                         F.substring(body, -1, 1).isin(".", "!", "?").alias("ended"), "dropped")
    first = F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("first")
    met = (narrow.where("not dropped").groupBy("conv_id", "role", "digest").agg(F.count("*").alias("times"), first)
           .where("times > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"))
    seen = F.struct(F.col("turn").isNotNull().alias("some"), "turn") > F.col("first")
    on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    return narrow.join(met, on, "left").select(
        "conv_id", "turn", "role", "digest", "blank", "ended", F.coalesce(seen, F.lit(False)).alias("seen"), "dropped")


def _order(text: str) -> list[Column]:
    return [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col(text)]


def _conv_type(rows: DataFrame) -> str:
    return rows.schema["conv_id"].dataType.simpleString()


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. ``rows`` has conv_id, turn, role,
    text without nulls in the last two, and dropped (rows that only name their conversation)."""
    kind = _conv_type(rows)
    schema = f"conv_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"
    dealt = _faulty(rows).repartition(partitions(rows), "conv_id").sortWithinPartitions(*_order("digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        walk: _Walk | None = None
        names = ("conv_id", "turn", "role", "digest", "blank", "ended", "seen", "dropped")
        for batch in batches:
            for conv, *row in zip(*(batch.column(c).to_pylist() for c in names)):
                if walk is None or conv != walk.conv:
                    if walk:
                        done.append(walk.summary())
                    walk = _Walk(conv)
                    if len(done) == 1000:
                        yield _batch(done, kinds)
                        done = []
                walk.row(*row)
        yield _batch(done + ([walk.summary()] if walk else []), kinds)

    kinds = _arrow_kinds(rows, schema)
    return dealt.mapInArrow(run, schema)


def _arrow_kinds(rows: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    conv = to_arrow_type(rows.schema["conv_id"].dataType)
    rest = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.schema([(n, conv if n == "conv_id" else rest[t]) for n, t in fields])


def _batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)


class _Walk:
    """One conversation, row by row."""

    def __init__(self, conv):
        self.conv, self.search = conv, Search()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.first = self.last_turn = self.last = None
        self.turns = self.illegal = 0

    def row(self, turn, role, digest, blank, ended, seen, dropped) -> None:
        if dropped:
            return
        this = (turn, role, digest)
        seen = seen or this == self.last
        if turn is not None and turn != self.last_turn:
            self.first = turn if self.first is None else self.first
            self.last_turn, self.turns = turn, self.turns + 1
        if self.last is not None and self.last[1][:1] + role[:1] not in FOLLOWS:
            self.illegal += 1
        self.last = this
        fault = "blank" if blank else "duplicate" if seen else None if ended else "truncated"
        if fault:
            self.faults[fault] += 1
        self.search.row(role[:1], fault in ("blank", "duplicate"), fault == "truncated")

    def summary(self) -> tuple:
        cost, audit = self.search.result()
        gaps = 0 if self.first is None else self.last_turn - self.first + 1 - self.turns
        return (self.conv, gaps, *self.faults.values(), self.illegal, cost, audit.decode())


def _applied(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Conversations one after the other: a row with place -1, the counts and the audit, then the repaired turns."""
    kind = _conv_type(rows)
    counts = [F.lit(None).cast("long").alias(c) for c in COUNTS]
    heads = found.select("conv_id", F.lit(True).alias("head"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                         F.col("audit").alias("text"), F.lit("").cast("binary").alias("digest"), *COUNTS)
    texts = rows.where("not dropped").select("conv_id", F.lit(False).alias("head"), "turn", "role", "text",
                                             F.unhex(F.md5("text")).alias("digest"), *counts)
    order = [F.col("conv_id"), F.col("head").desc(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    dealt = heads.union(texts).repartition(partitions(rows), "conv_id").sortWithinPartitions(*order)
    schema = f"conv_id {kind}, place long, edit string, role string, text string, " + ", ".join(f"{c} long" for c in COUNTS)
    kinds = _arrow_kinds(rows, schema)

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        none = (None,) * len(COUNTS)
        conv, audit, at, place, expected = None, "", 0, 0, "user"

        def inserted() -> Iterator[tuple]:
            nonlocal at, place, expected
            while at < len(audit) and audit[at] == "I":
                yield conv, place, "I", expected, "", *none
                at, place, expected = at + 1, place + 1, "assistant" if expected == "user" else "user"

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "head", "role", "text", *COUNTS)]
            for name, head, role, text, *numbers in zip(*columns):
                if head:
                    yield from inserted()
                    conv, audit, at, place, expected = name, text, 0, 0, "user"
                    yield name, -1, None, None, audit, *numbers
                    continue
                yield from inserted()
                edit, at = audit[at], at + 1
                if edit == "D":
                    continue
                if edit == "R":
                    role = expected
                if role[:1] != "s":
                    expected = "assistant" if role[:1] == "u" else "user"
                yield name, place, edit, role, text, *none
                place += 1
        yield from inserted()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for one in turns(batches):
            held.append(one)
            size += len(one[4] or "")
            if len(held) == 5000 or size > 4_000_000:
                yield _batch(held, kinds)
                held, size = [], 0
        yield _batch(held, kinds)

    return dealt.mapInArrow(run, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """The turns of every conversation after its cheapest edits: conv_id, place (from 0), edit (K, R or I), role, text."""
    return _applied(rows, audits(rows)).where("place >= 0").select("conv_id", "place", "edit", "role", "text")


def digests(rows: DataFrame) -> DataFrame:
    """The rows of ``audits`` with repaired_sha256, the hash of the repaired turns as ``role:text``, joined by newlines. The
    repaired turns are hashed where they come out, in order: no further shuffle."""
    schema = f"conv_id {_conv_type(rows)}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    kinds = _arrow_kinds(rows, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, digest, done = None, hashlib.sha256(), []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text", *COUNTS)]
            for conv, place, role, text, *numbers in zip(*columns):
                if place < 0:
                    if head:
                        done.append((*head, digest.hexdigest()))
                    head, digest = (conv, *numbers, text), hashlib.sha256()
                else:
                    digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            yield _batch(done, kinds)
            done = []
        yield _batch([(*head, digest.hexdigest())] if head else [], kinds)

    return _applied(rows, audits(rows)).mapInArrow(run, schema)
