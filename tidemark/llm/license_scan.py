"""Licence scans: one Aho-Corasick automaton finds notice phrases and identifier tags; licence expressions behind a
tag are put in postfix order by the shunting-yard method and evaluated with ``and``, ``or`` and ``with``.

One pass over the texts, no shuffle: a hot source or a huge group of copies costs what its bytes cost. The automaton
holds the fixed phrases below and is built once per Python worker.

Defined results: null text counts as empty; without words n_words is 0, both positions null, labels empty, score 0;
repeated rows give repeated results; malformed expressions give the labels of the licences they name.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import alnum_words, byte_texts, slices

#: Fixed values of the contract: words that stand consecutively, and the label they give.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Further notices, all words lower-cased (fixed values).
NOTICES = {
    "gnu lesser general public license": "lgpl", "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl", "mozilla public license": "mpl", "eclipse public license": "epl",
    "bsd license": "bsd", "isc license": "isc", "boost software license": "bsl", "the unlicense": "unlicense",
    "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc0": "cc0", "cc zero": "cc0",
    "creative commons attribution": "cc-by", "creative commons zero": "cc0", "licensed under the gpl": "gpl",
    "released into the public domain": "public-domain", "all rights reserved": "reserved",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd", "www apache org licenses": "apache",
    "creativecommons org licenses by": "cc-by", "creativecommons org publicdomain zero": "cc0",
    "opensource org licenses mit": "mit", "www gnu org licenses gpl": "gpl",
}
#: Words of an identifier tag; an expression follows it.
TAG = "spdx license identifier"
#: Beginnings of licence identifiers, lower-cased, longest first wins, and their labels (fixed values).
IDENTIFIERS = {
    "agpl": "agpl", "apache": "apache", "artistic": "artistic", "bsd": "bsd", "bsl": "bsl", "cc-by": "cc-by",
    "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd", "cc-by-sa": "cc-by-sa", "cc0": "cc0", "epl": "epl", "gpl": "gpl",
    "isc": "isc", "lgpl": "lgpl", "mit": "mit", "mpl": "mpl", "unlicense": "unlicense", "zlib": "zlib",
}
#: How freely a label's terms allow reuse, 0 to 1 (fixed values); other labels count 0.5.
FREEDOM = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "mit": 0.9, "isc": 0.9, "bsd": 0.9, "bsl": 0.9, "zlib": 0.9,
    "apache": 0.9, "cc-by": 0.8, "artistic": 0.7, "mpl": 0.6, "epl": 0.6, "cc-by-sa": 0.5, "lgpl": 0.5, "gpl": 0.4,
    "cc-by-nd": 0.2, "agpl": 0.3, "cc-by-nc": 0.2, "reserved": 0.0,
}
RANK = {"or": 1, "and": 2, "with": 3}
_TAGGED = re.compile(rb"(?i)spdx[^0-9a-z\x80-\xff]+license[^0-9a-z\x80-\xff]+identifier[ \t]*:?[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:\-]+")
SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double")


def postfix(expression: str) -> list[str]:
    """The tokens of a licence expression in postfix order. Reading stops where prose begins: at two licences without an
    operator between them, or at a word that names no licence, unless it is the exception behind ``with``; brackets that do
    not match are skipped."""
    out: list[str] = []
    waiting: list[str] = []
    operand = False
    for token in _TOKEN.findall(expression):
        word = token.lower()
        if word in RANK:
            while waiting and RANK.get(waiting[-1], 0) >= RANK[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand = False
        elif token == "(":
            if operand:
                break
            waiting.append(token)
        elif token == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if waiting:
                waiting.pop()
        elif operand or (waiting[-1:] != ["with"] and identifier_label(token) is None):
            break
        else:
            out.append(token)
            operand = True
    return out + [t for t in reversed(waiting) if t != "("]


def identifier_label(identifier: str) -> str | None:
    """The label of a licence identifier, with or without a version; ``LicenseRef-…`` is its own label; others have none."""
    name = identifier.lower().rstrip(".")
    if name.startswith("licenseref-"):
        return name
    known = [k for k in IDENTIFIERS if re.match(re.escape(k) + r"($|[-+.\d]|v\d)", name)]
    return IDENTIFIERS[max(known, key=len)] if known else None


def evaluated(expression: str) -> tuple[set[str], float | None]:
    """Labels that an expression names, and its freedom: ``and`` the least, ``or`` the most, ``with`` an exception
    that leaves the licence's own value. Operators short of operands are skipped; nothing named: None."""
    stack: list[tuple[frozenset, float]] = []
    labels: set[str] = set()
    for token in postfix(expression):
        if token in RANK:
            if len(stack) < 2:
                continue
            (right, b), (left, a) = stack.pop(), stack.pop()
            if token == "with" or None in right:
                stack.append((left, a))
            else:
                stack.append((left | right, min(a, b) if token == "and" else max(a, b)))
        else:
            label = identifier_label(token)
            stack.append((frozenset([label]), FREEDOM.get(label, 0.5)))
    for names, _ in stack:
        labels |= names - {None}
    return labels, (min(v for _, v in stack) if labels else None)


@functools.cache
def _automaton():
    import ahocorasick

    machine = ahocorasick.Automaton()
    for phrase in dict.fromkeys([*BASE, *NOTICES, TAG]):
        machine.add_word(f" {phrase} ", phrase)
    machine.make_automaton()
    return machine


def scan(text: bytes) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text."""
    words = alnum_words(text)
    line = (" " + b" ".join(words).decode("latin-1") + " ") if words else ""
    starts: list[int] = []
    base: set[str] = set()
    more: set[str] = set()
    values: list[float] = []
    tagged = False
    at = before = 0  # so many spaces stand before this place: what lies between two hits is counted once
    for end, phrase in _automaton().iter(line) if words else ():
        if phrase in BASE:
            start = end - len(phrase)
            before += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
            at = start
            starts.append(before - 1)
            base.add(BASE[phrase])
        elif phrase in NOTICES:
            more.add(NOTICES[phrase])
        else:
            tagged = True
    if tagged:
        for found in _TAGGED.finditer(text):
            labels, value = evaluated(found[1].decode("utf-8", "replace"))
            more |= labels
            values += [] if value is None else [value]
    values += [FREEDOM.get(label, 0.5) for label in base | (more if not values else set())]
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | more)), min(values, default=0.0))


def scanned(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_base (places of base phrases), first_word, last_word, base_labels, labels
    (the base's, the notices' and the expressions'), score (freedom of the strictest terms stated, 0 without any)."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
        for batch in slices(batches, 1000):
            rows = [scan(text) for text in byte_texts(batch, "text")]
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array(c, t) for c, t in zip(columns, types[1:])], names=names)

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
                       ).mapInArrow(run, SCHEMA)
