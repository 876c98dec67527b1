"""Quality rules by tokeniser fertility: how public vocabularies cut a text's words tells prose from junk.

Measured over the words of a text (characters other than ASCII white space): characters per token under two
vocabularies, the share of tokens that fall back to single bytes, and the entropy of the tokens in bits over that of as
many different ones, or 7 bits for long texts. Each language has bands; a text outside one of them is rejected. One pass
over texts; with labels the bands come from the clean documents among all rows, by an aggregate of the measures, shrunk
towards the bands without labels by the number of labelled documents.

Defined results: null text counts as empty and has no words, so it fails the base rule; unknown, null or odd languages
use the band of ``None``; repeated rows are judged alike; the text's own columns are read and no others, and further
columns may have any name; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import byte_texts, held, slices, stored

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
PIECES, BYTES = "piece_bpe_32k.model", "byte_bpe_50k.json"
#: What a text in any of the four languages may give that no labelled documents speak for: ordinary prose has some four
#: characters a token in English, less in other languages and in rare words.
PROSE = {"chars_per_piece": (3.0, 3.6, 1.6), "chars_per_byte_token": (3.0, 3.6, 1.6), "fallback": (0, 0.05)}
#: Bands per language: a centre, the slack of a one-word text, which narrows with the root of the word count, and the least
#: slack, the spread between documents; or, for what no centre is known, the lowest and highest value. ``None`` holds for
#: every other language. Centre and slacks are taken from labelled documents where there are any (``fitted``).
BANDS: dict[str | None, dict[str, tuple[float, ...]]] = {
    "en": PROSE | {"entropy": (0.79, 1)},
    "de": PROSE | {"entropy": (0.80, 1)},
    "fr": PROSE | {"entropy": (0.78, 1)},
    "es": PROSE | {"entropy": (0.79, 1)},
    None: {"fallback": (0, 0.9), "entropy": (0.4, 1)},
}
#: What shrinks the edges of labels towards: the bands above, or for another language one so wide that it holds any text.
ANY = {"chars_per_piece": (3.0, 3.6, 30.0), "chars_per_byte_token": (3.0, 3.6, 30.0)}
#: Labelled documents that weigh as much as the bands without labels; the share of them that fitted edges hold; and the
#: room beyond, in parts of the way from the median to the edge.
WEIGHT, WITHIN, ROOM = 30, 0.99, 0.5
MEASURES = ("chars_per_piece", "chars_per_byte_token", "fallback", "entropy")
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, chars_per_piece double, chars_per_byte_token double, fallback double, "
          "entropy double")
#: Words whose pieces a worker remembers.
CACHE = 350_000
#: Bits of token entropy that prose of any length is held against: as many as a language's common pieces give.
MOST_BITS = 7.0


def _marked(word: bytes) -> bool:
    """Whether a final comma or full stop stands behind a letter or digit; it is then a token of its own."""
    return len(word) > 2 and word[-1] in b".," and word[-2:-1].isalnum()


class _Pieces(dict):
    """Word -> piece ids as 16-bit bytes."""

    def __init__(self):
        import public_tokenizers
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))
        size = self.model.get_piece_size()
        self.is_byte = np.fromiter((self.model.is_byte(i) for i in range(size)), bool, size)

    def __missing__(self, word: bytes) -> bytes:
        if _marked(word):
            mark = np.asarray([self.model.piece_to_id(word[-1:].decode())], "<u2").tobytes()
            ids = self[word[:-1]] + mark
        else:
            ids = np.asarray(self.model.encode(word.decode("utf-8", "replace")), "<u2").tobytes()
        if len(self) < CACHE:
            self[word] = ids
        return ids


class _Counts(dict):
    """Word -> number of byte-level tokens, as behind a space."""

    def __init__(self):
        import public_tokenizers
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.letters = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(BYTES))
        self.tokenizer.encode_special_tokens = True

    def __missing__(self, word: bytes) -> int:
        text = word.decode("utf-8", "replace")
        if _marked(word):
            n = self[word[:-1]] + 1
        elif text.isalpha():  # one piece of letters: no need for the whole tokenizer
            n = len(self.tokenizer.model.tokenize(self.letters(" " + text)[0][0]))
        else:
            n = len(self.tokenizer.encode(" " + text, add_special_tokens=False).ids)
        if len(self) < CACHE:
            self[word] = n
        return n


def _vocabularies() -> tuple[_Pieces, _Counts]:
    return held("pieces and counts", lambda: (_Pieces(), _Counts()))


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that are found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    twice = np.fromiter((times[w] > 1 for w in windows), np.int8, len(windows))
    covered = np.zeros(len(words), np.int8)
    for shift in range(3):
        covered[shift:shift + len(windows)] |= twice
    return int(covered.sum())


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = [line for line in text.split(b"\n") if line.strip()] if b"\n" in text else []
    return (len(words), len(b"".join(words).decode("utf-8", "replace")),
            len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words))


def fertility(words: list[bytes], chars: int) -> tuple[float, float, float, float]:
    """The measures of a text's words; a text without words has zeros and entropy ratio 1."""
    pieces, counts = _vocabularies()
    ids = np.frombuffer(b"".join(map(pieces.__getitem__, words)), "<u2")
    if not len(ids):
        return 0.0, 0.0, 0.0, 1.0
    n = np.unique(ids, return_counts=True)[1]
    entropy = float(np.log2(len(ids)) - (n * np.log2(n)).sum() / len(ids))
    most = min(np.log2(len(ids)), MOST_BITS)
    return (chars / len(ids), chars / sum(map(counts.__getitem__, words)), float(pieces.is_byte[ids].mean()),
            float(min(1.0, entropy / most)) if most else 1.0)


def inside(measures: tuple[float, ...], n_words: int, band: Mapping[str, tuple[float, ...]]) -> bool:
    """Whether all measures lie in the language's bands."""
    for name, value in zip(MEASURES, measures):
        if name in band:
            low, high, *least = band[name]
            if name.startswith("chars"):
                slack = max(high / max(1, n_words) ** 0.5, *least, 0)
                low, high = low - slack, low + slack
            if not low <= value <= high:
                return False
    return True


def fitted(measured: DataFrame, labels: DataFrame, bands: Mapping[str | None, Mapping[str, tuple[float, ...]]] = BANDS,
           id_column: str = "doc_id", label_column: str = "quality") -> dict[str | None, dict[str, tuple[float, ...]]]:
    """``bands`` drawn to each language's labelled clean documents: median and slacks of characters per token, and where
    they go further than the given ones, the most fallback and the least entropy. An edge is the mean of the given one, with ``WEIGHT``, and of the documents' own, with their
    number. ``measured`` has doc_id, lang, n_words, base_failed and the measures; one row per language returns."""
    clean = labels.where(F.col(label_column) == 1).select(F.col(id_column).cast("long").alias("doc_id")).distinct()
    rows = measured.where("not base_failed and lang is not null").join(clean, "doc_id")
    chars = [m for m in MEASURES if m.startswith("chars")]
    centres = rows.groupBy("lang").agg(F.count("*").alias("n"), *[F.percentile_approx(m, 0.5).alias(f"{m}_mid") for m in MEASURES])
    off = {m: F.abs(F.col(m) - F.col(f"{m}_mid")) for m in MEASURES}
    edges = rows.join(centres, "lang").groupBy("lang").agg(
        F.first("n").alias("n"), *[F.first(f"{m}_mid").alias(f"{m}_mid") for m in MEASURES],
        *[F.percentile_approx(off[m] * F.sqrt("n_words"), WITHIN).alias(f"{m}_word") for m in chars],
        *[F.percentile_approx(off[m], WITHIN).alias(f"{m}_off") for m in MEASURES])

    def drawn(r) -> dict[str, tuple[float, ...]]:
        given = (dict(bands[None]) | ANY) if r["lang"] not in bands else dict(bands[r["lang"]])
        own = {m: (r[f"{m}_mid"], (1 + ROOM) * r[f"{m}_word"], (1 + ROOM) * r[f"{m}_off"]) for m in chars}
        own["fallback"] = (0, max(given["fallback"][1], r["fallback_mid"] + (1 + ROOM) * r["fallback_off"]))
        own["entropy"] = (min(given["entropy"][0], r["entropy_mid"] - (1 + ROOM) * r["entropy_off"]), 1)
        share = r["n"] / (r["n"] + WEIGHT)
        return {m: tuple(share * x + (1 - share) * y for x, y in zip(own[m], given[m])) for m in given}

    return dict(bands) | {r["lang"]: drawn(r) for r in edges.collect()}


def _fits(bands: Mapping[str | None, Mapping[str, tuple[float, ...]]]) -> Column:
    """``inside`` as a column of measured rows."""
    def of(band: Mapping[str, tuple[float, ...]]) -> Column:
        out = F.lit(True)
        for name in MEASURES:
            if name in band:
                low, high, *least = band[name]
                if name.startswith("chars"):
                    slack = F.greatest(F.lit(float(high)) / F.sqrt(F.greatest("n_words", F.lit(1))), F.lit(float(max([0, *least]))))
                    out &= F.col(name).between(F.lit(float(low)) - slack, F.lit(float(low)) + slack)
                else:
                    out &= F.col(name).between(float(low), float(high))
        return out

    known = [lang for lang in bands if lang is not None]
    return functools.reduce(lambda rest, lang: F.when(F.col("lang") == lang, of(bands[lang])).otherwise(rest), known, of(bands[None]))


def _measured(docs: DataFrame, id_column: str, text_column: str, lang_column: str | None, along: bool = False) -> DataFrame:
    """Stored: the rows of ``judged`` with lang, and with ``along`` the whole row as the struct ``row``. Each text is measured
    once and none is shuffled."""
    lang = F.col(lang_column).cast("string") if lang_column else F.lit(None).cast("string")
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row")
    text = [] if along else [F.col(text_column).alias("text")]  # a whole row has its text already
    inner = docs.select(F.col(id_column).cast("long").alias("doc_id"), *text, lang.alias("lang"), *[row] * along)
    schema = T.StructType.fromDDL(f"{SCHEMA}, lang string")
    if along:
        schema.add(inner.schema["row"])
    rows = _rows(BANDS, ("lang", "row"), [c.lower() for c in docs.columns].index(text_column.lower())) if along else _rows(BANDS, ("lang",))
    return stored(inner.mapInArrow(rows, schema), "measured")


def _rows(bands: Mapping, along: tuple[str, ...] = (), place: int | None = None):
    """The function from batches of doc_id, text, lang to judged rows, with other columns as they are. ``place`` says which field
    of the struct ``row`` is the text, where there is no such column."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    types = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()] * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            own = batch if place is None else pa.RecordBatch.from_arrays([batch.column("row").field(place)], ["text"])
            rows = [verdict(t, lang, bands) for t, lang in zip(byte_texts(own, "text"), batch.column("lang").to_pylist())]
            columns = list(zip(*rows)) if rows else [[]] * 11
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array(c, t) for c, t in zip(columns, types[1:])]
                + [batch.column(c) for c in along], names=[*names, *along])

    return run


def judged(docs: DataFrame, bands: Mapping[str | None, Mapping[str, tuple[float, ...]]] = BANDS,
           id_column: str = "doc_id", text_column: str = "text", lang_column: str | None = "lang",
           labels: DataFrame | None = None) -> DataFrame:
    """Per document: the base counts, base_failed, kept and the measures. With ``labels`` the bands are fitted to the
    documents labelled clean."""
    if labels is not None:
        rows = _measured(docs, id_column, text_column, lang_column)
        fits = ~F.col("base_failed") & _fits(fitted(rows, labels, bands))
        return rows.withColumn("kept", fits).select([f.split()[0] for f in SCHEMA.split(", ")])
    lang = F.col(lang_column).cast("string") if lang_column else F.lit(None).cast("string")
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"),
                       lang.alias("lang")).mapInArrow(_rows(bands), SCHEMA)


def verdict(text: bytes, lang: str | None, bands: Mapping = BANDS) -> tuple:
    words = text.split()
    counts = base_counts(text, words)
    failed = counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED_PERCENT * counts[0]
    measures = fertility(words, counts[1])
    good = not failed and inside(measures, counts[0], bands.get(lang, bands[None]))
    return (*counts, failed, good, *measures)


def kept(docs: DataFrame, bands: Mapping[str | None, Mapping[str, tuple[float, ...]]] = BANDS,
         text_column: str = "text", lang_column: str = "lang", labels: DataFrame | None = None,
         id_column: str = "doc_id") -> DataFrame:
    """The rows that the rules keep, with all their columns. With ``labels`` the rows are stored with their measures, the
    bands are fitted to these, and the rows read again."""
    if labels is not None:
        rows = _measured(docs, id_column, text_column, lang_column, along=True)
        good = rows.where(~F.col("base_failed") & _fits(fitted(rows, labels, bands)))
        return good.select([F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            keep = [verdict(t, lang, bands)[6] for t, lang in zip(byte_texts(batch, text_column),
                                                                  batch.column(lang_column).to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
