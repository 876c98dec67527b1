"""SimHash classes and suffix-array deduplication against brute force over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from tidemark.llm import simhash, suffix_dedup
from tidemark.llm.components import components


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    values = [xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def slow_classes(codes, bits=4):
    codes = np.array(codes, np.uint64)
    near = np.bitwise_count(codes[:, None] ^ codes[None]) <= bits
    label = np.arange(len(codes))
    while True:
        new = np.where(near, label[None], len(codes)).min(1)
        if (new == label).all():
            return label
        label = new


def test_classes_match_brute_force(docs, rows):
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.classes(docs).collect())
    rows = sorted(rows, key=lambda r: r[0])
    codes = [slow_fingerprint(t) for _, t in rows]
    label = slow_classes(codes)
    assert got == Counter((d, f"{c:016x}", rows[k][0]) for (d, _), c, k in zip(rows, codes, label))


@pytest.mark.parametrize("cell", [16, 4096])
def test_links_of_dense_cells(spark, cell):
    rng = np.random.default_rng(5)
    codes = np.repeat(rng.integers(0, 1 << 63, 6, dtype=np.uint64), 60)
    for _ in range(5):
        codes = codes ^ (np.uint64(1) << rng.integers(0, 20, len(codes)).astype(np.uint64))
    codes = np.unique(codes)
    nodes = spark.createDataFrame([(int(c), i) for i, c in enumerate(codes.astype(np.int64))], "fp long, node long")
    roots = dict(map(tuple, components(simhash.links(nodes, cell=cell)).collect()))
    assert [roots.get(i, i) for i in range(len(codes))] == slow_classes(codes).tolist()


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (None, 3), (60, 59), (60, 59)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[200 + i] == 100 for i in range(50)) and got[60] == 59
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_repeats(rows, length=200):
    texts = [(t or "").encode() for _, t in rows]
    times = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if times[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and not before for g, before in zip(gone, b"\0" + gone))
        out.append((doc, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def planted(rng, n=60):
    """Texts over few letters with shared passages, near copies and runs."""
    word = lambda: "".join(rng.choices("abé ", k=rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(20, 120))) for _ in range(5)]
    out = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(word() for _ in range(40)) for _ in range(4)]
        out.append((i, " ".join(parts)))
    return out + [(n, out[3][1]), (n + 1, out[3][1][:300] + "!" + out[3][1][300:]), (n + 2, "ab" * 500), (n + 3, "ba" * 90)]


@pytest.mark.parametrize("hot", [2048, 0])
def test_repeats_match_brute_force(spark, docs, rows, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    if hot:
        assert Counter(map(tuple, suffix_dedup.digests(docs).collect())) == slow_repeats(rows)
    data = planted(random.Random(4))
    frame = spark.createDataFrame(data, "doc_id long, text string")
    assert Counter(map(tuple, suffix_dedup.digests(frame).collect())) == slow_repeats(data)


def slow_first(rows, length=200):
    """Texts by id without windows that begin elsewhere before, overlaps within a text apart."""
    first, out = {}, {}
    for doc, text in sorted(rows):
        t = text.encode()
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            d, at = first.setdefault(t[i:i + length], (doc, i))
            if d != doc or i >= at + length:
                gone[i:i + length] = b"\1" * length
        runs = suffix_dedup._whole_characters(t, [(a, b) for a, b in _runs(gone)])
        out[doc] = suffix_dedup._kept(t, runs).decode()
    return {d: t for d, t in out.items() if t.strip()}


def _runs(gone):
    edges = np.flatnonzero(np.diff(np.frombuffer(b"\0" + bytes(gone) + b"\0", np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


@pytest.mark.parametrize("hot", [2048, 0])
def test_first_occurrences_stay(spark, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    data = planted(random.Random(9))
    frame = spark.createDataFrame([(d, d, "x", t) for d, t in data], "tag long, doc_id long, parts string, text string")
    got = suffix_dedup.deduplicated(frame)
    assert got.columns == frame.columns
    assert {r.doc_id: r.text for r in got.collect()} == slow_first(data)


def test_deduplicated_keeps_odd_rows(docs, empty):
    got = suffix_dedup.deduplicated(docs)
    assert got.columns == docs.columns
    texts = defaultdict(list)
    for r in got.collect():
        texts[r.doc_id].append(r.text)
    assert texts[900001] == [None] and texts[900002] == [""] and texts[900004] == ["one"] and 900007 not in texts
    assert suffix_dedup.deduplicated(empty).count() == 0 and suffix_dedup.digests(empty).count() == 0


def test_one_document_of_each_class_stays(docs, rows, empty):
    label = slow_classes([slow_fingerprint(t) for _, t in sorted(rows, key=lambda r: (r[0], r[1] or ""))])
    ordered = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    first = {}
    for (doc, text), k in zip(ordered, label):
        first.setdefault(k, doc)
    left = simhash.deduplicated(docs)
    assert left.columns == docs.columns and Counter(r.doc_id for r in left.collect()) == Counter(first.values())
    assert simhash.deduplicated(empty).count() == 0 and simhash.classes(empty).count() == 0


P, Q = (" ".join(f"{c}{i}" for i in range(80)) for c in "pq")
UNNAMED = [(None, P), (None, P), (1, P), (2, Q), (2, Q), (2, "another text"), (None, None), (3, ""), (None, Q + " z"),
           (None, "alone here"), (None, "p " * 300)]


def test_rows_without_id(spark):
    """Null and repeated ids, beside columns whose names the operators use themselves."""
    frame = spark.createDataFrame([(i, t, "x", "y", 0, None) for i, t in UNNAMED],
                                  "doc_id long, text string, key string, row string, tag int, root long")
    got = Counter((r.doc_id, r.component_id) for r in simhash.classes(frame).collect())
    assert got[None, 1] == 2 and got[1, 1] == 1 and got[None, 3] == 1 and got[3, 3] == 1
    assert got[2, 2] == 3 and got[None, 2] == 1 and got[None, None] == 2
    left = simhash.deduplicated(frame)
    assert left.columns == frame.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(
        [(1, P), (2, Q), (2, "another text"), (3, ""), (None, "alone here"), (None, "p " * 300)])
    assert Counter(map(tuple, suffix_dedup.digests(frame).collect())) == slow_repeats(UNNAMED)
    cut = suffix_dedup.deduplicated(frame)
    assert cut.columns == frame.columns
    assert Counter((r.doc_id, r.text) for r in cut.collect() if len(r.text or "") > 60) == Counter(
        [(1, P), (2, Q), (2, Q), (None, "p " * 100)])


def test_previous_factors_match_their_definition():
    rng = random.Random(3)
    for length in (3, 8, 20, 37):
        for n in (1, 5, 60, 250):
            data = "".join(rng.choices("aab", k=n)).encode() + b"abc" * 20  # every position asked for has a whole window
            at = np.array(sorted(rng.sample(range(len(data) - length + 1), (len(data) - length + 1) * 2 // 3)))
            got, source = suffix_dedup.previous_factors(suffix_dedup.Suffixes(np.frombuffer(data, np.uint8), length), at)
            def common(i, j):
                return next((k for k in range(length) if data[i + k] != data[j + k]), length)
            for k, i in enumerate(at.tolist()):
                want = max((common(i, j) for j in at[:k].tolist()), default=0)
                assert got[k] == want and (want == 0 or (source[k] < k and common(i, int(at[source[k]])) == want))


@pytest.mark.parametrize("length", [40, 200, 400, 500])
def test_other_lengths(spark, length):
    data = planted(random.Random(length), 25)
    data += [(900, "x" + data[2][1] * 3), (901, data[2][1] * 3 + "y"), (902, data[2][1] * 3)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    assert Counter(map(tuple, suffix_dedup.digests(frame, length).collect())) == slow_repeats(data, length)


def test_texts_of_one_id_that_begin_alike(spark):
    """Each row is a document of its own, whatever its id; the copy of a beginning goes once."""
    start = " ".join(f"w{i}" for i in range(130))
    texts = [start + " first end", start + " another end"]
    for ids in ((7, 7), (7, 8)):
        frame = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
        left = sorted(len(r.text) for r in suffix_dedup.deduplicated(frame).collect())
        assert max(left) >= len(start) + 10 and min(left) < 30
        assert Counter(map(tuple, suffix_dedup.digests(frame).collect())) == slow_repeats(list(zip(ids, texts)))
    many = spark.createDataFrame([(5, start)] * 300 + [(6, start + " tail")], "doc_id long, text string")
    assert {(r.doc_id, r.n_spans) for r in suffix_dedup.digests(many).collect()} == {(5, 1), (6, 1)}
