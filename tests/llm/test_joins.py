"""Hard negatives, conversation repair and the Jaccard join against brute force."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.llm import conversation_repair, hard_negatives, jaccard_join, queries

# ---- hard negatives


def slow_negatives(rows, positives=5, negatives=10):
    part = {}
    for i, vector, label in sorted((r for r in rows if None not in r), key=lambda r: (r[0], r[2], r[1])):
        if all(x is not None and np.isfinite(x) for x in vector):
            part.setdefault(i, ((label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * x)) for x in vector]))
    out = Counter()
    for anchor, (label, vector) in part.items():
        if anchor % 100:
            continue
        order = sorted((-sum(a * b for a, b in zip(vector, v)), i, k) for i, (k, v) in part.items() if i != anchor)
        for p_score, positive, _ in [o for o in order if o[2] == label][:positives]:
            inside = [o for o in order if o[2] != label and 30 * -p_score <= 100 * -o[0] <= 90 * -p_score][:negatives]
            for rank, (score, other, _) in enumerate(inside, 1):
                out[anchor, positive, rank, other, -p_score, -score] += 1
    return out


def odd_vectors():
    rng = random.Random(3)
    rows = [(i, [rng.choice((-1.0, -0.25, 0.0, 0.25, 0.5, 1.0)) for _ in range(4)], rng.randrange(3)) for i in range(260)]
    rows += [(i, [0.5, 0.5, 0.25, 0.0], 1) for i in range(300, 340)]  # ties
    rows += [(400, [0.0] * 4, 1), (500, [-1.0] * 4, 2), (600, None, 1), (700, [1.0, None, 0.0, 0.0], 1), (800, [1.0], None)]
    rows += [(900, [float("nan")] * 4, 1), (901, [float("inf")] * 4, 1), (None, [1.0] * 4, 1), (1000, [], 0), (1001, [0.5, 0.5], 0)]
    rows += [(1100, [0.5, 0.5, 0.5, 0.0], 7), (200, [0.25] * 4, 2), (200, [0.25] * 4, 2), (-100, [0.5, -0.25, 0.0, 1.0], 0)]
    return rows


@pytest.mark.parametrize("block_rows", [32768, 2])
def test_hard_negatives_match_brute_force(spark, block_rows):
    rows = odd_vectors()
    frame = spark.createDataFrame([(*r, "x", 1, True) for r in rows],
                                  "vec_id long, embedding array<double>, label int, key string, id long, positive boolean")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    part = hard_negatives.taking_part(frame.repartition(5), label=label)
    got = hard_negatives.mined(part, F.col("id") % 100 == 0, block_rows=block_rows)
    assert Counter(map(tuple, got.collect())) == slow_negatives(rows)
    if block_rows > 2:
        one = hard_negatives.mined(part, F.col("id") % 100 == 0, positives=1, negatives=3)
        assert Counter(map(tuple, one.collect())) == slow_negatives(rows, 1, 3)
        assert hard_negatives.mined(hard_negatives.taking_part(frame.limit(0)), F.col("id") % 100 == 0).count() == 0
        with pytest.raises(ValueError):
            hard_negatives.mined(part, F.col("id") == 0, high=100)


def test_hard_negatives_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert Counter(map(tuple, queries.op11_hard_negatives(spark, SMALL).collect())) == slow_negatives(rows)


def test_keys_order_like_their_parts():
    rng = np.random.default_rng(1)
    anchor, score, row = (rng.integers(-5, 5, 500) * 10 ** rng.integers(0, 17, 500) for _ in range(3))
    keys = [k.tobytes() for k in hard_negatives.packed(anchor, score, row)]
    listed = list(zip(anchor.tolist(), score.tolist(), row.tolist()))
    import pyarrow as pa
    assert list(zip(*hard_negatives.unpacked(pa.array(keys, pa.binary())))) == listed
    by_key = sorted(range(500), key=keys.__getitem__)
    assert [listed[i] for i in by_key] == sorted(listed, key=lambda t: (t[0], -t[1], t[2]))


def test_products_are_exact():
    big = np.array([[2.0 ** 29 + 1, -3.0]])
    assert hard_negatives.products(big, big).tolist() == [[(2 ** 29 + 1) ** 2 + 9]]
    with pytest.raises(ValueError):
        hard_negatives.products(big * 8, big * 8)


# ---- conversations


ROLE = {"u": "user", "a": "assistant"}


def options(end, initial, gone, cut):
    """(edit, cost, next end) of one row."""
    yield "D", 2, end
    if not gone:
        follow = {"": "u", "s": "u", "a": "u", "u": "a"}[end]
        if initial == follow or (initial == "s" and end == ""):
            yield "K", 5 * cut, initial
        yield "R", 1 + 5 * cut, follow


def every_audit(rows, end="", most=2):
    """All audits of rows with at most so many inserted turns in a row: (cost, audit) that end well."""
    if most:
        follow = {"": "u", "s": "u", "a": "u", "u": "a"}[end]
        for cost, audit in every_audit(rows, follow, most - 1):
            yield cost + 5, "I" + audit
    if not rows:
        if end in ("", "a"):
            yield 0, ""
        return
    for edit, cost, to in options(end, *rows[0]):
        for more, audit in every_audit(rows[1:], to):
            yield cost + more, edit + audit


def plain_audit(rows):
    best = {"": (0, "")}
    for step in (None, *rows):
        if step is not None:
            new = {}
            for end, (cost, audit) in best.items():
                for edit, more, to in options(end, *step):
                    new[to] = min(new.get(to, (1 << 60, "")), (cost + more, audit + edit))
            best = new
        for end in ("", "s", "a", "u"):
            if end in best:
                to = "a" if end == "u" else "u"
                best[to] = min(best.get(to, (1 << 60, "")), (best[end][0] + 5, best[end][1] + "I"))
    return min(best[e] for e in ("", "a") if e in best)


def random_rows(rng, n):
    return [(rng.choice("suuaat "), rng.random() < 0.2, rng.random() < 0.15) for _ in range(n)]


def searched(rows):
    search = conversation_repair.Search()
    for initial, gone, cut in rows:
        search.row(initial, gone, cut and not gone)
    cost, audit = search.result()
    return cost, audit.decode()


def test_audits_of_few_rows_are_the_least_of_all():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4):
        for _ in range(25):
            rows = [(i, g, c and not g) for i, g, c in random_rows(rng, n)]
            assert searched(rows) == min(every_audit(rows)) == plain_audit(rows)


@pytest.mark.parametrize("link", [1, 2, 5, 64])
def test_long_audits(link, monkeypatch):
    monkeypatch.setattr(conversation_repair, "LINK", link)
    rng = random.Random(link)
    for n in (30, 300, 900):
        rows = [(i, g, c and not g) for i, g, c in random_rows(rng, n)]
        assert searched(rows) == plain_audit(rows)
    for rows in ([("u", True, False)] * 400, [("u", False, False)] * 401, [("t", False, True), ("a", False, False)] * 150):
        assert searched(rows) == plain_audit(rows)


def test_audits_whose_hashes_meet(monkeypatch):
    monkeypatch.setattr(conversation_repair, "LINK", 2)
    monkeypatch.setattr(conversation_repair, "_BASE", 0)
    monkeypatch.setattr("xxhash.xxh3_64_intdigest", lambda edits: 7)
    rows = [(i, g, c and not g) for i, g, c in random_rows(random.Random(5), 120)]
    assert searched(rows) == plain_audit(rows)


def slow_repair(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        convs[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = Counter()
    for conv, turns in convs.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
        seen, faults, steps = set(), Counter(), []
        for _, role, text in turns:
            body = text.strip(" \t\n\x0b\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults[fault] += 1
            steps.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit = plain_audit(steps)
        fixed, at, expected = [], 0, "u"
        for edit in audit:
            _, role, text = (None, None, "") if edit == "I" else turns[at]
            at += edit != "I"
            if edit == "D":
                continue
            role = role if edit == "K" else ROLE[expected]
            expected = "a" if role[0] == "u" else "u"
            fixed.append(f"{role}:{text}")
        known = [t for t, *_ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(steps))
        out[conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(fixed).encode()).hexdigest()] += 1
    return out


def odd_turns():
    rng = random.Random(8)
    texts = ["Yes.", "Yes.", "no", "", " \n", None, "What?", "é!\t", "a\x85", "long " * 3000 + "."]
    roles = ["user", "assistant", "system", "user", "tool", None, "", "User"]
    rows = [(conv, rng.choice([*range(12), None]), rng.choice(roles), rng.choice(texts)) for conv in range(150) for _ in range(conv % 9)]
    rows += [(500, t, rng.choice(("user", "assistant")), f"Turn {rng.randrange(90)}{rng.choice('.!? x')}") for t in range(700)]
    rows += [(None, 1, "user", "Hello."), (None, 2, "assistant", "Hi."), (None, None, None, None), (-7, -3, "user", "a."), (-7, 4, "user", "b.")]
    return rows + [r for r in rows if r[0] == 17]


def test_repairs_match_brute_force(spark):
    rows = odd_turns()
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                  "conv_id long, turn long, role string, text string, digest string, place long").repartition(4)
    found = conversation_repair.damaged(frame)
    assert Counter(map(tuple, conversation_repair.digests(found).collect())) == slow_repair(rows)
    turns = conversation_repair.repaired(found).where("conv_id = 500").orderBy("place").collect()
    assert [t.place for t in turns] == list(range(len(turns)))
    assert [t.role for t in turns] == ["user", "assistant"] * (len(turns) // 2) and {t.edit for t in turns} <= set("KRI")
    assert conversation_repair.digests(conversation_repair.damaged(frame.limit(0))).count() == 0


def test_repairs_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert Counter(map(tuple, queries.op12_conversation_repair(spark, SMALL).collect())) == slow_repair(rows)


# ---- Jaccard join


def shingle_set(text, width=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def slow_join(rows):
    sets = [shingle_set(t) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    linked = [set() for _ in rows]
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x] if j > i)
        for j, both in shared.items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                linked[i].add(j)
                linked[j].add(i)
    label = list(range(len(rows)))
    for i in range(len(rows)):
        queue = [i] if label[i] == i else []
        while queue:
            for j in linked[queue.pop()]:
                if label[j] != i and label[j] == j and j != i:
                    label[j] = i
                    queue.append(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[label[i]] = min(doc, least.get(label[i], doc))
    return Counter((doc, len(s), least.get(label[i]), len(linked[i])) for i, ((doc, _), s) in enumerate(zip(rows, sets)))


def edited_copies(rng):
    """Texts with copies of every kind of edit near the limit, and a dense group."""
    words = [f"w{i}" for i in range(4000)]
    out = []
    for _ in range(60):
        base = rng.choices(words, k=rng.randint(4, 300))
        some = rng.choices(words, k=rng.randint(1, 2 + len(base) // 4))
        at = rng.randrange(len(base))
        spread = list(base)
        for i in rng.sample(range(len(base)), len(base) // rng.choice((25, 50))):
            spread[i] = rng.choice(words)
        out += [base, base + some, some + base, base[:len(base) * rng.choice((80, 82, 85)) // 100], spread,
                base[:at] + some[:max(1, len(some) // 3)] + base[at:], list(base)]
    group = rng.choices(words, k=120)
    for _ in range(260):
        copy = list(group)
        for i in rng.sample(range(120), rng.choice((1, 1, 2, 3))):
            copy[i] = rng.choice(words)
        out.append(copy)
    common = rng.choices(words, k=40)
    out += [rng.choices(words, k=rng.choice((5, 9, 30))) + common + rng.choices(words, k=rng.choice((0, 4, 12))) for _ in range(150)]
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("cell, chunk", [(4096, 1 << 20), (7, 300)])
def test_jaccard_join_matches_brute_force(spark, cell, chunk):
    rows = list(enumerate(edited_copies(random.Random(6))))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = Counter(map(tuple, jaccard_join.joined(frame, cell=cell, chunk=chunk).collect()))
    assert got == slow_join(rows)


ODD = [(None, "a b c d e f g h"), (None, "a b c d e f g h"), (3, "A b c d e f  g h"), (4, "a b"), (5, "A B"), (5, "x y z"), (6, "x y z"),
       (7, None), (8, ""), (9, " \t\n"), (None, ""), (None, "all alone in this one place"), (4, "a b"), (10, "a b c d e f g h i"),
       (11, "p " * 500), (12, "p p p p p"), (13, "é É"), (14, "é É")]


def test_jaccard_join_of_odd_rows(spark, docs, rows, empty):
    frame = spark.createDataFrame([(*r, 1, "n", 2, None) for r in ODD],
                                  "doc_id long, text string, node int, digest string, n int, root long")
    assert Counter(map(tuple, jaccard_join.joined(frame).collect())) == slow_join(ODD)
    assert Counter(map(tuple, jaccard_join.joined(docs).collect())) == slow_join(rows)
    assert jaccard_join.joined(empty).count() == 0


def test_bitmaps_bound_from_above():
    rng = np.random.default_rng(2)
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        x = np.unique(rng.choice(pool, rng.integers(1, 380)))
        y = np.union1d(rng.choice(x, rng.integers(1, len(x) + 1), replace=False), rng.choice(pool, rng.integers(1, 1 + len(x) // 5 + 1)))
        if 5 * len(x) < 4 * len(y) or 5 * len(y) < 4 * len(x):
            continue
        both = len(np.intersect1d(x, y))
        maps = jaccard_join.Bitmaps([jaccard_join.bitmap(s, jaccard_join.words_for(len(s))).tobytes() for s in (x, y)])
        differ = maps.differing(np.array([0, 1]), np.array([1, 0]))
        assert differ[0] == differ[1] and 2 * both <= len(x) + len(y) - differ[0]
        if 5 * both >= 4 * (len(x) + len(y) - both):
            assert jaccard_join.bound_passes(len(x), len(y), differ[0])
    assert [jaccard_join.words_for(n) for n in (1, 64, 65, 128, 129, 5000)] == [1, 1, 2, 2, 4, 128]
