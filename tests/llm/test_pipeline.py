"""The corpus pipeline from end to end: each stage's rows against brute force on what the stage before it kept."""

import functools
import random
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.conftest import DOCS, odd_rows
from tests.llm.test_near_copies import slow_classes, slow_fingerprint, slow_first
from tests.llm.test_texts import WORD, lowered
from tidemark.llm import quality_rules, tokens

STAGES = dict(corpus_pipeline.STAGES)


@functools.cache
def planted():
    """Copies, edited copies, a benchmark passage, a passage of two documents, and texts that must stay as they are, all of
    words of the table's clean documents; and the passage."""
    docs = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    clean = {r["doc_id"] for r in pq.read_table(f"{SMALL}/labels.parquet").to_pylist() if r["quality"] == 1}
    words = [w for r in docs if r["doc_id"] in clean and r["lang"] == "en" for w in r["text"].split()]
    rng = random.Random(12)
    own = lambda n=260: " ".join(rng.choices(words, k=n))
    texts, passage = [own() for _ in range(12)], own(70)
    more = [(910101, texts[0]), (910102, texts[0]), (910103, texts[0].upper()), (910104, texts[1] + " end"),
            (910105, f"{own()} {passage} {own()}"), (910106, f"{own()} {passage} {own()}")]
    return [(d, t, "en", "s", len(t)) for d, t in [*enumerate(texts, 910001), *more]], passage


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """documents, labels and benchmark with odd and planted rows, and columns of names the operators use themselves."""
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").union(spark.createDataFrame(odd_rows() + planted()[0], DOCS))
    clashing = {c: F.lit(i) for i, c in enumerate(("row", "hash", "root", "tag", "key", "measured", "spans", "c0"))}
    docs.withColumns(clashing).repartition(5).write.parquet(f"{path}/documents.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    item = planted()[0][11][1]
    more = spark.createDataFrame([(77001, " ".join(item.split()[:120])), (None, None), (77002, "")], "item_id long, text string")
    bench.unionByName(more, allowMissingColumns=True).write.parquet(f"{path}/benchmark.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    labels.union(labels.limit(3)).write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def kept(spark, folder):
    """What goes into each stage, and under "" what the last one returns."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs.cache()
        docs = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.schema == out[name].schema, name
    return out | {"": docs.cache()}


def ids(frame):
    return Counter(r.doc_id for r in frame.select("doc_id").collect())


def test_the_stages_are_those_of_the_contract():
    assert list(STAGES) == ["quality rules", "SimHash near-dedup", "suffix-array dedup", "benchmark decontamination", "best-fit packing"]


def test_rules_reject_what_the_base_rules_and_the_bands_reject(spark, folder, kept):
    rows = kept["quality rules"].select("doc_id", "text", "lang").collect()
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    bands = quality_rules.fitted(quality_rules.judged(kept["quality rules"]).join(
        kept["quality rules"].select("doc_id", "lang").distinct(), "doc_id"), labels)
    want = Counter(r.doc_id for r in rows if quality_rules.verdict((r.text or "").encode(), r.lang, bands)[6])
    got = ids(kept["SimHash near-dedup"])
    assert got.keys() <= {r.doc_id for r in rows if len((r.text or "").split()) >= 50}
    assert got == want and {d for d, *_ in planted()[0] if d < 910100} <= got.keys()


def test_one_of_each_class_goes_on(kept):
    rows = sorted(tuple(r) for r in kept["SimHash near-dedup"].select("doc_id", "text").collect())
    label = slow_classes([slow_fingerprint(t) for _, t in rows])
    want = {}
    for (doc, _), k in zip(rows, label):
        want.setdefault(k, doc)
    got = ids(kept["suffix-array dedup"])
    assert got == Counter(want.values())
    assert 910001 in got and not {910101, 910102, 910103, 910104} & got.keys()


def test_later_copies_of_passages_go(kept):
    rows = [tuple(r) for r in kept["suffix-array dedup"].select("doc_id", "text").collect()]
    after = kept["benchmark decontamination"].select("doc_id", "text", "n_chars").collect()
    assert {r.doc_id: r.text for r in after} == slow_first(rows) and all(r.n_chars == len(r.text) for r in after)
    text = {r.doc_id: r.text for r in after}
    assert planted()[1] in text[910105] and planted()[1][30:-30] not in text[910106]
    assert all(text[d] == t for d, t, *_ in planted()[0][2:12])


def test_contaminated_documents_go(spark, folder, kept):
    windows = set()
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        words = WORD.findall(lowered(r.text))
        windows |= {tuple(words[i:i + 13]) for i in range(max(1, len(words) - 12))} if words else set()
    want = Counter()
    for r in kept["benchmark decontamination"].select("doc_id", "text").collect():
        words, hit = WORD.findall(lowered(r.text)), set()
        for size in {len(w) for w in windows}:
            hit |= {j for i in range(len(words) - size + 1) if tuple(words[i:i + size]) in windows for j in range(i, i + size)}
        want[r.doc_id] += not (hit and 20 * len(hit) >= len(words))
    got = ids(kept["best-fit packing"])
    assert got == +want and 910012 not in got and 910003 in got


def test_every_id_is_packed_once(kept):
    coder = tokens.encoder(tokens.public_path())
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in kept[""].collect():
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids(kept["best-fit packing"]).keys()
    for doc in pieces.values():
        ends = np.cumsum([0] + [n for *_, n, _ in sorted(doc)])
        assert [(p, s) for p, s, *_ in sorted(doc)] == list(enumerate(ends[:-1].tolist()))
        assert all(n == 4096 for *_, n, _ in sorted(doc)[:-1]) and sorted(doc)[-1][2] > 0
    for parts in bins.values():
        ends = np.cumsum([0] + [n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= 4096
    for r in kept["best-fit packing"].select("doc_id", "text").collect():
        ids_ = np.frombuffer(coder.encode([r.text.encode()])[0], coder.type)
        whole = np.append(ids_, 1).astype("<u4")
        assert [p[2:] for p in sorted(pieces[r.doc_id])] == [
            (len(whole[at:at + 4096]), zlib.crc32(whole[at:at + 4096])) for at in range(0, len(whole), 4096)]


def test_the_run_is_its_stages_in_order(spark, folder, kept):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = Counter(map(tuple, corpus_pipeline.run(spark, folder).select(columns).collect()))
    assert got == Counter(map(tuple, kept[""].select(columns).collect())) and got


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_worker_holds_for_one_operator_at_a_time():
    path = tokens.public_path()
    coder = weakref.ref(tokens.encoder(path))
    assert tokens.encoder(path) is coder()
    pieces = weakref.ref(quality_rules._vocabularies()[0])
    assert coder() is None and quality_rules._vocabularies()[0] is pieces()
    tokens.encoder(path)
    assert pieces() is None


def test_texts_go_to_the_quality_rules_once(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3)], DOCS)
    seen = []

    class Stop(Exception):
        pass

    def sent(self, run, schema):
        seen.append(self.schema.simpleString())
        raise Stop

    with pytest.MonkeyPatch.context() as patch, pytest.raises(Stop):
        patch.setattr(type(docs), "mapInArrow", sent)
        quality_rules.kept(docs, labels=spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert seen == ["struct<doc_id:bigint,lang:string,row:struct<c0:bigint,c1:string,c2:string,c3:string,c4:bigint>>"]
