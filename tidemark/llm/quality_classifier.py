"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage of the whole text is encoded, a gated attention
weighs the codes, and the weighted code gives the document's score; only documents carry labels, so the attention learns
by itself which passages tell. The model is fitted by numpy on the driver from at most ``SAMPLE`` labelled documents,
chosen by a hash of their ids; scoring is one pass over all documents without a shuffle.

Defined results: null or empty texts are a bag of one empty passage and get a score; labels of unknown documents and null
labels are ignored, of repeated label rows the worst counts and of rows that repeat a sampled id one is learnt from; without labelled rows every score is 0.5, with one
class alone it is nearly that class; repeated rows get equal scores (to nine digits); a null id is not held out; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_texts, slices

PASSAGE = 64
#: Labelled documents that the model is fitted on at most: bounds what the driver holds.
SAMPLE = 4000
HIDDEN, GATE, EPOCHS, RATE, SEED = 16, 8, 40, 0.01, 7
THRESHOLD = 0.7
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"#*$%&|<>", b".", b",", b"!?",
            b"\"'()[]{}-_/\\:;@+=^~`")
FEATURES = len(_CLASSES) + 9


def passages(text: bytes) -> np.ndarray:
    """One row of features for each passage of a text."""
    words = text.split()
    rows = []
    seen: set = set()
    lines = [line for line in text.split(b"\n") if line.strip()]
    copied = 1 - len(set(lines)) / len(lines) if lines else 0.0
    size = np.log1p(len(words))
    for at in range(0, len(words) or 1, PASSAGE):
        part = words[at:at + PASSAGE]
        joined = b"".join(part)
        n, chars = max(1, len(part)), max(1, len(joined))
        counts = [(len(joined) - len(joined.translate(None, c))) / chars for c in _CLASSES]
        reach = words[at:at + PASSAGE + 2]
        windows = list(zip(reach, reach[1:], reach[2:]))
        new = set(windows) - seen
        seen |= new
        rows.append(counts + [chars / n / 10, len(set(part)) / n, 1 - len(new) / len(windows) if windows else 0.0,
                              sum(map(bytes.isupper, part)) / n, sum(len(w) == 1 for w in part) / n,
                              1 - sum(counts), copied, size / 10, np.log1p(len(part)) / 10])
    return np.asarray(rows, np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionModel:
    """code = tanh(x W + b); weight ~ exp(u . (tanh(code V) * sigmoid(code G))); score = sigmoid(c . sum + d)."""

    def __init__(self, features: int = FEATURES):
        rng = np.random.default_rng(SEED)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.mean, self.scale = np.zeros(features), np.ones(features)
        self.p = {"W": draw(features, HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, GATE), "G": draw(HIDDEN, GATE),
                  "u": draw(GATE), "c": draw(HIDDEN), "d": np.zeros(1)}

    def _forward(self, x: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> dict:
        p = self.p
        code = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(code @ p["V"]), _sigmoid(code @ p["G"])
        raw = (t * g) @ p["u"]
        e = np.exp(raw - np.repeat(np.maximum.reduceat(raw, begins), sizes))
        weight = e / np.repeat(np.add.reduceat(e, begins), sizes)
        bag = np.add.reduceat(weight[:, None] * code, begins)
        return {"code": code, "t": t, "g": g, "weight": weight, "bag": bag, "score": _sigmoid(bag @ p["c"] + p["d"])}

    def score(self, bags: Sequence[np.ndarray]) -> np.ndarray:
        sizes = np.fromiter(map(len, bags), np.int64, len(bags))
        x = (np.concatenate(bags) - self.mean) / self.scale
        return self._forward(x, np.cumsum(sizes) - sizes, sizes)["score"]

    def _gradients(self, x: np.ndarray, begins: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict:
        p, f = self.p, self._forward(x, begins, sizes)
        error = (f["score"] - y) / len(y)
        on_bag = np.repeat(error[:, None] * p["c"], sizes, axis=0)
        through = (on_bag * f["code"]).sum(1)
        average = np.repeat(np.add.reduceat(f["weight"] * through, begins), sizes)
        on_raw = f["weight"] * (through - average)
        on_t = on_raw[:, None] * p["u"] * f["g"] * (1 - f["t"] ** 2)
        on_g = on_raw[:, None] * p["u"] * f["t"] * f["g"] * (1 - f["g"])
        on_code = (f["weight"][:, None] * on_bag + on_t @ p["V"].T + on_g @ p["G"].T) * (1 - f["code"] ** 2)
        return {"W": x.T @ on_code, "b": on_code.sum(0), "V": f["code"].T @ on_t, "G": f["code"].T @ on_g,
                "u": (f["t"] * f["g"]).T @ on_raw, "c": f["bag"].T @ error, "d": np.array([error.sum()])}

    def fit(self, bags: Sequence[np.ndarray], labels: Sequence[int]) -> AttentionModel:
        """Adam on the cross-entropy, with a little weight decay; the same input gives the same model."""
        y = np.asarray(labels, float)
        flat = np.concatenate(bags)
        self.mean, self.scale = flat.mean(0), flat.std(0) + 1e-3
        bags = [(b - self.mean) / self.scale for b in bags]
        rng = np.random.default_rng(SEED)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), 128):
                chosen = order[at:at + 128]
                sizes = np.array([len(bags[i]) for i in chosen])
                grads = self._gradients(np.concatenate([bags[i] for i in chosen]), np.cumsum(sizes) - sizes, sizes,
                                        y[chosen])
                step += 1
                for k, g in grads.items():
                    g = g + 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


class Constant:
    """The score where there is nothing to learn from."""

    def __init__(self, value: float):
        self.value = value

    def score(self, bags: Sequence[np.ndarray]) -> np.ndarray:
        return np.full(len(bags), self.value)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id",
           text_column: str = "text", label_column: str = "quality"):
    """A model of at most ``sample`` labelled documents that are not held out; text is the only input."""
    known = (labels.where(F.col(label_column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min(label_column).cast("int").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))  # the documented bound of the sample
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    chosen = texts.join(F.broadcast(known), "doc_id").select("doc_id", "label", "text")  # at most sample short rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            bags = [passages(t).tobytes() for t in byte_texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(bags, pa.binary())],
                                             names=["doc_id", "label", "bag"])

    # Of rows that repeat an id one bag stays, so that the bound holds for any table; tasks keep one each before they send.
    bagged = chosen.mapInArrow(run, "doc_id long, label int, bag binary").groupBy("doc_id").agg(F.min(F.struct("label", "bag")).alias("r"))
    rows = sorted(map(tuple, bagged.select("doc_id", "r.label", "r.bag").collect()))
    if not rows:
        return Constant(0.5)
    bags = [np.frombuffer(r[2], np.float32).reshape(-1, FEATURES) for r in rows]
    values = [r[1] for r in rows]
    if len(set(values)) == 1:
        return Constant((sum(values) + 1) / (len(values) + 2))
    return AttentionModel().fit(bags, values)


def scored(docs: DataFrame, model, threshold: float = THRESHOLD, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            bags = [passages(t) for t in byte_texts(batch, "text")]
            scores = np.round(shared.value.score(bags), 9) if bags else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array((scores >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    key = F.col(id_column).cast("long")
    return docs.select(key.alias("doc_id"), held_out(key).alias("held_out"), F.col(text_column).alias("text")
                       ).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
