"""Quality classifier: supervised subword embeddings.

A document is a bag of hashed features: its words, its word pairs and its
character 3-, 4- and 5-grams. Every bucket has a learned vector; a document is
the average of its features' vectors, and a softmax layer reads its class from
that average. Vectors and layer are trained together by stochastic gradient
descent in numpy on a bounded sample of labelled rows.

Between the average and the softmax nothing is bent, so a bucket's part in the
score is one number. Scoring broadcasts that table of fixed size and averages
it over a text's features in one pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .frames import map_texts, need_columns
from .shingles import mix64

#: Buckets of the feature table (a power of two) and length of a vector.
BUCKETS, DIM = 1 << 17, 12
#: Labelled rows used of each class, at most: those whose hashed id is least.
SAMPLE_PER_CLASS = 1200
#: Bytes of their texts, about, of each class.
SAMPLE_BYTES = 8 << 20
EPOCHS, RATE = 6, 0.3
CHAR_GRAMS = (3, 4, 5)
THRESHOLD = 0.3

_WORD, _PAIR = 0x51ED270B, 0x9E3779B9
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)


def _buckets(h: np.ndarray) -> np.ndarray:
    return (mix64(h) >> _SHIFT).astype(np.int64)


def features(text: str | None) -> np.ndarray:
    """Bucket of every feature of a whole text, in no order, with repeats."""
    if not text:
        return np.empty(0, np.int64)
    data = text.encode("utf-8", "replace")
    words = data.split()
    parts = []
    if words:
        w = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
        parts.append(_buckets(w + np.uint64(_WORD)))
        if len(w) > 1:
            parts.append(_buckets(mix64(w[:-1] + np.uint64(_PAIR)) + w[1:]))
    raw = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    for n in CHAR_GRAMS:
        if len(raw) >= n:
            last = len(raw) - n + 1
            gram = np.full(last, n, np.uint64)
            for i in range(n):
                gram = mix64(gram + raw[i : i + last])
            parts.append(_buckets(gram))
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(features(text), return_counts=True)


@dataclass
class Model:
    """``table[bucket]`` is a feature's part in the logit, ``bias`` the rest."""

    table: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0

    def logit(self, text: str | None) -> float:
        f = features(text)
        mean = float(self.table[f].mean()) if len(f) else 0.0
        return self.scale * (mean + self.bias) + self.shift

    def score(self, text: str | None) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.logit(text), -30, 30))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7, epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """SGD over ``(buckets, counts, label)``; both classes weigh the same.

    One class alone, or no rows, give a model that answers with the prior.
    """
    rng = np.random.default_rng(seed)
    y = np.array([r[2] for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        sure = 0.0 if not len(y) else (2.0 if y[0] else -2.0)
        return Model(np.zeros(BUCKETS, np.float32), sure)
    vectors = (rng.random((BUCKETS, DIM), np.float32) - 0.5) / DIM
    layer = np.zeros((DIM, 2), np.float32)
    layer[:, 1] = rng.normal(0, 0.5, DIM)
    layer[:, 0] = -layer[:, 1]
    bias = np.zeros(2, np.float32)
    weight = len(y) / (2 * np.bincount(y, minlength=2))
    parts = [(b, (c / c.sum()).astype(np.float32)) if len(b) else (b, c.astype(np.float32)) for b, c, _ in rows]
    step, total = 0, epochs * len(rows)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            pace = rate * (1 - step / total)
            step += 1
            b, share = parts[i]
            hidden = share @ vectors[b] if len(b) else np.zeros(DIM, np.float32)
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            grad = p * weight[y[i]]
            if len(b):
                # a feature's step is by its share of the text; times its share's
                # inverse norm so that long texts learn as fast as short ones
                vectors[b] -= (pace / max(float(share @ share), 1e-4) ** 0.5) * share[:, None] * (layer @ grad)[None, :]
            layer -= pace * hidden[:, None] * grad[None, :]
            bias -= pace * 0.1 * grad
    table = (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32)
    model = Model(table, float(bias[1] - bias[0]))
    return calibrate(model, parts, y)


def calibrate(model: Model, parts, y: np.ndarray) -> Model:
    """Platt scaling of the training logits, both classes weighing the same."""
    x = np.array([float(share @ model.table[b]) + model.bias if len(b) else model.bias for b, share in parts])
    middle, spread = float(np.median(x)), float(x.std()) or 1.0
    x = (x - middle) / spread
    a, c = 1.0, 0.0
    weight = (len(y) / (2 * np.bincount(y, minlength=2)))[y]
    weight = weight / weight.sum()
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(a * x + c, -30, 30)))
        a -= 2.0 * (float((weight * (p - y) * x).sum()) + 1e-3 * a)
        c -= 2.0 * float((weight * (p - y)).sum())
    model.scale, model.shift = a / spread, c - a * middle / spread
    return model


def held_out(doc_id, parts: int, rest: int):
    """True where crc32 of the id as text leaves ``rest``: never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == rest, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, rest: int, per_class: int, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """``(doc_id, text, label)`` of a bounded sample: per class the rows whose
    hashed id is least, none held out, as many as ``per_class`` rows and about
    ``most_bytes`` of text allow. The ids' number is bounded, so they are
    broadcast."""
    known = need_columns(labels, doc_id="long", **{label: "int"}).where(f"doc_id IS NOT NULL AND {label} IN (0, 1)")
    known = known.where(~held_out(F.col("doc_id"), parts, rest)).groupBy("doc_id").agg(F.max(label).alias("label"))
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.union(some)
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    rows = docs.join(F.broadcast(chosen), "doc_id").withColumn("at", F.row_number().over(order)).where(F.col("at") <= per_class)
    before = F.sum(F.octet_length(F.coalesce("text", F.lit("")))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("before", before).where(F.coalesce("before", F.lit(0)) < most_bytes).select("doc_id", "text", "label")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 5, rest: int = 0, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Train on the labelled sample. Executors make the features of the texts;
    the driver gets their counts (bounded by the sample) and trains."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [counted(t) for t in batch.column(1).to_pylist()]
        pack = lambda i: pa.array([m[i].astype(np.int32).tobytes() for m in made], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), pack(0), pack(1), batch.column(2)], names=["doc_id", "b", "c", "label"])

    texts = need_columns(docs, doc_id="long", text="string")
    sample = labelled_sample(texts, labels, label, parts, rest, per_class)
    made = map_texts(sample, "text", fn, "doc_id long, b binary, c binary, label int").toArrow().sort_by("doc_id")
    read = lambda c: [np.frombuffer(x, np.int32) for x in made.column(c).to_pylist()]
    return train(list(zip(read("b"), read("c"), made.column("label").to_pylist())))


def score(docs: DataFrame, model: Model, parts: int = 5, rest: int = 0) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Null and empty texts have no features and get the score of the bias alone;
    texts of any length are scored whole. Rows are scored by their text only, so
    copies get equal scores; a score of just the threshold is predicted 1. A
    null ``doc_id`` stays null and is not held out. An empty table gives no rows;
    other columns are ignored, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([m.score(t) for t in batch.column(1).to_pylist()], pa.float64())], names=["doc_id", "score"])

    out = map_texts(need_columns(docs, doc_id="long", text="string"), "text", fn, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id"), parts, rest).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
