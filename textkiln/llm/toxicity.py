"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on windows of ordinary labelled
texts, one on toxic text. A text is cut into windows of a few words, each half
over the one before, and each window is compressed with the ordinary dictionary
and with the toxic one, behind which the ordinary one stands again. What the
latter saves is large only where wording is known from toxic text. A document's
score comes from its best windows and their mean through thresholds calibrated
on the labelled sample.

Labels tell which documents are toxic, not where, and most text of a toxic
document is ordinary. The toxic dictionary is trained on the short windows of
toxic documents around wording that stands in many more different surroundings
there than in ordinary documents. Equal windows count once, so a passage copied
into many documents teaches nothing.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_texts, need_columns, reliable
from .quality_model import held_out, labelled_sample

#: Words of a window.
WINDOW = 8
#: Labelled rows used of each class, at most, and bytes of their texts, about.
SAMPLE_PER_CLASS, SAMPLE_BYTES = 2500, 8 << 20
#: Bytes of the ordinary dictionary, and those of which the toxic one gets what
#: is best on the sample.
ORDINARY_BYTES, TOXIC_BYTES = 48_000, (700, 1_500, 3_000, 6_000, 12_000)
#: Different surroundings that toxic wording has at least, how many times its
#: rate of them in ordinary documents, and how many of them the toxic dictionary
#: is trained on, so that frequent wording leaves room for other.
MIN_SURROUNDINGS, RATIO, EXAMPLES = 5, 16, 12
THRESHOLD = 0.3
_PAD = 40
_EDGES = b".,;:!?\"'()|*&%$#<>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """Windows of ``size`` words, each beginning in the middle of the one before."""
    w = words_of(text)
    step = max(1, size // 2)
    return [b" " + b" ".join(w[i : i + size]) + b" " for i in range(0, max(1, len(w) - size + step), step)] if w else []


def trained(samples: list[bytes], size: int, segment: int = 14) -> bytes:
    """A dictionary trained by zstandard; of too little text, the text itself."""
    size = min(size, max(256, sum(map(len, samples)) // 2))
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=6, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


@lru_cache(maxsize=16)
def _coder(dictionary: bytes) -> zstandard.ZstdCompressor:
    kind = zstandard.ZstdCompressionDict(dictionary.rjust(16), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    how = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_GREEDY, min_match=4, window_log=19, chain_log=16, hash_log=16, search_log=4, target_length=16,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    return zstandard.ZstdCompressor(compression_params=how, dict_data=kind)


def saver(ordinary: bytes, toxic: bytes):
    """How many bytes the toxic dictionary saves on a window. What stands at the
    end of both is put before it, as zstandard does not compress short texts."""
    plain, bad, pad = _coder(ordinary).compress, _coder(toxic + ordinary).compress, ordinary[-_PAD:]
    return lambda window: len(plain(pad + window)) - len(bad(pad + window))


def signs(text: str | None, ordinary: bytes, toxic: bytes) -> tuple[float, float, float]:
    """Best and second best saving of a window in bytes, and the mean of all.

    Windows that a text repeats are compressed once but count each time.
    """
    saves = saver(ordinary, toxic)
    seen: dict[bytes, int] = {}
    first = second = total = n = 0
    for w in windows(text):
        gain = seen.get(w)
        if gain is None:
            gain = seen[w] = saves(w)
        total += gain
        n += 1
        if gain > first:
            first, second = gain, first
        elif gain > second:
            second = gain
    return float(first), float(second), total / n if n else 0.0


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...] = (1.0, 0.5, 0.0)
    bias: float = -5.0

    def logit(self, found: tuple[float, float, float]) -> float:
        return sum(w * x for w, x in zip(self.weights, found)) + self.bias

    def score(self, text: str | None) -> float:
        z = self.logit(signs(text, self.ordinary, self.toxic))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def toxic_text(bad: list[str], good: list[str]) -> list[bytes]:
    """Windows of the toxic texts ``bad``, each a word and what is next to it,
    where that word stands in more surroundings than chance and the ``good``
    texts explain."""

    def around(texts):
        met = defaultdict(set)
        for text in texts:
            w = [x.strip(_EDGES) for x in words_of(text)]
            for before, word, after in zip([b"", *w], w, [*w[1:], b""]):
                met[word].add((before, after))
        return met

    toxic, plain = around(bad), around(good)
    all_bad, all_good = (max(1, sum(map(len, met.values()))) for met in (toxic, plain))
    out = []
    for word, places in toxic.items():
        n, m = len(places), len(plain.get(word, ()))
        # rates with two and one standard deviations to the safe side
        if word and n >= MIN_SURROUNDINGS and (n - 2 * n**0.5) / all_bad > RATIO * (m + 0.5 + m**0.5) / all_good:
            out += [b"%s %s %s" % (before[-3:], word, after[:3]) for before, after in sorted(places)[:EXAMPLES]]
    return out


def calibrate(found: np.ndarray, y: np.ndarray, prior: float) -> tuple[tuple[float, ...], float, float]:
    """Logistic weights and bias, moved so that the best F1 at the prior is at
    the threshold, and that F1."""
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9)) / len(y)
    middle, spread = found.mean(axis=0), found.std(axis=0) + 1e-9
    x = np.c_[(found - middle) / spread, np.ones(len(found))]
    w = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.r_[np.full(x.shape[1] - 1, 1e-3), 0]
        slope = x.T @ (weight * (p - y)) + ridge * w
        bend = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        w -= np.linalg.solve(bend, slope)
    z = x @ w
    order = np.argsort(-z, kind="stable")
    hits, all_ = np.cumsum((weight * y)[order]), np.cumsum(weight[order])
    f1 = 2 * hits / (all_ + prior)
    last = np.r_[z[order][1:] != z[order][:-1], True]
    best = int(np.argmax(np.where(last, f1, -1)))
    cut = z[order][best]
    below = z[order][best + 1] if best + 1 < len(z) else cut - 1
    slopes = w[:-1] / spread
    return tuple(slopes.tolist()), float(w[-1] - (middle * slopes).sum() - (cut + below) / 2 + math.log(THRESHOLD / (1 - THRESHOLD))), float(f1[best])


def fit(docs: DataFrame, labels: DataFrame, parts: int = 4, rest: int = 2, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Dictionaries and thresholds from a bounded sample, none of it held out.

    The driver gets at most ``per_class`` rows and ``SAMPLE_BYTES`` of text of
    each class. Without labelled rows of both classes the thresholds are the
    defaults.
    """
    texts = need_columns(docs, doc_id="long", text="string")
    sample = reliable(labelled_sample(texts, labels, "toxic", parts, rest, per_class, SAMPLE_BYTES))
    rows = sorted(((r["doc_id"], r["text"], r["label"]) for r in sample.collect()), key=lambda r: (r[0], r[1] or ""))
    ordinary = trained(list(dict.fromkeys(w for _, t, y in rows if y == 0 for w in windows(t, 16))), ORDINARY_BYTES)
    bad, good = ([t for t in dict.fromkeys(t for _, t, y in rows if y == v)] for v in (1, 0))
    if not bad or not good:
        return Model(ordinary, trained(toxic_text(bad, good), TOXIC_BYTES[0]))
    # a document is tried on dictionaries of the half that it is not in
    side = {t: i % 2 for texts in (bad, good) for i, t in enumerate(texts)}
    halves = [toxic_text([t for t in bad if side[t] == i], [t for t in good if side[t] == i]) for i in (0, 1)]
    tried = [[trained(half, size) for size in TOXIC_BYTES] for half in halves]

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [[x for toxic in tried[1 - side[t]] for x in signs(t, ordinary, toxic)] for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "label", "found"])

    got = map_texts(sample.repartition(8), "text", fn, "doc_id long, label int, found array<double>").toArrow().sort_by("doc_id")
    y, found = got.column("label").to_numpy(), np.array(got.column("found").to_pylist()).reshape(len(rows), len(TOXIC_BYTES), 3)
    known = need_columns(labels, doc_id="long", toxic="int").where("toxic IN (0, 1)").where(~held_out(F.col("doc_id"), parts, rest))
    prior = min(max(known.agg(F.avg("toxic")).first()[0], 1e-3), 1 - 1e-3)
    made = [calibrate(found[:, i], y, prior) for i in range(len(TOXIC_BYTES))]
    best = max(range(len(made)), key=lambda i: made[i][2])
    return Model(ordinary, trained(toxic_text(bad, good), TOXIC_BYTES[best]), *made[best][:2])


def score(docs: DataFrame, model: Model, parts: int = 4, rest: int = 2) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Null and empty texts have no windows and get the score of the bias alone;
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
