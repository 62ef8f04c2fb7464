"""Quality classifier: hashed word n-grams, logistic regression, FTRL updates.

Words are runs of letters, of digits or of other signs. Hashed into 2^18 weights
are single words and pairs, and runs of one to three word shapes (case, length
class, the sign itself, whether the word repeats the one before). A text's
features are the shares of its n-grams, so a score is a sparse dot product with
the weights: the mean weight of the n-grams, put through the logistic function.

Weights are learnt with follow-the-regularised-leader updates, one labelled text
at a time, by ``SHARDS`` tasks over a bounded sample (``MAX_ROWS``) whose weights
are averaged. Scoring reads whole texts.

Edge cases: a null or empty text has the bias as its only feature; null labels and
ids are not learnt from; without labelled rows all scores are 0.5; a doc that is
labelled twice is learnt from twice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesrel.llm.text import TOKENS, U, encoded, mix, scan, small

BITS = 18
SIZE = 1 << BITS                     # the weight at SIZE is the bias
MAX_ROWS, SHARDS, EPOCHS = 24_000, 4, 3
ALPHA, BETA, L1, L2 = 0.8, 1.0, 1e-4, 1e-4
SLICE = 1 << 19                      # bytes of text at once
SCALE = 8.0                          # of an n-gram share
THRESHOLD = 0.3
_KINDS = tuple(U(k) for k in (0x1B873593CC9E2D51, 0x85EBCA6B27D4EB2F, 0xC2B2AE35165667B1, 0x38495AB5A1B2C3D5, 0x561CCD1BE6546B64))


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(owner, feature, value)``: each n-gram's share of its kind in its text, times SCALE."""
    h, owner, kind, up, ups, size = scan(texts, TOKENS, shapes=True)
    if not len(h):
        return owner, np.zeros(0, np.int64), np.zeros(0)
    n = len(h)
    again = np.zeros(n, bool)
    again[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    case = np.where((ups == size) & (size > 1), 2, np.where(up, 1, 0))
    shape = kind.astype(U) * U(64) + case.astype(U) * U(16) + np.minimum(size, 12).astype(U) // U(4) * U(2) + again.astype(U)
    shape = mix(np.where(kind == 4, h, shape) + U(1))
    out = []
    for seed, base, width in zip(_KINDS, (h, h, shape, shape, shape), (1, 2, 1, 2, 3), strict=True):
        m = n - width + 1
        if m <= 0:
            continue
        acc = np.full(m, seed, U)
        for j in range(width):
            acc = mix(acc + base[j:m + j])
        inside = owner[:m] == owner[width - 1:]
        own = owner[:m][inside]
        total = np.bincount(own, minlength=len(texts))
        out.append((own, (acc[inside] & U(SIZE - 1)).astype(np.int64), SCALE / total[own]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _features(batches):
    for batch in small(batches, SLICE):
        owner, feature, value = ngrams(encoded(batch.column("text")))
        key, inv = np.unique(owner * (SIZE + 1) + feature, return_inverse=True)
        value = np.bincount(inv, weights=value, minlength=len(key)).astype(np.float32)
        ends = np.searchsorted(key, np.arange(batch.num_rows + 1) * (SIZE + 1)).astype(np.int32)
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "label": batch.column("label"),
            "f": pa.ListArray.from_arrays(ends, (key % (SIZE + 1)).astype(np.int32)),
            "v": pa.ListArray.from_arrays(ends, value)})


class Ftrl:
    """FTRL-proximal logistic regression over ``SIZE`` weights and a bias."""

    def __init__(self):
        self.z, self.n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)

    def weights(self, f=slice(None)):
        z, n = self.z[f], self.n[f]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, f: np.ndarray, v: np.ndarray, label: int) -> None:
        f, v = np.append(f, SIZE), np.append(v, 1.0)
        w = self.weights(f)
        p = 1 / (1 + np.exp(-np.clip(w @ v, -35, 35)))
        g = (p - label) * v
        self.z[f] += g - (np.sqrt(self.n[f] + g * g) - np.sqrt(self.n[f])) / ALPHA * w
        self.n[f] += g * g


def _learn(batches):
    rows = []
    for batch in batches:
        rows += [(i, y, np.asarray(f, np.int64), np.asarray(v)) for i, y, f, v in zip(
            *(batch.column(c).to_pylist() for c in ("doc_id", "label")),
            *([x.values.to_numpy() for x in batch.column(c)] for c in ("f", "v")), strict=True)]
    if not rows:
        return
    rows.sort(key=lambda r: (r[0], r[1]))
    model = Ftrl()
    for epoch in range(EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            model.learn(rows[k][2], rows[k][3], rows[k][1])
    w = model.weights()
    at = np.flatnonzero(w)
    yield pa.record_batch({"f": pa.array(at), "w": pa.array(w[at])})


def train(labelled: DataFrame) -> np.ndarray:
    """Weights from rows with ``doc_id``, ``text`` and ``label`` (0 or 1); callers bound their number."""
    rows = labelled.where("doc_id IS NOT NULL AND label IN (0, 1)")
    feats = rows.select(F.col("doc_id").cast("long"), "text", F.col("label").cast("int")).mapInArrow(
        _features, "doc_id long, label int, f array<int>, v array<float>")
    shards = feats.repartition(SHARDS, F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)))
    learnt = shards.mapInArrow(_learn, "f long, w double").groupBy("f").agg(F.sum("w").alias("w"), F.count("*").alias("n")).toPandas()
    w = np.zeros(SIZE + 1)
    if len(learnt):
        shards_used = int(learnt["n"].max())
        w[learnt["f"].to_numpy(np.int64)] = learnt["w"].to_numpy() / shards_used
    return w


def scores(texts: list[bytes], w: np.ndarray) -> np.ndarray:
    owner, feature, value = ngrams(texts)
    dot = np.bincount(owner, weights=w[feature] * value, minlength=len(texts)) + float(w[SIZE])
    return 1 / (1 + np.exp(-np.clip(dot, -35, 35)))


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``(doc_id, score)`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches):
        for batch in small(batches, SLICE):
            yield pa.record_batch({"doc_id": batch.column("doc_id"),
                                   "score": pa.array(scores(encoded(batch.column("text")), shared.value))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches):
        for batch in small(batches, SLICE):
            yield batch.filter(pa.array(scores(encoded(batch.column("text")), shared.value) >= threshold))

    return docs.mapInArrow(run, docs.schema)
