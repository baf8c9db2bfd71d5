"""Text quality by random-indexing word vectors and a two-layer network (operator 2)."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import held_out, label_sample, trained

THRESHOLD = 0.5
#: Rows of the word-vector table that words hash to, length of a vector, non-zero entries of an index vector.
BUCKETS, SIZE, ENTRIES = 1 << 15, 48, 6
#: Words to either side that make a word's context, and the context's weight beside the index vector.
REACH, CONTEXT = 2, 0.7
HIDDEN, ROUNDS, SEED = 24, 300, 11
#: A run of letters and digits, or a run of one other mark: marks are words of their own.
WORD = re.compile(r"[^\W_]+|([^\w\s]|_)\1*").finditer
SHAPES = 8


def index_vectors() -> np.ndarray:
    """A few random 1 and -1 in each row."""
    rng = np.random.default_rng(SEED)
    table = np.zeros((BUCKETS, SIZE), np.float32)
    for _ in range(ENTRIES):
        table[np.arange(BUCKETS), rng.integers(0, SIZE, BUCKETS)] += rng.choice(np.array([-1, 1], np.float32), BUCKETS)
    return table / np.sqrt(ENTRIES)


class Words:
    """Buckets of a text's words. The last SHAPES buckets are for what a word looks like; they count beside the words."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def bucket(self, w: str) -> int:
        if len(self.known) > 300_000:
            self.known.clear()
        h = zlib.crc32(w.lower().encode())
        shape = 0 if w.islower() else 1 if w.istitle() else 2 if w.isupper() else 3 if w.isdigit() else 4 if w.isalnum() else 5
        found = self.known[w] = h % (BUCKETS - SHAPES) * SHAPES + shape
        return found

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(bucket of each word, its shape's bucket)."""
        known, bucket = self.known, self.bucket
        words = [m[0] for m in WORD(text)] if text else []
        coded = np.array([known[w] if w in known else bucket(w) for w in words], np.int64)
        return coded // SHAPES, BUCKETS - SHAPES + coded % SHAPES


def pooled(words: np.ndarray, shapes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of word vectors, mean of shape vectors, the mean's length, how far words repeat and follow themselves, and size."""
    if not len(words):
        return np.zeros(3 * SIZE + 4, np.float32)
    distinct, n = np.unique(words, return_counts=True)
    share = (n / n.sum()).astype(np.float32)
    rows = vectors[distinct]
    mean = share @ rows
    spread = np.sqrt(np.maximum(share @ (rows * rows) - mean * mean, 0))
    shape = np.bincount(shapes - (BUCKETS - SHAPES), minlength=SHAPES).astype(np.float32) / len(shapes) @ vectors[BUCKETS - SHAPES :]
    again = float((words[1:] == words[:-1]).mean()) if len(words) > 1 else 0.0
    return np.concatenate([mean, spread, shape, [np.linalg.norm(mean), len(distinct) / len(words), again, np.log1p(len(words)) / 8]]).astype(np.float32)


class QualityModel:
    def __init__(self, vectors: np.ndarray, centre, scale, layers, temperature: float):
        self.vectors, self.centre, self.scale, self.layers, self.temperature = vectors.astype(np.float16), centre, scale, layers, temperature

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((x - self.centre) / self.scale @ w1 + b1, 0) @ w2 + b2

    def scores(self, texts: list[str | None], words: Words, vectors: np.ndarray) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        z = self.logits(np.stack([pooled(*words.of(t), vectors) for t in texts])) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def word_vectors(texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Index vectors, each with the mean direction of its neighbours' index vectors over the texts."""
    index = index_vectors()
    context = np.zeros_like(index)
    for words, _ in texts:
        for step in range(1, REACH + 1):
            if len(words) > step:
                pairs, n = np.unique(words[:-step] * BUCKETS + words[step:], return_counts=True)
                left, right = pairs // BUCKETS, pairs % BUCKETS
                np.add.at(context, left, index[right] * n[:, None])
                np.add.at(context, right, index[left] * n[:, None])
    norm = np.linalg.norm(context, axis=1, keepdims=True)
    return index + CONTEXT * context / np.maximum(norm, 1e-6)


def train(sample: list[tuple[str, int]]) -> QualityModel:
    """Vectors and network from the sample; a fifth of it is kept to calibrate the temperature.

    Without both labels every score is the sample's share of 1, or 0.5 for an empty sample.
    """
    words = Words()
    coded = [words.of(t) for t, _ in sample]
    y = np.array([y for _, y in sample], np.float32)
    vectors = word_vectors(coded)
    wide = 3 * SIZE + 4
    if len(y) == 0 or y.min() == y.max():
        share = np.clip(y.mean() if len(y) else 0.5, 0.02, 0.98)
        return QualityModel(vectors, np.zeros(wide), np.ones(wide), (np.zeros((wide, 1)), np.zeros(1), np.zeros(1), np.log(share / (1 - share))), 1.0)
    vectors = vectors.astype(np.float16).astype(np.float32)
    x = np.stack([pooled(*c, vectors) for c in coded])
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(y))
    check, fit = order[: len(y) // 5], order[len(y) // 5 :]
    centre, scale = x[fit].mean(0), x[fit].std(0) + 1e-2
    a, t = (x[fit] - centre) / scale, y[fit]
    p = [rng.normal(0, wide**-0.5, (wide, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(())]
    m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    for step in range(1, ROUNDS + 1):
        h = np.maximum(a @ p[0] + p[1], 0)
        error = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - t) / len(t)
        back = error[:, None] * p[2] * (h > 0)
        slopes = [a.T @ back + 1e-3 * p[0] / 10, back.sum(0), h.T @ error + 1e-3 * p[2] / 10, error.sum()]
        for k, g in enumerate(slopes):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            p[k] = p[k] - 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    model = QualityModel(vectors, centre, scale, tuple(p), 1.0)
    z, t = model.logits(x[check]), y[check]
    if len(t):
        loss = lambda c: np.mean(np.logaddexp(0, np.where(t == 1, -z, z) / c))
        model.temperature = float(min(np.exp(np.linspace(np.log(0.5), np.log(8), 60)), key=loss))
    return model


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Learns from at most common.SAMPLE_ROWS labelled documents that aren't held out."""
    return trained(label_sample(docs, labels, "quality"), train)


def score(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of docs, then held_out, score (likelier good towards 1) and predicted.

    Null and empty texts, and texts without words, score as an empty pool. Rows stand alone: repeated rows and null
    ids stay. Columns of docs by the new names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    rows = docs.select(*kept)
    told = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m, words = told.value, Words()
        vectors = m.vectors.astype(np.float32)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(m.scores(b.column("text").to_pylist(), words, vectors), pa.float64())], [*b.schema.names, "score"])

    out = rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("score", DoubleType())]))
    return out.select(*kept, held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
