"""Toxicity by subword-bag embeddings averaged into a linear softmax (operator 5)."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import each, held_out, label_sample, let_go, tidy, trained

THRESHOLD = 0.7
#: Hashed character n-grams, their lengths and the size of their vectors.
BUCKETS, GRAMS, SIZE = 1 << 18, (3, 4, 5, 6), 4
#: Words of a bag, whose vectors are averaged. A document is as toxic as its most toxic run of BAG words, wherever that
#: begins, so neither length nor place thins a few words out; training takes the runs end to end.
BAG = 8
#: Characters of the words that a worker remembers; characters of a word's pieces, which overlap so that no n-gram is lost.
KEPT, PIECE = 5_000_000, 64
#: Characters of texts that are scored together, and words whose n-grams are hashed together.
TOGETHER, WORDS = 200_000, 20_000
#: Largest step of a vector.
RATE = 8.0
#: Log-likelihood ratio, between documents of either label, that an n-gram needs to be trained; others stay at zero.
LEAST_RATIO = 20.0
WORD = re.compile(r"[^\W_]+").findall


def pieces(word: str) -> list[str]:
    """The word; a very long one in pieces, so that its n-grams never stand in memory at once."""
    step = PIECE - max(GRAMS) + 1
    return [word] if len(word) <= PIECE else [word[i : i + PIECE] for i in range(0, len(word) - max(GRAMS) + 1, step)]


def grams(word: str) -> list[int]:
    """Buckets of a piece itself and its character n-grams, ends marked."""
    w = f"<{word}>"
    data = [w[i : i + n] for n in GRAMS for i in range(len(w) - n + 1)]
    return [zlib.crc32(x.encode()) % BUCKETS for x in dict.fromkeys([w, *data])]


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _utf8(codes: np.ndarray) -> list[np.ndarray]:
    """The first, second, third and fourth UTF-8 byte of each code point; 256 where it has none."""
    size = np.searchsorted(np.array([0x80, 0x800, 0x10000], np.uint32), codes, "right")
    if not size.any():
        return [codes]
    lead = np.array([0, 0xC0, 0xE0, 0xF0], np.uint32)[size] | codes >> (6 * size).astype(np.uint32)
    rest = [np.where(size >= k, codes >> (6 * np.maximum(size - k, 0)).astype(np.uint32) & 0x3F | 0x80, np.uint32(256)) for k in range(1, int(size.max()) + 1)]
    return [lead, *rest]


def touched(words: list[str], told: np.ndarray) -> np.ndarray:
    """Whether any bucket of ``grams`` of each piece is told: the hashes of all n-grams of all pieces, character by character."""
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))
    data = _utf8(codes)
    found = np.fromiter((told[zlib.crc32(f"<{w}>".encode()) % BUCKETS] for w in words), bool, len(words))
    at, state = np.arange(len(codes)), np.full(len(codes), 0xFFFFFFFF, np.uint32)
    for n in range(1, max(GRAMS) + 1):
        here = left[at] >= n
        at, state = at[here], state[here]
        state = _CRC[(state ^ data[0][at + n - 1]) & 0xFF] ^ state >> 8
        for more in data[1:]:
            byte = more[at + n - 1]
            k = np.flatnonzero(byte < 256)
            state[k] = _CRC[(state[k] ^ byte[k]) & 0xFF] ^ state[k] >> 8
        if n in GRAMS:
            found[word[at[told[~state % BUCKETS]]]] = True
    return found


class ToxicModel:
    """What scoring needs: each bucket's pull towards toxic (its vector times the softmax's difference) and the bias."""

    def __init__(self, pull: np.ndarray, bias: float, bag: int = BAG):
        self.pull, self.bias, self.bag = pull.astype(np.float32), float(bias), bag
        self.known: dict[str, float] = {}
        self.kept = 0

    def __getstate__(self):
        return self.__dict__ | {"known": {}, "kept": 0}

    def word(self, w: str) -> float:
        """The mean over a word's n-grams, over its pieces where it is very long."""
        each = [float(self.pull[grams(x)].mean()) for x in pieces(w)]
        return sum(each) / len(each)

    def learn(self, words: list[str]) -> None:
        """Pulls of words that aren't known. Few n-grams are trained: a word without any stands at zero, and only the others' n-grams are looked up."""
        short = [w for w in words if len(w) <= PIECE]
        self.known.update(dict.fromkeys(short, 0.0))
        self.kept += sum(map(len, short)) + 16 * len(short)
        for k in np.flatnonzero(touched(short, self.pull != 0)).tolist():
            self.known[short[k]] = self.word(short[k])
        self.known.update((w, self.word(w)) for w in words if len(w) > PIECE)

    def pulls(self, words: list[str]) -> np.ndarray:
        out = np.empty(len(words))
        for k in range(0, len(words), WORDS):
            some = words[k : k + WORDS]
            if self.kept > KEPT:
                self.known.clear()
                self.kept = 0
            fresh = [w for w in set(some) if w not in self.known]
            if fresh:
                self.learn(fresh)
            out[k : k + len(some)] = list(map(self.known.__getitem__, some))
            for w in fresh:
                if len(w) > PIECE:
                    del self.known[w]
        return out

    def _together(self, texts: list[str | None]) -> Iterator[float]:
        words = [WORD(t.lower()) if t else [] for t in texts]
        whole, end = self.pulls([w for x in words for w in x]), 0
        for x in words:
            pulls, end = whole[end : end + len(x)], end + len(x)
            if len(pulls) <= self.bag:
                best = sum(pulls.tolist()) / len(pulls) if len(pulls) else 0.0
            else:
                total = np.concatenate([[0.0], np.cumsum(pulls)])
                best = float((total[self.bag :] - total[: -self.bag]).max()) / self.bag
            yield float(1 / (1 + np.exp(-np.clip(best + self.bias, -30, 30))))

    def scores(self, texts: Iterable[str | None]) -> Iterator[float]:
        """Each text's score; some texts at a time, so that their unknown words are looked up together."""
        some, size = [], 0
        for t in texts:
            some.append(t)
            size += len(t or "")
            if size >= TOGETHER:
                yield from self._together(some)
                some, size = [], 0
        yield from self._together(some)

    def score(self, text: str | None) -> float:
        return next(self.scores([text]))


def telling(flat: np.ndarray, counts: np.ndarray, docs: np.ndarray, words: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which buckets' shares of toxic documents differ from the sample's by more than chance. flat: the words' buckets, counts of them each; docs ascend."""
    starts = np.concatenate([[0], np.cumsum(counts)])
    n, k = np.zeros(BUCKETS), np.zeros(BUCKETS)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(docs)) + 1, [len(docs)]])
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        w = np.unique(words[a:b])
        size = counts[w]
        at = np.repeat(starts[w] - np.cumsum(size) + size, size) + np.arange(size.sum())
        here = np.unique(flat[at])
        n[here] += 1
        k[here] += y[docs[a]]
    p = y.mean()
    part = lambda x, expected: x * np.log(np.maximum(x, 1e-9) / np.maximum(expected, 1e-9))
    return (2 * (part(k, n * p) + part(n - k, n * (1 - p))) >= LEAST_RATIO) & (k > n * p)


def train(sample: list[tuple[str, int]], rounds: int = 80, seed: int = 7) -> ToxicModel:
    """Word vectors, their n-grams' vectors and the softmax are trained jointly, by Adam, on the bags of each document.

    At first every bag bears its document's label; then only a document's most toxic bag does. Without either label
    all scores are near zero.
    """
    vocabulary: dict[str, int] = {}
    # as machine numbers: a sample's words are millions, and a list's arrays of a few numbers each cost more than the numbers
    words, bag_of, doc_of_bag, labels = array("i"), array("i"), array("i"), []
    for d, (text, y) in enumerate(sample):
        w = array("i", [vocabulary.setdefault(y, len(vocabulary)) for x in WORD(text.lower()) for y in pieces(x)])
        labels.append(y)
        for k in range(0, len(w), BAG):
            words += w[k : k + BAG]
            bag_of += array("i", [len(doc_of_bag)]) * len(w[k : k + BAG])
            doc_of_bag.append(d)
    y = np.array(labels, np.int64)
    if len(doc_of_bag) == 0 or y.min() == y.max():
        return ToxicModel(np.zeros(BUCKETS), -6.0)
    flat, whole = array("i"), array("i")
    for w in vocabulary:
        own = grams(w)
        flat.extend(own)
        whole.append(len(own))
    del vocabulary
    words, bag_of, docs, flat, whole = (np.frombuffer(x, np.int32) for x in (words, bag_of, doc_of_bag, flat, whole))
    told = telling(flat, whole, docs[bag_of], words, y)[flat]
    if not told.any():
        return ToxicModel(np.zeros(BUCKETS), -6.0)
    # words without such an n-gram stand at zero: they count in a bag's size alone
    counts = np.add.reduceat(told, np.cumsum(whole) - whole, dtype=np.int64)
    place = np.where(counts > 0, np.cumsum(counts > 0) - 1, -1)
    sizes = np.bincount(bag_of)
    here = place[words] >= 0
    bag_of, words, whole, counts = bag_of[here].astype(np.int64), place[words[here]], whole[counts > 0].astype(np.int64), counts[counts > 0]
    used, flat = np.unique(flat[told], return_inverse=True)
    gram_word = np.repeat(np.arange(len(counts)), counts)
    # a word is the mean of its n-grams, a bag the mean of its words; both as sorted segments
    pairs, multiple = np.unique(bag_of * len(counts) + words, return_counts=True)
    pair_bag, pair_word = pairs // len(counts), pairs % len(counts)
    weight = (multiple / sizes[pair_bag]).astype(np.float32)[:, None]
    by_word = np.argsort(pair_word, kind="stable")
    by_gram = np.argsort(flat, kind="stable")
    first = lambda x: np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    bag_at, word_at, gram_at, own_at = first(pair_bag), first(pair_word[by_word]), first(flat[by_gram]), np.concatenate([[0], np.cumsum(counts)[:-1]])
    doc_at = first(docs)
    scale = (1 / whole).astype(np.float32)[:, None]
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-0.1, 0.1, (len(used), SIZE)).astype(np.float32)
    soft = rng.normal(0, 0.5, (SIZE, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    share = {1: 0.5 / max(1, (y == 1).sum()), 0: 0.5 / max(1, (y == 0).sum())}
    balance = np.where(y == 1, share[1], share[0]).astype(np.float32) * len(y)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (vectors, soft, bias)]
    for step in range(1, rounds + 1):
        word_vectors = np.add.reduceat(vectors[flat], own_at) * scale
        bags = np.zeros((len(docs), SIZE), np.float32)
        bags[pair_bag[bag_at]] = np.add.reduceat(word_vectors[pair_word] * weight, bag_at)
        logits = bags @ soft + bias
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(1, keepdims=True)
        error = p.copy()
        error[np.arange(len(docs)), y[docs]] -= 1
        if step <= rounds // 4:
            error *= (balance[docs] / np.bincount(docs, minlength=len(y))[docs])[:, None] / len(y)
        else:  # the most toxic bag of each document stands for it
            margin = p[:, 1] - p[:, 0]
            top = np.maximum.reduceat(margin, doc_at)
            chosen = margin == np.repeat(top, np.diff(np.append(doc_at, len(docs))))
            error *= (chosen * balance[docs])[:, None] / len(y)
        slope = [None, bags.T @ error, error.sum(0)]
        back = (error @ soft.T).astype(np.float32)
        to_words = np.zeros_like(word_vectors)
        to_words[pair_word[by_word][word_at]] = np.add.reduceat((back[pair_bag] * weight)[by_word], word_at)
        slope[0] = np.add.reduceat((to_words * scale)[gram_word][by_gram], gram_at)
        for p_, g, (m, v), rate in zip((vectors, soft, bias), slope, state, (RATE, 0.05, 0.4)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            # one scale for all vectors: rare n-grams, whose slopes are small, move less
            turn = np.sign(m) * np.sqrt(np.abs(m) / (np.abs(m).max() + 1e-12)) if p_ is vectors else m / (np.sqrt(v / (1 - 0.99**step)) * (1 - 0.9**step) + 1e-12)
            p_ -= rate * (1 - step / (rounds + 1)) * turn
    pull = np.zeros(BUCKETS, np.float32)
    pull[used] = vectors @ (soft[:, 1] - soft[:, 0])
    return ToxicModel(pull, bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame) -> ToxicModel:
    """Learns from at most common.SAMPLE_ROWS labelled documents that aren't held out."""
    return trained(label_sample(docs, labels, "toxic"), train)


def score(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of docs, then held_out, score and predicted.

    Null and empty texts, and texts without words, get the score of an empty bag. Rows stand alone: repeated rows and
    null ids stay. Columns of docs by the new names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    out = docs.select(*kept, _scorer(docs.sparkSession, model)(F.col("text").cast("string")).alias("score"))
    return out.select(*kept, held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _scorer(spark: SparkSession, model: ToxicModel):
    """Rows stay in Spark's own queue, which spills; text alone goes to Python and scores alone come back."""
    told = spark.sparkContext.broadcast(model)

    @tidy
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        let_go()
        for batch in texts:
            yield pa.array(told.value.scores(each(batch)), pa.float64())

    # not deterministic to Spark, so that a filter on the score doesn't score once more
    return F.arrow_udf(scores, "double").asNondeterministic()
