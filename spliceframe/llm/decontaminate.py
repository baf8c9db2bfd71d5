"""Benchmark decontamination by an FM-index of each training shard (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, each, let_go, tidy

WINDOW = 13
#: Symbols of a shard after which its index is built and searched; memory is about 100 bytes for each.
SHARD_SYMBOLS = 300_000
#: Bytes of text after which a shard ends too, so that few rows wait for its findings.
SHARD_BYTES = 48_000_000
#: Every so-many-th position of a shard's text is stored.
SAMPLED = 8
#: Windows that are searched in one pass, and so held by the driver and each worker at once; more take several passes over the documents.
WINDOWS_A_PASS = 2_000_000
END, BREAK, FIRST = 0, 1, 2
#: A-Z to a-z; what isn't a digit, a letter or beyond ASCII to a blank.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Patterns:
    """The windows of all items: symbols by word, windows as rows of symbols, items by window."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.symbol: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            w = [self.symbol.setdefault(x, len(self.symbol) + FIRST) for x in words(text)]
            for k in range(max(1, len(w) - window + 1) if w else 0):
                owners.setdefault(tuple(w[k : k + window]), set()).add(item)
        self.owners = list(owners.values())
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.shortest = int(self.lengths.min()) if owners else 0
        #: Right-aligned, so that a backward search takes columns from the last.
        self.rows = np.zeros((len(owners), window), np.int32)
        for k, p in enumerate(owners):
            self.rows[k, window - len(p) :] = p


class FmIndex:
    """Burrows-Wheeler text in a wavelet matrix, with sampled suffix positions."""

    def __init__(self, text: np.ndarray):
        text = np.append(text, END).astype(np.int64)
        n = len(text)
        suffixes = self.sort(text)
        self.bwt = text[suffixes - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=int(text.max()) + 1))])
        self.sampled = suffixes % SAMPLED == 0
        self.place = suffixes
        self.place[~self.sampled] = -1
        self.bits = max(1, int(text.max()).bit_length())
        self.zeros_to, self.zeros, level = [], [], self.bwt
        for b in range(self.bits - 1, -1, -1):
            one = (level >> b) & 1
            self.zeros_to.append(np.concatenate([[0], np.cumsum(1 - one)]).astype(np.int32))
            self.zeros.append(int(n - one.sum()))
            level = np.concatenate([level[one == 0], level[one == 1]])

    @staticmethod
    def sort(text: np.ndarray) -> np.ndarray:
        """The suffix array by prefix doubling."""
        n, k = len(text), 1
        rank = text
        while True:
            key = rank * (n + 2 + int(rank.max()))
            key[:-k] += rank[k:] + 1
            order = np.argsort(key, kind="stable")
            ranked = key[order]
            fresh = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            if fresh[-1] == n - 1:
                return order
            k *= 2

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the Burrows-Wheeler text."""
        first = np.zeros_like(at)
        for level in range(self.bits):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            to, zeros = self.zeros_to[level], self.zeros[level]
            a, f = to[at], to[first]
            at = np.where(one, zeros + at - a, a)
            first = np.where(one, zeros + first - f, f)
        return at - first

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that each right-aligned pattern begins, as from and to."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(self.bwt), np.int64)
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[:, column].astype(np.int64)
            go = np.flatnonzero((symbol > 0) & (low < high))
            if not len(go):
                break
            c = np.minimum(symbol[go], len(self.before) - 2)
            known, start = c == symbol[go], self.before[c]
            low[go] = np.where(known, start + self.rank(c, low[go]), 0)
            high[go] = np.where(known, start + self.rank(c, high[go]), 0)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of suffixes, by walking to a sampled one."""
        at, out, steps = rows.copy(), np.full(len(rows), -1, np.int64), 0
        open_ = np.arange(len(rows))
        while len(open_):
            got = self.sampled[at[open_]]
            done = open_[got]
            out[done] = self.place[at[done]] + steps
            open_ = open_[~got]
            symbol = self.bwt[at[open_]]
            at[open_] = self.before[symbol] + self.rank(symbol, at[open_])
            steps += 1
        return out


def _spans(flags: np.ndarray, places: np.ndarray) -> list[tuple[int, int]]:
    """Runs of neighbouring places that are flagged."""
    p = np.sort(places[flags])
    if not len(p):
        return []
    cut = np.flatnonzero(np.diff(p) > 1)
    return list(zip(p[np.concatenate([[0], cut + 1])].tolist(), (p[np.concatenate([cut, [len(p) - 1]])] + 1).tolist()))


class Shard:
    """Collects documents until its text is large enough to index."""

    def __init__(self, patterns: Patterns):
        self.patterns, self.texts, self.places, self.docs, self.size, self.rows, self.bytes = patterns, [], [], [], 0, [], 0

    def add(self, text: bytes | None) -> None:
        p = self.patterns
        w = words(text or b"")
        self.bytes += len(text or b"")
        doc = len(self.rows)
        self.rows.append(len(w))
        if not p.shortest or len(w) < p.shortest:
            return
        symbols = np.fromiter(map(p.symbol.get, w, repeat(BREAK)), np.int32, len(w))
        # a window lies in a run of words that some item has, at least as long as the shortest window
        edge = np.diff(np.concatenate([[0], (symbols != BREAK).view(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = ends - starts >= p.shortest
        for s, e in zip(starts[long].tolist(), ends[long].tolist()):
            self.texts.append(np.append(symbols[s:e], BREAK))
            self.places.append(np.append(np.arange(s, e), -1))
            self.docs.append((doc, e - s + 1))
            self.size += e - s + 1

    def results(self) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """(words, merged spans of hit words, items) of each document added."""
        out: list = [(n, [], []) for n in self.rows]
        if self.size:
            p, text, place = self.patterns, np.concatenate(self.texts), np.concatenate(self.places)
            owner = np.repeat([d for d, _ in self.docs], [n for _, n in self.docs])
            index = FmIndex(text)
            low, high = index.search(p.rows)
            count = np.maximum(0, high - low)
            which = np.repeat(np.arange(len(count)), count)
            offset = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            at = index.locate(low[which] + offset)
            delta = np.bincount(at, minlength=len(text) + 1) - np.bincount(at + p.lengths[which], minlength=len(text) + 1)
            hit = np.cumsum(delta[:-1]) > 0
            bounds = np.searchsorted(owner, np.arange(len(self.rows) + 1))
            found = np.unique(owner[at].astype(np.int64) * len(count) + which)
            items: dict[int, set[str]] = {}
            for d, k in zip((found // len(count)).tolist(), (found % len(count)).tolist()):
                items.setdefault(d, set()).update(p.owners[k])
            for d in items:
                a, b = bounds[d], bounds[d + 1]
                out[d] = (self.rows[d], _spans(hit[a:b], place[a:b]), sorted(items[d]))
        return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, windows_a_pass: int = WINDOWS_A_PASS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (word places, end exclusive) of every document.

    Each task joins its documents into shards, keeps the runs of words that items have (a window lies in one), builds
    an FM-index of them and searches every window backwards. An item of fewer words than a window is one window.
    Null and empty texts have no words and aren't contaminated; items without words or with a null id match nothing;
    repeated items count once by id; repeated documents stay, each a row; other columns aren't read. Items of about
    ``windows_a_pass`` windows are broadcast; more are searched in passes one after the other, see ``_earlier``.
    """
    items, passes = _items(benchmark, window, windows_a_pass)
    text = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    if passes > 1:
        # the key first, so that a row's text goes to Python once
        text = text.withColumn("_text", _text_key())
        earlier = _earlier(text, items, passes, window)
    # not deterministic to Spark, so that a filter on the result doesn't search once more
    search = _search(docs.sparkSession, _patterns(items, passes, passes - 1, window)).asNondeterministic()
    found = text.select(*[c for c in text.columns if c != "text"], search("text").alias("_pass"))
    if passes > 1:
        found = found.join(earlier, "_text", "left")
    found = found.select("doc_id", *_merged(F.col("_pass"), passes > 1))
    return found.withColumns({"n_hit": _hit(F.col("spans")), "contaminated": _contaminated(F.col("n_words"), F.col("spans"))}).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated", "spans"
    )


def _items(benchmark: DataFrame, window: int, windows_a_pass: int) -> tuple[DataFrame, int]:
    """The items that have an id and a text, and how many passes their windows take, counted by Spark."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    length = F.size(F.regexp_extract_all("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0)))
    windows = items.agg(F.sum(F.greatest(length - (window - 1), F.lit(1))).alias("n")).first()["n"] or 0
    return items, max(1, -(-windows // windows_a_pass))


def _patterns(items: DataFrame, passes: int, k: int, window: int) -> Patterns:
    """The windows of one pass's items, a share of all by hash."""
    part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k) if passes > 1 else items
    return Patterns([(r[0], r[1].encode()) for r in part.toLocalIterator()], window)


def _text_key() -> Column:
    return F.unhex(F.sha2("text", 256))


def _earlier(text: DataFrame, items: DataFrame, passes: int, window: int) -> DataFrame:
    """_text (a text's digest), _spans and _items of the texts in which all passes but the last find something.

    A pass is over, its findings cut in the shared folder, before the next one's items are collected, so windows_a_pass
    bounds what driver and workers hold. What is found hangs on the text alone; equal texts are one row.
    """
    cuts = []
    for k in range(passes - 1):
        search = _search(text.sparkSession, told := text.sparkSession.sparkContext.broadcast(_patterns(items, passes, k, window)))
        found = text.select("_text", search.asNondeterministic()("text").alias("f")).where(F.size("f.spans") > 0)
        cuts.append(cut(found.select("_text", "f.spans", "f.items").dropDuplicates(["_text"])))
        told.destroy()
    every = cuts[0]
    for one in cuts[1:]:
        every = every.unionAll(one)
    return every.groupBy("_text").agg(F.flatten(F.collect_list("spans")).alias("_spans"), F.flatten(F.collect_list("items")).alias("_items"))


def _search(spark: SparkSession, patterns: Patterns | Broadcast):
    """A column function of text bytes: the row's words, and the spans and items found.

    Rows stay in Spark's own queue, which spills; text alone goes to Python and findings alone come back.
    """
    told = patterns if isinstance(patterns, Broadcast) else spark.sparkContext.broadcast(patterns)
    kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])

    def findings(shard: Shard) -> pa.Array:
        return pa.array([{"n_words": n, "spans": [{"start": s, "end": e} for s, e in spans], "items": items} for n, spans, items in shard.results()], kind)

    @tidy
    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        let_go()
        shard = Shard(told.value)
        for batch in texts:
            for text in each(batch):
                shard.add(text)
                if shard.size >= SHARD_SYMBOLS or shard.bytes >= SHARD_BYTES:
                    yield findings(shard)
                    shard = Shard(told.value)
        if shard.rows:
            yield findings(shard)

    return F.arrow_udf(found, "n_words long, spans array<struct<start:long,end:long>>, items array<string>")


def _merged(last: Column, more: bool) -> list[Column]:
    """n_words, spans and items of the last pass, with _spans and _items of the earlier ones if there are more."""
    spans, items = last["spans"], last["items"]
    if more:
        none = lambda c, like: F.coalesce(F.col(c), F.filter(like, lambda _: F.lit(False)))
        spans, items = _islands(F.concat(spans, none("_spans", spans))), F.array_sort(F.array_distinct(F.concat(items, none("_items", items))))
    return [last["n_words"].alias("n_words"), spans.alias("spans"), items.alias("items")]


def _islands(spans: Column) -> Column:
    """Spans in order, those that touch as one."""

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when(x["start"] <= last["end"], F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(wider))).otherwise(F.concat(done, F.array(x)))

    # an entry before all others, so that there is a last one from the beginning
    before = F.array(F.struct(F.lit(-1).cast("long").alias("start"), F.lit(-1).cast("long").alias("end")))
    return F.aggregate(F.array_sort(spans), before, add, lambda done: F.slice(done, F.lit(2), F.size(done)))


def _hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


def _contaminated(n_words: Column, spans: Column) -> Column:
    return (_hit(spans) > 0) & (20 * _hit(spans) >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, windows_a_pass: int = WINDOWS_A_PASS) -> DataFrame:
    """The documents that aren't contaminated, with the columns they came with.

    The verdict hangs on the row's own text, so ids may repeat or be null.
    """
    items, passes = _items(benchmark, WINDOW, windows_a_pass)
    if passes > 1:
        keyed = docs.select("text").select(F.col("text").cast("binary").alias("text")).withColumn("_text", _text_key())
        earlier = _earlier(keyed, items, passes, WINDOW).select(F.col("_text").alias("_decontaminated"), "_spans", "_items")
        rows = docs.select(F.struct(*docs.columns).alias("_back"), F.col("text").cast("binary").alias("text"))
        rows = rows.join(earlier, _text_key() == F.col("_decontaminated"), "left")
        n_words, spans, _ = _merged(_search(docs.sparkSession, _patterns(items, passes, passes - 1, WINDOW))(F.col("text")), True)
        return rows.where(~_contaminated(n_words, spans)).select("_back.*")
    n_words, spans, _ = _merged(_search(docs.sparkSession, _patterns(items, 1, 0, WINDOW))(F.col("text").cast("binary")), False)
    return docs.where(~_contaminated(n_words, spans))
