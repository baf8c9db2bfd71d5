"""Near duplicates by Order MinHash with banded alignment (operator 9)."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, each, let_go, tidy
from .decontaminate import words

#: Words of a k-mer, least share of aligned k-mers, k-mers sampled for a band, bands, and bands a candidate pair agrees on.
K, SIMILARITY, SAMPLED, BANDS, AGREE = 5, 0.8, 3, 32, 6
#: Text ids up to which the set of candidates is broadcast (16 bytes each); beyond it, texts are shuffled to it.
BROADCAST_IDS = 200_000
#: Rows of ids for a partition at least.
ROWS = 50_000
_rng = np.random.default_rng(2024)
_SEEDS = _rng.integers(1, 2**63, BANDS, dtype=np.uint64)[:, None]
_ODD = _rng.integers(1, 2**63, BANDS, dtype=np.uint64)[:, None] | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def kmers(text: bytes | None, hashes: WordHash) -> np.ndarray:
    """Hashes of a text's k-mers in order, each labelled by its occurrence, so none repeats. Fewer than K words are one k-mer."""
    w = words(text or b"")
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, w), np.uint64, len(w))
    size = min(K, len(h))
    total = np.zeros(len(h) - size + 1, np.uint64)
    for j in range(size):
        total = total * _STEP + h[j : len(h) - size + 1 + j]
    total = _mix(total)
    order = np.argsort(total, kind="stable")
    ranked = total[order]
    same = np.concatenate([[False], ranked[1:] == ranked[:-1]])
    if same.any():
        at = np.arange(len(total))
        occurrence = np.empty(len(total), np.uint64)
        occurrence[order] = at - np.maximum.accumulate(np.where(same, 0, at))
        total = np.where(occurrence > 0, _mix(total + occurrence * _STEP), total)
    return total


def sketch(k: np.ndarray) -> list[int]:
    """For each band the hash of the SAMPLED least k-mers, taken in the order they have in the text."""
    if not len(k):
        return []
    take = min(SAMPLED, len(k))
    keys = np.empty(BANDS, np.uint64)
    step = max(1, min(BANDS, 400_000 // len(k)))
    for b in range(0, BANDS, step):
        value = (k[None, :] ^ _SEEDS[b : b + step]) * _ODD[b : b + step]
        value ^= value >> np.uint64(32)
        at = np.sort(np.argpartition(value, take - 1, axis=1)[:, :take], axis=1) if take < len(k) else np.broadcast_to(np.arange(take), (len(value), take))
        total = np.zeros(len(value), np.uint64)
        for j in range(take):
            total = total * _STEP + k[at[:, j]]
        keys[b : b + step] = _mix(total)
    return keys.view(np.int64).tolist()


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned k-mers over all distinct ones: L / (n + m - L), L the longest alignment within the band that ``least`` allows.

    K-mers don't repeat in a text, so the alignment is the longest increasing run of places. 0 if ``least`` is out of reach.
    """
    n, m = len(a), len(b)
    need = int(np.ceil(least * (n + m) / (1 + least) - 1e-9))
    if not n or not m or need > min(n, m):
        return 0.0
    order = np.argsort(b, kind="stable")
    at = np.minimum(np.searchsorted(b, a, sorter=order), m - 1)
    places = order[at]
    here = b[places] == a
    if here.sum() < need:
        return 0.0
    i = np.flatnonzero(here)
    j = places[here]
    band = n + m - 2 * need
    tails: list[int] = []
    for x in j[np.abs(i - j) <= band].tolist():
        k = bisect_left(tails, x)
        if k == len(tails):
            tails.append(x)
        else:
            tails[k] = x
    aligned = len(tails)
    return aligned / (n + m - aligned)


def _with_id(docs: DataFrame) -> DataFrame:
    """doc_id, text bytes, and the text's md5 as its id; null and empty texts have no id."""
    text = F.col("text").cast("string")
    return docs.select("doc_id", F.when(F.length(text) > 0, F.unhex(F.md5(text.cast("binary")))).alias("id"), text.cast("binary").alias("text"))


def _sketches(rows: DataFrame) -> DataFrame:
    kind = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, id binary, keys array<long>"

    @tidy
    def run(batches):
        let_go()
        hashes = WordHash()
        for b in batches:
            keys = [sketch(kmers(t, hashes)) for t in each(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("id"), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "id", "keys"])

    return rows.mapInArrow(run, kind)


def _sequences(rows: DataFrame) -> DataFrame:
    """id and its k-mers as 32-bit hashes; over two texts' thousands of k-mers a chance match is rarer than one in a hundred pairs, and worth one k-mer."""

    @tidy
    def run(batches):
        let_go()
        hashes = WordHash()
        for b in batches:
            data = [(kmers(t, hashes) >> np.uint64(32)).astype("<u4").tobytes() for t in each(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(data, pa.binary())], ["id", "seq"])

    return rows.select("id", "text").mapInArrow(run, "id binary, seq binary")


def _only(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of df with one of the ids, which are broadcast while few, so that the others aren't shuffled."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")


def _gathered(df: DataFrame) -> DataFrame:
    """A checkpointed df in no more partitions than its rows need, so that what follows doesn't write many tiny files."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS)))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select("id").union(pairs.select("rep")).distinct()


def _verify(pairs: DataFrame, sequences: DataFrame, least: float) -> DataFrame:
    """pairs with ok, true where the texts align. Each side's sequence comes by its own join; a hot representative's pairs can be split."""
    needed = _only(sequences, cut(_ends(pairs)))
    both = pairs.join(needed, "id").join(needed.select(F.col("id").alias("rep"), F.col("seq").alias("rep_seq")), "rep").select("id", "rep", "seq", "rep_seq")

    def run(batches):
        for b in batches:
            ok = [similarity(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"), least) >= least for x, y in zip(each(b.column("seq")), each(b.column("rep_seq")))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("rep"), pa.array(ok, pa.bool_())], ["id", "rep", "ok"])

    return both.mapInArrow(run, "id binary, rep binary, ok boolean")


def _tokens(rows: DataFrame) -> DataFrame:
    """Each k-mer of each text once, as a 32-bit number, with the text's length n in k-mers and how many of them differ (size)."""

    def run(batches):
        for b in batches:
            for i, seq in zip(each(b.column("id")), each(b.column("seq"))):
                own = np.frombuffer(seq, "<u4")
                different = np.unique(own)
                for at in range(0, len(different), 100_000):
                    part = pa.array(different[at : at + 100_000].view(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array([i] * len(part), pa.binary()), pa.array([len(own)] * len(part), pa.int32()), pa.array([len(different)] * len(part), pa.int32()), part], ["id", "n", "size", "token"])

    return rows.select("id", "seq").mapInArrow(run, "id binary, n int, size int, token int")


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(id, label) of texts that share AGREE buckets or more with texts of other components; no other text can have a link that is still missing."""
    live = members.join(roots, "id", "left").select("bucket", "id", F.coalesce("root", "id").alias("label"))
    for _ in range(2):
        mixed = live.groupBy("bucket").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo <> _hi").select("bucket")
        live = live.join(mixed, "bucket")
        live = live.join(live.groupBy("id").count().where(F.col("count") >= AGREE).select("id"), "id")
    return live.select("id", "label").distinct()


def _split(open_texts: DataFrame, sequences: DataFrame, least: float) -> DataFrame:
    """(id, rep) of open texts in different components that could still align to ``least``: an exact filter that splits hot buckets.

    K-mers are put in one order, rare ones first. The first k-mer that two texts share leaves at most as many shared
    ones as the shorter rest holds, so it stands early in both if they are to align; edits make k-mers of their own,
    which are rare and come first, so texts that resemble a hot group too little share none there. Within a k-mer's
    texts, those of its largest component aren't compared with each other.
    """
    tokens = cut(_tokens(open_texts.join(sequences, "id")))
    counted = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = Window.partitionBy("id")
    at = F.col("size") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("df", "token")) - 1
    early = tokens.join(counted, "token").withColumn("at", at).where(F.col("at") <= F.col("size") - F.ceil(F.lit(least) * F.col("n") - 1e-9)).drop("df")
    early = _gathered(cut(early.join(open_texts, "id")))
    each = early.groupBy("token", "label").agg(F.count(F.lit(1)).alias("k"))
    mixed = each.groupBy("token").agg(F.max(F.struct("k", "label"))["label"].alias("major"), F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo <> _hi").select("token", "major")
    early = _gathered(cut(early.join(mixed, "token")))
    a, b = early.where("label <> major").alias("a"), early.alias("b")
    need = F.ceil(F.lit(least / (1 + least)) * (F.col("a.n") + F.col("b.n")) - 1e-9)
    on = (F.col("a.token") == F.col("b.token")) & (F.col("a.label") != F.col("b.label")) & ((F.col("b.label") == F.col("b.major")) | (F.col("a.id") < F.col("b.id")))
    reach = (F.col("a.at") <= F.col("a.size") - need) & (F.col("b.at") <= F.col("b.size") - need)
    return a.join(b, on & reach).select(F.greatest("a.id", "b.id").alias("id"), F.least("a.id", "b.id").alias("rep")).distinct()


def links(uniq: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(id, rep) with rep < id: verified links that connect the texts which share AGREE bands and align.

    First every text is compared with the centre of each of its buckets: the member whose buckets hold the most
    entries, which in a group of copies is what they are copies of. What agrees on AGREE bands and aligns is linked,
    so most groups are one component. Then texts that share AGREE buckets with other components meet by their rare
    k-mers (``_split``), an exact filter. Pairs grow with the square of a group only where that many texts of different
    components pass the filter.
    """
    entries = uniq.select("id", F.posexplode("keys").alias("at", "key")).select("id", F.xxhash64("at", "key").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("_lo"), F.max("id").alias("_hi")).where("_lo <> _hi").select("bucket", "n")
    members = _gathered(cut(entries.join(shared, "bucket")))
    weight = members.groupBy("id").agg(F.sum("n").alias("weight"), F.count(F.lit(1)).alias("bands")).where(F.col("bands") >= AGREE).select("id", "weight")
    members = _gathered(cut(members.join(weight, "id").select("bucket", "id", "weight")))
    centres = members.groupBy("bucket").agg(F.max(F.struct("weight", "id"))["id"].alias("rep"))
    pairs = members.join(centres, "bucket").where("id <> rep").select(F.greatest("id", "rep").alias("id"), F.least("id", "rep").alias("rep")).distinct()
    keys = _gathered(cut(_only(uniq.select("id", "keys"), cut(members.select("id").distinct()))))
    mine, theirs = keys.select("id", F.col("keys").alias("_a")), keys.select(F.col("id").alias("rep"), F.col("keys").alias("_b"))
    agree = F.size(F.filter(F.zip_with("_a", "_b", lambda x, y: x == y), lambda x: x))
    likely = _gathered(cut(pairs.join(mine, "id").join(theirs, "rep").where(agree >= AGREE).select("id", "rep")))
    sequences = _gathered(cut(_sequences(_only(texts, keys.select("id")).dropDuplicates(["id"]))))
    found = _gathered(cut(_verify(likely, sequences, least).where("ok").select("id", "rep")))
    still = _gathered(cut(_open(members.select("bucket", "id"), components(found))))
    if still.isEmpty():
        return found
    more = _verify(_gathered(cut(_split(still, sequences, least))), sequences, least).where("ok").select("id", "rep")
    return cut(found.unionAll(more))


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every id in an edge, root the least id it is connected to, by alternating stars until nothing changes."""
    edges = _gathered(cut(edges.select(F.greatest("id", "rep").alias("a"), F.least("id", "rep").alias("b")).where("a <> b").distinct()))
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).union(edges.select(F.col("b"), F.col("b")).distinct())
        before, parts = state, max(1, edges.rdd.getNumPartitions())
        both = edges.union(edges.select("b", "a")).toDF("u", "v").coalesce(parts)
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").coalesce(parts)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("a", F.col("m").alias("b")).union(small.select(F.col("b").alias("a"), F.col("m").alias("b"))).where("a <> b").coalesce(parts)
        edges = cut(small.distinct().coalesce(parts))


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (least doc_id of the class) and representative of every document.

    Equal texts are one class; texts whose occurrence-labelled five-word k-mers align to ``least`` or more are linked,
    and linked ones are one class. Words are lower-cased (A-Z) and without ASCII marks. Null and empty texts are each
    a class of their own; a null doc_id neither names a class that has others nor is representative. Repeated rows
    stay, all with the same flag. Other columns aren't read.
    """
    rows = _with_id(docs)
    sketches = cut(_sketches(rows))
    named = sketches.where("id IS NOT NULL")
    uniq = cut(named.groupBy("id").agg(F.min("doc_id").alias("least_doc"), F.first("keys").alias("keys")))
    found = links(uniq.select("id", "keys"), rows.where("id IS NOT NULL"), least)
    roots = cut(components(found))
    own = uniq.select("id", "least_doc").join(roots, "id", "left").select("id", "least_doc", F.coalesce("root", "id").alias("root"))
    classes = own.groupBy("root").agg(F.min("least_doc").alias("class_id"))
    by_text = cut(own.join(classes, "root").select("id", "class_id"))
    out = sketches.select("doc_id", "id").join(by_text, "id", "left")
    class_id = F.coalesce("class_id", "doc_id")
    return out.select("doc_id", class_id.alias("class_id"), F.coalesce(F.col("doc_id") == class_id, F.lit(False)).alias("representative"))


def drop_near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each class, that of the least doc_id, with the columns it came with.

    Documents to drop are (doc_id, text id) pairs, broadcast while few; texts aren't shuffled unless they are many or
    rows repeat both. Among rows that repeat both, and in classes without any doc_id, one row stays.
    """
    marked = cut(near_duplicates_by_text(docs, least))
    repeated = marked.where("copies > 1")
    gone = cut(marked.where("NOT keep").select("doc_id", "id"))
    small = gone.count() <= BROADCAST_IDS
    keyed = docs.withColumn("_near_text_id", F.when(F.length(F.col("text").cast("string")) > 0, F.unhex(F.md5(F.col("text").cast("binary")))))
    g = gone.select(F.col("doc_id").alias("_doc"), F.col("id").alias("_gone"))
    on = keyed["_near_text_id"].eqNullSafe(g["_gone"]) & keyed["doc_id"].eqNullSafe(g["_doc"])
    kept = keyed.join(F.broadcast(g) if small else g, on, "left_anti")
    if not repeated.isEmpty():
        kept = kept.where("_near_text_id IS NULL").unionByName(kept.where("_near_text_id IS NOT NULL").dropDuplicates(["doc_id", "_near_text_id"]))
    return kept.select(*docs.columns)


def near_duplicates_by_text(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, id, copies (rows that share both) and keep (the pair that stays for its class) of each distinct pair with a text."""
    rows = _with_id(docs).where("id IS NOT NULL")
    sketches = cut(_sketches(rows))
    uniq = cut(sketches.groupBy("id").agg(F.min("doc_id").alias("least_doc"), F.first("keys").alias("keys")))
    roots = cut(components(links(uniq.select("id", "keys"), rows, least)))
    pairs = sketches.groupBy("doc_id", "id").agg(F.count(F.lit(1)).alias("copies")).join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    stays = pairs.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("id"))).alias("s"))
    return pairs.join(stays, "root").select("doc_id", "id", "copies", (F.col("id").eqNullSafe(F.col("s.id")) & F.col("doc_id").eqNullSafe(F.col("s.doc_id"))).alias("keep"))
